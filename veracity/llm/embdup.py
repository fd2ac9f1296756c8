"""Embedding near-duplicates: iterative quantisation, Hamming tables, rerank.

Unit vectors are centred, projected on their principal axes and rotated so
that signs lose as little as possible (iterative quantisation); each of a few
rotations, learnt from other starts, gives ``BITS`` balanced bits. The codes
are cut into substrings of ``SUBSTRING`` bits, each with a table of its own:
vectors that agree in a whole substring are candidates, so every pair whose
codes differ in fewer bits than there are tables is found. The model is fitted
on at most ``SAMPLE`` vectors; all vectors are indexed.

Recall is measured on a part of the sample that the model isn't fitted on
(:func:`plan`): on its pairs within ``BAND`` above the threshold, found by
brute force, and on partners put at such an angle in the directions in which
the sample's vectors differ. Where less than ``RECALL`` of either share a
substring, as with a large common mean or a dense group, more rotations and
shorter substrings are tried and the cheapest that reach it are taken; the
substrings may become as short as a bit, so some do. Every label goes through
the tables, however few vectors it has.

Equal vectors of one label are one class, with its size as weight. Members of
a bucket are dealt to blocks; each pair of blocks is compared in a task of its
own with the original vectors in double precision. A pair counts in its first
common table only. Tasks return sums of weights and links that span their
components, not pairs. A bucket of m classes costs ``m * m / BLOCK`` rows.

Without a common mean, a pair at cosine 0.93 differs in each bit with a
probability of about 0.12 and so agrees in one of 24 substrings of 16 bits
with 0.96, of 36 with 0.99; closer pairs more often. Centring widens the
angles of vectors that share a direction, so there it is less.

Defined results: vectors that are null, empty, zero, or hold null or
non-finite components, and rows without label or id, link with nothing, have
no links and are kept; vectors of different lengths don't link. Rows that
repeat are other vectors to each other; rows of one id should hold one vector.
An empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracity.llm.base import arrow_batches, arrow_rows
from veracity.llm.components import components
from veracity.session import materialize

COSINE = 0.93
BITS, SUBSTRING, ROTATIONS = 64, 16, 6
SAMPLE, ITERATIONS = 20_000, 40
BLOCK = 512
RECALL, BAND = 0.985, 0.02
#: Vectors and pairs of the sample that recall is measured on, pairs that say something, further rotations and substrings.
MEASURED, PAIRS, LEAST_PAIRS = 4_000, 4_000, 100
MORE_ROTATIONS, SHORTER = 18, (16, 12, 8, 6, 4, 2, 1)


def learn(sample: np.ndarray, bits: int = BITS, rotations: int = ROTATIONS, iterations: int = ITERATIONS, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection (dimensions x rotations * bits) for unit vectors.

    Each step takes the signs as they are, and the rotation that brings the
    projections nearest to them (orthogonal Procrustes)."""
    mean = sample.mean(0)
    centred = sample - mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, ::-1][:, :bits]
    if axes.shape[1] < bits:  # few dimensions: rotations mix them into all bits
        axes = np.pad(axes, ((0, 0), (0, bits - axes.shape[1])))
    low = centred @ axes
    out = []
    for n in range(rotations):
        turn = np.linalg.qr(np.random.default_rng(seed + n).normal(size=(bits, bits)))[0]
        for _ in range(iterations):
            u, _, v = np.linalg.svd(np.where(low @ turn > 0, 1.0, -1.0).T @ low)
            turn = (u @ v).T
        out.append(axes @ turn)
    return mean, np.hstack(out)


def keys_of(unit: np.ndarray, mean: np.ndarray, projection: np.ndarray, substring: int = SUBSTRING) -> np.ndarray:
    """``table << substring | value`` for each vector and table."""
    signs = (unit - mean) @ projection > 0
    tables = signs.shape[1] // substring
    values = signs[:, :tables * substring].reshape(len(unit), tables, substring) @ (1 << np.arange(substring, dtype=np.int64))
    return values + (np.arange(tables, dtype=np.int64) << substring)


def hard_pairs(unit: np.ndarray, kinds: np.ndarray, widths: np.ndarray, cosine: float, seed: int = 0) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs within ``BAND`` above ``cosine``: partners made for the vectors, and such pairs of one kind among them."""
    r = np.random.default_rng(seed)
    n = len(unit)
    away = unit[r.integers(n, size=n)] - unit[r.integers(n, size=n)] + 1e-6 * r.normal(size=unit.shape)
    away *= np.arange(unit.shape[1]) < widths[:, None]
    away -= (away * unit).sum(1, keepdims=True) * unit
    away /= np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-300)
    at = r.uniform(cosine, min(cosine + BAND, 1), size=(n, 1))
    out = [(unit, at * unit + np.sqrt(1 - at * at) * away)]
    left, right = [], []
    for a in range(0, n, BLOCK):  # the sample's order is random, so each block may give as many
        same = unit[a:a + BLOCK] @ unit.T
        x, y = np.nonzero((same >= cosine) & (same < cosine + BAND) & (kinds[a:a + BLOCK, None] == kinds))
        some = r.permutation(len(x))[:PAIRS * BLOCK // n + 1]
        left.append(a + x[some])
        right.append(y[some])
    left, right = np.concatenate(left), np.concatenate(right)
    return [*out, (unit[left], unit[right])] if len(left) >= LEAST_PAIRS else out


def tables_needed(pairs: list[tuple[np.ndarray, np.ndarray]], mean: np.ndarray, projection: np.ndarray, substring: int) -> int | None:
    """So many tables give each group of pairs ``RECALL``; None if all of them don't."""
    most = 0
    for left, right in pairs:
        hit = keys_of(left, mean, projection, substring) == keys_of(right, mean, projection, substring)
        enough = np.flatnonzero(np.logical_or.accumulate(hit, axis=1).mean(0) >= RECALL)
        if not len(enough):
            return None
        most = max(most, int(enough[0]) + 1)
    return most


def plan(unit: np.ndarray, kinds: np.ndarray, widths: np.ndarray, largest: int, cosine: float = COSINE, rotations: int = ROTATIONS, substring: int = SUBSTRING) -> tuple[np.ndarray, np.ndarray, int]:
    """Mean, projection and substring that find the sample's hard pairs; of those that do, the fewest rows for the ``largest`` label."""
    held = min(MEASURED, len(unit) // 4)  # not fitted on: signs are better for those
    measured = slice(0, held) if held else slice(None)
    pairs, unit, held = hard_pairs(unit[measured], kinds[measured], widths[measured], cosine), unit[held:], unit[measured]
    mean, projection = learn(unit, rotations=rotations)
    if tables_needed(pairs, mean, projection, substring) is not None:
        return mean, projection, substring
    projection = np.hstack([projection, learn(unit, rotations=MORE_ROTATIONS, seed=rotations)[1]])
    best, least = (mean, projection, SHORTER[-1]), np.inf  # that two vectors differ in all bits is left to chance 2^-1536
    for bits in sorted({substring, *(x for x in SHORTER if x < substring)}, reverse=True):
        if tables := tables_needed(pairs, mean, projection, bits):
            keys = keys_of(held, mean, projection[:, :tables * bits], bits)
            _, members = np.unique(keys, return_counts=True)
            together = (members * (members - 1.0)).sum() / (tables * len(keys) * max(len(keys) - 1.0, 1.0))
            if (rows := tables * (1 + largest * together / BLOCK)) < least:
                best, least = (mean, projection[:, :tables * bits], bits), rows
    return best


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)  # squares of very large or small components stay finite
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _padded(cells: list[list[float]], width: int) -> np.ndarray:
    out = np.zeros((len(cells), width))
    for i, c in enumerate(cells):
        out[i, :len(c)] = c
    return out


_CODED = pa.schema([("node", pa.int64()), ("unit", pa.binary()), ("keys", pa.list_(pa.int64()))])
_FOUND = pa.schema([("node", pa.int64()), ("other", pa.int64()), ("links", pa.int64())])


def _coded(width: int, model: tuple[np.ndarray, np.ndarray, int]):
    def run(batches):
        for b in batches:
            if b.num_rows:
                unit = _unit(_padded(b.column("embedding").to_pylist(), width))
                keys = keys_of(unit, *model)
                yield pa.RecordBatch.from_arrays(
                    [b.column("node"), pa.array([u.tobytes() for u in unit], pa.binary()), pa.array(list(keys), _CODED.field("keys").type)], schema=_CODED)
    return run


def _compared(cosine: float, substring: int):
    def run(key, table):
        bucket, i, j = key[2].as_py(), key[3].as_py(), key[4].as_py()
        node, weight, block = (table[c].to_numpy() for c in ("node", "weight", "block"))
        unit = np.frombuffer(b"".join(table["unit"].to_pylist())).reshape(len(node), -1)
        keys = np.array(table["keys"].to_pylist())
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        near = unit[left] @ unit[right].T >= cosine
        if i == j:
            near &= node[left][:, None] < node[right][None, :]
        x, y = (side[at] for side, at in zip((left, right), np.nonzero(near), strict=True))
        before = bucket >> substring
        first = ~(keys[x, :before] == keys[y, :before]).any(1)
        x, y = x[first], y[first]
        links = np.zeros(len(node), np.int64)
        np.add.at(links, x, weight[y])
        np.add.at(links, y, weight[x])
        some = np.flatnonzero(links)
        rows = [((int(node[at]), None, int(links[at])), 24) for at in some]
        root = np.arange(len(node))

        def find(at):
            while root[at] != at:
                root[at] = at = root[root[at]]
            return at

        for u, v in zip(x.tolist(), y.tolist(), strict=True):
            if (p := find(u)) != (q := find(v)):
                root[q] = p
                rows.append(((int(node[u]), int(node[v]), 0), 24))
        return pa.Table.from_batches(arrow_batches(rows, _FOUND), _FOUND)
    return run


def _sound(vectors: DataFrame):
    """Rows that can link: label, id and a vector of finite components, not all zero."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col("label").isNotNull() & F.col("vec_id").isNotNull() & F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False))


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, rotations: int = ROTATIONS, substring: int = SUBSTRING, sample: int = SAMPLE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors`` (``vec_id, embedding, label``)."""
    # a column of the same doubles whether components came as floats or doubles
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding")).withColumn("__sound", F.coalesce(_sound(vectors), F.lit(False)))
    alone = rows.filter("not __sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    sound = rows.filter("__sound")
    classes = materialize(sound.groupBy("label", "embedding").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight")))
    width = classes.agg(F.max(F.size("embedding"))).first()[0]
    if width is None:
        return alone.withColumn("kept", F.lit(True))
    kinds = classes.select("node", "label", F.size("embedding").alias("width"), "weight")
    largest = kinds.groupBy("label", "width").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    fitted = classes.select("node", "embedding", F.xxhash64("label", F.size("embedding")).alias("kind")).orderBy(F.xxhash64("node"), "node").limit(sample).collect()
    unit, each = _unit(_padded([r.embedding for r in fitted], width)), np.array([len(r.embedding) for r in fitted])
    model = plan(unit, np.array([r.kind for r in fitted]), each, largest, cosine, rotations, substring)
    substring = model[2]

    coded = materialize(classes.select("node", "embedding").mapInArrow(_coded(width, model), "node long, unit binary, keys array<long>"))
    members = coded.select("node", "keys").join(kinds, "node").select("node", "label", "width", "weight", F.explode("keys").alias("key"))
    bucket = ["label", "width", "key"]
    # stored before the join: its sides then come straight from exchanges, and a hot bucket's can be split
    shared = materialize(members.groupBy(*bucket).agg(F.count("*").alias("n")).filter("n > 1").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")))
    dealt = members.join(shared.drop("n"), bucket).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("to", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(*bucket, F.least("block", "to").alias("i"), F.greatest("block", "to").alias("j"), "node", "weight", "block")
    found = materialize(dealt.join(coded, "node").groupBy(*bucket, "i", "j").applyInArrow(_compared(cosine, substring), "node long, other long, links long"))

    counts = found.filter("other is null").groupBy("node").agg(F.sum("links").alias("links"))
    comp = components(found.filter("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    named = classes.join(counts, "node", "left").join(comp, "node", "left").select(
        "label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("comp", "node").alias("component_id"))
    linked = sound.join(named, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
