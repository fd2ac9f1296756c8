"""MinHash near-duplicates with sequential Bayesian verification.

A document's set holds the hashes (64 bits) of its distinct word shingles.
Documents with the same set form a class, found by one aggregation on the
set's digest, and only one signature for each class goes on.

Candidates share a band of the signature. A bucket's members aren't paired
with each other: each is paired with a few leaders of its bucket, and links
join them to components. Then all pairs that share a bucket and are still in
two components are tested. So every candidate pair is either tested or in one
component anyway: nothing is capped. Pairs in small buckets are rows;
the members of large ones are dealt to blocks, and each pair of blocks is
compared in a task of its own that gives links only. A group of thousands of
copies so costs about a row for each member, band and block.

A pair is verified by comparing signatures in batches. With m of n values
equal and a uniform prior, the posterior of the similarity is Beta(m + 1,
n - m + 1); once the probability that it reaches the threshold is below
``miss``, the pair is dropped. Survivors are confirmed on their full sets.

A pair at similarity s is no candidate with probability
``(1 - s ** rows) ** bands``: 1.2e-7 at 0.8 as set here, 3e-16 at 0.9.

Defined results: a text without words (or null) has an empty set and is linked
with nothing, as is a row whose id is null, whose component is null and which
is kept. Repeated rows are in the class of their text. Rows of one id should
carry one text; where they don't, links of the id's classes are confirmed on
one of its texts, the same at every run. Ties go to the least id; an empty
table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import math
import re
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracity.llm.base import arrow_batches, arrow_rows, slices
from veracity.llm.components import components
from veracity.session import materialize

BANDS, ROWS = 40, 5
MISS = 1e-7
BATCH = 40
#: Members of a bucket whose pairs are rows; members of a block for those of larger ones.
PAIRED, BLOCK = 32, 256
#: Ids that may be broadcast: 8 MB of values.
BROADCAST_IDS = 1_000_000
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_SKETCH = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("signature", pa.binary())])
_SET = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), ("shingles", pa.binary())])


class _WordHash(dict):
    """Hashes of words seen lately."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 16:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


class Shingler:
    """Sorted distinct hashes of a text's word shingles, A-Z taken as a-z.

    A text with fewer words than a shingle is one shingle."""

    def __init__(self, width: int):
        self.width, self.hashes = width, _WordHash()
        self.factors = [np.uint64(f) for f in (np.random.default_rng(11).integers(1, 1 << 63, width, dtype=np.uint64) * 2 + 1)]

    def __call__(self, text: str | None) -> np.ndarray:
        words = _WORD.findall((text or "").encode().lower())
        width = min(self.width, len(words))
        if not width:
            return np.empty(0, np.uint64)
        hashes = self.hashes
        ids = np.fromiter((hashes[w] for w in words), np.uint64, len(words))
        n = len(ids) - width + 1
        out = np.full(n, width, np.uint64)
        for i in range(width):
            out += ids[i:i + n] * self.factors[i]
            out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(32)
        return np.unique(out)


def signature(shingles: np.ndarray, factors: np.ndarray, step: int = 512) -> np.ndarray:
    """For each factor, the least upper half of its product with a shingle."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), step):
        np.minimum(least, (shingles[at:at + step, None] * factors[None, :]).min(0), out=least)
    return (least >> np.uint64(32)).astype("<u4")


def sketches(docs: DataFrame, width: int, size: int) -> DataFrame:
    """``doc_id, n_shingles, digest, signature``; the last two are null for an empty set."""
    factors = np.random.default_rng(5).integers(1, 1 << 63, size, dtype=np.uint64) * 2 + 1

    def run(batches):
        shingle = Shingler(width)

        def out():
            for doc_id, text in arrow_rows(batches, "doc_id", "text"):
                s = shingle(text)
                if len(s):
                    yield (doc_id, len(s), xxhash.xxh3_128_digest(s.tobytes()), signature(s, factors).tobytes()), 4 * size
                else:
                    yield (doc_id, 0, None, None), 0
        yield from arrow_batches(out(), _SKETCH)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, digest binary, signature binary")


def least_matches(size: int, threshold: float, miss: float, batch: int = BATCH) -> dict[int, int]:
    """After n values, how many must be equal for the threshold to stay possible.

    The posterior probability of reaching it is P(Binomial(n + 1, threshold) <= m)."""
    out = {}
    for n in [*range(batch, size, batch), size]:
        total, m = 0.0, -1
        while total < miss:
            m += 1
            total += math.exp(math.lgamma(n + 2) - math.lgamma(m + 1) - math.lgamma(n + 2 - m)
                              + m * math.log(threshold) + (n + 1 - m) * math.log1p(-threshold))
        out[n] = m
    return out


def _pruned(size: int, threshold: float, miss: float):
    needed = least_matches(size, threshold, miss)

    def run(batches):
        for b in (part for whole in batches for part in slices(whole, 2048)):
            left, right = (np.frombuffer(b"".join(b.column(c).to_pylist()), "<u4").reshape(-1, size) for c in ("sa", "sb"))
            alive, equal, start = np.arange(len(left)), np.zeros(len(left), np.int64), 0
            for end, least in needed.items():
                equal[alive] += (left[alive, start:end] == right[alive, start:end]).sum(1)
                alive, start = alive[equal[alive] >= least], end
            yield pa.RecordBatch.from_arrays([b.column("a").take(pa.array(alive)), b.column("b").take(pa.array(alive))], ["a", "b"])
    return run


def _overlap(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _confirmed(percent: int):
    def run(batches):
        for b in batches:
            hold = [_overlap(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), percent) for x, y in arrow_rows([b], "sa", "sb")]
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(hold, pa.bool_()))
    return run


def _across(percent: int, size: int, miss: float):
    """Links between components within a block, or from one block to another."""
    needed = least_matches(size, percent / 100, miss)

    def run(key, table):
        i, j = key[1].as_py(), key[2].as_py()
        node, comp, block = (table[c].to_numpy() for c in ("node", "comp", "block"))
        values = np.frombuffer(b"".join(table["signature"].to_pylist()), "<u4").reshape(-1, size)
        sets = [np.frombuffer(x, "<u8") for x in table["shingles"].to_pylist()]
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        apart = comp[left][:, None] != comp[right][None, :]
        if i == j:
            apart &= node[left][:, None] < node[right][None, :]
        x, y = (side[at] for side, at in zip((left, right), np.nonzero(apart), strict=True))
        equal, start = np.zeros(len(x), np.int64), 0
        for end, least in needed.items():
            equal += (values[x, start:end] == values[y, start:end]).sum(1)
            stay = equal >= least
            x, y, equal, start = x[stay], y[stay], equal[stay], end
        root: dict[int, int] = {}

        def find(c):
            while c in root:
                c = root[c]
            return c

        links = []
        for at in np.argsort(-equal, kind="stable"):  # likely links first: they spare the rest
            u, v = x[at], y[at]
            a, b = find(comp[u]), find(comp[v])
            if a != b and _overlap(sets[u], sets[v], percent):
                root[b] = a
                links.append((node[u], node[v]))
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})
    return run


def only(rows: DataFrame, ids: DataFrame, column: str, how: str = "left_semi") -> DataFrame:
    """Rows whose ``column`` is (``left_anti``: isn't) in ``ids``; ids are broadcast if they are few."""
    few = ids.count() <= BROADCAST_IDS
    named = ids.toDF("__id")
    return rows.join(F.broadcast(named) if few else named, F.col(column) == F.col("__id"), how)


def _both(pairs: DataFrame, values: DataFrame) -> DataFrame:
    """Pairs ``a, b`` with the value of either; ``values``: node, value."""
    return pairs.join(values.toDF("a", "sa"), "a").join(values.toDF("b", "sb"), "b")


class _Verifier:
    """Tests pairs of class representatives; remembers those it has seen."""

    def __init__(self, docs: DataFrame, signatures: DataFrame, width: int, percent: int, size: int, miss: float):
        self.docs, self.signatures, self.width, self.percent = docs, signatures, width, percent
        self.prune, self.across = _pruned(size, percent / 100, miss), _across(percent, size, miss)
        self.tested: list[DataFrame] = []

    def sets(self, ids: DataFrame) -> DataFrame:
        width = self.width

        def run(batches):
            shingle = Shingler(width)

            def out():
                for doc_id, text in arrow_rows(batches, "doc_id", "text"):
                    s = shingle(text).astype("<u8")
                    yield (doc_id, xxhash.xxh3_128_digest(s.tobytes()), s.tobytes()), s.nbytes
            yield from arrow_batches(out(), _SET)

        rows = only(self.docs, ids, "doc_id").mapInArrow(run, "doc_id long, digest binary, shingles binary")
        return rows.groupBy("doc_id").agg(F.min_by("shingles", "digest").alias("shingles"))

    def links(self, pairs: DataFrame) -> DataFrame | None:
        pairs = pairs.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
        if self.tested:
            pairs = pairs.join(reduce(DataFrame.unionAll, self.tested), ["a", "b"], "left_anti")
        pairs = materialize(pairs)
        if pairs.isEmpty():
            return None
        self.tested.append(pairs)
        alive = materialize(_both(pairs, self.signatures).mapInArrow(self.prune, "a long, b long"))
        ids = materialize(alive.select("a").unionAll(alive.select("b")).distinct())
        if ids.isEmpty():
            return None
        return materialize(_both(alive, materialize(self.sets(ids))).mapInArrow(_confirmed(self.percent), "a long, b long"))

    def block_links(self, held: DataFrame) -> DataFrame | None:
        """Links between components among rows ``key, node, comp`` that share a key.

        Keys with the same least member are one group, which has that member's
        keys at most, so a group's size is bounded by its buckets' and never
        chains from one bucket to the next. The many buckets that a set of
        near-copies shares have few least members, so a pair is compared a few
        times at most, not once for each bucket."""
        lead = held.groupBy("key").agg(F.min("node").alias("group"))
        members = materialize(held.join(lead, "key").select("group", "node", "comp").distinct())
        if members.isEmpty():
            return None
        blocks = members.groupBy("group").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
        dealt = members.join(blocks, "group").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        dealt = dealt.withColumn("to", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        values = materialize(self.sets(members.select("node").distinct())).toDF("node", "shingles").join(self.signatures, "node")
        return materialize(
            dealt.select("group", F.least("block", "to").alias("i"), F.greatest("block", "to").alias("j"), "node", "comp", "block")
            .join(values, "node").groupBy("group", "i", "j").applyInArrow(self.across, "a long, b long"))


def near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS,
                    miss: float = MISS, leaders: int = 3) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Links documents whose sets overlap by ``percent`` of their union or more;
    ``component_id`` is the least id reachable and its document is kept."""
    docs = docs.select("doc_id", "text")
    size = bands * rows
    base = materialize(sketches(docs, shingle_words, size))
    classes = materialize(base.filter("n_shingles > 0 and doc_id is not null").groupBy("digest")
                          .agg(F.min("doc_id").alias("node"), F.first("signature").alias("signature")))
    bands_of = F.array(*[F.xxhash64(F.lit(i), F.substring("signature", 4 * rows * i + 1, 4 * rows)) for i in range(bands)])
    keys = classes.select(F.explode(bands_of).alias("key"), "node")
    buckets = keys.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.count("*").alias("members")).filter("lo < hi")
    shared = materialize(keys.join(buckets.select("key", "members"), "key"))
    verifier = _Verifier(docs, classes.select("node", "signature"), shingle_words, percent, size, miss)

    # members against their bucket's leaders
    leaders = [F.struct(F.min("node").alias("other")), *[
        F.struct(F.min_by("node", F.xxhash64("node", F.lit(turn))).alias("other")) for turn in range(1, leaders)]]
    lead = shared.groupBy("key").agg(F.array_distinct(F.array(*leaders)).alias("leaders"))
    pairs = shared.join(lead, "key").select("node", F.explode("leaders").alias("at")).select("node", "at.other").filter("node <> other")
    links = verifier.links(pairs)
    comp = materialize(components(links)) if links is not None else None

    # across what is still apart in a bucket of three or more; a pair alone was tested
    if comp is not None:
        held = shared.filter("members > 2").join(comp, "node", "left").select("key", "node", "members", F.coalesce("comp", "node").alias("comp"))
    else:
        held = shared.filter("members > 2").withColumn("comp", F.col("node"))
    apart = held.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi")
    held = materialize(held.join(apart.select("key"), "key", "left_semi"))
    few = held.filter(F.col("members") <= PAIRED)
    other = few.select("key", F.col("node").alias("other"), F.col("comp").alias("other_comp"))
    pairs = few.join(other, "key").filter("node < other and comp <> other_comp")
    found = [x for x in (verifier.links(pairs), verifier.block_links(held.filter(F.col("members") > PAIRED))) if x is not None]
    if found:
        known = found if comp is None else [*found, comp.select(F.col("node").alias("a"), F.col("comp").alias("b"))]
        comp = materialize(components(reduce(DataFrame.unionAll, known)))

    named = classes.select("digest", "node")
    if comp is not None:
        named = named.join(comp, "node", "left").select("digest", F.coalesce("comp", "node").alias("component_id"))
    else:
        named = named.select("digest", F.col("node").alias("component_id"))
    whole = F.col("n_shingles").eqNullSafe(0) | F.col("doc_id").isNull()
    slim = base.select("doc_id", "n_shingles", "digest")
    out = slim.filter(~whole).join(named, "digest").select("doc_id", "n_shingles", "component_id").unionAll(
        slim.filter(whole).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicated(docs: DataFrame, **how) -> DataFrame:
    """One document of each component, columns as they came.

    Of rows that repeat an id, one is left; rows without an id all stay."""
    marked = materialize(near_duplicates(docs, **how))
    gone = materialize(marked.filter("not kept").select("doc_id").distinct())
    rest = only(docs, gone, "doc_id", "left_anti")
    twice = materialize(marked.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"))
    if twice.isEmpty():
        return rest
    one = only(rest, twice, "doc_id").withColumn("__row", F.struct(*docs.columns)).groupBy("doc_id").agg(F.min("__row").alias("__row"))
    return only(rest, twice, "doc_id", "left_anti").unionAll(one.select("__row.*"))
