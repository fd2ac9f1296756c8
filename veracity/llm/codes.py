"""Vector code compression: product codes, nearest entries by equal-average search.

Components become integers, vectors are cut into equal parts, and each part is
replaced by the index of the nearest entry of that part's codebook. Codebooks
start as the parts of the vectors of the smallest ids and move for a fixed
number of rounds to the floored means of the parts assigned to them.

**Equal-average search.** By Cauchy and Schwarz the squared distance of two
parts is at least the squared gap of their component sums over the dimension.
Entries are sorted by component sum; from the place of a part's own sum the
search goes outward on both sides, and a side ends where that bound is
strictly greater than the best distance yet. Entries beyond are farther, so
the result is that of comparing all entries; an entry at the best distance is
never skipped, so ties go to the lower index. All parts of a batch walk
together, ``STEP`` entries a side and turn; those that have ended leave.

Each round is one pass: tasks look entries up and add parts up by entry, and
what leaves a task are at most ``parts * ENTRIES`` partial sums. The driver
holds codebooks and their new sums only (``parts * ENTRIES`` entries whatever
the table's size); all arithmetic is on integers, so the order of rows and
tasks doesn't matter. Integer vectors are checkpointed once. The sum of a
label is aggregated before it meets the rows, so a label that holds a third
of them is one row a task there.

Defined results: rows whose vector is null, empty, or holds a null or
non-finite component are left out; so are those with components so large that
an error may not fit a long (262,144 or more in 64 dimensions), and those of
another length than the kept row of the least id, or of one that can't be cut
into equal parts. Ids order ascending, null ids last, and rows of one id by their
components; every row is coded, repeated ones too. Fewer rows than
``ENTRIES`` make fewer entries. An empty table gives an empty one; other
columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracity.session import materialize

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
STEP, ROWS = 8, 2048

_CODED = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("code", pa.string()), ("error", pa.int64())])
_SUMS = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])


def nearest(parts: np.ndarray, entries: np.ndarray, step: int = STEP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the nearest entry, its squared distance, and how many entries were compared, for each row of ``parts``."""
    dim, sums = parts.shape[1], entries.sum(1)
    order = np.argsort(sums, kind="stable")
    ranked, sums, n = entries[order], sums[order], len(order)
    own = parts.sum(1)
    best = np.full(len(parts), np.iinfo(np.int64).max)
    index, compared = np.full(len(parts), n), np.zeros(len(parts), np.int64)
    start = np.searchsorted(sums, own)
    for side in (1, -1):
        # the upper side takes entries start, start + 1, ..., the lower start - 1, start - 2, ...
        rows, at = np.arange(len(parts)), start if side == 1 else start - 1
        while len(rows):
            inside = (at >= 0) & (at < n)
            rows, at = rows[inside], at[inside]
            # in doubles, rounded so that a side may go on but never ends where the bound isn't exceeded
            near = np.abs(own[rows] - sums[at]) <= np.sqrt(best[rows].astype(float) * dim) * (1 + 1e-12)
            rows, at = rows[near], at[near]
            if not len(rows):
                break
            places = at[:, None] + side * np.arange(step)
            valid = (places >= 0) & (places < n)
            places = np.clip(places, 0, n - 1)
            away = parts[rows][:, None, :] - ranked[places]
            distance = np.einsum("ijk,ijk->ij", away, away)
            distance[~valid] = np.iinfo(np.int64).max
            compared[rows] += valid.sum(1)
            least = distance.min(1)
            which = np.where(distance == least[:, None], order[places], n).min(1)
            better = (least < best[rows]) | ((least == best[rows]) & (which < index[rows]))
            best[rows[better]], index[rows[better]] = least[better], which[better]
            at = at + side * step
    return index, best, compared


def _parts(column: pa.Array, parts: int):
    """``rows x parts x dimension`` integers of an Arrow column of equally long lists, some rows at a time."""
    for at in range(0, len(column), ROWS):
        some = column.slice(at, ROWS)
        yield at, some.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(some), parts, -1)


def _summed(books: np.ndarray):
    def run(batches):
        sums, n = np.zeros_like(books), np.zeros(books.shape[:2], np.int64)
        for b in batches:
            for _, cells in _parts(b.column("ints"), len(books)):
                for part, entries in enumerate(books):
                    index = nearest(cells[:, part], entries)[0]
                    np.add.at(sums[part], index, cells[:, part])
                    n[part] += np.bincount(index, minlength=len(entries))
        part, entry = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(n[part, entry]),
                                          pa.array(list(sums[part, entry]), pa.list_(pa.int64()))], schema=_SUMS)
    return run


def _coded(books: np.ndarray):
    def run(batches):
        for b in batches:
            for at, cells in _parts(b.column("ints"), len(books)):
                found = [nearest(cells[:, part], entries)[:2] for part, entries in enumerate(books)]
                codes = ["".join(f"{i:02x}" for i in row) for row in np.stack([f[0] for f in found], 1).tolist()]
                rows = b.slice(at, len(cells))
                yield pa.RecordBatch.from_arrays([rows.column("vec_id"), rows.column("label"), pa.array(codes), pa.array(sum(f[1] for f in found))], schema=_CODED)
    return run


def integers(vectors: DataFrame, scale: int = SCALE, parts: int = PARTS) -> DataFrame:
    """``vec_id, label, ints`` of the rows that can be coded."""
    size = F.size("embedding")
    largest = F.sqrt(F.lit(2.0 ** 62) / size) / (2 * scale)  # size * (2 * largest * scale) ** 2 fits a long
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < largest))
    ints = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("int"))
    return vectors.filter(F.col("embedding").isNotNull() & (size > 0) & (size % parts == 0) & F.coalesce(fine, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), ints.alias("ints"))


def trained(ints: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks, ``parts x entries x dimension``; None for an empty table."""
    first = ints.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).collect()
    if not first:
        return None
    width = len(first[0].ints)
    rows = [r.ints for r in first if len(r.ints) == width]
    if len(rows) < len(first):  # another length among the least ids: take as many of the right one
        rows = [r.ints for r in ints.filter(F.size("ints") == width).orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).collect()]
    books = np.array(rows, np.int64).reshape(len(rows), parts, -1).transpose(1, 0, 2).copy()
    usable = ints.filter(F.size("ints") == width).select("ints")
    for _ in range(rounds):
        found = usable.mapInArrow(_summed(books), "part int, entry int, n long, sums array<long>")
        totals = found.groupBy("part", "entry").agg(
            F.sum("n").alias("n"), *(F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(books.shape[2])))
        for r in totals.collect():  # one row an entry
            books[r.part, r.entry] = [s // r.n for s in r[3:]]
    return books


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compressed(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` for every row of ``vectors`` (``vec_id, embedding, label``) that can be coded."""
    ints = materialize(integers(vectors, parts=parts))
    books = trained(ints, parts, entries, rounds)
    if books is None:
        return ints.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"),
                           F.lit("").alias("codebooks_sha256"))
    usable = ints.filter(F.size("ints") == books.shape[0] * books.shape[2])
    coded = materialize(usable.mapInArrow(_coded(books), "vec_id long, label long, code string, error long"))
    labels = materialize(coded.groupBy(F.col("label").alias("__label")).agg(F.sum("error").alias("label_error")))
    return coded.join(labels, F.col("label").eqNullSafe(F.col("__label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
