"""Source divergence audit: how the terms of a language's sources differ.

Every group (a language's source) gives each kept term a whole-number share
``p``; the divergence of two shares is ``floor((p - q)^2 / (p + q))``. Sources
of a language are compared over all kept terms, and each source's terms with
those of its whole language.

**Quadtree.** The matrix of groups and terms is mostly zero. It is cut into
tiles of ``ROWS`` groups by some ``COLUMNS`` terms, and a pair of row blocks and
a column block is one group of rows in Spark. There the tile's nonzero leaves
(``LEAF_ROWS`` by ``LEAF_COLUMNS`` cells, columns sorted so that terms of the same
groups lie together) are the bottom of a quadtree whose levels say which
quadrants hold anything. Two blocks of groups are traversed jointly from the
root: where a quadrant is zero in both, all its terms have the divergence of
the two groups' shares of absent terms, so the quadrant costs a
multiplication; only leaves that are nonzero in one of them are evaluated. A
tile without any cell is priced so as a whole.

Shares are computed as decimals and divergences as 64-bit integers, so results
are exact; sums don't depend on order. Texts are counted where they are read,
so a source, language or term that holds a third of all rows leaves a task as
one row a term and flush. Output is every pair of sources of a language, as
asked for; tiles bound what a task holds, and their partial sums are fewer
rows than the cells that were compared. Nothing is collected on the driver;
the tables of languages and groups are broadcast only after their rows were
counted, beyond the bound Spark joins them as any others.

Defined results: null text, language and source are ''. A group without terms
takes part, and a language without kept terms has pairs of value 0 and no
terms. A text counts once in a term's documents however often it has it;
repeated rows are documents of their own, ids are not read. An empty table
gives an empty one; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veracity.llm.base import arrow_batches, slices
from veracity.operators.features import broadcast_within
from veracity.session import materialize

MIN_DOCUMENTS, TOP = 10, 10
UNIT = 1_000_000_000
#: Groups and (on average) terms of a tile, cells of a leaf.
ROWS, COLUMNS, LEAF_ROWS, LEAF_COLUMNS = 256, 4096, 4, 64
#: Bytes of counts that a task holds before it passes them on; what a term and a group take beside their letters.
HELD, TERM_BYTES, GROUP_BYTES = 200_000_000, 250, 1000

#: Bytes that end a term become spaces, A-Z become lower case; all others, with those of other scripts, stay.
_TABLE = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256)).lower()
_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])
_SUMS = pa.schema([("lang", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("value", pa.int64())])
#: Bytes of a text that are split at once.
PIECE = 1 << 20


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """Terms of a text, in lists: a long text is split piece by piece."""
    at = 0
    while at < len(text):
        stop = at + PIECE
        piece = text[at:stop].translate(_TABLE)
        while stop < len(text) and not piece.endswith(b" "):  # a term that goes on: up to its end
            more = text[stop:stop + PIECE].translate(_TABLE)
            end = more.find(b" ") + 1 or len(more)
            piece, stop = piece + more[:end], stop + end
        yield piece.split(b" ")
        at = stop


def _counted(batches):
    """Partial counts of a task: a row for each term of a group, ``docs`` of them documents; term null for the group itself.

    Terms and groups are held by their bytes, so long terms or a source for each text are passed on sooner."""
    held: dict[tuple[bytes, bytes], tuple[Counter, Counter]] = {}

    def flush():
        for (lang, source), (n, docs) in held.items():
            names, size = (lang.decode(), source.decode()), 60 + len(lang) + len(source)
            yield (*names, None, 0, 0), size
            for term, count in n.items():
                if term:
                    yield (*names, term.decode(), count, docs[term]), size + len(term)
        held.clear()

    def rows():
        size = 0
        for b in batches:
            for part in slices(b):
                columns = [c.cast(pa.binary()).fill_null(b"").to_pylist() for c in (part.column("lang"), part.column("source"), part.column("text"))]
                for lang, source, text in zip(*columns, strict=True):
                    group = lang, source
                    if group not in held:
                        held[group] = Counter(), Counter()
                        size += GROUP_BYTES + len(lang) + len(source)
                    n, docs = held[group]
                    before, own = len(n), set()
                    for terms in terms_of(text):
                        n.update(terms)
                        own.update(terms)
                    size += TERM_BYTES * (len(n) - before) + sum(map(len, filterfalse(docs.__contains__, own)))
                    docs.update(own)
                    if size > HELD:
                        yield from flush()
                        size = 0
        yield from flush()

    yield from arrow_batches(rows(), _COUNTS)


def counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences and documents; one row with a null term for each group."""
    found = docs.select("lang", "source", "text").mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    found = found.repartition("lang", "source", "term")  # tasks have added up already: no second partial sum before the exchange
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count, total, kept):
    """1 + floor(UNIT * (count + 2) / (total + 2 * kept)), whatever the counts; null without kept terms."""
    whole = f"(CAST({UNIT} AS DECIMAL(10,0)) * CAST({count} + 2 AS DECIMAL(20,0))) DIV CAST(nullif({total} + 2 * {kept}, 0) AS DECIMAL(20,0))"
    return F.expr(f"1 + {whole}")


def _divergence(p, q):
    return (p - q) * (p - q) // (p + q)


def occupied(leaves: np.ndarray) -> list[np.ndarray]:
    """Levels of the quadtree over the leaves that hold something, from the leaves to the root."""
    side = max(leaves.shape, default=1)
    side = 1 << max(side - 1, 0).bit_length()
    level = np.zeros((side, side), bool)
    level[:leaves.shape[0], :leaves.shape[1]] = leaves
    out = [level]
    while len(level) > 1:
        level = level.reshape(len(level) // 2, 2, -1, 2).any((1, 3))
        out.append(level)
    return out


def traversed(levels: list[np.ndarray]) -> Iterator[tuple[int, int, int]]:
    """Pairs of row leaves and a column leaf, at least one of the two nonzero, by joint descent from the root."""
    todo = [(len(levels) - 1, 0, 0, 0)]
    while todo:
        depth, i, j, column = todo.pop()
        if not (levels[depth][i, column] or levels[depth][j, column]):
            continue  # zero in both: priced from the absent terms' shares
        if depth == 0:
            yield i, j, column
            continue
        for c in (2 * column, 2 * column + 1):
            todo += [(depth - 1, x, y, c) for x in (2 * i, 2 * i + 1) for y in (2 * j, 2 * j + 1) if i != j or x <= y]


def tile(shares: np.ndarray, absent: np.ndarray, present: np.ndarray, columns: int) -> np.ndarray:
    """Sum of divergences over ``columns`` terms for every pair of rows.

    ``shares`` holds the columns in which some row is present; all others are zero quadrants."""
    rows = len(absent)
    order = np.lexsort(present) if present.size else np.zeros(0, np.int64)
    shares, present = shares[:, order], present[:, order]
    high, wide = -(-rows // LEAF_ROWS), -(-shares.shape[1] // LEAF_COLUMNS)
    padded = np.zeros((high * LEAF_ROWS, wide * LEAF_COLUMNS), bool)
    padded[:rows, :shares.shape[1]] = present
    total = np.zeros((rows, rows), np.int64)
    priced = np.full((rows, rows), columns, np.int64)
    leaves = padded.reshape(high, LEAF_ROWS, wide, LEAF_COLUMNS).any((1, 3))
    for i, j, c in traversed(occupied(leaves)) if wide else ():
        x, y = (slice(k * LEAF_ROWS, (k + 1) * LEAF_ROWS) for k in (i, j))
        z = slice(c * LEAF_COLUMNS, (c + 1) * LEAF_COLUMNS)
        if i >= high or j >= high:
            continue
        p, q = shares[x, z], shares[y, z]
        total[x, y] += _divergence(p[:, None, :], q[None, :, :]).sum(2)
        priced[x, y] -= p.shape[1]
    total += priced * _divergence(absent[:, None], absent[None, :])
    lower = np.tril_indices(rows, -1)
    total[lower] = total.T[lower]  # leaves below the diagonal were not visited
    return total


def _tiles(key, table):
    lang, first, second, _ = (k.as_py() for k in key)
    row, column, share = (table[c].to_numpy() for c in ("row", "column", "share"))
    heads = column < 0  # the groups themselves, with the share of an absent term; -column - 1 terms are in the block
    names, at = np.unique(row[heads], return_index=True)
    absent, columns = share[heads][at], int(-column[heads][0] - 1)
    used, place = np.unique(column[~heads], return_inverse=True)
    at = np.searchsorted(names, row[~heads])
    shares = np.repeat(absent[:, None], len(used), 1)
    shares[at, place] = share[~heads]
    present = np.zeros(shares.shape, bool)
    present[at, place] = True
    total = tile(shares, absent, present, columns) if columns else np.zeros((len(names), len(names)), np.int64)
    block = names // ROWS
    i, j = np.nonzero((block[:, None] == first) & (block[None, :] == second) & (names[:, None] < names[None, :]))
    return pa.Table.from_arrays([pa.array([lang] * len(i), pa.string()), pa.array(names[i], pa.int32()), pa.array(names[j], pa.int32()), pa.array(total[i, j])], schema=_SUMS)


def audit(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank``: divergences from the language's other sources, and the ``top`` terms that exceed the language's share."""
    found = materialize(counts(docs))
    cells = found.filter("term is not null")
    kept = cells.groupBy("lang", "term").agg(F.sum("n").alias("whole"), F.sum("docs").alias("docs")).filter(F.col("docs") >= min_documents).drop("docs")
    kept = materialize(kept)
    langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("whole").alias("words"))
    langs = broadcast_within(materialize(langs.withColumn("blocks", F.ceil(F.col("kept") / COLUMNS).cast("int"))))
    placed = kept.join(langs.select("lang", "blocks"), "lang").withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int")).drop("blocks")
    placed = placed.withColumn("column", F.row_number().over(Window.partitionBy("lang", "block").orderBy("term")) - 1)
    # the language's total is one row a term, a cell one a source and term
    cells = materialize(cells.drop("docs").join(placed, ["lang", "term"]))
    sizes = placed.groupBy("lang", "block").agg(F.count("*").cast("int").alias("columns"))

    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = found.filter("term is null").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("kept", F.lit(0)).alias("kept"), F.coalesce("words", F.lit(0)).alias("words"),
                           F.coalesce("blocks", F.lit(0)).alias("blocks"))
    # groups of a language are as few as the square root of the pairs asked for
    groups = groups.withColumn("row", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    groups = materialize(groups.withColumn("absent", F.coalesce(_share("0", "total", "kept"), F.lit(0))).withColumn("row_blocks", F.floor((F.max("row").over(Window.partitionBy("lang")) / ROWS)).cast("int")))

    groups = broadcast_within(groups)
    shares = materialize(cells.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "block", "column", "row", "row_blocks", _share("n", "total", "kept").alias("share"), _share("whole", "words", "kept").alias("expected")))

    heads = groups.withColumn("block", F.explode(F.sequence(F.lit(0), F.greatest(F.col("blocks") - 1, F.lit(0))))).join(sizes, ["lang", "block"], "left")
    heads = heads.select("lang", "block", "row", (-F.coalesce("columns", F.lit(0)) - 1).alias("column"), F.col("absent").alias("share"), "row_blocks")
    entries = shares.select("lang", "block", "row", "column", "share", "row_blocks").unionByName(heads)
    own = F.floor(F.col("row") / ROWS).cast("int")
    entries = entries.withColumn("__own", own).withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("row_blocks"))))
    entries = entries.select("lang", F.least("__own", "__other").alias("first"), F.greatest("__own", "__other").alias("second"), "block", "row", "column", "share")
    sums = entries.groupBy("lang", "first", "second", "block").applyInArrow(_tiles, "lang string, a int, b int, value long")
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = sums.select("lang", F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("at"), "value").select("lang", "at.*", "value")
    pairs = both.join(groups.select("lang", F.col("row").alias("a"), "source"), ["lang", "a"]).join(
        groups.select("lang", F.col("row").alias("b"), F.col("source").alias("item")), ["lang", "b"]).select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    over = shares.filter("share > expected").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr(
        "((share - expected) * (share - expected)) DIV (share + expected)").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    leading = over.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(leading)
