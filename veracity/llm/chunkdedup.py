"""Substring dedup by content-defined chunks: every run of ``MIN_WORDS`` words that stands in two documents.

**Chunks.** Words get random values, and a gear rolling hash (shift and add)
runs over them; its shift leaves the last ``WINDOW`` words in it. Of every
``REACH + 1`` neighbouring places the one of the greatest hash ends a chunk,
the last of equal ones. So chunks have 1 to ``REACH + 1`` words, ends are
defined in texts that repeat a word or a few as well, and after an insertion
the same words are cut the same way again a few words on. A chunk's digest
covers the chunk and the ``CONTEXT`` words before it.

**Seeds.** Chunks are deduplicated by digest. Whether and where a chunk ends
depends on ``WINDOW - 1 + REACH`` words before it and ``REACH`` words behind,
so inside any ``MIN_WORDS`` words some chunks are whole and certain whatever
stands around; the one of the greatest digest, the last of equal ones, is the
seed of that place. Where the same words stand in another document, so does
the same chunk: no shared run is without a shared seed. A chunk serves
neighbouring places, about eight, and is one row with them.

Places whose chunk no other document has are no repeats. Where all places of a
chunk have the same words, from the first served to the last, these are. What
is left are the edges of passages, where texts part: there each run of
``MIN_WORDS`` words is compared by digest itself, once for all places whose
words agree. So results are exact but for digests of 64 bits that agree by
chance. A passage in a third of all documents is one row after aggregation;
that table is stored before rows are joined with it, so the join's sides come
straight from exchanges and adaptive execution can split a hot chunk's.

Shared chunks are marked in a bitmap of ``BITS`` bits, whatever their number.
When texts are chunked the second time only places whose chunk is marked leave
the task; marks that agree by chance are removed by the join. With more chunks
the bitmap lets more through, which costs time and no result.

Spans are runs of places that follow each other by one word: maximal, except
that parts may stand in different documents. Spans that lie apart by more may
overlap in words.

Defined results: a null or empty text, or a null id, has no spans. Places of
one id count as one document, so rows that repeat an id don't repeat each
other. An empty table gives an empty one; other columns are not read, and
:func:`without_repeats` gives back those that came.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veracity.llm.base import WORD_RE, arrow_rows
from veracity.session import materialize

MIN_WORDS, WINDOW, REACH, CONTEXT = 24, 4, 2, 6
BITS = 1 << 27
#: Rows of a batch that leaves a task, words of texts that are chunked together, words whose values a task keeps.
ROWS, TOGETHER, WORDS_HELD = 1 << 16, 1 << 15, 1 << 18
_PICKS = pa.schema([("doc_id", pa.int64()), ("word", pa.int32()), ("places", pa.int32()), ("chunk", pa.int64()), ("whole", pa.int64())])
_EDGES = pa.schema([("lo", pa.int64()), ("whole", pa.int64()), ("step", pa.int32()), ("digest", pa.int64()), ("hi", pa.int64())])


class _Gear(dict):
    """A random value for each word, those seen lately at hand."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_HELD:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word, 9)
        return value

    def values(self, text: bytes | None) -> np.ndarray:
        words = (text or b"").split()  # at space and U+0009..U+000D
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def _stirred(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(31))


BASE = 0x9E3779B97F4A7C15
BACK = pow(BASE, -1, 1 << 64)


class Runs:
    """Digests of runs of a text's values: differences of one running sum of the values times powers of an odd base."""

    _powers = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def __init__(self, values: np.ndarray):
        if len(values) >= len(self._powers[0]):
            size = 2 * len(values) + 1
            Runs._powers = tuple(np.concatenate([np.ones(1, np.uint64), np.full(size, b, np.uint64)]).cumprod(dtype=np.uint64) for b in (BASE, BACK))
        self._sums = np.concatenate([np.zeros(1, np.uint64), (values * self._powers[0][:len(values)]).cumsum(dtype=np.uint64)])

    def digest(self, first: np.ndarray, size) -> np.ndarray:
        """Digests of the runs of ``size`` values from ``first`` on; other sizes are other digests."""
        raw = (self._sums[first + size] - self._sums[first]) * self._powers[1][first]
        return _stirred(raw + np.asarray(size).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def picked(hashes: np.ndarray, width: int) -> np.ndarray:
    """For every ``width`` neighbours, the place of the greatest, the last of equal ones; by doubling."""
    if len(hashes) < width:
        return np.zeros(0, np.int64)
    best, at, have = hashes, np.arange(len(hashes)), 1
    while have < width:
        step = min(have, width - have)
        later = best[step:] >= best[:-step]
        best, at = np.where(later, best[step:], best[:-step]), np.where(later, at[step:], at[:-step])
        have += step
    return at


def _each(at: np.ndarray) -> np.ndarray:
    """The values of a rising array once."""
    return at[np.append(True, at[1:] != at[:-1])] if len(at) else at


def gear(values: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The rolling hash at each word, h = (h << shift) + value; the shift drives a word out after ``window`` steps.

    The hash of a place whose window isn't full is that of the words that are there."""
    shift, out = np.uint64(64 // window), values.copy()
    for back in range(1, min(window, len(values))):
        out[back:] += values[:-back] << np.uint64(back * int(shift))
    return out


def ends(values: np.ndarray, window: int = WINDOW, reach: int = REACH) -> np.ndarray:
    """Places of the last words of chunks."""
    return _each(picked(gear(values, window), reach + 1))


def chunks(values: np.ndarray, runs: Runs, window: int = WINDOW, reach: int = REACH, context: int = CONTEXT) -> tuple[np.ndarray, np.ndarray]:
    """Last words and digests of the chunks that begin ``context`` words or more from the text's start."""
    last = ends(values, window, reach)
    before, last = last[:-1], last[1:]
    far = before >= context - 1
    before, last = before[far], last[far]
    # of the context, then of the chunk, whose size tells them apart
    return last, np.maximum(runs.digest(before - context + 1, last - before + context), np.uint64(1))


def seeds(values: np.ndarray, runs: Runs, min_words: int = MIN_WORDS, window: int = WINDOW, reach: int = REACH, context: int = CONTEXT) -> tuple[np.ndarray, np.ndarray]:
    """For every ``min_words`` words, the last word of its seed, and the seeds' digests by place.

    From ``first`` words on an end is certain; a chunk has at most ``reach + 1`` words, so one that ends so
    much later began at a certain end."""
    last, digest = chunks(values, runs, window, reach, context)
    at = np.zeros(len(values), np.uint64)
    at[last] = digest
    first = max(window - 1 + reach, context - 1) + reach + 1
    width = min_words - reach - first
    if width < reach + 1:
        raise ValueError("so few words may hold no whole chunk")
    places = max(len(values) - min_words + 1, 0)
    return picked(at[first:], width)[:places] + first, at


def _marked(digest: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Whether digests are marked in a bitmap of bytes."""
    at = digest >> np.uint64(64 - (len(marks) * 8 - 1).bit_length())
    return (marks[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _batches(parts, schema: pa.Schema):
    """Record batches of about ``ROWS`` rows from ``(doc_id or doc_ids, column, ...)``."""
    held, rows = [], 0

    def batch():
        columns = [np.concatenate([np.full(len(x[1]), x[0], np.int64) for x in held]), *(np.concatenate(c) for c in list(zip(*held, strict=True))[1:])]
        return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    for part in parts:
        held.append(part)
        rows += len(part[1])
        if rows >= ROWS:
            yield batch()
            held, rows = [], 0
    if rows:
        yield batch()
    pa.default_memory_pool().release_unused()  # a worker lives on with the next task


def picks(docs: DataFrame, min_words: int = MIN_WORDS, marks=None) -> DataFrame:
    """``doc_id, word, places, chunk, whole``: first place that a chunk serves, number of places, the
    chunk's digest, and the digest of all words of these places. With ``marks``, a broadcast bitmap,
    only of chunks that are marked in it."""
    def run(batches):
        held = _Gear()
        bitmap = None if marks is None else np.frombuffer(marks.value, np.uint8)

        def together(ids, texts):
            # what stands around a run of words doesn't change its seed, so texts follow each other; runs over their ends are left out
            values, sizes = np.concatenate(texts), np.array([len(t) for t in texts])
            start = np.cumsum(sizes) - sizes
            runs = Runs(values)
            at, digest = seeds(values, runs, min_words)
            doc = np.repeat(np.arange(len(texts)), sizes)[:len(at)]
            inside = np.flatnonzero(np.arange(len(at)) + min_words <= (start + sizes)[doc])
            at, doc = at[inside], doc[inside]
            new = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])))
            first, places, chunk, doc = inside[new], np.diff(np.append(new, len(at))), digest[at[new]], doc[new]
            if bitmap is not None:
                some = _marked(chunk, bitmap)
                first, places, chunk, doc = first[some], places[some], chunk[some], doc[some]
            return np.array(ids, np.int64)[doc], first - start[doc], places, chunk, runs.digest(first, places + (min_words - 1))

        def out():
            ids, texts, words = [], [], 0
            for doc_id, text in arrow_rows(batches, "doc_id", "text"):
                values = held.values(text) if doc_id is not None else ()
                if len(values) >= min_words:
                    ids.append(doc_id)
                    texts.append(values)
                    words += len(values)
                    if words >= TOGETHER:
                        yield together(ids, texts)
                        ids, texts, words = [], [], 0
            if ids:
                yield together(ids, texts)
        yield from _batches(out(), _PICKS)

    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(run, "doc_id long, word int, places int, chunk long, whole long")


def bitmap_of(shared: DataFrame, bits: int = BITS) -> bytes:
    """Marks the leading bits of ``chunk``: as many rows of some KB as ``bits`` make, added up on executors."""
    place = F.shiftrightunsigned("chunk", 64 - (bits - 1).bit_length())
    rows = shared.select(place.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("row")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("marks"))
    out = np.zeros(bits // 8 + 8192, np.uint8)
    for r in rows.collect():
        # buckets count from 1 and hold places 32768 (n - 1) + 1 to 32768 n; bucket 0 has place 0 alone
        part = np.unpackbits(np.frombuffer(r.marks, np.uint8), bitorder="little")
        out_at = np.flatnonzero(part) + (r.row - 1) * len(part) + (1 if r.row else len(part))
        np.bitwise_or.at(out, out_at >> 3, (1 << (out_at & 7)).astype(np.uint8))
    return out[:bits // 8].tobytes()


def _edges(min_words: int):
    def run(batches):
        held = _Gear()

        def out():
            for doc_id, text, *at in arrow_rows(batches, "doc_id", "text", "word", "places", "whole", "hi"):
                values = held.values(text)
                runs = Runs(values)
                word, places, whole, hi = (np.array(x, np.int64) for x in at)
                found = np.flatnonzero(word + places + min_words - 1 <= len(values))  # of rows of one id, those that have these words
                found = found[runs.digest(word[found], places[found] + (min_words - 1)).view(np.int64) == whole[found]]
                word, places, whole, hi = word[found], places[found], whole[found], hi[found]
                step = np.arange(places.max(initial=0))
                n, k = np.nonzero(step < places[:, None])
                yield doc_id, whole[n], step[k], runs.digest(word[n] + k, min_words), hi[n]
        yield from _batches(out(), _EDGES)
    return run


def _joined(pieces: DataFrame, name: str, *keys: str) -> DataFrame:
    """Numbers the runs of ``pieces`` (``word``, ``stop``) of the same keys that follow each other without a gap."""
    order = Window.partitionBy(*keys).orderBy("word", "stop")
    before = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return pieces.withColumn("__new", F.when(F.col("word") <= before, 0).otherwise(1)).withColumn(
        name, F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("__new")


def repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Spans of which each ``min_words`` words stand in another document too.

    ``doc_id, word, words`` (in words from the text's start), ``n_chunks`` (runs
    of ``min_words`` words in it), ``first_doc_id`` (the least id that has one of
    these) and ``cuts``: what a lower id has too, as (word, words)."""
    shared = picks(docs, min_words).groupBy("chunk").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), (F.min("whole") == F.max("whole")).alias("same"))
    shared = materialize(shared.filter("lo < hi").drop("hi"))
    marks = docs.sparkSession.sparkContext.broadcast(bitmap_of(shared))
    # texts are chunked twice, which takes less than to keep all chunks
    held = materialize(picks(docs, min_words, marks).join(shared, "chunk").select("doc_id", "word", "places", "whole", "lo", "same"))

    apart = held.filter("not same")
    kinds = apart.groupBy("whole").agg(F.min(F.struct("doc_id", "word", "places")).alias("at"), F.max("doc_id").alias("hi"))
    kinds = kinds.select("at.*", "whole", "hi").groupBy("doc_id").agg(F.collect_list(F.struct("word", "places", "whole", "hi")).alias("at"))
    texts = docs.select("doc_id", F.col("text").cast("binary")).join(kinds.select("doc_id", "at.word", "at.places", "at.whole", "at.hi").hint("shuffle_hash"), "doc_id")
    edges = materialize(texts.mapInArrow(_edges(min_words), "lo long, whole long, step int, digest long, hi long"))
    both = edges.groupBy("digest").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).filter("lo < hi").drop("hi")
    # stored as ``shared`` is: a hot passage's places can be split
    steps = materialize(edges.select("whole", "step", "digest").join(both, "digest").groupBy("whole").agg(F.collect_set(F.struct("step", "lo")).alias("steps")))
    edged = apart.drop("lo").join(steps, "whole").select("doc_id", "word", F.explode("steps").alias("at"))

    pieces = held.filter("same").select("doc_id", "word", (F.col("word") + F.col("places")).alias("stop"), "lo").unionAll(
        edged.select("doc_id", (F.col("word") + F.col("at.step")).alias("word"), (F.col("word") + F.col("at.step") + 1).alias("stop"), "at.lo"))
    runs = _joined(pieces, "__run", "doc_id").withColumn("__lower", F.col("lo") < F.col("doc_id"))
    parts = _joined(runs, "__part", "doc_id", "__lower").groupBy("doc_id", "__run", "__lower", "__part").agg(
        F.min("word").alias("word"), F.max("stop").alias("stop"), F.min("lo").alias("lo"))
    part = F.struct("word", (F.col("stop") - F.col("word") + (min_words - 1)).alias("words"))
    return (parts.groupBy("doc_id", "__run").agg(
        F.min("word").alias("word"), (F.max("stop") - F.min("word") + (min_words - 1)).alias("words"),
        (F.max("stop") - F.min("word")).cast("long").alias("n_chunks"), F.min("lo").alias("first_doc_id"),
        F.array_sort(F.collect_list(F.when(F.col("__lower"), part))).alias("cuts")).drop("__run"))


def cut_words(text: str | None, spans: list) -> str | None:
    """The text without the words of the spans ``(first, number)`` and what stands after each of them."""
    if not text or not spans:
        return text
    starts = [m.start() for m in WORD_RE.finditer(text)] + [len(text)]
    out, at = [], 0
    for first, number in sorted(spans):
        if first < len(starts) - 1:
            out.append(text[at:starts[first]])
            at = max(at, starts[min(first + number, len(starts) - 1)])
    return "".join([*out, text[at:]])


def without_repeats(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Documents without the ``cuts`` of ``spans``, columns as they came."""
    cut = F.udf(lambda t, s: cut_words(t, [(x["word"], x["words"]) for x in s or []]), "string", useArrow=True)
    gone = spans.filter(F.size("cuts") > 0).groupBy(F.col("doc_id").alias("__id")).agg(F.flatten(F.collect_list("cuts")).alias("__spans"))
    joined = docs.join(gone, F.col("doc_id") == F.col("__id"), "left")
    changed = joined.withColumn("text", F.when(F.col("__spans").isNotNull(), cut("text", "__spans")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.when(F.col("__spans").isNotNull(), F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return changed.select(*docs.columns)
