"""Feature engineering.

Tables are broadcast only after their rows were counted (:func:`broadcast_within`);
beyond the bound Spark joins them as any others. Token tables are never broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veracity.functions.common import hash32
from veracity.functions.text import whitespace_tokens, word_terms
from veracity.session import materialize

# --- fixed values that must equal the reference's -----------------------------
VOCAB_SIZE = 20000
MAX_LEN = 128
MONITOR_MAX_LEN = 100
PAD_ID = 0
UNK_ID = 1
TFIDF_MAX_FEATURES = 30000
SPLIT_SEED = 42
TEST_FRACTION = 0.2
VALID_FRACTION = 0.1
HASH_BUCKET_BITS = 16
# ------------------------------------------------------------------------------
#: Rows of a table of words, terms, classes or coefficients that may be broadcast: some 50 MB.
BROADCAST_ROWS = 500_000
#: Groups that are told apart by an expression.
FEW_GROUPS = 64
#: More than the positions of a text.
POSITIONS = 1 << 31


def broadcast_within(table: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``table``, marked for broadcast if it has at most ``rows`` rows. It is
    counted, so it should be one that is stored already."""
    return F.broadcast(table) if table.count() <= rows else table


# --- A7 / O3 / M5 ------------------------------------------------------------------
def token_positions(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, pos, word)`` for every whitespace token of every text (F8)."""
    return docs.select(id_col, F.posexplode(whitespace_tokens(text_col)).alias("pos", "word"))


def token_frequency(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Corpus count of each lower-cased whitespace token, with its first
    appearance ``(first_doc, first_pos)`` for stable tie-breaking; null ids
    are no appearance.

    Whole-number ids and positions are packed into one decimal, of which the
    least is kept in a hash aggregate: no sort of tokens, neither before the
    exchange nor after it. A struct, as for other ids, would be sorted."""
    t = token_positions(docs, id_col, text_col)
    if isinstance(docs.schema[id_col].dataType, T.IntegralType):
        place = F.col(id_col).cast("decimal(20,0)") * F.lit(POSITIONS).cast("decimal(10,0)") + F.col("pos").cast("decimal(10,0)")
        doc = F.floor(F.col("__first") / F.lit(POSITIONS).cast("decimal(10,0)"))
        return t.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("__first")).select(
            "word", "n", doc.cast(docs.schema[id_col].dataType).alias("first_doc"), F.expr(f"CAST(pmod(__first, {POSITIONS}BD) AS INT)").alias("first_pos"))
    first = F.min(F.struct(F.col(id_col).alias("d"), F.col("pos").alias("p")))
    return t.groupBy("word").agg(F.count(F.lit(1)).alias("n"), first.alias("__first")).select(
        "word", "n", F.col("__first.d").alias("first_doc"), F.col("__first.p").cast("int").alias("first_pos")
    )


def build_vocabulary(docs: DataFrame, id_col: str, text_col: str, max_words: int = VOCAB_SIZE) -> DataFrame:
    """M5: the ``max_words - 2`` most frequent tokens (ties by first
    appearance) with ids from 2; 0 = PAD and 1 = UNK are implicit.

    A global ``orderBy().limit(k)`` is a ``TakeOrderedAndProject``: each task
    keeps its own top k, so only ``k x tasks`` rows meet in the final task."""
    k = max_words - 2
    freq = token_frequency(docs, id_col, text_col)
    top = freq.orderBy(F.col("n").desc(), F.col("first_doc").asc(), F.col("first_pos").asc()).limit(k)
    w = Window.orderBy(F.col("n").desc(), F.col("first_doc").asc(), F.col("first_pos").asc())
    return top.select("word", (F.row_number().over(w) + 1).cast("int").alias("id"), "n")


def _pad(ids, max_len: int):
    n = F.size(ids)
    return F.concat(ids, F.array_repeat(F.lit(PAD_ID), F.greatest(F.lit(max_len) - n, F.lit(0))))


def encode_sequences(docs: DataFrame, vocab: DataFrame, id_col: str, text_col: str,
                     max_len: int = MAX_LEN) -> DataFrame:
    """J3 + F11: token ids (OOV -> 1), cut to ``max_len``, right-padded with 0.

    Only the first ``max_len`` tokens can survive truncation, so they are the
    only ones looked up."""
    words = broadcast_within(materialize(vocab.select("word", "id")))
    # by id first: a text is smaller than its tokens, which then needn't move
    toks = docs.select(id_col, text_col).repartition(id_col).select(id_col, F.slice(whitespace_tokens(text_col), 1, max_len).alias("toks"))
    ex = toks.select(id_col, F.posexplode_outer("toks").alias("pos", "word"))
    j = ex.join(words, on="word", how="left")
    j = j.withColumn("tok_id", F.when(F.col("pos").isNotNull(), F.coalesce(F.col("id"), F.lit(UNK_ID))))
    seq = j.groupBy(id_col).agg(
        F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "tok_id")))).alias("__p")
    )
    ids = F.transform(F.col("__p"), lambda s: s["tok_id"])
    return seq.select(id_col, _pad(ids, max_len).alias("ids"))


def encode_drop_oov(docs: DataFrame, vocab: DataFrame, id_col: str, text_col: str,
                    max_len: int = MONITOR_MAX_LEN) -> DataFrame:
    """like :func:`encode_sequences` but unknown words are dropped
    before post-truncation, so every token of the whole text is looked up."""
    words = broadcast_within(materialize(vocab.select("word", "id")))
    parted = docs.select(id_col, text_col).repartition(id_col)
    ex = parted.select(id_col, F.posexplode_outer(whitespace_tokens(text_col)).alias("pos", "word"))
    j = ex.join(words, on="word", how="left")
    seq = j.groupBy(id_col).agg(
        F.array_sort(F.collect_list(F.when(F.col("id").isNotNull(), F.struct("pos", "id")))).alias("__p")
    )
    ids = F.slice(F.transform(F.col("__p"), lambda s: s["id"]), 1, max_len)
    return seq.select(id_col, _pad(ids, max_len).alias("ids"))


# --- M1-M4: exact hash cuts -------------------------------------------------------
def _told(rows: DataFrame, table: DataFrame, on: Sequence[str], names: dict[str, str]) -> DataFrame:
    """``rows`` with the columns ``names`` (name: type) of ``table``, which has one row a group; null for groups without.

    Few groups are told apart by an expression, so no row is joined or moved;
    many meet in a join, null with null."""
    found = table.limit(FEW_GROUPS + 1).collect()
    if len(found) > FEW_GROUPS:
        named = broadcast_within(table).withColumnsRenamed({c: f"__on_{c}" for c in on})
        cond = F.lit(True)
        for c in on:
            cond = cond & F.col(c).eqNullSafe(F.col(f"__on_{c}"))
        return rows.join(named, cond, "left").drop(*[f"__on_{c}" for c in on])
    values = {}
    for name, kind in names.items():
        value = F.lit(None).cast(kind)
        for r in found:
            same = F.lit(True)
            for c in on:
                same = same & F.col(c).eqNullSafe(F.lit(r[c]))
            value = F.when(same, F.lit(r[name]).cast(kind)).otherwise(value)
        values[name] = value
    return rows.withColumns(values)


def _boundary(rows: DataFrame, place: "F.Column", quota: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """``group_cols, __at, __need``: the place at which a group's running count reaches its quota, and how
    many of the rows there are still wanted. Groups whose quota is 0 or not reached have no row."""
    counts = rows.groupBy(*group_cols, place.alias("__at")).agg(F.count(F.lit(1)).alias("__cnt"))
    w = Window.partitionBy(*group_cols).orderBy("__at").rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.withColumn("__cum", F.sum("__cnt").over(w))
    told = _told(counts, quota, group_cols, {"quota": "bigint"})
    before = F.col("__cum") - F.col("__cnt")
    return told.filter((F.col("__cum") >= F.col("quota")) & (before < F.col("quota"))).select(
        *group_cols, "__at", (F.col("quota") - before).alias("__need"))


def exact_rank_cut(df: DataFrame, h_col: str, id_col: str, quota: DataFrame,
                   group_cols: Sequence[str] = (), flag: str = "in_cut",
                   bucket_bits: int = HASH_BUCKET_BITS) -> DataFrame:
    """Flag, per group, the ``quota`` rows with the smallest ``(h, id)``.

    The last of them is found by refining histograms: rows are counted by the
    top ``bucket_bits`` of the hash, those of the bucket in which the quota is
    reached by the bits below, and those of the hash found there by id. Counts
    are made on a stored copy of group, hash and id, so ``df`` is read twice:
    for that copy, and for one comparison of each row with its group's cut.
    Nothing is sorted or numbered, and with few groups nothing is joined.
    Rows that agree in group, hash and id fall on the same side, so a quota
    that ends among such copies is exceeded by those. ``quota`` has
    ``group_cols`` + ``quota``, one row a group."""
    shift = 32 - bucket_bits
    keys = materialize(df.select(*group_cols, F.col(h_col).alias("__h"), F.col(id_col).alias("__id")))
    quota = materialize(quota.select(*group_cols, F.col("quota").cast("bigint").alias("quota")))
    whole = materialize(_told(keys.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("n")), quota, group_cols, {"quota": "bigint"}).filter("n <= quota").select(
        *group_cols, F.lit(True).alias("__whole")))

    top = materialize(_boundary(keys, F.shiftright("__h", shift), quota, group_cols))
    near = _told(keys, top, group_cols, {"__at": "bigint", "__need": "bigint"}).filter(F.shiftright("__h", shift) == F.col("__at"))
    exact = materialize(_boundary(near.select(*group_cols, "__h", "__id"), F.col("__h"), top.select(*group_cols, F.col("__need").alias("quota")), group_cols))
    tied = _told(keys, exact, group_cols, {"__at": "bigint", "__need": "bigint"}).filter(F.col("__h") == F.col("__at"))
    last = _boundary(tied.select(*group_cols, "__id"), F.col("__id"), exact.select(*group_cols, F.col("__need").alias("quota")), group_cols)
    last = materialize(last.select(*group_cols, F.col("__at").alias("__last")))

    kind = df.schema[id_col].dataType.simpleString()
    told = _told(_told(df, exact.select(*group_cols, F.col("__at").alias("__cut")), group_cols, {"__cut": "bigint"}), last, group_cols, {"__last": kind})
    told = _told(told, whole, group_cols, {"__whole": "boolean"})
    at_cut = (F.col(h_col) == F.col("__cut")) & ((F.col(id_col) <= F.col("__last")) | F.col(id_col).isNull())  # null ids come first
    inside = F.coalesce("__whole", F.lit(False)) | F.coalesce((F.col(h_col) < F.col("__cut")) | at_cut, F.lit(False))
    return told.withColumn(flag, inside).select(*df.columns, flag)


def stratified_split(df: DataFrame, id_col: str, label_col: str = "label", test_fraction: float = TEST_FRACTION,
                     seed: int = SPLIT_SEED) -> DataFrame:
    """M1: exact per-label split - ``ceil(test_fraction * n_label)`` rows of
    each label with the smallest ``(md5(seed:id), id)`` form the test side.

    Deterministic and independent of partitioning; adds ``split`` =
    'train' / 'test'."""
    h = df.withColumn("__h", hash32(id_col, str(seed)))
    quota = h.groupBy(label_col).agg(
        F.ceil(F.count(F.lit(1)) * F.lit(test_fraction)).cast("bigint").alias("quota"))
    cut = exact_rank_cut(h, "__h", id_col, quota, [label_col], flag="__test")
    return cut.withColumn("split", F.when(F.col("__test"), F.lit("test")).otherwise(F.lit("train"))) \
        .drop("__h", "__test")


def random_split(df: DataFrame, id_col: str, fraction: float = VALID_FRACTION, seed: int = SPLIT_SEED,
                 names: tuple[str, str] = ("train", "valid")) -> DataFrame:
    """M2: the same exact cut without a label key."""
    h = df.withColumn("__h", hash32(id_col, str(seed)))
    quota = h.agg(F.ceil(F.count(F.lit(1)) * F.lit(fraction)).cast("bigint").alias("quota"))
    cut = exact_rank_cut(h, "__h", id_col, quota, [], flag="__held")
    return cut.withColumn("split", F.when(F.col("__held"), F.lit(names[1])).otherwise(F.lit(names[0]))) \
        .drop("__h", "__held")


def oversample_minority(df: DataFrame, id_col: str, label_col: str = "label", minority: int = 0,
                        seed: int = SPLIT_SEED) -> DataFrame:
    """M3: repeat each minority row ``R // F`` times plus one extra copy for
    the ``R % F`` minority rows with the smallest hash. Adds ``replica``.
    Unchanged when the minority is empty or not smaller."""
    counts = {r[0]: r[1] for r in df.groupBy(label_col).count().collect()}  # one row per class
    f = counts.get(minority, 0)
    r = sum(v for k, v in counts.items() if k != minority)
    if f == 0 or f >= r:
        return df.withColumn("replica", F.lit(0))
    q, rem = r // f, r % f
    minor = df.filter(F.col(label_col) == minority).withColumn("__h", hash32(id_col, str(seed)))
    if rem:
        quota = minor.agg(F.lit(rem).cast("bigint").alias("quota"))
        minor = exact_rank_cut(minor, "__h", id_col, quota, [], flag="__extra")
    else:
        minor = minor.withColumn("__extra", F.lit(False))
    n_copies = F.lit(q) + F.col("__extra").cast("int")
    rep = minor.select(*df.columns, F.explode(F.sequence(F.lit(0), n_copies - 1)).alias("replica"))
    major = df.filter(~F.col(label_col).eqNullSafe(minority)).withColumn("replica", F.lit(0))
    return major.unionByName(rep)


def class_weights(df: DataFrame, label_col: str = "label") -> DataFrame:
    """M4: ``n / (n_classes * n_c)`` per class (``class_weight='balanced'``)."""
    c = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n_class"))
    w = Window.partitionBy()
    return c.select(
        label_col, "n_class",
        (F.sum("n_class").over(w) / (F.count(F.lit(1)).over(w) * F.col("n_class"))).alias("weight"),
    )


def with_class_weight(df: DataFrame, label_col: str = "label", weight_col: str = "weight") -> DataFrame:
    """M4 attached to every row."""
    cw = materialize(class_weights(df, label_col).select(label_col, F.col("weight").alias(weight_col)))
    return df.join(broadcast_within(cw), on=label_col, how="left")


# --- M6 TF-IDF ------------------------------------------------------------------------
#: Bytes of text that a task counts at once, but for a longer text: some 2.7 million words.
COUNTED_BYTES = 1 << 24
#: Texts of a task, so that the terms it sums up don't grow with the input.
TASK_TEXTS = 10_000
#: What splits words in Arrow (RE2) as ``word_terms`` splits them in Spark.
_NO_WORD = "[^\\p{L}\\p{N}_]+"
#: Characters that Arrow and Spark lower and tell apart alike, whatever stands beside them: none that Unicode got
#: after Java's version of it, none with a lower case of several characters or one that goes by the word.
_ALIKE = "\\x{0}-\\x{12F}\\x{131}-\\x{3A2}\\x{3A4}-\\x{86F}\\x{1E00}-\\x{2C2E}\\x{3000}-\\x{9FEF}\\x{AC00}-\\x{D7A3}\\x{1F300}-\\x{1F64F}"


def _by_row(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, text)``, dealt evenly to tasks. A text with characters beyond :data:`_ALIKE` comes as its words."""
    n = docs.sparkSession.sparkContext.defaultParallelism
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), n, -(-docs.select(id_col).count() // TASK_TEXTS))
    text = F.when(F.col(text_col).rlike(f"[^{_ALIKE}]"), F.array_join(word_terms(text_col), " ")).otherwise(F.col(text_col))
    return docs.select(id_col, text_col).repartition(parts, id_col).select(id_col, text.alias("text"))


def _words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """F9 in Arrow: words of some texts in order, with the text of each."""
    parts = pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(texts, "")), _NO_WORD)
    words = parts.flatten()
    long = pc.greater_equal(pc.utf8_length(words), 2)
    row = np.repeat(np.arange(len(texts)), pc.list_value_length(parts).to_numpy())
    return row[long.to_numpy(zero_copy_only=False)], words.filter(long)


def _once_and_repeated(docs: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame | None]:
    """Rows whose id no other row has, and those whose id several rows share, if there are any: a document
    is all rows of an id, null ids are one."""
    several = materialize(docs.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col(id_col).alias("__several")))
    if several.isEmpty():
        return docs, None
    several, same = broadcast_within(several), F.col(id_col).eqNullSafe(F.col("__several"))
    return docs.join(several, same, "left_anti"), docs.join(several, same, "left_semi")


class _Grams(NamedTuple):
    """Unigrams and bigrams of some rows: row and code of each; ``words`` are the different words. A unigram's
    code is its word's number, a bigram's follows those: ``len(words) * (1 + first) + second``."""

    row: np.ndarray
    code: np.ndarray
    words: pa.Array

    def terms(self, code: np.ndarray) -> pa.Array:
        n = max(len(self.words), 1)
        one = self.words.take(pa.array(code[code < n]))
        first, second = np.divmod(code[code >= n] - n, n)
        two = pc.binary_join_element_wise(self.words.take(pa.array(first)), self.words.take(pa.array(second)), " ")
        place = np.empty(len(code), np.int64)
        place[np.concatenate([np.flatnonzero(code < n), np.flatnonzero(code >= n)])] = np.arange(len(code))
        return pa.concat_arrays([one, two]).take(pa.array(place))


def _grams(batches, known: pa.Array | None = None):
    """``(ids, grams)`` of some rows at a time; with ``known``, words are numbered as there, others are -1."""
    for b in batches:
        ends, at = np.cumsum(pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)), 0
        while at < b.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + COUNTED_BYTES, "right")))
            row, found = _words(b.column(1).slice(at, to - at))
            found = found.dictionary_encode()
            number, words = found.indices.to_numpy().astype(np.int64), found.dictionary
            if known is not None:
                number, words = pc.fill_null(pc.index_in(words, known), -1).to_numpy(zero_copy_only=False).astype(np.int64)[number], known
            pair = (row[1:] == row[:-1]) & (number[1:] >= 0) & (number[:-1] >= 0)
            code = np.concatenate([number, (len(words) * (1 + number[:-1]) + number[1:])[pair]])
            row = np.concatenate([row, row[1:][pair]])
            yield b.column(0).slice(at, to - at), _Grams(row[code >= 0], code[code >= 0], words)
            at = to


def _row_counts(row: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, code and number of each different pair, by row."""
    if not len(code):
        return row, code, code
    width = int(code.max()) + 1
    if (int(row.max()) + 1) * width < 1 << 63:
        key, n = np.unique(row * width + code, return_counts=True)
        return key // width, key % width, n
    order = np.lexsort((code, row))
    row, code = row[order], code[order]
    first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (code[1:] != code[:-1])))
    return row[first], code[first], np.diff(np.append(first, len(row)))


def _counts_of_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, term, tf)`` for each row; rows of the same id are not added up."""
    schema = T.StructType([docs.schema[id_col], T.StructField("term", T.StringType()), T.StructField("tf", T.LongType())])

    def run(batches):
        for ids, grams in _grams(batches):
            row, code, n = _row_counts(grams.row, grams.code)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(row)), grams.terms(code), pa.array(n)], names=[id_col, "term", "tf"])
    return _by_row(docs, id_col, text_col).mapInArrow(run, schema)


def _term_sums(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(term, cf, df)`` of rows that are a document each, summed within a task's portions; a term comes several times."""
    def run(batches):
        for _, grams in _grams(batches):
            _, code, n = _row_counts(grams.row, grams.code)
            term, at, df = np.unique(code, return_inverse=True, return_counts=True)
            cf = np.bincount(at, n, len(term)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([grams.terms(term), pa.array(cf), pa.array(df.astype(np.int64))], names=["term", "cf", "df"])
    return _by_row(docs, id_col, text_col).mapInArrow(run, "term string, cf long, df long")


def _row_weights(docs: DataFrame, vocab: Sequence, id_col: str, text_col: str, listed: bool = False) -> DataFrame:
    """``(id, term, index, weight)`` of rows that are a document each, for the rows ``term, index, idf`` of a
    vocabulary; ``listed``: ``(id, indices, weights)``, a row for each document, also for one without terms."""
    cells = [("indices", T.ArrayType(T.IntegerType())), ("weights", T.ArrayType(T.DoubleType()))] if listed else [("term", T.StringType()), ("index", T.IntegerType()), ("weight", T.DoubleType())]
    schema = T.StructType([docs.schema[id_col], *[T.StructField(*x) for x in cells]])
    table = docs.sparkSession.sparkContext.broadcast(
        (pa.array([r.term for r in vocab], pa.string()), np.array([r["index"] for r in vocab], np.int32), np.array([r.idf for r in vocab], np.float64)))

    def run(batches):
        terms, index, idf = table.value
        parts = [t.split(" ") for t in terms.to_pylist()]
        known = pa.array(sorted({w for p in parts for w in p}), pa.string())
        number, n = {w: k for k, w in enumerate(known.to_pylist())}, len(known)
        code = np.array([number[p[0]] if len(p) == 1 else n * (1 + number[p[0]]) + number[p[1]] if len(p) == 2 else -1 for p in parts], np.int64)
        order = np.argsort(code)
        code = code[order]
        for ids, grams in _grams(batches, known):
            at = np.minimum(np.searchsorted(code, grams.code), max(len(code) - 1, 0))
            there = code[at] == grams.code if len(code) else np.zeros(len(at), bool)
            row, term, tf = _row_counts(grams.row[there], order[at[there]])
            raw = (1.0 + np.log(tf)) * idf[term]
            norm = np.sqrt(np.bincount(row, raw * raw, len(ids)))
            weight = raw / norm[row]
            if listed:
                ends = pa.array(np.append(0, np.cumsum(np.bincount(row, minlength=len(ids)))).astype(np.int32))
                yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(ends, pa.array(index[term])), pa.ListArray.from_arrays(ends, pa.array(weight))], names=[id_col, "indices", "weights"])
            else:
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(row)), terms.take(pa.array(term)), pa.array(index[term]), pa.array(weight)], names=[id_col, "term", "index", "weight"])
    return _by_row(docs, id_col, text_col).mapInArrow(run, schema)


def _added_up(counts: DataFrame, id_col: str) -> DataFrame:
    return counts.groupBy(id_col, "term").agg(F.sum("tf").alias("tf"))


def term_counts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, term, tf)``. Tasks count a row's n-grams as whole numbers in sorted
    arrays; only rows that share their id are exploded into an aggregate."""
    once, repeated = _once_and_repeated(docs, id_col)
    counts = _counts_of_rows(once, id_col, text_col)
    return counts if repeated is None else counts.unionByName(_added_up(_counts_of_rows(repeated, id_col, text_col), id_col))


def tfidf_fit(docs: DataFrame, id_col: str, text_col: str, max_features: int = TFIDF_MAX_FEATURES,
              counts: DataFrame | None = None) -> DataFrame:
    """M6 fit: ``(term, index, df, idf)`` for the ``max_features`` terms of
    highest corpus frequency (ties: term ascending, after sklearn's sorted
    vocabulary); ``idf = ln((1+n)/(1+df)) + 1``. Pass ``counts`` (from
    :func:`term_counts`) to go by counts that are stored already; else no
    count of a single document leaves its task."""
    n_docs = docs.select(id_col).count()  # one scalar
    of_counts = lambda c: c.select("term", F.col("tf").alias("cf"), F.lit(1).cast("bigint").alias("df"))
    if counts is not None:
        sums = of_counts(counts)
    else:
        once, repeated = _once_and_repeated(docs, id_col)
        sums = _term_sums(once, id_col, text_col)
        if repeated is not None:
            sums = sums.unionByName(of_counts(_added_up(_counts_of_rows(repeated, id_col, text_col), id_col)))
    stats = sums.groupBy("term").agg(F.sum("cf").alias("cf"), F.sum("df").alias("df"))
    top = stats.orderBy(F.col("cf").desc(), F.col("term").asc()).limit(max_features)
    w = Window.orderBy("term")  # <= max_features rows
    idf = F.log(F.lit(1.0 + n_docs) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    return top.select("term", (F.row_number().over(w) - 1).cast("int").alias("index"), "df", idf.alias("idf"))


def tfidf_transform(docs: DataFrame, vocab: DataFrame, id_col: str, text_col: str,
                    counts: DataFrame | None = None) -> DataFrame:
    """M6 transform: ``(id, term, index, weight)`` with sublinear tf,
    L2-normalised per document (documents without terms have no rows).
    ``vocab`` should be stored, as :func:`tfidf_fit_transform` does.

    Terms outside the vocabulary are dropped before they are counted. A task
    weighs its rows by itself, portions of :data:`COUNTED_BYTES` at a time;
    counts meet the vocabulary in a join where they are given, where rows share
    an id, and with a vocabulary beyond :data:`BROADCAST_ROWS`."""
    few = vocab.select("term", "index", "idf")
    if counts is None and vocab.count() <= BROADCAST_ROWS:
        once, repeated = _once_and_repeated(docs, id_col)
        weights = _row_weights(once, few.collect(), id_col, text_col)
        return weights if repeated is None else weights.unionByName(_weights_of_repeated(repeated, few, id_col, text_col))
    return _weights_of_counts(term_counts(docs, id_col, text_col) if counts is None else counts, few, id_col)


def tfidf_rows(docs: DataFrame, vocab: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The same with a document's terms in one row, ``(id, indices, weights)``; a document without terms
    has a row with empty lists or none. Tasks make the lists where they weigh a row, so no weight is
    exchanged but of rows that share an id."""
    few = vocab.select("term", "index", "idf")
    lists = lambda w: w.groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct("index", "weight"))).alias("c")).select(
        id_col, F.col("c.index").alias("indices"), F.col("c.weight").alias("weights"))
    if vocab.count() > BROADCAST_ROWS:
        return lists(tfidf_transform(docs, vocab, id_col, text_col))
    once, repeated = _once_and_repeated(docs, id_col)
    rows = _row_weights(once, few.collect(), id_col, text_col, listed=True)
    return rows if repeated is None else rows.unionByName(lists(_weights_of_repeated(repeated, few, id_col, text_col)))


def _weights_of_repeated(docs: DataFrame, vocab: DataFrame, id_col: str, text_col: str) -> DataFrame:
    counts = _counts_of_rows(docs, id_col, text_col).join(F.broadcast(vocab.select("term")), "term", "left_semi")
    return _weights_of_counts(_added_up(counts, id_col), vocab, id_col)


def _weights_of_counts(counts: DataFrame, vocab: DataFrame, id_col: str) -> DataFrame:
    raw = (F.lit(1.0) + F.log(F.col("tf"))) * F.col("idf")
    w = Window.partitionBy(id_col)
    j = counts.join(broadcast_within(vocab), on="term", how="inner").withColumn("__w", raw)
    norm = F.sqrt(F.sum(F.col("__w") * F.col("__w")).over(w))
    return j.select(id_col, "term", "index", (F.col("__w") / norm).alias("weight"))


def tfidf_fit_transform(docs: DataFrame, id_col: str, text_col: str,
                        max_features: int = TFIDF_MAX_FEATURES) -> tuple[DataFrame, DataFrame]:
    """M6 on one corpus: the first pass over the texts finds the terms, which
    are stored; the second counts only those. No count of another term is kept."""
    vocab = materialize(tfidf_fit(docs, id_col, text_col, max_features))
    return vocab, tfidf_transform(docs, vocab, id_col, text_col)
