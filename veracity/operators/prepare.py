"""Preparation operators: projections, filters, lookups, merges
(P1-P9, J1, J2, J5, U1, U2, S3, A11)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veracity.functions import text as T
from veracity.functions.common import as_col
from veracity.session import materialize

# --- fixed values that must equal the reference's -----------------------------
MIN_TEXT_LEN = 20
SERVE_THRESHOLD = 0.5  # p > 0.5 is Real when serving
# Topic query terms of the scraper (OR-ed, lang:en, no retweets, no replies)
TOPIC_TERMS = [
    "Iran", "Iranian", "IRGC", "Tehran", "Khamenei", "Strait of Hormuz",
    "US strikes", "airstrike", "Middle East war", "nuclear deal",
    "sanctions Iran", "Persian Gulf", "Houthis", "proxy war",
    "US military Iran", "Iran attack", "Iran missile",
    "trump", "biden", "congress", "white house", "pentagon",
]


# --- P1/P2/P4 --------------------------------------------------------------------------
def preprocess(df: DataFrame, text_col: str, mode: str = "headline", keep: Sequence[str] = ("label",)) -> DataFrame:
    """``clean_title`` from F1 (headline) or F2 (tweet); other columns kept."""
    fn = T.clean_headline if mode == "headline" else T.clean_tweet
    if mode not in ("headline", "tweet"):
        raise ValueError(mode)
    return df.select(*keep, fn(text_col).alias("clean_title"))


def drop_incomplete(df: DataFrame, text_col: str = "clean_title", label_col: str | None = "label") -> DataFrame:
    """Drop rows with null or empty text or a null label; label -> int.

    A non-integral label is dropped too (``try_cast``), instead of failing."""
    cond = as_col(text_col).isNotNull() & (as_col(text_col) != "")
    out = df
    if label_col:
        out = out.withColumn(label_col, F.col(label_col).try_cast("int"))
        cond = cond & F.col(label_col).isNotNull()
    return out.filter(cond)


def min_length_filter(df: DataFrame, text_col: str, min_len: int = MIN_TEXT_LEN,
                      cleaned_col: str = "text") -> DataFrame:
    """F4-clean the text and keep rows whose cleaned text has at least
    ``min_len`` code points."""
    cleaned = once(df, cleaned_col, T.strip_tweet(text_col))
    return cleaned.filter(F.length(F.col(cleaned_col)) >= min_len)


def once(df: DataFrame, name: str, value) -> DataFrame:
    """``df`` with a costly column that a filter above isn't evaluated on again:
    a generator stands between, which filters on its output don't pass."""
    other = [c for c in df.columns if c != name]
    return df.select(*other, F.inline(F.array(F.struct(value.alias(name)))))


# --- P6/P7 -------------------------------------------------------------------------------
def topic_filter(df: DataFrame, text_col: str, terms: Sequence[str] = TOPIC_TERMS, lang_col: str | None = None,
                 lang: str = "en", exclude_flags: Sequence[str] = ()) -> DataFrame:
    """Any term/phrase as a whole word (case-insensitive), language match,
    and none of the exclusion flags (e.g. retweet, reply)."""
    cond = T.topic_match(text_col, terms)
    if lang_col:
        cond = cond & (F.col(lang_col) == lang)
    for f in exclude_flags:
        cond = cond & ~F.coalesce(F.col(f), F.lit(False))
    return df.filter(cond)


def relevancy_flag(df: DataFrame, text_col: str, keywords: Sequence[str], out: str = "is_relevant") -> DataFrame:
    """P7."""
    return df.withColumn(out, T.relevant(text_col, keywords))


# --- P8 / J2 -------------------------------------------------------------------------
def annotation_value(col):
    """``int(ann.get(key, 0))``: absent -> 0, castable -> int, else null."""
    c = as_col(col)
    return F.when(c.isNull(), F.lit(0)).otherwise(F.trim(c.cast("string")).try_cast("int"))


def thread_label(is_rumour, misinformation, true, has_annotation):
    """Non-rumour -> 1; rumour without annotation -> null (dropped);
    misinformation == 1 -> 0; else true == 1 -> 1; else null (unverified).
    A malformed value (not an integer) also drops the thread."""
    mis, tru = annotation_value(misinformation), annotation_value(true)
    r = as_col(is_rumour)
    return (
        F.when(~r, F.lit(1))
        .when(~as_col(has_annotation), F.lit(None).cast("int"))
        .when(mis.isNull() | tru.isNull(), F.lit(None).cast("int"))
        .when(mis == 1, F.lit(0))
        .when(tru == 1, F.lit(1))
        .otherwise(F.lit(None).cast("int"))
    )


def thread_annotation_join(posts: DataFrame, annotations: DataFrame, keys: Sequence[str],
                           is_rumour_col: str = "is_rumour", text_col: str = "text") -> DataFrame:
    """J2 + P8 + F3: source posts left-joined to their annotation on
    ``keys``; rows without a label and posts with empty text are dropped, the
    text is normalised. ``annotations`` has ``keys`` + misinformation + true."""
    a = annotations.select(*keys, "misinformation", "true", F.lit(True).alias("__has_ann"))
    j = posts.join(a, on=list(keys), how="left")
    lab = thread_label(F.col(is_rumour_col), F.col("misinformation"), F.col("true"),
                       F.coalesce(F.col("__has_ann"), F.lit(False)))
    stripped = T.strip_ws(text_col)
    out = j.withColumn("label", lab).filter(F.col("label").isNotNull() & (stripped != ""))
    return out.withColumn(text_col, T.normalise_tweet(text_col)).drop("misinformation", "true", "__has_ann")


# --- P9 ---------------------------------------------------------------------------------
def verdict(df: DataFrame, score: str = "score", threshold: float = SERVE_THRESHOLD) -> DataFrame:
    """P9/F14: 'Real' iff p > threshold; confidence = p or 1 - p."""
    p = F.col(score)
    conf = F.when(p > threshold, p).otherwise(F.lit(1.0) - p)
    return df.select(
        "*",
        F.when(p > threshold, F.lit("Real")).otherwise(F.lit("Fake")).alias("verdict"),
        conf.alias("conf"),
    )


# --- J1 --------------------------------------------------------------------------------
def author_join(posts: DataFrame, users: DataFrame, author_col: str, user_id_col: str, username_col: str,
                order_col: str | None = None, out: str = "source") -> DataFrame:
    """``'@' + username`` by author id, ``@unknown`` when missing. Users
    are first reduced to one row per id (last one wins by ``order_col``)."""
    if order_col:
        u = users.groupBy(user_id_col).agg(
            F.max_by(F.col(username_col), F.col(order_col)).alias("__uname"))
    else:
        u = users.groupBy(user_id_col).agg(F.max(F.col(username_col)).alias("__uname"))
    j = posts.join(u, posts[author_col] == u[user_id_col], "left")
    return j.select(*[posts[c] for c in posts.columns],
                    F.concat(F.lit("@"), F.coalesce(F.col("__uname"), F.lit("unknown"))).alias(out))


# --- U1/J5 -------------------------------------------------------------------------------
def merge_distinct(master: DataFrame, new: DataFrame, key: str = "text", order_cols: Sequence[str] = ()) -> DataFrame:
    """``master`` followed by ``new``, one row per key over both: master
    rows come first, then the smallest ``order_cols`` (then columns). All null
    keys are one key, as in pandas. One aggregation, one shuffle."""
    cols = master.columns
    both = master.select(*cols, F.lit(0).alias("__side")).unionByName(new.select(*cols, F.lit(1).alias("__side")))
    firsts = both.groupBy(key).agg(F.min_by(F.struct(*cols), F.struct("__side", *order_cols, *[c for c in cols if c not in order_cols])).alias("__r"))
    return firsts.select("__r.*")


def key_digest(key) -> "F.Column":
    """SHA-256 of a key, 32 bytes whatever its length; null is a key of its own."""
    return F.unhex(F.coalesce(F.sha2(as_col(key), 256), F.lit("")))


def fresh_rows(batch: DataFrame, known: DataFrame, key: str = "text", order_cols: Sequence[str] = ()) -> DataFrame:
    """The first row per key of ``batch`` whose :func:`key_digest` isn't in
    the only column of ``known``.

    ``known`` is as long as the master, so its part that the batch meets is
    found first, with the batch's digests as the small side: the master's
    digests are then scanned, but not shuffled, as long as a batch's fit a
    broadcast."""
    firsts = materialize(merge_distinct(batch.limit(0), batch, key, order_cols).withColumn("__digest", key_digest(key)))
    met = known.toDF("__known").join(firsts.select("__digest"), F.col("__known") == F.col("__digest"), "left_semi")
    return firsts.join(met, F.col("__digest") == F.col("__known"), "left_anti").drop("__digest")


# --- S3 / A11 -------------------------------------------------------------------------
def latest_snapshot(df: DataFrame, file_col: str, mtime_col: str, prefer: str | None = None) -> DataFrame:
    """S3: rows of the file with the greatest modification time (ties: the
    greatest file name), or of ``prefer`` if that file is there. The chosen
    name is a one-row aggregate."""
    place = F.struct((F.col(file_col) == F.lit(prefer)) if prefer else F.lit(False), F.col(mtime_col), F.col(file_col))
    latest = df.agg(F.max_by(F.col(file_col), place).alias("__latest"))
    return df.join(F.broadcast(latest), df[file_col] == latest["__latest"], "left_semi")


def snapshot_counts(df: DataFrame, file_col: str) -> DataFrame:
    """Rows per snapshot file."""
    return df.groupBy(file_col).agg(F.count(F.lit(1)).alias("n_articles"))


def serving_status(df: DataFrame, mtime_col: str, score: str = "score", threshold: float = SERVE_THRESHOLD,
                   text_col: str = "text") -> DataFrame:
    """One row on what is being served: ``last_sync`` (minutes, ``No data yet``
    without any row), ``status`` and the counts of real and fake texts. ``df``
    holds the rows of the served file, those without text included."""
    has_text = F.col(text_col).isNotNull()
    real = F.count_if(has_text & (F.col(score) > threshold))
    agg = df.agg(F.count("*").alias("__n"), F.count_if(has_text).alias("__texts"), F.max(mtime_col).alias("__at"), real.alias("n_real"),
                 (F.count_if(has_text) - real).alias("n_fake"))
    status = F.when(F.col("__n") == 0, "Waiting for scrape").when(F.col("__texts") == 0, "Empty file").otherwise("Healthy")
    return agg.select(F.coalesce(F.date_format("__at", "yyyy-MM-dd HH:mm"), F.lit("No data yet")).alias("last_sync"), status.alias("status"), "n_real", "n_fake")


# --- O1 ---------------------------------------------------------------------------------
def latest_rows(df: DataFrame, time_col: str, tie_cols: Sequence[str], n: int = 10, text_col: str = "text") -> DataFrame:
    """O1: drop null text, newest ``n`` rows (a ``TakeOrderedAndProject``).
    Without the time column rows go by ``tie_cols`` alone."""
    if time_col not in df.columns:
        return df.filter(F.col(text_col).isNotNull()).orderBy(*[F.col(c) for c in tie_cols]).limit(n)
    order = [F.col(time_col).desc_nulls_last()] + [F.col(c).desc() for c in tie_cols]
    return df.filter(F.col(text_col).isNotNull()).orderBy(*order).limit(n)


def serving_defaults(df: DataFrame) -> DataFrame:
    """The columns that served rows must have, with the defaults of a file
    that lacks them: ``scraped_at`` ``N/A``, ``source`` ``NewsAPI``."""
    missing = {c: F.lit(v) for c, v in (("scraped_at", "N/A"), ("source", "NewsAPI")) if c not in df.columns}
    return df.withColumns(missing) if missing else df


def top_k_per_group(df: DataFrame, group_cols: Sequence[str], order, k: int, rank_col: str = "rank") -> DataFrame:
    """O4 building block: ``row_number() <= k`` (planned as WindowGroupLimit)."""
    w = Window.partitionBy(*group_cols).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)
