"""Text scalar functions (F1-F10) as Spark Column expressions.

Every function returns a Column built from built-in expressions, so it stays
inside whole-stage codegen; there is no Python UDF anywhere on this path.

Python's ``re`` treats ``\\s`` and ``\\w`` as Unicode classes while Java's are
ASCII by default, so the classes below are spelled out explicitly:

* Python ``\\s``  ->  ``(?U)[\\s\\x1C-\\x1F]`` (Java's Unicode white space lacks
  the four information separators that ``str.isspace`` accepts).
* Python ``\\w``  ->  ``[\\p{L}\\p{N}_]``.
* ``string.punctuation``  ->  ``\\p{Punct}`` *without* ``(?U)`` (POSIX ASCII).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veracity.functions.common import as_col

# --- regex building blocks (Java syntax) ------------------------------------
WS_CLASS = r"[\s\x1C-\x1F]"
WS_RUN = r"(?U)" + WS_CLASS + "+"
NON_WS_RUN = r"[^\s\x1C-\x1F]+"
URL = r"(?U)(?:http|www)" + NON_WS_RUN
WORD_CHAR = r"[\p{L}\p{N}_]"
MENTION = "@" + WORD_CHAR + "+"
PUNCT = r"\p{Punct}"
EDGE_WS = r"(?U)^" + WS_CLASS + "+|" + WS_CLASS + r"+\z"
NOT_ASCII_WORD = r"(?U)[^a-z0-9\s\x1C-\x1F]"
TERM = WORD_CHAR + "{2,}"

# --- fixed values that must equal the reference's -----------------------------
# Strings that pandas.read_csv turns into NaN by default.
NA_STRINGS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)


def canonical_null(col) -> Column:
    """Map pandas' default NA sentinels to null (S1 / §1.3)."""
    c = as_col(col)
    return F.when(c.isin(list(NA_STRINGS)), F.lit(None)).otherwise(c)


def collapse_ws(col) -> Column:
    """``re.sub(r"\\s+", " ", t).strip()`` - after collapsing only U+0020
    can remain at the ends, so Spark's space-only ``trim`` equals ``strip``."""
    return F.trim(F.regexp_replace(as_col(col), WS_RUN, " "))


def strip_ws(col) -> Column:
    """Python ``str.strip()`` (all Unicode white space, no collapsing)."""
    return F.regexp_replace(as_col(col), EDGE_WS, "")


def clean_headline(col) -> Column:
    """lower, drop URLs, drop ASCII punctuation, collapse white space."""
    t = F.lower(as_col(col))
    t = F.regexp_replace(t, URL, "")
    t = F.regexp_replace(t, PUNCT, "")
    return collapse_ws(t)


def clean_tweet(col) -> Column:
    """collapse white space and strip; case and URLs kept."""
    return collapse_ws(col)


def normalise_tweet(col) -> Column:
    """URL -> ``HTTPURL``, ``@word`` -> ``@USER``, strip (no collapse)."""
    t = F.regexp_replace(as_col(col), URL, "HTTPURL")
    t = F.regexp_replace(t, MENTION, "@USER")
    return strip_ws(t)


def strip_tweet(col) -> Column:
    """remove URLs and mentions, collapse white space; case kept."""
    t = F.regexp_replace(as_col(col), URL, "")
    t = F.regexp_replace(t, MENTION, "")
    return collapse_ws(t)


def clean_ascii(col) -> Column:
    """lower, drop URLs, keep only ``[a-z0-9]`` and white space, collapse."""
    t = F.lower(as_col(col))
    t = F.regexp_replace(t, URL, "")
    t = F.regexp_replace(t, NOT_ASCII_WORD, "")
    return collapse_ws(t)


def whitespace_tokens(col, lower: bool = True) -> Column:
    """F8: ``t.lower().split()`` as ``array<string>``; empty text -> ``[]``."""
    t = as_col(col)
    if lower:
        t = F.lower(t)
    parts = F.split(F.regexp_replace(t, WS_RUN, " "), " ")
    return F.filter(parts, lambda x: x != "")


def word_terms(col) -> Column:
    """lower-cased runs of two or more word characters (``\\b\\w\\w+\\b``).

    Splitting on runs of non-word characters and dropping pieces shorter than
    two yields exactly the maximal word runs of length >= 2, and a split is
    several times cheaper than ``regexp_extract_all`` on long texts."""
    parts = F.split(F.lower(as_col(col)), "[^" + WORD_CHAR[1:-1] + "]+")
    return F.filter(parts, lambda x: F.length(x) >= 2)


def with_bigrams(tokens) -> Column:
    """unigrams followed by space-joined adjacent bigrams."""
    toks = as_col(tokens)
    n = F.size(toks)
    left = F.slice(toks, 1, F.greatest(n - 1, F.lit(0)))
    right = F.slice(toks, 2, F.greatest(n - 1, F.lit(0)))
    bigrams = F.zip_with(left, right, lambda a, b: F.concat(a, F.lit(" "), b))
    return F.concat(toks, bigrams)


def ngram_terms(col) -> Column:
    """F9 + F10: the TF-IDF analyser (word 1- and 2-grams) as one array."""
    return with_bigrams(word_terms(col))


def ngram_rows(df, id_col: str, text_col: str):
    """F9 + F10 as rows ``(id, term)``: each unigram paired with its
    successor by the native ``arrays_zip`` (no lambda per element), then one
    row for the unigram and one for the bigram. Order inside a document is
    not kept; counts are identical to :func:`ngram_terms`."""
    w = df.select(id_col, word_terms(text_col).alias("__w"))
    n = F.size("__w")
    pairs = F.arrays_zip(F.col("__w").alias("a"), F.slice("__w", 2, F.greatest(n, F.lit(1))).alias("b"))
    z = w.select(id_col, F.explode(pairs).alias("__p"))
    both = F.array(F.col("__p.a"), F.concat(F.col("__p.a"), F.lit(" "), F.col("__p.b")))
    return z.select(id_col, F.explode(both).alias("term")).filter(F.col("term").isNotNull())


def event_name(dir_name) -> Column:
    """``name.split("-all-rnr")[0].split("-")[0]``."""
    c = as_col(dir_name)
    return F.substring_index(F.substring_index(c, "-all-rnr", 1), "-", 1)


def relevant(col, keywords) -> Column:
    """Lower-cased substring test against any keyword; null -> false."""
    t = F.lower(as_col(col))
    cond = F.lit(False)
    for kw in keywords:
        cond = cond | F.coalesce(t.contains(kw.lower()), F.lit(False))
    return cond


def keyword_count(col, keyword: str) -> Column:
    """A8 helper: non-overlapping occurrences of ``keyword`` in lower(text)
    (``str.count`` semantics); null text counts 0."""
    pat = r"\Q" + keyword.lower() + r"\E"
    return F.coalesce(F.regexp_count(F.lower(as_col(col)), F.lit(pat)), F.lit(0))


def topic_match(col, terms) -> Column:
    """Case-insensitive whole-word/phrase alternation over ``terms``."""
    alts = "|".join(r"\Q" + t + r"\E" for t in terms)
    return F.coalesce(
        as_col(col).rlike(r"(?iU)(?<![\p{L}\p{N}_])(?:" + alts + r")(?![\p{L}\p{N}_])"),
        F.lit(False),
    )
