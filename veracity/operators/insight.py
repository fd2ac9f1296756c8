"""Serving aggregates (A6, A8, O2): verdict counts and keyword counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracity.functions.text import keyword_count

# --- fixed values that must equal the reference's -----------------------------
TRACKED_KEYWORDS = [
    "iran", "airstrike", "nuclear", "sanctions", "tehran",
    "houthis", "pentagon", "trump", "congress", "missile",
    "irgc", "persian gulf", "proxy war", "white house", "biden",
]
TOP_KEYWORDS = 8


def status_summary(df: DataFrame, score: str = "score", threshold: float = 0.5) -> DataFrame:
    """real = p > threshold, fake = the rest, total."""
    p = F.col(score)
    return df.agg(
        F.count_if(p > threshold).alias("n_real"),
        F.count_if(~(p > threshold) | p.isNull()).alias("n_fake"),
        F.count(F.lit(1)).alias("n_total"),
    )


def keyword_counts(df: DataFrame, text_col: str, keywords: Sequence[str] = TRACKED_KEYWORDS) -> DataFrame:
    """Non-overlapping occurrences of each keyword in the lower-cased
    texts, summed over rows - one pass, one partial aggregate per keyword."""
    agg = df.agg(*[F.sum(keyword_count(text_col, kw)).cast("bigint").alias(f"k{i}") for i, kw in enumerate(keywords)])
    rows = F.array(*[
        F.struct(F.lit(kw).alias("keyword"), F.lit(i).alias("kw_pos"), F.coalesce(F.col(f"k{i}"), F.lit(0)).cast("bigint").alias("n"))
        for i, kw in enumerate(keywords)
    ])
    return agg.select(F.inline(rows))


def top_keywords(df: DataFrame, text_col: str, keywords: Sequence[str] = TRACKED_KEYWORDS,
                 k: int = TOP_KEYWORDS) -> DataFrame:
    """O2: non-zero keyword counts, most frequent first, list order on ties."""
    kc = keyword_counts(df, text_col, keywords)
    return kc.filter(F.col("n") > 0).orderBy(F.col("n").desc(), F.col("kw_pos").asc()).limit(k)
