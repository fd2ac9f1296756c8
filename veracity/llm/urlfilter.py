"""URL filters: rules by host and path, and a list of canonical URLs.

The list can be of any size. A blocked Bloom filter of it, each key setting
one bit in each of the eight words of one block, is built by aggregation and
is at most ``MAX_BLOCKS`` rows, so it is broadcast whatever the list's size.
Most URLs fail it there and then; only possible hits are shuffled to an exact
hash join with the list, which removes the false positives. A list beyond what
the filter was sized for costs more possible hits, never a wrong verdict.

Defined results: a null URL or one without ``://`` has an empty host and path,
meets no rule and isn't listed. Rows that repeat are judged each; repeats in
the list count once, nulls there not at all. An empty list blocks nothing, an
empty table gives an empty one. Columns that came stay, except those named
like the results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracity.session import materialize

#: (verdict, host, path), fixed values.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Parameters that don't change what a URL leads to.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"
WORDS, BITS_A_KEY = 8, 16
MAX_BLOCKS = 1 << 17
RESULTS = ("host", "path", "canonical", "rule", "listed", "verdict")


def host(url) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path(url) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def canonical(url) -> Column:
    """Host without ``www.`` and default port, path without a slash at its end,
    parameters sorted and without tracking; null if there is no host."""
    query = F.coalesce(F.regexp_extract(url, PARTS, 3), F.lit(""))
    parameters = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    name = F.regexp_replace(F.regexp_replace(host(url), r"^www\.", ""), r":(80|443)$", "")
    return F.when(host(url) != "", F.concat(
        name, F.regexp_replace(path(url), "/+$", ""), F.when(F.size(parameters) > 0, F.concat(F.lit("?"), F.array_join(parameters, "&"))).otherwise("")))


def rule_of(rules: Sequence[tuple[str, str, str]] = RULES, host_col="host", path_col="path") -> Column:
    """``struct(rule, verdict)`` of the longest rule that fits, or null. Rules are a short list."""
    fits = []
    for verdict, name, start in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        within = (F.col(host_col) == name) | F.col(host_col).endswith("." + name)
        fits.append(F.when(within & F.col(path_col).startswith(start), F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<rule:string,verdict:string>")


def _bit(key: str, word: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key, F.lit("bits")), 6 * word).bitwiseAND(F.lit(63)).cast("int")


def _block(key: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def bloom(keys: DataFrame, key: str, max_blocks: int = MAX_BLOCKS) -> tuple[DataFrame, int]:
    """The filter's blocks (``block, w0..w7``; those that aren't empty) and their number."""
    blocks = max(1, min(max_blocks, -(-keys.count() * BITS_A_KEY // (64 * WORDS))))
    # 1 << bit as a long; shiftleft takes a column for the number of places only in SQL
    words = [F.bit_or(F.expr(f"shiftleft(1L, __b{i})")).alias(f"w{i}") for i in range(WORDS)]
    placed = keys.select(_block(key, blocks).alias("block"), *[_bit(key, i).alias(f"__b{i}") for i in range(WORDS)])
    return placed.groupBy("block").agg(*words), blocks


def possible(rows: DataFrame, key: str, filter_: DataFrame, blocks: int) -> DataFrame:
    """Add ``__maybe``: false only if the row's key surely isn't in the filter's."""
    named = filter_.toDF("__block", *[f"__w{i}" for i in range(WORDS)])
    probed = rows.withColumns({"__block": _block(key, blocks), **{f"__b{i}": _bit(key, i) for i in range(WORDS)}}).join(F.broadcast(named), "__block", "left")
    hit = F.col(key).isNotNull() & F.col("__w0").isNotNull()
    for i in range(WORDS):
        hit &= F.expr(f"shiftrightunsigned(__w{i}, __b{i}) & 1L = 1L")
    return probed.select(*rows.columns, F.coalesce(hit, F.lit(False)).alias("__maybe"))


def judge(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """Add ``host, path, canonical, rule, listed, verdict`` to ``pages``.

    ``listed`` has the canonical URLs to block in its only column. A URL that
    meets a rule takes the rule's verdict, another is blocked if listed."""
    own = [c for c in pages.columns if c not in RESULTS]
    keys = materialize(listed.toDF("canonical").filter("canonical is not null").distinct())
    filter_, blocks = bloom(keys, "canonical", max_blocks)
    rows = pages.select(*own, host("url").alias("host"), path("url").alias("path"), canonical("url").alias("canonical"))
    rows = possible(rows.withColumn("__rule", rule_of(rules)), "canonical", materialize(filter_), blocks)
    exact = keys.withColumn("listed", F.lit(True))
    found = rows.filter("__maybe").join(exact, "canonical", "left").withColumn("listed", F.coalesce("listed", F.lit(False)))
    rest = rows.filter("not __maybe").withColumn("listed", F.lit(False))
    return found.unionByName(rest).select(
        *own, "host", "path", "canonical", F.col("__rule.rule").alias("rule"), "listed",
        F.coalesce("__rule.verdict", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"))
