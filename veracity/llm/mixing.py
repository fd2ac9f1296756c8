"""Mixing sources to target weights, with DataFrame operations only.

Every row gets a hash-random key. A source's rows are dealt out by ranges of
that key, so a source with a third of all rows has as many tasks as it needs;
ranges are summed first (map-side), their running totals give each range its
offset, and a window within the range adds the rest: a distributed prefix sum
in the order of the keys. A source is cut at its exact budget. Where the
budget is above the source's size, whole epochs are taken first.

Defined results: a null or empty text has size 0 and nothing is taken of it;
the null source comes last; rows that repeat are rows of their own, in any
order among equals; an empty table gives an empty one. :func:`mix` returns
its own columns; :func:`take` returns the columns that came.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veracity.llm.base import n_words
from veracity.session import materialize

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix"
#: Rows that one range of a source holds on average at most; with texts some 15 MB.
RANGE_ROWS = 4_000
#: Sources whose totals may be broadcast: a few MB.
BROADCAST_SOURCES = 50_000


def sized(docs: DataFrame, *keep: str, seed: str = SEED) -> DataFrame:
    """``doc_id, source, size``, the hash-random key of each row, and the columns in ``keep``."""
    return docs.select("doc_id", "source", n_words("text").alias("size"),
                       F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("key"), *keep)


def targets(rows: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``source, n_rows, source_size, target`` (null-safe: ``source_key``).

    Shares go by weight; no target is above ``max_epochs`` times its source's
    size. With sources ordered by that limit over weight, those at their
    limit come first: it is enough to find where the rest's common level
    falls below its own limits. The windows run over one row per source."""
    per = rows.groupBy("source").agg(F.count("*").alias("n_rows"), F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    weighed = per.withColumn("__w", F.element_at(
        F.array(*[F.lit(int(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    ).withColumn("__cap", max_epochs * F.col("source_size"))
    by_level = Window.orderBy(F.col("__cap") / F.col("__w"), "source").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    level = weighed.select(
        "*", (F.sum("source_size").over(everything) - F.coalesce(F.sum("__cap").over(by_level), F.lit(0))).alias("__left"),
        (F.sum("__w").over(everything) - F.coalesce(F.sum("__w").over(by_level), F.lit(0))).alias("__weights"))
    # the first source in that order whose share of what is left fits: its level holds for all after it
    fits = F.col("__left") * F.col("__w") <= F.col("__cap") * F.col("__weights")
    first = F.struct(F.col("__cap") / F.col("__w"), F.col("source"), "__left", "__weights")
    chosen = level.withColumn("__at", F.min(F.when(fits, first)).over(everything))
    share = F.col("__at.__left") * F.col("__w").cast("double") / F.col("__at.__weights")
    return chosen.select("source", "n_rows", "source_size",
                         F.coalesce(F.least(F.col("__cap").cast("double"), share), F.lit(0.0)).alias("target"))


def mix(rows: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Add ``source_size, target, taken`` to rows of :func:`sized`.

    ``taken`` is the number of words the mix takes of a row: as many whole
    times its size as the target holds whole epochs, plus what the last,
    partial epoch takes; the row at the cut is taken in part, so a source
    gives exactly ``floor(target)`` words. ``rows`` is read three times."""
    per = materialize(targets(rows, weights, max_epochs))
    # a source has as many ranges of the key as its rows ask for
    named = F.coalesce(F.col("source"), F.lit("")), F.col("source").isNull()
    slot = F.floor(F.conv(F.substring("key", 1, 7), 16, 10).cast("long") * F.col("__parts") / (1 << 28))
    parts = per.select(named[0].alias("__s"), named[1].alias("__n"), "source_size", "target",
                       F.least(F.lit(1 << 22), F.ceil(F.col("n_rows") / range_rows)).alias("__parts"))
    if per.count() <= BROADCAST_SOURCES:
        parts = F.broadcast(parts)
    place = ["__s", "__n", "__range"]
    # dealt out by range in so many words: a join by source must not leave a source's ranges in one task
    ranged = rows.withColumns({"__s": named[0], "__n": named[1]}).join(parts, ["__s", "__n"]).withColumn("__range", slot).repartition(*place)
    totals = ranged.groupBy(*place).agg(F.sum("size").alias("__total"))
    before = Window.partitionBy("__s", "__n").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*place, F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__offset"))
    within = Window.partitionBy(*place).orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    left = budget - epochs * F.col("source_size") - F.col("__in") - F.col("__offset")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), left))
    return (
        ranged.withColumn("__in", F.coalesce(F.sum("size").over(within), F.lit(0)))
        .join(offsets, place)
        .select(*rows.columns, "source_size", "target", taken.cast("long").alias("taken"))
    )


def mixed_documents(docs: DataFrame, **mixture) -> DataFrame:
    """The documents as often as the mix takes them, columns as they came.

    A document at its source's cut comes with the words that the budget
    still has room for; ``n_chars`` then follows its text. Documents without
    words come once: they weigh nothing."""
    rows = sized(docs.withColumn("__row", F.struct(*docs.columns)), "__row")
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(1)
    rest = F.when(F.col("size") > 0, F.col("taken") % F.col("size")).otherwise(0)
    part = F.array_join(F.slice(F.split("__row.text", r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"), F.lit(1), rest.cast("int")), "")
    cut = F.col("__row").withField("text", part)
    if "n_chars" in docs.columns:
        cut = cut.withField("n_chars", F.length(part).cast(docs.schema["n_chars"].dataType))
    copies = F.concat(F.array_repeat(F.col("__row"), whole.cast("int")), F.when(rest > 0, F.array(cut)).otherwise(F.array().cast(f"array<{rows.schema['__row'].dataType.simpleString()}>")))
    return mix(rows, **mixture).select(F.explode(copies).alias("__copy")).select("__copy.*")
