"""Exact dense ranking of a whole table without a whole-table window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierstone.operators.lookup import lookup_join
from tierstone.sources import stage

# Up to this many rows a plain window in one task is the cheapest correct plan.
SINGLE_TASK_ROWS = 100_000
# Distinct values a ranking task should sort.
VALUES_PER_RANGE = 1_000_000
# Largest k whose k values are broadcast back to the table.
MAX_BROADCAST_K = 100_000

_VALUE, _PLACE, _RANGE = "__rank_value", "__rank_place", "__rank_range"
# monotonically_increasing_id(): the partition above this bit, the row in it below.
_ROW_BITS = 33


def _without(df: DataFrame, out: str) -> DataFrame:
    """The frame without a column that ``out`` is to replace."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() != out.lower()])


def dense_rank_global(
    df: DataFrame,
    by: str,
    out: str = "rank",
    *,
    buckets: int | None = None,
    single_task_rows: int = SINGLE_TASK_ROWS,
    rank_type: str = "int",
) -> DataFrame:
    """Add the dense rank of ``by`` over the whole frame, highest first, nulls last.

    Any type that Spark can sort is ranked, at any size. ``df`` is read several times and must
    give the same rows each time: pass a stored table, not an aggregate over doubles. A column
    named ``out`` is replaced; more than 2**31 distinct values need ``rank_type="bigint"``. Small frames use the plain window. Larger ones (or any frame
    when ``buckets`` is given):

    1. the distinct values, one row each however often they occur, are sorted into ranges,
       one range a task, and written with their place;
    2. prefix sums over the ranges' sizes, a table of one row a range, make the place a rank;
    3. rows look their rank up by value: broadcast if the values are measured to be few, else
       joined with frequent values dealt to several tasks.
    """
    rows = df.count()
    if buckets is None and rows <= single_task_rows:
        rank = F.dense_rank().over(Window.orderBy(F.desc_nulls_last(by)))
        ranked = df.withColumn("__rank", rank.cast(rank_type))
        return _without(ranked, out).withColumnRenamed("__rank", out)
    ranges = max(2, -(-rows // VALUES_PER_RANGE)) if buckets is None else buckets
    if ranges < 1:
        raise ValueError(f"buckets must be 1 or more, not {ranges}")

    values = df.filter(F.col(by).isNotNull()).select(F.col(by).alias(_VALUE)).distinct()
    places = stage(
        values.repartitionByRange(ranges, F.desc(_VALUE))
        .sortWithinPartitions(F.desc(_VALUE))
        .withColumn(_PLACE, F.monotonically_increasing_id()),
        "rank-values",
    )
    range_of = F.shiftright(_PLACE, _ROW_BITS).alias(_RANGE)
    sizes = places.groupBy(range_of).agg(F.count(F.lit(1)).alias("n"))
    # one row per range: small beside the values, whatever their number
    before = (F.sum("n").over(Window.orderBy(_RANGE)) - F.col("n")).alias("__before")
    offsets = stage(sizes.select(_RANGE, before, "n"), "rank-offsets")
    total = offsets.agg(F.sum("n")).first()[0] or 0
    in_range = F.col(_PLACE).bitwiseAND((1 << _ROW_BITS) - 1) + 1
    placed = places.withColumn(_RANGE, range_of).join(offsets, _RANGE)
    ranks = placed.select(F.col(_VALUE).alias(by), (F.col("__before") + in_range).cast(rank_type).alias("__rank"))
    order = [c for c in df.columns if c.lower() != out.lower()]
    found = lookup_join(df.select(*[F.col(f"`{c}`") for c in df.columns]), ranks, by, ["__rank"])
    rank = F.coalesce("__rank", F.lit(total + 1)).cast(rank_type)
    return found.select(*[F.col(f"`{c}`") for c in order], rank.alias(out))


def top_ranked(df: DataFrame, by: str, k: int, out: str = "rank") -> DataFrame:
    """All rows whose dense rank by ``by``, highest first, is at most ``k``; ties are kept.

    The k highest distinct values are a top-k over pre-aggregated values (at most k rows
    leave each task). They come back as a lookup of k rows, so no row of the table is
    shuffled, however many rows tie. Beyond ``MAX_BROADCAST_K`` values the whole frame is
    ranked. ``df`` is read twice; pass a stored table. A column named ``out`` is replaced.
    """
    if k > MAX_BROADCAST_K:
        return dense_rank_global(df, by, out).filter(F.col(out) <= k)
    best = df.select(F.col(by).alias(_VALUE)).distinct().orderBy(F.desc_nulls_last(_VALUE)).limit(k)
    rank = F.dense_rank().over(Window.orderBy(F.desc_nulls_last(_VALUE)))
    ranks = best.select(_VALUE, rank.alias("__rank"))
    found = df.join(F.broadcast(ranks), F.col(by).eqNullSafe(F.col(_VALUE))).drop(_VALUE)
    return _without(found, out).withColumnRenamed("__rank", out)
