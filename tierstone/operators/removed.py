"""Why rows were removed: a reason for each, and the copy that survived it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstone.functions import named
from tierstone.functions.fixed_values import FLAG_SEPARATOR
from tierstone.operators.lookup import HOT_KEY_ROWS, MAX_HOT_KEYS, fits_broadcast, lookup_join
from tierstone.operators.quality import AUDIT_TIMES
from tierstone.sources import shuffles_removed, stage

_KEY, _ROWS, _COPIES, _REASON = "__key", "__rows", "__copies", "__reason"


def _with_survivors(rows: DataFrame, firsts: DataFrame, key: Column, **lookup_options) -> DataFrame:
    """Equal rows, counted, with the surviving copy of their key where it is repeated.

    Beyond the broadcast bound a row is shuffled once, to the task of its key, where equal rows are
    counted and the lookup finds them in place. Rows of hot keys, which ``firsts`` tells, are
    counted by content instead, and then dealt out by the lookup.
    """
    survivors = [c for c in firsts.columns if c != _KEY]

    def counted(some: DataFrame) -> DataFrame:
        keyed = some.withColumn(_KEY, key)
        return keyed.groupBy(*map(named, keyed.columns)).agg(F.count(F.lit(1)).alias(_COPIES))

    small = fits_broadcast(firsts, **lookup_options)
    if lookup_options.get("broadcast", "auto") == "auto":
        lookup_options["broadcast"] = "measured" if small else "never"

    def looked_up(copies: DataFrame, found: DataFrame, hot: Mapping) -> DataFrame:
        return lookup_join(copies, found, _KEY, survivors, **(lookup_options | {"hot": hot}))

    if small:
        return looked_up(counted(rows), firsts, {})
    hot = lookup_options.get("hot")
    if hot is None:
        many = firsts.where(F.col(_ROWS) >= lookup_options.get("min_hot_rows", HOT_KEY_ROWS))
        hot = dict(many.select(_KEY, _ROWS).orderBy(F.desc(_ROWS), _KEY).limit(MAX_HOT_KEYS).collect())
    if not hot:
        return looked_up(counted(rows.repartition(key)), firsts, {})
    is_hot, keyed = named(_KEY).isin([k for k in hot if k is not None]), rows.withColumn(_KEY, key)
    others = keyed.where(~is_hot).drop(_KEY).repartition(key)
    return looked_up(counted(others), firsts, {}).unionByName(
        looked_up(counted(keyed.where(is_hot).drop(_KEY)), firsts.where(is_hot), hot)
    )


def removed_rows(df: DataFrame, keys: Sequence[str], required: Sequence[str], **lookup_options) -> DataFrame:
    """What :func:`dedupe_by_key` (by its default order) and then :func:`require_not_null` remove.

    One row per content and reason: the columns of ``df`` but its audit times, ``reason``
    (``duplicate``, or ``missing_<column>`` for each required value that the surviving copy lacks),
    ``copies`` (rows removed for it), and for duplicates the columns of the surviving copy as
    ``survivor_<column>`` and whether that one stays, ``survivor_kept``. The copies and the rows
    that stay add up to the rows of ``df``.

    The first copy of each key is found in map tasks before it moves, and the surviving copies, of
    repeated keys alone, are looked up as in :func:`tierstone.operators.lookup_join`
    (``lookup_options`` are its), so no hot key is gathered in one task. Every row is shuffled
    twice, and the shuffle files of the first time are gone before the second.
    """
    content = [c for c in df.columns if c not in AUDIT_TIMES]
    others = [c for c in content if c not in keys]
    kinds = {f.name: f.dataType for f in df.schema}
    floating = {c for c, kind in kinds.items() if isinstance(kind, (T.DoubleType, T.FloatType))}
    # zero has one sign, as in a grouping
    rows = df.select(*[(named(c) + F.lit(0.0)).cast(kinds[c]).alias(c) if c in floating else named(c) for c in content])
    key = F.to_json(F.struct(*[named(c) for c in keys]))
    # nulls last, as in the dedupe: structs are compared field by field
    order = [x for i, c in enumerate(others) for x in (named(c).isNull().alias(f"n{i}"), named(c).alias(f"v{i}"))]
    firsts = (
        rows.groupBy(key.alias(_KEY))
        .agg(F.min(F.struct(F.lit(0).alias("x"), *order)).alias("f"), F.count(F.lit(1)).alias(_ROWS))
        .where(F.col(_ROWS) > 1)
        .select(_KEY, _ROWS, *[F.col(f"f.v{i}").alias(f"survivor_{c}") for i, c in enumerate(others)])
    )
    with shuffles_removed(df.sparkSession):
        firsts = stage(firsts, "survivors")  # read twice: once to be sized
    joined = _with_survivors(rows, firsts, key, **lookup_options)

    def missing(column: str, prefix: str = "") -> Column:
        null = named(prefix + column).isNull()
        return null | F.isnan(named(prefix + column)) if column in floating else null

    def kept(prefix: str = "") -> Column:
        # a key that is required is the same in all copies
        return ~reduce(Column.__or__, [missing(c, "" if c in keys else prefix) for c in required], F.lit(False))

    same = [named(c).eqNullSafe(named(f"survivor_{c}")) for c in others]
    is_first = F.col(_ROWS).isNull() | reduce(Column.__and__, same, F.lit(True))
    extra = F.col(_COPIES) - is_first.cast("long")
    lacking = F.concat_ws(FLAG_SEPARATOR, *[F.when(missing(c), F.lit(f"missing_{c}")) for c in required])
    reasons = F.array_compact(
        F.array(
            F.when(extra > 0, F.struct(F.lit("duplicate").alias("reason"), extra.alias("copies"))),
            F.when(is_first & ~kept(), F.struct(lacking.alias("reason"), F.lit(1).cast("long").alias("copies"))),
        )
    )
    repeated = F.col("reason") == "duplicate"
    return (
        joined.withColumn(_REASON, F.explode(reasons))
        .select(*map(named, content), *[named(f"survivor_{c}") for c in others], F.col(f"{_REASON}.*"))
        .select(
            *map(named, content),
            "reason",
            "copies",
            F.when(repeated, kept("survivor_")).alias("survivor_kept"),
            *[F.when(repeated, named(f"survivor_{c}")).alias(f"survivor_{c}") for c in others],
        )
    )
