"""Row-quality steps: dedupe, reject, fill, flag."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstone.functions import issue_label, named
from tierstone.functions.fixed_values import CLEAN

# Columns that change on every run and so must never decide which copy survives.
AUDIT_TIMES = ("ingestion_timestamp", "updated_timestamp")

_COPY_NO = "__copy_no"


def dedupe_by_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column] | None = None,
    prefer: Sequence[Column] = (),
) -> DataFrame:
    """Keep one row per key. Null keys equal each other.

    The survivor is the first row by ``prefer``, then by ``order_by``, which defaults
    to every other column but the audit times, ascending with nulls last. Rows tied on all
    of those are the same, so the survivor never depends on task order.

    Catalyst turns ``row_number() <= 1`` into a group limit on both sides of the
    exchange: every map task sends at most one row per key, so a key that holds a
    third of the table costs the reducer one row per map task. Both sides sort by key
    first; leading with its hash settles nearly every comparison on eight bytes, also for
    ids that share a long prefix.
    """
    if order_by is None:
        skip = {*keys, *AUDIT_TIMES}
        order_by = [named(c).asc_nulls_last() for c in df.columns if c not in skip]
    ordering = [*prefer, *order_by] or [F.lit(1)]
    copies = Window.partitionBy(F.xxhash64(*keys), *keys).orderBy(*ordering)
    return (
        df.withColumn(_COPY_NO, F.row_number().over(copies))
        .filter(F.col(_COPY_NO) == 1)
        .drop(_COPY_NO)
    )


def require_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any of ``columns``.

    Written as a conjunction of ``IS NOT NULL`` because that reaches the Parquet scan;
    ``dropna`` does not. ``dropna`` also drops NaN, so that is spelled out for
    floating-point columns.
    """
    floating = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}

    def present(name: str) -> Column:
        ok = F.col(name).isNotNull()
        return ok & ~F.isnan(name) if name in floating else ok

    return df.filter(reduce(Column.__and__, map(present, columns)))


def _accepts(spark_type: T.DataType, value: object) -> bool:
    if isinstance(value, bool):
        return isinstance(spark_type, T.BooleanType)
    if isinstance(value, str):
        return isinstance(spark_type, T.StringType)
    if isinstance(value, int):
        return isinstance(spark_type, T.NumericType)
    if isinstance(value, float):
        return isinstance(spark_type, T.NumericType) and (
            not isinstance(spark_type, T.IntegralType) or value.is_integer()
        )
    return False


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace nulls (and NaN in floating-point columns) by a default per column.

    Spark skips a default whose type does not fit its column without a word; here that
    is an error, as is a column that does not exist.
    """
    types = {f.name: f.dataType for f in df.schema}
    for name, value in defaults.items():
        if name not in types:
            raise ValueError(f"no column {name!r} to fill; have {sorted(types)}")
        if not _accepts(types[name], value):
            raise TypeError(
                f"default {value!r} does not fit {name!r} of type {types[name].simpleString()}"
            )
    return df.fillna(dict(defaults))


def flag_quality(
    df: DataFrame,
    rules: Mapping[str, Column],
    out: str = "data_quality_flag",
    clean: str = CLEAN,
) -> DataFrame:
    """Add ``out``: the names of the rules that hold for the row, or ``clean``."""
    return df.withColumn(out, issue_label(rules, clean))
