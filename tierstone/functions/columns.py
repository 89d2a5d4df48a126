"""Column expressions. All are built-in Spark expressions, so they stay in codegen."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstone.functions.fixed_values import CLEAN, FLAG_SEPARATOR, ISO_DAY

_PLAIN_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"


def named(name: str) -> Column:
    """The column called exactly ``name``, whatever characters the file header used."""
    return F.col("`" + name.replace("`", "``") + "`")


def proper_case(text: Column) -> Column:
    """Strip edge spaces, then capitalise each space-separated word."""
    return F.initcap(F.trim(text))


def parse_day(text: Column, fmt: str = ISO_DAY, strict: bool = False) -> Column:
    """Text to date. Unparseable text is null, or an error when ``strict``.

    Valid days in the usual format take a cast, which costs half of a formatted parse; all
    other text is left to the parser.
    """
    parsed = F.to_date(text, fmt) if strict else F.try_to_date(text, fmt)
    if fmt != ISO_DAY:
        return parsed
    return F.coalesce(F.when(text.rlike(_PLAIN_DAY), text.try_cast("date")), parsed)


def as_type(value: Column, spark_type: str, strict: bool = False) -> Column:
    """Cast. Values that do not fit are null, or an error when ``strict``."""
    return value.cast(spark_type) if strict else value.try_cast(spark_type)


def money(value: Column, digits: int = 2) -> Column:
    """Half-up rounding for reported amounts."""
    return F.round(value, digits)


def audit_time(moment: datetime | None = None) -> Column:
    """The query's own start time, or a fixed ``moment`` for reproducible re-runs."""
    return F.current_timestamp() if moment is None else F.lit(moment).cast("timestamp")


def issue_label(rules: Mapping[str, Column], clean: str = CLEAN, sep: str = FLAG_SEPARATOR) -> Column:
    """Names of all rules that hold, joined by ``sep``; ``clean`` when none does.

    A rule that evaluates to null counts as not holding.
    """
    found = F.concat_ws(sep, *[F.when(rule, F.lit(name)) for name, rule in rules.items()])
    return F.coalesce(F.nullif(found, F.lit("")), F.lit(clean))


# Upper estimates for one row of an in-memory hash table: header, key copy and pointers,
# then an 8-byte slot per column, doubled for the table's load factor.
_ROW_BYTES, _COLUMN_BYTES = 64, 16


def row_bytes(schema: T.StructType) -> Column:
    """Upper estimate of a row's size in an in-memory hash table.

    Null for a schema with nested columns, whose size has no cheap bound.
    """
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    if any(isinstance(f.dataType, nested) for f in schema):
        return F.lit(None).cast("long")
    size = F.lit(_ROW_BYTES + _COLUMN_BYTES * len(schema)).cast("long")
    for field in schema:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(named(field.name)), F.lit(0))
    return size
