"""Filtered fact rows and left lookups into dimensions of any size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierstone.functions import named, row_bytes
from tierstone.functions.fixed_values import COMPLETED

# A dimension is copied to every executor only up to this measured size.
MAX_BROADCAST_BYTES = 256 * 1024 * 1024
# Keys above this many rows are dealt to several tasks. At most MAX_HOT_KEYS are, heaviest
# first: a key beyond has fewer rows than the 10,000th, which AQE splits if it must.
HOT_KEY_ROWS = 1_000_000
MAX_HOT_KEYS = 10_000
# Tasks that the rows of one key, or rows without a key, are dealt to at most.
MAX_SPLITS = 4_096

_SALT = "__salt"


def completed_only(df: DataFrame, status: str = COMPLETED, column: str = "status") -> DataFrame:
    """Rows whose status equals ``status`` exactly; null is dropped."""
    return df.filter(F.col(column) == status)


def in_memory_bytes(df: DataFrame) -> int | None:
    """Upper estimate of a frame's size as an in-memory hash table, from its actual rows.

    One aggregate over the frame. ``None`` when the size cannot be bounded this way.
    """
    rows, size = df.agg(F.count(F.lit(1)), F.sum(row_bytes(df.schema))).first()
    return size if rows else 0


def fits_broadcast(
    dim: DataFrame,
    dim_bytes: int | None = None,
    *,
    broadcast: str = "auto",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    **_,
) -> bool:
    """Whether a dimension may be copied to every executor; measured unless ``dim_bytes``, an
    upper bound, already settles it."""
    if broadcast != "auto":
        return broadcast == "measured"
    if dim_bytes is None or dim_bytes > max_broadcast_bytes:
        dim_bytes = in_memory_bytes(dim)
    return dim_bytes is not None and dim_bytes <= max_broadcast_bytes


def hot_key_rows(
    df: DataFrame, keys: Sequence[str], min_rows: int = HOT_KEY_ROWS, limit: int = MAX_HOT_KEYS
) -> dict[str, dict]:
    """Per key column: its heaviest values of at least ``min_rows`` rows and how many, null included.

    All columns are counted in one pass. Counting is pre-aggregated per map task and the
    answer is at most ``limit`` values a column, so neither a reducer nor the driver sees more.
    """
    names = [f"k{i}" for i in range(len(keys))]
    columns = df.select(*[named(k).alias(n) for k, n in zip(keys, names)])
    counted = columns.groupingSets([[n] for n in names], *names).agg(
        F.count(F.lit(1)).alias("n"), F.grouping_id().alias("set")
    )
    # what is left is few: no more values than rows divided by ``min_rows``
    place = F.row_number().over(Window.partitionBy("set").orderBy(F.desc("n"), *names))
    heaviest = counted.filter(F.col("n") >= min_rows).withColumn("place", place)
    found: dict[str, dict] = {k: {} for k in keys}
    for row in heaviest.filter(F.col("place") <= limit).orderBy("set", "place").collect():
        # a set's bit is 0 for the column that it groups by
        at = next(i for i in range(len(keys)) if not row["set"] >> (len(keys) - 1 - i) & 1)
        found[keys[at]][row[names[at]]] = row["n"]
    return found


def hot_keys(
    df: DataFrame, key: str, min_rows: int = HOT_KEY_ROWS, limit: int = MAX_HOT_KEYS
) -> list:
    """The heaviest key values with at least ``min_rows`` rows, null excluded."""
    return [k for k in hot_key_rows(df, [key], min_rows, limit + 1)[key] if k is not None][:limit]


def _splits(key: Column, rows_of: Mapping, min_rows: int) -> Column:
    """How many tasks the rows of ``key`` are dealt to; 1 if it is not hot."""
    by_splits: dict[int, list] = {}
    for value, n in rows_of.items():
        # powers of two, so that the expression has few branches
        wanted = 1 << max(1, min(MAX_SPLITS, -(-n // min_rows)) - 1).bit_length()
        by_splits.setdefault(wanted, []).append(value)
    splits = F.lit(1)
    for wanted, values in by_splits.items():
        present = [v for v in values if v is not None]
        here = key.isin(present) if present else F.lit(False)
        if len(present) < len(values):
            here = here | key.isNull()
        splits = F.when(here, wanted).otherwise(splits)
    return splits


def _reject_duplicates(dim: DataFrame, key: str) -> None:
    repeated = (
        dim.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .limit(1)
        .collect()
    )
    if repeated:
        raise ValueError(f"{key}={repeated[0][0]!r} occurs {repeated[0]['n']} times in the lookup")


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    columns: Sequence[str],
    *,
    broadcast: str = "auto",
    dim_bytes: int | None = None,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    min_hot_rows: int = HOT_KEY_ROWS,
    hot: Mapping | None = None,
    require_unique: bool = False,
) -> DataFrame:
    """Left lookup: every fact row is kept, with ``columns`` of the matching ``dim`` rows.

    Unmatched or null keys give null columns; a key repeated in ``dim`` repeats the fact
    row (``require_unique=True`` makes that an error). ``dim`` is pruned to the key and
    ``columns`` first.

    ``broadcast="auto"`` copies the dimension to the executors when it is at most
    ``max_broadcast_bytes``: the fact table is then not shuffled at all. The size is
    measured on the pruned rows, unless an upper bound from :func:`in_memory_bytes` or the
    table's commit record is given as ``dim_bytes`` and already settles it. Beyond that, or
    with ``broadcast="never"`` (``"measured"``: the caller found it to fit), both sides shuffle
    on the key in one join: rows of hot keys,
    and rows without a key if they are many, are dealt to several tasks, and the lookup's rows
    of those keys alone are copied to each. Hot keys are counted in ``fact`` first; when that
    is itself a join, count them in the table that they come from with :func:`hot_key_rows`
    and pass them as ``hot``.
    """
    if broadcast not in ("auto", "never", "measured"):
        raise ValueError(f"broadcast must be 'auto', 'never' or 'measured', not {broadcast!r}")
    clash = set(columns) & set(fact.columns)
    if clash:
        raise ValueError(f"both sides have {sorted(clash)}; rename or drop one of them")
    lookup = dim.select(key, *columns)
    if require_unique:
        _reject_duplicates(lookup, key)
    if fits_broadcast(lookup, dim_bytes, broadcast=broadcast, max_broadcast_bytes=max_broadcast_bytes):
        return fact.join(F.broadcast(lookup), key, "left")

    if hot is None:
        hot = hot_key_rows(fact, [key], min_hot_rows)[key]
    if not hot:
        return fact.join(lookup.hint("merge"), key, "left")
    splits = _splits(named(key), hot, min_hot_rows)
    dealt = fact.withColumn(_SALT, F.pmod(F.monotonically_increasing_id(), splits.cast("long")).cast("int"))
    copies = lookup.filter(named(key).isNotNull()).withColumn(
        _SALT, F.explode(F.sequence(F.lit(0), splits - 1))
    )
    return dealt.join(copies.hint("merge"), [key, _SALT], "left").drop(_SALT)
