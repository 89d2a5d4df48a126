"""Uniform shuffling into shards of exact size by a communication matrix.

How many rows each input partition sends to each shard is drawn exactly, from the multivariate
hypergeometric law, on the driver: a small matrix. Each partition then deals out its rows by a
random permutation of the labels that its line of the matrix asks for, the rows are exchanged,
and every shard permutes what it received. The result is a uniform random permutation of all
rows, cut into shards whose sizes differ by one at most (law ``rows``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

LAW = "rows"
ROWS_PER_CELL = 200_000
MIN_CELLS = 32


@dataclass(frozen=True)
class Draw:
    """The matrix: rows from each partition (by id) to each shard."""

    counts: dict[int, np.ndarray]
    seed: int

    def labels(self, partition: int) -> np.ndarray:
        """Shards of the partition's rows, in a random order that a retried task repeats."""
        line = self.counts.get(partition, np.zeros(1, dtype=np.int64))
        kind = np.uint8 if len(line) <= 256 else np.int32
        labels = np.repeat(np.arange(len(line), dtype=kind), line)
        return np.random.default_rng([self.seed, 1, partition]).permutation(labels)


def shard_sizes(rows: int, shards: int) -> np.ndarray:
    return rows // shards + (np.arange(shards) < rows % shards).astype(np.int64)


def draw(partition_rows: dict[int, int], shards: int, seed: int) -> Draw:
    """Exact counts, one partition after the other from what the shards have left."""
    left = shard_sizes(sum(partition_rows.values()), shards)
    random = np.random.default_rng([seed, 0])
    counts = {}
    for partition, n in sorted(partition_rows.items()):
        # one conditional hypergeometric draw per shard, exact for any size numpy takes
        line, rest, want = np.zeros(shards, dtype=np.int64), int(left.sum()), n
        for k in range(shards - 1):
            rest -= int(left[k])
            got = _hypergeometric(random, int(left[k]), rest, want)
            line[k], want = got, want - got
        line[-1] = want
        left -= line
        counts[partition] = line
    return Draw(counts, seed)


def _hypergeometric(random: np.random.Generator, good: int, bad: int, n: int) -> int:
    if not n or not good:
        return 0
    if not bad:
        return min(good, n)
    if max(good, bad) < 10**9:  # what numpy draws from
        return int(random.hypergeometric(good, bad, n))
    return _log_concave(random, good, bad, n)


def _log_concave(random: np.random.Generator, good: int, bad: int, n: int) -> int:
    """The same draw for any size, by Devroye's rejection for log-concave laws: a flat top around
    the mode with exponential tails lies above the probabilities."""

    def choose(a: int, b: int) -> float:
        return math.lgamma(a + 1) - math.lgamma(b + 1) - math.lgamma(a - b + 1)

    def log_p(k: int) -> float:
        return choose(good, k) + choose(bad, n - k) - choose(good + bad, n)

    low, high = max(0, n - bad), min(good, n)
    mode = min(high, max(low, (good + 1) * (n + 1) // (good + bad + 2)))
    at_mode = math.exp(log_p(mode))
    flat = 1 + at_mode / 2
    while True:
        if random.random() <= flat / (1 + flat):
            y, top = random.random() * flat / at_mode, 1.0
        else:
            e = random.exponential()
            y, top = (flat + e) / at_mode, math.exp(-e)
        k = mode + (1 if random.random() < 0.5 else -1) * round(y)
        if low <= k <= high and random.random() * top <= math.exp(log_p(k)) / at_mode:
            return k


def _deal(batches: Iterator[pa.RecordBatch], plan: Draw) -> Iterator[pa.RecordBatch]:
    """The rows with their shard and a random 64-bit order."""
    partition = TaskContext.get().partitionId()
    labels, at = plan.labels(partition), 0
    random = np.random.default_rng([plan.seed, 2, partition])
    for batch in batches:
        n = batch.num_rows
        if at + n > len(labels):
            raise RuntimeError("the input changed between counting and dealing")
        order = random.integers(-(2**63), 2**63 - 1, n, dtype=np.int64, endpoint=True)
        columns = [*batch.columns, pa.array(labels[at : at + n].astype(np.int32)), pa.array(order)]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "_shard", "_order"])
        at += n
    if at != len(labels):
        raise RuntimeError("the input changed between counting and dealing")


def shuffle_into_shards(docs: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """``docs`` with struct ``_place``: ``shard`` and ``slot``, gapless from 0 in each shard.

    The input must come in the same partitions each time it is computed, as a table read from
    files does; a task that sees other numbers of rows than were counted fails, it never deals
    wrongly. Writing the result by shard, sorted by slot, gives the shuffled shards. All columns
    of a row move with it; nulls, repeated and empty rows are rows like any other. A column named
    ``_place`` in the input is replaced.

    The driver holds one line of ``shards`` counts per input partition, and one number for each
    cell of about ``ROWS_PER_CELL`` rows, the ranges of the second permutation that are sorted
    apart.
    """
    own = [c for c in docs.columns if c != "_place"]
    whole = docs.select(F.struct(*[docs[f"`{c}`"] for c in own]).alias("_row"))
    counted = docs.select(F.spark_partition_id().alias("p")).groupBy("p").agg(F.count("*").alias("n")).collect()
    plan = draw({r["p"]: r["n"] for r in counted}, shards, seed)
    rows = sum(r["n"] for r in counted)
    cells = max(math.ceil(MIN_CELLS / shards), math.ceil(rows / shards / ROWS_PER_CELL))

    def celled(df: DataFrame) -> DataFrame:
        # a cell is a range of the random order, so cells in order are the shard in order
        position = (F.col("_order") / F.lit(2.0**64) + 0.5) * cells
        return df.withColumn("_cell", F.greatest(F.lit(0), F.least(F.lit(cells - 1), F.floor(position))).cast("int"))

    def dealt(df: DataFrame) -> DataFrame:
        schema = StructType([*df.schema, StructField("_shard", IntegerType()), StructField("_order", LongType())])
        return celled(df.mapInArrow(lambda batches: _deal(batches, plan), schema))

    light = dealt(docs.select(F.lit(1).cast("byte").alias("_one")))
    per_cell = light.groupBy("_shard", "_cell").agg(F.count("*").alias("n")).collect()
    sizes = sorted((r["_shard"], r["_cell"], r["n"]) for r in per_cell)
    begin, before = [], {}
    for shard, cell, n in sizes:
        begin.append((shard, cell, before.get(shard, 0)))
        before[shard] = before.get(shard, 0) + n
    offsets = docs.sparkSession.createDataFrame(begin, "_shard int, _cell int, _begin long")
    placed = dealt(whole).selectExpr(
        "*", "row_number() over (partition by _shard, _cell order by _order) - 1 as _in_cell"
    ).join(F.broadcast(offsets), ["_shard", "_cell"])
    return placed.select(
        *[F.col(f"_row.`{c}`").alias(c) for c in own],
        F.struct(F.col("_shard").alias("shard"), (F.col("_begin") + F.col("_in_cell")).alias("slot")).alias("_place"),
    )
