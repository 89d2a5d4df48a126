"""Packing of documents into token sequences by length patterns.

The histogram of piece lengths is all that the plan needs: patterns of a few documents that fill
a sequence are enumerated on a coarse grid, non-negative least squares fits how often to repeat
each, the counts are rounded down, and what they leave over is packed best fit, longest first,
into the space that is left. Plan and histogram are bounded by the sequence length, whatever the
number of documents; documents find their place in the plan by their rank among equal lengths.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstone.llm.token_ids import encoder
from tierstone.sources import stage

# Rows of one length are ranked in cells of about CELL_ROWS, in at most MOST_CELLS of them until
# that would make cells of more than MOST_CELL_ROWS.
CELL_ROWS = 2_000
MOST_CELLS = 64
MOST_CELL_ROWS = 1_000_000
# Documents, or pieces, whose rows of five numbers go to one file. Where Hadoop's native library is
# missing, each file costs processes that start with the executor's memory mapped.
ROWS_PER_FILE = 50_000
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


# --- the plan: lengths and how often, on the driver -------------------------------------


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``x >= 0`` that minimises ``|a x - b|``, by the active set method of Lawson and Hanson."""
    n = a.shape[1]
    x, active = np.zeros(n), np.zeros(n, dtype=bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    for _ in range(10 * a.shape[0]):
        gradient = a.T @ (b - a @ x)
        gradient[active] = -np.inf
        best = int(np.argmax(gradient))
        if gradient[best] <= tolerance:
            break
        active[best] = True
        while True:
            at = np.flatnonzero(active)
            s = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if (s > 0).all():
                x[:] = 0
                x[at] = s
                break
            down = s <= 0
            step = np.min(x[at][down] / np.maximum(x[at][down] - s[down], 1e-300))
            x[at] += step * (s - x[at])
            active[at[x[at] <= 1e-12]] = False
            x[~active] = 0
    return x


@cache
def patterns(grid: int, most: int) -> tuple[tuple[int, ...], ...]:
    """Multisets of 1 to ``most`` grid lengths, longest first, that fill the grid."""
    out = []

    def extend(held: tuple[int, ...], left: int) -> None:
        if left == 0:
            out.append(held)
        elif len(held) < most:
            for x in range(min(left, held[-1] if held else left), 0, -1):
                if x * (most - len(held)) < left:
                    break
                extend((*held, x), left - x)

    extend((), grid)
    return tuple(out)


def _take(counts: np.ndarray, low: int, high: int, k: int) -> list[tuple[int, int]]:
    """Remove the ``k`` longest of lengths ``low + 1 .. high``: runs of (length, how many)."""
    runs = []
    for length in range(high, low, -1):
        n = min(k, int(counts[length]))
        if n:
            counts[length] -= n
            runs.append((length, n))
            k -= n
    return runs


def _zip_runs(slots: list[list[tuple[int, int]]]) -> list[tuple[tuple[int, ...], int]]:
    """Runs of each slot, side by side, as runs of whole sequences."""
    cuts = sorted({x for runs in slots for x in accumulate(n for _, n in runs)})
    ends = [list(accumulate(n for _, n in runs)) for runs in slots]
    out, begin = [], 0
    for cut in cuts:
        out.append((tuple(runs[int(np.searchsorted(e, cut))][0] for runs, e in zip(slots, ends)), cut - begin))
        begin = cut
    return out


Plan = list[tuple[tuple[int, ...], int]]


def plan(histogram: dict[int, int], capacity: int, grid: int = 64) -> Plan:
    """Sequences as (lengths in order, how many such sequences). Uses every count exactly once.

    Patterns of at most two, three and four documents are tried; the fewest sequences win.
    """
    return min((_plan(histogram, capacity, grid, most) for most in (2, 3, 4)), key=lambda p: sum(n for _, n in p))


def _plan(histogram: dict[int, int], capacity: int, grid: int, most: int) -> Plan:
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in histogram.items():
        counts[length] += n
    unit = -(-capacity // grid)
    bins = -(-capacity // unit)
    wanted = np.array([counts[b * unit + 1 : (b + 1) * unit + 1].sum() for b in range(bins)], dtype=np.float64)
    shapes = patterns(bins, most)
    a = np.zeros((bins, len(shapes)))
    for j, shape in enumerate(shapes):
        for x in shape:
            a[x - 1, j] += 1
    fitted = np.floor(nonnegative_least_squares(a, wanted) + 1e-6).astype(np.int64)
    groups: list[list[tuple[tuple[int, ...], int]]] = [[] for _ in range(capacity + 1)]  # by free space

    def put(slots: tuple[int, ...], n: int) -> None:
        groups[capacity - sum(slots)].append((slots, n))

    for j in np.flatnonzero(fitted):
        shape = shapes[j]
        here = [int(counts[(x - 1) * unit + 1 : min(x * unit, capacity) + 1].sum()) // shape.count(x) for x in shape]
        k = min(int(fitted[j]), *here)
        if k:
            # the shortest slot takes what fits best into the space that the others really leave
            taken = [_take(counts, (x - 1) * unit, min(x * unit, capacity), k) for x in shape[:-1]]
            for slots, n in _zip_runs(taken) if taken else [((), k)]:
                for last, m in _take(counts, 0, capacity - sum(slots), n):
                    put((*slots, last), m)
                    n -= m
                if n:
                    put(slots, n)
    for length in range(capacity, 0, -1):
        left, free = int(counts[length]), length
        while left:
            while free <= capacity and not groups[free]:
                free += 1
            if free > capacity:
                each = capacity // length
                if left // each:
                    put((length,) * each, left // each)
                if left % each:
                    put((length,) * (left % each), 1)
                break
            slots, n = groups[free].pop()
            used = min(n, left)
            left -= used
            put((*slots, length), used)
            if n > used:
                groups[free].append((slots, n - used))
            free = length
    return [x for held in groups for x in held]


@dataclass(frozen=True)
class Places:
    """The plan by length: which ranks of a length go to which sequences, at which offset."""

    length: np.ndarray
    first: np.ndarray  # rank of the first piece, within its length
    sequence: np.ndarray
    offset: np.ndarray
    n_sequences: int

    @classmethod
    def of(cls, sequences: list[tuple[tuple[int, ...], int]]) -> Places:
        rows, used, base = [], {}, 0
        for slots, n in sequences:
            for offset, length in zip(accumulate(slots, initial=0), slots):
                first = used.get(length, 0)
                rows.append((length, first, base, offset))
                used[length] = first + n
            base += n
        rows.sort()
        table = np.array(rows, dtype=np.int64).reshape(-1, 4)
        return cls(*table.T, base)

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces."""
        begin = np.searchsorted(self.length, length)
        end = np.searchsorted(self.length, length, side="right")
        while True:  # halve every search at once
            mid = (begin + end) // 2
            going = end - begin > 1
            if not going.any():
                break
            right = going & (self.first[np.minimum(mid, len(self.first) - 1)] <= rank)
            begin = np.where(right, mid, begin)
            end = np.where(going & ~right, mid, end)
        return self.sequence[begin] + rank - self.first[begin], self.offset[begin]


# --- documents --------------------------------------------------------------------------


def _cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces of ``n`` tokens; the first is the one that may be shorter."""
    first = n % capacity or capacity
    return [(0, min(n, first)), *((a, a + capacity) for a in range(first, n, capacity))] if n > capacity else [(0, n)]


def _encoded(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int) -> Iterator[tuple[list, list[bytes]]]:
    encode, end = encoder(tokenizer), end_id.to_bytes(4, "little")
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for at in range(0, batch.num_rows, 128):
            found = encode.encode([x.as_py() or "" for x in texts[at : at + 128]])
            yield ids[at : at + 128].to_pylist(), [x + end for x in found]


def _pieces(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int, capacity: int) -> Iterator[pa.RecordBatch]:
    for ids, encoded in _encoded(batches, tokenizer, end_id):
        rows = [
            (doc_id, piece, a, b - a, zlib.crc32(memoryview(data)[4 * a : 4 * b]))
            for doc_id, data in zip(ids, encoded)
            for piece, (a, b) in enumerate(_cuts(len(data) // 4, capacity))
        ]
        names = [x.split()[0] for x in _PIECES.split(", ")]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)


def _cells(n: int) -> int:
    """The driver holds a number per cell: at most 64 for each length, and one for a million rows."""
    return max(min(math.ceil(n / CELL_ROWS), MOST_CELLS), math.ceil(n / MOST_CELL_ROWS))


def _files(rows: int) -> int:
    return max(1, -(-rows // ROWS_PER_FILE))


def _narrow(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs[f"`{text}`"].alias("text"))


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048, text: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    A document's tokens are its ids and ``end_id``; a null text has the end alone. Documents of
    more than ``capacity`` tokens are cut. Rows that repeat a ``doc_id``, or have none, are packed
    as documents of their own. No documents: no rows. ``docs`` is counted, then read.
    """
    cut = _narrow(docs, text).mapInArrow(lambda batches: _pieces(batches, tokenizer, end_id, capacity), _PIECES)
    # not coalesced, which would encode the texts in those few tasks
    pieces = stage(cut.repartition(_files(docs.count())), "pieces")
    spark = docs.sparkSession
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = Places.of(plan(histogram, capacity))

    # ranks among equal lengths: a frequent length is dealt to cells, counted first
    split = [(length, _cells(n)) for length, n in histogram.items()]
    cells_of = spark.createDataFrame(split, "length long, cells long")
    mixed = F.xxhash64("doc_id", "piece", "ids_crc32")
    dealt = pieces.join(F.broadcast(cells_of), "length").withColumn("cell", F.pmod(mixed, F.col("cells")))
    per_cell = dealt.groupBy("length", "cell").agg(F.count("*").alias("n")).collect()
    counts = sorted((r["length"], r["cell"], r["n"]) for r in per_cell)
    before, offsets = {}, []
    for length, cell, n in counts:
        offsets.append((length, cell, before.get(length, 0)))
        before[length] = before.get(length, 0) + n
    cell_offsets = spark.createDataFrame(offsets, "length long, cell long, before long")
    ranked = dealt.selectExpr(
        "*", "row_number() over (partition by length, cell order by doc_id, piece, ids_crc32) - 1 as in_cell"
    ).join(F.broadcast(cell_offsets), ["length", "cell"])
    ranked = ranked.select(*[x.split()[0] for x in _PIECES.split(", ")], (F.col("before") + F.col("in_cell")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = places.find(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            columns = [*batch.columns[:-1], pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "sequence_id", "offset"])

    placed = ranked.mapInArrow(place, f"{_PIECES}, sequence_id long, offset long")
    return placed.coalesce(_files(sum(histogram.values())))


def sequences(
    docs: DataFrame,
    packed: DataFrame,
    tokenizer: str,
    end_id: int = 0,
    capacity: int = 2048,
    text: str = "text",
) -> DataFrame:
    """The packed sequences themselves: ``sequence_id``, ``ids`` (little-endian unsigned 32-bit)
    and ``pieces``, an array of ``offset, doc_id, piece``. Needs unique ids. At most ``capacity``
    tokens meet in a row, so no group grows with the data."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, encoded in _encoded(batches, tokenizer, end_id):
            rows = [
                (doc_id, piece, data[4 * a : 4 * b])
                for doc_id, data in zip(ids, encoded)
                for piece, (a, b) in enumerate(_cuts(len(data) // 4, capacity))
            ]
            kinds = [pa.int64(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["doc_id", "piece", "ids"])

    tokens = _narrow(docs, text).mapInArrow(cut, "doc_id long, piece int, ids binary")
    met = packed.select("doc_id", "piece", "sequence_id", "offset").join(tokens, ["doc_id", "piece"])
    placed = F.collect_list(F.struct("offset", "doc_id", "piece", "ids"))
    grouped = met.groupBy("sequence_id").agg(F.sort_array(placed).alias("p"))
    return grouped.select(
        "sequence_id",
        F.aggregate("p", F.lit(b""), lambda held, x: F.concat(held, x["ids"])).alias("ids"),
        F.transform("p", lambda x: F.struct(x["offset"], x["doc_id"], x["piece"])).alias("pieces"),
    )
