"""Removal of long repeated byte strings with suffix arrays, shard by shard.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else. Equal
strings must meet in one shard, so every window of ``length`` bytes is dealt by its anchor: the
run of ``gram`` bytes in it with the least hash, the leftmost if there are several. Equal windows
have equal anchors. Consecutive windows with one anchor make a segment.

* Segments whose anchor occurs once are done: none of their windows is repeated.
* Segments with equal bytes are one content; a content of two segments repeats in all its windows.
* Contents that share an anchor but differ are compared by longer anchors, to its right and to
  its left: every window holds one of the two. Contents that still share one go to its shard,
  where a suffix array over all of them, by external induced sorting, puts equal windows side by
  side.

Anchors of too many contents for a shard are made longer, which splits their windows further;
at ``length`` bytes an anchor is the window itself, so this ends, exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from tierstone.llm.induced_sort import sort_suffixes
from tierstone.llm.words import mix, powers_of, text_blocks
from tierstone.sources import stage

_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)
_POSITION_BITS = 23


@dataclass(frozen=True)
class Repeats:
    length: int = 200
    gram: int = 32
    shard_bytes: int = 1 << 20
    sort_memory: int = 16 << 20
    contents_per_anchor: int = 5_000
    block: int = 2 << 20  # windows looked at in one step; less than 2 ** _POSITION_BITS

    @property
    def right(self) -> int:
        """Bytes that the anchor of a right half adds behind the gram."""
        return (self.length - self.gram) // 2

    @property
    def left(self) -> int:
        """Bytes that the anchor of a left half adds before the gram."""
        return self.length - self.gram - self.right


# --- anchors ----------------------------------------------------------------------------


def _gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes from every position that has them, by doubling."""
    held, width = mix(data.astype(np.uint64) + _U(1)), 1
    out, covered = None, 0
    rest = size
    while rest:
        if rest & 1:
            out = held.copy() if out is None else _pair(out, held, covered)
            covered += width
        rest >>= 1
        if rest:
            held, width = _pair(held, held, width), 2 * width
    return mix(out[: len(data) - size + 1])


def _pair(a: np.ndarray, b: np.ndarray, shift: int) -> np.ndarray:
    n = min(len(a), len(b) - shift)
    x = a[:n] * _ODD
    x ^= x >> _U(31)
    return x + b[shift : shift + n] * _U(0xD6E8FEB86659FD93)


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values."""
    held, span = x, 1
    while 2 * span <= width:
        held = np.minimum(held[: len(held) - span], held[span:])
        span *= 2
    if span < width:
        shift = width - span
        held = np.minimum(held[: len(held) - shift], held[shift:])
    return held


@lru_cache(maxsize=4)
def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    return powers_of(int(_ODD), n), powers_of(pow(int(_ODD), -1, 1 << 64), n)


def segments_of(data: np.ndarray, ends: np.ndarray, how: Repeats) -> Iterator[tuple[np.ndarray, ...]]:
    """Blocks of (number of the text, anchor hash, content hash, first window in its text, number
    of windows, place of the anchor in the first window, hashes of the longer anchors).

    ``data`` has texts one after the other, which end at ``ends``. A segment's content is the bytes
    of all its windows and the place of the anchor in them. The longer anchors' hashes are 32 bits
    each, the right one above.
    """
    begins = np.concatenate([[0], ends[:-1]])
    windows = len(data) - how.length + 1
    for a in range(0, windows, how.block):
        b = min(windows, a + how.block)
        part = data[a : b - 1 + how.length]
        grams = _gram_hashes(part, how.gram)
        low = _U((1 << _POSITION_BITS) - 1)
        ranked = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        least = _sliding_least(ranked, how.length - how.gram + 1)
        place = (least & low).astype(np.int32)
        # windows that lie in one text; a segment ends with its text
        at = np.arange(a, b)
        text = np.repeat(np.arange(len(ends)), ends - begins)[a:b]
        inside = at + how.length <= ends[text]
        changes = np.diff(place, prepend=-1) != 0
        changes[1:] |= (text[1:] != text[:-1]) | (inside[1:] != inside[:-1])
        first = np.flatnonzero(changes)
        count = np.diff(np.append(first, len(place)))
        first, count = first[inside[first]], count[inside[first]]
        text = text[first]
        # contents: sums of mixed gram hashes, each by a power that depends on where it stands
        powers, inverse = _powers_to(1 << max(16, len(grams).bit_length()))
        sums = np.zeros(len(grams) + 1, dtype=np.uint64)
        np.cumsum(grams * powers[: len(grams)], out=sums[1:])
        end = first + count - 1 + how.length - how.gram + 1
        anchor = place[first].astype(np.int64)
        least_at = np.maximum(begins[text] - a, 0)
        most_at = np.minimum(ends[text] - a - how.gram + 1, len(grams))

        def between(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            return mix((sums[np.minimum(y, most_at)] - sums[x]) * inverse[x])

        total = between(first, end)
        right = between(anchor, anchor + how.right + 1)
        left = between(np.maximum(anchor - how.left, least_at), anchor + 1)
        sides = (right & ~_U(0xFFFFFFFF)) | (left >> _U(32))
        content = mix(total ^ mix((count.astype(np.uint64) << _U(20)) ^ (anchor - first).astype(np.uint64)))
        yield text, grams[anchor], content, first + a - begins[text], count, anchor - first, sides


def _anchor_rows(batches: Iterator[pa.RecordBatch], how: Repeats) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        uids, held, size = batch.column(0).to_numpy(), [], 0
        for a, b, data, ends in text_blocks(batch, 1):
            for text, keys, contents, first, count, place, sides in segments_of(data, ends, how):
                size += len(keys)
                hashes = (x.view(np.int64) for x in (keys, contents, sides))
                held.append((uids[a:b][text], *hashes, first, (count << 16) | place))
            if size > 20_000:
                yield _anchor_batch(held)
                held, size = [], 0
        if held:
            yield _anchor_batch(held)


def _anchor_batch(held: list[tuple]) -> pa.RecordBatch:
    uid, key, content, sides, first, shape = (np.concatenate(x) for x in zip(*held))
    return pa.RecordBatch.from_arrays(
        [pa.array(x) for x in (key, content, uid, first, shape.astype(np.int32), sides)],
        ["key", "content", "uid", "first", "shape", "sides"],
    )


# shape: number of windows, times 2 ** 16, and place of the anchor
_ANCHORS = "key long, content long, uid long, first long, shape int, sides long"


def anchors(texts: DataFrame, how: Repeats) -> DataFrame:
    """Segments of ``uid, text``."""
    return texts.select("uid", "text").mapInArrow(lambda batches: _anchor_rows(batches, how), _ANCHORS)


# --- shards -----------------------------------------------------------------------------

# bytes of the windows from ``base`` of a content; of those the ones in [low, high) count
_RECORDS = "key long, content long, base int, anchor_key long, bytes binary, gram_at int, gram int, low int, high int"


def _longer_anchors(batches: Iterator[pa.RecordBatch], how: Repeats) -> Iterator[pa.RecordBatch]:
    """Each record as two: windows that hold more to the right of the anchor, and to the left."""
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            grow = -(-(how.length - r["gram"]) // 2)
            # windows from here on hold the anchor and ``grow`` bytes to its left or right
            middle = r["gram_at"] + r["gram"] + grow - how.length
            for at, low, high in (
                (r["gram_at"], max(r["low"], middle), r["high"]),
                (r["gram_at"] - grow, r["low"], min(r["high"], middle)),
            ):
                if low < high:
                    data = np.frombuffer(r["bytes"], np.uint8)[at : at + r["gram"] + grow]
                    key = int(_gram_hashes(data, len(data)).view(np.int64)[0])
                    rows.append((r["key"], r["content"], r["base"], key, r["bytes"], at, r["gram"] + grow, low, high))
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), *[pa.int32()] * 4]
        columns = list(zip(*rows)) if rows else [()] * 9
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], batch.schema.names)


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position as one word, the first one lowest; zeros behind the end."""
    out = np.zeros(len(data) + 8, dtype=np.uint64)
    out[: len(data)] = data
    for shift in (1, 2, 4):
        out[:-shift] |= out[shift:] << _U(8 * shift)
    return out[: len(data)]


def _repeated_runs(shard: pd.DataFrame, how: Repeats) -> pd.DataFrame:
    """Runs of windows ``[low, high)`` of the contents that equal a window of the shard elsewhere."""
    texts, base = shard["bytes"].to_list(), shard["base"].to_numpy()
    size = np.array([len(x) + 1 for x in texts])
    begin = np.cumsum(size) - size
    data = np.frombuffer(b"\x00".join(texts) + b"\x00", dtype=np.uint8)
    low, high = begin + shard["low"].to_numpy(), begin + shard["high"].to_numpy()
    change = np.zeros(len(data) + 1, dtype=np.int32)
    np.add.at(change, low, 1)
    np.add.at(change, high, -1)
    is_window = np.cumsum(change[:-1]) > 0
    order = sort_suffixes(data, how.sort_memory)
    order = order[is_window[order]]
    eights, found = _eights(data), np.zeros(len(data), dtype=bool)
    for a in range(0, len(order) - 1, 1 << 16):
        p = order[a : a + (1 << 16) + 1].astype(np.int64)
        p, q = p[:-1], p[1:]
        for at in range(0, how.length, 8):  # common prefixes up to the length, the unequal ones left early
            unread = _U(8 * max(0, 8 - (how.length - at)))
            same = (eights[p + at] ^ eights[q + at]) << unread == 0
            if not same.all():
                p, q = p[same], q[same]
        found[p] = found[q] = True
    edge = np.diff(found.astype(np.int8), prepend=0, append=0)
    run_low, run_high = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    of = np.searchsorted(begin, run_low, side="right") - 1
    return pd.DataFrame(
        {
            "key": shard["key"].to_numpy()[of], "content": shard["content"].to_numpy()[of],
            "low": (run_low - begin[of] + base[of]).astype(np.int32),
            "high": (run_high - begin[of] + base[of]).astype(np.int32),
        }
    )


def _pack(texts: pa.Array) -> pa.Array:
    packer = zstandard.ZstdCompressor(level=1)
    return pa.array([packer.compress(x.as_py() or b"") for x in texts.cast(pa.binary())], pa.binary())


_PACKED = F.arrow_udf(_pack, BinaryType())
_SPAN = StructType([StructField("start", LongType()), StructField("end", LongType())])
_KEPT = StructType(
    [StructField("n_bytes", LongType()), StructField("spans", ArrayType(_SPAN)), StructField("kept", BinaryType())]
)
_SPAN_ARROW = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_KEPT_ARROW = pa.struct([("n_bytes", pa.int64()), ("spans", pa.list_(_SPAN_ARROW)), ("kept", pa.binary())])
# how the slices are asked for, and what is handed on besides their bytes
_ASKED = "first, span, key, content, base, anchor_key, gram_at, gram, low, high"
_HANDED = [tuple(x.split()) for x in _RECORDS.split(", ")]
_TYPES = {"long": (LongType(), pa.int64()), "int": (IntegerType(), pa.int32()), "binary": (BinaryType(), pa.binary())}
_SLICE = StructType([StructField(n, _TYPES[t][0]) for n, t in _HANDED])


def _cut_out(packed: pa.Array, starts: pa.Array, ends: pa.Array) -> pa.Array:
    """Remaining bytes of each text without the spans."""
    unpacker, rows = zstandard.ZstdDecompressor(), []
    for blob, a, b in zip(packed, starts, ends):
        data = unpacker.decompress(blob.as_py())
        spans: list[list[int]] = []
        if a.is_valid:
            for x, y in sorted(zip(a.as_py(), b.as_py())):
                if spans and x <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], y)
                else:
                    spans.append([x, y])
        at, kept = 0, []
        for x, y in spans:
            kept.append(data[at:x])
            at = y
        kept.append(data[at:])
        rows.append({"n_bytes": len(data), "spans": [{"start": x, "end": y} for x, y in spans], "kept": b"".join(kept)})
    return pa.array(rows, _KEPT_ARROW)


def _slices(packed: pa.Array, wanted: pa.Array) -> pa.Array:
    unpacker, rows = zstandard.ZstdDecompressor(), []
    for blob, segments in zip(packed, wanted):
        data = unpacker.decompress(blob.as_py())
        rows.append([s | {"bytes": data[s["first"] : s["first"] + s["span"]]} for s in segments.as_py()])
    return pa.array(rows, pa.list_(pa.struct([(n, _TYPES[t][1]) for n, t in _HANDED])))


def _unpack(packed: pa.Array, is_null: pa.Array) -> pa.Array:
    unpacker = zstandard.ZstdDecompressor()
    texts = [None if n.as_py() else unpacker.decompress(x.as_py()).decode() for x, n in zip(packed, is_null)]
    return pa.array(texts, pa.string())


_unpacked = F.arrow_udf(_unpack, StringType())
_CUT, _SLICED = F.arrow_udf(_cut_out, _KEPT), F.arrow_udf(_slices, ArrayType(_SLICE))


def _shard_runs(records: DataFrame, how: Repeats) -> DataFrame:
    """``key, content, low, high``: repeated windows found by the suffix arrays of the shards."""
    records = stage(records, "segments")
    while True:
        crowded = records.where(f"gram < {how.length}").groupBy("anchor_key").agg(F.count("*").alias("n"))
        crowded = stage(crowded.where(f"n > {how.contents_per_anchor}").select("anchor_key"), "crowded")
        if not crowded.limit(1).count():
            break
        longer = records.join(crowded, "anchor_key", "left_semi").select(*records.columns)
        longer = longer.mapInArrow(lambda batches: _longer_anchors(batches, how), _RECORDS)
        records = stage(records.join(crowded, "anchor_key", "left_anti").select(*records.columns).union(longer), "segments")
    # anchors as long as a window need no sorting, and may be as many as there are documents
    whole = records.where(f"gram >= {how.length}")
    repeated = stage(whole.groupBy("anchor_key").agg(F.count("*").alias("n")).where("n > 1").select("anchor_key"), "windows")
    runs = whole.join(repeated, "anchor_key", "left_semi").selectExpr(
        "key", "content", "low + base as low", "high + base as high"
    )
    sortable = records.where(f"gram < {how.length}")
    total = sortable.agg(F.sum(F.length("bytes"))).first()[0] or 0
    shards = max(1, math.ceil(total / how.shard_bytes))
    shard = F.pmod(F.xxhash64("anchor_key"), F.lit(shards))
    dealt = sortable.select("key", "content", "base", "bytes", "low", "high", shard.alias("shard"))
    sorted_ = dealt.groupBy("shard").applyInPandas(
        lambda x: _repeated_runs(x, how), "key long, content long, low int, high int"
    )
    return runs.union(sorted_)


def _halves(contents: DataFrame, how: Repeats) -> DataFrame:
    """Each content as the windows that hold the longer anchor to the right, and those that hold
    the one to the left: where their bytes stand, and the anchor in them."""
    split = F.greatest(F.lit(0), F.least("windows", F.col("place") - how.left))

    def half(right: bool) -> Column:
        low, high = (split, F.col("windows")) if right else (F.lit(0), split)
        at = F.col("place") if right else F.col("place") - how.left
        side = F.shiftrightunsigned("sides", 32) if right else F.col("sides").bitwiseAND(0xFFFFFFFF)
        return F.struct(
            F.xxhash64("key", F.lit(right), side).alias("anchor_key"),
            (F.col("at.first") + low).alias("first"),
            (high - low + how.length - 1).alias("span"),
            low.alias("base"),
            (at - low).alias("gram_at"),
            F.lit(how.gram + (how.right if right else how.left)).alias("gram"),
            F.lit(0).alias("low"),
            (high - low).alias("high"),
        )

    both = contents.select(
        "key", "content", "n", F.col("at.uid").alias("uid"), F.explode(F.array(half(True), half(False))).alias("h")
    )
    return both.select("key", "content", "n", "uid", "h.*").where("high > 0")


# --- documents --------------------------------------------------------------------------


def remove_repeats(docs: DataFrame, how: Repeats = Repeats(), text: str = "text") -> DataFrame:
    """``docs`` with struct ``_repeats``: ``n_bytes``, ``spans`` removed, and ``kept`` bytes.

    Texts are UTF-8 bytes, a null text is empty. The kept bytes may cut a character, so they are
    binary. Rows that repeat a ``doc_id`` are documents of their own. A column named ``_repeats``
    in the input is replaced.
    """
    own = [c for c in docs.columns if c != "_repeats"]
    uid = F.xxhash64(docs["doc_id"], docs[f"`{text}`"])  # rows that are equal in both have equal results
    texts = docs.select(uid.alias("uid"), docs[f"`{text}`"].alias("text"))
    every = stage(anchors(texts, how), "all_segments")
    keys = every.groupBy("key").agg(F.count("*").alias("n"))
    repeated = stage(keys.where("n > 1").select("key"), "anchors")
    segments = stage(every.join(repeated, "key", "left_semi"), "segments")
    contents = stage(
        segments.groupBy("key", "content").agg(
            F.count("*").alias("n"), F.min(F.struct("uid", "first")).alias("at"), F.any_value("shape").alias("shape"),
            F.any_value("sides").alias("sides"),
        ).withColumn("windows", F.shiftright("shape", 16)).withColumn("place", F.col("shape").bitwiseAND(0xFFFF)),
        "contents",
    )
    several = stage(contents.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key"), "several")
    halves = _halves(contents.join(several, "key", "left_semi"), how)
    # where every content of an anchor is repeated already, there is nothing left to find
    counted = halves.groupBy("anchor_key").agg(F.count("*").alias("c"), F.min("n").alias("least"))
    shared = stage(counted.where("c > 1 and least = 1").select("anchor_key"), "shared")
    # one document that holds each content gives its bytes
    wanted = halves.join(shared, "anchor_key", "left_semi").select("uid", F.struct(*_ASKED.split(", ")).alias("s"))
    wanted = wanted.groupBy("uid").agg(F.collect_list("s").alias("wanted"))
    packed = texts.select("uid", _PACKED("text").alias("packed")).join(wanted, "uid")
    fetched = packed.select(_SLICED("packed", "wanted").alias("s"))
    records = fetched.select(F.inline("s")).dropDuplicates(["key", "content", "base", "anchor_key"])
    runs = _shard_runs(records, how).union(
        contents.where("n > 1").select("key", "content", F.lit(0).alias("low"), F.col("windows").alias("high"))
    )
    found = segments.join(stage(runs, "runs"), ["key", "content"]).select(
        F.col("uid").alias("_uid"),
        (F.col("first") + F.col("low")).alias("x"),
        (F.col("first") + F.col("high") + how.length - 1).alias("y"),
    )
    spans = found.groupBy("_uid").agg(F.collect_list("x").alias("_x"), F.collect_list("y").alias("_y"))
    others = [c for c in own if c != text]
    whole = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in others], F.lit(0).alias("_")).alias("_row"),
        docs[f"`{text}`"].isNull().alias("_null"), _PACKED(docs[f"`{text}`"]).alias("_packed"), uid.alias("_uid"),
    )
    joined = whole.join(spans, "_uid", "left")
    return joined.select(
        *[F.col(f"_row.`{c}`").alias(c) for c in others],
        _unpacked(F.col("_packed"), F.col("_null")).alias(text),
        _CUT(F.col("_packed"), F.col("_x"), F.col("_y")).alias("_repeats"),
    )
