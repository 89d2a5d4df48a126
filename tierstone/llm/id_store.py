"""Token ids in compressed, randomly readable segments.

Each document's ids (little-endian unsigned 32-bit) are one zstandard frame, compressed by
itself with a dictionary that all documents share, so one short document is read by decoding one
frame. A segment is a run of documents in ascending ``doc_id`` order; it holds the hash of the
dictionary, an index of offsets and the frames. Segments are rows of a Parquet table, in which the
range of ids of a segment finds the one to read. Layout of a segment, all little-endian:

    magic "TIDS", version u32, dictionary sha256 (32 bytes), documents u64,
    ids i64[n], tokens u64[n], frame ends u64[n], frames

Documents without an id come first and have the least 64-bit integer in the index.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstone.llm.token_ids import encoder

# Fixed values of the format.
MAGIC = b"TIDS"
VERSION = 1
NO_ID = -(2**63)

# Fitting the dictionary: at most this many documents, each by a window of at most this many bytes.
SAMPLE_DOCUMENTS = 2_000
SAMPLE_BYTES = 32 << 10
DICTIONARY_BYTES = 64 << 10
LEVEL = 1
SEGMENT_BYTES = 1 << 20
_SEGMENTS = "part int, segment int, first_id long, last_id long, start_in_part long, n_tokens long, data binary"


def pack_segment(ids: list[int], encoded: list[bytes], dictionary: zstandard.ZstdCompressionDict) -> bytes:
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
    frames = [packer.compress(x) for x in encoded]
    head = MAGIC + VERSION.to_bytes(4, "little") + hashlib.sha256(dictionary.as_bytes()).digest()
    index = (
        np.array(ids, "<i8"),
        np.array([len(x) // 4 for x in encoded], "<u8"),
        np.cumsum([len(x) for x in frames]).astype("<u8"),
    )
    return head + len(ids).to_bytes(8, "little") + b"".join(x.tobytes() for x in index) + b"".join(frames)


class Segment:
    """A reader of one segment."""

    def __init__(self, data: bytes, dictionary: zstandard.ZstdCompressionDict):
        if data[:4] != MAGIC or int.from_bytes(data[4:8], "little") != VERSION:
            raise ValueError("not a segment of this version")
        if data[8:40] != hashlib.sha256(dictionary.as_bytes()).digest():
            raise ValueError("the segment was written with another dictionary")
        n = int.from_bytes(data[40:48], "little")
        kinds = enumerate(("<i8", "<u8", "<u8"))
        self.ids, self.tokens, ends = (np.frombuffer(data, t, n, 48 + 8 * n * i) for i, t in kinds)
        self._from, self._data = 48 + 24 * n, memoryview(data)
        self._bounds = np.concatenate([[0], ends.astype(np.int64)])
        self._unpacker = zstandard.ZstdDecompressor(dict_data=dictionary)

    def __len__(self) -> int:
        return len(self.ids)

    def read(self, i: int) -> bytes:
        """The ids of the i-th document: decodes its frame alone."""
        a, b = self._from + self._bounds[i], self._from + self._bounds[i + 1]
        return self._unpacker.decompress(self._data[a:b])

    def find(self, doc_id: int) -> list[bytes]:
        return [self.read(i) for i in range(*np.searchsorted(self.ids, [doc_id, doc_id + 1]))]


def _encode(batch: pa.RecordBatch, tokenizer: str, end_id: int) -> Iterator[tuple[list, list[bytes]]]:
    encode, end = encoder(tokenizer), end_id.to_bytes(4, "little")
    for at in range(0, batch.num_rows, 128):
        texts = [x.as_py() or "" for x in batch.column(1)[at : at + 128]]
        ids = [NO_ID if x is None else x for x in batch.column(0)[at : at + 128].to_pylist()]
        yield ids, [x + end for x in encode.encode(texts)]


def fit_dictionary(docs: DataFrame, tokenizer: str, end_id: int, text: str = "text") -> bytes:
    """A dictionary from the documents whose ids have the least hashes: at most
    ``SAMPLE_DOCUMENTS``, each by at most ``SAMPLE_BYTES`` of its ids. Every document is
    compressed with it whole; the sample only decides how well.
    """
    chosen = docs.select(F.xxhash64("doc_id").alias("_hash")).orderBy("_hash").limit(SAMPLE_DOCUMENTS)
    bar = chosen.agg(F.max("_hash"), F.count("*")).first()
    if not bar[1]:
        return b""
    narrow = docs.where(F.xxhash64("doc_id") <= bar[0]).select("doc_id", f"`{text}`")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, encoded in _encode(batch, tokenizer, end_id):
                cut = [x[: SAMPLE_BYTES] for x in encoded]
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(cut, pa.binary())], ["doc_id", "ids"])

    sample = narrow.mapInArrow(windows, "doc_id long, ids binary").limit(SAMPLE_DOCUMENTS).collect()
    held = [bytes(r["ids"]) for r in sorted(sample, key=lambda r: (r["doc_id"], bytes(r["ids"])))]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, held).as_bytes()
    except zstandard.ZstdError:  # too few or too short documents to learn from
        return b"".join(held)[:DICTIONARY_BYTES]


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict:
    found = zstandard.ZstdCompressionDict(raw)
    if raw:
        found.precompute_compress(level=LEVEL)  # else every short frame would digest it anew
    return found


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int, text: str = "text") -> None:
    """Write ``docs`` as segments in ascending ``doc_id`` order, with the dictionary beside them.

    A null text has no ids but ``end_id``. Rows that repeat a ``doc_id`` are all written, in an
    order that their texts decide.
    """
    spark = docs.sparkSession
    raw = fit_dictionary(docs, tokenizer, end_id, text)
    spark.createDataFrame([(bytearray(raw),)], "dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary")
    narrow = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs[f"`{text}`"].alias("text"))
    ordered = narrow.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, dictionary = TaskContext.get().partitionId(), _dictionary(raw)
        segment, start, held_ids, held, size = 0, 0, [], [], 0

        def flush() -> pa.RecordBatch:
            n = sum(map(len, held)) // 4
            row = (part, segment, held_ids[0], held_ids[-1], start, n, pack_segment(held_ids, held, dictionary))
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = [x.split()[0] for x in _SEGMENTS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds)], names)

        for batch in batches:
            for ids, encoded in _encode(batch, tokenizer, end_id):
                held_ids += ids
                held += encoded
                size += sum(map(len, encoded))
                if size >= SEGMENT_BYTES:
                    out = flush()
                    yield out
                    segment, start, held_ids, held, size = segment + 1, start + out.column(5)[0].as_py(), [], [], 0
        if held:
            yield flush()

    # frames are compressed already
    ordered.mapInArrow(segments, _SEGMENTS).write.option("compression", "none").parquet(f"{path}/segments")


def _read(spark: SparkSession, path: str) -> tuple[DataFrame, bytes]:
    raw = bytes(spark.read.parquet(f"{path}/dictionary").first()[0])
    return spark.read.schema(_SEGMENTS).parquet(f"{path}/segments"), raw


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Every document from the segments: ``doc_id, start, n_tokens, ids``; ``start`` counts the
    tokens of all documents before it."""
    segments, raw = _read(spark, path)
    # one row per written partition: as many as the write had tasks, whatever the data
    parts = segments.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    base, at = {}, 0
    for r in parts:
        base[r["part"]] = at
        at += r["n"]

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary = _dictionary(raw)
        for batch in batches:
            for part, start, data in zip(*(batch.column(i) for i in range(3))):
                segment = Segment(data.as_py(), dictionary)
                starts = base[part.as_py()] + start.as_py() + np.cumsum(segment.tokens) - segment.tokens
                ids = pa.array([None if x == NO_ID else x for x in segment.ids.tolist()], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(starts.astype(np.int64)), pa.array(segment.tokens.astype(np.int64)),
                     pa.array([segment.read(i) for i in range(len(segment))], pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    return segments.select("part", "start_in_part", "data").mapInArrow(
        unpack, "doc_id long, start long, n_tokens long, ids binary"
    )


def lookup(spark: SparkSession, path: str, doc_id: int) -> list[bytes]:
    """The ids of one document: reads the segments whose range holds it and decodes one frame."""
    segments, raw = _read(spark, path)
    rows = segments.where((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id)).orderBy("part", "segment")
    dictionary = _dictionary(raw)
    return [x for r in rows.select("data").toLocalIterator() for x in Segment(bytes(r["data"]), dictionary).find(doc_id)]
