"""Reversible line dedup: sharded cuckoo filters backed by exact reference counts.

A line's key is the line without ASCII white space at both ends, A-Z in lower case. Keys of at
least ``MIN_KEY`` code points that are held by two documents or more lose all their lines but
those of the smallest id. The index keeps

* ``postings``: one row per key, document and change, +1 for an insertion and -1 for a deletion,
  so reference counts are exact sums and a deletion brings a line back where it was dropped;
* ``shared``: keys with two live documents or more, their count and smallest id;
* ``filters``: one cuckoo filter per shard over the shared keys. Lines that miss the filter stay
  without a look at any table; only hits meet ``shared``, which settles them exactly.

All tables are written under one folder, a generation per change, so that lost executors and
retried tasks read what was written. ``log`` has a row per generation that is complete: a later job
that opens the index goes on from there, and what a failed change left is never read.
"""

from __future__ import annotations

import hashlib
import math
import struct
from collections.abc import Iterable, Iterator
from functools import reduce
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tierstone.llm.cuckoo import CuckooFilter

# Fixed values of the contract: white space stripped from lines, code points of a shared key.
SPACE = b" \t\n\v\f\r"
MIN_KEY = 10

KEYS_PER_SHARD = 1_000_000
BROADCAST_BYTES = 64 << 20
ROWS_PER_PROBE = 1_000_000
_LAST = 2**63 - 1
_KEYS = "doc_id long, k1 long, k2 long"
_LOG = "generation long, token string, shards int"


def ident(doc_id: Column) -> Column:
    """Documents without an id count as one document, after all others."""
    return F.coalesce(doc_id.cast("long"), F.lit(_LAST))


def _key(line: bytes) -> bytes | None:
    key = line.strip(SPACE).lower()
    if len(key) < MIN_KEY or (len(key) < 4 * MIN_KEY and len(key.decode("utf-8")) < MIN_KEY):
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


def _halves(digests: Iterable[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)


def shard_of(k1: Column, shards: int) -> Column:
    return F.pmod(F.shiftright(k1, 20), F.lit(shards)).cast("int")


def _shards_of(k1: np.ndarray, shards: int) -> np.ndarray:
    return (k1 >> 20) % shards


def _emit_keys(batches: Iterator[pa.RecordBatch], filters: dict[int, bytes] | None) -> Iterator[pa.RecordBatch]:
    """One row per document and distinct key; with ``filters`` only keys that they hold."""
    shards = len(filters) if filters else 0
    loaded = {k: CuckooFilter.from_bytes(v) for k, v in (filters or {}).items()}
    for batch in batches:
        ids, texts = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).cast(pa.binary())
        for at in range(0, len(ids), 512):
            found, owners = [], []
            for doc_id, text in zip(ids[at : at + 512], texts[at : at + 512]):
                keys = {_key(x) for x in (text.as_py() or b"").split(b"\n")} - {None}
                found += sorted(keys)
                owners.append(np.full(len(keys), doc_id, dtype=np.int64))
            if not found:
                continue
            k, doc = _halves(found), np.concatenate(owners)
            if filters:
                hit = np.zeros(len(k), dtype=bool)
                shard = _shards_of(k[:, 0], shards)
                for s in np.unique(shard):
                    rows = np.flatnonzero(shard == s)
                    hit[rows] = loaded[int(s)].contains(k[rows, 0])
                k, doc = k[hit], doc[hit]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc), pa.array(k[:, 0]), pa.array(k[:, 1])], ["doc_id", "k1", "k2"]
            )


def line_keys(docs: DataFrame, filters: dict[int, bytes] | None = None, text: str = "text") -> DataFrame:
    """``doc_id, k1, k2``: the distinct keys of each document, halves of a 128-bit digest."""
    narrow = docs.select(ident(docs["doc_id"]).alias("doc_id"), docs[f"`{text}`"].alias("text"))
    return narrow.mapInArrow(lambda batches: _emit_keys(batches, filters), _KEYS)


_CLEANED = StructType(
    [StructField("text", StringType()), StructField("n_lines", LongType()), StructField("n_dropped", LongType())]
)


@F.arrow_udf(_CLEANED)
def _without(texts: pa.Array, dropped: pa.Array) -> pa.Array:
    """Texts without the lines whose digests are listed."""
    out, lines_of, lost = [], [], []
    for text, gone in zip(texts.cast(pa.binary()), dropped):
        lines = (text.as_py() or b"").split(b"\n")
        keep = lines
        if gone.is_valid and len(gone.values):
            drop = {struct.pack("<qq", x["k1"], x["k2"]) for x in gone.as_py()}
            keep = [x for x in lines if _key(x) not in drop]
        out.append(b"\n".join(keep).decode("utf-8"))
        lines_of.append(len(lines))
        lost.append(len(lines) - len(keep))
    return pa.StructArray.from_arrays(
        [pa.array(out, pa.string()), pa.array(lines_of, pa.int64()), pa.array(lost, pa.int64())],
        ["text", "n_lines", "n_dropped"],
    )


# a filter on the result must not be pushed below the function, which would then run twice
_without = _without.asNondeterministic()


class LineIndex:
    """The index under ``path``, on storage that all executors share. One writer at a time.

    Opened where there is one already, it has that one's lines and shards. A change counts the keys
    that it names anew and touches the filters of their shards; the other postings are read for
    those keys, but not shuffled.
    """

    def __init__(self, spark: SparkSession, path: str, shards: int | None = None):
        self.spark, self.path, self.shards = spark, path.rstrip("/"), shards
        self.broadcast_bytes, self.keys_per_shard = BROADCAST_BYTES, KEYS_PER_SHARD
        self._tokens: list[str] = []  # of the generations, from the first on
        try:
            log = spark.read.schema(_LOG).parquet(f"{self.path}/log").orderBy("generation").collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return
        if [r["generation"] for r in log] != list(range(1, len(log) + 1)):
            raise RuntimeError(f"{self.path}: two writers changed the index at once")
        if log:
            self._tokens, self.shards = [r["token"] for r in log], log[-1]["shards"]

    @property
    def generation(self) -> int:
        return len(self._tokens)

    def _at(self, table: str, generation: int | None = None) -> str:
        generation = generation or self.generation
        if not generation:
            raise LookupError(f"no line index at {self.path}")
        return f"{self.path}/{table}/{generation}-{self._tokens[generation - 1]}"

    def _postings(self, *generations: int) -> DataFrame:
        schema = f"{_KEYS}, change int"
        parts = [self.spark.read.schema(schema).parquet(self._at("postings", g)) for g in generations]
        return reduce(DataFrame.union, parts)

    def _all_postings(self) -> DataFrame:
        return self._postings(*range(1, self.generation + 1))

    @staticmethod
    def _live(postings: DataFrame) -> DataFrame:
        return postings.groupBy("k1", "k2", "doc_id").agg(F.sum("change").alias("n")).where("n > 0")

    @staticmethod
    def _counts(live: DataFrame) -> DataFrame:
        counted = live.groupBy("k1", "k2").agg(
            F.count("*").alias("refs"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")
        )
        return counted.where("first_id < last_id").drop("last_id")

    def insert(self, docs: DataFrame, text: str = "text") -> None:
        """Count the lines of ``docs``. Ids must be new to the index."""
        self._change(line_keys(docs, text=text).withColumn("change", F.lit(1)))

    def delete(self, doc_ids: DataFrame) -> None:
        """Take back documents by ``doc_id``; lines that only they had kept come back elsewhere.

        Raises ``LookupError`` where there is no index."""
        self._at("postings")
        gone = doc_ids.select(ident(doc_ids["doc_id"]).alias("doc_id")).distinct()
        live = self._live(self._all_postings().join(gone, "doc_id", "left_semi"))
        self._change(live.select("doc_id", "k1", "k2", (-F.col("n")).cast("int").alias("change")))

    def _change(self, postings: DataFrame) -> None:
        before, shards = list(self._tokens), self.shards
        self._tokens = [*before, uuid4().hex[:12]]
        try:
            postings.write.parquet(self._at("postings"))
            if not before:
                # the rows of one insertion are distinct per document already, so they need no sum first
                self._counts(self._postings(1)).write.parquet(self._at("shared"))
                self._write_filters()
            else:
                keys = self._postings(self.generation).select("k1", "k2").distinct()
                live = self._live(self._all_postings().join(keys, ["k1", "k2"], "left_semi"))
                others = self._shared(len(before)).join(keys, ["k1", "k2"], "left_anti")
                others.unionByName(self._counts(live)).write.parquet(self._at("shared"))
                self._write_filters(len(before), keys)
            log = self.spark.createDataFrame([(self.generation, self._tokens[-1], self.shards)], _LOG)
            log.coalesce(1).write.mode("append").parquet(f"{self.path}/log")
        except BaseException:
            self._tokens, self.shards = before, shards
            raise

    def _shared(self, generation: int | None = None) -> DataFrame:
        schema = "k1 long, k2 long, refs long, first_id long"
        return self.spark.read.schema(schema).parquet(self._at("shared", generation))

    def _write_filters(self, old: int = 0, changed: DataFrame | None = None) -> None:
        """Filters over the shared keys: those of generation ``old``, put right in the shards of the
        ``changed`` keys. All are made anew, with more shards, once there are too many keys for them."""
        shared = self._shared()
        n = shared.count()
        if self.shards is None or n > 2 * self.keys_per_shard * self.shards:
            self.shards, old = 1 << max(3, math.ceil(math.log2(max(1, n) / self.keys_per_shard))), 0
        shards = self.shards
        every = self.spark.range(shards).select(F.col("id").cast("int").alias("shard"))
        now = shared.select(shard_of(F.col("k1"), shards).alias("shard"), "k1", F.lit(1).alias("now"))
        kept = None
        if old:
            touched = [r["shard"] for r in changed.select(shard_of(F.col("k1"), shards).alias("shard")).distinct().collect()]
            held = self._filters(old)
            blobs, kept = held.where(F.col("shard").isin(touched)), held.where(~F.col("shard").isin(touched))
            before = self._shared(old).select(shard_of(F.col("k1"), shards).alias("shard"), "k1", F.lit(1).alias("before"))
            here = F.col("shard").isin(touched)
            keys = before.where(here).join(now.where(here), ["shard", "k1"], "full_outer")
        else:
            keys = now.withColumn("before", F.lit(None).cast("int"))
            blobs = every.withColumn("blob", F.lit(None).cast("binary"))

        def apply(key, keys: pd.DataFrame, blob: pd.DataFrame) -> pd.DataFrame:
            held = blob["blob"].iloc[0] if len(blob) else None
            has_now, had = keys["now"].notna(), keys["before"].notna()
            filter_ = CuckooFilter.from_bytes(held) if held is not None else CuckooFilter(2 * len(keys))
            added = keys.loc[has_now & ~had, "k1"].to_numpy(np.int64)
            filter_.delete(keys.loc[had & ~has_now, "k1"].to_numpy(np.int64))
            if not filter_.insert(added):
                live = keys.loc[has_now, "k1"].to_numpy(np.int64)
                size = 2 * len(live)
                filter_ = CuckooFilter(size)
                while not filter_.insert(live):
                    size *= 2
                    filter_ = CuckooFilter(size)
            return pd.DataFrame({"shard": [int(key[0])], "blob": [filter_.to_bytes()]})

        filters = (
            keys.groupBy("shard").cogroup(blobs.groupBy("shard")).applyInPandas(apply, "shard int, blob binary")
        )
        (filters if kept is None else filters.unionByName(kept)).write.parquet(self._at("filters"))

    def _filters(self, generation: int | None = None) -> DataFrame:
        return self.spark.read.schema("shard int, blob binary").parquet(self._at("filters", generation))

    def _hits(self, docs: DataFrame, text: str) -> DataFrame:
        """Keys of the documents that the filters hold."""
        filters, shards = self._filters(), self.shards
        size = filters.agg(F.sum(F.length("blob"))).first()[0] or 0
        if size <= self.broadcast_bytes:
            return line_keys(docs, {r["shard"]: r["blob"] for r in filters.collect()}, text)
        keys = line_keys(docs, text=text)
        rows = self._all_postings().count()
        salts = max(1, math.ceil(4 * rows / shards / ROWS_PER_PROBE))
        dealt = keys.withColumn("shard", shard_of(F.col("k1"), shards)).withColumn(
            "salt", F.pmod(F.xxhash64("doc_id", "k2"), F.lit(salts)).cast("int")
        )
        copies = filters.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))

        def probe(keys: pd.DataFrame, blob: pd.DataFrame) -> pd.DataFrame:
            held = CuckooFilter.from_bytes(blob["blob"].iloc[0]).contains(keys["k1"].to_numpy(np.int64)) if len(keys) else []
            return keys.loc[held, ["doc_id", "k1", "k2"]]

        return dealt.groupBy("shard", "salt").cogroup(copies.groupBy("shard", "salt")).applyInPandas(probe, _KEYS)

    def resolve(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """``docs`` with struct ``_lines``: ``text`` without dropped lines, ``n_lines``, ``n_dropped``.

        A null or empty text is one empty line. Of rows that repeat a ``doc_id`` none counts as
        another document. A column named ``_lines`` in ``docs`` is replaced.
        """
        own = [c for c in docs.columns if c != "_lines"]
        hits = self._hits(docs, text).join(self._shared(), ["k1", "k2"]).where("first_id < doc_id")
        drops = hits.groupBy(F.col("doc_id").alias("_id")).agg(F.collect_set(F.struct("k1", "k2")).alias("_drops"))
        whole = docs.select(F.struct(*[docs[f"`{c}`"] for c in own]).alias("_row"), ident(docs["doc_id"]).alias("_id"))
        joined = whole.join(drops, "_id", "left")
        return joined.select(
            *[F.col(f"_row.`{c}`").alias(c) for c in own],
            _without(F.col(f"_row.`{text}`"), F.col("_drops")).alias("_lines"),
        )


def dedup(docs: DataFrame, path: str, text: str = "text", drop_emptied: bool = False) -> DataFrame:
    """Documents without the lines that an earlier document holds; columns as in ``docs``.

    With ``drop_emptied``, documents go of which no word is left; those that had none on arrival
    stay. Without, no document goes. ``n_chars``, if there is one, is counted anew; a null text
    stays null.
    """
    index = LineIndex(docs.sparkSession, path)
    index.insert(docs, text)
    df = index.resolve(docs, text)
    if drop_emptied:
        df = df.where((F.col("_lines.n_dropped") == 0) | F.col("_lines.text").rlike(r"[^\x20\x09-\x0D]"))
    cleaned = F.when(F.col(f"`{text}`").isNotNull(), F.col("_lines.text"))
    new = {text: cleaned}
    if "n_chars" in docs.columns and text != "n_chars":
        new["n_chars"] = F.length(cleaned).cast(docs.schema["n_chars"].dataType)
    return df.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns if c != "_lines"])
