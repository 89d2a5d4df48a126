"""Near-duplicate groups by SetSketch registers, joint likelihood and verified links.

A document's set is its distinct runs of five words. A register keeps the truncated logarithm of
the least of exponentially distributed hashes of the set, so registers of a union are the maxima
of the registers, and two registers agree about as often as the sets overlap. Bands of registers
put similar sets in the same bucket; the joint maximum likelihood estimate from all registers
drops pairs that are far from the bar; what is left is confirmed on full sets.

Equal sets are one node from the start. In a bucket every member is paired with the one that
shares the most buckets with others, never with all, so a bucket of copies costs one pair per
member. Buckets that still hold two groups after that are searched in blocks of registers; only
pairs across groups whose estimate is near the bar come out of that search.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.llm.components import components
from tierstone.llm.words import WordHasher, mix, shingles, text_blocks
from tierstone.sources import stage

_U = np.uint64


@dataclass(frozen=True)
class Sketch:
    """Shape of the sketch. 40 bands of 4 miss a pair at similarity 0.75 about twice in ten million
    times, and an estimate from 256 registers falls short by ``slack`` once in a million."""

    shingle: int = 5
    bands: int = 40
    words: int = 64  # 64-bit words of four 16-bit registers; the first ``bands`` are the bands
    base: float = 1.001
    rate: float = 20.0
    percent: int = 75
    slack: float = 0.13
    block: int = 512
    together: int = 1000

    @property
    def registers(self) -> int:
        return self.words * 4

    @property
    def least_likely(self) -> float:
        return self.percent / 100 - self.slack

    def multipliers(self) -> np.ndarray:
        return mix(np.arange(1, self.registers + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)) | _U(1)


def registers(hashes: np.ndarray, sketch: Sketch, multipliers: np.ndarray) -> np.ndarray:
    """Truncated logarithms of the least exponential hash of each register, as uint16."""
    least = np.full(sketch.registers, np.iinfo(np.uint64).max, dtype=np.uint64)
    for a in range(0, len(hashes), 128):
        np.minimum(least, (hashes[a : a + 128, None] * multipliers).min(axis=0), out=least)
    uniform = (least.astype(np.float64) + 0.5) / 2.0**64
    x = -np.log1p(-np.minimum(uniform, 1 - 2.0**-53)) / sketch.rate
    k = np.floor(1 - np.log(x) / np.log(sketch.base))
    return np.clip(k, 0, 65535).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def likely_similarity(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, base: float) -> np.ndarray:
    """Maximum likelihood estimates of the similarity from registers (pairs x registers) and sizes."""
    above, below = (a > b).sum(axis=1), (a < b).sum(axis=1)
    equal = a.shape[1] - above - below
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)

    def p(x):
        return -np.log1p(-x * (base - 1) / base) / np.log(base)

    def loss(j):
        up, down = p(np.maximum(u - v * j, 0)), p(np.maximum(v - u * j, 0))
        tiny = 1e-12
        return -(
            above * np.log(np.maximum(up, tiny))
            + below * np.log(np.maximum(down, tiny))
            + equal * np.log(np.maximum(1 - up - down, tiny))
        )

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(40):  # the likelihood has one peak
        third = (high - low) / 3
        right = loss(low + third) > loss(high - third)
        low, high = np.where(right, low + third, low), np.where(right, high, high - third)
    return (low + high) / 2


def _sketch_rows(batches: Iterator[pa.RecordBatch], sketch: Sketch) -> Iterator[pa.RecordBatch]:
    hasher, multipliers = WordHasher(), sketch.multipliers()
    packer, number = zstandard.ZstdCompressor(level=1), TaskContext.get().partitionId() << 33
    for batch in batches:
        for a, b, data, ends in text_blocks(batch, 2):
            words, word_ends = hasher.words(data, ends)
            n, s1, s2, bands, packed, w, t = [], [], [], [], [], 0, 0
            for word_end, end in zip(word_ends.tolist(), ends.tolist()):
                hashes = np.unique(shingles(words[w:word_end], sketch.shingle))
                n.append(len(hashes))
                if len(hashes):
                    key = np.frombuffer(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest(), "<i8")
                    s1.append(key[0]), s2.append(key[1])
                    bands.append(registers(hashes, sketch, multipliers).view(np.int64))
                    packed.append(packer.compress(data[t:end].tobytes()))
                else:
                    s1.append(0), s2.append(0), bands.append(None), packed.append(None)
                w, t = word_end, end
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(n, pa.int64()),
                    pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(bands, pa.list_(pa.int64())),
                    pa.array(packed, pa.binary()), pa.array(range(number, number + len(n)), pa.int64()),
                ],
                ["key", "doc", "n", "s1", "s2", "bands", "packed", "id"],
            )
            number += len(n)


def sketches(docs: DataFrame, sketch: Sketch = Sketch(), text: str = "text") -> DataFrame:
    """Per row: ``key``, ``doc``, set size ``n``, set digest ``s1, s2``, packed registers and text.

    ``doc`` is the ``doc_id``, ``key`` what tells documents apart: the id, or for rows without one
    the digest of their text. Without words, registers and text are null.
    """
    narrow = docs.select(identity(docs, text).alias("key"), docs["doc_id"].cast("long").alias("doc"), docs[f"`{text}`"].alias("text"))
    return narrow.mapInArrow(
        lambda batches: _sketch_rows(batches, sketch),
        "key string, doc long, n long, s1 long, s2 long, bands array<bigint>, packed binary, id long",
    )


def identity(docs: DataFrame, text: str) -> Column:
    """The id of a row as text, or the digest of its text, so that unrelated rows stay apart."""
    own = F.concat(F.lit("text:"), F.md5(F.coalesce(docs[f"`{text}`"], F.lit("")).cast("binary")))
    return F.coalesce(docs["doc_id"].cast("long").cast("string"), own)


def _set_of(packed: bytes, hasher: WordHasher, size: int) -> np.ndarray:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), dtype=np.uint8)
    words, _ = hasher.words(data, np.array([len(data)]))
    return np.unique(shingles(words, size))


def _verified(batches: Iterator[pa.RecordBatch], sketch: Sketch) -> Iterator[pa.RecordBatch]:
    """Pairs whose full sets reach the bar."""
    hasher, last, held = WordHasher(), None, None
    for batch in batches:
        col = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        regs = [
            np.asarray(col[c].flatten()).view(np.uint16).reshape(-1, sketch.registers) for c in ("bands_a", "bands_b")
        ]
        n_a, n_b = (col[c].to_numpy().astype(np.float64) for c in ("n_a", "n_b"))
        likely = likely_similarity(*regs, n_a, n_b, sketch.base) if len(n_a) else np.zeros(0)
        keep = np.zeros(len(likely), dtype=bool)
        ids = col["a"].to_numpy()
        for i in np.flatnonzero(likely >= sketch.least_likely):
            if last != ids[i]:
                last, held = ids[i], _set_of(col["packed_a"][i].as_py(), hasher, sketch.shingle)
            other = _set_of(col["packed_b"][i].as_py(), hasher, sketch.shingle)
            both = len(np.intersect1d(held, other, assume_unique=True))
            keep[i] = 100 * both >= sketch.percent * (len(held) + len(other) - both)
        kept = pa.array(keep)
        yield pa.RecordBatch.from_arrays([col["a"].filter(kept), col["b"].filter(kept)], ["a", "b"])


def _confirm(pairs: DataFrame, sets: DataFrame, sketch: Sketch) -> DataFrame:
    """``a, b`` of the pairs that are similar enough. ``sets``: staged sketches."""
    full = sets.where("n > 0").select("id", "n", "bands", "packed")

    def side(name: str) -> DataFrame:
        return full.toDF(name, f"n_{name}", f"bands_{name}", f"packed_{name}")

    joined = pairs.join(side("b"), "b").join(side("a"), "a")
    near = joined.where(f"100 * least(n_a, n_b) >= {sketch.percent} * greatest(n_a, n_b)")
    return near.mapInArrow(lambda batches: _verified(batches, sketch), "a long, b long")


def _bucket(position: Column, band: Column) -> Column:
    return F.xxhash64(position, band)


def near_duplicates(docs: DataFrame, sketch: Sketch = Sketch(), text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id``.

    ``component_id`` is the least id reachable over links of at least ``sketch.percent``. Texts
    without words are linked with nothing. Rows are linked by their texts alone, so those that
    repeat an id, or have none, are documents of their own; a group without any id has a null
    component.
    """
    found = _grouped(docs, sketch, text)
    return found.select(
        F.col("doc").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least_doc")).otherwise(F.col("doc")).alias("component_id"),
    )


def _grouped(docs: DataFrame, sketch: Sketch, text: str) -> DataFrame:
    """Per row: ``key, doc, n``, and of its group the least id, ``least_doc``, and the least
    key of the rows without an id, ``least_key``."""
    sets = stage(sketches(docs, sketch, text), "sketches")
    unnamed = F.when(F.col("doc").isNull(), F.col("key"))
    classes = stage(
        sets.where("n > 0").groupBy("s1", "s2").agg(
            F.min("id").alias("rep"), F.any_value("n").alias("n"), F.any_value("bands").alias("bands"),
            F.min("doc").alias("least_doc"), F.min(unnamed).alias("least_key"),
        ),
        "classes",
    )
    rows = classes.select("rep", "n", F.posexplode(F.slice("bands", 1, sketch.bands))).select(
        _bucket(F.col("pos"), F.col("col")).alias("bucket"), F.col("pos").alias("band"), "rep", "n"
    )
    shared = stage(rows.groupBy("bucket").agg(F.count("*").alias("c")).where("c > 1"), "buckets")
    members = stage(rows.join(shared, "bucket"), "members")
    star = stage(_star(members), "star")
    pairs = star.where(_sizes_allow("n_a", "n_b", sketch)).select("a", "b").distinct()
    links = stage(_confirm(pairs, sets, sketch), "links")
    found = components(links, "groups")

    extra = stage(_across(members, star, found, sets, sketch), "more_links")
    if extra.limit(1).count():
        found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(extra), "groups")

    # groups of several classes are few: what they share is found apart from all the others
    ends = found.union(found.select("component", "component").distinct()).toDF("rep", "component")
    linked = stage(classes.select("rep", "least_doc", "least_key").join(ends, "rep"), "linked")
    least = linked.groupBy("component").agg(F.min("least_doc").alias("_doc"), F.min("least_key").alias("_key"))
    of = linked.select("rep", "component").join(least, "component").drop("component").withColumn("_many", F.lit(True))
    named = classes.join(of, "rep", "left").select(
        "s1", "s2", *[F.when(F.col("_many"), F.col(x)).otherwise(F.col(y)).alias(y) for x, y in (("_doc", "least_doc"), ("_key", "least_key"))]
    )
    # one row per document: a copy of a hot set moves by its digest, which a skewed join splits
    return sets.select("key", "doc", "n", "s1", "s2").join(stage(named, "reps"), ["s1", "s2"], "left")


def _sizes_allow(n: str, m: str, sketch: Sketch) -> str:
    return f"100 * least({n}, {m}) >= {sketch.percent} * greatest({n}, {m})"


def _star(members: DataFrame) -> DataFrame:
    """``bucket, a, n_a, b, n_b``: each member ``b`` with its bucket's center ``a``.

    The center is the member that meets the most others over all its buckets: of edited copies
    and their original that is the original, which is the nearest to all.
    """
    meets = stage(members.groupBy("rep").agg(F.sum("c").alias("meets")), "meets")
    ranked = members.join(meets, "rep")
    centers = stage(
        ranked.groupBy("bucket").agg(F.max(F.struct("meets", (-F.col("rep")).alias("minus"), "n")).alias("top"))
        .select("bucket", (-F.col("top.minus")).alias("a"), F.col("top.n").alias("n_a")),
        "centers",
    )
    joined = members.join(centers, "bucket").where("rep != a")
    return joined.select("bucket", "a", "n_a", F.col("rep").alias("b"), F.col("n").alias("n_b"))


def _linked(left: pd.DataFrame, right: pd.DataFrame, sketch: Sketch) -> pd.DataFrame:
    """Confirmed links between different groups, one end from each side of a bucket.

    A pair that shares several buckets is looked at in the first of them alone. Registers rule
    most pairs out; sets are made once for each member that is left.
    """
    left, right = left.sort_values("bucket"), right.sort_values("bucket")
    bands_x, bands_y = (np.stack(side["bands"].to_list()) for side in (left, right))
    x, y = bands_x.view(np.uint16), bands_y.view(np.uint16)
    id_x, n_x, g_x, band, bucket = (left[c].to_numpy(np.int64) for c in ("rep", "n", "g", "band", "bucket"))
    id_y, n_y, g_y, buckets = (right[c].to_numpy(np.int64) for c in ("rep", "n", "g", "bucket"))
    begin, end = np.searchsorted(buckets, bucket), np.searchsorted(buckets, bucket, side="right")
    # two registers are equal at least as often as the sets overlap, so few equal ones rule a pair out
    bar, ends = sketch.least_likely * sketch.registers, []
    for i, (a, b, k) in enumerate(zip(begin.tolist(), end.tolist(), band.tolist())):
        large, small = np.maximum(n_y[a:b], n_x[i]), np.minimum(n_y[a:b], n_x[i])
        some = a + np.flatnonzero((g_y[a:b] != g_x[i]) & (100 * small >= sketch.percent * large))
        if len(some):
            some = some[(y[some] == x[i]).sum(axis=1) >= bar]
            some = some[(bands_y[some, :k] != bands_x[i, :k]).all(axis=1)]
            ends.append(np.stack([np.full(len(some), i), some]))
    at, to = np.concatenate(ends, axis=1) if ends else np.zeros((2, 0), np.int64)
    hasher, sets, found = WordHasher(), {}, []

    def set_of(side: pd.DataFrame, where: int) -> np.ndarray:
        ident = (side is left, where)
        if ident not in sets:
            sets[ident] = _set_of(side["packed"].iloc[where], hasher, sketch.shingle)
        return sets[ident]

    for a in range(0, len(at), 8192):
        i, j = at[a : a + 8192], to[a : a + 8192]
        likely = likely_similarity(x[i], y[j], n_x[i].astype(np.float64), n_y[j].astype(np.float64), sketch.base)
        near = likely >= sketch.least_likely
        for p, q in zip(i[near].tolist(), j[near].tolist()):
            held, other = set_of(left, p), set_of(right, q)
            both = len(np.intersect1d(held, other, assume_unique=True))
            if 100 * both >= sketch.percent * (len(held) + len(other) - both):
                found.append((min(id_x[p], id_y[q]), max(id_x[p], id_y[q])))
    return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)


def _across(members: DataFrame, star: DataFrame, found: DataFrame, sets: DataFrame, sketch: Sketch) -> DataFrame:
    """Links ``a, b`` between members of one bucket that are not in one group yet.

    A bucket is searched if one of its members is not in its center's group. Members outside the
    bucket's largest group, dealt in blocks, meet blocks of all its members.
    """
    of = found.toDF("_id", "_g")

    def grouped(df: DataFrame, id_: str, name: str) -> DataFrame:
        joined = df.join(of, F.col(id_) == F.col("_id"), "left")
        return joined.withColumn(name, F.coalesce("_g", id_)).drop("_g", "_id")

    apart = grouped(grouped(star.select("bucket", "a", "b"), "a", "g_a"), "b", "g_b").where("g_a != g_b")
    mixed = stage(apart.select("bucket").distinct(), "mixed")
    inside = stage(grouped(members.join(mixed, "bucket", "left_semi"), "rep", "g"), "mixed_members")
    largest = (
        inside.groupBy("bucket", "g").agg(F.count("*").alias("k"))
        .groupBy("bucket").agg(F.max(F.struct("k", "g")).alias("top")).select("bucket", F.col("top.g").alias("main"))
    )
    blocks = F.greatest(F.lit(1), F.ceil(F.col("c") / sketch.block))
    inside = stage(
        inside.join(stage(largest, "largest"), "bucket").select(
            "bucket", "band", "rep", "n", "g", (F.col("g") != F.col("main")).alias("odd"),
            F.pmod(F.xxhash64("rep"), blocks).alias("block"), blocks.alias("blocks"),
        ),
        "mixed_blocks",
    )
    # buckets of one block share calls of about ``together`` members; larger ones have calls of their own
    calls = max(1, inside.where("blocks = 1").count() // sketch.together)
    shared_call = F.pmod("bucket", F.lit(calls))
    inside = inside.withColumn("call", F.when(F.col("blocks") > 1, F.col("bucket")).otherwise(shared_call))
    inside = inside.join(sets.select(F.col("id").alias("rep"), "bands", "packed"), "rep")
    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    common = ("call", "blocks", "bucket", "band", "rep", "n", "g", "bands", "packed")
    odd = inside.where("odd").select(*common, F.col("block").alias("i"), F.explode(every).alias("j"))
    all_ = inside.select(*common, F.explode(every).alias("i"), F.col("block").alias("j"))
    all_ = all_.toDF(*all_.columns)  # fresh columns: both sides come from one table

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        return _linked(left, right, sketch)

    keys = ("call", "blocks", "i", "j")
    return odd.groupBy(*keys).cogroup(all_.groupBy(*keys)).applyInPandas(search, "a long, b long").distinct()


def keep_first(docs: DataFrame, sketch: Sketch = Sketch(), text: str = "text") -> DataFrame:
    """The documents whose id is the least of their group; columns as in ``docs``.

    Rows without an id come last: one text of a group without ids stays, that of the least digest.
    Rows with one id, or without one and of one text, are one document: they stay or go together.
    """
    found = _grouped(docs, sketch, text)
    first = F.coalesce(F.col("least_doc").cast("string"), F.col("least_key"))
    # an id stays if any of its rows is the first of its group
    gone = found.groupBy(F.col("key").alias("_gone")).agg(F.max((F.col("n") == 0) | (F.col("key") == first)).alias("_stays"))
    return docs.join(stage(gone.where("not _stays").select("_gone"), "gone"), identity(docs, text) == F.col("_gone"), "left_anti")
