"""Jaccard join of documents on word n-grams by rare-first prefixes.

Two sets whose overlap reaches the bar share an element among the first few of each, whatever
order all sets are sorted by. With rare elements first, those prefixes meet little by chance:

1. Texts are kept in blocks. A block sends every distinct n-gram to the slot of its hash, with the
   number of documents of the block that hold it; slots add up and send document frequencies back.
   So a frequent n-gram costs one entry per block.
2. A document's n-grams are ordered by frequency, then hash. Those of its prefix that another
   document holds too are its keys; most documents have none and are done.
3. Sets are joined on their keys. Length, position and suffix filters bound the overlap: what
   follows the key on either side, and how it spreads over ``CELLS`` ranges of hashes. What is left
   is verified on full sets, once per pair.

Equal sets are one class from the start. A key that many classes hold is not expanded into all
pairs: every member is first paired with the one that meets the most others, and only where
members are still apart after that are those outside the largest group compared with the others,
in blocks.
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
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstone.llm.components import components
from tierstone.llm.words import WordHasher, shingles, text_blocks
from tierstone.sources import stage

BLOCK_BYTES = 16 << 20
SLOT_GRAMS = 250_000
CELLS = 128
MEMBERS = 1024  # of one key that are compared in one call
_ROW_BITS = 20
_U = np.uint64


@dataclass(frozen=True)
class Bar:
    """Sets of runs of ``size`` words are linked at ``percent`` of a hundred common to all."""

    size: int = 4
    percent: int = 85

    def prefix(self, n: int) -> int:
        """How many of ``n`` elements can be left out of a prefix that a linked set meets, and one."""
        return n - -(-self.percent * n // 100) + 1

    def overlap(self, n: np.ndarray, m: np.ndarray) -> np.ndarray:
        """The least overlap of linked sets of these sizes."""
        return -(-self.percent * (n + m) // (100 + self.percent))

    def lengths(self, n: str, m: str) -> str:
        return f"100 * least({n}, {m}) >= {self.percent} * greatest({n}, {m})"

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        both = len(np.intersect1d(a, b, assume_unique=True))
        return 100 * both >= self.percent * (len(a) + len(b) - both)


_BLOCK = "block long, ids array<long>, n array<long>, s1 array<long>, s2 array<long>, packed array<binary>"


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Rows of documents packed together: ids, set sizes, set digests and compressed texts."""
    hasher, packer, number = WordHasher(), zstandard.ZstdCompressor(level=1), TaskContext.get().partitionId() << 22
    names = [x.split()[0] for x in _BLOCK.split(", ")]
    held, weight = [[] for _ in names[1:]], 0

    def flush() -> pa.RecordBatch:
        kinds = [pa.list_(pa.int64())] * 4 + [pa.list_(pa.binary())]
        columns = [pa.array([number], pa.int64()), *(pa.array([x], t) for x, t in zip(held, kinds))]
        return pa.RecordBatch.from_arrays(columns, names)

    for batch in batches:
        for a, b, data, ends in text_blocks(batch, 1):
            words, word_ends = hasher.words(data, ends)
            w = t = 0
            for ident, word_end, end in zip(batch.column(0).slice(a, b - a).to_pylist(), word_ends.tolist(), ends.tolist()):
                grams = np.unique(shingles(words[w:word_end], size))
                key = np.frombuffer(hashlib.blake2b(grams.tobytes(), digest_size=16).digest(), "<i8").tolist()
                text = packer.compress(data[t:end].tobytes()) if len(grams) else None
                for column, value in zip(held, (ident, len(grams), *key, text)):
                    column.append(value)
                weight += end - t + (BLOCK_BYTES >> _ROW_BITS) + 1  # so a block never has 2^20 rows
                w, t = word_end, end
                if weight >= BLOCK_BYTES:
                    yield flush()
                    number, held, weight = number + 1, [[] for _ in names[1:]], 0
    if held[0]:
        yield flush()


def _grams(packed: bytes, hasher: WordHasher, size: int) -> np.ndarray:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), dtype=np.uint8)
    words, _ = hasher.words(data, np.array([len(data)]))
    return np.unique(shingles(words, size))


def _places(grams: np.ndarray, slots: int) -> np.ndarray:
    """Slot and mark of each n-gram, as one number. N-grams that share both count as one; that
    can only make them look more frequent, alike for all documents."""
    return (grams >> _U(32)) % _U(slots) << _U(32) | grams & _U(0xFFFFFFFF)


def _sets(texts: pa.ListScalar, hasher: WordHasher, size: int) -> list[np.ndarray | None]:
    return [None if x is None else _grams(x, hasher, size) for x in texts.as_py()]


def _distinct(sets: list[np.ndarray | None], slots: int) -> tuple[np.ndarray, np.ndarray]:
    some = [_places(x, slots) for x in sets if x is not None]
    return np.unique(np.concatenate(some), return_counts=True) if some else (np.zeros(0, _U), np.zeros(0, np.int64))


def _requests(batches: Iterator[pa.RecordBatch], size: int, slots: int) -> Iterator[pa.RecordBatch]:
    """Per block and slot: marks in order and how many documents of the block hold each."""
    hasher, packer = WordHasher(), zstandard.ZstdCompressor(level=1)
    for batch in batches:
        for block, texts in zip(batch.column(0), batch.column(1)):
            places, counts = _distinct(_sets(texts, hasher, size), slots)
            of = (places >> _U(32)).astype(np.int64)
            begin = np.flatnonzero(np.diff(of, prepend=-1))
            cut = list(zip(begin.tolist(), [*begin[1:].tolist(), len(of)]))
            marks, counts = places.astype("<u4"), counts.astype("<u4")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block.as_py()] * len(cut), pa.int64()), pa.array(of[begin]),
                    pa.array([marks[a:b].tobytes() for a, b in cut], pa.binary()),
                    pa.array([packer.compress(counts[a:b].tobytes()) for a, b in cut], pa.binary()),
                ],
                ["block", "slot", "marks", "counts"],
            )


def _frequencies(cells: pd.DataFrame) -> pd.DataFrame:
    """Replies of one slot: for each cell, the document frequency of its marks, in order."""
    packer, unpacker = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
    marks = [np.frombuffer(x, "<u4") for x in cells["marks"]]
    counts = [np.frombuffer(unpacker.decompress(x), "<u4") for x in cells["counts"]]
    _, at = np.unique(np.concatenate(marks), return_inverse=True)
    total = np.bincount(at, weights=np.concatenate(counts)).astype("<u4")[at]
    ends = np.cumsum([len(x) for x in marks]).tolist()
    found = [packer.compress(total[a:b].tobytes()) for a, b in zip([0, *ends], ends)]
    return pd.DataFrame({"block": cells["block"], "slot": cells["slot"], "found": found})


_KEYED = "row long, n long, keys array<struct<key:long,at:long,suffix:binary>>, packed binary"


def _keys(batches: Iterator[pa.RecordBatch], bar: Bar, slots: int) -> Iterator[pa.RecordBatch]:
    """Documents with a key: for each, its place in the order and the ranges of what follows it."""
    hasher, unpacker = WordHasher(), zstandard.ZstdDecompressor()
    for batch in batches:
        for block, texts, replies in zip(*map(batch.column, range(3))):
            sets = _sets(texts, hasher, bar.size)
            places, _ = _distinct(sets, slots)
            if not len(places):
                continue
            found = sorted((r["slot"], r["found"]) for r in replies.as_py())
            frequency = np.concatenate([np.frombuffer(unpacker.decompress(x), "<u4") for _, x in found])
            out = []
            for i, grams in enumerate(sets):
                if grams is None:
                    continue
                held_by = frequency[np.searchsorted(places, _places(grams, slots))]
                length = bar.prefix(len(grams))
                alone = int((held_by == 1).sum())
                if alone >= length:
                    continue
                order = np.lexsort((grams, held_by))
                cells = (grams[order] >> _U(57)).astype(np.int64)  # ``CELLS`` ranges by the highest bits
                left = np.bincount(cells, minlength=CELLS) - np.bincount(cells[:alone], minlength=CELLS)
                keys = []
                for at in range(alone, length):
                    left[cells[at]] -= 1
                    key = int(grams[order[at]].astype(np.int64))
                    keys.append({"key": key, "at": at, "suffix": np.minimum(left, 65535).astype("<u2").tobytes()})
                out.append(((block.as_py() << _ROW_BITS) + i, len(grams), keys, texts.values[i].as_py()))
            if out:
                kinds = [pa.int64(), pa.int64(), None, pa.binary()]
                key = pa.struct([("key", pa.int64()), ("at", pa.int64()), ("suffix", pa.binary())])
                kinds[2] = pa.list_(key)
                columns = [pa.array(x, t) for x, t in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in ("row", "n", "keys", "packed")])


def _may_link(n: np.ndarray, m: np.ndarray, at: np.ndarray, to: np.ndarray, left: np.ndarray, right: np.ndarray, bar: Bar) -> np.ndarray:
    """Position and suffix filter for pairs that share a key, should it be their first."""
    least = bar.overlap(n, m) - 1  # beyond the key
    keep = np.minimum(n - at, m - to) - 1 >= least
    some = np.flatnonzero(keep)
    full = (left[some] == 65535).any(axis=1) | (right[some] == 65535).any(axis=1)  # not counted to the end
    keep[some] = full | (np.minimum(left[some], right[some]).sum(axis=1, dtype=np.int64) >= least[some])
    return keep


def _suffixes(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, CELLS)


def _filtered(batches: Iterator[pa.RecordBatch], bar: Bar) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            col = dict(zip(batch.schema.names, batch.columns))
            numbers = [col[x].to_numpy() for x in ("n_a", "n_b", "at_a", "at_b")]
            keep = pa.array(_may_link(*numbers, _suffixes(col["suffix_a"]), _suffixes(col["suffix_b"]), bar))
            yield pa.RecordBatch.from_arrays([col["a"].filter(keep), col["b"].filter(keep)], ["a", "b"])


def _verified(batches: Iterator[pa.RecordBatch], bar: Bar) -> Iterator[pa.RecordBatch]:
    hasher, last, held = WordHasher(), None, None
    for batch in batches:
        a, b, packed_a, packed_b = map(batch.column, range(4))
        keep = []
        for i, ident in enumerate(a.to_pylist()):
            if last != ident:
                last, held = ident, _grams(packed_a[i].as_py(), hasher, bar.size)
            keep.append(bar.linked(held, _grams(packed_b[i].as_py(), hasher, bar.size)))
        kept = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([a.filter(kept), b.filter(kept)], ["a", "b"])


def _verify(pairs: DataFrame, keyed: DataFrame, bar: Bar) -> DataFrame:
    """The linked ones of distinct pairs ``a, b``."""
    sets = keyed.select("row", "packed")
    joined = pairs.join(sets.toDF("b", "packed_b"), "b").join(sets.toDF("a", "packed_a"), "a")
    rows = joined.select("a", "b", "packed_a", "packed_b")
    return rows.mapInArrow(lambda batches: _verified(batches, bar), "a long, b long")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _star(members: DataFrame) -> DataFrame:
    """Each member of a key with the one that meets the most others over all its keys."""
    meets = stage(members.groupBy("row").agg(F.sum("c").alias("meets")), "key_meets")
    top = F.max(F.struct("meets", (-F.col("row")).alias("minus"), "n", "at", "suffix")).alias("top")
    centers = stage(members.join(meets, "row").groupBy("key").agg(top), "key_centers").select(
        "key", (-F.col("top.minus")).alias("a"), F.col("top.n").alias("n_a"), F.col("top.at").alias("at_a"),
        F.col("top.suffix").alias("suffix_a"),
    )
    others = members.select("key", F.col("row").alias("b"), F.col("n").alias("n_b"), F.col("at").alias("at_b"), F.col("suffix").alias("suffix_b"))
    return others.join(centers, "key").where("a != b")


def _search(left: pd.DataFrame, right: pd.DataFrame, bar: Bar) -> pd.DataFrame:
    """Pairs of one key from both sides that are in different groups and pass the filters."""
    right = right.sort_values("key")
    keys, found = right["key"].to_numpy(), []
    suffixes = np.frombuffer(b"".join(right["suffix"]), "<u2").reshape(-1, CELLS)
    row, n, at, g = (right[x].to_numpy(np.int64) for x in ("row", "n", "at", "g"))
    odd = right["odd"].to_numpy(bool)
    begin, end = (np.searchsorted(keys, left["key"], side=x).tolist() for x in ("left", "right"))
    for x, a, b in zip(left.itertuples(), begin, end):
        small, large = np.minimum(n[a:b], x.n), np.maximum(n[a:b], x.n)
        apart = (g[a:b] != x.g) & (100 * small >= bar.percent * large)
        some = a + np.flatnonzero(apart & (~odd[a:b] | (row[a:b] > x.row)))  # both odd: from one side only
        if len(some):
            one = np.ones(len(some), dtype=np.int64)
            own = np.broadcast_to(np.frombuffer(x.suffix, "<u2"), (len(some), CELLS))
            some = some[_may_link(one * x.n, n[some], one * x.at, at[some], own, suffixes[some], bar)]
            found.append(np.stack([np.full(len(some), x.row), row[some]], axis=1))
    pairs = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
    return pd.DataFrame(pairs, columns=["a", "b"])


def _across(members: DataFrame, found: DataFrame, bar: Bar) -> DataFrame:
    """Pairs to verify between members of a key that the first round left in different groups."""
    of = found.toDF("_row", "_g")
    grouped = members.where("c > 2").join(of, F.col("row") == F.col("_row"), "left")  # of two, both have met
    grouped = stage(grouped.withColumn("g", F.coalesce("_g", "row")).drop("_row", "_g"), "key_groups")
    sizes = grouped.groupBy("key", "g").agg(F.count("*").alias("k"))
    main = sizes.groupBy("key").agg(F.count("*").alias("groups"), F.max(F.struct("k", "g")).alias("top"))
    mixed = stage(main.where("groups > 1").select("key", F.col("top.g").alias("main")), "mixed_keys")
    blocks = F.ceil(F.col("c") / MEMBERS)
    inside = stage(
        grouped.join(mixed, "key").select(
            "key", "row", "n", "at", "g", "suffix", (F.col("g") != F.col("main")).alias("odd"),
            blocks.alias("blocks"), F.pmod(F.xxhash64("row"), blocks).alias("block"),
        ),
        "mixed_members",
    )
    # keys of one block share calls of about ``MEMBERS`` members; larger ones have calls of their own
    calls = max(1, inside.where("blocks = 1").count() // MEMBERS)
    call = F.when(F.col("blocks") > 1, F.xxhash64("key")).otherwise(F.pmod(F.xxhash64("key"), F.lit(calls)))
    inside = inside.withColumn("call", call)
    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    common = ("call", "blocks", "key", "row", "n", "at", "g", "suffix", "odd")
    odd = inside.where("odd").select(*common, F.col("block").alias("i"), F.explode(every).alias("j"))
    all_ = inside.select(*common, F.explode(every).alias("i"), F.col("block").alias("j"))
    all_ = all_.toDF(*all_.columns)  # fresh columns: both sides come from one table
    keys = ("call", "blocks", "i", "j")

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        return _search(left, right, bar)

    return odd.groupBy(*keys).cogroup(all_.groupBy(*keys)).applyInPandas(search, "a long, b long")


def _linked(blocks: DataFrame, classes: DataFrame, bar: Bar) -> DataFrame:
    """``node, component`` of the rows that stand for their class and are linked to another."""
    total = blocks.select(F.expr("aggregate(n, 0L, (x, y) -> x + y)").alias("n")).agg(F.sum("n")).first()[0]
    slots = (total or 0) // SLOT_GRAMS + 1
    texts = blocks.select("block", "packed")
    requests = texts.mapInArrow(
        lambda batches: _requests(batches, bar.size, slots), "block long, slot long, marks binary, counts binary"
    )
    replies = requests.groupBy("slot").applyInPandas(_frequencies, "block long, slot long, found binary")
    replies = stage(replies, "replies").groupBy("block").agg(F.collect_list(F.struct("slot", "found")).alias("replies"))
    keyed = texts.join(replies, "block").select("block", "packed", "replies").mapInArrow(
        lambda batches: _keys(batches, bar, slots), _KEYED
    )
    keyed = stage(keyed, "keyed").join(classes.select("row"), "row", "left_semi")
    keyed = stage(keyed, "keyed_classes")
    rows = keyed.select("row", "n", F.explode("keys").alias("k")).select("row", "n", "k.*")
    shared = stage(rows.groupBy("key").agg(F.count("*").alias("c")).where("c > 1"), "shared_keys")
    members = stage(rows.join(shared, "key"), "key_members")
    pairs = _star(members).where(bar.lengths("n_a", "n_b"))
    pairs = pairs.mapInArrow(lambda batches: _filtered(batches, bar), "a long, b long")
    first = stage(_ordered(pairs), "first_pairs")
    found = components(stage(_verify(first, keyed, bar), "first_links"), "first_groups")
    more = _ordered(_across(members, found, bar)).join(first, ["a", "b"], "left_anti")
    links = stage(_verify(stage(more, "more_pairs"), keyed, bar), "more_links")
    if links.isEmpty():
        return found
    return components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(links), "all_groups")


def jaccard_groups(docs: DataFrame, bar: Bar = Bar(), text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id``.

    ``component_id`` is the least id that links reach, its own included. Rows are documents of
    their own: those that repeat an id, or have none, are linked by their texts alone. Null and
    empty texts, and those without words, are linked with nothing. A group without any id has a
    null component.
    """
    narrow = docs.select(docs["doc_id"].cast("long").alias("id"), docs[f"`{text}`"].alias("text"))
    blocks = stage(narrow.mapInArrow(lambda batches: _blocks(batches, bar.size), _BLOCK), "gram_blocks")
    rows = blocks.select("block", F.posexplode(F.arrays_zip("ids", "n", "s1", "s2"))).select(
        (F.shiftleft("block", _ROW_BITS) + F.col("pos")).alias("row"), F.col("col.ids").alias("id"), "col.n", "col.s1", "col.s2"
    )
    classes = stage(
        rows.where("n > 0").groupBy("s1", "s2").agg(F.min("row").alias("row"), F.min("id").alias("least")), "gram_classes"
    )
    found = _linked(blocks, classes, bar)
    ends = found.union(found.select("component", "component").distinct()).toDF("row", "component")
    linked = stage(classes.join(ends, "row"), "linked_classes")
    least = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    of = linked.join(least, "component").select("row", "component_id")
    named = classes.join(of, "row", "left").select("s1", "s2", F.coalesce("component_id", "least").alias("component_id"))
    # written, so that the join reads two plain exchanges and splits a hot class
    out = rows.join(stage(named, "class_names"), ["s1", "s2"], "left")
    return out.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
    )
