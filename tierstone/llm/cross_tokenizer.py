"""Which tokens of two tokenizers stand for the same bytes, and how often ids meet.

Both tokenizers spell a blank and the text. Their tokens end at byte offsets; wherever both end,
a group of tokens is complete. The two arrays of ends are walked together at an index shift (how
many more tokens the second one has used so far). While ends are equal at that shift, the walk
probes stretches of 8, 16, 32, ... tokens with one comparison each and jumps over those that are
equal throughout; in the stretch that is not, halves lead to the first difference. There the
group is resolved token by token, and the walk goes on at the shift after it.

Links are the pairs of tokens whose bytes overlap. Documents are put into blocks of about
``BLOCK_BYTES`` of text, which count their links by pair of ids; only distinct pairs of a block
are shuffled to be summed over the corpus, and come back to the block as one array.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import pre_tokenizers

from tierstone.llm.token_ids import encoder
from tierstone.sources import stage

BLOCK_BYTES = 2 << 20
TEXTS_TOGETHER = 256 << 10  # bytes of texts that share a call of the tokenizers
SHORT = 8  # tokens of the shortest stretch that is probed at once

_MARK = "▁"


class PieceTokens:
    """Ids of texts by a sentencepiece model that spells blanks as marks and adds one in front."""

    def __init__(self, path: str):
        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self._model.id_to_piece(i) for i in range(self._model.get_piece_size())]
        self.spelling = [
            bytes([int(x[3:5], 16)]) if self._model.is_byte(i) else x.replace(_MARK, " ").encode()
            for i, x in enumerate(pieces)
        ]

    def _spelt(self, ids: list[int], text: str) -> bytes | None:
        found = b"".join(map(self.spelling.__getitem__, ids))
        same = found == b" " + text.encode("utf-8", "surrogatepass")
        return np.array(ids, dtype="<u4").tobytes() if same else None

    def encode(self, texts: list[str]) -> list[bytes | None]:
        """Little-endian unsigned 32-bit ids of each text; none if they don't spell a blank and it."""
        return [self._spelt(ids, x) for x, ids in zip(texts, self._model.encode(texts, num_threads=1))]


def _byte_level(vocabulary: dict[str, int]) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary, which spells every byte as a letter.

    Printable bytes of Latin-1 stand for themselves, the others for letters from 256 on in order.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [x for x in range(256) if x not in set(own)]
    letter = {chr(x): x for x in own} | {chr(256 + i): x for i, x in enumerate(others)}
    assert set(letter) == set(pre_tokenizers.ByteLevel.alphabet())
    out = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        out[i] = bytes(map(letter.__getitem__, token)) if all(c in letter for c in token) else token.encode()
    return out


class _Side:
    """What alignment needs to know of a tokenizer: ids of texts, and the bytes of each id."""

    def __init__(self, path: str, byte_level: bool):
        if byte_level:
            found = encoder(path, plain=True)
            self.encode, self.spelling = found.encode, _byte_level(found.vocabulary)
            self.lossless = found.lossless  # then ids always spell the text
        else:
            found = PieceTokens(path)
            self.encode, self.spelling, self.lossless = found.encode, found.spelling, True  # checks itself
        self.lengths = np.array([len(x) for x in self.spelling], dtype=np.int64)

    def spells(self, ids: np.ndarray, text: str) -> bool:
        found = b"".join(map(self.spelling.__getitem__, ids.tolist()))
        return found == b" " + text.encode("utf-8", "surrogatepass")

    def written(self, last: str) -> list[str]:
        """Decimal ids with what follows them: first inside a group, then at its end."""
        decimal = [str(i) for i in range(len(self.spelling))]
        return [x + "," for x in decimal] + [x + last for x in decimal]


def group_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per group, one past its last token on either side. Both arrays end at the same offset.

    Ends grow strictly. Diagonal run skipping, as the module describes.
    """
    n_a, n_b = len(ends_a), len(ends_b)
    list_a, list_b = ends_a.tolist(), ends_b.tolist()
    at_a, at_b, runs = [], [], []  # where a stretch of one-to-one groups ends, or one other group
    i = j = 0
    while i < n_a and j < n_b:
        begin, x, y = i, list_a[i], list_b[j]
        if x == y:
            i, j, step = i + 1, j + 1, SHORT
            while i + step <= n_a and list_a[i : i + step] == list_b[j : j + step]:
                i, j, step = i + step, j + step, 2 * step
            while step > SHORT:  # the first difference is among the next ``step`` tokens
                step >>= 1
                if i + step <= n_a and list_a[i : i + step] == list_b[j : j + step]:
                    i, j = i + step, j + step
            while i < n_a and j < n_b and list_a[i] == list_b[j]:
                i, j = i + 1, j + 1
            runs.append(i - begin)
        else:
            while x != y:
                if x < y:
                    i += 1
                    x = list_a[i]
                else:
                    j += 1
                    y = list_b[j]
            i, j = i + 1, j + 1
            runs.append(1)
        at_a.append(i)
        at_b.append(j)
    times = np.array(runs, dtype=np.int64)
    back = np.repeat(np.cumsum(times), times) - np.arange(1, times.sum() + 1)
    return np.repeat(np.array(at_a, np.int64), times) - back, np.repeat(np.array(at_b, np.int64), times) - back


@dataclass(frozen=True)
class Aligned:
    """Tokens of one text, where they end, and where their groups end (one past the last token)."""

    a: np.ndarray
    b: np.ndarray
    ends_a: np.ndarray
    ends_b: np.ndarray
    groups_a: np.ndarray
    groups_b: np.ndarray

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both tokens of each link: one per stretch of bytes without an end inside."""
        if not len(self.a):
            return self.a, self.b
        ends = np.zeros(self.ends_a[-1] + 1, dtype=np.uint8)
        ends[self.ends_a] = 1
        ends[self.ends_b] += 2
        ends = ends[ends > 0]
        in_a, in_b = ends & 1, ends >> 1
        return self.a[np.cumsum(in_a, dtype=np.int64) - in_a], self.b[np.cumsum(in_b, dtype=np.int64) - in_b]


_NONE = Aligned(*(np.zeros(0, dtype=np.int64) for _ in range(6)))


class Aligner:
    """Aligns texts by a byte-level tokenizer (``path_a``) and a sentencepiece model (``path_b``)."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = _Side(path_a, True), _Side(path_b, False)
        self._written = self.a.written("|") + self.b.written(";")

    def align(self, texts: list[str]) -> list[Aligned]:
        ids_a, ids_b = self.a.encode([" " + x if x else "" for x in texts]), self.b.encode(texts)
        return [self._align(*x) for x in zip(texts, ids_a, ids_b)]

    def _align(self, text: str, ids_a: bytes, ids_b: bytes | None) -> Aligned:
        if not text or ids_b is None:
            return _NONE
        a, b = (np.frombuffer(x, "<u4").astype(np.int64) for x in (ids_a, ids_b))
        if not self.a.lossless and not self.a.spells(a, text):
            return _NONE
        ends_a, ends_b = np.cumsum(self.a.lengths[a]), np.cumsum(self.b.lengths[b])
        return Aligned(a, b, ends_a, ends_b, *group_ends(ends_a, ends_b))

    def write(self, x: Aligned) -> str:
        """``a1,a2|b1;a3|b2,b3``: the ids of each group, in order."""
        if not len(x.a):
            return ""
        a, b = x.a.copy(), x.b + 2 * len(self.a.spelling)
        a[x.groups_a - 1] += len(self.a.spelling)
        b[x.groups_b - 1] += len(self.b.spelling)
        codes = np.empty(len(a) + len(b), dtype=np.int64)
        before_b = np.repeat(np.concatenate([[0], x.groups_b[:-1]]), np.diff(x.groups_a, prepend=0))
        upto_a = np.repeat(x.groups_a, np.diff(x.groups_b, prepend=0))
        codes[np.arange(len(a)) + before_b] = a
        codes[np.arange(len(b)) + upto_a] = b
        return "".join(map(self._written.__getitem__, codes.tolist()))[:-1]


@cache
def aligner(path_a: str, path_b: str) -> Aligner:
    """One per process: workers are reused, and so is what they have looked up."""
    return Aligner(path_a, path_b)


def _calls(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str], int]]:
    """Ids and texts (null: empty) of about ``TEXTS_TOGETHER`` bytes, however many rows that is."""
    for batch in batches:
        ids, texts, size = [], [], 0
        for ident, text in zip(batch.column(0), batch.column(1)):
            ids.append(ident.as_py())
            texts.append(text.as_py() or "")
            size += len(texts[-1])
            if size >= TEXTS_TOGETHER:
                yield ids, texts, size
                ids, texts, size = [], [], 0
        if ids:
            yield ids, texts, size


def _narrow(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs[f"`{text}`"].alias("text"))


def groups(docs: DataFrame, path_a: str, path_b: str, text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id`` and ``groups``, the ids of each group as written text.

    Null and empty texts, and those that a tokenizer can't spell, have an empty one.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = aligner(path_a, path_b)
        for ids, texts, _ in _calls(batches):
            written = [held.write(x) for x in held.align(texts)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(written)], ["doc_id", "groups"])

    return _narrow(docs, text).mapInArrow(rows, "doc_id long, groups string")


_DOC = "doc_id: long, n_a: long, n_b: long, n_groups: long, n_links: long, groups_sha256: string".replace(": ", ":")
_BLOCK = f"block long, docs array<struct<{_DOC}>>, pairs array<struct<pair:long,times:long>>, links binary"


def _block(number: int, docs: list[tuple], links: list[np.ndarray]) -> pa.RecordBatch:
    pairs, at, times = np.unique(np.concatenate(links), return_inverse=True, return_counts=True)
    names = [x.split(":")[0] for x in _DOC.split(", ")]
    counted = pa.StructArray.from_arrays([pa.array(pairs), pa.array(times.astype(np.int64))], ["pair", "times"])
    kind = pa.struct([(x, pa.string() if x.endswith("256") else pa.int64()) for x in names])
    packed = zstandard.ZstdCompressor(level=1).compress(at.astype("<u4").tobytes())
    return pa.RecordBatch.from_arrays(
        [
            pa.array([number], pa.int64()),
            pa.array([[dict(zip(names, x)) for x in docs]], pa.list_(kind)),
            pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), counted),
            pa.array([packed], pa.binary()),
        ],
        ["block", "docs", "pairs", "links"],
    )


def _blocks(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str) -> Iterator[pa.RecordBatch]:
    held, number = aligner(path_a, path_b), TaskContext.get().partitionId() << 32
    size_b, docs, links, size = len(held.b.spelling), [], [], 0
    for ids, texts, size_here in _calls(batches):
        for ident, x in zip(ids, held.align(texts)):
            a, b = x.links()
            digest = hashlib.sha256(held.write(x).encode()).hexdigest() if len(x.a) else ""
            docs.append((ident, len(x.a), len(x.b), len(x.groups_a), len(a), digest))
            links.append(a * size_b + b)
        size += size_here
        if size >= BLOCK_BYTES:
            yield _block(number, docs, links)
            number, docs, links, size = number + 1, [], [], 0
    if docs:
        yield _block(number, docs, links)


def _resolved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of documents from blocks and the counts of their pairs (negative: not the highest)."""
    names = [x.split(":")[0] for x in _DOC.split(", ")] + ["n_best", "count_sum"]
    for batch in batches:
        for docs, packed, found in zip(*(batch.column(batch.schema.get_field_index(x)) for x in ("docs", "links", "found"))):
            rows = pa.RecordBatch.from_struct_array(docs.values)
            at = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed.as_py()), "<u4")
            totals = np.zeros((2, len(rows)), dtype=np.int64)
            if len(at):
                counts = np.zeros(int(at.max()) + 1, dtype=np.int64)
                counts[found.values.field(0).to_numpy()] = found.values.field(1).to_numpy()
                ends = np.cumsum(rows.column(4).to_numpy())
                for out, value in zip(totals, ((counts > 0)[at], np.abs(counts)[at])):
                    sums = np.concatenate([[0], np.cumsum(value, dtype=np.int64)])
                    out[:] = np.diff(sums[ends], prepend=0)
            yield pa.RecordBatch.from_arrays([*rows.columns, *map(pa.array, totals)], names)


def link_scores(docs: DataFrame, path_a: str, path_b: str, text: str = "text") -> DataFrame:
    """Per row of ``docs``: its numbers of tokens, groups and links, and how common the links are.

    ``n_best`` counts links whose pair of ids is the commonest of its second id in the corpus,
    ties included; ``count_sum`` adds up how often each link's pair is linked in the corpus.
    ``groups_sha256`` digests what ``groups`` writes. Rows are taken one by one, so null and
    repeated ids need no care; null and empty texts, and those that a tokenizer can't spell, have
    zeros and an empty digest.
    """
    size_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    narrow = _narrow(docs, text)
    blocks = stage(narrow.mapInArrow(lambda batches: _blocks(batches, path_a, path_b), _BLOCK), "link_blocks")
    pairs = blocks.select("block", F.posexplode("pairs")).select("block", "pos", "col.pair", "col.times")
    counts = stage(pairs.groupBy("pair").agg(F.sum("times").alias("n")), "pair_counts").withColumn("b", F.pmod("pair", F.lit(size_b)))
    best = counts.groupBy("b").agg(F.max("n").alias("most"))
    signed = counts.join(best, "b").select("pair", F.when(F.col("n") == F.col("most"), F.col("n")).otherwise(-F.col("n")).alias("n"))
    signed = stage(signed, "signed_counts")
    # a common pair is in every block: both sides of the join are plain exchanges, which AQE splits
    found = pairs.select("block", "pos", "pair").join(signed, "pair").groupBy("block").agg(
        F.collect_list(F.struct("pos", "n")).alias("found")  # as many as a block has distinct pairs
    )
    joined = blocks.select("block", "docs", "links").join(found, "block", "left")
    return joined.select("docs", "links", "found").mapInArrow(
        _resolved, _DOC.replace(":", " ") + ", n_best long, count_sum long"
    )
