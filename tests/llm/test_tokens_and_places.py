"""Token segments, packing and sharding: exact round trips and laws."""

import random
import zlib
from collections import Counter
from functools import cache
from unittest import mock

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.helpers import frame, odd_rows
from tierstone.llm import id_store, packing, sharding
from tierstone.llm.token_ids import PieceEncoder, encoder

WORD, BYTE = (public_tokenizers.path(x) for x in ("word_bpe_49k.json", "byte_bpe_50k.json"))


_tokenizer = cache(Tokenizer.from_file)


def _plain(path, text):
    tokenizer = _tokenizer(path)
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_pieces_give_the_ids_of_the_whole_text(path):
    r = random.Random(2)
    letters = "ab C,.!'\n\t 　\xa0\x1c\x85 é1 2's <|endoftext|>中"
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 40))) for _ in range(400)]
    texts += ["", " ", "\n\n", "don't  we'll", " It's, a,b .c", "a" * 300, "x  ,y\n,z"]
    assert encoder(path).encode(texts) == [_plain(path, t) for t in texts]


def test_segments_read_back_exactly(spark, tmp_path):
    path, rows = str(tmp_path / "ids"), odd_rows()
    id_store.write_ids(frame(spark, clashes=True), path, WORD, end_id=2)
    want = sorted(((r[0] if r[0] is not None else -(2**63)), _plain(WORD, r[1]) + (2).to_bytes(4, "little")) for r in rows)
    got = sorted(id_store.read_ids(spark, path).collect(), key=lambda r: r["start"])
    assert sorted(((r["doc_id"] if r["doc_id"] is not None else -(2**63)), bytes(r["ids"])) for r in got) == want
    ids = [r["doc_id"] for r in got if r["doc_id"] is not None]
    assert ids == sorted(ids)
    at = 0
    for r in got:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"]) // 4
        at += r["n_tokens"]
    assert id_store.lookup(spark, path, 9) == [_plain(WORD, "One two") + (2).to_bytes(4, "little")] * 2
    assert id_store.lookup(spark, path, 99) == []


def test_segments_refuse_another_dictionary(spark, tmp_path):
    path = str(tmp_path / "ids")
    id_store.write_ids(frame(spark), path, WORD, end_id=2)
    data = bytes(spark.read.parquet(f"{path}/segments").first()["data"])
    with pytest.raises(ValueError, match="another dictionary"):
        id_store.Segment(data, id_store._dictionary(b"something else entirely"))


def test_no_documents_no_segments(spark, tmp_path):
    id_store.write_ids(frame(spark, []), str(tmp_path / "ids"), WORD, end_id=2)
    assert id_store.read_ids(spark, str(tmp_path / "ids")).collect() == []
    assert packing.pack(frame(spark, []), BYTE).collect() == []
    assert sharding.shuffle_into_shards(frame(spark, []), 8).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 400), max_size=30))
def test_plans_use_every_piece_once_and_fit(histogram):
    made = packing.plan(histogram, 64, grid=16)
    used = Counter()
    for lengths, n in made:
        assert sum(lengths) <= 64 and n > 0
        for length in lengths:
            used[length] += n
    assert used == Counter(histogram)
    total = sum(k * v for k, v in histogram.items())
    largest = max([0, *histogram])
    assert sum(n for _, n in made) <= max(-(-total // 64) * 1.3 + 1, sum(v for k, v in histogram.items() if k > 32) + total / max(1, 64 - largest) + 1)


def test_least_squares_finds_a_nonnegative_solution():
    r = np.random.default_rng(3)
    a, x = r.random((12, 30)), np.maximum(r.normal(size=30), 0)
    found = packing.nonnegative_least_squares(a, a @ x)
    assert (found >= 0).all() and np.linalg.norm(a @ found - a @ x) < 1e-6
    assert (packing.nonnegative_least_squares(a, -a.sum(axis=1)) == 0).all()


def test_packed_pieces_and_sequences(spark):
    rows = [r for r in odd_rows() if r[0] not in (9, None)]
    docs = frame(spark, rows, clashes=True)
    packed = packing.pack(docs, BYTE).toPandas()
    for ident, part in packed.sort_values("piece").groupby("doc_id"):
        ids = _plain(BYTE, next(r[1] for r in rows if r[0] == ident)) + bytes(4)
        at = 0
        for p in part.itertuples():
            assert p.start == at and zlib.crc32(ids[4 * at : 4 * (at + p.length)]) == p.ids_crc32
            at += p.length
        assert 4 * at == len(ids) and (part.length.iloc[1:] == 2048).all()
    ordered = packed.sort_values(["sequence_id", "offset"])
    sums = ordered.groupby("sequence_id").length
    assert (ordered.offset == sums.cumsum() - ordered.length).all() and sums.sum().max() <= 2048
    assert packed.sequence_id.nunique() == -(-packed.length.sum() // 2048)
    made = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(docs, packing.pack(docs, BYTE), BYTE).collect()}
    assert sorted(len(x) // 4 for x in made.values()) == sorted(sums.sum())


def test_a_frequent_length_is_ranked_in_cells(spark):
    docs = frame(spark, [(i, "the same text, and the same length", "en", "a", 1) for i in range(300)])
    with mock.patch.object(packing, "CELL_ROWS", 20):
        packed = packing.pack(docs, BYTE).toPandas().sort_values(["sequence_id", "offset"])
    lengths = packed.groupby("sequence_id").length
    assert len(packed) == 300 and lengths.sum().max() <= 2048 and packed.sequence_id.nunique() == 2
    assert (packed.offset == lengths.cumsum() - packed.length).all()


def test_pieces_are_written_by_their_number(spark, monkeypatch):
    """Few documents go to one file, however many tasks read and rank them; many to several, with the same rows."""
    names = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in names}
    docs = frame(spark, [(i, "some words " * (1 + i % 17), "en", "a", 1) for i in range(90)]).repartition(24)
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        found = []
        for each, files in ((50_000, 1), (30, 3)):
            monkeypatch.setattr(packing, "ROWS_PER_FILE", each)
            packed = packing.pack(docs, BYTE)
            assert len(packed.inputFiles()) == files and packed.rdd.getNumPartitions() == files
            found.append(sorted(packed.collect()))
        assert found[0] == found[1] and len(found[0]) == 90
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_rows_that_repeat_an_id_are_packed_each(spark):
    assert packing.pack(frame(spark), BYTE).where("doc_id is null or doc_id = 9").count() == 3


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_shards_are_exact_and_carry_the_rows(spark, shards):
    docs = frame(spark, clashes=True).union(frame(spark, clashes=True))
    stored = spark.createDataFrame(docs.collect(), docs.schema)
    placed = sharding.shuffle_into_shards(stored, shards)
    assert placed.columns == [*docs.columns, "_place"]
    rows = placed.collect()
    sizes = Counter(r["_place"]["shard"] for r in rows)
    assert len(rows) == 28 and max(sizes.values()) - min(sizes.values()) <= 1 and len(sizes) == shards
    for shard, n in sizes.items():
        assert sorted(r["_place"]["slot"] for r in rows if r["_place"]["shard"] == shard) == list(range(n))
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter((r["doc_id"], r["text"]) for r in stored.collect())


def test_the_matrix_is_drawn_exactly():
    made = sharding.draw({3: 10, 0: 5, 9: 0, 4: 22}, 4, seed=1)
    lines = np.stack(list(made.counts.values()))
    assert lines.sum(axis=0).tolist() == sharding.shard_sizes(37, 4).tolist() == [10, 9, 9, 9]
    assert {k: int(v.sum()) for k, v in made.counts.items()} == {3: 10, 0: 5, 9: 0, 4: 22}
    drawn = [sharding._log_concave(np.random.default_rng(i), 40, 60, 30) for i in range(4000)]
    exact = np.random.default_rng(1).hypergeometric(40, 60, 30, 4000)
    assert abs(np.mean(drawn) - 12) < 0.15 and abs(np.std(drawn) - np.std(exact)) < 0.12
    big = sharding.draw({0: 3 * 10**9, 1: 5 * 10**9}, 2, seed=2)
    assert sum(x.sum() for x in big.counts.values()) == 8 * 10**9 and abs(big.counts[0][0] - 1.5 * 10**9) < 10**6


def test_every_place_is_equally_likely(spark):
    docs = spark.range(12).select(F.col("id").alias("doc_id"), F.lit("x").alias("text")).coalesce(3)
    shards, slots = Counter(), Counter()
    for seed in range(60):
        for partition, line in (plan := sharding.draw({0: 4, 1: 4, 2: 4}, 3, seed)).counts.items():
            labels = plan.labels(partition)
            assert np.bincount(labels, minlength=3).tolist() == line.tolist()
            shards[int(labels[0])] += 1
    assert min(shards.values()) > 35
    for seed in range(8):
        for r in sharding.shuffle_into_shards(docs, 2, seed).where("doc_id = 0").collect():
            slots[r["_place"]["slot"]] += 1
    assert len(slots) > 3


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_strings_of_special_tokens_are_those_tokens(name):
    """As the library has it by default; ordinary text on demand."""
    path = public_tokenizers.path(name)
    texts = ["a<|endoftext|>b", "A <|EndOfText|> B", "x.<|endoftext|>\n y", "<|startoftext|>", "Up <|endoftext|>,Down", "<|endoftext|"]
    for plain in (False, True):
        tokenizer = Tokenizer.from_file(path)
        if plain:
            tokenizer.encode_special_tokens = True
        want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        assert PieceEncoder(path, plain).encode(texts) == want
