"""Quality rules and line dedup on awkward input, against plain versions."""

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import DOCS, LINE, deduped_lines, frame, odd_rows
from tierstone.llm import line_dedup, quality_lines
from tierstone.llm.cuckoo import CuckooFilter
from tierstone.llm.oracle import SQL


def test_quality_of_awkward_rows(spark):
    rows = {r["doc_id"]: r["_quality"] for r in quality_lines.measure(frame(spark, clashes=True)).collect()}
    assert (rows[1]["n_words"], rows[1]["kept"], rows[1]["cleaned"]) == (0, False, "")
    assert rows[2]["n_words"] == rows[3]["n_words"] == rows[3]["n_dup_lines"] == 0
    assert rows[4]["base_failed"] and rows[4]["n_repeat_words"] == 42 and rows[4]["n_words"] == 54
    assert rows[7]["n_words"] == 30_000 and rows[7]["kept"]
    assert rows[11]["word_chars"] == 1000 and rows[12]["word_chars"] == 1700


def test_repeated_windows_count_every_covered_word(spark):
    texts = ["a b c a b c", "a a a a", "x y z", "a b c d a b c q r s t", ""]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    got = [r["_quality"]["n_repeat_words"] for r in quality_lines.measure(df).orderBy("doc_id").collect()]
    assert got == [6, 4, 0, 6, 0]


@pytest.mark.parametrize(
    "line",
    ["HOME | NEWS | SPORT | ABOUT | CONTACT.", "just some words without an end", "Buy!! now!! best!! price!!",
     "spam spam spam spam spam spam spam.", "All rights reserved.", "a### b### c### d###."],
)
def test_lines_that_fail_go_and_the_rest_stays(spark, line):
    good = " ".join(f"Sentence {i} has words{i} of{i} its{i} own{i}." for i in range(12))
    df = frame(spark, [(1, f"{good}\n{line}", "en", "a", 5), (2, "\n".join([line] * 60), "en", "a", 5)])
    kept = quality_lines.clean(df).collect()
    assert [(r["doc_id"], r["text"], r["n_chars"]) for r in kept] == [(1, good, len(good))]


def test_sound_text_in_long_or_wrapped_lines_stays(spark):
    """One phrase in a long line, and prose whose lines seldom end a sentence."""
    sound = " ".join(f"Sentence {i} has words{i} of{i} its{i} own{i}." for i in range(60))
    phrase = sound.replace("Sentence 9 has", "Sentence 9 is powered by") + " It is about the privacy policy."
    prose = [f"{'The' if i % 4 == 0 else 'and'} " + " ".join(f"w{i}x{j}" for j in range(9)) + ("." if i % 4 == 3 else "") for i in range(40)]
    lists = "\n".join(f"Menu{i} Entry{i} Page{i} Other{i} More{i} Item{i} End{i}" for i in range(40))
    few = "\n".join(f"word{i} of{i}" for i in range(60))
    texts = [phrase, "\n".join(prose), lists, few, "\n\n".join(prose) + "\nA heading of six words here", f"{sound}\nThis page is powered by them. See the privacy policy."]
    df = frame(spark, [(i, t, "en", "a", 1) for i, t in enumerate(texts)])
    kept = {r["doc_id"]: r["text"] for r in quality_lines.clean(df).collect()}
    assert kept == {0: phrase, 1: texts[1], 4: "\n".join(prose), 5: sound}
    connection = duckdb.connect()
    connection.register("documents", pa.table({"doc_id": range(len(texts)), "text": texts}))
    connection.execute(SQL["op2_quality_lines"])
    columns = [d[0] for d in connection.description]
    got = quality_lines.measure(df).select("doc_id", "_quality.*").select(*columns)
    assert sorted(tuple(r) for r in got.collect()) == sorted(connection.fetchall())


def test_empty_tables(spark, tmp_path):
    empty = frame(spark, [])
    assert quality_lines.clean(empty).collect() == []
    assert line_dedup.dedup(empty, str(tmp_path / "i")).collect() == []


@pytest.mark.parametrize("broadcast", [line_dedup.BROADCAST_BYTES, 0])
def test_line_dedup_equals_plain_version(spark, tmp_path, broadcast):
    rows = [(r[0] if r[0] is not None else 2**63 - 1, r[1]) for r in odd_rows()]
    index = line_dedup.LineIndex(spark, str(tmp_path / "index"))
    index.broadcast_bytes = broadcast
    docs = frame(spark, clashes=True)
    index.insert(docs)
    got = sorted((r["doc_id"] if r["doc_id"] is not None else 2**63 - 1, r["_lines"]["n_lines"], r["_lines"]["text"]) for r in index.resolve(docs).collect())
    want = sorted((i, n, "\n".join(lines)) for (i, _), (n, lines) in zip(rows, deduped_lines(rows)))
    assert got == want


def test_deleting_a_document_brings_its_line_back(spark, tmp_path):
    docs = frame(spark, [(i, f"{LINE}\nonly in {i}, this one", "en", "a", 1) for i in range(4)])
    index = line_dedup.LineIndex(spark, str(tmp_path / "index"))
    index.insert(docs.where("doc_id < 2"))
    index.insert(docs.where("doc_id >= 2"))

    def holders(df):
        return [r["doc_id"] for r in index.resolve(df).orderBy("doc_id").collect() if LINE in r["_lines"]["text"]]

    assert holders(docs) == [0]
    index.delete(docs.where("doc_id = 0").select("doc_id"))
    assert holders(docs.where("doc_id > 0")) == [1]
    index.delete(docs.where("doc_id in (1, 2)").select("doc_id"))
    assert holders(docs.where("doc_id = 3")) == [3]
    assert index._shared().count() == 0


def test_a_reopened_index_goes_on(spark, tmp_path):
    docs = frame(spark, [(i, f"{LINE}\nonly in {i}, this one\nshared by {i // 2}, these two", "en", "a", 1) for i in range(40)])
    path = str(tmp_path / "index")
    index = line_dedup.LineIndex(spark, path)
    with pytest.raises(LookupError):
        index.delete(docs.select("doc_id"))
    with pytest.raises(LookupError):
        index.resolve(docs)
    index.insert(docs.where("doc_id < 30"))
    again = line_dedup.LineIndex(spark.newSession(), path)
    assert (again.generation, again.shards) == (1, index.shards)
    again.delete(docs.where("doc_id = 0").select("doc_id"))
    more = line_dedup.LineIndex(spark, path)
    more.keys_per_shard = 1
    more.insert(docs.where("doc_id >= 30"))
    assert more.shards > index.shards  # 20 shared lines for 8 shards of one

    left = docs.where("doc_id > 0")
    last = line_dedup.LineIndex(spark, path)
    assert last.shards == more.shards
    got = sorted((r["doc_id"], r["_lines"]["n_lines"], r["_lines"]["text"]) for r in last.resolve(left).collect())
    rows = sorted((r["doc_id"], r["text"]) for r in left.collect())
    assert got == [(i, n, "\n".join(lines)) for (i, _), (n, lines) in zip(rows, deduped_lines(rows))]
    fresh = line_dedup.LineIndex(spark, str(tmp_path / "fresh"))
    fresh.insert(left)
    assert sorted(map(tuple, last._shared().collect())) == sorted(map(tuple, fresh._shared().collect()))


def test_a_small_change_keeps_the_filters_of_other_shards(spark, tmp_path):
    texts = [(i, "\n".join(f"line {j} of many lines" for j in range(200)), "", "", 0) for i in range(2)]
    index = line_dedup.LineIndex(spark, str(tmp_path / "index"))
    index.insert(frame(spark, texts))
    before = {r["shard"]: bytes(r["blob"]) for r in index._filters().collect()}
    index.insert(frame(spark, [(i, "a new line of two", "", "", 0) for i in (5, 6)]))
    after = {r["shard"]: bytes(r["blob"]) for r in index._filters().collect()}
    assert len(after) == len(before) and sum(after[s] != before[s] for s in after) == 1


def test_a_failed_change_leaves_the_index_as_it_was(spark, tmp_path, monkeypatch):
    docs = frame(spark, [(i, LINE, "en", "a", 1) for i in range(4)])
    index = line_dedup.LineIndex(spark, str(tmp_path / "index"))
    index.insert(docs.where("doc_id < 2"))
    with monkeypatch.context() as m:
        m.setattr(line_dedup.LineIndex, "_write_filters", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            index.insert(docs.where("doc_id = 2"))
    index.insert(docs.where("doc_id >= 2"))
    assert [tuple(r) for r in index._shared().select("refs", "first_id").collect()] == [(4, 0)]


def test_dedup_keeps_columns_and_nulls(spark, tmp_path):
    docs = frame(spark, clashes=True)
    out = line_dedup.dedup(docs, str(tmp_path / "index"))
    assert out.columns == docs.columns and out.count() == docs.count()
    rows = {r["doc_id"]: r for r in out.where(F.col("doc_id").isNotNull()).collect()}
    assert rows[1]["text"] is None and rows[1]["n_chars"] is None
    assert rows[5]["n_chars"] == len(rows[5]["text"])


def test_cuckoo_filter_holds_deletes_and_survives_storage():
    keys = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 40_000, dtype=np.int64)
    held = CuckooFilter(40_000)
    assert held.insert(keys[:30_000]) and held.insert(keys[30_000:])
    assert held.contains(keys).all()
    others = np.random.default_rng(2).integers(-(2**63), 2**63 - 1, 100_000, dtype=np.int64)
    assert held.contains(others).mean() < 0.001
    held.delete(keys[:20_000])
    again = CuckooFilter.from_bytes(held.to_bytes())
    assert again.contains(keys[20_000:]).all() and again.contains(keys[:20_000]).mean() < 0.001
    assert not CuckooFilter(8).insert(keys[:100])


def test_documents_without_own_lines_can_go(spark, tmp_path):
    rows = [(1, LINE, "", "", 0), (2, f"{LINE}\n \n", "", "", 0), (3, f"{LINE}\nown", "", "", 0), (4, "", "", "", 0), (5, None, "", "", 0)]
    for drop, want in ((True, {1: LINE, 3: "own", 4: "", 5: None}), (False, {1: LINE, 2: " \n", 3: "own", 4: "", 5: None})):
        found = line_dedup.dedup(frame(spark, rows), str(tmp_path / str(drop)), drop_emptied=drop).collect()
        assert {r["doc_id"]: r["text"] for r in found} == want
