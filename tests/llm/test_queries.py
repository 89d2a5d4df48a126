"""The registered queries over whole given tables: against their SQL, or brute force."""

import hashlib
import os
import re
import zlib
from html import unescape
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.helpers import LINE, deduped_lines, frame, near_groups, words, without_repeats
from tierstone.llm import decontaminate, quality_lines
from tierstone.llm.oracle import SQL
from tierstone.llm.queries import QUERIES

SMALL, LARGER = "/root/testdata/sf0.001", f"/root/testdata/sf{os.environ.get('ORACLE_SF', '0.01')}"


@pytest.fixture(scope="module")
def docs(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]


def _rows(spark, name, sf_dir=SMALL):
    return QUERIES[name](spark, sf_dir).toPandas()


def test_every_operator_and_the_pipeline_are_registered():
    names = entry.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert "pipeline" in names and "pipeline" not in entry.oracle_sql() and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    connection = duckdb.connect()
    for file in Path(LARGER).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    found = QUERIES[name](spark, LARGER)
    got = sorted(tuple(r[c] for c in sorted(found.columns)) for r in found.collect())
    result = connection.execute(SQL[name])
    columns = [d[0] for d in result.description]
    order = sorted(range(len(columns)), key=columns.__getitem__)
    assert [columns[i] for i in order] == sorted(found.columns)
    assert got == sorted(tuple(r[i] for i in order) for r in result.fetchall()) and got


def _ids(name, text, end):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end], "<u4").tobytes()


def test_ids(spark, docs):
    at, got = 0, _rows(spark, "op1_id_store").set_index("doc_id")
    for doc_id, text in sorted(docs):
        ids = _ids("word_bpe_49k.json", text, 2)
        assert tuple(got.loc[doc_id]) == (at, len(ids) // 4, zlib.crc32(ids))
        at += len(ids) // 4


def test_shards(spark, docs):
    got = _rows(spark, "op3_matrix_shuffle")
    sizes = got.groupby("shard").size()
    assert sizes.max() - sizes.min() <= 1 and set(got.law) == {"rows"} and got.grown_shard.isna().all()
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))
    data = {i: (t or "").encode() for i, t in docs}
    assert {r[0]: (r[1], r[2]) for r in got.itertuples(index=False)} == {i: (len(d) + 1, zlib.crc32(d)) for i, d in data.items()}


def test_pages(spark):
    html = dict(tuple(r) for r in spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "html").collect())
    got = _rows(spark, "op4_site_templates")
    assert set(got.page_id) == set(html)
    for r in got.itertuples():
        body = re.search(r"<article>(.*?)</article>", html[r.page_id], re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"</?b>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        assert r.text == "\n".join(x for x in blocks if x) and r.n_chars == len(r.text)


def test_repeats(spark, docs):
    got = _rows(spark, "op5_induced_sort").set_index("doc_id")
    for (doc_id, text), (kept, removed, spans) in zip(docs, without_repeats([t for _, t in docs], 200)):
        assert tuple(got.loc[doc_id]) == (len((text or "").encode()), removed, spans, hashlib.sha256(kept).hexdigest())


def test_quality_is_learnt_for_rows_held_out(spark):
    got = _rows(spark, "op7_nbsvm_quality", LARGER)
    labels = spark.read.parquet(f"{LARGER}/labels.parquet").toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.3)).all()
    held = got[got.held_out].merge(labels, on="doc_id")
    assert len(held) > 50 and (held.predicted == held.quality).mean() > 0.95
    good, bad = held.score[held.quality == 1], held.score[held.quality == 0]
    assert np.mean([(good > x).mean() for x in bad]) > 0.97


def test_near_duplicates(spark, docs):
    got = _rows(spark, "op8_near_dups")
    want = near_groups(docs)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.itertuples()} == want
    assert (got.kept == (got.doc_id == got.component_id)).all() and not got.kept.all()


def _check_packed(packed, texts):
    for doc_id, part in packed.sort_values("piece").groupby("doc_id"):
        ids, at = _ids("byte_bpe_50k.json", texts[doc_id], 0), 0
        for p in part.itertuples():
            assert p.start == at and p.ids_crc32 == zlib.crc32(ids[4 * at : 4 * (at + p.length)])
            at += p.length
        assert at == len(ids) // 4
    ordered = packed.sort_values(["sequence_id", "offset"])
    lengths = ordered.groupby("sequence_id").length
    assert (ordered.offset == lengths.cumsum() - ordered.length).all() and lengths.sum().max() <= 2048
    assert packed.sequence_id.nunique() <= 1.01 * packed.length.sum() / 2048 + 1


def test_packing(spark, docs):
    packed = _rows(spark, "op9_pattern_packing")
    assert set(packed.doc_id) == {i for i, _ in docs}
    _check_packed(packed, dict(docs))


@pytest.fixture
def corpus(spark, tmp_path):
    """Documents for every stage to act on, and the benchmark that some of them quote."""
    item = "How far does the quick courier ride from the harbour of Oslo to the old stone bridge in a single summer day"
    body = [" ".join(f"w{i}x{j}" for j in range(90)) + "." for i in range(12)]
    edited = body[3].replace("w3x40", "other")
    rows = [(i, f"{LINE}\n{t}", "en", "s", 1) for i, t in enumerate(body)]
    rows += [(20, body[2], "en", "s", 1), (21, edited, "en", "s", 1), (22, f"{body[5]}\n{item}?", "en", "s", 1)]
    rows += [(23, "BUY!! NOW!! " * 60, "en", "s", 1), (24, "too short.", "en", "s", 1), (25, None, None, None, None), (26, "", "", "", 0)]
    rows += [(27, f"{body[7]} {item}.\nHOME | NEWS | SPORT", "en", "s", 1)]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path), rows


def test_pipeline_equals_its_stages_by_brute_force(spark, corpus):
    sf_dir, rows = corpus
    measured = quality_lines.measure(frame(spark, rows)).collect()
    left = [(r["doc_id"], r["_quality"]["cleaned"]) for r in measured if r["_quality"]["kept"]]
    assert {23, 24, 25, 26}.isdisjoint(i for i, _ in left) and all("HOME" not in t for _, t in left)
    left = [(i, "\n".join(kept)) for (i, _), (_, kept) in zip(left, deduped_lines(left))]
    # an exact copy has lost all its lines by now, and goes
    assert dict(left)[20] == "" and all(words(t) for i, t in left if i != 20)
    left = [(i, t) for i, t in left if words(t)]
    assert sum(LINE in t for _, t in left) == 1
    groups = near_groups(left)
    left = [(i, t) for i, t in left if groups[i][1] == i]
    assert 21 not in dict(left)
    left = [(i, t) for i, t in left if "quick courier ride" not in t]
    assert {22, 27}.isdisjoint(dict(left)) and len(left) == 12
    packed = corpus_pipeline.run(spark, sf_dir).toPandas()
    assert set(packed.doc_id) == {i for i, _ in left}
    _check_packed(packed, dict(left))


def test_stages_keep_columns_extra_ones_and_take_empty_tables(spark, corpus):
    sf_dir, rows = corpus
    for docs in (frame(spark, rows, clashes=True), frame(spark, [], clashes=True)):
        names = docs.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, sf_dir)
            assert docs.columns == names, name
        corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()


def test_the_rest_works_without_the_subpackage(spark):
    """Nothing outside imports it, and the entry point does without it."""
    root = Path(entry.__file__).parent
    for file in [*root.glob("tierstone/**/*.py"), *root.glob("verification/*.py")]:
        if "llm" not in file.parts:
            assert "llm" not in file.read_text(), file
    assert words("a  b\n") == ["a", "b"] and decontaminate.UNITS.count("|") > 10
