"""Near duplicates and repeated byte strings against brute force."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import LONG, frame, near_groups, odd_rows, without_repeats
from tierstone.llm import near_dups, substring_dedup
from tierstone.llm.components import components
from tierstone.llm.induced_sort import sort_suffixes

LAST = 2**63 - 1


def _found(df, sketch=near_dups.Sketch()):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dups.near_duplicates(df, sketch).collect()}


def _edited(seed, edits, base):
    r, w = random.Random(seed), list(base)
    for _ in range(edits):
        w[r.randrange(len(w))] = f"new{r.randrange(10**6)}"
    return " ".join(w)


def test_groups_of_awkward_rows(spark):
    want = near_groups([(LAST if r[0] is None else r[0], r[1]) for r in odd_rows()])
    want[None] = (want.pop(LAST)[0], None)
    assert _found(frame(spark, clashes=True)) == want


def test_edited_copies_across_the_bar(spark):
    """Copies of one text whose similarity to it and to each other lies on both sides of the bar."""
    base = [f"w{i}" for i in range(120)]
    rows = [(0, " ".join(base))] + [(i, _edited(i, i % 7, base)) for i in range(1, 150)]
    rows += [(i, _edited(i, 40, base)) for i in range(150, 170)]
    df = frame(spark, [(i, t, "en", "a", 1) for i, t in rows])
    assert _found(df, near_dups.Sketch(block=16, together=20)) == near_groups(rows)


def test_one_of_each_group_stays(spark):
    docs = frame(spark, clashes=True)
    kept = near_dups.keep_first(docs)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert 7 in ids and 8 not in ids and 10 not in ids and {1, 2, 3, None} <= ids
    assert near_dups.keep_first(frame(spark, [])).collect() == []


def test_rows_without_an_id_are_told_apart(spark):
    """A copy without an id goes, unrelated rows without one stay; one text of a group stays."""
    body = " ".join(f"w{i}" for i in range(60))
    texts = [(1, body), (None, body), (None, "an unrelated text that has no id at all"), (None, None), (None, "")]
    texts += [(None, f"x {body[40:]} y{i}") for i in range(3)] + [(7, "some rows repeat an id"), (7, "with another text under it")]
    kept = [r["text"] for r in near_dups.keep_first(frame(spark, [(i, t, "", "", 0) for i, t in texts])).collect()]
    assert kept.count(body) == 1 and sum((t or "").startswith("x ") for t in kept) == 1 and len(kept) == 7
    assert {None, "", texts[2][1], texts[-1][1], texts[-2][1]} <= set(kept)


def test_registers_merge_and_estimate():
    sketch = near_dups.Sketch()
    m = sketch.multipliers()
    hashes = np.random.default_rng(5).integers(0, 2**64, 4000, dtype=np.uint64)
    a, b = hashes[:2600], hashes[600:]
    ra, rb = (near_dups.registers(x, sketch, m) for x in (a, b))
    assert (near_dups.merge(ra, rb) == near_dups.registers(hashes, sketch, m)).all()
    size = np.array([float(len(a))]), np.array([float(len(b))])
    got = near_dups.likely_similarity(ra[None], rb[None], *size, sketch.base)[0]
    assert abs(got - 2000 / 4000) < 0.12


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 150)] + [(7, 7), (200, 201)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {x: 100 for x in range(101, 150)} | {201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_rounds_of_components_are_dealt_out_by_their_edges(spark, monkeypatch):
    """A few edges go to one file, whatever the shuffle; many to as many as they need."""
    names = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in names}
    edges = spark.createDataFrame([(i, i + 1) for i in range(6)] + [(100, x) for x in range(101, 150)], "a long, b long")
    want = {i: 0 for i in range(1, 7)} | {x: 100 for x in range(101, 150)}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        for each, least, most in ((100_000, 1, 1), (10, 5, 6)):
            monkeypatch.setattr("tierstone.llm.components.EDGES_PER_TASK", each)
            found = components(edges)
            assert {r["node"]: r["component"] for r in found.collect()} == want
            assert least <= len(found.inputFiles()) <= most
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@settings(max_examples=150, deadline=None)
@given(st.text("ab\x00c", max_size=60), st.integers(0, 3), st.sampled_from([40, 10**8]))
def test_suffixes_are_sorted(text, copies, memory):
    data = (text * (copies + 1)).encode()
    got = sort_suffixes(np.frombuffer(data, np.uint8), memory)
    assert got.tolist() == sorted(range(len(data)), key=lambda i: data[i:])


def _repeat_rows():
    r = random.Random(4)
    vocabulary = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(400)]

    def text(n):
        return " ".join(r.choice(vocabulary) for _ in range(n))

    passage, other = text(60), text(25)
    rows = [text(50), text(40) + passage + text(30), passage + text(10), text(5) + passage, text(60) + other, other + text(9)]
    rows += [text(20) + passage[:150] + text(20), rows[0], rows[0] + "x", "", None, "abc" * 300, "z" * 900, text(30) + "z" * 450]
    return rows


@pytest.mark.parametrize(
    "how",
    [substring_dedup.Repeats(), substring_dedup.Repeats(contents_per_anchor=1, shard_bytes=4000, sort_memory=1000),
     substring_dedup.Repeats(block=64, gram=16), substring_dedup.Repeats(length=150, gram=50, contents_per_anchor=2)],
)
def test_repeats_equal_brute_force(spark, how):
    texts = _repeat_rows()
    df = frame(spark, [(i, t, "en", "a", 1) for i, t in enumerate(texts)], clashes=True)
    rows = {r["doc_id"]: r for r in substring_dedup.remove_repeats(df, how).collect()}
    for i, (kept, removed, spans) in enumerate(without_repeats(texts, how.length)):
        got = rows[i]["_repeats"]
        assert (bytes(got["kept"]), got["n_bytes"] - len(got["kept"]), len(got["spans"])) == (kept, removed, spans), i
        assert rows[i]["text"] == texts[i]


def test_repeats_of_awkward_rows(spark):
    got = substring_dedup.remove_repeats(frame(spark)).collect()
    texts = [r[1] for r in odd_rows() if r[1] != LONG]
    plain = iter(without_repeats(texts, 200))
    want = sorted((len(LONG) if r[1] == LONG else next(plain)[1]) for r in odd_rows())
    assert sorted(r["_repeats"]["n_bytes"] - len(r["_repeats"]["kept"]) for r in got) == want
    assert substring_dedup.remove_repeats(frame(spark, [])).collect() == []
