"""Token alignment, draws towards a target, and the n-gram join, against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, pre_tokenizers

from tests.llm.helpers import LONG, ascii_lower, frame, near_groups, odd_rows
from tierstone.llm import cross_tokenizer, ngram_join, target_resampling
from tierstone.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD_TEXTS = [
    "a  b   c", " lead and trail  ", "tab\tline\n\nfeed\r\n", "é中🙂 ﬁ Ａ", "x　y\xa0z", "own ▁ mark", "<s> </s> <unk> <0x41>",
    "a<|endoftext|>b", "1234567 3.14 a.b,c;d", "\n", " ", "  ", "\n \n", "\x00\x07", "word" * 50, "ab, cd. Ef\nGh",
]


def _library_tokens(text):
    """(id, bytes) of both tokenizers by plain calls of their libraries."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    names = {i: t for t, i in a.get_vocab().items()}
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    # each byte-level letter's byte, found by encoding that byte alone
    letters = sorted(pre_tokenizers.ByteLevel.alphabet())
    printable = {chr(x): x for x in [*range(33, 127), *range(161, 173), *range(174, 256)]}
    rest = iter(x for x in range(256) if x not in printable.values())
    byte = printable | {c: next(rest) for c in letters if c not in printable}

    def pair(text):
        left = [(i, bytes(byte[c] for c in names[i])) for i in a.encode(" " + text, add_special_tokens=False).ids]
        right = []
        for i in model.encode(text):
            piece = model.id_to_piece(i)
            right.append((i, bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()))
        return left, right

    return [pair(t) for t in text]


def _brute_links(texts):
    """Per text: numbers, written groups and linked pairs of ids, comparing all ranges nearby."""
    out = []
    for text, (left, right) in zip(texts, _library_tokens([t or "" for t in texts])):
        spelt = (" " + (text or "")).encode()
        if not text or any(b"".join(x for _, x in side) != spelt for side in (left, right)):
            out.append((0, 0, [], []))
            continue
        ranges = []
        for side in (left, right):
            at, found = 0, []
            for i, x in side:
                found.append((i, at, at + len(x)))
                at += len(x)
            ranges.append(found)
        links = [(a, b) for a, x, y in ranges[0] for b, u, v in ranges[1] if x < v and u < y]
        cuts = sorted({y for _, _, y in ranges[0]} & {y for _, _, y in ranges[1]})
        groups, begin = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, x, y in side if begin <= x and y <= cut) for side in ranges))
            begin = cut
        out.append((len(left), len(right), groups, links))
    return out


def _scores(texts):
    found = _brute_links(texts)
    counts = Counter(pair for x in found for pair in x[3])
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    for n_a, n_b, groups, links in found:
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if links else ""
        best = sum(counts[x] == most[x[1]] for x in links)
        yield n_a, n_b, len(groups), len(links), digest, best, sum(counts[x] for x in links)


NAMES = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]


def test_links_of_awkward_texts(spark):
    rows = odd_rows() + [(100 + i, t, "en", "s", 1) for i, t in enumerate(ODD_TEXTS)]
    rows = [r for r in rows if r[1] != LONG] + [(500, LONG[:20_000], "en", "s", 1)]
    docs = frame(spark, rows, clashes=True)
    got = sorted(tuple(r[c] for c in ["doc_id", *NAMES]) for r in cross_tokenizer.link_scores(docs, A, B).collect() if r["doc_id"])
    want = sorted((r[0], *x) for r, x in zip(rows, _scores([r[1] for r in rows])) if r[0])
    assert got == want
    written = {r["doc_id"]: r["groups"] for r in cross_tokenizer.groups(docs, A, B).collect()}
    assert written[2] == "" and hashlib.sha256(written[500].encode()).hexdigest() == dict((x[0], x[5]) for x in want)[500]
    assert cross_tokenizer.link_scores(frame(spark, []), A, B).collect() == []


def test_links_in_many_blocks(spark, monkeypatch):
    """Blocks of a few texts count and resolve as one would; the sizes travel by closure."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").repartition(7)
    one = {r["doc_id"]: tuple(r[c] for c in NAMES) for r in QUERIES["op11_cross_tokenizer"](spark, SMALL).collect()}
    many = {r["doc_id"]: tuple(r[c] for c in NAMES) for r in cross_tokenizer.link_scores(docs, A, B).collect()}
    assert one == many


def test_links_of_given_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    short = [r for r in rows if len(r[1] or "") < 4000]
    docs = frame(spark, [(i, t, "", "", 0) for i, t in short])
    got = {r["doc_id"]: tuple(r[c] for c in NAMES) for r in cross_tokenizer.link_scores(docs, A, B).collect()}
    assert got == {i: x for (i, _), x in zip(short, _scores([t for _, t in short]))} and len(got) > 100


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(1, 60), max_size=50), st.sets(st.integers(1, 60), max_size=50))
def test_groups_end_where_both_end(a, b):
    ends_a, ends_b = (np.array(sorted(x | {60})) for x in (a, b))
    both = np.intersect1d(ends_a, ends_b)
    got = cross_tokenizer.group_ends(ends_a, ends_b)
    assert (got[0] == np.searchsorted(ends_a, both) + 1).all() and (got[1] == np.searchsorted(ends_b, both) + 1).all()


def _drawn(rows, target, draw):
    """doc_id -> (n_features, weight, score, rank) for rows with distinct ids."""

    def buckets(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text or ""))
        grams = [" ".join(w[i : i + k]) for k in range(1, draw.n + 1) for i in range(len(w) - k + 1)]
        return len(w), [zlib.crc32(x.encode()) % draw.buckets for x in grams]

    found = {i: buckets(t) for i, t in rows}
    s = Counter(x for _, b in found.values() for x in b)
    t = Counter(x for text in target for x in buckets(text)[1])
    all_s, all_t = s.total() + draw.buckets, t.total() + draw.buckets
    out, enough = {}, []
    for i, (n, b) in found.items():
        weight = sum(math.floor(1000 * math.log((t[x] + 1) * all_s / ((s[x] + 1) * all_t))) for x in b)
        h = int(hashlib.sha256(f"{draw.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out[i] = [len(b), weight, score, None]
        if n >= draw.least_words:
            enough.append((-score, i is None, i or 0, i))
    for rank, x in enumerate(sorted(enough)[: draw.percent * len(enough) // 100], 1):
        out[x[-1]][3] = rank
    return {i: tuple(x) for i, x in out.items()}


@pytest.mark.parametrize("n, chars", [(1, 1 << 18), (3, 40)])
def test_draws(spark, monkeypatch, n, chars):
    """Windows across the parts of a long text count once."""
    hasher = target_resampling.FeatureHasher(n, 97)
    text = "One two, three-four five;  six é7 eight " * 9
    whole = sorted(hasher.buckets(text)[1].tolist())
    monkeypatch.setattr(target_resampling, "PART_CHARS", chars)
    assert sorted(hasher.buckets(text)[1].tolist()) == whole
    rows = [(i, t) for i, t, *_ in odd_rows()]
    rows = list(dict(rows).items()) + [(1000 + i, f"some words of document {i} " * (i % 9)) for i in range(60)]
    target = [None, "", "Words of the target, of some kind", "words OF"]
    draw = target_resampling.Draw(n=n, buckets=97, least_words=5, percent=30)
    docs = frame(spark, [(i, t, "", "", 0) for i, t in rows], clashes=True)
    aim = spark.createDataFrame([(1, t) for t in target], "doc_id long, text string")
    found = target_resampling.resample(docs, aim, draw).collect()
    got = {r["doc_id"]: (r["n_features"], r["weight"], r["score"], r["rank"]) for r in found}
    assert got == _drawn(rows, target, draw) and sum(x[3] is not None for x in got.values()) > 10


def test_the_query_weighs_by_the_floored_mean(spark, tmp_path):
    """A long text scores no lower or higher for its length; means below zero are floored too."""
    rows = [(i, f"plain words of the document number {i} " * (1 + i % 9)) for i in range(40)]
    rows += [(100 + i, f"target words {i} " * 15) for i in range(20)] + [(200, None), (201, ""), (202, "one")]
    target = ["Target words", "words of one kind", None]
    frame(spark, [(i, t, "", "", 0) for i, t in rows]).write.parquet(f"{tmp_path}/documents.parquet")
    aim = spark.createDataFrame(list(enumerate(target)), "item_id long, text string")
    aim.write.parquet(f"{tmp_path}/benchmark.parquet")
    # sums by brute force, which the mean's floor turns into the weights asked for
    summed = _drawn(rows, target, target_resampling.Draw())
    want, scores = {}, []
    for i, (n, total, score, _) in summed.items():
        weight = math.floor(total / n) if n else 0
        want[i] = (n, weight, score - total + weight)
        scores += [(-want[i][2], i)] if n >= 20 else []
    drawn = {i: k for k, (_, i) in enumerate(sorted(scores)[: len(scores) * 10 // 100], 1)}
    got = {r["doc_id"]: r for r in QUERIES["op12_target_resampling"](spark, str(tmp_path)).collect()}
    assert {i: (r["n_features"], r["weight"], r["score"]) for i, r in got.items()} == want
    assert {i: r["rank"] for i, r in got.items() if r["rank"]} == drawn and len(drawn) >= 4
    assert any(w < 0 and total % n for (n, w, _), (_, total, *_) in zip(want.values(), summed.values()) if n)


def test_histograms_are_written_by_their_buckets(spark, monkeypatch):
    """One file for few buckets, however many tasks counted them, and the same gains."""
    draw = target_resampling.Draw(buckets=40)
    docs, aim = (frame(spark, [(i, f"{w} {i} x", "", "", 0) for i in range(30)]) for w in ("one two", "two"))
    found, target = (target_resampling.features(x, draw) for x in (docs, aim))
    one = target_resampling.gains(found, target, draw)
    assert len(one.inputFiles()) == 1
    monkeypatch.setattr(target_resampling, "BUCKETS_PER_TASK", 10)
    several = target_resampling.gains(found, target, draw)
    assert 1 < len(several.inputFiles()) <= 4
    assert sorted(one.collect()) == sorted(several.collect()) and one.count() == 40


def test_draws_of_repeated_rows_and_empty_tables(spark):
    """A third of all rows alike: ranks stay apart. Without documents or target nothing fails."""
    rows = [(7, "the same old words again and again", "", "", 0)] * 40 + [(i, f"other words {i}", "", "", 0) for i in range(100, 180)]
    draw = target_resampling.Draw(least_words=2, percent=50)
    found = target_resampling.resample(frame(spark, rows), frame(spark, []), draw).collect()
    ranks = sorted(r["rank"] for r in found if r["rank"])
    assert ranks == list(range(1, 61)) and len(found) == 120
    assert len({(r["weight"], r["score"]) for r in found if r["doc_id"] == 7}) == 1
    assert target_resampling.resample(frame(spark, []), frame(spark, [])).collect() == []


def _joined(df, bar=ngram_join.Bar()):
    return [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_groups(df, bar).collect()]


def test_ngram_groups_of_given_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = {i: (n, c) for i, n, c in ((r["doc_id"], r["n_shingles"], r["component_id"]) for r in QUERIES["op13_ngram_join"](spark, SMALL).collect())}
    assert got == near_groups(rows, 4, 85)


def test_ngram_groups_of_awkward_rows(spark):
    """Rows without an id stay apart unless their texts are near; a group without ids has none."""
    rows = odd_rows() + [(None, LONG, "", "", 0), (None, "some text only here twice", "", "", 0), (None, "some text only here twice", "", "", 0)]
    rows = [r for r in rows if r[0] != 9] + [(9, "One two", "", "", 0)] * 3
    got = Counter(_joined(frame(spark, rows, clashes=True)))
    numbered = [(i if r[0] is None else r[0], r[1]) for i, r in zip(range(10**6, 10**7), rows)]
    want = near_groups(numbered, 4, 85)
    expected = Counter()
    for (i, _), r in zip(numbered, rows):
        n, c = want[i]
        expected[r[0], n, None if c >= 10**6 else c] += 1
    assert got == expected and got[9, 1, 9] == 3 and got[None, 2, None] == 2
    assert _joined(frame(spark, [])) == [] and _joined(frame(spark, [(1, None, "", "", 0)])) == [(1, 0, 1)]


def _edited(base, share, r):
    return " ".join(f"e{r.randrange(10**9)}" if r.random() < share else w for w in base)


@pytest.mark.parametrize("members", [1024, 16])
def test_ngram_groups_about_the_bar(spark, monkeypatch, members):
    """Copies that are near their original, and those that are near each other alone."""
    r = random.Random(members)
    monkeypatch.setattr(ngram_join, "MEMBERS", members)
    base = [f"w{r.randrange(10**6)}" for _ in range(150)]
    texts = [" ".join(base)] + [_edited(base, r.choice([0.005, 0.01, 0.02, 0.04]), r) for _ in range(120)]
    for _ in range(25):  # far from the original, in pairs that are near each other
        half = _edited(base, 0.08, r).split()
        texts += [" ".join(half), _edited(half, 0.01, r)]
    texts += [" ".join(base[:n]) for n in (3, 4, 120, 130, 140)]
    rows = [(i, t, "", "", 0) for i, t in enumerate(texts)]
    r.shuffle(rows)
    got = {i: (n, c) for i, n, c in _joined(frame(spark, rows))}
    want = near_groups([x[:2] for x in rows], 4, 85)
    assert got == want and 20 < len({c for _, c in want.values()}) < len(rows) - 60


def test_filters_never_drop_a_linked_pair():
    r, bar = random.Random(3), ngram_join.Bar()
    for _ in range(300):
        n = r.randrange(1, 200)
        whole = [r.getrandbits(64) for _ in range(n + 40)]
        a, b = (np.array(sorted(r.sample(whole, n)), dtype=np.uint64) for _ in range(2))
        if r.random() < 0.7:
            b = np.unique(np.concatenate([a[r.randrange(max(1, n // 8)) :], b[: r.randrange(6)]]))
        if not bar.linked(a, b):
            continue
        x, y = a[: bar.prefix(len(a))], b[: bar.prefix(len(b))]
        first = np.intersect1d(x, y)[:1]
        assert len(first)
        at, to = (np.searchsorted(s, first) for s in (a, b))
        ranges = [np.bincount((s[i[0] + 1 :] >> np.uint64(57)).astype(int), minlength=ngram_join.CELLS)[None] for s, i in ((a, at), (b, to))]
        sizes = [np.array([len(s)]) for s in (a, b)]
        assert ngram_join._may_link(*sizes, at, to, *ranges, bar).all()
