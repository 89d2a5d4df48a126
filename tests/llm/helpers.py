"""Awkward documents, and plain versions of the operators to compare with."""

import re
from collections import Counter, defaultdict

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# columns that clash with names the operators use inside
CLASHES = "_t string, _w string, key string, bucket string, n string, uid string, _row string, shard string, rank string, `odd name.x` string"

LONG = " ".join(f"word{i % 700}x{i * 7919 % 1009}" for i in range(30_000)) + "."
LINE = "A line that several documents share word for word, here and there."


def odd_rows():
    body = "It was a clear morning and the river ran slowly past the old mill. " * 3
    return [
        (1, None, "en", "a", None),
        (2, "", "en", "a", 0),
        (3, " \n\t \n", None, None, 5),
        (4, LINE + "\n" + body, "en", "a", 1),
        (5, body + "\n" + LINE, "en", "a", 1),
        (6, "  " + LINE.upper() + " \nshort\n\n" + LINE, "en", "a", 1),
        (7, LONG, "en", "a", 1),
        (8, LONG, "en", "a", 1),
        (9, "One two", "en", "a", 1),
        (9, "One two", "en", "a", 1),
        (10, "one TWO", "en", "a", 1),
        (11, "a" * 1000, "en", "a", 1),
        (12, "ab" * 700 + "é" * 300, "en", "a", 1),
        (None, "No id here, but some text that is long enough to be read.", None, None, None),
    ]


def frame(spark, rows=None, clashes=False):
    df = spark.createDataFrame(odd_rows() if rows is None else rows, DOCS)
    if clashes:
        names = [c.split()[0] if "`" not in c else "odd name.x" for c in CLASHES.split(", ")]
        df = df.selectExpr("*", *[f"'{i}' as `{c}`" for i, c in enumerate(names)])
    return df


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def near_groups(rows, size=5, percent=75):
    """id -> (set size, least id reachable), by comparing all sets that share a shingle."""
    sets = defaultdict(set)
    for ident, text in rows:
        w = words(ascii_lower(text or ""))
        sets[ident] |= {tuple(w[j : j + size]) for j in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    held = defaultdict(list)
    for i in sorted(sets):
        met = Counter()
        for s in sets[i]:
            met.update(held[s])
            held[s].append(i)
        for j, n in met.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}


def deduped_lines(rows):
    """(number of lines, kept lines) per row, ids in any order."""

    def key(line):
        return ascii_lower(line.strip(" \t\n\v\f\r"))

    owners = defaultdict(set)
    for ident, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                owners[key(line)].add(ident)
    out = []
    for ident, text in rows:
        lines = (text or "").split("\n")
        out.append((len(lines), [x for x in lines if len(owners.get(key(x), ())) < 2 or min(owners[key(x)]) == ident]))
    return out


def without_repeats(texts, length):
    """(kept bytes, removed, spans) per text, by counting every window."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        kept = bytes(c for c, g in zip(d, gone) if not g)
        out.append((kept, sum(gone), sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))))
    return out
