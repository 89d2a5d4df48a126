"""Benchmark decontamination by template canonicalisation, in DataFrame functions alone.

Numbers, names and units become typed placeholders, so a question whose values were changed has
the same template as the original. Windows of templates are hash-joined; where they match, the
values in the slots are compared, and a window counts only as a consistent renaming (in it, one
value of the document for each value of the item; two values of the item may become the same).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from tierstone.sources import stage

MARK = "\u0001"
START = MARK + "s"
BITS = 1 << 16

# Patterns of the canonical form. A name is a word inside a sentence that begins with
# a capital and a small letter (words all in capitals are words like any other), a number a word
# that begins with a digit, a unit one of these words after a number.
DECIMAL = r"([0-9])[.,]([0-9])"
INSIDE = r"[^\x20\x09-\x0D.!?:…]"
NAME = r"\p{Lu}\p{Ll}"
NO_LETTER = r"[^\p{L}\p{N}\x01_]"
NO_WORD = NO_LETTER + "+"
UNITS = (
    "km|m|cm|mm|mi|miles|mile|ft|feet|foot|inches|inch|kg|g|mg|lb|lbs|pounds|pound|tons|ton|l|ml|liters|"
    "litres|gallons|gallon|s|sec|seconds|second|min|minutes|minute|h|hours|hour|days|day|weeks|week|months|"
    "month|years|year|percent|dollars|dollar|cents|cent|euros|euro|usd|eur|gbp|mph|kmh|celsius|fahrenheit|"
    "degrees|degree|watts|watt|kwh|volts|volt|bytes|kb|mb|gb|tb"
)


@dataclass(frozen=True)
class Match:
    """Windows of ``window`` words with at least ``literals`` plain ones. A document leaks an item
    if matches cover ``share`` of the item's windows, or ``run`` windows of a long item. Items of
    fewer words than a window are searched whole, those of fewer than ``short`` as lines only.
    A table is broadcast if it is counted to have at most ``broadcast_rows`` and ``broadcast_bytes``."""

    window: int = 8
    literals: int = 4
    share: float = 0.5
    run: int = 20
    short: int = 4
    broadcast_rows: int = 1_000_000
    broadcast_bytes: int = 128 << 20


def canonical(text: Column, starts: bool = False) -> Column:
    """Lower-case words with one space between; names and units marked with their type.

    With ``starts``, other words that begin like a name (at the start of a sentence, mostly) are
    marked too, with a mark of their own."""
    t = F.coalesce(text, F.lit(""))
    for _ in range(2):
        t = F.regexp_replace(t, DECIMAL, "$1_$2")
    t = F.replace(t, F.lit("\n"), F.lit(" "))
    # the blank first: it is found fast, and few blanks go on to the two conditions
    t = F.regexp_replace(t, rf" (?={NAME})(?<={INSIDE} {{1,40}})", f" {MARK}p")
    if starts:
        t = F.regexp_replace(F.concat(F.lit(" "), t), f"({NO_LETTER})(?={NAME})", f"$1{START}")
    t = F.trim(F.regexp_replace(F.lower(t), NO_WORD, " "))
    return F.regexp_replace(t, rf"([0-9]) ({UNITS})( |\z)", f"$1 {MARK}u$2$3")


def _split(canon: Column) -> Column:
    return F.filter(F.split(canon, " "), lambda w: w != "")


def tokens(text: Column) -> Column:
    return _split(canonical(text))


def _forms(df: DataFrame, *carry: str) -> DataFrame:
    """``carry`` and the words of column ``_text`` in three forms of the same length: ``_tokens``,
    ``_named`` with names at the start of sentences too, and ``_plain`` without any mark."""
    df = df.select(*carry, canonical(F.col("_text"), starts=True).alias("_canon"))
    return df.select(
        *carry,
        _split(F.replace("_canon", F.lit(START), F.lit(""))).alias("_tokens"),
        _split(F.replace("_canon", F.lit(START), F.lit(MARK + "p"))).alias("_named"),
        _split(F.regexp_replace("_canon", MARK + "[psu]", "")).alias("_plain"),
    )


def _is_number(word: Column) -> Column:
    return F.left(word, F.lit(1)).between("0", "9")


def typed(word: Column) -> Column:
    """The word, or the placeholder of its type."""
    return (
        F.when(word.startswith(MARK), F.left(word, F.lit(2)))
        .when(_is_number(word), F.lit(MARK + "n"))
        .otherwise(word)
    )


def _is_slot(word: Column) -> Column:
    return word.startswith(MARK) | _is_number(word)


def vocabulary(items: DataFrame) -> bytes:
    """Which of ``BITS`` hash values the words of the items have: a byte 1 or 0 for each, so its size
    is fixed. ``items`` has their ``_plain`` words."""
    words = items.select(F.explode("_plain").alias("word")).select(F.pmod(F.xxhash64("word"), F.lit(BITS)).alias("bit"))
    table = bytearray(b"0" * BITS)
    for r in words.distinct().toLocalIterator():  # as many as there are hash values at most
        table[r["bit"]] = ord("1")
    return bytes(table)


def _known(df: DataFrame, table: bytes) -> DataFrame:
    """Adds ``_known``, a byte per word: 1 if it can stand in an item's window, as a slot or a word
    of the items. A window that matches has eight such words in a row, so no other is hashed."""

    def known(x: Column) -> Column:
        held = F.substring(F.lit(table), F.pmod(F.xxhash64(x), F.lit(BITS)).cast("int") + 1, 1)
        return F.when(_is_slot(x), F.lit("1")).otherwise(held.cast("string"))

    return df.select("*", F.array_join(F.transform("_named", known), "").cast("binary").alias("_known"))


def _starts(df: DataFrame, width: int) -> Column:
    """Where windows of ``width`` words begin: everywhere, or where all their words are known.

    Columns that a lambda reads stand outside of it too: with one use alone the optimizer would put
    what makes them into the lambda, and run it once per element."""
    size = F.length("_known") if "_known" in df.columns else F.size("_plain")
    every = F.when(size >= width, F.sequence(F.lit(0), size - width)).otherwise(F.array().cast("array<int>"))
    if "_known" not in df.columns:
        return every
    run = F.lit(b"1" * width)
    return F.filter(every, lambda i: F.substring(F.col("_known"), i + 1, width) == run)


def _windowed(df: DataFrame, match: Match, *carry: str) -> DataFrame:
    """``carry``, ``pos``, ``form`` and ``key`` of the windows of the forms that ``_forms`` makes.

    Form 0 has the windows of ``_tokens`` that are literal enough, form 1 those of ``_named`` that
    are and differ from them, form 2 all windows of ``_plain`` that have a slot. A window without
    a slot is the same in all forms and made once."""
    w, many, few = match.window, 2 * match.window, match.window - match.literals

    def slots(i: Column) -> Column:
        """The slots of a window in one sum: those of form 0 as ``many``, names at starts as 1."""
        each = []
        for j in range(w):
            t, x = F.get("_tokens", i + j), F.get("_named", i + j)
            each.append(F.when(_is_slot(t), many).when(t != x, 1).otherwise(0))
        return sum(each[1:], each[0])

    def made(form: int, word, wanted) -> Column:
        def window(at: Column) -> Column:
            # fields of a lambda's variable are named by hand: in a lambda, aliases are lost
            key = F.xxhash64(*[word(at["i"] + j) for j in range(w)])
            return F.named_struct(F.lit("pos"), at["i"], F.lit("form"), F.lit(form), F.lit("key"), key)

        return F.transform(F.filter("_at", lambda at: wanted(at["n"])), window)

    found = df.select("*", _starts(df, w).alias("_starts"))
    counted = F.transform("_starts", lambda i: F.named_struct(F.lit("i"), i, F.lit("n"), slots(i)))
    found = found.select("*", counted.alias("_at"))
    windows = F.concat(
        made(0, lambda i: typed(F.get("_tokens", i)), lambda n: n < (few + 1) * many),
        made(1, lambda i: typed(F.get("_named", i)), lambda n: (n % many > 0) & (F.floor(n / many) + n % many <= few)),
        made(2, lambda i: F.get("_plain", i), lambda n: n >= many),
    )
    # A column of its own first, so that rows are made and joined in generated code. The outer form
    # infers no filter on the array: one would be pushed down and run the hashing once per element.
    rows = found.select(*carry, windows.alias("_windows")).select(*carry, F.explode_outer("_windows").alias("_w"))
    return rows.select(*carry, "_w.pos", "_w.form", "_w.key").where("key is not null")


def _short_keys(df: DataFrame, lengths: list[int], *carry: str) -> DataFrame:
    """``carry`` and ``key`` of every run of plain words that has one of ``lengths``."""

    def runs(n: int) -> Column:
        keys = F.transform(_starts(df, n), lambda i: F.xxhash64(F.lit(n), *[F.xxhash64(F.get("_plain", i + j)) for j in range(n)]))
        return F.when(F.size("_plain") >= n, keys).otherwise(F.array().cast("array<bigint>"))

    made = df.select(*carry, F.array_distinct(F.concat(*[runs(n) for n in lengths])).alias("_keys"))
    return made.select(*carry, F.explode_outer("_keys").alias("key")).where("key is not null")


def _whole_key(words: str, lengths: list[int]) -> Column:
    """The key of a run of words that has one of ``lengths``; null otherwise."""
    key = F.lit(None).cast("long")
    for n in lengths:
        hashed = F.xxhash64(F.lit(n), *[F.xxhash64(F.get(words, F.lit(j))) for j in range(n)])
        key = F.when(F.size(words) == n, hashed).otherwise(key)
    return key


def _short_leaks(split: DataFrame, narrow: DataFrame, items: DataFrame, match: Match) -> DataFrame:
    """Documents that hold a whole item of fewer words than a window, its values included: anywhere,
    or as a line of its own if it has fewer than ``short`` words, which any text may have.

    Items of the same words are one; each is one window."""
    lengths = sorted(r[0] for r in items.select(F.size("_plain")).distinct().collect())
    columns = "_id string, item_id long, n_items long, n_windows long, item_windows long, n_slots long"
    if not lengths:
        return split.sparkSession.createDataFrame([], columns)
    keys = items.groupBy(_whole_key("_plain", lengths).alias("key")).agg(
        F.min("item_id").alias("item_id"), F.count("*").alias("n_items")
    )
    keys = stage(keys, "bench_short")
    anywhere, alone = ([n for n in lengths if (n >= match.short) == wanted] for wanted in (True, False))
    found = []
    if anywhere:
        found.append(_short_keys(split, anywhere, "_id"))
    if alone:
        lines = _forms(narrow.select("_id", F.explode(F.split("_text", "\n")).alias("_text")), "_id")
        found.append(lines.select("_id", _whole_key("_plain", alone).alias("key")).where("key is not null"))
    rows = found[0] if len(found) == 1 else found[0].union(found[1])
    hits = rows.join(_small(keys, match), "key").select("_id", "item_id", "n_items").distinct()
    one = F.lit(1).cast("long")
    return hits.select(
        "_id", "item_id", "n_items",
        one.alias("n_windows"), one.alias("item_windows"), F.lit(0).cast("long").alias("n_slots"),
    )


def _small(df: DataFrame, match: Match) -> DataFrame:
    """A staged frame, broadcast if its rows are counted to be few and not large."""
    size = F.lit(64 + 16 * len(df.columns)).cast("long")
    for field in df.schema:
        if isinstance(field.dataType, ArrayType):  # of words
            size += F.coalesce(F.octet_length(F.array_join(field.name, "")) + 24 * F.size(field.name), F.lit(0))
        elif isinstance(field.dataType, StringType):
            size += F.coalesce(F.octet_length(field.name), F.lit(0))
    rows, held = df.agg(F.count("*"), F.sum(size)).first()
    return F.broadcast(df) if rows <= match.broadcast_rows and (held or 0) <= match.broadcast_bytes else df


def _span(pos: Column, match: Match) -> Column:
    return F.sequence(pos, pos + F.lit(match.window - 1))


def _slots(positions: Column) -> Column:
    """The distinct slots of the item at ``positions``, each with the word of the document there."""
    return F.array_distinct(
        F.transform(
            F.filter(positions, lambda p: _is_slot(F.get("_words", p))),
            # named by hand: in a lambda within another one, aliases are lost
            lambda p: F.named_struct(
                F.lit("item"), F.get("_words", p), F.lit("doc"), F.get("_tokens", p + F.col("shift"))
            ),
        )
    )


def _one_value_each(slots: Column) -> Column:
    return F.size(F.array_distinct(F.transform(slots, lambda s: s["item"]))) == F.size(slots)


def _identity(docs: DataFrame, text: str) -> Column:
    """The id of a row, or the digest of its text: rows without an id are known by their text."""
    own = F.concat(F.lit("text:"), F.md5(F.coalesce(docs[f"`{text}`"], F.lit("")).cast("binary")))
    return F.coalesce(docs["doc_id"].cast("long").cast("string"), own)


def leaks(docs: DataFrame, benchmark: DataFrame, match: Match = Match(), text: str = "text") -> DataFrame:
    """One row per document and item that it leaks: ``doc_id``, ``item_id``, ``n_items``,
    ``n_windows``, ``item_windows``, ``n_slots``.

    Items with the same template are one, under their least ``item_id``; ``n_items`` counts them.
    ``n_windows`` of the item's ``item_windows`` were found with consistent slots, and ``n_slots``
    values differ from the item's. A null text has no words. An item of fewer words than a window is
    one window of its own, found with its values and in any case; such items of the same words are
    one. Rows that repeat a ``doc_id`` are judged together. Rows without one are documents of their
    own, one for each text; their ``doc_id`` in the result is null.
    """
    found = _leaks(docs, benchmark, match, text)
    ident = F.when(~F.col("_id").startswith("text:"), F.col("_id").cast("long"))
    return found.select(ident.alias("doc_id"), *found.columns[1:])


def _leaks(docs: DataFrame, benchmark: DataFrame, match: Match, text: str) -> DataFrame:
    """As :func:`leaks`, by the identity of documents, ``_id``."""
    items = _forms(benchmark.select(benchmark["item_id"].cast("long").alias("item_id"), benchmark["text"].alias("_text")), "item_id")
    words = items.select("_plain")
    short = stage(items.where(F.size("_tokens").between(1, match.window - 1)).select("item_id", "_plain"), "bench_short_items")
    items = items.withColumn("template", F.sha2(F.array_join(F.transform("_tokens", typed), " "), 256))
    items = stage(
        items.where(F.size("_tokens") >= match.window).withColumn("n_items", F.count("*").over(Window.partitionBy("template")))
        .withColumn("first", F.row_number().over(Window.partitionBy("template").orderBy("item_id", "_tokens")) == 1)
        .withColumn("item_id", F.min("item_id").over(Window.partitionBy("template"))),
        "bench_items",
    )
    firsts = items.where("first").select("item_id", "n_items", F.col("_tokens").alias("_words"), F.col("_named").alias("_named_words"))
    # items of one template have the same windows but for the values that are plain words
    windows = stage(
        _windowed(items, match, "item_id").withColumnsRenamed({"pos": "item_pos", "form": "item_form"}).distinct(), "bench_windows"
    )
    sizes = windows.where("item_form = 0").groupBy("item_id").agg(F.count("*").alias("sized"))
    firsts = stage(firsts.join(sizes, "item_id", "left"), "bench_sizes")

    narrow = docs.select(_identity(docs, text).alias("_id"), docs[f"`{text}`"].alias("_text"))
    split = _known(_forms(narrow, "_id"), vocabulary(stage(words, "bench_words")))
    keys = stage(windows.select("key").distinct(), "bench_keys")
    found = stage(_windowed(split, match, "_id").join(_small(keys, match), "key", "left_semi"), "window_hits")
    ids = stage(found.select("_id").distinct(), "hit_ids")
    hit_docs = stage(
        _forms(narrow.join(_small(ids, match), "_id", "left_semi"), "_id").drop("_plain"),
        "hit_docs",
    )

    pairs = found.join(_small(windows, match), "key").withColumn("shift", F.col("pos") - F.col("item_pos"))
    # plain words match with their values; the other forms only if the slots agree
    plain = (F.col("form") == 2) | (F.col("item_form") == 2)
    as_named = (F.col("form") == 1) | (F.col("item_form") == 1)
    runs = pairs.where(~plain).groupBy("_id", "item_id", "shift", as_named.alias("named")).agg(F.collect_set("item_pos").alias("at"))
    runs = runs.join(hit_docs, "_id").join(_small(firsts.select("item_id", "_words", "_named_words"), match), "item_id")
    runs = runs.withColumn("_words", F.when(F.col("named"), F.col("_named_words")).otherwise(F.col("_words")))
    runs = runs.withColumn("_tokens", F.when(F.col("named"), F.col("_named")).otherwise(F.col("_tokens")))
    # a window counts if each value of the item in its slots stands for one value of the document
    runs = runs.withColumn("at", F.filter("at", lambda p: _one_value_each(_slots(_span(p, match)))))
    covered = F.array_distinct(F.flatten(F.transform("at", lambda p: _span(p, match))))
    changed = F.size(F.filter(_slots(covered), lambda s: s["item"] != s["doc"])).cast("long")
    # windows of form 0 are scored by themselves as well: of an item full of slots they are but a part
    hits = runs.select("_id", "item_id", F.explode("at").alias("item_pos"), (~F.col("named")).alias("form_0"), changed.alias("changed"))
    hits = hits.unionByName(
        pairs.where(plain).select("_id", "item_id", "item_pos", F.lit(False).alias("form_0"), F.lit(0).cast("long").alias("changed"))
    )
    scored = hits.groupBy("_id", "item_id").agg(
        F.countDistinct(F.when(F.col("form_0"), F.col("item_pos"))).alias("n_0"),
        F.max(F.when(F.col("form_0"), F.col("changed"))).alias("slots_0"),
        F.countDistinct("item_pos").alias("n_all"),
        F.max("changed").alias("slots_all"),
    )
    scored = scored.join(firsts, "item_id")
    all_windows = (F.size("_words") - match.window + 1).cast("long")

    def enough(n: str, of: Column) -> Column:
        return (F.col(n) >= of * match.share) | (F.col(n) >= match.run)

    by_0 = F.coalesce((F.col("n_0") > 0) & enough("n_0", F.col("sized")), F.lit(False))
    found = scored.where(by_0 | enough("n_all", all_windows)).select(
        "_id",
        "item_id",
        "n_items",
        F.when(by_0, F.col("n_0")).otherwise(F.col("n_all")).alias("n_windows"),
        F.when(by_0, F.col("sized")).otherwise(all_windows).alias("item_windows"),
        F.when(by_0, F.col("slots_0")).otherwise(F.col("slots_all")).alias("n_slots"),
    )
    return found.unionByName(_short_leaks(split, narrow, short, match))


def clean(docs: DataFrame, benchmark: DataFrame, match: Match = Match(), text: str = "text") -> DataFrame:
    """The documents that leak no item; columns as in ``docs``. Rows without an id go by their text."""
    found = _leaks(docs, benchmark, match, text).select(F.col("_id").alias("_leaks")).distinct()
    return docs.join(_small(stage(found, "leaks"), match), _identity(docs, text) == F.col("_leaks"), "left_anti")
