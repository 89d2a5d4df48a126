"""Line-first quality rules, in DataFrame functions alone.

Every line is judged by itself (punctuation, navigation, shouting, repetition, boilerplate);
failing lines go, and a document that loses too much of its text with them is rejected. Base
counts over the whole text reject documents that are too short or repeat themselves.

All of it is per row: no shuffle, and no row depends on another.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The white space that separates words, and the symbols that count as noise.
SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"

# Fixed values of the line rules.
SENTENCE_END = r"[.!?:;…。][\"')\]»”’]*(" + SPACE + r"|\z)"
GOES_ON = r"^[\x20\x09-\x0D]*\p{Ll}"  # a line that begins in lower case
SEPARATORS = r"[|»›·•<>→]"
BOILERPLATE = (
    r"(?i)all rights reserved|copyright (\(c\)|©)|terms of (use|service)|privacy policy|"
    r"cookie (policy|settings)|accept (all )?cookies|enable javascript|javascript is disabled|"
    r"lorem ipsum|click here|sign up for|subscribe to|powered by|back to top|read more\z"
)


@dataclass(frozen=True)
class Rules:
    """Limits of the rules; shares are per word of the line or document.

    A line without the end of a sentence passes if it has ``min_wrapped_words`` and the next line
    with a word goes on in lower case, as wrapped prose does. A boilerplate phrase costs a short
    line; a long one may have one per 25 words."""

    min_words: int = 50
    max_repeat_percent: int = 50
    max_line_symbols: float = 0.25
    max_line_separators: float = 0.2
    max_line_exclamations: float = 0.3
    max_line_repeats: float = 0.3
    max_line_boilerplate: float = 0.04
    min_wrapped_words: int = 6
    min_kept_share: float = 0.5


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE + "+"), lambda w: w != "")


def _adjacent_repeats(words: Column) -> Column:
    """How many words equal the word before them."""
    same = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: a == b)
    return F.size(F.filter(same, lambda x: x))


def _count(line: Column, pattern: str) -> Column:
    return F.size(F.split(line, pattern, -1)) - 1


def _line_passes(line: Column, words: Column, following: Column, rules: Rules) -> Column:
    n = F.size(words)
    wrapped = (n >= rules.min_wrapped_words) & F.coalesce(following.rlike(GOES_ON), F.lit(False))
    phrases = F.when(line.rlike(BOILERPLATE), _count(line, BOILERPLATE)).otherwise(0)
    # other lines without any end of a sentence are headings, menus or lists of words
    return (
        (line.rlike(SENTENCE_END) | wrapped)
        & (_count(line, SYMBOLS) <= n * rules.max_line_symbols)
        & (_count(line, SEPARATORS) <= n * rules.max_line_separators)
        & (_count(line, "!") <= n * rules.max_line_exclamations)
        & (_adjacent_repeats(words) <= n * rules.max_line_repeats)
        & (phrases <= n * rules.max_line_boilerplate)
    )


def _repeat_words(h: Column, grams: Column, ranked: Column) -> Column:
    """Words covered by the 3-word windows that occur twice or more; see ``measure``."""
    twice = F.filter(
        F.sequence(F.lit(0), F.size(ranked) - 1),
        lambda i: (F.get(ranked, i)["g"] == F.get(ranked, i - 1)["g"])
        | (F.get(ranked, i)["g"] == F.get(ranked, i + 1)["g"]),
    )
    at = F.sort_array(F.transform(twice, lambda i: F.get(ranked, i)["i"]))
    steps = F.transform(
        F.arrays_zip(at.alias("a"), F.slice(at, 2, F.greatest(F.size(at), F.lit(1))).alias("b")),
        lambda s: F.coalesce(F.least(F.lit(3), s["b"] - s["a"]), F.lit(3)),
    )
    return F.aggregate(steps, F.lit(0), lambda total, x: total + x)


def measure(docs: DataFrame, rules: Rules = Rules(), text: str = "text") -> DataFrame:
    """``docs`` with the counts, the verdict and the cleaned text.

    Adds struct ``_quality`` with ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words`` (all long), ``base_failed``, ``kept`` and ``cleaned`` (the passing lines
    joined by a line feed). A struct cannot clash with columns of the input, but for one named
    ``_quality`` itself, which is replaced.

    A null text has no words and no lines: all counts are 0, it fails the base rule and its
    cleaned text is empty. Lines without a word are neither judged nor duplicates; they go with
    the cleaning. Windows are compared by 64-bit hashes within one text.
    """
    own = [c for c in docs.columns if c != "_quality"]
    # names of their own on the way, so that none of the input's can clash with the ones used here
    given = [f"_given{i}" for i in range(len(own))]
    df = docs.select(*[docs[f"`{c}`"].alias(g) for c, g in zip(own, given)])
    df = df.withColumn("_t", F.coalesce(given[own.index(text)], F.lit("")))
    df = df.withColumn("_lines", F.filter(F.split("_t", "\n", -1), lambda x: x.rlike(NOT_SPACE)))
    # words are split by line, once, for the lines as for the whole text
    df = df.withColumn("_by_line", F.transform("_lines", _words)).withColumn("_w", F.flatten("_by_line"))
    df = df.withColumn("_h", F.transform("_w", lambda w: F.xxhash64(w)))
    df = df.withColumn(
        "_g",
        F.when(
            F.size("_h") >= 3,
            F.transform(
                F.sequence(F.lit(0), F.size("_h") - 3),
                lambda i: F.xxhash64(F.get("_h", i), F.get("_h", i + 1), F.get("_h", i + 2)),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    df = df.withColumn(
        "_ranked",
        F.when(
            F.size(F.array_distinct("_g")) < F.size("_g"),
            F.sort_array(F.transform("_g", lambda g, i: F.struct(g.alias("g"), i.alias("i")))),
        ),
    )
    judged = F.transform(
        "_lines",
        lambda line, i: F.struct(
            line.alias("line"),
            F.size(F.get("_by_line", i)).alias("n"),
            _line_passes(line, F.get("_by_line", i), F.get("_lines", i + 1), rules).alias("ok"),
        ),
    )
    df = df.withColumn("_judged", F.filter(judged, lambda s: s["ok"]))
    repeat = F.when(F.col("_ranked").isNull(), 0).otherwise(
        _repeat_words(F.col("_h"), F.col("_g"), F.col("_ranked"))
    )
    df = df.select(
        *given,
        F.size("_w").cast("long").alias("_n"),
        F.length(F.array_join("_w", "")).cast("long").alias("_chars"),
        _count(F.col("_t"), SYMBOLS).cast("long").alias("_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("_dups"),
        repeat.cast("long").alias("_repeats"),
        F.aggregate("_judged", F.lit(0), lambda t, s: t + s["n"]).alias("_left"),
        F.array_join(F.transform("_judged", lambda s: s["line"]), "\n").alias("_cleaned"),
    )
    failed = (F.col("_n") < rules.min_words) | (
        100 * F.col("_repeats") > rules.max_repeat_percent * F.col("_n")
    )
    kept = ~failed & (F.col("_left") >= F.col("_n") * rules.min_kept_share)
    measures = F.struct(
        F.col("_n").alias("n_words"),
        F.col("_chars").alias("word_chars"),
        F.col("_symbols").alias("n_symbols"),
        F.col("_dups").alias("n_dup_lines"),
        F.col("_repeats").alias("n_repeat_words"),
        failed.alias("base_failed"),
        kept.alias("kept"),
        F.col("_cleaned").alias("cleaned"),
    )
    # through a generator of one row: a filter on the verdict must not be pushed below it, where
    # the rules' expressions would be put into each other and run once per element
    back = [F.col(g).alias(c) for c, g in zip(own, given)]
    return df.select(*back, F.explode(F.array(measures)).alias("_quality"))


def clean(docs: DataFrame, rules: Rules = Rules(), text: str = "text") -> DataFrame:
    """The kept documents with their passing lines as text; columns as in ``docs``.

    Rejected documents go. ``n_chars``, if there is one, is counted anew.
    """
    df = measure(docs, rules, text).where("_quality.kept")
    out = [
        F.col("_quality.cleaned").alias(c)
        if c == text
        else F.length("_quality.cleaned").cast(docs.schema[c].dataType).alias(c)
        if c == "n_chars"
        else df[f"`{c}`"]
        for c in docs.columns
        if c != "_quality"
    ]
    return df.select(*out)
