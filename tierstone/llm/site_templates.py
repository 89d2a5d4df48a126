"""Main text of web pages, with site templates removed.

Every element subtree of a page has a hash over its tags and text. Spark counts, per host, on how
many pages each hash occurs, copies of a page counting once; subtrees that recur across many pages
of their host are template and go. What is left is the article: menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles and reader comments are told by their tags, roles, classes and ids.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tierstone.sources import stage

# Fixed values of HTML: elements without content, elements whose content is no markup, elements
# that make blocks, and those that a following block start closes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol option p pre "
    "search section select summary table tbody td template tfoot th thead tr ul".split()
)
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
# What is not main text, by tag, by role, and by words in class or id.
DROP_TAGS = frozenset("nav footer aside form head noscript template select menu dialog search button svg canvas object".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
DROP_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice notices popup modal overlay newsletter subscribe signup sidebar nav navbar navigation menu breadcrumb "
    "breadcrumbs share sharing social related recommended comment comments disqus respond reply replies footer masthead "
    "pagination pager widget toolbar".split()
)
# Words that go with those in a name of the same meaning, as in "comment-list".
FRAME_WORDS = frozenset(
    "area bar block bottom box btn container content css div first fixed floating footer form global google group "
    "header heading holder icon icons inner item items js last left link links list main outer page panel primary "
    "reader readers right row secondary section site slot sticky text title top ui unit user users wrap wrapper".split()
)

_ATTRS = r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+"
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|textarea|title|iframe|noframes|noembed|xmp)\b" + _ATTRS + r">.*?(?:</\1\b[^>]*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)(" + _ATTRS + r")>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_NAMED = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+")
# An article or main part with less than one part in so many of the text that is left is no root.
ROOT_SHARE = 10


@dataclass(frozen=True)
class Template:
    """A subtree is template on at least ``pages`` pages that are ``share`` of its host's pages, or on
    ``many`` pages. Pages of a host with the same text count once.

    Inside an article the bar is higher and a share alone, so that passages which many articles
    quote stay."""

    pages: int = 8
    share: float = 0.1
    many: int = 1000
    article_pages: int = 20
    article_share: float = 0.9
    broadcast_rows: int = 200_000


def _names_extra(value: str) -> bool:
    """Whether a class or id names something beside the text: all of the name, not a word in it."""
    for name in value.split():
        found = {x for x in _WORD.findall(name) if len(x) > 1}
        if not DROP_WORDS.isdisjoint(found) and found <= DROP_WORDS | FRAME_WORDS:
            return True
    return False


def _dropped(tag: str, attrs: str, in_article: bool) -> str:
    """``by tag`` (or role, or because it is hidden), ``by name``, or nothing if it stays."""
    if tag in DROP_TAGS or (tag == "header" and not in_article):
        return "by tag"
    if "=" not in attrs and "hidden" not in attrs:
        return ""
    named = ""
    for name, value in _NAMED.findall(attrs):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id"):
            if tag not in ("html", "body", "main") and _names_extra(value):
                named = "by name"
        elif name == "role":
            if value in DROP_ROLES:
                return "by tag"
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            return "by tag"
        elif name == "style" and re.search(r"display\s*:\s*none", value):
            return "by tag"
    return named


class Page:
    """One parsed page: block elements with hashes, and blocks of text in page order."""

    def __init__(self, html: str):
        self.parent, self.drop, self.kind, self.digest = [-1], [""], [""], [0]
        self.in_main = [False]
        self.blocks: list[tuple[int, str]] = []
        self._parts: list[list[bytes]] = [[]]
        self._open: list[tuple[str, int, bool]] = [("", 0, False)]  # tag, block element, muted
        self._text: list[str] = []
        at = 0
        for m in _MARKUP.finditer(html):
            if m.start() > at:
                self._text.append(html[at : m.start()])
            at = m.end()
            tag = m[3] or m[6]
            if tag:
                tag, attrs = tag.lower(), m[4] or m[7] or ""
                if m[2] or m[5]:
                    self._end(tag)
                else:
                    self._start(tag, attrs)
        self._text.append(html[at:])
        while len(self._open) > 1:
            self._pop()
        self._flush()

    def _flush(self) -> None:
        """Text so far becomes a block of the innermost block element."""
        if not self._text:
            return
        # runs between inline tags are one text: a word may go on across a tag
        words = "".join(unescape(x) if "&" in x else x for x in self._text).split()
        self._text = []
        _, element, muted = self._open[-1]
        if words and not muted:
            text = " ".join(words)
            self.blocks.append((element, text))
            self._parts[element].append(text.encode("utf-8", "replace"))

    def _start(self, tag: str, attrs: str) -> None:
        if tag == "br":
            self._text.append(" ")
            return
        if tag in BLOCKS:
            self._flush()
            if tag in CLOSES:
                closes, within = CLOSES[tag]
                for name, _, _ in reversed(self._open):
                    if name in within:
                        break
                    if name in closes:
                        self._end(name)
                        break
            elif any(name == "p" for name, _, _ in self._open[1:]):
                self._end("p")
        if tag in VOID or attrs.endswith("/") and tag not in BLOCKS:
            return
        _, inside, muted = self._open[-1]
        if tag not in BLOCKS:
            if not muted and _dropped(tag, attrs, False):
                self._flush()
                muted = True
            self._open.append((tag, inside, muted))
            return
        in_article = self.kind[inside] == "article"
        self.parent.append(inside)
        self.drop.append(_dropped(tag, attrs, in_article))
        role_main = tag == "main" or "role" in attrs and re.search(r"\brole\s*=\s*[\"']?main\b", attrs, re.IGNORECASE)
        self.in_main.append(self.in_main[inside] or bool(role_main))
        kind = "article" if tag == "article" else "main" if role_main and not in_article else ""
        self.kind.append(kind or self.kind[inside])
        self.digest.append(0)
        self._parts.append([tag.encode()])
        self._open.append((tag, len(self.parent) - 1, muted))

    def _end(self, tag: str) -> None:
        if tag in BLOCKS:
            self._flush()
        for i in range(len(self._open) - 1, 0, -1):
            name = self._open[i][0]
            if name == tag:
                if self._open[i][2]:
                    self._text = []  # what a muted element held
                while len(self._open) > i:
                    self._pop()
                return
            if tag not in BLOCKS and name in BLOCKS:
                return  # a stray end of an inline element

    def _pop(self) -> None:
        tag, element, muted = self._open[-1]
        if tag in BLOCKS:
            self._flush()
            digest = hashlib.blake2b(b"\x00".join(self._parts[element]), digest_size=8).digest()
            if len(self._parts[element]) > 1:
                self.digest[element] = int.from_bytes(digest, "little", signed=True)
                self._parts[self.parent[element]].append(digest)
            self._parts[element] = []
        elif muted:
            self._text = []
        self._open.pop()

    def subtrees(self) -> set[tuple[int, bool]]:
        """Hashes of the subtrees with text, and whether they are part of an article."""
        return {
            (d, self.kind[p] == "article")
            for d, p in zip(self.digest[1:], self.parent[1:])
            if d
        }

    def main_text(self, templates: frozenset[int] = frozenset(), article_templates: frozenset[int] = frozenset()) -> str:
        n = len(self.parent)
        gone = [x == "by tag" for x in self.drop]
        for i in range(1, n):
            gone[i] = gone[i] or gone[self.parent[i]]
        # code points of each subtree, of articles and main parts where the page has them
        whole, rooted = [0] * n, [0] * n
        for e, t in self.blocks:
            if not gone[e]:
                whole[e] += len(t)
                rooted[e] += len(t) if self.kind[e] else 0
        for i in range(n - 1, 0, -1):
            whole[self.parent[i]] += whole[i]
            rooted[self.parent[i]] += rooted[i]
        held_by = rooted if rooted[0] else whole
        for i in range(1, n):
            p = self.parent[i]
            held = article_templates if self.kind[p] == "article" else templates
            # a name does not take most of the page's text with it, whatever it says
            by_name = self.drop[i] == "by name" and (self.kind[i] != "" or 2 * held_by[i] <= held_by[0])
            # the page's own frame is no template, however alike two pages are
            gone[i] = gone[i] or gone[p] or by_name or (self.digest[i] in held and self.kind[i] == self.kind[p])
        left = [(e, t) for e, t in self.blocks if not gone[e]]
        articles = [(e, t) for e, t in left if self.kind[e] == "article"]
        main = [(e, t) for e, t in left if self.in_main[e]]
        # teasers are articles too: the root is what holds the text
        sizes = [sum(len(t) for _, t in x) for x in (articles, main, left)]
        beside = sum(len(t) for e, t in main if self.kind[e] != "article")
        if 0 < sizes[0] >= beside and ROOT_SHARE * sizes[0] >= sizes[2]:
            left = articles
        elif 0 < sizes[1] and ROOT_SHARE * sizes[1] >= sizes[2]:
            left = main
        return "\n".join(t for _, t in left)


def host_of(url: Column) -> Column:
    """The host, in lower case; null if the url has none."""
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            hosts, bodies, digests, inside = [], [], [], []
            for host, body, html in zip(*[batch.column(i)[at : at + 256] for i in range(3)]):
                found = Page(html.as_py()).subtrees()
                hosts += [host.as_py()] * len(found)
                bodies += [body.as_py()] * len(found)
                digests += [d for d, _ in found]
                inside += [i for _, i in found]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip((hosts, bodies, digests, inside), kinds)],
                ["host", "body", "subtree", "inside"],
            )


def site_templates(pages: DataFrame, template: Template = Template()) -> DataFrame:
    """``host`` (64-bit hash), ``subtree``, ``inside``: subtrees that recur across the host's pages.

    Pages of a host that have the same text between their tags count as one, so that a group of
    copies is no template. A host keeps at most its mean number of subtrees a page divided by
    ``share``, or all subtrees divided by ``many``.
    """
    text = F.regexp_replace("html", "<[^>]*>", "")
    hosted = pages.select(
        F.xxhash64(host_of(pages["url"])).alias("host"), F.xxhash64(text).alias("body"), "html"
    ).where(host_of(pages["url"]).isNotNull() & F.col("html").isNotNull())
    seen = hosted.mapInArrow(_subtrees, "host long, body long, subtree long, inside boolean")
    bodies = F.count_distinct("body")
    counted = seen.groupBy("host", "subtree", "inside").agg(bodies.alias("n")).where(
        F.col("n") >= F.when(F.col("inside"), template.article_pages).otherwise(template.pages)
    )
    sizes = hosted.groupBy("host").agg(bodies.alias("pages"))
    share = F.when(F.col("inside"), template.article_share).otherwise(template.share)
    recurs = (F.col("n") >= F.col("pages") * share) | (~F.col("inside") & (F.col("n") >= template.many))
    return counted.join(sizes, "host").where(recurs).select("host", "subtree", "inside")


@F.arrow_udf(StringType())
def _main_text(htmls: pa.Array, templates: pa.Array, article_templates: pa.Array) -> pa.Array:
    out, last, held = [], None, (frozenset(), frozenset())
    for html, t, a in zip(htmls, templates, article_templates):
        key = (t.as_py(), a.as_py())
        if key != last:
            last, held = key, tuple(frozenset(x or ()) for x in key)
        out.append(Page(html.as_py() or "").main_text(*held))
    return pa.array(out, pa.string())


def extract(pages: DataFrame, template: Template = Template()) -> DataFrame:
    """``pages`` with a column ``_main``: the main text, empty if there is none.

    A null html is empty. Pages without a host share no template with others. Rows that repeat a
    page each have its text, and count once when recurrence is counted. A column named ``_main`` in the input is replaced.
    """
    own = [c for c in pages.columns if c != "_main"]
    found = stage(site_templates(pages, template), "site_templates")
    rows = found.count()
    lists = found.groupBy("host").agg(
        F.collect_list(F.when(~F.col("inside"), F.col("subtree"))).alias("_t"),
        F.collect_list(F.when(F.col("inside"), F.col("subtree"))).alias("_a"),
    )
    whole = pages.select(
        F.struct(*[pages[f"`{c}`"] for c in own]).alias("_row"),
        F.xxhash64(host_of(pages["url"])).alias("_host"),
        host_of(pages["url"]).isNotNull().alias("_has"),
    )
    host = F.when(F.col("_has"), F.col("_host"))
    if rows <= template.broadcast_rows:
        joined = whole.join(F.broadcast(lists), host == F.col("host"), "left")
    else:  # a host's pages are dealt to so many tasks, each with a copy of its short list
        salts = max(1, math.ceil(math.sqrt(rows)) // 100)
        dealt = whole.withColumn("_salt", F.pmod(F.xxhash64("_row.page_id"), F.lit(salts)))
        copies = lists.withColumn("_s", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
        joined = dealt.join(copies, (host == F.col("host")) & (F.col("_salt") == F.col("_s")), "left")
    return joined.select(
        *[F.col(f"_row.`{c}`").alias(c) for c in own],
        _main_text(F.col("_row.html"), F.col("_t"), F.col("_a")).alias("_main"),
    )
