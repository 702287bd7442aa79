"""Main text of web pages by the maximum-scoring subsequence.

Method. A page is a sequence of words and tags. Words score positive and tags
negative; one linear scan finds the contiguous region of the greatest sum, which
is the article. The weights are the log-odds of each kind of token inside
against outside the article, counted on labelled pages: pages that mark their
article themselves (one ``article`` or ``main`` element). At most ``FIT_PAGES``
pages are counted, those with the smallest hash of their id; without any, words
weigh 1 and tags -3.25. Inside the region, elements that are no part of the
article by their name, a whole class, id or role (menus, adverts, notices, forms,
sidebars, reader comments, scripts, styles) are left out; their words weigh 0. An
element that holds the page's article or, without any article outside of such
elements, more than half of the page's words is not left out.

Character references are decoded, white space inside a block becomes one space,
and blocks are joined in page order by a line end.

Defined results: a null or empty html has the empty text and 0 characters; a
page without words too; repeated rows give a row each; an unclosed element ends
with its parent, an unclosed comment or script with the page; extra columns are
dropped; an empty table gives an empty result. Of regions with equal sums the
first wins. Whole pages are read whatever their length.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices

FIT_PAGES = 2000
WORD, TAG = 1.0, -3.25
LEAST = 0.01  # words weigh at least so much, tags at most its negative

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z) | <!\[CDATA\[.*?(?:\]\]>|\Z) | <[!?/](?![a-zA-Z])[^>]*>? | <![^>]*>?
    | <(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*+)>
    | <(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)>
    | (?P<text>[^<]++|<)""",
    re.S | re.X,
)
#: what is left of it where no > follows, so that no tag can end
_TAIL = re.compile(r"""<!--.*?(?:-->|\Z) | <!\[CDATA\[.*?(?:\]\]>|\Z) | <[!?/](?![a-zA-Z])[^>]*>? | <![^>]*>? | (?P<text>[^<]++|<)""", re.S | re.X)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript template svg math".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("b i em strong u s small big sub sup span font abbr acronym cite code kbd samp var mark q time tt ins del dfn bdi bdo ruby rt rp data wbr br img a label".split())
ENDS_ITSELF = frozenset("p li dt dd tr td th option thead tbody tfoot".split())
LEFT_OUT = frozenset("head nav header footer aside form button select menu dialog object canvas audio video map fieldset".split())
ARTICLE = frozenset(("article", "main"))
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
    "menu nav navbar navigation breadcrumb breadcrumbs sidebar widget widgets related recommended share sharing social comment comments "
    "disqus respond reply replies footer header masthead topbar popup modal overlay newsletter subscribe subscription signup login search "
    "pagination pager toolbar complementary contentinfo alert".split()
)
#: what a name of NAMES may be joined with in one class, id or role (ad-box, site-footer)
BESIDE = frozenset("site global top bottom left right primary secondary list links buttons bar box container wrapper wrap area inner outer block item items mobile desktop form icons section posts stories".split())
#: elements whose ids are anchors; those of sections inside an article are too, but for readers' parts
ANCHORED = frozenset("h1 h2 h3 h4 h5 h6 hgroup p dt pre blockquote figure".split())
READERS = frozenset("comments respond disqus".split())
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _named(token: str, in_article: bool) -> bool:
    """Whether a whole class, id or role names what is no part of an article."""
    parts = [p.lower() for p in _PARTS.findall(token)]
    names = [p for p in parts if p in NAMES and not (p == "header" and in_article)]
    return bool(names) and all(p in NAMES or p in BESIDE for p in parts)


def _left_out(name: str, attrs: str, in_article: bool) -> bool:
    """Whether an element is no part of an article by its name and attributes."""
    if name in LEFT_OUT and not (name == "header" and in_article):
        return True
    if not attrs or name in ("html", "body") or name in ARTICLE:
        return False
    for m in _ATTRIBUTE.finditer(attrs):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True
        if key == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return True
        elif key == "id":
            if name not in ANCHORED and (value.lower() in READERS or not (name == "section" and in_article)) and _named(value, in_article):
                return True
        elif key in ("class", "role") and any(_named(x, in_article) for x in value.split()):
            return True
    return False


class _Element:
    """An open or closed block element of a page."""

    __slots__ = ("above", "inner", "name", "skipped", "words")

    def __init__(self, name: str, above: _Element | None, skipped: bool):
        self.name, self.above, self.skipped, self.words = name, above, skipped, 0
        self.inner = above is not None and (above.inner or above.name in ARTICLE)  # inside an article


def _settle(elements: list[_Element]) -> None:
    """Decides for each element whether it is left out, with all in it. What
    holds the page's article is not: the outermost article or main element
    outside of all that could be left out; if there is none, the longest one, or
    what holds more than half of the page's words."""
    top = elements[0]
    for e in reversed(elements[1:]):
        e.above.words += e.words
    below = {top: False}
    for e in elements[1:]:
        below[e] = below[e.above] or e.skipped
    marked = [e for e in elements if e.name in ARTICLE and not e.inner]
    if not any(not below[e] and e.words for e in marked):
        kept = max(marked, key=lambda e: (e.words, e.name == "main"), default=None)
        while kept is not None:
            kept.skipped, kept = False, kept.above
        for e in elements:
            if e.skipped and 2 * e.words > top.words:
                e.skipped = False
    for e in elements[1:]:
        e.skipped = e.skipped or e.above.skipped


def units(html: str) -> Iterator[tuple[str, str, bool, bool]]:
    """(kind, text, new block, inside an article) of the page's words and tags.
    Kind is ``word`` (a run of text), ``link`` (text of a link), ``out`` (text
    that is left out) or a tag name."""
    elements = [_Element("", None, False)]
    seq = list(_parse(html, elements))
    _settle(elements)
    for kind, text, block, in_article, element in seq:
        if element is None or not element.skipped:
            yield kind, text, block, in_article
        elif kind != "space":
            yield "out", text, block, in_article


def _parse(html: str, elements: list[_Element]) -> Iterator[tuple[str, str, bool, bool, _Element | None]]:
    """The units before any is left out, texts with the element they are in.
    Adds the page's elements, with the words directly in them."""
    stack, opened = [elements[0]], Counter()
    links = articles = at = 0
    last = html.rfind(">")
    while at < len(html):
        m = (_TOKEN if at <= last else _TAIL).match(html, at)
        if m is None:
            break
        at = m.end()
        if (text := m["text"]) is not None:
            if not text.isspace():
                text = unescape(text)
                stack[-1].words += len(text.split())
                yield ("link" if links else "word"), text, False, articles > 0, stack[-1]
            else:
                yield "space", " ", False, articles > 0, stack[-1]
            continue
        if m.re is _TAIL or (name := m["name"] or m["name2"]) is None:
            continue
        name, attrs = name.lower(), m["attrs"] or m["attrs2"] or ""
        block = name not in INLINE
        if m["end"] or m["end2"]:
            yield name, "", block, articles > 0, None
            if name == "a":
                links = 0
            elif block and opened[name]:
                while True:
                    e = stack.pop()
                    opened[e.name] -= 1
                    articles -= e.name in ARTICLE
                    if e.name == name:
                        break
            continue
        if block and name not in VOID:
            while stack[-1].name in ENDS_ITSELF and (stack[-1].name in ("p", name) or name in ENDS_ITSELF and stack[-1].name in ("td", "th") and name == "tr"):
                opened[stack.pop().name] -= 1
        yield name, "", block, articles > 0, None
        if name in RAW:
            if not attrs.rstrip().endswith("/") or name not in ("svg", "math"):
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(html, at)
                at = end.end() if end else len(html)
        elif name in VOID:
            pass
        elif name == "a":
            links = 1
        elif block:
            elements.append(_Element(name, stack[-1], _left_out(name, attrs, articles > 0)))
            stack.append(elements[-1])
            opened[name] += 1
            articles += name in ARTICLE


def count_kinds(html: str, inside: Counter, outside: Counter) -> None:
    """Count a labelled page's tokens inside and outside its article; a page
    that does not mark exactly one article counts nothing."""
    here: tuple[Counter, Counter] = (Counter(), Counter())
    marks = 0
    for kind, text, _, in_article in units(html):
        marks += kind in ARTICLE
        if kind not in ("space", "out"):
            here[in_article][kind] += len(text.split()) if kind in ("word", "link") else 1
    if marks == 2:
        inside.update(here[1])
        outside.update(here[0])


def weights(inside: dict[str, int], outside: dict[str, int]) -> dict[str, float]:
    """Log-odds of each kind; words positive, tags negative."""
    n_in, n_out = sum(inside.values()), sum(outside.values())
    if not n_in or not n_out:
        return {}
    kinds = {*inside, *outside}
    out = {}
    for kind in kinds:
        odds = math.log((inside.get(kind, 0) + 0.5) / (n_in + 0.5 * len(kinds))) - math.log((outside.get(kind, 0) + 0.5) / (n_out + 0.5 * len(kinds)))
        out[kind] = max(odds, LEAST) if kind in ("word", "link") else min(odds, -LEAST)
    out["word"] = max(out.get("word", WORD), 0.1)
    return out


def main_text(html: str, weight: dict[str, float]) -> str:
    """Text of the region with the greatest sum of weights."""
    seq = list(units(html))
    best = total = 0.0
    first = start = end = 0
    for i, (kind, text, _, _) in enumerate(seq):
        if total <= 0:
            total, first = 0.0, i
        if kind in ("word", "link"):
            total += len(text.split()) * weight.get(kind, WORD)
        elif kind not in ("space", "out"):
            total += weight.get(kind, TAG)
        if total > best:
            best, start, end = total, first, i + 1
    # a page's one article is whole, whatever the lists and tables in it weigh
    own = [i for i, (kind, _, _, in_article) in enumerate(seq) if in_article and kind in ("word", "link")]
    if own and sum(kind in ARTICLE and not inner for kind, _, _, inner in seq) == 1:
        start, end = (min(start, own[0]), max(end, own[-1] + 1)) if best else (own[0], own[-1] + 1)
    blocks: list[str] = []
    parts: list[str] = []
    for kind, text, block, _ in seq[start:end]:
        if block:
            blocks.append(" ".join("".join(parts).split()))
            parts = []
        elif kind in ("word", "link", "space"):
            parts.append(text)
        elif kind == "br":
            parts.append(" ")
    blocks.append(" ".join("".join(parts).split()))
    return "\n".join(b for b in blocks if b)


_COUNTS = T.StructType([T.StructField("kind", T.StringType()), T.StructField("n_in", T.LongType()), T.StructField("n_out", T.LongType())])


def fit_weights(pages: DataFrame, rows: int = FIT_PAGES, key: str = "page_id", html: str = "html") -> dict[str, float]:
    """Weights from the labelled pages among ``rows`` pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, outside = Counter(), Counter()
        for batch in batches:
            for page in batch.column(0).to_pylist():
                count_kinds(page or "", inside, outside)
        kinds = sorted({*inside, *outside})
        yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array([inside[k] for k in kinds], pa.int64()), pa.array([outside[k] for k in kinds], pa.int64())], names=_COUNTS.names)

    # ids are chosen on narrow rows; the pages themselves are only filtered
    ids = pages.select(F.col(key).alias("_k")).distinct().orderBy(F.xxhash64("_k"), "_k").limit(rows)
    sample = pages.select(F.col(key).alias("_k"), F.col(html).cast("string").alias("h")).join(F.broadcast(ids), "_k", "left_semi").select("h").limit(rows)
    # tag names of a bounded sample: few rows
    got = sample.mapInArrow(run, _COUNTS).groupBy("kind").agg(F.sum("n_in").alias("n_in"), F.sum("n_out").alias("n_out")).collect()
    return weights({r["kind"]: r["n_in"] for r in got}, {r["kind"]: r["n_out"] for r in got})


TEXTS = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])


def extract(pages: DataFrame, weight: dict[str, float], key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 500, text=2):
                texts = [main_text(h or "", weight) for h in batch.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=TEXTS.names)

    return pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html")).mapInArrow(run, TEXTS)
