"""Main text of web pages by a maximum-scoring subsequence.

A page is a sequence of text runs and tags.  Every word scores positive, every tag negative, and one linear scan finds the
contiguous region with the largest sum.  The weights are log odds of being content, counted on labelled pages: of a word
by the kind and length of the block it is in and whether it is a link, of a tag by its name, and of a container by
the parts of its class and id.  A container whose parts speak against content (an advert, a box of comments) is in the
sequence with its outer tags alone, so that one in the middle of an article doesn't cut it in two; so are the elements
that HTML itself sets apart (``nav``, ``footer``, ``form`` ...).

Labelled pages are of two kinds: the corpus' own, whose authors marked the content with ``<article>`` (a bounded sample,
``SAMPLE`` pages with the smallest hash of page_id), and a few common layouts (``LAYOUTS``), in which the content is
bracketed.  In marked content all words weigh most and tags next to nothing, so no short block of it is lost, and what a
region has between two marked parts is left out.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.functions.batches import values

SAMPLE = 500
LIMIT = 4.0  # of a log odds
BORDER = 0.5  # of the tags of marked content; what a region has outside is left out
MARKED = 0.25  # least share of a page's words, without what is set apart, for its marks to be believed
BETWEEN = 0.01
AGAINST = -1.0  # log odds from which on a container is no content

_ATTRS = r"((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)(?:>|\Z)"  # a quote opens a value only after the equals sign
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|title|textarea|xmp|iframe|noembed|noframes|svg|math)\b" + _ATTRS + r".*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)" + _ATTRS,
    re.S | re.I,
)
ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre"
    " section select summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# elements that HTML defines as something other than content
APART = frozenset("nav footer aside form menu dialog button select option template noscript head object applet audio video canvas map datalist fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog toolbar".split())
MARKS = ("article", "main")
CONTAINERS = frozenset("div section article main ul ol dl table tr td details figure center span aside header".split())
GROUP = {**{f"h{i}": "h" for i in range(1, 7)}, **dict.fromkeys("p blockquote pre dd figcaption".split(), "p"), **dict.fromkeys("li dt".split(), "li"), **dict.fromkeys("td th caption".split(), "td")}
_CAMEL, _PART = re.compile(r"(?<=[a-z])(?=[A-Z])"), re.compile(r"[a-z]{2,}")

# Common layouts, one a line, content in brackets; a number stands for as many words.
LAYOUTS = """
<body><div id=header class=site-header><div class=logo>2</div><ul class=main-nav><li><a>1</a><li><a>1</a><li><a>2</a></ul></div><div id=content class=post-content>[<h1 id=top>7</h1><p>60</p><p>45</p><h2 id=search>2</h2><p>70</p><ul><li>9<li>12</ul><p>30</p>]<div class=post-share><a>1</a> <a>1</a></div><div class=post-comments id=comments><h3>2</h3><div class=comment>20</div><div class=comment>14</div></div></div><div class=sidebar><div class=widget>3 <a>4</a></div><div class=widget><ul><li><a>4</a><li><a>5</a></ul></div></div><div id=footer class=site-footer>9</div>
<body><div class=topbar><a>1</a> <a>1</a></div><div class="cookie-notice">18</div><div class=breadcrumbs><a>1</a> <a>2</a></div><div class=article-body>[<h1>9</h1><p>35</p>]<div class=advert>6</div>[<p>50</p><h2 id=comments>3</h2><p>40</p><table><tr><td>2<td>3</table><p>20</p>]</div><div class="related-posts"><h3>2</h3><ul><li><a>6</a><li><a>7</a></ul></div><div class=newsletter-signup>14</div><div class=footer>12 <a>2</a></div>
<body><div id=masthead class=banner>4</div><div class="menu nav"><a>1</a><a>1</a><a>1</a></div><div id=main class="main-content entry">[<h1 id=about>5</h1><blockquote>25</blockquote><p>80</p><pre>30</pre><p>55</p><p>5</p>]<div class="entry-meta">5</div><div class=entry-tags><a>1</a><a>1</a></div></div><div id=respond class="comment-respond reply">12</div><div class="author-bio widget">16</div><div class="content-sidebar sidebar">8</div><div class="copyright legal">8</div>
<body><div class="ad ads">5</div><div class=promo-banner>7</div><div class=story-wrapper><div class="story text">[<p>65</p><p>40</p><h3>4</h3><p>8</p><p>75</p><p>6</p>]</div><div class="social share-buttons"><a>1</a><a>1</a></div></div><div class=subscribe-box>15</div><div class=popup-modal>11</div><div class="ad-slot sponsored">8</div><div class="pagination pager"><a>1</a><a>1</a></div>
<body><div class="navbar toolbar"><a>1</a><a>1</a><a>1</a></div><div class=page><div class=post id=post>[<h1>6</h1><p>30<p>50<p>45<ol><li>10<li>15</ol><figure>3</figure><p>4<p>35]</div><div class="post-nav navigation"><a>4</a><a>4</a></div><section class="comments-area comments"><ol class=comment-list><li>18<li>22</ol></section></div><div class="widget-area secondary sidebar">3 <a>3</a></div><div class=footer-links><a>1</a><a>1</a></div>
<body><div class="alert notice consent gdpr">16</div><div class="site-nav menu"><ul><li><a>1</a><li><a>1</a></ul></div><section class="page-content body">[<h1>4</h1><div>40</div><div>60</div><h2>3</h2><p>7</p><div>55</div>]</section><div class="recommended trending"><a>7</a><a>6</a></div><div class="disqus discussion">5</div><div class="login signup">8</div><div class="disclaimer copyright">20</div>
<body><table><tr><td class=nav><a>1</a><a>1</a><a>1</a></td><td class=content>[<p>70</p><p>55</p><p>45</p>]</td><td class="sidebar ads">6</td></tr></table><div class="social related">3 <a>5</a></div><div class="overlay popup notification">9</div><div class=sponsor>6</div><div class="foot bottom footer">10</div>
""".strip().split("\n")  # fmt: skip


class Event:
    """``kind``: ``w`` for a text run, else a tag's ``<name`` or ``/name``; ``inside`` marked content."""

    __slots__ = ("kind", "text", "n", "inside", "block", "group", "link", "at")

    def __init__(self, kind: str, text: str, inside: bool, group: str, link: bool, at: int):
        self.kind, self.text, self.inside, self.group, self.link, self.at = kind, text, inside, group, link, at
        self.n = len(text.split())
        self.block = 0  # words of the block it is in


def parts(tag: str, attrs: str) -> list[str]:
    """Features of a container: its kind and a part of its class or id."""
    if not attrs or tag not in CONTAINERS:
        return []
    out = []
    for name, value in ATTR.findall(attrs):
        if name.lower() in ("class", "id"):
            out += [x.rstrip("s") for x in _PART.findall(_CAMEL.sub(" ", value.strip("\"'")).lower())]
    return [f"#{x}" for x in dict.fromkeys(out)]


def _hidden(attrs: str) -> bool:
    for name, value in ATTR.findall(attrs):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "role" and value in ROLES or name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


class Reader:
    """One page: its events, and where each container with a class or id begins and ends."""

    def __init__(self, page: str, odds: dict[str, float] | None, forms: bool = False):
        self.page, self.odds, self.forms = page, odds, forms
        self.events: list[Event] = []
        self.found: list[tuple[list[str], int, int]] = []
        self.stack: list[tuple[str, list[str], int]] = []  # open elements: tag, features, where
        self.open: list[Counter] = [Counter()]  # of open elements, by marks around
        self.root: int | None = None  # depth of the outermost element that is no content
        self.read()

    def apart(self, tag: str, attrs: str, features: list[str]) -> bool:
        inside = len(self.open) > 1
        if tag in APART and not (tag == "form" and self.forms) and not (tag == "footer" and any(c["blockquote"] for c in self.open)) or tag == "header" and not inside:
            return True
        if attrs and tag not in ("html", "body") and _hidden(attrs):
            return True
        return self.odds is not None and bool(features) and sum(self.odds.get(x, 0.0) for x in features) <= AGAINST

    def add(self, kind: str, text: str, at: int, group: str = "", link: bool = False) -> None:
        if self.root is None:
            self.events.append(Event(kind, text, len(self.open) > 1, group, link, at))

    def pop(self, at: int) -> None:
        tag, features, start = self.stack.pop()
        if features:
            self.found.append((features, start, at))
        marked = tag in MARKS
        if marked:
            self.open.pop()
        else:
            self.open[-1][tag] -= 1
        if self.root is not None and len(self.stack) <= self.root:
            self.root = None
        if tag in BLOCKS or self.root is None:
            self.add("/" + tag, "", at)

    def close(self, tag: str, at: int) -> None:
        if tag in MARKS:
            if any(t == tag for t, _, _ in self.stack if t in MARKS):
                while self.stack[-1][0] != tag:
                    self.pop(at)
                self.pop(at)
            return
        if not self.open[-1][tag]:
            return
        if tag not in BLOCKS:  # an inline tag closes no block
            k = len(self.stack) - 1
            while self.stack[k][0] != tag:
                if self.stack[k][0] in BLOCKS:
                    return
                k -= 1
        while self.stack[-1][0] != tag:
            self.pop(at)
        self.pop(at)

    def implied(self, tag: str, at: int) -> None:
        """What an opening tag closes."""
        again = {"li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
        if tag in BLOCKS and self.open[-1]["p"]:
            k = len(self.stack) - 1
            while self.stack[k][0] not in BLOCKS:
                k -= 1
            if self.stack[k][0] == "p":
                self.close("p", at)
        if tag in again:
            same = ("dt", "dd") if tag in ("dt", "dd") else ("td", "th") if tag in ("td", "th") else (tag,)
            for t, _, _ in reversed(self.stack):
                if t in same:
                    return self.close(t, at)
                if t in again[tag] or t in MARKS:
                    return None
        return None

    def unclosed(self) -> bool:
        """Whether the element that is no content lacks its end tag."""
        tag, _, start = self.stack[self.root]
        count = lambda x: len(re.findall(rf"{x}{re.escape(tag)}\b", self.page[start:], re.I))
        return count("<") > count("</")

    def read(self) -> None:
        at, link = 0, 0
        group = "d"

        def text(end: int) -> None:
            if end > at and self.root is None and not (run := self.page[at:end]).isspace():
                self.add("w", run, at, group, link > 0)
            elif end > at and self.root is None:
                self.add("w", " ", at, group, link > 0)

        for m in TOKEN.finditer(self.page):
            text(m.start())
            at = m.end()
            if not m[4] or self.page[at - 1] != ">":  # nothing to open, or cut off
                continue
            tag, start = m[4].lower(), m.start()
            if m[3]:
                if tag == "a":
                    link = 0
                self.close(tag, start)
            else:
                if tag == "a":
                    link = 1
                elif tag in BLOCKS:
                    link = 0
                    self.implied(tag, start)
                if tag in VOID:
                    self.add("<" + tag, "", start)
                    continue
                features = parts(tag, m[5] or "")
                if self.root is not None and tag in MARKS and self.stack[self.root][0] != "article" and not self.apart(tag, m[5] or "", features) and self.unclosed():
                    while len(self.stack) > self.root if self.root is not None else False:
                        self.pop(start)
                if tag in BLOCKS or self.root is None:
                    self.add("<" + tag, "", start)
                if self.root is None and self.apart(tag, m[5] or "", features):
                    self.root = len(self.stack)
                self.stack.append((tag, features, start))
                if tag in MARKS:
                    self.open.append(Counter())
                else:
                    self.open[-1][tag] += 1
            if tag in BLOCKS:
                group = next((GROUP.get(t, "d") for t, _, _ in reversed(self.stack) if t in BLOCKS), "d")
        text(len(self.page))
        while self.stack:
            self.pop(len(self.page))
        lo = words = 0
        for i, e in enumerate([*self.events, None]):
            if e is None or e.kind[1:] in BLOCKS:
                for x in self.events[lo:i]:
                    x.block = words
                lo, words = i, 0
            elif e.kind == "w":
                words += e.n


def feature(e: Event) -> str:
    """Which weight an event has."""
    if e.kind != "w":
        return ("[" if e.inside and e.kind[1:] not in MARKS else "") + e.kind
    if e.inside:
        return "[w"
    return f"w:{e.group}{'a' if e.link else ''}:{'s' if e.block < 10 else 'm' if e.block < 25 else 'l'}"


class Weights(dict):
    """feature -> score; a word of an unknown kind counts little, so does an unknown tag against it."""

    def __missing__(self, key: str) -> float:
        return 0.2 if key[0] == "w" else -0.02 if key[0] == "[" else -0.5


def weights(inside: Counter, outside: Counter) -> Weights:
    """Of counts in and out of content.  Words are positive and tags negative whatever the counts."""
    w = Weights()
    for k in {*inside, *outside}:
        odds = max(-LIMIT, min(LIMIT, math.log((inside[k] + 0.5) / (outside[k] + 0.5))))
        if k[0] == "#":
            w[k] = odds
        elif k[:2] == "w:":
            w[k] = max(0.05, odds)
        elif k[1:] in MARKS:
            w[k] = -BORDER
        elif k[0] != "[":
            w[k] = min(-0.25, (odds - LIMIT) / 2)
    w["[w"] = LIMIT
    return w


def label_counts(page: str, spans: list[tuple[int, int]], odds: dict[str, float] | None = None) -> tuple[Counter, Counter]:
    """Counts of features in and out of the given spans of a page; what ``odds`` speak against is out wherever it is."""
    r = Reader(page, odds, forms=True)
    inside, outside = Counter(), Counter()
    for features, lo, hi in r.found:
        out = odds is not None and sum(odds.get(x, 0.0) for x in features) <= AGAINST
        (inside if not out and any(lo < b and a < hi for a, b in spans) else outside).update(features)
    for e in r.events:
        e.inside = False
        if e.kind[1:] not in MARKS:
            (inside if any(a <= e.at < b for a, b in spans) else outside)[feature(e)] += e.n if e.kind == "w" else 1
    return inside, outside


def _layout(line: str) -> tuple[str, list[tuple[int, int]]]:
    line = re.sub(r"(?<![h\d])\d+", lambda m: " ".join(["w"] * int(m[0])), line)
    page, spans = "", []
    for i, piece in enumerate(re.split(r"[\[\]]", line)):
        if i % 2:
            spans.append((len(page), len(page) + len(piece)))
        page += piece
    return page, spans


def _default() -> tuple[Counter, Counter]:
    inside, outside = Counter(), Counter()
    for line in LAYOUTS:
        a, b = label_counts(*_layout(line))
        inside += a
        outside += b
    return inside, outside


BUNDLED = _default()
DEFAULT = weights(*BUNDLED)
_ARTICLE = re.compile(r"<article\b[^>]*>(.*?)</article\s*>", re.S | re.I)


def fit(pages: DataFrame, sample: int = SAMPLE) -> Weights:
    """Weights from the layouts and the marked articles of ``sample`` pages."""
    marked = pages.select("page_id", "html").where(F.lower("html").contains("<article"))
    pick = marked.select(F.col("page_id").alias("_pick")).orderBy(F.xxhash64("_pick"), "_pick").limit(sample).distinct()
    known = marked.join(F.broadcast(pick), F.col("page_id") == F.col("_pick"), "left_semi").select("html")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, outside = Counter(), Counter()
        for b in batches:
            for page in values(b.column(0)):
                if spans := [m.span(1) for m in _ARTICLE.finditer(page)]:
                    got = label_counts(page, spans, DEFAULT)
                    inside += got[0]
                    outside += got[1]
        keys = sorted({*inside, *outside})
        yield pa.record_batch([pa.array(keys, pa.string()), pa.array([inside[k] for k in keys], pa.int64()), pa.array([outside[k] for k in keys], pa.int64())], names=["k", "i", "o"])

    top = 5000  # features; the rest is so rare that it would have no weight
    rows = known.mapInArrow(count, "k string, i long, o long").groupBy("k").agg(F.sum("i").alias("i"), F.sum("o").alias("o")).orderBy(F.desc(F.col("i") + F.col("o")), "k").limit(top).collect()
    inside, outside = BUNDLED[0].copy(), BUNDLED[1].copy()
    for k, i, o in rows:
        if k[:2] == "w:" or k[0] == "#":
            inside[k] += i
            outside[k] += o
    return weights(inside, outside)


def best_region(scores: list[float]) -> tuple[int, int]:
    """First and one past the last element of the contiguous run with the largest positive sum; the first of equals."""
    best = here = 0.0
    lo = hi = start = 0
    for i, s in enumerate(scores):
        if here <= 0:
            here, start = 0.0, i
        here += s
        if here > best:
            best, lo, hi = here, start, i + 1
    return lo, hi


def main_text(page: str | None, w: Weights = DEFAULT) -> str:
    """The text of the best region: references decoded, white space folded, blocks joined by a line feed."""
    if not page:
        return ""
    events = Reader(page, w).events
    if not any(e.n for e in events):  # a page that is one form
        events = Reader(page, w, forms=True).events
    marked = sum(e.n for e in events if e.inside) >= MARKED * sum(e.n for e in events) > 0
    # between marked parts a tag is no reason to stop: what is outside is left out anyway
    lo, hi = best_region([w[feature(e)] * (e.n if e.kind == "w" else BETWEEN if marked and not e.inside else 1) for e in events])
    region = events[lo:hi]
    blocks: list[str] = []
    run: list[str] = []

    def close() -> None:
        if words := "".join(run).split():
            blocks.append(" ".join(words))
        run.clear()

    for e in region:
        if e.kind == "w":
            if e.inside or not marked:
                run.append(html.unescape(e.text))
        elif e.kind[1:] == "br":
            run.append(" ")
        elif e.kind[1:] in BLOCKS:
            close()
    close()
    return "\n".join(blocks)


def extract(pages: DataFrame, w: Weights | None = None, sample: int = SAMPLE) -> DataFrame:
    """page_id, url, text: one row per input row, from the whole html.

    Null or empty html, and a page without a word, give the empty text.  Truncated pages (open tags, cut references) are
    read as far as they go.  Repeated rows are returned as often; other columns are left behind; an empty table gives an
    empty result.
    """
    held = pages.sparkSession.sparkContext.broadcast(dict(w if w is not None else fit(pages, sample)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = Weights(held.value)
        for b in batches:
            yield pa.record_batch([b.column(0), b.column(1), pa.array([main_text(p, weight) for p in values(b.column(2))], pa.string())], names=["page_id", "url", "text"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(run, "page_id long, url string, text string")
