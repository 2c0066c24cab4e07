"""Main text of web pages (operator 2).

The standard library's event parser streams through a page once and cuts it into
lines, one for each block of text, with the number of tags and of characters
inside and outside links, and the element that holds it.  Each line has a
text-to-tag ratio; the ratios are smoothed with a Gaussian over neighbouring
lines, and lines above a threshold (a share of their standard deviation over
zero) form clusters.  The content region is the element that holds the clusters:
the smallest main element or outermost article with nearly all of the text that
those hold and no other with clusters beside it, or else all of them, or without any
the deepest container around the clusters.  All lines of the region are returned,
short ones and lists of links too.

What is left out in a region: elements that are never text of an article (scripts,
navigation, forms, asides, ...); elements whose class, id or role says so, as whole names, not as a part
of one: ``sidebar`` and ``sidebar-left``, but not ``no-sidebar`` or ``related-work``.  Density has the last word:
a heading, or an element with most of the page's text, is not cut for its name, and names that can be a topic
(``search``, ``cookies``, ``share``) cut an element inside the region only if its own text-to-tag ratio is under the
threshold.

Elements are numbers with a parent, and sums go up from child to parent once, so the time is in
proportion to the page, however deep its open tags are.

Defined results: null or empty html, or a page without text, gives empty text;
markup that is cut off or left open is read to its end; pages of any length are read whole; repeated rows are each
extracted; null ids and urls pass through; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from castline.llm.arrow import batch, slices
from castline.llm.common import table

#: Lines either side that the Gaussian reaches, and its width in lines.
RADIUS, SIGMA = 2, 1.0
#: Threshold of a clustered line, in standard deviations of the smoothed ratios.
DEVIATIONS = 0.5
#: Shares of the clusters' text that articles need to be the region, and of the articles' text that one needs to be it alone.
ARTICLE_SHARE, ELEMENT_SHARE = 0.25, 0.9

# HTML's elements by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary
    table tbody td tfoot th thead title tr ul""".split())
CLOSES_P = BLOCK - frozenset("body head html td th tr tbody thead tfoot caption title".split())
SCOPE = frozenset("html body table td th caption article section main div nav aside header footer form blockquote "
                  "figure details dialog fieldset".split())
#: What can hold a whole article, and the root; others (section, blockquote, p, ...) are parts of one.
CONTAINER = frozenset(["", *"html body article main center div td".split()])
ARTICLE = frozenset("article main".split())
CELL = frozenset("td th".split())
SIBLING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"},
           "option": {"option"}}
NEVER = frozenset("""script style noscript template head title nav aside footer form button select option textarea input
    iframe object embed svg canvas audio video dialog menu search""".split())
SITE_PART = frozenset(["header"])
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Names in class, id or role that mark what is not the article.
OUTSIDE = frozenset("""ad ads adv advert adverts advertisement advertising adbox adsbygoogle breadcrumb breadcrumbs comment
    comments complementary consent contentinfo disqus footer gdpr masthead menu menubar nav navbar navigation newsletter
    overlay pager pagination popup promo promotion respond sidebar signup sponsor sponsored subscribe subscription tagcloud
    toolbar widget widgets""".split())
#: Names that also are topics or parts of an article: these cut thin elements only.
TOPIC = frozenset("""banner cookie cookies header hidden login modal notice notices recommended related replies reply search
    share sharing skip social""".split())
#: Words that say where such an element is, or of what kind.
PLACE = frozenset("""area bar block bottom box container group holder inner item items left list outer panel primary right row
    secondary section site top wrap wrapper""".split())
COMMENT = frozenset(["comment", "comments"])
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
#: Names that mark the article; an element that has one is not cut for another name, but for that of comments.
INSIDE = frozenset("article articlebody body content entry main post story text".split())
#: How an element may be cut: not, if it is thin, if it does not hold most of the text, for its comments, always.
NOT, THIN, NAMED, COMMENTS, ALWAYS = range(5)


def named(attrs: list[tuple[str, str | None]]) -> list[set[str]]:
    """The words of each name in class, id and role."""
    found = " ".join(v or "" for k, v in attrs if k in ("class", "id", "role"))
    return [words for name in found.split() if (words := {w.lower() for w in WORD.findall(name)})]


def how_cut(tag: str, attrs: list[tuple[str, str | None]], in_article: bool) -> int:
    """May the element be left out?"""
    if tag in NEVER or tag in SITE_PART and not in_article:
        return ALWAYS
    if not attrs or tag in ("html", "body") or tag in HEADING:
        return NOT
    told = {k: (v or "") for k, v in attrs}
    if "hidden" in told or told.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", told.get("style", "")):
        return ALWAYS
    names = named(attrs)
    marks = [words for words in names if words <= OUTSIDE | TOPIC | PLACE]
    if any(words & COMMENT for words in marks):
        return COMMENTS
    if tag in ("article", "main") or any(len(words) == 1 and words <= INSIDE for words in names):
        return NOT
    if any(words & OUTSIDE or len(words & TOPIC) > 1 for words in marks):
        return NAMED
    return THIN if any(words & TOPIC for words in marks) else NOT


class Line:
    """A block of text: its tags, characters in links, and the element that holds it."""

    __slots__ = ("text", "tags", "chars", "linked", "element", "tag")

    def __init__(self, text: str, tags: int, linked: int, element: int, tag: str) -> None:
        self.text, self.tags, self.chars, self.linked = text, tags, len(text), linked
        self.element, self.tag = element, tag

    @property
    def menu(self) -> bool:
        """An item that is all link."""
        return self.tag == "li" and self.linked >= 0.9 * self.chars

    @property
    def ratio(self) -> float:
        return 0.0 if self.menu else max(self.chars - self.linked, 0) / (1 + self.tags)


class Page(HTMLParser):
    """Cuts a page into lines as its events come."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        # of each element number: its kind, parent, how it may be cut
        self.kind, self.parent, self.how = [""], [0], [NOT]
        # the open elements: tag, element number, innermost block's tag; and their places by tag
        self.open: list[tuple[str, int, str]] = [("", 0, "")]
        self.places: dict[str, list[int]] = {}
        self.pieces: list[str] = []
        self.tags = self.linked = 0

    def is_open(self, *tags: str) -> bool:
        return any(self.places.get(t) for t in tags)

    def end_line(self) -> None:
        text = " ".join("".join(self.pieces).split()) if self.pieces else ""
        if text:
            _, number, block = self.open[-1]
            self.lines.append(Line(text, self.tags, self.linked, number, block))
        self.pieces, self.tags, self.linked = [], 0, 0

    def leave(self, at: int) -> None:
        """Close all elements from a place in the stack on."""
        for tag, _, _ in reversed(self.open[at:]):
            self.places[tag].pop()
        del self.open[at:]

    def find(self, tags, until=frozenset()) -> int:
        """The place of the innermost open element of ``tags``, if none of ``until`` lies inside it."""
        at = max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)
        barrier = max((self.places[t][-1] for t in until if self.places.get(t)), default=-1)
        return at if at >= barrier else -1

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self.pieces.append(" ")
        if tag in CELL:
            self.pieces.append(" ")
        elif tag in BLOCK:
            self.end_line()
        self.tags += 1
        if tag in VOID:
            return
        if tag in CLOSES_P and (at := self.find(("p",), SCOPE)) > 0:
            self.leave(at)
        if tag in SIBLING and (at := self.find(SIBLING[tag], SCOPE | {"ul", "ol", "dl", "select"} - SIBLING[tag])) > 0:
            self.leave(at)
        self.how.append(how_cut(tag, attrs, self.is_open("article", "main")))
        self.kind.append("article" if tag == "article" or ("itemprop", "articleBody") in attrs
                         else "main" if ("role", "main") in attrs else tag)
        self.parent.append(self.open[-1][1])
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, len(self.kind) - 1, tag if tag in BLOCK else self.open[-1][2]))

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCK and tag not in CELL:
            self.end_line()
        if tag in VOID:
            return
        at = self.find((tag,), SCOPE - {tag} if tag not in SCOPE else frozenset())
        if at > 0:
            self.leave(at)

    def handle_data(self, data: str) -> None:
        if self.open[-1][0] in ("script", "style"):
            return
        self.pieces.append(data)
        if self.is_open("a"):
            self.linked += len(" ".join(data.split()))

    # ------------------------------------------------- sums over elements: a child has a higher number than its parent
    def summed(self, amounts: list[float]) -> list[float]:
        """Of each element the amounts of the lines inside it."""
        total = [0.0] * len(self.kind)
        for x, amount in zip(self.lines, amounts, strict=True):
            total[x.element] += amount
        for n in range(len(total) - 1, 0, -1):
            total[self.parent[n]] += total[n]
        return total

    def below(self, marked) -> list[bool]:
        """Is the element, or one around it, marked?"""
        inside = [bool(marked(0))]
        for n in range(1, len(self.kind)):
            inside.append(inside[self.parent[n]] or bool(marked(n)))
        return inside


def read_page(html: str) -> Page:
    page = Page()
    page.feed(html)
    page.close()
    page.end_line()
    return page


def smoothed(ratios: list[float], radius: int = RADIUS, sigma: float = SIGMA) -> list[float]:
    """Gaussian smoothing; the weights that fall off the page are left out."""
    weights = [math.exp(-(k * k) / (2 * sigma * sigma)) for k in range(-radius, radius + 1)]
    out = []
    for i in range(len(ratios)):
        near = [(w, ratios[i + k]) for k, w in zip(range(-radius, radius + 1), weights, strict=True) if 0 <= i + k < len(ratios)]
        out.append(sum(w * r for w, r in near) / sum(w for w, _ in near))
    return out


def clusters(ratios: list[float]) -> tuple[list[float], float]:
    """The smoothed ratio of lines above the threshold, 0 for the others; and the threshold."""
    smooth = smoothed(ratios)
    mean = sum(smooth) / len(smooth)
    limit = DEVIATIONS * math.sqrt(sum((s - mean) ** 2 for s in smooth) / len(smooth))
    return [s if r > 0 and s >= limit else 0.0 for s, r in zip(smooth, ratios, strict=True)], limit


def region(page: Page, cut: list[bool], text: list[float]) -> tuple[set[int], bool]:
    """Element numbers of the content, and whether they are articles or main elements.

    ``text`` has the characters outside links of clustered lines, 0 for the others.
    """
    kind, parent = page.kind, page.parent
    # The main elements around an element, down to its outermost article; articles inside that one are parts of it.
    chain, up = [0] * len(kind), [0] * len(kind)
    for n in range(1, len(kind)):
        chain[n] = chain[parent[n]]
        if kind[n] in ARTICLE and kind[chain[n]] != "article":
            chain[n], up[n] = n, chain[n]
    held, size = [0.0] * len(kind), [0] * len(kind)
    for x, n_text in zip(page.lines, text, strict=True):
        held[chain[x.element]] += n_text
        size[chain[x.element]] += 1
    ends = [n for n in range(1, len(kind)) if chain[n] == n]
    # How many of them have clustered text of their own: inside each, and around it.
    own = [int(h > 0) for h in held]
    within, around = list(own), [0] * len(kind)
    for n in ends:
        around[n] = around[up[n]] + (own[up[n]] if up[n] else 0)
    for n in reversed(ends):
        held[up[n]] += held[n]
        size[up[n]] += size[n]
        within[up[n]] += within[n]
    outer = {n for n in ends if up[n] == 0 and size[n] and not cut[n]}
    inside = sum(held[n] for n in outer)
    whole = sum(text)
    if not whole:
        return (outer, True) if outer else (set(), False)
    if inside > 0 and inside >= ARTICLE_SHARE * whole:
        # Alone: nearly all of the text, and clusters in none that is neither around it nor in it.
        every = sum(own[n] for n in ends)
        alone = [n for n in ends if held[n] >= ELEMENT_SHARE * inside and within[n] + around[n] == every]
        return ({min(alone, key=lambda n: (size[n], -n))}, True) if alone else (outer, True)
    total = page.summed(text)
    holder = max(n for n in range(len(kind)) if total[n] == total[0])
    while kind[holder] not in CONTAINER:
        holder = parent[holder]
    return {holder}, False


def main_text(html: str | None) -> str:
    """The blocks of the article, joined by an empty line."""
    if not html:
        return ""
    page = read_page(html)
    lines = page.lines
    if not lines:
        return ""
    hard = page.below(lambda n: page.how[n] == ALWAYS)
    chars = page.summed([0 if hard[x.element] else x.chars - x.linked for x in lines])
    # Most of the page's text lies inside, and no article or main element with text outside.
    in_article = page.below(lambda n: page.kind[n] in ARTICLE)
    articles = page.summed([int(in_article[x.element] and not hard[x.element]) for x in lines])
    most = [2 * c > chars[0] and a == articles[0] for c, a in zip(chars, articles, strict=True)]
    cut = page.below(lambda n: page.how[n] >= COMMENTS or page.how[n] != NOT and not most[n])
    weight, limit = clusters([0.0 if cut[x.element] else x.ratio for x in lines])
    best, article = region(page, cut, [x.chars - x.linked if w > 0 else 0 for x, w in zip(lines, weight, strict=True)])
    inside = page.below(best.__contains__)
    # Elements named like a topic stay inside the region unless they are thin: text outside links for each tag.
    tags = page.summed([x.tags for x in lines])
    n_lines = page.summed([1] * len(lines))
    thin = [c < max(limit, 1) * (t + k) for c, t, k in zip(chars, tags, n_lines, strict=True)]
    gone = page.below(lambda n: page.how[n] >= COMMENTS or not most[n] and (
        page.how[n] == NAMED or page.how[n] == THIN and (thin[n] or not inside[n])))
    kept = [(k, x) for k, x in enumerate(lines) if inside[x.element] and not gone[x.element]]
    if not article:
        # A container of more than the article: lists of links before and after its text are menus.
        first = next((k for k, w in enumerate(weight) if w > 0), 0)
        last = next((k for k in range(len(weight) - 1, -1, -1) if weight[k] > 0), -1)
        kept = [(k, x) for k, x in kept if first <= k <= last or not x.menu]
    return "\n\n".join(x.text for _, x in kept)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = list(map(main_text, b.column(2).to_pylist()))
            yield batch(schema, b.column(0), b.column(1), texts, list(map(len, texts)))

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
