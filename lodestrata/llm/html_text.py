"""Main text of web pages, by tag-path ratios.

A page becomes a run of text blocks, each with the path of block tags from the root. Blocks on one
path share two ratios: characters per block, and punctuation per block. Along the page the ratios
are smoothed with a Gaussian, fused by their product, and held against a threshold taken from
their spread. The blocks above it are the content nodes; the element around them is the article, and
what it holds, apart from elements whose name, class or role marks them as something else and from
lists of links, is its text. A class or id does not count on an element that holds the page's main
element or most of its content score: that is a wrapper around the article.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of the HTML vocabulary.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg math".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var".split()
)
OTHER_TAGS = frozenset("nav aside footer form head menu dialog button select option fieldset object canvas audio video map".split())
OTHER_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
OTHER_NAMES = frozenset(
    """ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion promoted
    sidebar side menu nav navbar navigation breadcrumb breadcrumbs masthead topbar header footer foot banner
    cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup
    login share sharing social comment comments reply replies respond disqus related recommended recommendations
    widget toolbar pagination pager skip search form""".split()
)
CLOSES_P = frozenset(
    """address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header
    hgroup hr main menu nav ol p pre section table ul""".split()
)
PARTS = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd td th tr tbody thead tfoot table blockquote pre figure figcaption".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?:\"[^\"]*\"|'[^']*'|[^>])*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PUNCTUATION = re.compile(r"[.,;:!?…。、，！？；：¿¡]")
_KERNEL = [math.exp(-(i * i) / 2) for i in range(-2, 3)]


@dataclass
class Mark:
    """An element that a class or id marks as something other than main text."""

    outer: Mark | None
    depth: int
    in_article: bool
    in_main: bool
    counts: bool = True


@dataclass
class Element:
    name: str
    parent: Element | None
    never: bool
    mark: Mark | None
    depth: int

    @property
    def other(self) -> bool:
        """Whether it is, or lies in, something other than main text."""
        mark = self.mark
        while mark is not None and not mark.counts:
            mark = mark.outer
        return self.never or mark is not None


@dataclass
class Block:
    path: tuple[str, ...]
    element: Element
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


def _never(name: str, found: dict[str, str], inside_article: bool) -> bool:
    """Whether an element is something other than main text, by its name, role or visibility."""
    if name in OTHER_TAGS or (name == "header" and not inside_article):
        return True
    if not found or name in ("html", "body", "article", "main"):
        return False
    if found.get("role") in OTHER_ROLES or "hidden" in found or found.get("aria-hidden") == "true":
        return True
    return re.search(r"(display\s*:\s*none|visibility\s*:\s*hidden)", found.get("style", "")) is not None


def _marked(name: str, found: dict[str, str], inside_article: bool) -> bool:
    """Whether a class or id, whole or by its first word, names something other than main text."""
    if not found or name in ("html", "body", "article", "main"):
        return False
    names = OTHER_NAMES
    if name in INLINE and name != "span" or name in ("h1", "h2", "h3", "h4", "h5", "h6", "p"):
        names = names - {"header", "side", "notice", "comment", "search"}
    if inside_article:
        names = names - {"header"}
    given = f"{found.get('class', '')} {found.get('id', '')}".split()
    return any(w in names for g in given for w in (g, re.split(r"[^a-z0-9]+", g.strip("-_"))[0]))


def blocks_of(page: str) -> list[Block]:
    """The page's text blocks in order, with white space folded and character references decoded."""
    root = Element("", None, False, None, 0)
    top, block, out = root, None, []
    links = article = main = 0

    def close(to: Element) -> None:
        nonlocal top, links, article, main
        while top is not to:
            links -= top.name == "a"
            article -= top.name == "article"
            main -= top.name == "main"
            top = top.parent

    def up(names: tuple[str, ...], stop: tuple[str, ...] = ()) -> Element | None:
        e = top
        while e is not root:
            if e.name in names:
                return e
            if e.name in stop:
                return None
            e = e.parent
        return None

    def text(piece: str) -> None:
        nonlocal block
        if not piece:
            return
        home = top
        while home.name in INLINE:
            home = home.parent
        if top.never and not home.never or top.mark is not home.mark:
            return  # an inline element that is no main text
        if block is None:
            path, e = [], home
            while e is not root:
                path.append(e.name)
                e = e.parent
            block = Block(tuple(reversed(path)), home)
            out.append(block)
        block.parts.append(piece)
        if links:
            block.linked += len(piece.strip())

    at = 0
    while at < len(page):
        m = _TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        if m["name"] is None:
            continue
        name = m["name"].lower()
        if m["end"]:
            found = up((name,))
            if name not in INLINE:
                block = None
            if found:
                close(found.parent)
            continue
        if name == "br":
            text(" ")
            continue
        if name not in INLINE and name not in VOID | RAW or name == "hr":
            block = None
        if name in CLOSES_P and (p := up(("p",), ("button", "table", "td", "th", "article", "section", "div", "li", "body"))):
            close(p.parent)
        if name in SIBLINGS and (e := up(SIBLINGS[name], _SCOPES[name])):
            close(e.parent)
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
            at = len(page) if end is None else end.start()
            if end is not None:
                close_tag = page.find(">", at)
                at = len(page) if close_tag < 0 else close_tag + 1
        elif name not in VOID and not m["attributes"].endswith("/"):
            found = {x[1].lower(): html.unescape(x[2] or x[3] or x[4] or "").lower() for x in _ATTRIBUTE.finditer(m["attributes"])}
            mark = Mark(top.mark, top.depth + 1, article > 0, main > 0) if _marked(name, found, article + main > 0) else top.mark
            top = Element(name, top, top.never or _never(name, found, article + main > 0), mark, top.depth + 1)
            links += name == "a"
            article += name == "article"
            main += name == "main"
    for b in out:
        b.text = " ".join(html.unescape("".join(b.parts)).split())
    return [b for b in out if b.text]


def path_scores(blocks: list[Block]) -> list[float]:
    """For each block the smoothed product of its path's text ratio and punctuation ratio."""
    totals: dict[tuple, list[int]] = defaultdict(lambda: [0, 0, 0])
    for b in blocks:
        t = totals[b.path]
        t[0] += 1
        t[1] += len(b.text) - b.linked
        t[2] += len(_PUNCTUATION.findall(b.text))
    ratios = [(totals[b.path][1] / totals[b.path][0], 1 + totals[b.path][2] / totals[b.path][0]) for b in blocks]

    def smooth(values: list[float]) -> list[float]:
        out = []
        for i in range(len(values)):
            near = [(values[i + k], w) for k, w in zip(range(-2, 3), _KERNEL) if 0 <= i + k < len(values)]
            out.append(sum(v * w for v, w in near) / sum(w for _, w in near))
        return out

    return [a * b for a, b in zip(smooth([r[0] for r in ratios]), smooth([r[1] for r in ratios]))]


def _threshold(scores: list[float]) -> float:
    """Half a standard deviation, but not above the mean."""
    mean = sum(scores) / len(scores)
    return min(mean, 0.5 * math.sqrt(sum((s - mean) ** 2 for s in scores) / len(scores)))


def _inside(e: Element | None, outer: Element) -> bool:
    while e is not None and e.depth > outer.depth:
        e = e.parent
    return e is outer


def _lift_marks(blocks: list[Block], scores: list[float]) -> None:
    """Let the marks of wrappers not count, the innermost first.

    Outside articles, an element is a wrapper if it holds the main element; or, where no other article
    or main element stands unmarked, if it holds four fifths of the content score, or an article and
    half of the score. Score within other marked elements is left out.
    """
    weight: dict[int, float] = defaultdict(float)
    named: dict[tuple[int, str], set[int]] = defaultdict(set)
    marks: dict[int, Mark] = {}
    seen: set[int] = set()
    for b, s in zip(blocks, scores):
        if b.element.never:
            continue
        weight[id(b.element.mark)] += s * max(len(b.text) - b.linked, 0)
        e = b.element
        while e is not None and id(e) not in seen:
            seen.add(id(e))
            if e.name in ("article", "main"):
                named[id(e.mark), e.name].add(id(e))
            mark = e.mark
            while mark is not None and id(mark) not in marks:
                marks[id(mark)] = mark
                mark = mark.outer
            e = e.parent
    for mark in sorted(marks.values(), key=lambda m: -m.depth):
        if mark.in_article:
            continue
        around, outer = [id(None)], mark.outer
        while outer is not None:
            around.append(id(outer))
            outer = outer.outer
        own, rest = weight[id(mark)], sum(weight[x] for x in around)
        elsewhere = any(named[x, "article"] or named[x, "main"] and not mark.in_main for x in around)
        articles, mains = named[id(mark), "article"], named[id(mark), "main"]
        if mains or not elsewhere and own > 0 and (own >= 4 * rest or articles and own >= rest):
            mark.counts = False
            weight[id(mark.outer)] += own
            named[id(mark.outer), "article"] |= articles
            named[id(mark.outer), "main"] |= mains


def _region(content: list[Block]) -> Element:
    """The article around the content nodes: the outermost article, or else main element, that holds
    nine tenths of their text, or else the innermost element that does."""
    weight: dict[int, list] = {}
    for b in content:
        e = b.element
        while e is not None:
            weight.setdefault(id(e), [e, 0])[1] += len(b.text)
            e = e.parent
    whole = sum(len(b.text) for b in content)
    most = [e for e, w in weight.values() if 10 * w >= 9 * whole]
    for name in ("article", "main"):
        named = [e for e in most if e.name == name]
        if named:
            return min(named, key=lambda e: e.depth)
    return max(most, key=lambda e: e.depth)


def main_text(page: str) -> str:
    """The article's blocks, joined by blank lines; empty if there is none."""
    blocks = [b for b in blocks_of(page) if "head" not in b.path]
    if not blocks:
        return ""
    scores = path_scores(blocks)
    least = _threshold(scores)
    _lift_marks(blocks, scores)
    content = [b for b, s in zip(blocks, scores) if s >= least and not b.element.other and b.linked * 2 <= len(b.text)]
    content = content or [b for b in blocks if not b.element.other and b.linked * 2 <= len(b.text)]
    if not content:
        return ""
    region = _region(content)
    while region.name in PARTS:
        region = region.parent
    links = lambda b: 2 * b.linked > len(b.text) and "li" in b.path
    return "\n\n".join(b.text for b in blocks if not b.element.other and not links(b) and _inside(b.element, region))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page) for page in batch["_page"].to_pylist()]
        yield batch.set_column(batch.schema.get_field_index("_page"), "text", pa.array(texts, pa.string()))


def extract_text(pages: DataFrame, body: str = "html", text: str = "text") -> DataFrame:
    """Every row with its page's main text in place of the page, and ``n_chars``, its code points.

    Null and empty pages have an empty text. Columns called like the results are replaced, others
    pass unchanged; repeated rows are extracted each; an empty table gives no rows. A page is
    handled whole, whatever its length.
    """
    carried = [c for c in pages.columns if c not in (body, text, "n_chars")]
    kinds = dict(pages.dtypes)
    inner = pages.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(carried)], F.coalesce(F.col(body), F.lit("")).alias("_page"))
    schema = ", ".join([*(f"_{i} {kinds[c]}" for i, c in enumerate(carried)), "text string"])
    out = inner.mapInArrow(_extract, schema)
    return out.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(carried)], F.col("text").alias(text), F.length("text").cast("long").alias("n_chars"))
