"""HTML extraction by tag-path ratios.

A page is read into blocks, each with its root-to-leaf path of tags (class and
id kept beside a tag, so that div.ad and div.body are two paths).  For every
path the text length and the punctuation are summed and divided by its number
of nodes; both ratios are smoothed over the page's order with a Gaussian, fused
by their product, and a path is content if its mean fused ratio reaches the
threshold (a fraction of the standard deviation over the page).  Parts that are
never the article (menus, headers and footers of the page, sidebars, notices,
adverts, forms, reader comments, by tag, role, class or id) are left out
first.  A class or id counts as a whole name (site-footer, not no-sidebar), and
not on body, main, article or an element that holds most of the text; a
heading's or paragraph's id never does, and inside article or main paragraphs
and sections are named out only where their links or lack of marks agree.  An
element is hidden by its attribute of that name, by aria-hidden or its style,
whatever the words of other attributes.
Every other content node is kept.  Content nodes vote, by their text,
for the element that holds them: the deepest one with most of that text, or the
article or main element around it; nodes outside it vote again, until all have
one.  The other blocks of these elements (headings, short paragraphs, lists)
come along, so that no block of the article is dropped for being short.

A page is parsed where it lies, in one pass without a shuffle; time and memory
are linear in its length, however deep its elements lie.

Defined results: null, empty and text-free pages give the empty text and 0
characters.  Unclosed tags, stray end tags and pages that break off are read
as far as they go.  Character references are decoded (unknown ones stay as
they are), formulas are text, white space in a block becomes one space, blocks join by one \\n.
Repeated rows give repeated results.  Other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, table

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|title|iframe|object|select)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/)?(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<(?P<odd>/?[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
UNSEEN = re.compile(r"display\s*:\s*none", re.I)
PUNCT = re.compile(r"[,.;:!?、。，；：！？]")

# fixed values: elements of HTML by what they do
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr "
                 "math semantics maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace "
                 "msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover".split())
NEVER = frozenset("nav footer aside form menu dialog button fieldset head".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
                     "h6 header hgroup hr main menu nav ol p pre section table ul".split())
PEERS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("table ul ol dl article section div body html td th".split())
BOILERPLATE = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu menus "
                        "breadcrumb breadcrumbs sidebar aside footer masthead topbar toolbar cookie cookies consent notice notices gdpr popup modal "
                        "overlay newsletter subscribe subscription signup login share sharing social related recommended comment comments "
                        "commentlist respond disqus replies widget pagination pager copyright legal disclaimer complementary contentinfo search".split())
REMARKS = frozenset("comment comments commentlist respond disqus replies".split())  # often longer than the article
# parts that a name may have beside words of BOILERPLATE: where it is, or of what; no-, with-, -open, category- say something else
BESIDE = frozenset("site page main global primary secondary top bottom left right header post posts article articles story stories entry content "
                   "user reader email mobile box bar block list area section container wrapper wrap inner body links link item items slot unit "
                   "form button buttons widgets".split())

UNSHOWN = frozenset("svg annotation annotation-xml".split())  # drawings, and formulas a second time in another notation
PARTS = frozenset("article main div section".split())
TEXT = frozenset("h1 h2 h3 h4 h5 h6 p".split())  # their ids are targets of links

_UNSHOWN_END = {t: re.compile(rf"<!--.*?--!?>|<foreignObject\b[^>]*>.*?</foreignObject\s*>|(?P<end></{t}\s*>)"
                              rf"|(?P<block></?(?:{'|'.join(sorted(CLOSES_P | SCOPE | {'li', 'dt', 'dd', 'tr'}))})(?=[\s/>]))", re.S | re.I) for t in UNSHOWN}


def unshown(page: str, tag: str, at: int) -> int:
    """Where an element that begins before ``at`` ends: its end tag or, without one, the next block tag."""
    for m in _UNSHOWN_END[tag].finditer(page, at):
        if m["end"]:
            return m.end()
        if m["block"]:
            return m.start()
    return len(page)


class Element:
    """``path``: number of the tag path; ``never``: not shown, or a part that is never the article; ``named``: boilerplate
    words in its names; ``inner``: inside article or main."""
    __slots__ = ("tag", "path", "up", "never", "named", "depth", "inner", "at")

    def __init__(self, tag: str, path: int, up: Element | None, never: bool, named: frozenset[str] = frozenset(), at: int = 0):
        self.tag, self.path, self.up, self.never, self.named, self.at = tag, path, up, never, named, at
        self.depth = up.depth + 1 if up else 0
        self.inner = bool(up) and (up.inner or up.tag in ("article", "main"))


class Stack:
    """Open elements, with the places of each tag, so that no step walks through them; all elements in page order."""

    def __init__(self):
        self.open, self.of, self.scopes = [], defaultdict(list), []
        self.all: list[Element] = []
        self.paths: dict[tuple[int, str], int] = {}
        self.push("", "", False, frozenset())

    def push(self, tag: str, name: str, never: bool, named: frozenset[str]) -> None:
        up = self.open[-1] if self.open else None
        path = self.paths.setdefault((up.path if up else -1, name), len(self.paths))
        e = Element(tag, path, up, never or bool(up) and up.never, named, len(self.all))
        self.all.append(e)
        self.of[tag].append(len(self.open))
        if tag in SCOPE:
            self.scopes.append(len(self.open))
        self.open.append(e)

    def cut(self, i: int) -> None:
        """Close the elements from place i on."""
        for e in self.open[i:]:
            self.of[e.tag].pop()
            if e.tag in SCOPE:
                self.scopes.pop()
        del self.open[i:]

    def last(self, tags) -> int:
        """Place of the innermost open element of these tags, 0 for none."""
        return max((self.of[t][-1] for t in tags if self.of.get(t)), default=0)

    def reach(self, tags) -> int:
        """The same, if no element that shuts it in lies further in."""
        i = self.last(tags)
        return i if not self.scopes or self.scopes[-1] <= i else 0


def boilerplate(names: list[str]) -> frozenset[str]:
    """Words of BOILERPLATE that classes, ids or roles consist of."""
    out: set[str] = set()
    for name in names:
        parts = [w for w in re.split(r"[^a-z0-9]+", name) if w]
        if all(w in BOILERPLATE or w in BESIDE or w[0].isdigit() for w in parts):
            out.update(w for w in parts if w in BOILERPLATE)
    return frozenset(out)


def _attributes(attrs: str) -> dict[str, str]:
    """Attributes by name; of repeated ones the first counts."""
    out: dict[str, str] = {}
    for name, a, b, c in ATTRIBUTE.findall(attrs):
        out.setdefault(name.lower(), a or b or c)
    return out


def blocks(page: str) -> tuple[list[tuple[Element, str, int]], list[Element]]:
    """(element, text, characters of it inside links) of every block of text in page order; all elements."""
    out: list[tuple[Element, str, int]] = []
    stack = Stack()
    text: list[str] = []
    links, linked = 0, 0

    def flush() -> None:
        nonlocal linked
        if text:
            s = " ".join(html.unescape("".join(text)).split())
            if s:
                out.append((stack.open[-1], s, linked))
            text.clear()
        linked = 0

    def said(s: str) -> None:
        nonlocal linked
        if s:
            text.append(s)
            if links:
                linked += len(s.strip())

    at = 0
    while m := TOKEN.search(page, at):
        said(page[at:m.start()])
        at = m.end()
        tag = m["tag"] or m["odd"]
        if m["raw"] or not tag:
            if m["raw"]:
                text.append(" ")
            continue
        closing = bool(m["close"]) or tag[0] == "/"
        tag = tag.lstrip("/").lower()
        if tag in UNSHOWN:
            text.append(" ")
            if not closing and not (m["attrs"] or "").rstrip().endswith("/"):
                at = unshown(page, tag, at)
            continue
        if tag in INLINE:
            if tag == "a":
                links = 0 if closing else 1
            elif tag == "br":
                text.append(" ")
            continue
        flush()
        links = 0
        if closing:
            if i := stack.last((tag,)):
                stack.cut(i)
            continue
        if tag in CLOSES_P and (i := stack.reach(("p",))):
            stack.cut(i)
        if tag in PEERS and (i := stack.reach(PEERS[tag])):
            stack.cut(i)
        if tag in VOID:
            continue
        attrs = m["attrs"] or ""
        had = _attributes(attrs) if "=" in attrs or "hidden" in attrs.lower() else {}
        marks = [had.get(k, "").lower() for k in ("class", "role", "id")]
        names = " ".join(marks[:2] if tag in TEXT else marks).split()
        up = stack.open[-1]
        inside = up.inner or up.tag in ("article", "main")
        unseen = "hidden" in had or had.get("aria-hidden", "").lower() == "true" or bool(UNSEEN.search(had.get("style", "")))
        if not attrs.rstrip().endswith("/") or tag not in ("path", "use"):
            words = sorted(w for w in re.split(r"[^a-z0-9]+", " ".join(marks)) if w)
            stack.push(tag, ".".join([tag, *words]), tag in NEVER or (tag == "header" and not inside) or unseen, boilerplate(names))
    said(page[at:])
    flush()
    return out, stack.all


def smooth(x: np.ndarray, radius: int = 2) -> np.ndarray:
    k = np.exp(-0.5 * (np.arange(-radius, radius + 1) / max(radius / 2, 0.5)) ** 2)
    num = np.convolve(x, k)[radius:radius + len(x)]
    return num / np.convolve(np.ones(len(x)), k)[radius:radius + len(x)]


def extract(page: str | None, threshold: float = 0.5, share: float = 0.6) -> str:
    """The main text of one page."""
    found, elements = blocks(page or "")
    found = [b for b in found if not b[0].never]
    out = _named_out(found, elements)
    found = [b for b in found if not out[b[0].at]]
    if not found:
        return ""
    size, marks, n = defaultdict(float), defaultdict(float), defaultdict(int)
    for e, s, linked in found:
        size[e.path] += max(len(s) - 2 * linked, 0)
        marks[e.path] += len(PUNCT.findall(s)) if linked * 2 < len(s) else 0
        n[e.path] += 1
    length = smooth(np.array([size[e.path] / n[e.path] for e, _, _ in found]))
    points = smooth(np.array([marks[e.path] / n[e.path] for e, _, _ in found]))
    fused = length * (1.0 + points)
    by = defaultdict(list)
    for (e, _, _), f in zip(found, fused):
        by[e.path].append(f)
    least = min(threshold * fused.std(), fused.max())
    content = {path for path, f in by.items() if sum(f) / len(f) >= least and sum(f) > 0}
    if not content:  # nothing stands out, all of it links or marks
        return ""
    homes = np.zeros(len(elements), bool)  # short blocks in these come along
    left = [(e, len(s)) for e, s, _ in found if e.path in content]
    while left:  # a round places at least ``share`` of the text that is left
        home = _home(left, elements, share)
        below = _inherit(elements, {home.at})
        if home.tag in PARTS:
            homes[home.at] = True
        else:  # body, html or no element: the outermost part of the page around each node
            outer: list[int] = []
            for e in elements:
                inside = -1 if e.up is None or not below[e.up.at] else outer[e.up.at]
                outer.append(inside if inside >= 0 or e.tag not in PARTS or not below[e.at] else e.at)
            for e, _ in left:
                if below[e.at] and outer[e.at] >= 0:
                    homes[outer[e.at]] = True
        left = [(e, k) for e, k in left if not below[e.at]]
    near = _inherit(elements, set(np.flatnonzero(homes).tolist()))
    return "\n".join(s for e, s, linked in found if e.path in content or linked * 2 < len(s) + 1 and near[e.at])


def _inherit(elements: list[Element], marked: set[int]) -> list[bool]:
    """Whether each element is marked or lies in one that is."""
    out: list[bool] = []
    for e in elements:
        out.append(e.at in marked or e.up is not None and out[e.up.at])
    return out


def _holds(elements: list[Element], own: dict[int, int]) -> list[int]:
    """What each element and all in it hold together."""
    out = [own.get(e.at, 0) for e in elements]
    for e in reversed(elements):
        if e.up is not None:
            out[e.up.at] += out[e.at]
    return out


def _named_out(found: list[tuple[Element, str, int]], elements: list[Element]) -> list[bool]:
    """Elements that are left out for their class, id or role, with all in them.  Not html, body, main and article, what is
    around main or the longest article, and what holds most of the text (within main or that article, if there is one):
    there the ratios decide.  Nor, inside article or main, headings, and paragraphs and sections whose text has marks and is
    not mostly links.  Reader comments that hold most of the text are left out all the same if there is other text."""
    own: dict[int, int] = defaultdict(int)
    linked, marks, length = defaultdict(int), defaultdict(int), defaultdict(int)
    for e, s, in_links in found:
        own[e.at] += max(len(s) - 2 * in_links, 0)
        linked[e.at] += in_links
        length[e.at] += len(s)
        marks[e.at] += len(PUNCT.findall(s))
    holds, linked, marks, length = (_holds(elements, x) for x in (own, linked, marks, length))
    total = holds[0]
    remark = _inherit(elements, {e.at for e in elements if e.named & REMARKS})
    longest = max((e for e in elements if e.tag == "article" and length[e.at] and not remark[e.at]), key=lambda e: holds[e.at], default=None)
    cores = {e.at for e in elements if e is longest or e.tag == "main" and length[e.at]}
    kept: set[int] = set()
    for i in cores:
        x: Element | None = elements[i]
        while x is not None and x.at not in kept:
            kept.add(x.at)
            x = x.up
    in_core = _inherit(elements, cores)

    def out(e: Element) -> bool:
        if not e.named or e.tag in ("html", "body", "main"):
            return False
        if e.inner and e.tag in TEXT | {"section"} and not (e.tag == "section" and e.named & REMARKS):
            return e.tag in ("p", "section") and (2 * linked[e.at] >= length[e.at] or not marks[e.at])
        if e.named & REMARKS:
            return holds[e.at] < total
        most = 2 * holds[e.at] > total and (not cores or in_core[e.at])
        return not (e.tag == "article" or e.at in kept or most)

    return _inherit(elements, {e.at for e in elements if length[e.at] and out(e)})


def _home(nodes: list[tuple[Element, int]], elements: list[Element], share: float) -> Element:
    """The article or main element around most of the nodes' text, or the deepest element that holds it."""
    own: dict[int, int] = defaultdict(int)
    for e, n in nodes:
        own[e.at] += n
    holds = _holds(elements, own)
    home = max((e for e in elements if holds[e.at] >= share * holds[0]), key=lambda e: (e.depth, holds[e.at]))
    x: Element | None = home
    while x is not None:
        if x.tag in ("article", "main"):
            return x
        x = x.up
    # a single paragraph that holds most of the text is no container
    while home.up is not None and home.tag in CLOSES_P | {"li", "td"} and home.tag not in ("div", "section"):
        home = home.up
    return home


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "html"):
                text = [extract(h) for h in batch.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())],
                    ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))
