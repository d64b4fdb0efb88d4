r"""Main text of web pages by tag-path ratios.

Every text block of a page hangs from a root-to-leaf path of block-level tags (with their classes, digits apart). For each
path the text length and the punctuation of its blocks are summed and divided by the number of blocks; both ratios are
fused into a score, the scores are smoothed over the page's block order, and a path passes whose smoothed score is at least
PASS times the page's mean (weighed by text). The blocks of the paths that pass are the seeds.

Furniture (menus, page headers, footers, sidebars, notices, adverts, forms, reader comments; scripts and styles) is known
by tag, role, class and id, and left out with all inside. A class or id counts as a whole: `site-footer` and `ad-slot` are
furniture, `has-sidebar`, `ad-free` and `post-header` aren't. Marks that also wrap whole pages (a form, an aside, a header,
a widget, ...) are taken back where no article or main element lies outside furniture and they hold more than twice the
seed text outside, with an article, a main heading or three seeds in them.

Where article elements (or else main elements) hold at least half of the seed text, only what lies in them is taken.
All seeds taken are content. A block of a path that failed is content
  - in such an element, unless its path is a menu (over half of the path's text is links),
  - elsewhere, if the nearest element around it that holds seeds has them as its own children and its path isn't a menu;
    directly in the body only between two seeds,
  - if it is a heading and one of the next three blocks is content.
So the ratios decide which parts of a page are content, and short blocks among them stay.

Inline tags belong to no path and cut no block. Character references are decoded, runs of white space in a block
become one space, blocks are trimmed and joined by an empty line in page order.

Defined results: null, empty and textless pages give the empty text; unclosed tags, stray end tags and text outside
any tag are taken as browsers take them, a tag that the page's end cuts off is no text; the time is linear in the length
of a page, whatever its nesting; every row gives one result, repeated ids and rows included; extra columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.common import read_table

INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no markup.
RAW = frozenset("script style textarea title xmp noembed noframes".split())
#: Nothing in them is ever text of the page.
NO_TEXT = frozenset("head template select option datalist iframe object svg canvas noscript audio video map".split())
#: Marks of furniture: SURE ones always are, WRAPPING ones may also be set on what holds the whole page.
SURE, WRAPPING = 2, 1
TAGS = {"nav": SURE, "footer": SURE, "menu": SURE, "button": SURE, "form": WRAPPING, "aside": WRAPPING, "dialog": WRAPPING}
ROLES = {
    "navigation": SURE, "contentinfo": SURE, "search": SURE, "menu": SURE, "menubar": SURE, "alert": SURE, "banner": WRAPPING,
    "complementary": WRAPPING, "dialog": WRAPPING, "alertdialog": WRAPPING, "form": WRAPPING,
}
NAMES = dict.fromkeys(
    """ad ads adv advert adverts advertisement advertising adsense sponsor sponsored menu nav navbar navigation breadcrumb breadcrumbs footer
    comment comments disqus respond replies share sharing social cookie cookies consent gdpr pagination pager copyright skiplink login signup""".split(),
    SURE,
) | dict.fromkeys(
    """promo promotion banner sidebar sidebars header masthead topbar related recommended recommendations notice notices popup modal overlay
    newsletter subscribe subscription widget widgets toolbar""".split(),
    WRAPPING,
)
#: Parts of a name that say where or how, not what.
PLACES = frozenset(
    """area bar block body bottom box container content contents group holder home inner item items left link links list main middle outer page
    panel primary right row secondary section site slot top unit wrap wrapper the my text message js""".split()
)
#: A name that begins so says what is absent or near.
DENIALS = frozenset("no not non has have with without is in hide hidden".split())
#: `post-header` is the header of the text, not of the page.
OF_TEXT = frozenset("post article entry story content news page section".split())
SECTIONS = ("article", "main")
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: A start tag on the left closes an open element of those on the right, up to the scopes after them.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
#: These start tags close an open paragraph, up to the scopes after them.
ENDS_P = frozenset(
    """address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr
    li main menu nav ol p pre search section summary table ul""".split()
)
P_SCOPES = ("td", "th", "caption", "button", "object")
CELLS = ("td", "th", "caption")
TABLE = frozenset("table tbody thead tfoot tr td th caption".split())
PASS = 0.5
LINKS = 0.5
OVER = 2
_TAG = re.compile(r"</?([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_BARE = re.compile(r"</?([a-zA-Z][^\s/>]*+)([^>]*+)>")
_ATTR = re.compile(r"(?<![^\s\"'/])(class|id|role|hidden|aria-hidden|style)(?:\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s>]++)|(?![^\s/=]))", re.I)
_HIDES = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
_DIGITS = re.compile(r"\d+")
_LARGE = re.compile(r"&#0*(\d{8,})")
_PUNCT = re.compile(r"[.,;:!?…。，、！？；：]")


@lru_cache(maxsize=4096)
def _named(token: str, in_section: bool) -> int:
    """How a class or id marks its element: 0, WRAPPING or SURE."""
    parts = [p for p in re.split(r"[-_:]+", token) if p]
    if not parts or parts[0] in DENIALS:
        return 0
    if parts[-1] == "header" and (in_section or (len(parts) > 1 and parts[-2] in OF_TEXT)):
        return 0
    if parts[-1] in NAMES:
        return NAMES[parts[-1]]
    found = [NAMES[p] for p in parts if p in NAMES]
    return max(found) if found and all(p in NAMES or p in PLACES for p in parts) else 0


def _marks(tag: str, rest: str, in_section: bool) -> tuple[str, int | None]:
    """The class of a tag, and how it is marked; None: nothing inside is text."""
    mark = TAGS.get(tag, WRAPPING if tag == "header" and not in_section else 0)
    cls = ""
    if rest and not rest.isspace():
        for k, v in _ATTR.findall(rest):
            k, v = k.lower(), v.strip("\"'").lower()
            if k == "class":
                cls = _DIGITS.sub("0", v[:200])
            if k in ("class", "id") and tag not in ("html", "body", "main"):
                for token in v.split():
                    if len(token) <= 64:
                        mark = max(mark, _named(token, in_section))
            elif k == "role":
                mark = max(mark, ROLES.get(v, 0))
            elif (k == "hidden" and tag not in ("html", "body")) or (k == "aria-hidden" and v == "true") or (k == "style" and _HIDES.search(v)):
                return cls, None
    return cls, mark


class Element(NamedTuple):
    """An open or closed element; parents have lower numbers."""

    up: int
    tag: str
    path: int
    mark: int
    in_section: bool


class Block(NamedTuple):
    """element, text, characters inside links"""

    element: int
    text: str
    linked: int


class _Reader:
    """Cuts a page into elements and text blocks; every step is constant but for the text it takes."""

    def __init__(self, page: str):
        self.page = page
        self.elements = [Element(-1, "", 0, 0, False)]
        self.paths: dict[tuple[int, str, str], int] = {}
        self.blocks: list[Block] = []
        self.stack = [0]
        self.open: defaultdict[str, list[int]] = defaultdict(list)  # by tag: places in the stack
        self.text: list[str] = []
        self.linked, self.link_at, self.mute_at = 0, None, None

    def _top(self, tags) -> int:
        return max((self.open[t][-1] for t in tags if self.open[t]), default=-1)

    def _add(self, raw: str) -> None:
        if self.mute_at is None:
            if "&" in raw:
                raw = entities.unescape(_LARGE.sub(lambda m: f"&#{m[1][:8]}", raw))
            self.text.append(raw)
            if self.link_at is not None:
                self.linked += sum(map(len, raw.split()))

    def _flush(self) -> None:
        if self.text:
            joined = " ".join("".join(self.text).split())
            if joined:
                self.blocks.append(Block(self.stack[-1], joined, self.linked))
            self.text = []
        self.linked = 0

    def _pop_to(self, place: int) -> None:
        while len(self.stack) > place:
            self.open[self.elements[self.stack.pop()].tag].pop()
        if self.link_at is not None and len(self.stack) < self.link_at:
            self.link_at = None
        if self.mute_at is not None and len(self.stack) <= self.mute_at:
            self.mute_at = None

    def _close(self, tags, scopes=()) -> None:
        place = self._top(tags)
        if place > self._top(scopes):
            self._pop_to(place)

    def _push(self, tag: str, rest: str) -> None:
        up = self.elements[self.stack[-1]]
        cls, mark = _marks(tag, rest, up.in_section)
        if (mark is None or tag in NO_TEXT) and self.mute_at is None:
            self.mute_at = len(self.stack)
        path = self.paths.setdefault((up.path, tag, cls), len(self.paths) + 1)
        self.elements.append(Element(self.stack[-1], tag, path, mark or 0, up.in_section or tag in SECTIONS))
        self.open[tag].append(len(self.stack))
        self.stack.append(len(self.elements) - 1)

    def read(self) -> tuple[list[Element], list[Block]]:
        page, pos, quotes = self.page, 0, True
        lower = None
        while True:
            at = page.find("<", pos)
            if at < 0:
                self._add(page[pos:])
                break
            if at > pos:
                self._add(page[pos:at])
            after = page[at + 1 : at + 2]
            if not ("a" <= after <= "z" or "A" <= after <= "Z" or (after == "/" and page[at + 2 : at + 3].isascii() and page[at + 2 : at + 3].isalpha())):
                if after and after in "!?/":  # a comment or what browsers take for one
                    long = page.startswith("<!--", at)
                    end = page.find("-->" if long else ">", at + 2)
                    if end < 0:
                        break
                    pos = end + (3 if long else 1)
                else:
                    self._add("<")
                    pos = at + 1
                continue
            m = _TAG.match(page, at) if quotes else None
            if m is None:  # its quotes don't pair up, so no later ones are trusted either
                quotes, m = False, _BARE.match(page, at)
                if m is None:
                    break
            pos, name, rest = m.end(), m[1].lower(), m[2]
            if after == "/":
                if name in INLINE:
                    if name == "a":
                        self.link_at = None
                    continue
                self._flush()
                self._close((name,), () if name in TABLE else CELLS)
                continue
            if name in INLINE:
                if name == "a":
                    self.link_at = len(self.stack)
                elif name == "br":
                    self._add(" ")
                continue
            self._flush()
            if name in CLOSES:
                self._close(*CLOSES[name])
            if name in ENDS_P and self.open["p"]:
                self._close(("p",), P_SCOPES)
            if name in VOID:
                continue
            if name in RAW:
                lower = lower or re.compile(rf"</({'|'.join(RAW)})(?=[\s/>])[^>]*+>?", re.I)
                end = next((e for e in lower.finditer(page, pos) if e[1].lower() == name), None)
                if end is None:
                    break
                pos = end.end()
                continue
            self._push(name, rest)
        self._flush()
        return self.elements, self.blocks


def read_page(page: str) -> tuple[list[Element], list[Block]]:
    """The elements of a page, parents first, and its text blocks in order."""
    return _Reader(page).read()


def path_scores(elements: list[Element], blocks: list[Block]) -> dict[int, float]:
    """Fused ratio of each path, smoothed over neighbouring blocks."""
    sums: dict[int, list[float]] = {}
    for at, text, linked in blocks:
        s = sums.setdefault(elements[at].path, [0, 0, 0])
        s[0] += max(0, len(text) - linked)
        s[1] += len(_PUNCT.findall(text))
        s[2] += 1
    fused = {path: math.log1p(size / n) * math.log1p(1 + punct / n) for path, (size, punct, n) in sums.items()}
    row = [fused[elements[b.element].path] for b in blocks]
    total: dict[int, list[float]] = {}
    for i, (b, x) in enumerate(zip(blocks, row, strict=True)):
        t = total.setdefault(elements[b.element].path, [0.0, 0])
        t[0] += (row[max(0, i - 1)] + 4 * x + row[min(len(row) - 1, i + 1)]) / 6
        t[1] += 1
    return {path: x / n for path, (x, n) in total.items()}


def _own(b: Block) -> int:
    return max(0, len(b.text) - b.linked)


def _seeds(elements: list[Element], blocks: list[Block], scores: dict[int, float], free: list[bool]) -> list[bool]:
    """Whether the path of each block passes; the mean is that of the blocks outside furniture, if there are any."""
    told = [b for b, x in zip(blocks, free, strict=True) if x and _own(b)] or [b for b in blocks if _own(b)]
    weight = sum(map(_own, told))
    if not weight:
        return [True] * len(blocks)
    least = PASS * sum(scores[elements[b.element].path] * _own(b) for b in told) / weight
    return [scores[elements[b.element].path] >= least and _own(b) > 0 for b in blocks]


def _owners(elements: list[Element], marks: list[int]) -> list[int]:
    """For each element the nearest marked one from itself upwards, or -1."""
    owner = [-1] * len(elements)
    for i, e in enumerate(elements):
        owner[i] = i if marks[i] else owner[e.up] if i else -1
    return owner


def _take_back(elements: list[Element], blocks: list[Block], seeds: list[bool], marks: list[int]) -> list[int]:
    """The marks without those on a wrapper of the main text."""
    owner = _owners(elements, marks)
    if any(e.tag in SECTIONS and owner[i] < 0 for i, e in enumerate(elements)):
        return marks
    weight, count = defaultdict(int), defaultdict(int)
    for b, seed in zip(blocks, seeds, strict=True):
        if seed:
            weight[owner[b.element]] += _own(b)
            count[owner[b.element]] += 1
    telling = {owner[i] for i, e in enumerate(elements) if e.tag in SECTIONS or e.tag == "h1"}
    outside = weight.pop(-1, 0)
    for best in sorted(weight, key=lambda i: (-weight[i], i)):
        if weight[best] <= OVER * outside:
            break
        chain, at = [], best
        while at >= 0:
            chain.append(at)
            at = owner[elements[at].up] if at else -1
        if (best in telling or count[best] >= 3) and all(marks[i] == WRAPPING for i in chain):
            gone = set(chain)
            return [0 if i in gone else m for i, m in enumerate(marks)]
        if len(chain) > 64:  # what lies so deep in furniture is no page
            break
    return marks


def _sections(elements: list[Element], blocks: list[Block], seeds: list[bool], free: list[bool]) -> list[bool] | None:
    """Whether each element lies in one of the sections that hold the main text; None: there are none."""
    weight = sum(_own(b) for b, seed, x in zip(blocks, seeds, free, strict=True) if seed and x)
    for tag in SECTIONS:
        inside = [False] * len(elements)
        for i, e in enumerate(elements):
            inside[i] = e.tag == tag or (i > 0 and inside[e.up])
        held = sum(_own(b) for b, seed, x in zip(blocks, seeds, free, strict=True) if seed and x and inside[b.element])
        if held and 2 * held >= weight:
            return inside
    return None


def select(elements: list[Element], blocks: list[Block], scores: dict[int, float]) -> list[bool]:
    """Whether each block is content, given the scores of the paths."""
    marks = [e.mark for e in elements]
    free = [x < 0 for x in _owners(elements, marks)]
    seeds = _seeds(elements, blocks, scores, [free[b.element] for b in blocks])
    if any(marks):
        left = _take_back(elements, blocks, seeds, marks)
        if left is not marks:
            free = [x < 0 for x in _owners(elements, left)]
            seeds = _seeds(elements, blocks, scores, [free[b.element] for b in blocks])
    here = [free[b.element] for b in blocks]
    inside = _sections(elements, blocks, seeds, here)
    if inside is not None:
        here = [x and inside[b.element] for x, b in zip(here, blocks, strict=True)]
    seeds = [s and x for s, x in zip(seeds, here, strict=True)]
    size, linked = defaultdict(int), defaultdict(int)
    for b in blocks:
        size[elements[b.element].path] += sum(map(len, b.text.split()))
        linked[elements[b.element].path] += b.linked
    menu = {path for path in size if linked[path] > LINKS * size[path]}
    holds, parents, reach = [False] * len(elements), set(), [i for i, s in enumerate(seeds) if s]
    for i in reach:
        holds[blocks[i].element] = True
        parents.add(blocks[i].element)
        parents.add(elements[blocks[i].element].up)
    for i in range(len(elements) - 1, 0, -1):
        if holds[i]:
            holds[elements[i].up] = True
    around = [0] * len(elements)  # the nearest element that holds seeds
    for i, e in enumerate(elements):
        around[i] = i if holds[i] or not i else around[e.up]
    first, last = (reach[0], reach[-1]) if reach else (0, -1)
    kept = []
    for i, b in enumerate(blocks):
        x = seeds[i]
        if here[i] and not x and reach and elements[b.element].path not in menu:
            at = around[b.element]
            x = inside is not None or (at in parents and (elements[at].tag not in ("", "html", "body") or first < i < last))
        kept.append(x)
    for i in range(len(blocks) - 1, -1, -1):
        if here[i] and not kept[i] and elements[blocks[i].element].tag in HEADINGS and any(kept[i + 1 : i + 4]):
            kept[i] = True
    return kept


def extract_text(page: str | None) -> str:
    if not page:
        return ""
    elements, blocks = read_page(page)
    kept = select(elements, blocks, path_scores(elements, blocks))
    return "\n\n".join(b.text for b, x in zip(blocks, kept, strict=True) if x)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row for each page: id, url, main text and its length in code points."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [extract_text(h.as_py()) for h in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                [id_col, url_col, "text", "n_chars"],
            )

    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]
    return pages.select(id_col, url_col, F.col(html_col).cast("string")).mapInArrow(
        emit, f"`{id_col}` {kinds[0]}, `{url_col}` {kinds[1]}, text string, n_chars long"
    )


def op1_html_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


#: The article element of each page cut at its block tags: what the path ratios must select on pages of this make.
OP1_SQL = r"""
WITH articles AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*)</article>', 1, 's') AS inner_html FROM pages),
parts AS (
  SELECT page_id, url, string_split(regexp_replace(inner_html, '</?(p|h1)>', chr(1), 'g'), chr(1)) AS raw FROM articles),
clean AS (
  SELECT page_id, url, list_filter(list_transform(raw, lambda x: trim(regexp_replace(
    replace(regexp_replace(replace(replace(replace(regexp_replace(regexp_replace(x, '<br>', ' ', 'g'), '<[^>]*>', '', 'g'),
      '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp$', '&'), '&amp;', '&'), '\s+', ' ', 'g'))), lambda x: x <> '') AS blocks FROM parts)
SELECT page_id, url, array_to_string(blocks, chr(10) || chr(10)) AS text,
       CAST(length(array_to_string(blocks, chr(10) || chr(10))) AS BIGINT) AS n_chars FROM clean
"""
