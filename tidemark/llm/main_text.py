"""The main text of web pages, by tag-path ratios.

A page is read once into blocks of text: what stands between two block-level tags,
with inline tags taken out. Length of text outside links and punctuation are added up per root-to-leaf
path of block tags and divided by the path's number of blocks. Both ratios are smoothed
over the blocks in page order, fused into their geometric mean, and the paths whose mean
reaches the page's standard deviation are content. The content blocks' lengths then
lead from the root to the smallest element that holds most of them: an ``article`` or
``main`` is taken with all its blocks, any other element with its content blocks, its
headings and what is no list of links between them. Menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles and reader comments never become blocks: they
are known by their tag, role, or a word of their class or id.

Defined results: a null or empty html, and one without text, gives the empty text of
length 0; rows are independent, so repeated rows and ids give repeated results and null
ids stay null; other columns are not read. A cut page is read up to its end: an open
comment, script or tag swallows the rest, as in a browser. ``<br>`` is white space, a
table cell is a block of its own. A page is held whole in its task, nothing else is.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from math import exp, sqrt
from statistics import pstdev

import pyarrow as pa
from pyspark.sql import DataFrame

# Element names by how HTML treats them.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rb rp rt ruby s samp small span strike "
    "strong sub sup time tt u var".split()
)
EMPTY = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
RAW = "script|style|textarea|title|iframe|noembed|noframes|noscript|xmp|template|svg|canvas|object|audio|video"
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
WHOLE = frozenset(("article", "main"))
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "thead": ("tr",), "tbody": ("thead", "tbody", "tr"), "tfoot": ("tbody", "tr"), "option": ("option",),
}
SCOPES = frozenset("html body article main section div ul ol dl table form blockquote".split())

# Boilerplate by tag, by role, and by a word of a class or id.
BOILER_TAGS = frozenset("head nav footer aside form menu dialog button select datalist fieldset search".split())
BOILER_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar status toolbar".split()
)
BOILER_WORDS = frozenset(
    """ad ads adbox adslot adsense adsbygoogle advert adverts advertisement advertisements advertising advertorial sponsor sponsored
    sponsors promo promos promotion banner nav navbar navigation navi menu menus breadcrumb breadcrumbs sidebar sidebars aside footer
    masthead topbar toolbar cookie cookies cookiebar consent gdpr notice notices notification notifications alert alerts popup popups
    modal overlay disclaimer newsletter subscribe subscription signup login comment comments commentlist commentarea commentbox
    commentform disqus replies related recommended recommendations share sharing social pagination pager searchform searchbox
    form forms skip""".split()
)
# Words that say the element is beside or around such a part: has-sidebar, no-ads.
NOT_ITSELF = frozenset("has with no without js is after before".split())

TOKEN = re.compile(
    rf"""<!---?>|<!--.*?(?:--!?>|\Z)
    |<(?P<raw>{RAW})(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)
    |<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>(?:[^"'>]|"[^"]*"|'[^']*')*+)>
    |<(?P<end2>/?)(?P<tag2>[a-z][^\s/>]*)(?P<attrs2>[^>]*)>
    |<[!?/][^>]*>|<[a-z!?/][^>]*\Z""",
    re.S | re.I | re.X,
)
ATTRIBUTE = re.compile(r"""(?:^|[\s/"'])(class|id|role|hidden|aria-hidden|style)(?=[\s=/]|$)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
PUNCTUATION = re.compile(r"""[.,;:!?…。，、；：！？،؛؟।"'“”‘’«»()–—-]""")

# Smoothing over this many blocks on either side, Gaussian with a deviation of one block.
RADIUS = 2
KERNEL = [exp(-(d * d) / 2) for d in range(-RADIUS, RADIUS + 1)]
# An element is entered if it holds this share of the content around it.
MAJORITY = 0.6
# Blocks with more of their text inside links are lists of links.
LINKS = 0.5


def is_boilerplate(tag: str, attrs: str, in_article: bool) -> bool:
    """Whether an element and all in it is no part of the article."""
    if tag in BOILER_TAGS or (tag == "header" and not in_article):
        return True
    if not attrs or tag in ("html", "body"):
        return False
    for name, value in ATTRIBUTE.findall(attrs):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and UNSEEN.search(value)):
            return True
        if name == "role" and value.lower() in BOILER_ROLES:
            return True
        if name in ("class", "id"):
            for label in value.split():
                words = [w.lower() for w in WORD.findall(label)]
                if not words or words[0] in NOT_ITSELF:
                    continue
                if not BOILER_WORDS.isdisjoint(words) or ("header" in words and not in_article and tag not in HEADINGS):
                    return True
    return False


class Page:
    """The blocks of a page in order, each under its element."""

    def __init__(self, source: str):
        # elements: tag, parent's number; the root is number 0
        self.tags, self.parents = ["#root"], [0]
        # blocks: element number, path, text, share of the text inside links
        self.owners: list[int] = []
        self.paths: list[int] = []
        self.texts: list[str] = []
        self.linked: list[float] = []
        self._path_numbers: dict[tuple[int, str], int] = {}
        self._paths = [0]
        # open elements: tag, number of the block element, boilerplate, inside an article
        self._open = [("#root", 0, False, False)]
        self._count: dict[str, int] = {}
        self._pieces: list[str] = []
        self._link_chars = self._chars = 0
        at = 0
        for token in TOKEN.finditer(source):
            if token.start() > at:
                self._text(source[at : token.start()])
            at = token.end()
            tag = token["tag"] or token["tag2"]
            if tag:
                tag = tag.lower()
                if token["end"] or token["end2"]:
                    self._close(tag)
                else:
                    self._start(tag, token["attrs"] or token["attrs2"] or "")
        self._text(source[at:])
        self._end_block()

    def _text(self, raw: str) -> None:
        if self._open[-1][2]:
            return
        text = html.unescape(raw) if "&" in raw else raw
        self._pieces.append(text)
        size = len(text) - text.count(" ")
        self._chars += size
        if self._count.get("a"):
            self._link_chars += size

    def _end_block(self) -> None:
        text = " ".join("".join(self._pieces).split())
        if text:
            element = self._open[-1][1]
            self.owners.append(element)
            self.paths.append(self._paths[element])
            self.texts.append(text)
            self.linked.append(self._link_chars / max(self._chars, 1))
        self._pieces.clear()
        self._link_chars = self._chars = 0

    def _start(self, tag: str, attrs: str) -> None:
        if tag in EMPTY:
            if tag == "br" and not self._open[-1][2]:
                self._pieces.append(" ")
            elif tag == "hr":
                self._end_block()
            return
        if tag not in INLINE:
            self._end_block()
            self._imply(tag)
        _, element, skipped, in_article = self._open[-1]
        skipped = skipped or is_boilerplate(tag, attrs, in_article)
        if tag not in INLINE:
            self.tags.append(tag)
            self.parents.append(element)
            number = self._path_numbers.setdefault((self._paths[element], tag), len(self._path_numbers) + 1)
            self._paths.append(number)
            element = len(self.tags) - 1
        self._open.append((tag, element, skipped, in_article or tag == "article"))
        self._count[tag] = self._count.get(tag, 0) + 1

    def _imply(self, tag: str) -> None:
        """Close what a block-level tag ends by itself: a paragraph, or the item before it."""
        if self._count.get("p"):
            self._pop_within("p")
        for other in CLOSES.get(tag, ()):
            if self._count.get(other):
                self._pop_within(other)

    def _pop_within(self, tag: str) -> None:
        """Close the innermost such element, if no element that begins a new scope lies over it."""
        for place in range(len(self._open) - 1, 0, -1):
            found = self._open[place][0]
            if found == tag:
                return self._pop_to(place)
            if found in SCOPES:
                return None
        return None

    def _pop_to(self, place: int) -> None:
        for tag, *_ in self._open[place:]:
            self._count[tag] -= 1
        del self._open[place:]

    def _close(self, tag: str) -> None:
        if not self._count.get(tag):
            return
        if tag in INLINE:
            for place in range(len(self._open) - 1, 0, -1):
                found = self._open[place][0]
                if found == tag:
                    return self._pop_to(place)
                if found not in INLINE:
                    return None
            return None
        self._end_block()
        for place in range(len(self._open) - 1, 0, -1):
            if self._open[place][0] == tag:
                return self._pop_to(place)
        return None


def smoothed(values: list[float]) -> list[float]:
    """Gaussian mean of each value and its neighbours, as shares of the greatest."""
    n, out = len(values), []
    for i in range(n):
        window = range(max(0, i - RADIUS), min(n, i + RADIUS + 1))
        weights = [KERNEL[j - i + RADIUS] for j in window]
        out.append(sum(w * values[j] for w, j in zip(weights, window)) / sum(weights))
    most = max(out)
    return [v / most for v in out] if most else out


def content_paths(page: Page) -> set[int]:
    """The paths whose fused, smoothed ratios reach the page's standard deviation."""
    sums: dict[int, list[float]] = {}
    for path, text, linked in zip(page.paths, page.texts, page.linked):
        total = sums.setdefault(path, [0, 0, 0])
        total[0] += 1
        total[1] += len(text) * (1 - linked)
        total[2] += len(PUNCTUATION.findall(text))
    lengths = smoothed([sums[p][1] / sums[p][0] for p in page.paths])
    marks = smoothed([sums[p][2] / sums[p][0] for p in page.paths])
    fused = [sqrt(a * b) for a, b in zip(lengths, marks)]
    least = pstdev(fused)
    scores: dict[int, float] = {}
    for path, score in zip(page.paths, fused):
        scores[path] = scores.get(path, 0.0) + score
    means = {p: total / sums[p][0] for p, total in scores.items()}
    least = min(least, max(means.values()))
    return {p for p, mean in means.items() if mean >= least}


def content_blocks(page: Page) -> list[int]:
    """Numbers of the blocks that make up the main text, in page order."""
    if not page.texts:
        return []
    chosen = content_paths(page)
    picked = [p in chosen for p in page.paths]
    own = [0] * len(page.tags)
    for owner, text, is_content in zip(page.owners, page.texts, picked):
        own[owner] += len(text) if is_content else 0
    mass = own.copy()
    for element in range(len(mass) - 1, 0, -1):
        mass[page.parents[element]] += mass[element]
    heaviest: dict[int, int] = {}
    for element in range(len(mass) - 1, 0, -1):
        parent = page.parents[element]
        if mass[element] >= mass[heaviest.get(parent, element)]:
            heaviest[parent] = element
    root = 0
    while page.tags[root] != "article" and root in heaviest:
        child = heaviest[root]
        if mass[child] < MAJORITY * mass[root] or mass[child] == own[child]:
            if not (page.tags[child] in WHOLE and mass[child] >= MAJORITY * mass[root]):
                break
        root = child
    inside = [False] * len(mass)
    inside[root] = True
    whole = root
    while whole and page.tags[whole] not in WHOLE:
        whole = page.parents[whole]
    if whole:
        root = whole
        inside[root] = True
    for element in range(root + 1, len(mass)):
        inside[element] = inside[page.parents[element]]
    blocks = [i for i, owner in enumerate(page.owners) if inside[owner]]
    if page.tags[root] in WHOLE:
        kept = blocks
    else:
        heading = [page.tags[o] in HEADINGS for o in page.owners]
        content = [i for i in blocks if picked[i] and page.linked[i] <= LINKS] or [i for i in blocks if picked[i]]
        first, last = content[0], content[-1]
        while first - 1 >= blocks[0] and heading[first - 1]:
            first -= 1
        kept = [i for i in blocks if first <= i <= last and (picked[i] or heading[i] or page.linked[i] <= LINKS)]
    if not any(page.tags[page.owners[i]] == "h1" for i in kept):
        titles = [i for i in range(kept[0]) if page.tags[page.owners[i]] == "h1"]
        kept = titles[-1:] + kept
    return kept


def main_text(source: str | None) -> str:
    """The page's main text, one line per block."""
    if not source:
        return ""
    page = Page(source)
    return "\n".join(page.texts[i] for i in content_blocks(page))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and its number of code points, a row for every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(source) for source in batch["html"].to_pylist()]
            columns = [batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.record_batch(columns, ["page_id", "url", "text", "n_chars"])

    needed = pages.select("page_id", "url", "html")
    page_id, url = (needed.schema[c].dataType.simpleString() for c in ("page_id", "url"))
    return needed.mapInArrow(run, f"page_id {page_id}, url {url}, text string, n_chars long")
