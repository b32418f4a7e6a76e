"""Main text of web pages by scoring the element tree.

The page is parsed into blocks of text within nested containers. Menus, forms and other furniture
are set aside by element, role or class. Every block then passes points for its length and its
commas to its container and, halved, to the one above; a container's points are discounted by the
share of its text that is link text. The best container is kept with such siblings as score well,
the headings before them and the short blocks between, and its blocks are joined in page order.

Reading and scoring take time in proportion to the page, whatever its markup: a tag is looked at
once, searches that fail are not repeated, and elements nest :data:`DEPTH` deep at most, text in
deeper ones being that of the last one.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from feedlake.llm.common import map_rows

DEPTH = 512
# Names of elements by their part in a page, as HTML defines them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title".split())
MEDIA = frozenset(
    "noscript template iframe object svg math canvas audio video noembed noframes".split()
)
CHOICES = frozenset("select option optgroup datalist".split())
FURNITURE = frozenset("nav footer aside form button menu dialog fieldset head search".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p "
    "pre section summary table caption thead tbody tfoot tr td th ul".split()
)
CONTAINERS = frozenset(
    "article body div main section td blockquote center details figure li table".split()
)
CLOSED_BY_BLOCK = "p"
# An element that opens ends an open one of these, up to the stop elements.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "thead": (("thead", "tbody", "tfoot", "tr", "td", "th"), ("table",)),
    "tbody": (("thead", "tbody", "tfoot", "tr", "td", "th"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot", "tr", "td", "th"), ("table",)),
    "option": (("option",), ("select",)),
}
# Words of class names and ids that mark furniture, as whole words.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement adsense sponsor sponsored promo promotion banner "
    "sidebar rail menu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar "
    "comment comments disqus respond replies reviews cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe subscription signup login share sharing social "
    "related recommended pager pagination skip widget toolbar tags".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search alert dialog alertdialog menu menubar "
    "toolbar form".split()
)
# Words that, beside such a word, leave a name one of furniture: they tell of layout only.
LAYOUT = frozenset(
    "area article articles bar block bottom box btn button buttons col column container content "
    "desktop fixed form footer global group header icon icons inner item items js left link links "
    "list main message mobile msg outer page panel policy post posts primary right row secondary "
    "section site slot space sticky stories story text title top unit wrap wrapper".split()
)
# Names by which an article is none of its own.
NO_ARTICLE = frozenset("comment comments reply advert advertisement promo related widget".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_NAME = re.compile(r"</?([A-Za-z][^\s/>]*+)")
_QUOTE = re.compile(r">|=\s*+([\"'])")
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_COMMA = re.compile(r"[,،、，]")
_SENTENCE = re.compile(r"[.!?…。！？]")


@dataclass(eq=False, slots=True)
class Element:
    tag: str
    parent: Element | None
    number: int = 0  # in page order
    dropped: bool = False
    doubtful: bool = False  # by its name it may be furniture
    score: float = 0.0
    text: int = 0  # characters below
    linked: int = 0  # of these, within links
    sentence: bool = False
    last: int = 0  # the greatest number below
    branch: Element | None = None  # the child of the best container's parent that it is under

    @property
    def density(self) -> float:
        return self.linked / self.text if self.text else 0.0

    def within(self, other: Element) -> bool:
        return other.number <= self.number <= other.last

    def box(self) -> Element:
        """The nearest container, this element included."""
        element = self
        while element.tag not in CONTAINERS and element.parent is not None:
            element = element.parent
        return element


@dataclass(slots=True)
class Block:
    inner: Element
    text: str
    linked: int
    heading: bool
    solid: int


def _attributes(source: str) -> dict[str, str]:
    if not source.strip():
        return {}
    found = {}
    for name, value in _ATTRIBUTE.findall(source):
        found.setdefault(name.lower(), html.unescape(value.strip("\"'")))
    return found


def _furniture(tag: str, source: str, in_article: bool) -> tuple[bool, bool]:
    """Whether an element is furniture, and whether it may be, depending on its text."""
    if tag in FURNITURE or tag in CHOICES or (tag == "header" and not in_article):
        return True, False
    if not source or source.isspace():
        return False, False
    values = _attributes(source)
    style = values.get("style", "").replace(" ", "").lower()
    if "hidden" in values or values.get("aria-hidden", "").lower() == "true":
        return True, False
    if "display:none" in style or "visibility:hidden" in style:
        return True, False
    if values.get("role", "").lower() in ROLES:
        return True, False
    names = f"{values.get('class', '')} {values.get('id', '')}".split()
    if tag == "article":
        return any(name.lower() in NO_ARTICLE for name in names), False
    if tag in ("body", "html", "main", "a", "span", "p") or tag.startswith("h"):
        return False, False
    doubtful = False
    for name in names:
        words = [word.lower() for word in _WORD.findall(name)]
        if any(word in MARKS for word in words):
            if all(word in MARKS or word in LAYOUT or word.isdigit() for word in words):
                return True, False
            doubtful = True
    return False, doubtful


class Page:
    """The blocks of a page and the containers they are in."""

    def __init__(self, source: str):
        self.source = source
        self.root = Element("html", None)
        self.elements = [self.root]
        self.open = [self.root]
        self.count = Counter()  # open elements by name
        self.blocks: list[Block] = []
        self.pieces: list[str] = []
        self.linked = 0
        self.ends: dict[str, int] = {}
        self.quotes = True
        self.last = {sign: source.rfind(sign) for sign in ("-->", "]]>", ">", "'", '"')}
        self._read()
        self._end_block()

    def _read(self) -> None:
        source, place = self.source, 0
        while (low := source.find("<", place)) >= 0:
            self._add(source[place:low])
            place = self._markup(low)
            if place == low:  # no markup
                self._add("<")
                place += 1
        self._add(source[place:])

    def _markup(self, low: int) -> int:
        """Takes the markup that starts at ``low``; the place after it, ``low`` if there is none."""
        source = self.source
        if source.startswith("<!--", low):
            return source.index("-->", low + 2) + 3 if self.last["-->"] >= low + 2 else len(source)
        if source.startswith("<![CDATA[", low) and self.last["]]>"] >= low:
            end = source.index("]]>", low)
            self._add(source[low + 9 : end], raw=True)
            return end + 3
        if source.startswith(("<!", "<?"), low):
            return source.index(">", low) + 1 if self.last[">"] >= low else len(source)
        name = _NAME.match(source, low) if self.last[">"] > low else None
        end = self._tag_end(name.end()) if name else -1
        if end < 0:
            return low
        tag = name[1].lower()
        if source[low + 1] == "/":
            self._close(tag)
            return end
        alone = source[end - 2] == "/"
        if tag in RAW and not alone and self._end_of(tag, end) >= 0:
            place = self._end_of(tag, end)
            return source.index(">", place) + 1 if self.last[">"] >= place else len(source)
        if not (tag in RAW or tag in MEDIA) or not (alone or (tag in MEDIA and self._end_of(tag, end) < 0)):
            self._start(tag, source[name.end() : end - 1])
        return end

    def _tag_end(self, place: int) -> int:
        """The place after the ``>`` that ends a tag, none within a quoted value; -1 without one."""
        source, start = self.source, place
        while self.quotes:
            found = _QUOTE.search(source, place)
            if not found:
                # All that is left is within quotes: from here on they are ordinary characters.
                self.quotes = False
            elif not found[1]:
                return found.end()
            else:
                closed = self.last[found[1]] >= found.end()
                place = source.index(found[1], found.end()) + 1 if closed else found.end()
        return source.find(">", start) + 1 or -1

    def _end_of(self, tag: str, place: int) -> int:
        """The place of the next end tag of this name, -1 without one."""
        known = self.ends.get(tag, -2)
        if known == -1 or known >= place:
            return known
        end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.IGNORECASE).search(self.source, place)
        self.ends[tag] = end.start() if end else -1
        return self.ends[tag]

    def _add(self, text: str, raw: bool = False) -> None:
        if text and not self.open[-1].dropped:
            value = text if raw else html.unescape(text)
            self.pieces.append(value)
            if self.count["a"]:
                self.linked += len("".join(value.split()))

    def _end_block(self) -> None:
        text = " ".join("".join(self.pieces).split())
        if text:
            inner = self.open[-1]
            heading = any(self.count[tag] for tag in HEADINGS)
            solid = len(text) - text.count(" ")
            self.blocks.append(Block(inner, text, self.linked, heading, solid))
        self.pieces, self.linked = [], 0

    def _start(self, tag: str, source: str) -> None:
        if tag == "br":
            self.pieces.append(" ")
            return
        if tag in VOID:
            if tag == "hr":
                self._end_block()
            return
        if tag == "html" or (tag == "body" and self.count[tag]):
            return
        if tag in BLOCKS:
            self._end_block()
            self._close(CLOSED_BY_BLOCK, until=CONTAINERS | {"ul", "ol", "dl"})
        if tag in CLOSES:
            ends, stops = CLOSES[tag]
            for end in ends:
                self._close(end, until=frozenset(stops))
        if tag == "a" or tag in MEDIA:
            self._close(tag)
        above = self.open[-1]
        in_article = self.count["article"] + self.count["main"] > 0
        dropped, doubtful = _furniture(tag, source, in_article)
        dropped = dropped or tag in MEDIA or tag in RAW
        within = above.dropped
        if within and tag in ("article", "main") and self._only_wrapped():
            within = False
        # Other elements within a line, such as bold ones, bear on nothing.
        if not dropped and not doubtful and tag not in BLOCKS and tag not in CONTAINERS and tag != "a":
            return
        if len(self.open) > DEPTH and (within or not dropped):
            return
        element = Element(tag, above, len(self.elements), within or dropped, doubtful)
        if element.dropped and not above.dropped:
            self._end_block()
        self.elements.append(element)
        self.open.append(element)
        self.count[tag] += 1

    def _only_wrapped(self) -> bool:
        """Whether what drops this place is a form, as servers put around whole pages."""
        origins = [e for e in self.open if e.dropped and not e.parent.dropped]
        return origins[-1].tag == "form"

    def _close(self, tag: str, until: frozenset = frozenset()) -> None:
        if not self.count[tag]:
            return
        skips = tag in FURNITURE or tag in MEDIA or tag in CHOICES
        for place in range(len(self.open) - 1, 0, -1):
            element = self.open[place]
            if element.tag == tag:
                if tag in BLOCKS or any(e.tag in BLOCKS for e in self.open[place:]):
                    self._end_block()
                for gone in self.open[place:]:
                    self.count[gone.tag] -= 1
                del self.open[place:]
                return
            if element.tag in until:
                return
            # An inline end tag does not reach beyond the block it is in.
            if tag not in BLOCKS and element.tag in BLOCKS and not (element.dropped and skips):
                return


def _points(block: Block) -> float:
    share = block.linked / max(1, block.solid)
    return (1 + len(_COMMA.findall(block.text)) + min(len(block.text) / 100, 3)) * (1 - min(share, 1))


def _add_up(page: Page, blocks: list[Block]) -> None:
    """Characters, link characters and sentences below every element."""
    for element in page.elements:
        element.text = element.linked = 0
        element.sentence = False
        element.last = element.number
    for block in blocks:
        block.inner.text += block.solid
        block.inner.linked += block.linked
        block.inner.sentence |= bool(_SENTENCE.search(block.text))
    for element in reversed(page.elements[1:]):
        above = element.parent
        above.text += element.text
        above.linked += element.linked
        above.sentence |= element.sentence
        above.last = max(above.last, element.last)


def _without_doubtful(page: Page) -> list[Block]:
    """The blocks but for those in elements that are furniture by name and by their text as well."""
    if not any(element.doubtful for element in page.elements):
        return page.blocks
    _add_up(page, page.blocks)
    for element in page.elements[1:]:
        by_text = element.density >= 1 / 3 or (element.text < 80 and not element.sentence)
        element.dropped = element.parent.dropped or (element.doubtful and by_text)
    return [block for block in page.blocks if not block.inner.dropped]


def _best(page: Page, blocks: list[Block]) -> Element:
    """The best container: an article or main part if it is in one, as these are one whole."""
    for block in blocks:
        points, element = _points(block), block.inner
        for share in (1, 2, 6):
            element = element.box()
            element.score += points / share
            if element.parent is None:
                break
            element = element.parent
    ranked = (e for e in page.elements if e.text and (e.tag in CONTAINERS or e.parent is None))
    element = best = max(ranked, key=_worth)
    while element is not None:
        if element.tag in ("article", "main"):
            best = element
            if element.tag == "article":
                break
        element = element.parent
    return best


def _worth(element: Element) -> float:
    return element.score * (1 - element.density)


def _belongs(element: Element, best: Element) -> bool:
    """Whether a sibling of the best container is part of the text."""
    if best.tag == "article":
        return element.tag == "article" and element.density < 0.2 and _worth(element) >= _worth(best) / 2
    return _worth(element) >= 0.2 * _worth(best)


def main_blocks(page: Page) -> list[str]:
    """The blocks of the best container and of what belongs to it.

    Beside it these are siblings with a fifth of its points, or for an article other articles with
    half of them; blocks without links between kept ones; and headings directly before the first
    kept block, with what stands between.
    """
    blocks = _without_doubtful(page)
    if not blocks:
        return []
    _add_up(page, blocks)
    best = _best(page, blocks)
    kept = [block.inner.within(best) for block in blocks]
    around = best.parent
    if around is not None and best.tag not in ("main", "body"):
        for element in page.elements[around.number + 1 : around.last + 1]:
            element.branch = element if element.parent is around else element.parent.branch
        near = [block.inner.within(around) for block in blocks]
        for place, block in enumerate(blocks):
            branch = block.inner.branch if near[place] and block.inner is not around else None
            if branch is not None and not kept[place]:
                kept[place] = _belongs(branch, best)
            elif near[place] and block.inner is around and best.tag != "article":
                kept[place] = len(block.text) > 80 and not block.linked
        first = kept.index(True)
        last = len(kept) - 1 - kept[::-1].index(True)
        for place in range(first, last):
            kept[place] |= near[place] and not blocks[place].linked
        start = first
        for place in range(first - 1, -1, -1):
            if not near[place] or blocks[place].linked or len(blocks[place].text) > 300:
                break
            if blocks[place].heading:
                start = place
        kept[start:first] = [True] * (first - start)
    return [block.text for block, keep in zip(blocks, kept, strict=True) if keep]


def extract(source: str | None) -> str:
    """Main text of one page; empty for a null or empty page and for one without text."""
    return "\n".join(main_blocks(Page(source))) if source else ""


def extract_text(pages: DataFrame, column: str = "html") -> DataFrame:
    """Adds ``text``, the main text of each page, and ``n_chars``, its length in code points.

    White space within a block is one space, blocks are lines. Null, empty and text-less pages give
    an empty text and 0; repeated pages give the same each time. Columns of these two names in the
    input give way.
    """

    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                texts = [extract(value.as_py()) for value in part.column(column)]
                yield part, (
                    pa.array(texts, pa.string()),
                    pa.array([len(text) for text in texts], pa.int64()),
                )

    return map_rows(pages, "text string, n_chars bigint", run)
