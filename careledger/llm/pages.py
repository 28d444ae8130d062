"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block elements. The first pass decides a block by its length, link
density and stop-word density, and by where it stands: menus, headers, footers, sidebars, forms,
adverts, notices and reader comments are never text, an article element or a heading in it is. The
second pass gives blocks that are too short to tell the label of their nearest decided neighbours: text
between two texts, none between two others, and the nearer one's otherwise. Stop words are of four
languages: on pages in another one length and links decide alone; long blocks with few stop words (tables,
code) are text beside text. In an article only lists of links are left out.

Defined results: a null or empty page, or one with blocks of no text, gives an empty text; markup that
is never closed ends with the page; repeated rows are each returned.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Density of links above which a block is none; of stop words from which one is text, and below
# which one can't be; characters below which a block is ambiguous, and from which it is long.
LINKS, HIGH, LOW = 0.35, 0.30, 0.20
SHORT, LONG = 70, 200
# Density of stop words in the page from which its language is taken for one of theirs.
KNOWN = 0.1
# Share of a page's text above which an element is no menu or advert, whatever its name.
MOST = 0.5

# Elements by what they do to blocks.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section summary table tbody td tfoot th thead title tr ul".split()
)
SKIPPED = frozenset("script style noscript template head title svg math iframe object canvas audio video select textarea button".split())
OUTSIDE = frozenset("nav aside footer form menu dialog search".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that end an open p, and those that end an open element of their own kind.
ENDS_ITSELF = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
ENDS_P = BLOCKS - {"body", "html", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "option", "optgroup", "legend", "summary"}
# Words in class, id or role that name what is not the article; a name is one of them, or ends
# or begins with one ("site-footer", "comments_list"), unless it says how a page is laid out.
NAMED = re.compile(
    r"(?:^|[_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|"
    r"sidebar|side-?nav|nav\w*|menu\w*|breadcrumbs?|pagination|pager|footer|masthead|site-?header|toolbar|widget\w*|"
    r"related|recommend\w*|share|sharing|social|subscribe|newsletter|signup|login|search\w*|comments?|comment-?\w+|"
    r"replies|disqus\w*|respond|complementary|contentinfo|navigation|hidden)(?:$|[_-])", re.IGNORECASE,
)
LAYOUT = re.compile(
    r"^(?:overflow|no|has|with|without|not|is-not|backface)[_-]|[_-](?:overflow|no|has|with|without|not)[_-]|"
    r"[_-](?:visible|open|closed|enabled|disabled)$|^(?:xs|sm|md|lg|xl)[_:-]|:", re.IGNORECASE,
)
HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
# Frequent words of English, German, French and Spanish.
STOP = frozenset(
    "the of and to in a is that for it as was with be by on not he this are or his from at which but have an had they "
    "you were their one all we can her has there been if more when will would who so no "
    "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass "
    "sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch "
    "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il sont avec ou aux mais comme "
    "on son cette ont été leur elle nous vous y "
    "el los las del que y por con una su para al lo como más o pero sus le ha me si sin sobre este ya entre cuando todo "
    "esta ser son dos también fue había era muy".split()
)
_WORDS = re.compile(r"[^\W\d_]+")
_WIDE = re.compile("[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af\uf900-\ufaff]")
_SPACE = re.compile(r"\s+")


@dataclass
class Block:
    text: str
    linked: int
    article: bool
    outside: bool
    heading: bool
    #: The elements named like what is not the article, around the block.
    named: tuple[int, ...] = ()
    links: int = 0
    #: It stands in a list.
    item: bool = False


def named(names: str) -> bool:
    return any(NAMED.search(n) and not LAYOUT.search(n) for n in names.split())


class _Blocks(HTMLParser):
    """Blocks of a page in order, with where each stands."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.stack: list[tuple[str, str]] = []  # element, what it is: skip, out, named, article, head, link, item or ""
        self.count = {"skip": 0, "out": 0, "named": 0, "article": 0, "head": 0, "link": 0, "item": 0, "": 0}
        self.wrappers: list[int] = []  # the open named elements
        self.wraps: set[int] = set()  # the named elements that hold an article
        self.n_named = 0
        self.parts: list[str] = []
        self.linked = self.links = 0

    def close_block(self) -> None:
        text = _SPACE.sub(" ", "".join(self.parts)).strip()
        if text:
            self.blocks.append(Block(
                text, self.linked, self.count["article"] > 0, self.count["out"] > 0, self.count["head"] > 0,
                tuple(self.wrappers), self.links, self.count["item"] > 0,
            ))
        self.parts, self.linked, self.links = [], 0, 0

    def _kind(self, tag: str, attrs: dict) -> str:
        if tag in SKIPPED:
            return "skip"
        # A header of the page, not that of the article.
        if tag in OUTSIDE or tag == "header" and not self.count["article"]:
            return "out"
        if "hidden" in attrs or (attrs.get("aria-hidden") or "").lower() == "true" or re.search(
            r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style") or "", re.IGNORECASE,
        ):
            return "skip"
        if tag not in ("html", "body", "article", "main") and named(
            " ".join(attrs.get(k) or "" for k in ("class", "id", "role")),
        ):
            return "named"
        if tag in ("article", "main") or (attrs.get("role") or "").lower() in ("main", "article"):
            return "article"
        return "head" if tag in HEADINGS else "link" if tag == "a" else "item" if tag == "li" else ""

    def _pop(self) -> None:
        _, kind = self.stack.pop()
        self.count[kind] -= 1
        if kind == "named":
            self.wrappers.pop()

    def _end(self, tags: tuple[str, ...], within: frozenset) -> None:
        """Close the innermost open element of tags, unless one of within is open inside of it."""
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] in tags:
                while len(self.stack) > i:
                    self._pop()
                return
            if self.stack[i][0] in within:
                return

    def handle_starttag(self, tag: str, attrs) -> None:
        # An element that can't stand in a head ends it.
        if tag not in HEAD and tag not in ("head", "html") and self.stack and self.stack[-1][0] == "head":
            self._pop()
        if tag in BLOCKS:
            self.close_block()
        elif tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        if tag in ENDS_P:
            self._end(("p",), frozenset(("td", "th", "button", "body", "html")))
        if tag in ENDS_ITSELF:
            self._end(ENDS_ITSELF[tag], frozenset(("ul", "ol", "dl", "table", "select", "menu")))
        kind = self._kind(tag, dict(attrs))
        self.stack.append((tag, kind))
        self.count[kind] += 1
        self.links += kind == "link"
        if kind == "named":
            self.wrappers.append(self.n_named)
            self.n_named += 1
        elif kind == "article":
            self.wraps.update(self.wrappers)

    def handle_startendtag(self, tag: str, attrs) -> None:
        if tag in BLOCKS:
            self.close_block()
        elif tag == "br":
            self.parts.append(" ")

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.close_block()
        if any(t == tag for t, _ in self.stack):
            while True:
                name = self.stack[-1][0]
                self._pop()
                if name == tag:
                    return

    def handle_data(self, data: str) -> None:
        if self.count["skip"]:
            return
        self.parts.append(data)
        if self.count["link"]:
            self.linked += len(data.strip())


def blocks(html: str) -> list[Block]:
    parser = _Blocks()
    parser.feed(html)
    parser.close()
    parser.close_block()
    # A name says nothing of an element that holds an article, or most of the text.
    sizes: dict[int, int] = {}
    total = 0
    for b in parser.blocks:
        size = 0 if b.outside else max(0, len(b.text) - b.linked)
        total += size
        for w in b.named:
            sizes[w] = sizes.get(w, 0) + size
    articles = any(b.article for b in parser.blocks)
    wide = parser.wraps | {w for w, size in sizes.items() if not articles and size > MOST * total}
    for b in parser.blocks:
        b.outside = b.outside or any(w not in wide for w in b.named)
    return parser.blocks


def density(block: Block) -> float:
    words = _WORDS.findall(block.text.lower())
    return sum(w in STOP for w in words) / max(len(words), 1)


def size(block: Block) -> int:
    """Characters; one of Chinese, Japanese or Korean says as much as three."""
    return len(block.text) + 2 * len(_WIDE.findall(block.text))


def link_list(block: Block) -> bool:
    """Links and hardly anything beside them: in a list, or several in a row."""
    return block.linked > LINKS * len(block.text) and (block.item or block.links > 2)


def known_language(found: list[Block]) -> bool:
    """Whether the stop words are those of the page's language."""
    plain = [b for b in found if not b.outside and b.linked <= LINKS * len(b.text)]
    total = sum(len(b.text) for b in plain)
    return total > 0 and sum(density(b) * len(b.text) for b in plain) >= KNOWN * total


def decide(block: Block, known: bool = True) -> bool | None:
    """First pass: True for text, False for none, None where it can't tell; known: the page is in a language of STOP."""
    if block.outside:
        return False
    if block.article:
        return not link_list(block)
    if block.linked > LINKS * len(block.text):
        return False
    if size(block) < SHORT or block.heading:
        return None
    share = density(block)
    if share >= HIGH or not known:
        return True
    if share >= LOW:
        return True if size(block) >= LONG else None
    # Tables, lists and code have few stop words.
    return None if size(block) >= LONG else False


def main_text(html: str | None) -> str:
    """The text of the blocks that both passes keep, joined by newlines."""
    found = blocks(html or "")
    known = any(b.article for b in found) or known_language(found)
    labels = [decide(b, known) for b in found]
    # Where there is an article, what is outside of it is not the text.
    if any(b.article and label for b, label in zip(found, labels)):
        labels = [bool(label and b.article) for b, label in zip(found, labels)]
    before, at = [None] * len(found), None
    for i, label in enumerate(labels):
        if label is not None:
            at = i
        before[i] = at
    after, at = [None] * len(found), None
    for i in range(len(found) - 1, -1, -1):
        if labels[i] is not None:
            at = i
        after[i] = at
    kept = []
    for i, block in enumerate(found):
        label = labels[i]
        if label is None:
            left, right = before[i], after[i]
            sides = [labels[j] for j in (left, right) if j is not None]
            if not block.heading and size(block) >= LONG:
                # Too long to go with a menu: text beside text, and where the page has no other.
                label = any(sides) or True not in labels
            elif len(set(sides)) < 2:
                label = bool(sides) and sides[0]
            elif block.heading:
                label = labels[right]
            else:
                label = labels[left if i - left < right - i else right]
        if label:
            kept.append(block.text)
    return "\n".join(kept)


def extracted(html: str = "html") -> Column:
    """The main text of a column of pages."""

    @F.pandas_udf("string")
    def run(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in pages:
            yield part.map(main_text, na_action=None).astype(object)

    return run(F.coalesce(F.col(html).cast("string"), F.lit("")))
