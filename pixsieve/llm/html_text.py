"""Main text of web pages: flat text blocks judged by a small decision tree.

A page is cut into text blocks at block-level elements. Every block is described by its words and link
density, those of the blocks before and after it, and where it stands (element, kinds of containers,
words in their class, id or role). A container counts the less the more of the page's words it holds, so a wrapper
around everything says nothing, whatever its name. A decision tree labels a block main text or boilerplate. The tree
is grown once from the labelled blocks of a few small pages written for it, below.

Tasks parse whole pages; nothing is shuffled. White space in a block becomes one blank, blocks are
joined by ``\\n`` in page order; character references are decoded. Unclosed elements end with their
container, as browsers have it; a page that breaks off ends there, and so does a tag, comment or quoted value
that nothing ends. Time is linear in the page however broken it is: what was searched for in vain is not
searched for again, and an end tag looks up where its element is open.

Edge cases: a null or empty page, and one without main blocks, has the empty text; repeated rows give equal
results; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixsieve.llm.chunks import text_chunks
from pixsieve.models import cached

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
SILENT = frozenset("head title script style noscript template svg math iframe object audio video canvas select datalist button textarea".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PROSE = frozenset("p blockquote pre dd td figcaption".split())
ITEMS = frozenset("li dt".split())
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section table ul".split()
)
ENDS_LIKE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPES = frozenset("ul ol dl table article section div body nav aside footer header form main".split())
# Words in class, id or role that mark what is not main text (fixed values).
MARKED = frozenset(
    "ad ads adv advert advertisement adverts advertising banner breadcrumb breadcrumbs byline comment commentlist comments consent "
    "cookie cookies disclaimer disqus feedback footer form gdpr header login masthead menu menubar modal nav navbar navigation "
    "newsletter notice notification overlay pager pagination paywall popup promo promoted promotion recommended related "
    "reply replies respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription tags teaser toolbar "
    "topbar trending widget".split()
)
MARKED_MAIN = frozenset("comment comments reply teaser related".split())
FEATURES = (
    "words", "links", "words_before", "links_before", "words_after", "links_after", "heading", "prose", "item",
    "in_main", "in_side", "in_header", "marked", "sentence",
)
DEPTH = 8
SEPARATOR = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])")


RAW = frozenset("script style".split())
_RAW_END = {tag: re.compile(f"</{tag}(?=[ \\t\\n\\r\\f/>])", re.IGNORECASE) for tag in RAW}
_NAME_END = re.compile("[ \\t\\n\\r\\f/>]")
_KEY_END = re.compile("[ \\t\\n\\r\\f/=>]")
_VALUE_END = re.compile("[ \\t\\n\\r\\f>]")
_NEXT_KEY = re.compile("[^ \\t\\n\\r\\f/]")
_NOT_BLANK = re.compile("[^ \\t\\n\\r\\f]")


@dataclass(slots=True)
class _Open:
    """An element. ``mark``, ``side`` and ``header`` are the innermost such containers, itself included."""

    tag: str
    within: str = ""
    main: bool = False
    silent: bool = False
    hidden: bool = False
    wanted: bool = False
    mark: _Open | None = None
    side: _Open | None = None
    header: _Open | None = None
    page: _Open | None = None
    first: int = 0
    last: int = 0


@dataclass
class Block:
    parts: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)
    tag: str = ""
    place: _Open | None = None


class _Blocks:
    """Collects the text blocks of one page."""

    def __init__(self) -> None:
        self.blocks: list[Block] = []
        self._root = _Open("")
        self._root.page = self._root
        self._stack = [self._root]
        self._at: dict[str, list[int]] = defaultdict(list)
        self._block = Block()
        self._links = self._words = 0

    def read(self, page: str) -> list[Block]:
        at, end = 0, len(page)
        while at < end:
            sign = page.find("<", at)
            if sign < 0:
                sign = end
            if sign > at:
                self._text(unescape(page[at:sign]))
            kind = page[sign + 1:sign + 2]
            if kind.isascii() and kind.isalpha():
                at = self._start_tag(page, sign + 1)
            elif kind == "/" and page[sign + 2:sign + 3].isascii() and page[sign + 2:sign + 3].isalpha():
                name, stop = _NAME_END.search(page, sign + 2), page.find(">", sign + 2)
                at = end if stop < 0 else stop + 1
                if stop >= 0:
                    self._end(page[sign + 2:name.start()].lower())
            elif page.startswith("<!--", sign):
                stop = page.find("-->", sign + 2)
                at = end if stop < 0 else stop + 3
            elif kind in ("!", "?", "/"):
                stop = page.find(">", sign)
                at = end if stop < 0 else stop + 1
            else:
                at = min(end, sign + 1)
                if sign < end:
                    self._text("<")
        self._pop_to(1)
        self._root.last = self._words
        self._end_block()
        return self.blocks

    def _start_tag(self, page: str, at: int) -> int:
        """Reads a start tag whose name begins at ``at``; returns where it ends, the page's end if nothing ends it."""
        end, found = len(page), _NAME_END.search(page, at)
        if not found:
            return end
        name, at, given = page[at:found.start()].lower(), found.start(), {}
        while True:
            found = _NEXT_KEY.search(page, at)
            if not found:
                return end
            at = found.start()
            if page[at] == ">":
                break
            found = _KEY_END.search(page, at + 1)
            if not found:
                return end
            key, at, value = page[at:found.start()].lower(), found.start(), None
            found = _NOT_BLANK.search(page, at)
            if found and page[found.start()] == "=":
                found = _NOT_BLANK.search(page, found.start() + 1)
                if not found:
                    return end
                at = found.start()
                if page[at] in "\"'":
                    stop = page.find(page[at], at + 1)
                    if stop < 0:
                        return end
                    value, at = page[at + 1:stop], stop + 1
                else:
                    found = _VALUE_END.search(page, at)
                    if not found:
                        return end
                    value, at = page[at:found.start()], found.start()
            given.setdefault(key, unescape(value) if value else value)
        self._start(name, given)
        if page[at - 1] == "/" and name not in VOID and name in INLINE:
            self._end(name)
        elif name in RAW:
            found = _RAW_END[name].search(page, at)
            return found.start() if found else end
        return at + 1

    def _end_block(self) -> None:
        if any(not p.isspace() for p in self._block.parts):
            self.blocks.append(self._block)
        self._block = Block()

    def _pop_to(self, depth: int) -> None:
        for gone in reversed(self._stack[depth:]):
            self._at[gone.tag].pop()
            gone.last = self._words
            if gone.tag == "a":
                self._links = max(0, self._links - 1)
        del self._stack[depth:]

    def _depth(self, tags: set[str] | frozenset[str]) -> int:
        """Where the innermost open element with one of the tags is; 0 if there is none."""
        return max((self._at[t][-1] for t in tags if self._at.get(t)), default=0)

    def _close(self, tags: set[str] | frozenset[str], scopes: frozenset[str]) -> None:
        depth = self._depth(tags)
        if depth and depth >= self._depth(scopes):
            self._pop_to(depth)

    def _start(self, tag: str, given: dict[str, str | None]) -> None:
        if tag == "br":
            self._block.parts.append(" ")
        if tag not in INLINE:
            self._end_block()
            if tag in ENDS_PARAGRAPH:
                self._close({"p"}, SCOPES)
            if tag in ENDS_LIKE:
                self._close(ENDS_LIKE[tag], SCOPES - {"div"})
        if tag in VOID:
            return
        top = self._stack[-1]
        named = " ".join(v for k in ("class", "id", "role") if (v := given.get(k)))
        words = {w.lower() for w in SEPARATOR.split(named) if w} if named and tag not in ("html", "body") else set()
        is_main = tag in ("article", "main") or given.get("role") in ("main", "article")
        own = _Open(
            tag, top.within if tag in INLINE else tag, top.main or is_main, top.silent or tag in SILENT,
            top.hidden or "hidden" in given or "display:none" in (given.get("style") or "").replace(" ", ""),
            top.wanted or "data-main" in given, top.mark, top.side, top.header, self._root, self._words,
        )
        if words & (MARKED_MAIN if is_main else MARKED):
            own.mark = own
        if tag in ("nav", "footer", "aside", "form", "menu", "dialog", "fieldset"):
            own.side = own
        if tag == "header" and not own.main:
            own.header = own
        self._at[tag].append(len(self._stack))
        self._stack.append(own)
        if tag == "a":
            self._links += 1

    def _end(self, tag: str) -> None:
        if tag not in INLINE:
            self._end_block()
        if tag not in VOID:
            self._close({tag}, frozenset() if tag in SCOPES else SCOPES)

    def _text(self, data: str) -> None:
        top = self._stack[-1]
        if top.silent or not data:
            return
        block = self._block
        if not data.isspace():
            if block.place is None:
                block.place = top
                block.tag = top.within
            if self._links:
                block.linked.append(data)
            self._words += len(data.split())
        block.parts.append(data)


def blocks_of(page: str) -> list[Block]:
    return _Blocks().read(page)


def block_text(block: Block) -> str:
    return " ".join("".join(block.parts).split())


def _weight(container: _Open | None) -> float:
    """How much a container says: 0 if there is none, else the share of the page's words outside of it."""
    if container is None:
        return 0.0
    return 1.0 - (container.last - container.first) / max(1, container.page.last)


def features(blocks: list[Block], texts: list[str]) -> np.ndarray:
    """One row per block of one page, in the order of ``FEATURES``."""
    n = len(blocks)
    words = np.array([len(t.split(" ")) for t in texts], float)
    links = np.array([len(" ".join(b.linked).split()) for b in blocks], float) / words if n else words
    out = np.zeros((n, len(FEATURES)))
    out[:, 0], out[:, 1] = words, links
    out[1:, 2], out[1:, 3], out[:-1, 4], out[:-1, 5] = words[:-1], links[:-1], words[1:], links[1:]
    for i, (b, t) in enumerate(zip(blocks, texts, strict=True)):
        out[i, 6:] = (
            b.tag in HEADINGS, b.tag in PROSE, b.tag in ITEMS, b.place.main, _weight(b.place.side), _weight(b.place.header),
            1.0 if b.place.hidden else _weight(b.place.mark),
            t[-1] in ".!?…:;\"'”’)。！？",
        )
    return out


@dataclass
class Tree:
    """A binary tree in arrays: feature (-1 at a leaf), threshold, left, right, label."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    label: np.ndarray

    def predict(self, rows: np.ndarray) -> np.ndarray:
        at = np.zeros(len(rows), np.int64)
        for _ in range(DEPTH):
            inner = np.flatnonzero(self.feature[at] >= 0)
            if not len(inner):
                break
            node = at[inner]
            goes_left = rows[inner, self.feature[node]] <= self.threshold[node]
            at[inner] = np.where(goes_left, self.left[node], self.right[node])
        return self.label[at]


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = DEPTH) -> Tree:
    """A tree by least Gini impurity; the first feature wins ties."""
    nodes: list[list] = []

    def impurity(y: np.ndarray) -> float:
        p = y.mean() if len(y) else 0.0
        return 2 * p * (1 - p) * len(y)

    def build(mask: np.ndarray, level: int) -> int:
        y, own = labels[mask], len(nodes)
        nodes.append([-1, 0.0, 0, 0, bool(y.mean() >= 0.5)])
        best = (impurity(y) - 1e-9, None, 0.0)
        if level < depth - 1 and 0 < y.sum() < len(y):
            for f in range(rows.shape[1]):
                values = np.unique(rows[mask, f])
                for low, high in zip(values, values[1:], strict=False):
                    cut = (low + high) / 2
                    side = rows[mask, f] <= cut
                    cost = impurity(y[side]) + impurity(y[~side])
                    if cost < best[0] - 1e-9:
                        best = (cost, f, cut)
        if best[1] is not None:
            side = rows[:, best[1]] <= best[2]
            nodes[own][:2] = [best[1], best[2]]
            nodes[own][2] = build(mask & side, level + 1)
            nodes[own][3] = build(mask & ~side, level + 1)
        return own

    build(np.ones(len(rows), bool), 0)
    columns = list(zip(*nodes, strict=True))
    kinds = (np.int64, float, np.int64, np.int64, bool)
    return Tree(*[np.array(c, k) for c, k in zip(columns, kinds, strict=True)])


#: Labelled pages: text of elements with data-main is main text, all other text is not.
LABELLED_PAGES = (
    """<html><body><nav><ul><li><a href=1>Home</a></li><li><a href=2>World news</a></li><li><a href=3>Sport</a></li></ul></nav>
    <div class="ad">Buy two lamps and get the third one for half the price this week only.</div>
    <article><h1 data-main>Ferry returns after repairs</h1><p data-main>The island ferry sailed again on Monday after eleven days in the dock, and
    the first crossing was full.</p><p data-main>No delays.</p><p data-main>Tickets bought before the repairs stay valid until the end of the season, the harbour said in a note.</p></article>
    <footer>&copy; Harbour Post. All rights reserved. No part may be copied without leave.</footer></body></html>""",
    """<html><body><header><a href=1>Garden Letter</a><p>A weekly letter about soil, seeds and patience.</p></header>
    <main><h1 data-main>Leaf mould</h1><h2 data-main>Why wait?</h2><p data-main>Leaves take two winters to rot, and the dark crumb they leave holds water well.</p>
    <ul><li data-main>Oak and beech leaves</li><li data-main>A wire cage</li><li data-main>Rain</li></ul>
    <p data-main>Turn it <a href=2>once or twice</a> a year.</p></main>
    <aside><h3>Also read</h3><p>Compost for beginners explains the quick way with kitchen scraps and straw.</p></aside>
    <form><label>Your mail</label> <p>We send one letter a week and never share the address you give us.</p></form><footer><p>Imprint</p></footer></body></html>""",
    """<html><body><div id="menu"><a href=1>Start</a> <a href=2>Archive</a></div><div class="cookie-notice"><p>We use cookies to make the site work and to count our visitors.</p></div>
    <div><h1 data-main>A short history of the town clock</h1><p data-main>The clock was built by two brothers who never agreed on the time, which the town found funny for a century.</p>
    <p data-main>It still runs slow in cold weather, and nobody has the heart to mend it.</p><blockquote data-main>It is our slowest citizen, the mayor likes to say.</blockquote></div>
    <div class="comments"><h3>Comments</h3><p>My grandmother set her watch by it and was late all her life.</p><p>Lovely piece, thank you.</p></div>
    <div class="sidebar"><p>Most read this week in our paper, chosen by the editors for you.</p></div></body></html>""",
    """<html><body><div><a href=1>One</a> | <a href=2>Two</a> | <a href=3>Three</a></div>
    <article class="post"><header><h1 data-main>Bread without a recipe</h1></header><div data-main>Mix flour and water until it feels like an ear lobe.</div>
    <p data-main>Salt.</p><p data-main>Wait until it has doubled, fold it, and wait again while the oven heats as far as it will go.</p>
    <div class="share"><p>Share this with a friend who bakes at the weekend.</p></div><section class="related"><h3>Related</h3><p>How to keep a starter alive through a long holiday.</p></section></article>
    <section id="comments"><article class="comment"><p>Worked at once, even with rye flour and an old oven.</p></article></section></body></html>""",
    """<html><body><table><tr><td><a href=1>Index</a></td><td><a href=2>Search</a></td></tr></table><p data-main>The observatory measured the comet for six nights and found that its tail had split in two.</p>
    <p data-main>A second team, working from the southern site, saw the same split and published first.</p><p data-main>Both now share the data.</p>
    <p><a href=3>Previous</a> <a href=4>Next</a></p><div>Copyright 1999</div></body></html>""",
    """<html><body><header><nav><a href=1>Shop</a></nav><div>Free delivery on all orders above forty coins until Sunday night.</div></header>
    <div class="content"><h2 data-main>Care of wool</h2><div data-main>Wash wool cold, with little soap, and never wring it; press the water out between two towels.</div><div data-main>Dry it flat.</div></div>
    <div role="dialog" class="popup"><p>Subscribe now and read the first month for nothing at all.</p></div><footer><ul><li><a href=2>Terms</a></li><li>Made by hand</li></ul></footer></body></html>""",
    """<html><body><article><h1 data-main>Notes on a quiet strike</h1><p data-main>The printers laid down their tools at noon and walked home without a word to anyone.</p><pre data-main>noon bell, tools down, doors shut</pre>
    <ol><li data-main>They wanted shorter nights.</li><li data-main>They got <a href=1>shorter nights</a>.</li></ol><figure><figcaption data-main>The empty hall</figcaption></figure>
    <table><tr><td data-main>Nights won</td><td data-main>2</td></tr></table><p data-main><a href=2>The full list of demands</a></p>
    <nav><a href=3>Chapter 1</a><a href=4>Chapter 2</a></nav><aside><p>Sign up for our letter on work and pay, every second Friday.</p></aside><footer><p>Filed under labour</p></footer></article></body></html>""",
    """<html><body><header><h1>The Marsh Courier</h1><p>News from the lower river since the flood.</p></header><nav><a href=1>News</a> <a href=2>Tides</a></nav>
    <article><h1 data-main>Otters are back</h1><p data-main>Two were seen below the weir.</p><p data-main>Anglers are not pleased.</p></article><aside>Weather: rain</aside></body></html>""",
    """<html><body><header><div>Hill Farm Diary</div></header><p><a href=1>Home</a></p><h1 data-main>Lambing</h1><p data-main>The first came at three.</p><p data-main>Twins, both black, both loud, and on their feet before the kettle boiled.</p>
    <p><a href=2>Back to the list</a></p><div id="footer"><p>Written at the kitchen table.</p></div></body></html>""",
    """<html><body><header><span>Open daily</span></header><main><p data-main><a href=1>Rules of the house</a></p><ul><li data-main><a href=2>Quiet after ten</a></li><li data-main>No boots inside</li></ul>
    <h3 data-main>Keys</h3><p data-main>Ask.</p></main><div class="newsletter">Write to us.</div></body></html>""",
    """<html><body><div class="banner">Winter sale</div><div class="advertisement"><p>Our winter catalogue has arrived with forty new pages of boots, belts and bags, all sewn in our own
    workshop by people we know by name.</p></div><p data-main>Frost.</p><p data-main>The pond froze overnight and the ducks walked.</p><p data-main>By noon the children had found every sledge in the village, and by one the first of them had found the brook under the snow.</p>
    <footer><p>The views given here are those of the writers, who are solely responsible for them, and the paper accepts no claim that may follow from their use in any court or country.</p><p>Frost report</p></footer></body></html>""",
    """<html><body><aside><p>From the archive: forty years ago this week the old mill burned, and half the town stood on the bridge to watch the sparks go over.</p></aside><div class="cookies">Fine by me</div>
    <h2 data-main>Bees</h2><div data-main>Eleven hives.</div><div data-main>Ten of them made it through the winter, which is more than we had any right to hope for after that wet autumn.</div><p data-main>Honey in June</p>
    <form><p>Leave your name and the number of jars you would like, and we will put them aside for you until the end of the month.</p><div>Jars</div></form></body></html>""",
    """<html><body><header><p>Since its founding the Review has appeared on the first day of every month, war and flood and one printers' strike excepted.</p><h2>Review</h2></header><nav><p>Read on in the next part, where the two brothers meet again at the mouth of the river and settle the matter.</p></nav>
    <h1 data-main>On rivers</h1><p data-main>A river is a road that walks.</p><p data-main>Old maps give it three names, one for each of the peoples who had to cross it, and none of the three is kind.</p><div class="comment"><p>My father ferried people across it for thirty years, and he had a fourth name for it that I will not print here.</p></div><div class="comment">Same here</div></body></html>""",
    """<html><body><div class="site has-sidebar with-nav"><article><h1 data-main>Salt pans</h1><p data-main>The pans are flooded at the spring tide and left to the sun until the crust will bear a child.</p>
    <p data-main>Rakes are of wood.</p><p data-main>A good summer fills the barn twice.</p></article></div><footer>Salt guild</footer></body></html>""",
    """<html><body><form id="aspnetForm"><div id="menu"><a href=1>Start</a></div><article><h1 data-main>Night train</h1><p data-main>It leaves at eleven from the far platform and carries the post, two dogs and whoever missed the day.</p>
    <p data-main>Bring a coat.</p><p data-main>By morning the lake lies on the other side, and the cook has run out of eggs.</p></article></form></body></html>""",
    """<html><body><aside class="wrapper"><main><h2 data-main>Moss</h2><p data-main>Moss asks for shade and gives a floor that no carpet can equal, soft and cold and full of small lives.</p><p data-main>Leave it be.</p></main></aside><div class="share">Pass it on</div></body></html>""",
    """<html><body><header class="page"><h1 data-main>Wind</h1><p data-main>Four names are given to it in the valley, and the oldest of them is used only of the wind that brings the locusts.</p><p data-main>All of them are rude.</p></header></body></html>""",
    """<html><body><div class="story social-policy"><h1 data-main>A wage for all</h1><p data-main>The canton paid every grown person the same small sum for two years and watched what they would do with it.</p><p data-main>Most of them slept better.</p></div><div class="footer">Files</div></body></html>""",
    """<html><body><p data-main>Short news today: the bridge opens at noon and closes again at dusk.</p><section id="comments"><h3>Comments</h3><p>I crossed it as a boy when it was still the old iron one, and my brother lost his hat to the river on the very day.</p>
    <p>They promised us this bridge three times, and each time the money went to the harbour instead, so I will believe it when my own boots are on the other side.</p><p>Fine work all the same.</p></section></body></html>""",
    """<html><body><article><p data-main>The well is dry.</p><p data-main>It was dug in a wet year, and nobody asked how deep.</p></article><footer><p>Everything on these pages may be copied by hand, read aloud and learned by heart, but not printed, sold or lent for money without a letter from us first.</p><p>Our office stands open on the first morning of every month, except in harvest time, when it stands empty.</p></footer></body></html>""",
    """<p data-main>Closed today.</p>""",
    """<div data-main>Nothing but one line</div>""",
    """<html><body><h1 data-main>Errata</h1><p data-main>Page nine: read south.</p><p data-main>Page ten</p></body></html>""",
    """<html><body><div class="sidebar"><p>Write to the editors</p><p>Letters of up to three hundred words reach us by post or by hand and may be cut before they are printed in the paper.</p></div><p data-main>Rain again.</p><div data-main>Harvest put off</div><p data-main>Nobody minds except the swallows, who have nowhere dry left to argue.</p><footer>Printed locally</footer></body></html>""",
)


@cached
def trained_tree() -> Tree:
    """The tree of the labelled pages; one per worker process."""
    rows, labels = [], []
    for page in LABELLED_PAGES:
        blocks = blocks_of(page)
        rows.append(features(blocks, [block_text(b) for b in blocks]))
        labels += [b.place.wanted for b in blocks]
    return grow(np.concatenate(rows), np.array(labels))


def main_texts(pages: list[str], tree: Tree) -> list[str]:
    """Main text of each page; the blocks of all of them are judged at once."""
    per_page, rows = [], [np.zeros((0, len(FEATURES)))]
    for page in pages:
        blocks = blocks_of(page)
        texts = [block_text(b) for b in blocks]
        per_page.append(texts)
        rows.append(features(blocks, texts))
    main = iter(tree.predict(np.concatenate(rows)).tolist())
    return ["\n".join([t for t in texts if next(main)]) for texts in per_page]


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = trained_tree()
        for rows, sources in text_chunks(batches, html):
            yield pa.RecordBatch.from_arrays([rows.column("page_id"), rows.column("url"), pa.array(main_texts(sources, tree), pa.string())], names=["page_id", "url", "text"])

    narrow = pages.select("page_id", "url", html)
    out = narrow.mapInArrow(run, "page_id long, url string, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))
