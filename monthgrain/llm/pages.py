"""Main text of web pages: paragraphs score their containers, the best one and its siblings stay.

A page becomes a tree. Menus, headers, footers, sidebars, notices, adverts, forms, scripts and
reader comments are cut by tag, role or name. Every paragraph that is left has points for its
length and its commas, less its share of link text; its container gets all of them, each further
ancestor half of what the one below it has. The container of most points, again less its share
of link text, is the main one. An ``article`` or ``main`` around it is taken whole, and siblings
that look alike are kept.

All steps are linear in the page: a pass of the parser, a pass over the nodes from the last to
the first, a pass over the texts. Nesting beyond ``DEEPEST`` is flattened as browsers do it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# HTML elements by what they do to the text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
PARAGRAPHS = frozenset(
    "p pre h1 h2 h3 h4 h5 h6 li dt dd td th caption figcaption summary address".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset(
    "area base br col embed frame hr img input link meta param source track wbr".split()
)
IN_HEAD = frozenset("base link meta noscript script style template title".split())
#: Elements never part of a text.
CUT = frozenset(
    "aside audio button canvas datalist dialog footer form head header iframe input label "
    "menu nav noscript object option script search select style svg template textarea title "
    "video".split()
)
#: Of these, those that unclosed or wrapping markup puts around whole articles.
AROUND = frozenset(("form", "header"))
#: An element of the key ends an open one of the value, unless a list or table is between.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("table", "tr")),
    "th": (("td", "th"), ("table", "tr")),
    "tbody": (("tbody", "thead", "tfoot", "tr", "td", "th"), ("table",)),
    "option": (("option",), ("select",)),
}
# Words of classes, ids and roles that tell what is not the main text.
NAMES = frozenset(
    "ad ads adslot adsense advert adverts advertisement advertising alert alertdialog banner "
    "breadcrumb breadcrumbs complementary consent contentinfo cookie cookies dialog footer gdpr "
    "header login masthead menu modal nav navbar navigation newsletter notice notices overlay pager "
    "pagination popup promo promotion related search share sharing sidebar signup social sponsor "
    "sponsored subscribe subscription toolbar topbar widget".split()
)
COMMENTS = frozenset("comment comments commentlist disqus replies reply respond".split())

#: Deepest nesting, share of the best score that a sibling needs, most link text of a part.
DEEPEST, ALIKE, LINKS = 512, 0.2, 0.5
#: A list of at least so many entries that is link text by this share is a menu.
MENU = (3, 0.9)

#: Elements whose content is text up to their own end tag.
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
_TAG = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*)|[!?/])")
_GAP, _NAME = re.compile(r"[\s/]*"), re.compile(r"[^\s/>][^\s/>=]*")
_EQUALS, _BARE = re.compile(r"\s*=\s*"), re.compile(r"[^\s>]*")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
_COMMA = re.compile("[,،、，]")
_SENTENCE = re.compile(r"""[.!?…。！？:]["'”’»)]*$""")


class Node:
    __slots__ = (
        "tag", "parent", "block", "is_block", "cut", "loose", "chars", "linked", "commas",
        "score", "entries", "in_link", "depth",
    )

    def __init__(self, tag: str, parent: Node | None):
        self.tag, self.parent = tag, parent
        self.is_block = tag in BLOCKS
        self.block: Node = self if self.is_block or parent is None else parent.block
        self.cut = self.loose = False  # cut; and whether an article inside revokes that
        self.in_link = tag == "a" or (parent is not None and parent.in_link)
        self.depth = 0 if parent is None else parent.depth + 1
        self.chars = self.linked = self.commas = self.entries = 0
        self.score = 0.0

    def up(self) -> Iterator[Node]:
        node: Node | None = self
        while node is not None:
            yield node
            node = node.parent

    @property
    def density(self) -> float:
        return self.linked / self.chars if self.chars else 0.0


def _names(attributes: dict[str, str]) -> set[str]:
    """Words of class, id and role."""
    given = " ".join(attributes.get(a, "") for a in ("class", "id", "role"))
    return {w.lower() for w in _WORDS.findall(given)} if given.strip() else set()


def _attributes(html: str, at: int) -> tuple[dict[str, str], bool, int]:
    """Attributes from ``at`` to the end of the tag, whether it closes itself, and where it ends."""
    found: dict[str, str] = {}
    while True:
        at = _GAP.match(html, at).end()
        if at >= len(html):
            return found, False, at
        if html[at] == ">":
            return found, html[at - 1] == "/", at + 1
        name = _NAME.match(html, at)
        at, value = name.end(), ""
        equals = _EQUALS.match(html, at)
        if equals:
            at = equals.end()
            quote = html[at : at + 1]
            if quote in ("'", '"') and quote:
                end = html.find(quote, at + 1)
                end = len(html) if end < 0 else end
                value, at = html[at + 1 : end], end + 1
            else:
                value = _BARE.match(html, at).group()
                at += len(value)
        found.setdefault(name.group().lower(), unescape(value))


def _until(html: str, mark: str, at: int) -> int:
    end = html.find(mark, at)
    return len(html) if end < 0 else end + len(mark)


class Page:
    """The nodes of a page in order, and its texts in order, with None where a block begins or ends.

    Broken markup is read as browsers do: what is not closed goes on to the end of the page.
    """

    def __init__(self, html: str):
        self.root = Node("html", None)
        self.nodes = [self.root]
        self.texts: list[tuple[Node, str] | None] = []
        self.stack = [self.root]
        self.open: Counter[str] = Counter(("html",))
        self.paragraph = -1  # place of the open p
        self._read(html)

    def _read(self, html: str) -> None:
        at = 0
        while at < len(html):
            tag = _TAG.match(html, at)
            if tag is None:  # a text, which a lone angle may begin
                end = html.find("<", at + 1)
                end = len(html) if end < 0 else end
                self.handle_data(unescape(html[at:end]))
                at = end
            elif tag.group(2):
                name = tag.group(2).lower()
                attributes, closed, at = _attributes(html, tag.end())
                if tag.group(1):
                    self.handle_endtag(name)
                elif name in RAW:
                    end = re.compile(f"</{name}(?=[\\s/>])", re.I).search(html, at)
                    start, at = at, end.start() if end else len(html)
                    self.handle_starttag(name, attributes)
                    self.handle_data(html[start:at])
                else:
                    self.handle_starttag(name, attributes)
                    # browsers ignore the slash of blocks
                    if closed and name not in BLOCKS and name not in VOID:
                        self.handle_endtag(name)
            elif html.startswith("<!--", at):
                at = _until(html, "-->", at + 2)
            else:
                at = _until(html, ">", at)

    def _pop_to(self, place: int) -> None:
        for node in self.stack[place:]:
            self.open[node.tag] -= 1
            if node.is_block:
                self.texts.append(None)
        del self.stack[place:]
        if self.paragraph >= place:
            self.paragraph = -1

    def _place(self, tags: tuple[str, ...], within: tuple[str, ...]) -> int:
        """The outermost open element of ``tags`` above the last one of ``within``, or -1."""
        found = -1
        if any(self.open[t] for t in tags):
            for k in range(len(self.stack) - 1, 0, -1):
                if self.stack[k].tag in within:
                    break
                if self.stack[k].tag in tags:
                    found = k
        return found

    def handle_starttag(self, tag: str, attributes: dict[str, str]) -> None:
        if tag == "html" or (tag == "body" and self.open["body"]):
            return
        if self.open["head"] and tag not in IN_HEAD:
            self._pop_to(self._place(("head",), ()))
        if self.paragraph > 0 and tag in BLOCKS:
            self._pop_to(self.paragraph)
        if tag in ENDS:
            place = self._place(*ENDS[tag])
            if place > 0:
                self._pop_to(place)
        if tag == "br" or tag == "wbr":
            self.texts.append((self.stack[-1], " " if tag == "br" else ""))
            return
        if tag == "hr":
            self.texts.append(None)
        if tag in VOID:
            return
        node = Node(tag, self.stack[-1])
        self._judge(node, attributes)
        self.nodes.append(node)
        if node.is_block:
            self.texts.append(None)
        if node.depth < DEEPEST:
            if tag == "p":
                self.paragraph = len(self.stack)
            self.stack.append(node)
            self.open[tag] += 1

    def _judge(self, node: Node, attributes: dict[str, str]) -> None:
        """Marks what is cut; an article takes back cuts by name around it."""
        tag, names = node.tag, _names(attributes)
        hidden = (
            "hidden" in attributes
            or attributes.get("aria-hidden") == "true"
            or _HIDDEN.search(attributes.get("style", "").lower()) is not None
        )
        if tag in ("article", "main"):
            node.cut = bool(names & COMMENTS) or hidden
            if not node.cut:
                for above in node.up():
                    if above.loose:
                        above.cut = above.loose = False
        elif tag != "body":
            named = bool(names & NAMES or names & COMMENTS)
            node.cut = tag in CUT or named or hidden
            node.loose = node.cut and not hidden and (tag in AROUND or tag not in CUT)

    def handle_endtag(self, tag: str) -> None:
        if tag == "p" and self.paragraph < 0:
            self.texts.append(None)
        if tag in ("html", "body") or not self.open[tag]:
            return
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag == tag:
                return self._pop_to(k)
            if tag not in BLOCKS and tag not in CUT and self.stack[k].is_block:
                return None  # an inline element does not end the block it began outside of

    def handle_data(self, data: str) -> None:
        top = self.stack[-1]
        if top.tag == "head" and data.strip():
            self._pop_to(len(self.stack) - 1)
            top = self.stack[-1]
        self.texts.append((top, data))


def _scored(page: Page) -> None:
    """Cuts passed down, sums and scores passed up."""
    for node in page.nodes:
        node.cut = node.cut or (node.parent is not None and node.parent.cut)
    own: dict[Node, list[int]] = {}  # of blocks alone: characters, linked ones, commas
    for item in page.texts:
        if item is None or item[0].cut:
            continue
        node, chars = item[0], sum(map(len, item[1].split()))
        if chars:
            sums = own.setdefault(node.block, [0, 0, 0])
            sums[0] += chars
            sums[1] += chars if node.in_link else 0
            sums[2] += len(_COMMA.findall(item[1]))
    for node in reversed(page.nodes):
        if node in own and not node.cut:
            chars, linked, commas = own[node]
            points = (1 + commas + chars / 100) * (1 - linked / chars)
            inside = node.tag in PARAGRAPHS and node.parent is not None
            (node.parent.block if inside else node).score += points
            node.chars, node.linked = node.chars + chars, node.linked + linked
        if node.is_block and node.parent is not None and not node.cut:
            above = node.parent.block
            above.chars, above.linked = above.chars + node.chars, above.linked + node.linked
            above.score += node.score / 2
            above.entries += node.tag == "li"


def _main(page: Page) -> set[Node]:
    """The best container, or the article around it, and the siblings that belong to it."""
    _scored(page)
    containers = [n for n in page.nodes if n.block is n and not n.cut and n.score > 0]
    if not containers:
        return set()
    best = max(containers, key=lambda n: n.score * (1 - n.density))
    around = [n for n in best.up() if n.tag in ("article", "main")]
    top = next((n for n in around if n.tag == "article"), around[0] if around else best)
    least = ALIKE * top.score * (1 - top.density)

    def alike(node: Node) -> bool:
        if node.cut or node.parent is not top.parent or not node.chars:
            return False
        if around:
            return node.tag == top.tag and node.score * (1 - node.density) >= least
        if node.tag in HEADINGS:
            return node.density < LINKS
        return node.density < LINKS and node.score * (1 - node.density) >= least

    kept = {top}
    if top.parent is not None and top.tag not in ("main", "body"):
        kept |= {n for n in page.nodes if n.is_block and alike(n)}
        if not around:
            kept |= _sentences(page, top)
    return kept


def _sentences(page: Page, top: Node) -> set[Node]:
    """Paragraphs beside the best container that end like a sentence."""
    texts: dict[Node, str] = {}
    for item in page.texts:
        if item is not None:
            block = item[0].block
            if block.parent is top.parent and block.tag in PARAGRAPHS and not item[0].cut:
                texts[block] = texts.get(block, "") + item[1]
    return {n for n, t in texts.items() if n.density < LINKS and _SENTENCE.search(t.rstrip())}


def main_text(html: str) -> str:
    """The main text of a page, a line per block; white space inside a block is one space."""
    page = Page(html)
    kept = _main(page)
    if not kept:
        return ""
    in_article = any(n.tag in ("article", "main") for n in kept)
    inside: set[Node] = set()
    for node in page.nodes:  # parents come first
        if node in kept:
            inside.add(node)
        elif node.parent in inside and not node.cut:
            menu = node.tag in ("ul", "ol", "div") and node.entries >= MENU[0]
            if menu and node.density >= MENU[1]:
                continue
            if not in_article and node.is_block and node.tag not in PARAGRAPHS:
                if node.chars and node.density > LINKS:
                    continue
            inside.add(node)
    blocks: list[list[str]] = [[]]
    for item in page.texts:
        if item is None:
            if blocks[-1]:
                blocks.append([])
        elif item[0] in inside:
            blocks[-1].append(item[1])
    lines = (" ".join("".join(b).split()) for b in blocks)
    return "\n".join(line for line in lines if line)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with ``text``, its main text, and ``n_chars``, the code points of that.

    The html itself goes; other columns pass through, those named like the results are
    replaced. Null and empty pages, and pages without any text, have the empty text. Each
    page is worked on alone, so repeated rows give repeated rows, and memory is a page's.
    """
    made = ("text", "n_chars")
    others = [c for c in pages.columns if c.lower() not in made and c != html_col]
    html = F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias("_html")
    given = pages.select(*[F.col(f"`{c}`") for c in others], html)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(k, 256) for k in range(0, whole.num_rows, 256)):
                texts = [main_text(h.as_py()) for h in batch.column(len(others))]
                columns = [
                    *batch.columns[:-1],
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[*others, *made])

    kinds = T.StructType(given.schema.fields[:-1]).add("text", "string").add("n_chars", "long")
    return given.mapInArrow(run, kinds)
