"""Main text of HTML pages by tree scoring.

A page is read into a tree with the rules of HTML for omitted and stray tags, raw text, comments and character
references. Subtrees that are no part of an article by their element, role or class (menus, page headers, footers,
sidebars, notices, adverts, forms, scripts, styles, reader comments) are left out. Each paragraph earns points for its
length and its commas, less the share of its letters that are links, and passes them on: to its container in full, to
each container above at half of the one below. Containers get or lose points for what their element and class say, and
are discounted by their own share of links. The best one is kept, or the article element it lies in, with those of its
siblings that score well enough beside it or are paragraphs or headings. Inside, lists and boxes that are mostly links go.

Pages are independent rows: Spark deals them out, and each task reads one page at a time. The work is linear in a page's
length, and nothing of a page is cut off.

Defined cases: a null or empty page, and one without text, gives an empty text; an unclosed comment, script or style runs
to the page's end, as in browsers, and an unclosed tag there is dropped; a line break element is white space inside its
block; a hidden element is left out; repeated rows stay; an empty table gives none; other columns stay as they are, but
for those whose names, in any case, are those of the results.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelspark.llm.arrow_text import passes
from reelspark.llm.store import task_session

# Elements of HTML by how they are read.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes noscript title textarea plaintext".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = HEADINGS | frozenset("p pre li dt dd td th blockquote figcaption caption address summary".split())
BLOCKS = PARAGRAPHS | frozenset(
    "html body head div section article main aside header footer nav form fieldset ul ol dl menu table thead tbody tfoot tr figure details dialog center hgroup hr search template select option optgroup button legend".split()
)
ENDS_PARAGRAPH = BLOCKS - frozenset("html body head td th tr thead tbody tfoot caption button template select option optgroup legend".split())
IN_HEAD = frozenset("title meta link base script style noscript template".split())
#: For an element that ends an earlier one of its kind: which ones it ends, and where the search for them stops.
ENDS_OWN = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "caption"}, {"table", "thead", "tbody", "tfoot"}),
    "thead": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
#: A stray end tag does not close elements beyond these.
SCOPES = frozenset("td th caption table button template object".split())

# What is no part of an article.
LEFT_OUT = frozenset("head nav footer aside form dialog button select template svg math canvas object audio video map menu search datalist".split())
LEFT_OUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar tooltip form".split())
LEFT_OUT_WORDS = frozenset(
    "ad ads adsense advert adverts advertisement advertising sponsor sponsored sponsors promo promotion banner cookie cookies consent gdpr notice notices notification alert popup modal overlay lightbox paywall "
    "nav navbar navigation menu menus submenu breadcrumb breadcrumbs pagination pager toolbar skip masthead footer sidebar sidebars rail widget widgets aside related recommended recommendations trending "
    "share sharing social newsletter subscribe subscription signup login outbrain taboola".split()
)
READER_WORDS = frozenset("comment comments commentlist commentform disqus respond reply replies discussion responses guestbook".split())
GOOD_WORDS = frozenset("article body content entry hentry main page post story text blog".split())
MAIN_ROLES = frozenset(["main", "article"])

_TAG = re.compile(r"<(?:!--(?:-?>|.*?(?:--!?>|\Z))|[!?][^>]*+>|(/?)([a-zA-Z][^\s/>]*+)((?:=\s*+(?:\"[^\"]*+\"|'[^']*+')|[^>])*+)>|/[^a-zA-Z>][^>]*+>|/>)", re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_COMMENT_END = re.compile(r"(?:--!?>|^<!--?->|^<!-->)\Z")
_UNCLOSED = re.compile(r"<[a-zA-Z/!?]")
_COMMAS = re.compile("[,،、，﹐﹑︐︑]")

#: Points of a paragraph: for being one of so many letters, for every comma, for each 100 letters up to so many.
PARAGRAPH_LETTERS, LONG_POINTS = 25, 3.0
#: What a container's element or class adds or takes.
WEIGHT = 25.0
#: Part of the points that goes on to the next container above.
PASSED_ON = 0.5
#: A sibling of the best container stays from this share of its score, with at most this share of links.
SIBLING_SCORE, SIBLING_LINKS = 0.2, 0.25
#: A list or box inside the article goes from this share of links, if it holds two links or more.
MENU_LINKS = 0.6
_BOXES = frozenset("ul ol dl div section table p".split())


@dataclass
class Node:
    name: str
    parent: int
    attributes: dict[str, str]
    words: frozenset[str]
    out: bool = False
    points: float = 0.0
    letters: int = 0
    linked: int = 0
    links: int = 0


@dataclass
class Block:
    """Text between the edges of block elements, with the innermost of them and, for each run, its own element."""

    node: int
    runs: list[tuple[int, bool, str]] = field(default_factory=list)


class Page:
    """The tree of a page: nodes in page order (a parent before its children), and the text in blocks."""

    def __init__(self, source: str):
        self.nodes = [Node("", -1, {}, frozenset())]
        self.blocks = [Block(0)]
        self._stack, self._block_stack = [0], [0]
        self._count: dict[str, int] = {}
        self._read(source)

    # reading

    def _read(self, source: str) -> None:
        at, end = 0, source.rfind(">") + 1
        while at < end:
            tag = _TAG.search(source, at, end)
            if tag is None:
                break
            self._text(source[at : tag.start()])
            at = tag.end()
            if tag[2] is None:
                if tag[0].startswith("<!--") and not _COMMENT_END.search(tag[0]):
                    at = len(source)
                continue
            name = tag[2].lower()
            if tag[1]:
                self._close(name)
            elif name in RAW:
                self._open(name, tag[3])
                self._pop(len(self._stack) - 1)
                stop = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(source, at)
                at = stop.start() if stop and name != "plaintext" else len(source)
            else:
                self._open(name, tag[3])
        if at < len(source):
            unclosed = _UNCLOSED.search(source, max(at, end))
            self._text(source[at : unclosed.start() if unclosed else len(source)])

    def _text(self, text: str) -> None:
        if not text:
            return
        if self._count.get("head") and text.strip():
            self._end("head", frozenset())
        self.blocks[-1].runs.append((self._stack[-1], bool(self._count.get("a")), text))

    def _break(self) -> None:
        if self.blocks[-1].runs:
            self.blocks.append(Block(self._block_stack[-1]))
        else:
            self.blocks[-1].node = self._block_stack[-1]

    def _push(self, name: str, attributes: str) -> None:
        found = {}
        for m in _ATTRIBUTE.finditer(attributes) if attributes.strip(" /") else ():
            found.setdefault(m[1].lower(), entities.unescape(m[2] or m[3] or m[4] or ""))
        words = frozenset(w.lower() for w in _NAME_PART.findall(found.get("class", "") + " " + found.get("id", "")))
        self.nodes.append(Node(name, self._stack[-1], found, words))
        if name in VOID:
            return
        self._stack.append(len(self.nodes) - 1)
        self._count[name] = self._count.get(name, 0) + 1
        if name in BLOCKS:
            self._block_stack.append(len(self.nodes) - 1)
            self._break()

    def _pop(self, size: int) -> None:
        """Closes the innermost elements until ``size`` are open."""
        broken = False
        while len(self._stack) > size:
            node = self._stack.pop()
            self._count[self.nodes[node].name] -= 1
            if self._block_stack[-1] == node:
                self._block_stack.pop()
                broken = True
        if broken:
            self._break()

    def _end(self, names: str | set[str], stops: frozenset[str] | set[str], inline: bool = False) -> bool:
        """Closes the innermost open element of these names and what is open inside, unless one of ``stops`` is nearer."""
        names = {names} if isinstance(names, str) else names
        if not any(self._count.get(n) for n in names):
            return False
        for place in range(len(self._stack) - 1, 0, -1):
            name = self.nodes[self._stack[place]].name
            if name in names:
                self._pop(place)
                return True
            if name in stops or (inline and name in BLOCKS):
                return False
        return False

    def _open(self, name: str, attributes: str) -> None:
        if name in ("html", "body") and self._count.get(name):
            return
        if self._count.get("head") and name not in IN_HEAD:
            self._end("head", frozenset())
        if name in ENDS_PARAGRAPH:
            self._end("p", SCOPES)
        if name in HEADINGS and self.nodes[self._stack[-1]].name in HEADINGS:
            self._pop(len(self._stack) - 1)
        if name in ENDS_OWN:
            own, stops = ENDS_OWN[name]
            self._end(own, stops | {"table"})
        if name == "a":
            self._end("a", frozenset(), inline=True)
        if name == "br":
            self._text(" ")
        elif name == "hr":
            self._break()
        else:
            self._push(name, attributes)

    def _close(self, name: str) -> None:
        if name == "br":
            self._text(" ")
        elif name in HEADINGS:
            self._end(set(HEADINGS), SCOPES)
        elif name in BLOCKS:
            if name not in ("html", "body") and not self._end(name, SCOPES - {name}):
                self._break()
        else:
            self._end(name, frozenset(), inline=True)

    # scoring

    def _leave_out(self) -> None:
        """Marks what is no part of an article: a page's own headers, but not those inside an article."""
        nodes = self.nodes
        central = [n.name in ("article", "main") or n.attributes.get("role") in MAIN_ROLES for n in nodes]
        holds = [c or n.name == "h1" for c, n in zip(central, nodes, strict=True)]
        within = list(central)
        for k in range(len(nodes) - 1, 0, -1):
            holds[nodes[k].parent] |= holds[k]
        for k in range(1, len(nodes)):
            n = nodes[k]
            within[k] |= within[n.parent]
            hidden = "hidden" in n.attributes or n.attributes.get("aria-hidden") == "true" or "display:none" in n.attributes.get("style", "").replace(" ", "").lower()
            header = (n.name == "header" or n.attributes.get("role") == "banner" or "header" in n.words) and not within[k] and n.name not in ("html", "body")
            named = n.name not in ("html", "body", "article", "main") and (bool(n.words & READER_WORDS) or (bool(n.words & LEFT_OUT_WORDS) and not holds[k]))
            n.out = nodes[n.parent].out or n.name in LEFT_OUT or n.name in RAW or n.attributes.get("role") in LEFT_OUT_ROLES - {"banner"} or hidden or header or named

    def _score(self) -> list[float]:
        nodes = self.nodes
        for block in self.blocks:
            node = nodes[block.node]
            runs = [(n, link, " ".join(text.split())) for n, link, text in block.runs if not nodes[n].out]
            letters = sum(len(t) for _, _, t in runs)
            if not letters:
                continue
            linked = sum(len(t) for _, link, t in runs if link)
            node.letters += letters
            node.linked += linked
            if node.name in HEADINGS:
                continue
            commas = sum(len(_COMMAS.findall(t)) for _, _, t in runs)
            points = (float(letters >= PARAGRAPH_LETTERS) + commas + min(letters / 100, LONG_POINTS)) * (1 - linked / letters)
            nodes[node.parent if node.name in PARAGRAPHS else block.node].points += points
        for k in range(len(nodes) - 1, 0, -1):
            n, above = nodes[k], nodes[nodes[k].parent]
            if n.out:
                continue
            n.links += n.name == "a"
            above.points += PASSED_ON * n.points
            above.letters += n.letters
            above.linked += n.linked
            above.links += n.links
        return [self._final(n) for n in nodes]

    def _final(self, n: Node) -> float:
        if n.out or not n.letters or n.name in PARAGRAPHS or (n.name not in BLOCKS and n.name):
            return 0.0
        weight = WEIGHT * (n.name in ("article", "main") or n.attributes.get("role") in MAIN_ROLES or n.attributes.get("itemprop") == "articleBody")
        if n.name not in ("", "html", "body"):
            weight += WEIGHT * bool(n.words & GOOD_WORDS) - WEIGHT * bool(n.words & (LEFT_OUT_WORDS | READER_WORDS))
        return (n.points + weight) * (1 - n.linked / n.letters)

    def _kept(self, scores: list[float]) -> list[bool]:
        """Whether each node is in the best container, its article, or a sibling that goes with it."""
        nodes = self.nodes
        best = max(range(len(nodes)), key=scores.__getitem__)
        if scores[best] <= 0:
            best = 0
        above = best
        while above > 0:
            if nodes[above].name == "article" or nodes[above].attributes.get("itemprop") == "articleBody":
                best = above
            above = nodes[above].parent
        share = lambda n: n.linked / n.letters if n.letters else 0.0
        kept = [False] * len(nodes)
        kept[best] = True
        for k in range(1, len(nodes)):
            n = nodes[k]
            if n.out:
                continue
            if n.parent == nodes[best].parent and k != best and n.letters:
                if n.name in PARAGRAPHS:  # an article element has its own paragraphs and headings inside
                    fits = nodes[best].name != "article" and (n.name in HEADINGS or n.letters >= PARAGRAPH_LETTERS)
                else:
                    fits = n.name in BLOCKS and n.points > 0 and n.points >= SIBLING_SCORE * nodes[best].points
                kept[k] = fits and share(n) <= SIBLING_LINKS
            else:
                kept[k] |= kept[n.parent] and not (n.name in _BOXES and n.links >= 2 and share(n) >= MENU_LINKS)
        return kept

    def main_text(self) -> str:
        self._leave_out()
        kept = self._kept(self._score())
        out = []
        for block in self.blocks:
            whole = "".join(text for node, _, text in block.runs if kept[node] and not self.nodes[node].out)
            if whole := " ".join(entities.unescape(whole).split()):
                out.append(whole)
        return "\n".join(out)


def main_text(source: str | None) -> str:
    """The article of one page: a line for each block."""
    return Page(source).main_text() if source else ""


def extract(pages: DataFrame, html: str = "html", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """All rows and columns of ``pages`` with the article's text and its number of code points."""
    task_session(pages.sparkSession)
    own = pages.drop(*(c for c in pages.columns if c.lower() in {text.lower(), n_chars.lower()}))
    schema = T.StructType([*own.schema.fields, T.StructField(text, T.StringType()), T.StructField(n_chars, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(batches, html):
            found = [main_text(page.as_py()) for page in batch.column(html)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())], names=schema.names)

    return own.mapInArrow(run, schema)


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: the main text of every page of ``pages``."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", F.col("html"))
    return extract(pages).select("page_id", "url", "text", "n_chars")
