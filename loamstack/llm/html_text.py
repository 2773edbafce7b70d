"""Layout-aware text of HTML pages.

A tolerant tokenizer feeds a tree builder that closes what a new tag implies (paragraphs,
list items, table cells and rows, options, the head).  The tree is walked without
recursion; what a browser would not show is left out.  Formulas (MathML) and the labels of inline
diagrams (SVG) are text like any other, and visible inputs show their value.  Blocks stand on lines of their
own, paragraphs and headings apart by an empty line, list items behind markers and
indented by depth, preformatted text as it is, table cells in aligned columns.

Defined results: null or empty html gives an empty text; unclosed and stray tags are
repaired; a null id stays null; repeated rows are rendered each; other columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import memory, store

_TAG = re.compile(
    r"<(?:!--(?:>|->|.*?(?:--!?>|\Z))|(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|[!?/][^>]*+>?)", re.DOTALL
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_BLANK = re.compile(r"[ \t\n\r\f]+")
_UNSEEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
#: Elements whose content a browser does not show (``dialog`` and ``details`` are judged by their attributes).
UNSEEN = frozenset("head script style title template noscript iframe noembed noframes datalist object audio video canvas map param".split())
#: The same in MathML and SVG; the slash of their tags closes them.
UNSEEN_FOREIGN = {"math": frozenset("annotation annotation-xml mphantom".split()), "svg": frozenset("defs desc metadata title symbol clippath mask marker pattern lineargradient radialgradient filter".split())}
#: Elements of MathML and SVG whose content is HTML again.
HTML_AGAIN = {"math": frozenset("mi mo mn ms mtext".split()), "svg": frozenset(["foreignobject"])}
#: Elements of MathML and SVG that stand apart from what is around them.
APART = frozenset("mtd mtr mfrac mroot text foreignobject".split())
#: Start tags that end MathML and SVG.
BREAKOUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
#: Types of inputs that do not show their value.
NO_VALUE = frozenset("hidden password checkbox radio file range color image".split())
HEAD_ONLY = frozenset("base link meta title style script template noscript".split())
#: Lines before and after each block element that are kept empty.
BLOCKS = dict.fromkeys("address article aside body center details dialog dir div fieldset figcaption figure footer form header hgroup html legend li main menu nav optgroup option search section summary dd dt".split(), 0)
BLOCKS |= dict.fromkeys("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table hr xmp listing".split(), 1)
#: A start tag closes these open elements, up to the nearest barrier.
IMPLIES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"td", "th", "tr", "caption", "colgroup"}, {"table"}), "td": ({"td", "th", "caption", "colgroup"}, {"table", "tr"}), "th": ({"td", "th", "caption", "colgroup"}, {"table", "tr"}),
    "tbody": ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
}
IMPLIES |= {"thead": IMPLIES["tbody"], "tfoot": IMPLIES["tbody"]}
CLOSES_P = frozenset(BLOCKS) - {"html", "body", "option", "optgroup", "legend"}
P_BARRIER = frozenset("button td th caption table object template html mi mo mn ms mtext foreignobject".split())
END_BARRIER = frozenset("table td th template".split())
#: Columns wider than this are not padded.
WIDEST = 60


class Node:
    __slots__ = ("tag", "attributes", "children", "kind", "inner")

    def __init__(self, tag: str, attributes: str = "", around: str = ""):
        self.tag, self.attributes, self.children = tag, attributes, []
        # Language of the element and of its content: "" for HTML, "math", "svg", "svg text".
        self.kind = tag if tag in ("math", "svg") else around
        self.inner = "svg text" if self.kind == "svg" and tag == "text" else self.kind
        if self.kind and tag in HTML_AGAIN[self.kind[:4].strip()]:
            self.inner = ""

    def attribute(self, name: str) -> str | None:
        """Value of an attribute; empty if it has none, None if it is not there."""
        if name not in self.attributes.lower():
            return None
        for m in _ATTRIBUTE.finditer(self.attributes):
            if m[1].lower() == name:
                return entities.unescape(m[2] or m[3] or m[4] or "")
        return None


class TreeBuilder:
    def __init__(self):
        self.root = Node("html")
        self.open = [self.root]
        self.head = None
        self.in_body = False

    def _close(self, names: set[str], barrier) -> None:
        """Close the outermost open element of ``names`` that no barrier stands above."""
        for k in range(len(self.open) - 1, 0, -1):
            tag = self.open[k].tag
            if tag in barrier:
                break
            if tag in names:
                cut = k
                while cut > 1 and self.open[cut - 1].tag in names:
                    cut -= 1
                del self.open[cut:]
                return

    def _body(self) -> None:
        if not self.in_body:
            self.in_body = True
            del self.open[1:]
            body = Node("body")
            self.root.children.append(body)
            self.open.append(body)

    def _in_template(self) -> bool:
        """Whether a template before the body is open: what it holds does not begin the body."""
        return any(node.tag == "template" for node in self.open)

    def start(self, tag: str, attributes: str) -> Node | None:
        if tag == "html":
            return None
        if tag == "head":
            if self.head is None and not self.in_body:
                self.head = Node("head")
                self.root.children.append(self.head)
                self.open.append(self.head)
            return None
        if tag == "body":
            self._body()
            self.open[1].attributes = self.open[1].attributes or attributes
            return None
        if not self.in_body and not self._in_template():
            if tag in HEAD_ONLY:
                if self.open[-1] is self.root:
                    self.start("head", "")
            else:
                self._body()
        if around := self.open[-1].inner:
            if tag not in BREAKOUT:
                node = Node(tag, attributes, around)
                self.open[-1].children.append(node)
                if not attributes.endswith("/"):
                    self.open.append(node)
                return node
            while self.open[-1].inner:
                self.open.pop()
        if tag in CLOSES_P:
            self._close({"p"}, P_BARRIER)
        if tag in IMPLIES:
            self._close(*IMPLIES[tag])
        if tag in ("td", "th") and self.open[-1].tag in ("table", "tbody", "thead", "tfoot"):
            self.start("tr", "")
        node = Node(tag, attributes)
        self.open[-1].children.append(node)
        if node.kind and attributes.endswith("/"):
            return node
        if tag not in VOID and not attributes.endswith("/") or tag in RAW:
            if tag not in VOID:
                self.open.append(node)
        elif tag not in VOID:  # a slash does not close an element of HTML
            self.open.append(node)
        return node

    def end(self, tag: str) -> None:
        if tag in ("html", "body"):
            return
        if tag == "head":
            if not self.in_body:
                del self.open[1:]
            return
        if tag == "br":
            self.start("br", "")
            return
        floor = 2 if self.in_body else 1
        for k in range(len(self.open) - 1, floor - 1, -1):
            name = self.open[k].tag
            if name == tag:
                del self.open[k:]
                return
            if name in END_BARRIER and tag not in ("table", "tr", "tbody", "thead", "tfoot", "td", "th"):
                break
        if tag == "p":
            self.start("p", "")
            self.open.pop()

    def text(self, data: str) -> None:
        if not self.in_body:
            if not data.strip():
                return
            if self.open[-1].tag not in RAW and not self._in_template():
                self._body()
        inner = self.open[-1].inner
        if inner == "svg" or inner == "math" and data.isspace():
            return
        self.open[-1].children.append(data)


def parse(page: str) -> Node:
    builder, at = TreeBuilder(), 0
    while True:
        tag = _TAG.search(page, at)
        data = page[at : tag.start()] if tag else page[at:]
        if data:
            builder.text(entities.unescape(data) if "&" in data else data)
        if not tag:
            return builder.root
        at = tag.end()
        if not tag[2]:
            continue
        name = tag[2].lower()
        if tag[1]:
            builder.end(name)
            continue
        builder.start(name, tag[3])
        if name in RAW and builder.open[-1].tag == name:
            stop = re.compile(rf"</{name}(?=[\s/>])[^>]*>?|\Z", re.I).search(page, at)
            content = page[at : stop.start()]
            if content and name in ("textarea", "title", "xmp"):
                builder.open[-1].children.append(entities.unescape(content) if name != "xmp" else content)
            builder.open.pop()
            at = stop.end()


def shown(node: Node) -> bool:
    if node.tag in UNSEEN or node.kind and node.tag in UNSEEN_FOREIGN[node.kind[:4].strip()]:
        return False
    if not node.attributes or node.attributes.isspace():
        return node.tag != "dialog"
    low = node.attributes.lower()
    if "hidden" in low and (h := node.attribute("hidden")) is not None and h.lower() != "until-found":
        return False
    if "style" in low and _UNSEEN_STYLE.search(node.attribute("style") or ""):
        return False
    if node.kind.startswith("svg") and (node.attribute("display") == "none" or node.attribute("visibility") in ("hidden", "collapse")):
        return False
    if node.tag == "dialog":
        return node.attribute("open") is not None
    return not (node.tag == "input" and (node.attribute("type") or "").lower() == "hidden")


class Flow:
    """Lines of a block formatting context."""

    def __init__(self):
        self.lines, self.inline, self.gap, self.indent, self.marker = [], [], 0, 0, ""

    def flush(self) -> None:
        if not self.inline:
            return
        for part in "".join(self.inline).split("\x00"):
            line = _BLANK.sub(" ", part).strip(" ")
            if line:
                self.line(line)
        self.inline = []

    def line(self, text: str) -> None:
        if self.lines and self.gap:
            self.lines += [""] * self.gap
        self.gap = 0
        self.lines.append(" " * (max(self.indent - 2, 0) if self.marker else self.indent) + self.marker + text)
        self.marker = ""

    def edge(self, gap: int) -> None:
        self.flush()
        self.gap = max(self.gap, gap)


class Table:
    def __init__(self):
        self.rows: list[list[tuple[list[str], int, int]]] = []

    def grid(self) -> list[str]:
        """Lines of the rows, with cells in columns; spans take up the columns and rows that they cover."""
        taken: dict[int, int] = {}
        placed, widths = [], {}
        for row in self.rows:
            at, cells = 0, []
            covered, taken = taken, {c: n - 1 for c, n in taken.items() if n > 1}
            for lines, wide, tall in row:
                while at in covered:
                    at += 1
                cells.append((at, wide, lines))
                if wide == 1:
                    widths[at] = max(widths.get(at, 0), *map(len, lines), 0) if lines else widths.get(at, 0)
                if tall > 1:
                    taken |= {c: tall - 1 for c in range(at, at + wide)}
                at += wide
            placed.append(cells)
        # A column in which no cell begins takes no room.
        starts, x = {}, 0
        for c in sorted({at for cells in placed for at, _, _ in cells}):
            starts[c] = x
            x += min(widths.get(c, 0), WIDEST) + 2
        out = []
        for cells in placed:
            for k in range(max((len(lines) for _, _, lines in cells), default=0)):
                line = ""
                for at, _, lines in cells:
                    if k < len(lines) and lines[k]:
                        line = line.ljust(starts[at]) if len(line) <= starts[at] else line + "  "
                        line += lines[k]
                out.append(line.rstrip())
        return out


#: The most columns and rows that a cell covers, by the HTML standard.
MOST_COLUMNS, MOST_ROWS = 1000, 65534
_NUMBER = re.compile(r"[ \t\n\r\f]*\+?([0-9]+)")


def _span(value: str | None, most: int, zero: int) -> int:
    """A span as the standard reads it: the number at the start, 1 if there is none; ``zero`` for none of them."""
    found = _NUMBER.match(value or "")
    if not found:
        return 1
    digits = found[1].lstrip("0")
    return zero if not digits else min(int(digits[:6]), most)


def render(root: Node) -> str:
    flows, tables, lists, pre = [Flow()], [], [], 0
    work: list[tuple[Node | str, bool]] = [(root, False)]
    while work:
        node, leaving = work.pop()
        flow = flows[-1]
        if isinstance(node, str):
            if pre:
                for k, line in enumerate(node.split("\n")):
                    if k:
                        flow.lines.append("".join(flow.inline))
                        flow.inline = []
                    if line:
                        if not flow.inline and flow.gap and flow.lines:
                            flow.lines += [""] * flow.gap
                        flow.gap = 0
                        flow.inline.append(line)
            else:
                flow.inline.append(node)
            continue
        tag = node.tag
        if leaving:
            if tag in ("td", "th", "caption") and len(flows) > 1 and tables:
                flow.flush()
                flows.pop()
                if tag == "caption":
                    flows[-1].edge(1)
                    for line in flow.lines:
                        flows[-1].line(line)
                else:
                    tables[-1].rows = tables[-1].rows or [[]]
                    tables[-1].rows[-1].append((flow.lines, _span(node.attribute("colspan"), MOST_COLUMNS, 1), _span(node.attribute("rowspan"), MOST_ROWS, MOST_ROWS)))
                continue
            if tag == "table" and tables:
                flow.flush()
                for line in tables.pop().grid():
                    flow.line(line)
                flow.edge(1)
                continue
            if tag in ("pre", "listing", "xmp"):
                pre -= 1
                if flow.inline:
                    flow.lines.append("".join(flow.inline))
                    flow.inline = []
                while flow.lines and not flow.lines[-1]:
                    flow.lines.pop()
            if tag in BLOCKS:
                flow.edge(0 if tag in ("ul", "ol") and len(lists) > 1 else BLOCKS[tag])
            if tag in ("ul", "ol", "menu", "dir"):
                lists.pop()
            elif tag == "li":
                flow.indent -= 2
                flow.marker = ""
            elif tag in ("dd", "blockquote"):
                flow.indent -= 2
            continue
        if not shown(node):
            continue
        if node.kind:
            apart = [" "] if tag in APART else []
            flow.inline += apart
            parts = [x for c in node.children for x in (c, " ")] if tag in ("mfrac", "mroot") else [*node.children, *apart]
            work += [(c, False) for c in reversed(parts)]
            continue
        if tag == "br":
            flow.inline.append("\n" if pre else "\x00")
            continue
        if tag == "hr":
            flow.edge(0)
            flow.line("---")
            continue
        if tag in VOID:
            if tag == "input" and (node.attribute("type") or "text").strip().lower() not in NO_VALUE and node.attribute("value"):
                flow.inline.append(f" {node.attribute('value')} ")
            elif tag == "wbr":
                pass
            continue
        if tag in ("td", "th", "caption") and tables:
            flows.append(Flow())
        elif tag == "tr" and tables:
            tables[-1].rows.append([])
        elif tag == "table":
            flow.edge(1)
            tables.append(Table())
        elif tag in BLOCKS:
            flow.edge(0 if tag in ("ul", "ol") and lists else BLOCKS[tag])
        if tag in ("ul", "ol", "menu", "dir"):
            first = node.attribute("start") if tag == "ol" else None
            lists.append([tag, int(first) if first and re.fullmatch(r"-?\d{1,9}", first.strip()) else 1])
        elif tag == "li":
            if lists and lists[-1][0] == "ol":
                flow.marker, lists[-1][1] = f"{lists[-1][1]}. ", lists[-1][1] + 1
            else:
                flow.marker = "- "
            flow.indent += 2
        elif tag in ("dd", "blockquote"):
            flow.indent += 2
        elif tag in ("pre", "listing", "xmp"):
            pre += 1
        work.append((node, True))
        work += [(c, False) for c in reversed(node.children)]
    flow = flows[0]
    flow.flush()
    return "\n".join(line.rstrip() for line in flow.lines).strip("\n").replace("\x00", "")


def extract(page: str | None) -> str:
    return render(parse(page.replace("\x00", ""))) if page else ""


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    memory.begin("html_text")
    for rows in batches:
        yield pd.DataFrame({"page_id": rows["page_id"], "url": rows["url"], "text": [extract(h) if isinstance(h, str) else "" for h in rows["html"]]})


def page_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of each page."""
    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInPandas(_extract, "page_id long, url string, text string")


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = page_text(store.table(spark, sf_dir, "pages"))
    lines = F.split("text", "\n")
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), F.size(F.filter(lines, lambda x: x != "")).cast("long").alias("n_lines"), F.size(F.filter(lines, lambda x: F.ltrim(x).startswith("- "))).cast("long").alias("n_items"))
