"""Visible text of web pages, laid out: a tree with implied tags, visibility rules, and block, list and table rendering."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctua.llm.batches import pieces

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("head script style template noscript iframe noembed noframes object audio video canvas datalist area title annotation annotation-xml".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure fieldset hr menu dir".split())
BLOCK = SPACED | frozenset("address article aside body caption center dd details dialog div dt fieldset figcaption footer form header hgroup html legend li "
                           "main nav optgroup option search section summary tbody td tfoot th thead tr".split())
#: A start tag closes these open elements, looked for up to the elements after them.
IMPLIED = {
    "li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "option": ("option", "select datalist"),
    "optgroup": ("optgroup option", "select"), "tr": ("tr td th caption", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"),
    "tbody": ("tbody thead tfoot tr td th caption", "table"), "thead": ("tbody thead tfoot tr td th caption", "table"),
    "tfoot": ("tbody thead tfoot tr td th caption", "table"),
}
IMPLIED = {tag: (frozenset(close.split()), frozenset(stop.split())) for tag, (close, stop) in IMPLIED.items()}
CLOSES_P = BLOCK - frozenset("option optgroup td th tr tbody thead tfoot caption html body".split())
P_SCOPE = frozenset("button td th caption table object".split())
SCOPE = frozenset("table td th caption".split())
#: A part of a table closes what is open inside its table up to one of these.
PARTS = {"caption": "table", "colgroup": "table", "col": "table colgroup", "tbody": "table", "thead": "table", "tfoot": "table",
         "tr": "table tbody thead tfoot", "td": "table tbody thead tfoot tr", "th": "table tbody thead tfoot tr"}
PARTS = {tag: frozenset(within.split()) for tag, within in PARTS.items()}
GRID = frozenset("table tbody thead tfoot tr".split())  # text and other elements in these stand before the table
UNMOVED = frozenset(PARTS) | frozenset("script style template".split())
FOREIGN = frozenset("svg math".split())
ISLANDS = frozenset("foreignobject desc annotation-xml mi mo mn ms mtext".split())  # HTML inside svg and math
LEAVES_FOREIGN = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small "
                           "span strong strike sub sup table tt u ul var".split())
SVG_HIDDEN = frozenset("defs symbol metadata desc clippath mask pattern marker lineargradient radialgradient filter".split())
BULLETS = ("*", "-", "+")
TABLES = 20  # depth of tables inside tables that are laid out; deeper ones are plain blocks
COLUMN_GAP = "  "
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|[^<]+|<", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_SPACE = re.compile(r"[ \t\r\n\f]+")


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []


def build_tree(html: str) -> Node:
    """The element tree. Missing end tags are implied by the next start tag or the end of the parent; stray end tags are ignored.

    A cell outside a row gets one; text and elements that a table cannot hold stand before it, and a form inside a table's rows is closed at once.
    """
    root = Node("#root", {})
    path, names = [root], ["#root"]
    opened: Counter[str] = Counter()

    def close(tags: frozenset, stop: frozenset) -> None:
        if not any(opened[t] for t in tags):
            return
        for i in range(len(path) - 1, 0, -1):
            if names[i] in stop:
                return
            if names[i] in tags:
                opened.subtract(names[i:])
                del path[i:], names[i:]
                return

    def cut(i: int) -> None:
        opened.subtract(names[i:])
        del path[i:], names[i:]

    def last(tags: frozenset) -> int:
        return next((i for i in range(len(names) - 1, 0, -1) if names[i] in tags), 0)

    def add(child: Node | str) -> None:
        if names[-1] in GRID and opened["table"] and (child.strip() if isinstance(child, str) else child.tag not in UNMOVED):
            path[last(frozenset(("table",))) - 1].children.insert(-1, child)  # an open table is the last child
        else:
            path[-1].children.append(child)

    def add_text(text: str) -> None:
        if names[-1] == "colgroup" and text.strip():
            cut(len(path) - 1)
        add(text)

    at, end = 0, len(html)
    while at < end:
        match = _TOKEN.match(html, at)
        at = match.end()
        tag = match[2]
        if tag is None:
            token = match[0]
            if token.startswith("<![CDATA["):
                add_text(token[9:-3] if token.endswith("]]>") else token[9:])
            elif not (token.startswith("<!") or token.startswith("<?")):
                add_text(unescape(token) if "&" in token else token)
            continue
        tag = tag.lower()
        if match[1]:
            if tag == "p" and not opened["p"]:
                add(Node("p", {}))
            elif tag not in VOID:
                close(frozenset((tag,)), frozenset() if tag in SCOPE or tag in ("tr", "tbody", "thead", "tfoot") else SCOPE)
            continue
        if tag in CLOSES_P and opened["p"]:
            close(frozenset(("p",)), P_SCOPE)
        if tag in IMPLIED:
            tags, stop = IMPLIED[tag]
            for _ in range(3 if "tr" in tags else 1):  # a row closes its cell and the row before
                close(tags, stop)
        if tag in LEAVES_FOREIGN and (opened["svg"] or opened["math"]) and names[i := last(FOREIGN | ISLANDS)] in FOREIGN:
            cut(i)
        if opened["table"]:
            if tag in PARTS:
                cut(last(PARTS[tag]) + 1)
                if tag in ("td", "th") and names[-1] != "tr":
                    row = Node("tr", {})
                    path[-1].children.append(row)
                    path.append(row)
                    names.append("tr")
                    opened["tr"] += 1
            elif names[-1] == "colgroup" and tag != "template":
                cut(len(path) - 1)
            if names[-1] in GRID:
                if tag == "form":
                    continue
                if tag == "table":
                    cut(last(frozenset(("table",))))
        rest = match[3]
        node = Node(tag, {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(rest)} if rest.strip(" /") else {})
        if tag == "input" and node.attributes.get("type", "").lower() == "hidden":
            path[-1].children.append(node)
        else:
            add(node)
        if tag in RAW:
            stop = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(html, at)
            body = html[at:stop.start() if stop else end]
            node.children.append(unescape(body) if tag in ("textarea", "title") else body)
            at = stop.end() if stop else end
        elif tag not in VOID and not (rest.endswith("/") and (tag in FOREIGN or opened["svg"] or opened["math"])):
            path.append(node)
            names.append(tag)
            opened[tag] += 1
    return root


def _style(node: Node) -> dict[str, str]:
    return {k.strip().lower(): v.strip().lower() for k, _, v in (p.partition(":") for p in node.attributes.get("style", "").split(";"))}


def _displayed(node: Node) -> bool:
    if node.tag in HIDDEN:
        return False
    attributes = node.attributes
    if not attributes:
        return node.tag != "dialog"
    if "hidden" in attributes and attributes["hidden"].lower() != "until-found":
        return False
    if node.tag == "input" and (attributes.get("type", "").lower() not in ("button", "submit", "reset", "text", "search", "email", "url", "tel", "number", "") or "value" not in attributes):
        return False
    if node.tag == "dialog" and "open" not in attributes:
        return False
    return "style" not in attributes or _style(node).get("display", "").removesuffix("!important").strip() != "none"


def _inherit(node: Node, shown: bool, keep: bool) -> tuple[bool, bool]:
    """Whether text of a node is visible and keeps its white space, given that of its parent."""
    if node.attributes and "style" in node.attributes:
        style = _style(node)
        shown = {"hidden": False, "collapse": False, "visible": True}.get(style.get("visibility", "").removesuffix("!important").strip(), shown)
        keep = keep or style.get("white-space", "").startswith("pre")
    return shown, keep


class Page:
    """Lines of text with collapsed white space, margins between blocks, and a prefix for lists and quotes."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.margin, self.space, self.first = 0, False, ""
        self.indents: list[str] = []

    def add(self, text: str, keep: bool) -> None:
        if keep:
            first, *others = text.replace("\r\n", "\n").split("\n")
            self._put(first)
            for other in others:
                self.end_line(True)
                self._put(other)
            return
        words = _SPACE.sub(" ", text)
        if words[:1] == " ":
            self.space = True
        body = words.strip(" ")
        if body:
            if self.space and self.line:
                self.line.append(" ")
            self._put(body)
            self.space = words[-1] == " "

    def _put(self, text: str) -> None:
        if text:
            self.line.append(text)

    def end_line(self, always: bool = False) -> None:
        self.space = False
        if self.line or always:
            if self.margin and self.lines:
                self.lines.extend([""] * (self.margin - 1))
            self.margin = 0
            indent = "".join(self.indents)
            if self.first:
                indent = indent[:max(len(indent) - len(self.first), 0)] + self.first
                self.first = ""
            self.lines.append((indent + "".join(self.line)).rstrip(" "))
            self.line = []

    def gap(self, lines: int) -> None:
        """The next line starts at least ``lines`` line breaks after the last one."""
        self.end_line()
        if not self.first:  # a list mark stays on the line of its text
            self.margin = max(self.margin, lines)


def _rows(table: Node, shown: bool, keep: bool) -> Iterator[tuple[Node, bool, bool]]:
    for child in table.children:
        if isinstance(child, Node) and _displayed(child):
            if child.tag == "tr":
                yield child, *_inherit(child, shown, keep)
            elif child.tag in ("tbody", "thead", "tfoot"):
                yield from _rows(child, *_inherit(child, shown, keep))


def _number(value: str | None, most: int = 1000) -> int:
    return min(max(int(value), 1), most) if value and value.isdecimal() and len(value) < 9 else 1


def _table_lines(table: Node, visible: bool, keep: bool, depth: int) -> list[str]:
    """Rows with cells padded to the width of their column; a spanning cell takes its columns together."""
    grid, taken = [], {}
    for row, *state in _rows(table, visible, keep):
        cells, column = [], 0
        for cell in row.children:
            if isinstance(cell, Node) and cell.tag in ("td", "th") and _displayed(cell):
                while taken.get(column, 0) > 0:
                    column += 1
                span, down = _number(cell.attributes.get("colspan")), _number(cell.attributes.get("rowspan"))
                cells.append((column, span, render(cell, *_inherit(cell, *state), depth + 1)))
                for c in range(column, column + span):
                    taken[c] = down
                column += span
        taken = {c: n - 1 for c, n in taken.items() if n > 1}
        grid.append(cells)
    width: dict[int, int] = {}
    for cells in grid:
        for column, span, lines in cells:
            if span == 1:
                width[column] = max(width.get(column, 0), max(map(len, lines), default=0))
    for cells in grid:
        for column, span, lines in cells:
            if span > 1:
                have = sum(width.get(c, 0) for c in range(column, column + span)) + len(COLUMN_GAP) * (span - 1)
                last = column + span - 1
                width[last] = width.get(last, 0) + max(max(map(len, lines), default=0) - have, 0)
    start, place = {}, 0
    for column in range(max(width, default=-1) + 1):
        start[column] = place
        place += width.get(column, 0) + (len(COLUMN_GAP) if width.get(column, 0) else 0)
    out = []
    for cells in grid:
        for i in range(max((len(lines) for _, _, lines in cells), default=0)):
            line = ""
            for column, _, lines in cells:
                if i < len(lines) and lines[i]:
                    line = line.ljust(start[column]) + lines[i]
            out.append(line.rstrip())
    return out


def render(root: Node, visible: bool = True, keep: bool = False, depth: int = 0) -> list[str]:
    """Lines of all that is visible below a node."""
    page = Page()
    lists: list[list] = []  # kind and counter of the open lists
    todo: list[tuple] = [("children", root, visible, keep)]
    while todo:
        step, node, shown, keep = todo.pop()
        if step == "leave":
            if node.tag in BLOCK:
                page.gap(2 if node.tag in SPACED and len(lists) < 2 else 1)
            if node.tag in ("ul", "ol", "menu", "dir") and lists:
                lists.pop()
            if node.tag in ("li", "dd", "blockquote") and page.indents:
                page.end_line(bool(page.first))
                page.indents.pop()
            if node.tag == "q":
                page.add('"', keep)
            continue
        if step == "children":
            for child in reversed(node.children):
                todo.append(("node", child, shown, keep))
            continue
        if isinstance(node, str):
            if shown:
                page.add(node, keep)
            continue
        if not _displayed(node):
            continue
        tag, attributes = node.tag, node.attributes
        shown, keep = _inherit(node, shown, keep)
        if step == "svg" or tag == "svg":  # of a drawing, its text elements and the HTML in it
            if attributes.get("display") == "none" or tag in SVG_HIDDEN:
                continue
            shown = {"hidden": False, "collapse": False, "visible": True}.get(attributes.get("visibility", ""), shown)
            if tag not in ("text", "foreignobject"):
                todo.extend(("svg", child, shown, keep) for child in reversed(node.children) if isinstance(child, Node))
                continue
            page.space = True
        if tag == "br":
            page.end_line(True)
            continue
        if tag == "input":
            if shown:
                page.add(attributes["value"], keep)
            continue
        if tag in BLOCK:
            page.gap(2 if tag in SPACED and len(lists) < 1 else 1)
        if tag == "table" and depth < TABLES:
            for child in node.children:
                if isinstance(child, Node) and child.tag == "caption" and _displayed(child):
                    for line in render(child, *_inherit(child, shown, keep), depth + 1):
                        page.line.append(line)
                        page.end_line(True)
            for line in _table_lines(node, shown, keep, depth):
                page.line.append(line)
                page.end_line(True)
            page.gap(2 if not lists else 1)
            continue
        todo.append(("leave", node, shown, keep))
        if tag in ("ul", "menu", "dir"):
            lists.append([BULLETS[min(sum(1 for k, _ in lists if k in BULLETS), len(BULLETS) - 1)], 0])
        elif tag == "ol":
            begin = attributes.get("start", "")
            lists.append(["1", int(begin) - 1 if re.fullmatch(r"-?\d{1,9}", begin) else 0])
        elif tag == "li":
            mark = BULLETS[0]
            if lists:
                lists[-1][1] += 1
                mark = lists[-1][0] if lists[-1][0] != "1" else f"{lists[-1][1]}."
            page.indents.append(" " * (len(mark) + 1))
            page.first = mark + " "
        elif tag == "dd":
            page.indents.append("    ")
        elif tag == "blockquote":
            page.indents.append("> ")
        elif tag == "q":
            page.add('"', keep)
        if tag == "details" and "open" not in attributes:
            for child in reversed(node.children):
                if isinstance(child, Node) and child.tag == "summary":
                    todo.append(("node", child, shown, keep))
                    break
            continue
        todo.append(("children", node, shown, keep or tag in ("pre", "textarea", "xmp", "listing")))
    page.end_line()
    while page.lines and not page.lines[-1]:
        page.lines.pop()
    return page.lines


def page_text(html: str | None) -> str:
    return "\n".join(render(build_tree(html or "")))


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text``: all visible text of every whole page, laid out.

    Paragraphs, headings, lists and tables are set apart by an empty line, other blocks by a line; list items carry a bullet or number and
    indent; cells of a table column start at one place; ``pre`` keeps its white space. Of ``svg`` its text elements and HTML are shown. Not shown: head, scripts, styles, templates, embedded media, annotations of ``math``, ``hidden``,
    ``display:none``, ``visibility:hidden``, closed details and dialogs. A null or empty page gives an empty text; each row stands alone, so repeated rows agree and null ids stay.
    Tables nested ``TABLES`` deep are laid out as plain blocks, and a cell spans at most 1,000 columns or rows; no text is lost by either.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "html"):
            texts = [page_text(h) for h in part["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays([part["page_id"], part["url"], pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html").mapInArrow(run, "page_id bigint, url string, text string")
