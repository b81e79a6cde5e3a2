"""Text of web pages as laid out: a tree with implied tags, visibility rules, blocks, lists and aligned tables.

Building: void elements, raw text of scripts and styles, character references; paragraphs, list items, definitions,
options, rows, cells and row groups end where HTML lets them end unsaid; an end tag closes what is open inside it and
is ignored if nothing matches within its table. Hidden: head, scripts, styles, templates, media fallbacks, `hidden`,
`display: none`, closed details except their summary; what `visibility` hides, except descendants that are visible again;
hidden, password, choice, file, range and colour inputs; in drawings all but `text` and `foreignObject`, and definitions;
in formulas annotations and phantoms. All other text is kept, values of inputs (else their placeholders) included; the
parts of a fraction are joined by a slash.

Layout: white space collapses outside preformatted text; blocks start lines, paragraphs, headings, lists and tables
stand apart by one blank line; list items have bullets or numbers and are indented by level; table columns are aligned,
up to `WIDE` characters, beyond which a cell takes its room without widening its column; cells of several lines stay
side by side; spans take their columns.

The page is parsed in one pass over its tags; nesting of any depth needs no recursion. Pages are independent, so that
nothing is shuffled. Defined cases: a null or empty page gives an empty text; broken markup is text or is skipped as
browsers do; rows of one id are rendered each by itself; an empty table gives no rows; further columns are ignored
unless kept.
"""

from __future__ import annotations

import re
from html import unescape

from pyspark.sql import DataFrame

from rollbook.llm.common import per_row

WIDE = 60
DEEPEST = 512  # levels; deeper elements become siblings, as in browsers
#: Names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset(
    "head title meta link base script style template iframe object audio video canvas datalist noembed noframes".split()
)
FOREIGN = frozenset("svg math foreignobject".split())
#: Not rendered where they stand in drawings and formulas.
UNDRAWN = frozenset("desc defs metadata symbol clippath mask marker pattern".split())
UNSAID = frozenset("annotation annotation-xml mphantom".split())
VALUELESS = frozenset("hidden password checkbox radio file image range color".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary ul option optgroup"
    " caption".split()
)
APART = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote table figure hr".split())
LISTS = frozenset("ul ol menu dir".split())
#: An opening tag ends an open element of the second set, unless one of the third stands between.
ENDS = {
    "li": ({"li"}, LISTS), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "body": ({"head"}, set()),
}
_ENDS_P = (BLOCK | {"table"}) - {"body", "html", "option", "optgroup", "caption", "legend", "summary"}
_IN_HEAD = frozenset("meta link base title style script noscript template head html".split())
_TAG = re.compile(
    r"<(?:!--(?P<comment>.*?)(?:--!?>|\Z)|(?P<odd>[!?][^>]*)(?:>|\Z)"
    r"|(?P<end>/)?(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?P<close>>|\Z))",
    re.DOTALL,
)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_GONE = re.compile(r"(?i)display\s*:\s*none")
_SEEN = re.compile(r"(?i)(?<![a-z-])visibility\s*:\s*(visible|initial|hidden|collapse)")
_SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("attrs", "children", "name")

    def __init__(self, name: str, attrs: dict[str, str]):
        self.name, self.attrs, self.children = name, attrs, []


def parse(html: str) -> Node:
    """The tree of a page; children are nodes and texts."""
    root = Node("html", {})
    stack = [root]
    at, n = 0, len(html)

    def text(value: str) -> None:
        if value:
            if stack[-1].name == "head" and value.strip():
                stack.pop()
            stack[-1].children.append(unescape(value))

    def close(names, until) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].name in names:
                del stack[i:]
                close(names, until)
                return
            if stack[i].name in until:
                return

    while at < n:
        start = html.find("<", at)
        if start < 0:
            text(html[at:])
            break
        m = _TAG.match(html, start)
        if not m and re.match(r"</?[a-zA-Z]", html[start : start + 3]):
            text(html[at:start])  # a quote is open to the end of the page: the tag ends at the next sign that could
            at = html.find(">", start) + 1 or n
            continue
        if not m:
            text(html[at : start + 1])
            at = start + 1
            continue
        text(html[at:start])
        at = m.end()
        if not m["name"] or not m["close"]:
            continue
        name = m["name"].lower()
        if m["end"]:
            if name == "br":
                stack[-1].children.append(Node("br", {}))
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == name:
                    del stack[i:]
                    break
                if stack[i].name in ("td", "th", "table", "caption") and name not in ("table", "tr", "tbody", "thead", "tfoot", "td", "th", "body", "html"):
                    break
            continue
        attrs = {a[0].lower(): unescape(a[1] or a[2] or a[3]) for a in reversed(_ATTR.findall(m["attrs"]))}
        if name == "html":
            continue
        if stack[-1].name == "head" and name not in _IN_HEAD:
            stack.pop()
        if name in _ENDS_P:
            close({"p"}, {"td", "th", "caption", "table", "button", "object"})
        if name in ENDS:
            close(*ENDS[name])
        if name in ("td", "th") and stack[-1].name != "tr" and any(x.name == "table" for x in stack[-4:]):
            row = Node("tr", {})
            stack[-1].children.append(row)
            stack.append(row)
        node = Node(name, attrs)
        stack[-1].children.append(node)
        inside = next((x.name for x in reversed(stack) if x.name in FOREIGN), "") if m["attrs"].rstrip().endswith("/") else ""
        if inside in ("svg", "math") or m["attrs"].rstrip().endswith("/") and name in ("svg", "math", "path"):
            continue  # only there a slash ends an element
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.IGNORECASE).search(html, at)
            stop = end.start() if end else n
            value = html[at:stop]
            if value:
                node.children.append(unescape(value) if name in ("textarea", "title") else value)
            at = stop
            if end:
                at = html.find(">", stop) + 1 or n
        elif name not in VOID:
            if len(stack) >= DEEPEST:
                stack.pop()
            stack.append(node)
    return root


def hidden(node: Node) -> bool:
    if node.name in HIDDEN or "hidden" in node.attrs and node.attrs["hidden"].lower() != "until-found":
        return True
    return bool(_GONE.search(node.attrs.get("style", "")))


def unseen(node: Node, above: bool, drawn: bool) -> bool:
    """Whether the element's own text is invisible: by its last declaration, else as above it."""
    said = _SEEN.findall(node.attrs.get("style", "")) or drawn and [node.attrs.get("visibility", "")]
    said = said[-1].lower() if said else ""
    return said in ("hidden", "collapse") if said in ("visible", "initial", "hidden", "collapse") else above


class Page:
    """Lines under construction: inline text goes to the last line; blank lines between blocks collapse."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.indent = ""
        self.mark = ""  # before the next line: a bullet
        self.gap = 0  # blank lines due before the next text
        self.space = False
        self.pre = 0

    def write(self, text: str) -> None:
        if self.pre:
            for i, line in enumerate(text.split("\n")):
                if i:
                    self.end(True)
                if line:
                    self.parts.append(line)
            return
        words = _SPACE.split(text)
        if len(words) > 1 and not words[0]:
            self.space = True
        for i, word in enumerate(words):
            if i:
                self.space = True
            if word:
                if self.space and self.parts and not self.parts[-1].endswith(" "):
                    self.parts.append(" ")
                self.parts.append(word)
                self.space = False

    def end(self, always: bool = False) -> None:
        """Finishes the line; always: even an empty one."""
        line = "".join(self.parts)
        line = line if self.pre else line.rstrip(" ")
        if line or self.mark or always:
            if self.lines:
                self.lines += [""] * self.gap
            self.gap = 0
            room = self.indent[: max(0, len(self.indent) - len(self.mark))] + self.mark if self.mark else self.indent
            self.lines.append(room + line if line or self.mark else "")
            self.mark = ""
        self.parts, self.space = [], False

    def apart(self, lines: int = 1) -> None:
        self.end()
        self.gap = max(self.gap, lines)

    def done(self) -> list[str]:
        self.end()
        while self.lines and not self.lines[-1].strip():
            self.lines.pop()
        return self.lines


class Table:
    def __init__(self):
        self.rows: list[list[tuple[int, int, list[str]]]] = []
        self.title: list[str] = []

    def cell(self, node: Node, lines: list[str]) -> None:
        if not self.rows:
            self.rows.append([])
        number = lambda k, most: min(most, max(1, int(v))) if (v := node.attrs.get(k, "").strip()).isdecimal() else 1
        self.rows[-1].append((number("colspan", 1000), number("rowspan", 65534), lines))

    def lines(self) -> list[str]:
        placed, taken, widths = [], {}, {}
        for row in self.rows:
            at, cells, fresh = 0, [], {}
            for columns, rows, lines in row:
                while taken.get(at, 0) > 0:
                    at += 1
                cells.append((at, columns, lines))
                if columns == 1:
                    widths[at] = max(widths.get(at, 0), min(WIDE, max(map(len, lines), default=0)))
                if rows > 1:
                    fresh.update({at + i: rows for i in range(columns)})
                at += columns
            taken = {k: v - 1 for k, v in (taken | fresh).items() if v > 1}
            placed.append(cells)
        starts, total = {}, 0
        for column in range(max([*widths, *(a for r in placed for a, _, _ in r)], default=-1) + 1):
            starts[column] = total
            total += widths.get(column, 0) + 2
        out = list(self.title)
        for cells in placed:
            for i in range(max((len(lines) for _, _, lines in cells), default=0)):
                line = ""
                for at, _, lines in cells:
                    if i < len(lines) and lines[i]:
                        room = starts[at] - len(line)
                        line += (" " * room if room >= 0 else "  ") + lines[i]
                out.append(line)
        return out


def render(html: str) -> str:
    """The visible text of a page."""
    pages, tables, lists = [Page()], [], []
    #: Further: whether text is invisible, and what it stands in: a page (""), "svg", "text" of a drawing, or "math".
    todo: list[tuple[object, bool, bool, str]] = [(parse(html), False, False, "")]
    while todo:
        node, leaving, dark, within = todo.pop()
        page = pages[-1]
        if isinstance(node, str):
            if not dark and within != "svg":
                page.write(node)
            continue
        name = node.name
        if leaving:
            if name in ("td", "th", "caption") and tables:
                lines = pages.pop().done()
                if name == "caption":
                    tables[-1].title += lines
                else:
                    tables[-1].cell(node, lines)
            elif name == "table":
                lines = tables.pop().lines()
                for line in lines:
                    page.parts.append(line)
                    page.end(True)
                page.apart()
            elif name in ("td", "th"):
                page.write(" ")
            elif name in BLOCK or name == "tr":
                page.end()
                if name in LISTS:
                    lists.pop()
                    page.indent = page.indent[:-3]
                elif name in ("dd", "blockquote"):
                    page.indent = page.indent[:-3]
                if name == "pre":
                    page.pre -= 1
                if name in APART and not (name in LISTS and lists):
                    page.apart()
            elif name == "textarea":
                page.pre -= 1
            elif name == "text" and within == "text":
                page.space = True
            continue
        if hidden(node):
            continue
        drawn = within in ("svg", "text")
        if drawn and (name in UNDRAWN or node.attrs.get("display", "").strip().lower() == "none") or within == "math" and name in UNSAID:
            continue
        dark = unseen(node, dark, drawn)
        if name in ("svg", "math"):
            within = name
        elif drawn and name in ("text", "foreignobject"):
            within = "text" if name == "text" else ""
        if within == "text" and name == "text":
            page.space = True
        if name == "br":
            if not dark:
                page.end(True)
            continue
        if name == "hr":
            if dark:
                continue
            page.apart()
            page.parts.append("---")
            page.apart()
            continue
        if name == "input":
            kind = node.attrs.get("type", "").strip().lower()
            if dark:
                continue
            if kind in ("submit", "button", "reset"):
                page.write(node.attrs.get("value", ""))
            elif kind not in VALUELESS and (value := node.attrs.get("value") or node.attrs.get("placeholder", "")):
                page.write(f" {value} ")
            continue
        if name in VOID:
            continue
        children = node.children
        if name == "details" and "open" not in node.attrs:
            first = next((x for x in children if isinstance(x, Node) and x.name == "summary"), None)
            children = [first] if first else []
        if name == "table":
            page.apart()
            tables.append(Table())
        elif name == "tr" and tables:
            tables[-1].rows.append([])
        elif name in ("td", "th", "caption") and tables:
            pages.append(Page())
        elif name in BLOCK or name == "tr":
            page.end()
            if name in APART and not (name in LISTS and lists):
                page.apart()
            if name in LISTS:
                lists.append([name, int(v) if (v := node.attrs.get("start", "").strip()).lstrip("-").isdecimal() else 1])
                page.indent += "   "
            elif name == "li":
                kind = lists[-1] if lists else ["ul", 1]
                if not dark:
                    page.mark = f"{kind[1]}. " if kind[0] == "ol" else "-  "
                kind[1] += 1
            elif name in ("dd", "blockquote"):
                page.indent += "   "
            elif name == "pre":
                page.pre += 1
        elif name == "textarea":
            page.pre += 1
        if name == "table" or name in ("thead", "tbody", "tfoot") or name == "tr" and tables:
            children = [x for x in children if not isinstance(x, str) or x.strip()]  # space between rows is no text
        if tables and name in ("table", "tr", "thead", "tbody", "tfoot"):
            # Text outside cells is not lost: it stands in a cell of its own.
            children = [_celled(x) if isinstance(x, str) else x for x in children]
        if name == "mfrac" and within == "math":
            parts = [x for x in children if isinstance(x, Node)]
            children = [y for x in parts for y in (x, "/")][:-1]
        todo.append((node, True, dark, within))
        todo += [(x, False, dark, within) for x in reversed(children)]
    return "\n".join(pages[0].done())


def _celled(text: str) -> Node:
    node = Node("td", {})
    node.children.append(text)
    return node


def extract(pages: DataFrame, keep: list[str]) -> DataFrame:
    """The kept columns and `text`, the visible text of `html`."""
    return per_row(pages, "text string", keep, "html", lambda raw: (render(raw.decode("utf-8", "replace")),))
