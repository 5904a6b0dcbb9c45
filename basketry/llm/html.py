"""HTML to text with layout.

A small tree builder supplies implied tags; a renderer then walks the visible
part of the tree and writes all of its text, with blank lines between blocks,
bullets and numbers for lists, and table cells in aligned columns.  Both work
on explicit stacks, so nesting depth is not a limit.  Each page is a row of
its own: one pass, no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from unicodedata import east_asian_width

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import map_batches, slices

# Fixed values of the HTML standard.
VOID = frozenset("area base basefont bgsound br col embed frame hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("head script style template noscript title iframe noembed noframes audio video canvas datalist area param rp meta link base".split())
#: What is not rendered inside svg and math, where text inside them is HTML
#: again, and the tags that end them.
UNRENDERED = {
    "svg": frozenset("title desc defs metadata symbol clippath mask marker pattern filter".split()),
    "math": frozenset("annotation annotation-xml mphantom".split()),
}
_HTML_INSIDE = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
_BREAKS_OUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre "
    "ruby s small span strong strike sub sup table tt u ul var".split()
)
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr li dt dd listing main menu nav ol p plaintext pre search section summary table ul xmp".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Tag -> open tags that it ends, and the tags beyond which it does not look.
_CELLS = frozenset("td th".split())
_LISTS = frozenset("ul ol menu dir".split())
IMPLIED_END = {
    "li": (frozenset(["li"]), _LISTS | {"table", "td", "th"}),
    "dt": (frozenset("dt dd".split()), frozenset("dl table td th".split())),
    "dd": (frozenset("dt dd".split()), frozenset("dl table td th".split())),
    "option": (frozenset(["option"]), frozenset("select datalist".split())),
    "optgroup": (frozenset("option optgroup".split()), frozenset("select datalist".split())),
    "td": (_CELLS, frozenset("tr table".split())),
    "th": (_CELLS, frozenset("tr table".split())),
    "tr": (frozenset("td th tr caption colgroup".split()), frozenset(["table"])),
    "tbody": (frozenset("td th tr tbody thead tfoot caption colgroup".split()), frozenset(["table"])),
    "thead": (frozenset("td th tr tbody thead tfoot caption colgroup".split()), frozenset(["table"])),
    "tfoot": (frozenset("td th tr tbody thead tfoot caption colgroup".split()), frozenset(["table"])),
    "rt": (frozenset("rt rp".split()), frozenset(["ruby"])),
    "rp": (frozenset("rt rp".split()), frozenset(["ruby"])),
}
#: An end tag does not reach beyond these, unless it names one of them.
SCOPE = frozenset("table td th caption button object template html".split())
BLOCKS = ENDS_P | frozenset("html body tr tbody thead tfoot caption option optgroup legend".split())
#: Blocks with a blank line before and after.
SPACED = frozenset("p blockquote pre dl ol ul menu dir figure table h1 h2 h3 h4 h5 h6 hr address fieldset".split())
_P = frozenset(["p"])
_IN_TABLE = frozenset("table tbody thead tfoot tr".split())
_TABLE_PARTS = frozenset("tbody thead tfoot tr td th caption colgroup col script style template".split())

#: Columns up to this width are padded; longer cells are written whole.
MAX_PAD = 60

#: Elements whose text keeps its lines and spaces.
_PREFORMATTED = frozenset("pre listing xmp plaintext textarea".split())

_TAG = re.compile(r"<(?:!--|([!?])|(/?)([a-zA-Z][^\s/>]*))")
_COMMENT_END = re.compile(r"--!?>")
#: What ends a tag, or opens a value that may hold its end.
_MARK = re.compile(r""">|=\s*(["'])""")
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_CSS = re.compile(r"/\*.*?(?:\*/|\Z)|\"[^\"\n]*\"|'[^'\n]*'|[{};]", re.S)
_DECLARED = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([a-z-]+)\s*(!\s*important)?", re.I)
_SIMPLE = re.compile(r"[a-zA-Z][\w-]*|[.#][\w-]+")
_BLANK = " \t\n\r\f"
_SPACES = re.compile(r"\s*")


class _Tags:
    """Where tags end, in time linear in the page however broken it is: what
    was looked for in vain is not looked for again."""

    def __init__(self, html: str):
        self.html = html
        self.last = html.rfind(">")
        self.last_quote = {q: html.rfind(q) for q in "\"'"}
        self.dead: set[int] = set()  # marks from which no end follows

    def end(self, at: int) -> int:
        """Position of the ">" that ends the tag whose name ends at ``at``;
        -1: none.  One inside a quoted value does not count, unless there is
        no other; a quotation mark that is never closed is an ordinary one."""
        if at > self.last:
            return -1
        passed, pos = [], at
        while (m := _MARK.search(self.html, pos)) is not None and m.start() not in self.dead:
            quote = m[1]
            if quote is None:
                return m.start()
            passed.append(m.start())
            pos = self.html.find(quote, m.end()) + 1 if m.end() <= self.last_quote[quote] else m.end()
            if pos > self.last:
                break
        self.dead.update(passed)
        return self.html.find(">", at)


def has_doctype(html: str) -> bool:
    """Whether a document type stands in front; class names and ids keep their
    case then."""
    at = 0
    while True:
        at = _SPACES.match(html, at).end()
        if not html.startswith("<!--", at):
            return html[at : at + 9].lower() == "<!doctype"
        done = _COMMENT_END.search(html, at + 4)
        if done is None:
            return False
        at = done.end()


def style_rules(css: str) -> Iterator[tuple[str, str]]:
    """(selectors, declarations) of the rules that hold on any screen: those
    for other media, or under a condition, are left out."""
    holds, text, at = [True], "", 0
    for m in _CSS.finditer(css):
        text += css[at : m.start()]
        at = m.end()
        mark = m[0]
        if mark == "{":
            head = text.strip()
            if head.startswith("@"):
                name, _, media = head[1:].partition(" ")
                kinds = [k.strip().lower() for k in media.split(",")]
                holds.append(holds[-1] and (name.lower() in ("layer", "supports") or name.lower() == "media" and any(k in ("", "all", "screen", "only screen", "not print") for k in kinds)))
            else:
                rule = head
                holds.append(None)
            text = ""
        elif mark == "}":
            if len(holds) > 1:
                if holds.pop() is None and holds[-1]:
                    yield rule, text
            text = ""
        elif mark == ";" and holds[-1] is not None:
            text = ""  # an @import, or the like
        elif mark == ";":
            text += ";"
        elif mark[0] in "\"'":
            text += mark


def _declared(body: str) -> Iterator[tuple[str, str, bool]]:
    """(property, value, whether important) of display and visibility."""
    for name, value, important in _DECLARED.findall(body):
        yield name.lower(), value.lower(), bool(important)


class Node:
    __slots__ = ("tag", "attrs", "children", "parent", "inside", "foreign")

    def __init__(self, tag: str, attrs: str = "", parent: Node | None = None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []
        #: The svg or math that this element belongs to, and the one that rules its content.
        self.inside = tag if tag in UNRENDERED else parent.foreign if parent else ""
        self.foreign = "" if self.inside and tag in _HTML_INSIDE else self.inside

    def attributes(self) -> dict[str, str]:
        found: dict[str, str] = {}
        for name, *values in _ATTR.findall(self.attrs):
            found.setdefault(name.lower(), unescape(next((v for v in values if v), "")))
        return found


class TreeBuilder:
    def __init__(self):
        self.root = self.at = Node("#root")
        self.styles: list[str] = []
        #: How many of each tag are open; most searches end here.
        self.opened: dict[str, int] = {}
        self.quirks = True

    def _open(self, tags: frozenset[str], until: frozenset[str]) -> Node | None:
        if not any(self.opened.get(t) for t in tags):
            return None
        node = self.at
        while node is not None and node.tag not in until:
            if node.tag in tags:
                return node
            node = node.parent
        return None

    def _close(self, node: Node) -> None:
        """End ``node`` and all that is open inside it."""
        while True:
            last = self.at
            self.opened[last.tag] -= 1
            self.at = last.parent
            if last is node:
                return

    def _place(self, child: Node | str, tag: str) -> None:
        """Append; what a table cannot hold goes in front of the table."""
        if self.at.tag in _IN_TABLE and tag not in _TABLE_PARTS:
            table = self.at
            while table.tag != "table" and table.parent is not None:
                table = table.parent
            if table.parent is not None:
                table.parent.children.insert(-1, child)  # its parent stays open, so the table goes on behind it
                return
        self.at.children.append(child)

    def text(self, data: str) -> None:
        if data:
            self._place(data, "#text" if data.strip(_BLANK) else "col")

    def start(self, tag: str, attrs: str) -> None:
        if tag in ("html", "body", "head") and self.at is not self.root and self.at.tag != "html":
            if tag != "body" or self.at.tag != "head":
                return  # a second one
        if self.at.foreign and tag in _BREAKS_OUT:
            while self.at.foreign:
                self._close(self.at)
        if self.at.tag == "head" and tag not in HIDDEN and tag not in VOID:
            self._close(self.at)
        if tag in ENDS_P and (p := self._open(_P, SCOPE)) is not None:
            self._close(p)
        if tag in HEADINGS and self.at.tag in HEADINGS:
            self._close(self.at)
        if tag in IMPLIED_END:
            ends, until = IMPLIED_END[tag]
            while (node := self._open(ends, until)) is not None:
                self._close(node)
        if tag in _CELLS and self.at.tag in _IN_TABLE - {"tr"}:
            self.start("tr", "")
        if tag == "form" and self.at.tag in _IN_TABLE:
            return  # empty there, so nothing of it is seen
        node = Node(tag, attrs, self.at)
        self._place(node, tag)
        if tag not in VOID and not (node.inside and attrs.endswith("/")):
            self.at = node
            self.opened[tag] = self.opened.get(tag, 0) + 1

    def end(self, tag: str) -> None:
        if tag == "br":
            self.start("br", "")
        elif tag == "p" and self._open(_P, SCOPE) is None:
            self.start("p", "")
            self._close(self.at)
        elif tag in HEADINGS:
            if (node := self._open(HEADINGS, SCOPE)) is not None:
                self._close(node)
        elif tag not in ("html", "body"):  # what follows belongs to the body still
            node = self._open(frozenset([tag]), SCOPE - {tag} if tag not in _IN_TABLE | _CELLS else frozenset(["table"]) - {tag})
            if node is not None:
                self._close(node)

    def feed(self, html: str) -> Node:
        self.quirks = not has_doctype(html)
        tags, at, seen = _Tags(html), 0, 0
        while (m := _TAG.search(html, seen)) is not None:
            bang, close, name = m.groups()
            if name is not None:
                if (stop := tags.end(m.end())) < 0:  # no tag ends any more; the rest is text, up to a comment
                    rest = [i for i in (html.find("<!", m.end()), html.find("<?", m.end())) if i >= 0]
                    if not rest:
                        break
                    seen = min(rest)
                    continue
            self.text(unescape(html[at : m.start()]) if "&" in html[at : m.start()] else html[at : m.start()])
            if name is None:
                if bang:
                    stop = html.find(">", m.end())
                    at = len(html) if stop < 0 else stop + 1
                elif short := next((x for x in (">", "->") if html.startswith(x, m.end())), ""):
                    at = m.end() + len(short)
                else:
                    done = _COMMENT_END.search(html, m.end())
                    at = len(html) if done is None else done.end()
                seen = at
                continue
            attrs, at, tag = html[m.end() : stop], stop + 1, name.lower()
            seen = at
            if close:
                self.end(tag)
                continue
            self.start(tag, attrs)
            if tag in RAW and self.at.tag == tag:
                done = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(html, at)
                stop = len(html) if done is None else done.start()
                if tag == "style":
                    self.styles.append(html[at:stop])
                self.text(unescape(html[at:stop]) if tag in ("textarea", "title") else html[at:stop])
                at = seen = stop
                if done is None:
                    break
            elif tag == "plaintext":
                self.text(html[at:])
                at = seen = len(html)
        self.text(unescape(html[at:]))
        return self.root

    def rules(self) -> dict[str, list[tuple[str, tuple, str]]]:
        """Selector (tag, .class, #id) -> (property, rank, value) of what the
        page's own styles declare; the greatest rank counts."""
        found: dict[str, list[tuple[str, tuple, str]]] = {}
        order = 0
        for css in self.styles:
            for selectors, body in style_rules(css):
                for name, value, important in _declared(body):
                    order += 1
                    for s in map(str.strip, selectors.split(",")):
                        if _SIMPLE.fullmatch(s):
                            kind = 1 + ".#".find(s[0]) if s[0] in ".#" else 0
                            found.setdefault(s.lower() if self.quirks or not kind else s, []).append((name, (important, kind, order), value))
        return found


def styled(node: Node, rules: dict[str, list[tuple[str, tuple, str]]], quirks: bool) -> tuple[bool, str | None]:
    """(whether the element has a box, its own visibility or None)."""
    if node.tag in HIDDEN or (node.inside and node.tag in UNRENDERED[node.inside]):
        return False, None
    if not node.attrs and not rules:
        return node.tag != "dialog", None
    a = node.attributes() if node.attrs else {}
    found = [("display", (False, -1, 0), "none")] if "hidden" in a or node.tag == "dialog" and "open" not in a else []
    if rules:
        same = str.lower if quirks else str
        for selector in (node.tag, *("." + same(c) for c in a.get("class", "").split()), "#" + same(a.get("id", ""))):
            found += rules.get(selector, ())
    if "style" in a:
        found += [(name, (important, 3, i), value) for i, (name, value, important) in enumerate(_declared(a["style"]))]
    of = lambda what: max(((rank, value) for name, rank, value in found if name == what), default=((), None))[1]
    return of("display") != "none", of("visibility")


def width(text: str) -> int:
    return len(text) if text.isascii() else sum(2 if east_asian_width(c) in "WF" else 1 for c in text)


class Flow:
    """Lines of a page or a table cell."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = False
        self.gap = 0
        self.indent: list[str] = []
        self.marker = ""

    def _begin(self) -> None:
        if self.lines:
            self.lines += [""] * self.gap
        self.gap = 0
        self.line.append("".join(self.indent[:-1] if self.marker else self.indent) + self.marker)
        self.marker = ""

    def text(self, data: str) -> None:
        words = data.split() if data.isascii() else [w for w in re.split(r"[ \t\n\r\f]+", data) if w]
        if not words:
            self.space = self.space or bool(data)
            return
        if not self.line:
            self._begin()
        elif self.space or data[0] in _BLANK:
            self.line.append(" ")
        self.line.append(" ".join(words))
        self.space = data[-1] in _BLANK

    def raw(self, line: str) -> None:
        if line:
            if not self.line:
                self._begin()
            elif self.space:
                self.line.append(" ")
            self.space = False
            self.line.append(line)

    def end_line(self, gap: int = 0, force: bool = False) -> None:
        if self.line:
            self.lines.append("".join(self.line).rstrip())
            self.line = []
        elif force and self.lines:
            self.gap += 1
        self.space = False
        self.gap = max(self.gap, gap)

    def done(self) -> list[str]:
        self.end_line()
        return self.lines


class Table:
    def __init__(self):
        self.rows: list[list[tuple[list[str], int, int]]] = []

    def cell(self, lines: list[str], node: Node) -> None:
        a = node.attributes()
        span = lambda k: max(1, min(1000, int(a[k]))) if a.get(k, "").isdecimal() and a[k].isascii() else 1
        if not self.rows:
            self.rows.append([])
        self.rows[-1].append((lines, span("colspan"), span("rowspan")))

    def lines(self) -> list[str]:
        held: dict[int, int] = {}
        grid = []
        for row in self.rows:
            placed, c = {}, 0
            for lines, cols, rows in row:
                while held.get(c, 0):
                    c += 1
                placed[c] = (lines, cols)
                for i in range(c, c + cols):
                    held[i] = max(held.get(i, 0), rows)
                c += cols
            held = {c: n - 1 for c, n in held.items() if n > 1}
            grid.append(placed)
        widths: dict[int, int] = {}
        for placed in grid:
            for c, (lines, cols) in placed.items():
                if cols == 1:
                    widths[c] = max(widths.get(c, 0), min(MAX_PAD, max(map(width, lines), default=0)))
        # columns without a cell of their own take no place
        shown = sorted({c for placed in grid for c in placed} | set(widths))
        start, at = {}, 0
        for c in shown:
            start[c] = at
            at += widths.get(c, 0) + 2
        out = []
        for placed in grid:
            for i in range(max((len(lines) for lines, _ in placed.values()), default=0)):
                line, end = "", 0
                for c, (lines, _) in sorted(placed.items()):
                    if i < len(lines) and lines[i]:
                        pad = max(start[c] - end, 2 if line else 0)
                        line += " " * pad + lines[i]
                        end += pad + width(lines[i])
                out.append(line)
        return out


def render(html: str) -> str:
    """The visible text of a page."""
    builder = TreeBuilder()
    root = builder.feed(html.replace("\r\n", "\n").replace("\0", ""))
    rules = builder.rules()
    flows, tables, lists = [Flow()], [], []
    pre = 0
    todo = [(root, iter(root.children), True)]
    while todo:
        node, children, seen = todo[-1]
        flow = flows[-1]
        child = next(children, None)
        if child is not None and node.tag == "details" and (isinstance(child, str) or child.tag != "summary") and "open" not in node.attributes():
            continue
        if isinstance(child, str):
            if not seen:
                continue
            if pre:
                first, *others = child.split("\n")
                flow.raw(first)
                for line in others:
                    flow.end_line(force=True)
                    flow.raw(line)
            else:
                flow.text(child)
            continue
        if child is not None:
            boxed, visibility = styled(child, rules, builder.quirks)
            if not boxed:
                continue
            shown = seen if visibility in (None, "inherit") else visibility not in ("hidden", "collapse")
            tag = child.tag
            if tag == "br":
                flow.end_line(force=True)
                continue
            if tag in _CELLS and tables:
                flows.append(Flow())
            elif tag == "tr" and tables:
                tables[-1].rows.append([])
            elif child.inside == "svg" and tag in ("text", "foreignobject"):
                flow.end_line()
            elif tag in BLOCKS:
                inner = lists and tag in _LISTS
                flow.end_line(1 if tag in SPACED and not inner else 0)
                if tag == "table":
                    tables.append(Table())
                elif tag in _LISTS:
                    start = child.attributes().get("start", "") if tag == "ol" else ""
                    lists.append(int(start) if re.fullmatch(r"-?[0-9]{1,9}", start) else 1 if tag == "ol" else None)
                elif tag == "li":
                    number = lists[-1] if lists else None
                    if number is not None:
                        value = child.attributes().get("value", "")
                        number = int(value) if re.fullmatch(r"-?[0-9]{1,9}", value) else number
                        lists[-1] = number + 1
                    mark = "- " if number is None else f"{number}. "
                    flow.indent.append(" " * len(mark))
                    flow.marker = mark
                elif tag in ("dd", "blockquote"):
                    flow.indent.append("  ")
            if tag in _PREFORMATTED:
                pre += 1
                if child.children and isinstance(child.children[0], str):
                    child.children[0] = child.children[0].removeprefix("\n")
            todo.append((child, iter(child.children), shown))
            continue
        todo.pop()
        tag = node.tag
        pre -= tag in _PREFORMATTED
        if tag in _CELLS and tables:
            tables[-1].cell(flows.pop().done(), node)
        elif node.inside == "svg" and tag in ("text", "foreignobject"):
            flow.end_line()
        elif tag in BLOCKS and not (tag == "tr" and tables):
            if tag == "table":
                for line in tables.pop().lines():
                    flow.raw(line)
                    flow.end_line()
            elif tag in ("li", "dd", "blockquote"):
                flow.end_line()
                flow.indent.pop()
                flow.marker = ""
            elif tag in _LISTS:
                lists.pop()
            inner = lists and tag in _LISTS
            flow.end_line(1 if tag in SPACED and not inner else 0)
    return "\n".join(flows[0].done())


def extract(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, text) of each row of ``pages``.  Null html gives null text, a
    page without visible text an empty one; repeated rows are rendered alike;
    an empty table gives no rows; other columns are not read."""
    slim = pages.select(F.col(key).alias("k"), F.col(html).cast("string").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "t"):
            texts = [None if t is None else render(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["k", "text"])

    return map_batches(slim, run, f"k {pages.schema[key].dataType.simpleString()}, text string").withColumnRenamed("k", key)
