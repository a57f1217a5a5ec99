"""HTML extraction by layout-aware rendering.

A page becomes a tree - with the end tags that HTML lets authors leave out - and the tree becomes
text: blocks on lines of their own with blank lines where they have margins, list items with
bullets or numbers and indents, table cells in aligned columns, ``pre`` as it stands.  Invisible
content is left out: head, scripts, styles, templates, ``hidden``, ``display:none``,
``visibility:hidden``, closed details and dialogs.  Rules of style sheets are not read, so what only a class hides is shown.

Time and text are in proportion to the page, whatever its markup: open elements are looked up by name, spans of
rows are kept as intervals, and three layout rules bound what nesting and padding add: lines are indented by
``MAX_INDENT`` columns at most, the cells of tables in more than ``MAX_TABLES`` tables are blocks, and a table whose padding
would be ``MOST_SHARE`` times its text has its cells on lines of their own.  No rule drops text.

Defined cases: a null or empty page gives empty text; broken markup never fails (a tag that the
page's end cuts off, with no > after it, is dropped, quotes that open no value are ordinary characters, stray
end tags are ignored); pages of any size and depth are rendered
whole, without recursion; repeated rows are rendered each for itself; an empty table gives an empty result; other
columns, clashing names included, are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right, insort
from collections import Counter, defaultdict
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerloom.llm.common import map_arrow, schema_of

# As browsers read tags: a quote opens a value only after =, and only if it is closed; else it is an ordinary character.
MARKUP = re.compile(r"""<!--(?:.*?-->|.*+)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[\s/]++|[^\s/>][^\s/>=]*+"""
                    r"""(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]++)?+)?+)*+)>|<[!?/][^>]*>""", re.S)
#: Tags up to the next >, for a page whose quotes leave no > outside them.
LOOSE = re.compile(r"<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>[^>]*)>")
TAG_START = re.compile(r"</?[a-zA-Z]|<[!?]")
ATTR = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s>]++))?+)?+""")
BLANKS = re.compile(r"[ \t\n\f\r]+")
HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*(hidden|collapse)", re.I)
SHOWN_STYLE = re.compile(r"visibility\s*:\s*visible", re.I)

# Fixed values of HTML: element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
UNSEEN = frozenset("head script style template noscript title meta link iframe noembed noframes object datalist audio "
                   "video canvas".split())
MARGIN = {"p": 1, "h1": 1, "h2": 1, "h3": 1, "h4": 1, "h5": 1, "h6": 1, "ul": 1, "ol": 1, "dl": 1, "pre": 1, "xmp": 1,
          "blockquote": 1, "table": 1, "figure": 1, "menu": 1, "dir": 1, "fieldset": 1, "hr": 1,
          **dict.fromkeys("html body div section article aside header footer main nav address form li dt dd center "
                          "figcaption details summary dialog hgroup search legend caption option optgroup".split(), 0)}
#: What a head may hold; any other start tag ends an open one, as its end tag may be left out.
HEAD_PARTS = frozenset("base link meta title script style template noscript noframes".split())
LISTS = frozenset(("ul", "ol", "menu", "dir"))
CELLS, ROW_GROUPS = frozenset(("td", "th")), frozenset(("thead", "tbody", "tfoot"))
TABLE_PARTS = CELLS | ROW_GROUPS | {"tr", "caption", "colgroup"}
#: Start tags that end an open <p>.
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer "
                   "form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul "
                   "li dt dd xmp".split())
SCOPE = frozenset(("table", "td", "th", "caption", "html", "template", "object"))
#: What a start tag ends if it is open: (elements, where to stop looking).
IMPLIED = {"li": (frozenset(("li",)), LISTS), "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
           "dd": (frozenset(("dt", "dd")), frozenset(("dl",))), "option": (frozenset(("option",)), frozenset(("select",))),
           "optgroup": (frozenset(("option", "optgroup")), frozenset(("select",))),
           "td": (CELLS | {"caption"}, frozenset(("table",))), "th": (CELLS | {"caption"}, frozenset(("table",))),
           "tr": (CELLS | {"tr", "caption", "colgroup"}, frozenset(("table",))),
           **dict.fromkeys(ROW_GROUPS, (CELLS | ROW_GROUPS | {"tr", "caption", "colgroup"}, frozenset(("table",))))}
#: The most columns and rows that a cell spans.
MAX_SPAN = {"colspan": 1000, "rowspan": 65_534}
MAX_INDENT, MAX_TABLES = 40, 32
#: Columns are narrowed, down to LEAST_WIDTH, where their padding would be more than PAD_SHARE times the table's text.
LEAST_WIDTH, PAD_SHARE, MOST_SHARE = 40, 16, 256


class Node:
    __slots__ = ("attrs", "children", "name")

    def __init__(self, name: str, attrs: str = ""):
        self.name, self.attrs, self.children = name, attrs, []

    def get(self, key: str) -> str | None:
        for m in ATTR.finditer(self.attrs):
            if m[1].lower() == key:
                return unescape(m[2] or m[3] or m[4] or "")
        return None


class Tree:
    """Builds the tree.  ``at`` holds where on the stack the open elements of a name are, lowest first, so no tag
    walks down the stack."""

    def __init__(self):
        self.root = Node("html")
        self.stack, self.at = [self.root], defaultdict(list, html=[0])

    def pop(self) -> None:
        self.at[self.stack.pop().name].pop()

    def push(self, node: Node) -> None:
        self.stack[-1].children.append(node)
        self.at[node.name].append(len(self.stack))
        self.stack.append(node)

    def top(self, names) -> int:
        """Where the innermost open element of ``names`` is; 0, the root, if there is none."""
        return max((self.at[n][-1] for n in names if self.at.get(n)), default=0)

    def cut(self, height: int) -> None:
        while len(self.stack) > height:
            self.pop()

    def end(self, names: frozenset | set, stop: frozenset) -> None:
        """Ends the outermost open element of ``names`` above the innermost one of ``stop``."""
        if open_ := [self.at[n] for n in names if self.at.get(n)]:
            floor = self.top(stop)
            self.cut(min((x[bisect_right(x, floor)] for x in open_ if x[-1] > floor), default=len(self.stack)))

    def leave_head(self) -> None:
        while self.stack[-1].name == "head":
            self.pop()

    def start(self, name: str, attrs: str) -> None:
        if name == "html":
            return
        if name not in HEAD_PARTS:
            self.leave_head()
        if name in ENDS_P and self.at["p"]:
            self.end({"p"}, SCOPE)
        if name in IMPLIED:
            self.end(*IMPLIED[name])
        if name in CELLS and self.at["table"] and self.top(("tr",)) <= self.top(("table", "td", "th")):
            self.push(Node("tr"))
        if name == "body":
            self.end({"head"}, frozenset())
        if name in VOID:
            self.stack[-1].children.append(Node(name, attrs))
        else:
            self.push(Node(name, attrs))

    def finish(self, name: str) -> None:
        if name == "br":
            self.leave_head()
            self.stack[-1].children.append(Node("br"))
        elif name == "p" and not self.at["p"]:
            self.stack[-1].children.append(Node("p"))
        elif self.at.get(name) and name not in ("html", "body"):
            stop = frozenset(("table",)) if name in TABLE_PARTS else frozenset() if name == "table" else SCOPE - {name}
            if self.at[name][-1] > self.top(stop):
                self.cut(self.at[name][-1])

    def text(self, raw: str) -> None:
        if self.stack[-1].name == "head" and raw.strip(" \t\n\f\r"):
            self.leave_head()
        self.stack[-1].children.append(unescape(raw) if "&" in raw else raw)


def parse(html: str) -> Node:
    tree, at, n = Tree(), 0, len(html)
    loose = False
    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            tree.text(html[at:])
            break
        m = loose and LOOSE.match(html, lt) or MARKUP.match(html, lt)
        if not m and (m := LOOSE.match(html, lt)):
            loose = True  # for the rest of the page, so that only one tag is read to the page's end
        if not m:
            if TAG_START.match(html, lt):  # cut off by the end of the page
                if lt > at:
                    tree.text(html[at:lt])
                break
            nxt = html.find("<", lt + 1)
            nxt = n if nxt < 0 else nxt
            tree.text(html[at:nxt])
            at = nxt
            continue
        if lt > at:
            tree.text(html[at:lt])
        at = m.end()
        name = (m["name"] or "").lower()
        if name and m["end"]:
            tree.finish(name)
        elif name:
            tree.start(name, m["attrs"])
            if name in RAW:
                close = re.compile(f"</{name}(?=[\\s/>])[^>]*>?", re.I).search(html, at)
                body = html[at:close.start() if close else n]
                if name in ("textarea", "title"):
                    tree.text(body)
                else:
                    tree.stack[-1].children.append(body)
                at = close.end() if close else n
                tree.pop()
    return tree.root


class Page:
    """Lines of text.  ``gap`` blank lines are due before the next one."""

    def __init__(self):
        self.lines: list[str] = []
        self.now: list[str] = []
        self.indent, self.marker, self.gap, self.space = 0, "", 0, False
        self.as_is = False  # whether the line is one of a ``pre``

    def text(self, raw: str) -> None:
        words = BLANKS.sub(" ", raw)
        if not self.now or self.space:
            words = words.lstrip(" ")
        if words:
            self.now.append(words)
            self.space = words[-1] == " "
        elif raw and self.now:
            self.space = True

    def flush(self) -> bool:
        """Ends the line; whether there was any."""
        line = "".join(self.now)
        line = line.expandtabs(8).rstrip() if self.as_is else line.strip(" ")
        self.now, self.space, self.as_is = [], False, False
        if line:
            self.put(line)
        return bool(line)

    def put(self, line: str) -> None:
        if self.lines and self.gap:
            self.lines += [""] * self.gap
        self.gap = 0
        lead = " " * min(self.indent - len(self.marker), MAX_INDENT) + self.marker
        self.marker = ""
        self.lines.append((lead + line).rstrip(" "))

    def block(self, margin: int) -> None:
        self.flush()
        self.gap = max(self.gap, margin)

    def line_break(self) -> None:
        if self.now:
            self.flush()
        elif self.lines and not self.gap:
            self.lines.append("")

    def literal(self, raw: str) -> None:
        """Text of a ``pre``: only a line feed ends the line, so inline elements stay on theirs."""
        for k, part in enumerate(raw.split("\n")):
            if k and not self.flush() and self.lines and not self.gap:
                self.put("")
            self.now.append(part)
            self.as_is = True

    def result(self) -> list[str]:
        self.flush()
        out = self.lines
        while out and not out[-1]:
            out.pop()
        return out


def _span(node: Node, key: str) -> int:
    value = (node.get(key) or "") if key in node.attrs.lower() else ""
    return min(int(value), MAX_SPAN[key]) if value.isascii() and value.isdigit() and 0 < len(value) < 6 and int(value) else 1


class Below:
    """The columns that cells of earlier rows take, as intervals that do not overlap: by first column, the column after
    the last and the row from which they are free.  ``far`` joins neighbours, so that they are passed in one step."""

    def __init__(self):
        self.starts: list[int] = []
        self.taken: dict[int, tuple[int, int]] = {}
        self.far: dict[int, tuple[int, int]] = {}

    def drop(self, start: int) -> None:
        del self.taken[start]
        del self.starts[bisect_left(self.starts, start)]

    def free(self, at: int, row: int) -> int:
        """The first column from ``at`` on that is free in ``row``."""
        passed = []
        while self.starts:
            hop = self.far.get(at)
            if hop is None or hop[1] <= row:
                k = bisect_right(self.starts, at) - 1
                if k < 0:
                    break
                hop = self.taken[self.starts[k]]
                if hop[1] <= row:
                    self.drop(self.starts[k])
                    continue
                if hop[0] <= at:
                    break
            passed.append((at, hop[1]))
            at = hop[0]
        until = 1 << 60
        for start, ends in reversed(passed):
            until = min(until, ends)
            self.far[start] = (at, until)
        return at

    def take(self, start: int, end: int, until: int) -> None:
        """Takes the columns of a cell whose first is free; the cell goes before what it overlaps."""
        while (k := bisect_left(self.starts, start)) < len(self.starts) and (old := self.starts[k]) < end:
            rest = self.taken[old]
            self.drop(old)
            if rest[0] > end:
                insort(self.starts, end)
                self.taken[end] = rest
            if until < rest[1]:
                self.far.clear()
        insort(self.starts, start)
        self.taken[start] = (end, until)


def _starts(widths: dict[int, int], spans: dict[int, dict[int, int]], columns: list[int], most: int) -> dict[int, int]:
    """Where each column starts, if no cell is wider than ``most``.  ``spans``: by column, the widths of the cells
    over several columns that end there, by their first column."""
    starts, x = {}, 0
    for c in columns:
        starts[c] = x = max(x, *(starts[a] + min(n, most) + 2 for a, n in spans[c].items())) if c in spans else x
        x += min(widths[c], most) + 2 if widths.get(c) else 0
    return starts


def _table_lines(rows: list[list[tuple[list[str], int, int]]]) -> list[str]:
    """Rows of (lines, columns, rows) cells as aligned lines; a column is as wide as its widest cell.  Where that would
    make a long text of a short one, columns are narrower, and what follows a longer cell has a line of its own."""
    placed, below, widths, spans = [], Below(), {}, {}
    size, deep = 0, Counter()  # characters of the table, lines by column
    for k, row in enumerate(rows):
        at, line, wide, kept = 0, [], None, []
        for cell, across, down in row:
            at = below.free(at, k)
            line.append((at, cell))
            if wide:
                ends = spans.setdefault(at, {})
                ends[wide[0]] = max(ends.get(wide[0], 0), wide[1])
            wide = (at, max(map(len, cell))) if cell and across > 1 else None
            if down > 1:
                kept.append((at, at + across, k + down))
            if cell:
                if across == 1:
                    widths[at] = max(widths.get(at, 0), max(map(len, cell)))
                size += sum(len(x) - x.count(" ") for x in cell)
                deep[at] += len(cell)
            at += across
        for cell in kept:
            below.take(*cell)
        placed.append(line)
    columns = sorted({c for line in placed for c, _ in line} | set(widths))
    most = max([*widths.values(), *(n for x in spans.values() for n in x.values())], default=0)
    starts = _starts(widths, spans, columns, most)
    while most > LEAST_WIDTH and sum(n * starts[c] for c, n in deep.items()) > PAD_SHARE * size:
        most = max(LEAST_WIDTH, most // 2)
        starts = _starts(widths, spans, columns, most)
    if sum(n * starts[c] for c, n in deep.items()) > MOST_SHARE * size:
        starts = dict.fromkeys(starts, 0)
    out = []
    for line in placed:
        for k in range(max((len(cell) for _, cell in line), default=0)):
            text, line = "", [x for x in line if k < len(x[1])]
            for c, cell in line:
                if cell[k]:
                    if text and len(text) >= starts[c]:
                        out.append(text)
                        text = ""
                    text = text.ljust(starts[c]) + cell[k]
            out.append(text)
    return out


def render(html: str | None) -> str:
    """The visible text of a page."""
    pages, lists, tables = [Page()], [], []
    pre = 0
    # (node, whether it ends here, whether its surroundings are visible)
    work: list[tuple] = [(parse(html or ""), False, True)]
    while work:
        node, ends, visible = work.pop()
        page = pages[-1]
        if isinstance(node, str):
            if visible:
                page.literal(node) if pre else page.text(node)
            continue
        name = node.name
        if not ends:
            if name in UNSEEN:
                continue
            if node.attrs:
                low = node.attrs.lower()
                if "hidden" in low and node.get("hidden") is not None:
                    continue
                if "style" in low and (style := node.get("style")):
                    if m := HIDDEN_STYLE.search(style):
                        if not m[1]:
                            continue
                        visible = False
                    elif SHOWN_STYLE.search(style):
                        visible = True
            if name == "dialog" and node.get("open") is None:
                continue
            if name == "br":
                if visible:
                    page.literal("\n") if pre else page.line_break()
                continue
            if name == "table":
                page.block(1)
                tables.append([] if len(tables) < MAX_TABLES else None)
            elif tables and tables[-1] is None and (name == "tr" or name in CELLS):
                page.block(0)
            elif name == "tr" and tables:
                tables[-1].append([])
            elif name in CELLS and tables and tables[-1]:
                pages.append(Page())
            elif name in MARGIN:
                page.block(0 if name in LISTS and lists else MARGIN[name])
            if name in LISTS:
                start = node.get("start") if name == "ol" else None
                lists.append([name, int(start) if start and re.fullmatch(r"-?\d{1,9}", start) else 1])
            elif name == "li":
                kind = lists[-1] if lists and lists[-1][0] != "item" else ["ul", 1]
                marker = f"{kind[1]}. " if kind[0] == "ol" else "- "
                kind[1] += 1
                page.indent += len(marker)
                page.marker = marker
                lists.append(["item", len(marker)])
            elif name in ("dd", "blockquote"):
                page.indent += 2
            elif name in ("pre", "xmp"):
                pre += 1
            work.append((node, True, visible))
            children = node.children
            if name == "details" and node.get("open") is None:
                children = [c for c in children if isinstance(c, Node) and c.name == "summary"][:1]
            work += [(c, False, visible) for c in reversed(children)]
            continue
        if name == "table":
            rows = tables.pop()
            page.flush()
            for line in _table_lines(rows or []):
                page.put(line)
            page.block(1)
        elif tables and tables[-1] is None and (name == "tr" or name in CELLS):
            page.block(0)
        elif name in CELLS and tables and tables[-1] and len(pages) > 1:
            pages.pop()
            tables[-1][-1].append((page.result(), _span(node, "colspan"), _span(node, "rowspan")))
        elif name in MARGIN:
            page.block(0 if name in LISTS and len(lists) > 1 else MARGIN[name])
        if name in LISTS:
            lists.pop()
        elif name == "li":
            page.indent, page.marker = page.indent - lists.pop()[1], ""
        elif name in ("dd", "blockquote"):
            page.indent -= 2
        elif name in ("pre", "xmp"):
            pre -= 1
    return "\n".join(pages[0].result()).replace("\xa0", " ")


def visible_text(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, text, n_chars."""

    def worker():
        def each(batch: pa.RecordBatch) -> dict:
            found = [render(x) for x in batch.column("html").to_pylist()]
            return {"page_id": batch.column("page_id"), "text": found, "n_chars": [len(x) for x in found]}
        return each

    return map_arrow(pages.select("page_id", "html"), worker,
                     schema_of(pages, ["page_id"], ("text", T.StringType()), ("n_chars", T.LongType())))
