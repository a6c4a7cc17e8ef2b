"""Visible text of web pages, laid out: blocks, lists and tables with aligned cells.

A tree is built from the tags, with the ones that authors leave out; then it is
walked once. Nothing recurses, so pages may nest as deep as they like.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass, field
from html import unescape
from html.parser import HTMLParser
from math import inf

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package
from .common import whole_text


def _names(text: str) -> frozenset[str]:
    return frozenset(text.split())


VOID = _names("area base br col embed hr img input link meta param source track wbr")
HEAD_ONLY = _names("title meta link base style script noscript template")
HIDDEN = _names(
    "head title style script noscript template iframe object embed audio video canvas svg math "
    "datalist map area"
)
HEADINGS = _names("h1 h2 h3 h4 h5 h6")
LISTS = _names("ul ol menu dir")
# Blocks with an empty line around them, and those without.
SPACED = HEADINGS | _names("p blockquote pre table dl figure fieldset hr") | LISTS
PLAIN = _names(
    "address article aside body center dd details dialog div dt figcaption footer form header "
    "hgroup html legend li main nav optgroup option search section summary caption"
)
BLOCKS = SPACED | PLAIN
CELLS = _names("td th")
SECTIONS = _names("thead tbody tfoot")
TABLE_PARTS = CELLS | SECTIONS | _names("tr caption colgroup col")
# A start tag ends these open elements, looked for up to the boundary.
ENDS = {
    "li": (_names("li"), LISTS | CELLS | {"table"}),
    "dt": (_names("dt dd"), _names("dl table") | CELLS),
    "dd": (_names("dt dd"), _names("dl table") | CELLS),
    "option": (_names("option"), _names("select datalist optgroup")),
    "optgroup": (_names("option optgroup"), _names("select datalist")),
    "td": (CELLS | _names("caption colgroup"), _names("tr table")),
    "th": (CELLS | _names("caption colgroup"), _names("tr table")),
    "tr": (CELLS | _names("tr caption colgroup"), _names("table")),
    "thead": (CELLS | SECTIONS | _names("tr caption colgroup"), _names("table")),
    "tbody": (CELLS | SECTIONS | _names("tr caption colgroup"), _names("table")),
    "tfoot": (CELLS | SECTIONS | _names("tr caption colgroup"), _names("table")),
    "body": (_names("head"), frozenset()),
}
ENDS_P = BLOCKS - _names("body html caption option optgroup legend summary")
P_BOUNDARY = CELLS | _names("table caption button object template")
RAW = _names("textarea title")  # what they hold is text up to their end tag
COMMENTS = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
SIMPLE = re.compile(r"(\*|[a-zA-Z][\w-]*)?((?:[.#][\w-]+)*)")
LOOKED_AT = _names("display visibility")
UNFINISHED = re.compile(r"</?[a-zA-Z]|<[!?]")
SPACES = re.compile(r"[ \t\n\r\f]+")
CELL_GAP = "  "
MOST_COLUMNS = 1_000  # what a colspan counts for at most, as browsers limit it
MOST_ROWS = 65_534  # the same of a rowspan
CELL_WIDTH = 80  # lines of a cell are folded to so many characters
MOST_LEVELS = 512  # indents, as many as browsers nest elements
ROMAN = [(1000, "m"), (900, "cm"), (500, "d"), (400, "cd"), (100, "c"), (90, "xc"), (50, "l"), (40, "xl"),
         (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")]


@dataclass(slots=True)
class Node:
    tag: str
    attrs: dict
    children: list = field(default_factory=list)  # nodes and texts


class TreeBuilder(HTMLParser):
    """The tree of a page, with implied tags put in and stray ones left out."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html", {})
        self.open = [self.root]
        self.counts = Counter({"html": 1})
        self.sheets: list[str] = []

    def _push(self, tag: str, attrs: dict) -> None:
        node = Node(tag, attrs)
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)
            self.counts[tag] += 1

    def _pop_to(self, at: int) -> None:
        while len(self.open) > at:
            self.counts[self.open.pop().tag] -= 1

    def _end_open(self, tags: frozenset[str], boundary: frozenset[str]) -> None:
        """Close the outermost of `tags` that is open within the boundary."""
        if not any(self.counts[tag] for tag in tags):
            return
        found = None
        for at in range(len(self.open) - 1, 0, -1):
            tag = self.open[at].tag
            if tag in boundary:
                break
            if tag in tags:
                found = at
        if found is not None:
            self._pop_to(found)

    def _imply(self, tag: str) -> None:
        """Open what stands around `tag` though nobody wrote it."""
        if tag not in HEAD_ONLY and tag not in ("head", "body") and not self.counts["body"]:
            self._end_open(_names("head"), frozenset())
            self._push("body", {})
        if tag in CELLS or tag == "tr":
            if self.open[-1].tag == "table":
                self._push("tbody", {})
            if tag in CELLS and self.open[-1].tag in SECTIONS:
                self._push("tr", {})

    def handle_starttag(self, tag: str, attrs: list) -> None:
        attrs = dict(reversed(attrs))
        if tag in ("html", "body") and self.counts[tag]:
            return
        if tag in ENDS:
            self._end_open(*ENDS[tag])
        if tag in ENDS_P and self.counts["p"]:
            self._end_open(_names("p"), P_BOUNDARY)
        if tag in HEADINGS and self.open[-1].tag in HEADINGS:
            self._pop_to(len(self.open) - 1)
        if tag == "a" and self.open[-1].tag == "a":
            self._pop_to(len(self.open) - 1)
        self._imply(tag)
        self._push(tag, attrs)
        if tag in RAW:
            self.set_cdata_mode(tag)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)  # a slash closes nothing but void elements

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.handle_starttag("br", [])
        elif tag == "p" and not self.counts["p"]:
            self.handle_starttag("p", [])
            self._pop_to(len(self.open) - 1)
        elif self.counts[tag] and tag not in ("html", "body"):
            boundary = frozenset() if tag in TABLE_PARTS or tag == "table" else CELLS | {"table"}
            for at in range(len(self.open) - 1, 0, -1):
                own = self.open[at].tag
                if own == tag:
                    self._pop_to(at)
                    break
                if own in boundary:
                    break

    def handle_data(self, data: str) -> None:
        own = self.open[-1]
        if own.tag == "style" and _is_for_screens(own.attrs.get("media")):
            self.sheets.append(data)
        elif own.tag in RAW:
            data = unescape(data)
        if not self.counts["body"] and self.open[-1].tag in ("html", "head") and data.strip():
            self._imply("text")
        self.open[-1].children.append(data)


def tree_of(html: str) -> Node:
    return built(html).root


def built(html: str) -> TreeBuilder:
    builder = TreeBuilder()
    builder.feed(html)
    if builder.cdata_elem in RAW:
        builder.handle_data(builder.rawdata)
    if builder.cdata_elem in RAW or UNFINISHED.match(builder.rawdata):
        builder.rawdata = ""  # a tag or comment that the page's end cuts off
    builder.close()
    return builder


def _is_for_screens(media: str | None) -> bool:
    return not (media or "").strip() or any(
        part.strip().lower() in ("all", "screen") for part in media.split(","))


def declarations(style: str) -> dict[str, tuple[bool, str]]:
    """The last value of each property looked at and whether it is important; that wins."""
    found: dict[str, tuple[bool, str]] = {}
    for part in COMMENTS.sub(" ", style).split(";"):
        name, colon, value = part.partition(":")
        name, value = name.strip().lower(), value.strip().lower()
        if not colon or name not in LOOKED_AT:
            continue
        value, mark, importance = value.partition("!")
        important = mark == "!" and importance.strip() == "important"
        if value.strip() and important >= found.get(name, (False, ""))[0]:
            found[name] = (important, value.strip())
    return found


class Sheet:
    """The rules of a page's style elements that say what shows.

    Selectors are a tag, classes and ids written together, and lists of those;
    others, such as those with ancestors or states, and rules inside blocks
    that begin with @ are not followed.
    """

    def __init__(self, sheets: list[str]):
        self.rules = defaultdict(list)  # by the id, class or tag that a selector needs
        order = 0
        for sheet in sheets:
            for selectors, body in _plain_rules(COMMENTS.sub(" ", sheet)):
                said = declarations(body)
                for selector in selectors.split(",") if said else ():
                    found = SIMPLE.fullmatch(selector.strip())
                    if not found or not selector.strip():
                        continue
                    tag = (found[1] or "*").lower()
                    parts = frozenset(re.findall(r"[.#][\w-]+", found[2]))
                    ids = sum(part[0] == "#" for part in parts)
                    rank = (ids, len(parts) - ids, tag != "*", order)
                    self.rules[min(parts, default=tag)].append((rank, tag, parts, said))
                    order += 1

    def said(self, node: Node) -> dict[str, str]:
        """Display and visibility of an element, as far as its style and the rules give them."""
        own = declarations(node.attrs.get("style") or "")
        if not self.rules:
            return {name: value for name, (_, value) in own.items()}
        marks = {f".{name}" for name in (node.attrs.get("class") or "").split()}
        marks.add(f"#{node.attrs.get('id') or ''}")
        found = []
        for key in (node.tag, "*", *marks):
            for rank, tag, parts, said in self.rules.get(key, ()):
                if tag in ("*", node.tag) and parts <= marks:
                    found += [(name, (important, 0, rank), value) for name, (important, value) in said.items()]
        found += [(name, (important, 1, ()), value) for name, (important, value) in own.items()]
        return {name: value for name, _, value in sorted(found, key=lambda item: item[1])}


def _plain_rules(sheet: str):
    """Selectors and bodies of the rules that stand outside @ blocks."""
    at = 0
    while found := re.compile(r"[^{};]*[{;]").match(sheet, at):
        head = found[0].strip()
        at = found.end()
        if head.endswith(";"):
            continue
        depth = 1
        begin = at
        for brace in re.compile(r"[{}]").finditer(sheet, at):
            depth += 1 if brace[0] == "{" else -1
            if not depth:
                break
        else:
            return
        at = brace.end()
        if not head.startswith("@"):
            yield head[:-1], sheet[begin:brace.start()]


def is_there(node: Node, said: dict[str, str]) -> bool:
    """Whether an element takes part in the page at all."""
    attrs = node.attrs
    if node.tag in HIDDEN or said.get("display") == "none":
        return False
    if "display" not in said and ("hidden" in attrs or node.tag == "dialog" and "open" not in attrs):
        return False
    if node.tag == "input":
        return (attrs.get("type") or "").lower() in ("submit", "button", "reset")
    return True


def numeral(number: int, kind: str) -> str:
    """A list number as `type` says: 1, a, A, i or I."""
    if kind in ("a", "A") and number > 0:
        out = ""
        while number:
            number, letter = divmod(number - 1, 26)
            out = chr(ord(kind) + letter) + out
        return out
    if kind in ("i", "I") and 0 < number < 4000:
        out = ""
        for value, letters in ROMAN:
            out += letters * (number // value)
            number %= value
        return out if kind == "i" else out.upper()
    return str(number)


def folded(line: str, width: int) -> list[str]:
    """A line as several of at most `width` characters, cut at spaces where there are any."""
    out = []
    while len(line) > width:
        at = line.rfind(" ", 1, width + 1)
        lead = len(line) - len(line.lstrip(" "))
        if at <= lead:
            at = width
        out.append(line[:at].rstrip(" "))
        line = line[at:].lstrip(" ")
    return [*out, line]


class Page:
    """Lines of text: inline runs, blocks with or without an empty line around, indents."""

    def __init__(self):
        self.lines: list[str] = []
        self.run: list[str] = []
        self.indents: list[str] = []
        self.mark: str | None = None
        self.empty_line = False  # one is due before the next line
        self.leads = False  # one was due before the first line

    def text(self, data: str) -> None:
        data = SPACES.sub(" ", data)
        if self.run and self.run[-1].endswith((" ", "\n")) or not self.run:
            data = data.removeprefix(" ")
        if data:
            self.run.append(data)

    def end_line(self) -> None:
        line = "".join(self.run).strip(" ")
        self.run = []
        if line:
            self.line(line)

    def line(self, line: str) -> None:
        if self.empty_line and self.lines:
            self.lines.append("")
        elif self.empty_line:
            self.leads = True
        self.empty_line = False
        indent = "".join(self.indents)
        if self.mark is not None:
            indent = indent[:len(indent) - len(self.mark)] + self.mark
            self.mark = None
        self.lines.append((indent + line).rstrip(" "))

    def block(self, spaced: bool) -> None:
        self.end_line()
        if spaced and self.mark is None:
            self.empty_line = True

    def begin_item(self, mark: str) -> None:
        self.end_line()
        if self.mark is not None:  # the item before had no text
            self.line("")
        self.indents.append(" " * len(mark) if len(self.indents) < MOST_LEVELS else "")
        self.mark = mark

    def end_item(self) -> None:
        self.end_line()
        if self.mark is not None:
            self.line("")
        self.indents.pop()

    def done(self) -> str:
        self.end_line()
        return "\n".join(self.lines)


@dataclass(slots=True)
class Table:
    rows: list = field(default_factory=list)  # of (column, columns, lines, empty line before, after)
    covered: dict = field(default_factory=dict)  # the first row not covered from above, by column
    column: int = 0
    captions: list = field(default_factory=list)

    def begin_row(self) -> None:
        self.rows.append([])
        self.column = 0

    def end_group(self) -> None:
        """No cell reaches over the end of its thead, tbody or tfoot."""
        self.covered = {}

    def cell(self, page: Page, columns: int, rows: int) -> None:
        """Put a cell into the next free column; 0 rows go on to the end of the row group."""
        page.end_line()
        lines = [line.expandtabs() for line in page.lines] if any(page.lines) else []
        if not self.rows:
            self.begin_row()
        row = len(self.rows) - 1
        while self.covered.get(self.column, 0) > row:
            self.column += 1
        self.rows[-1].append((self.column, columns, lines, page.leads, page.empty_line))
        if rows != 1:
            until = row + rows if rows else inf
            self.covered |= dict.fromkeys(range(self.column, self.column + columns), until)
        self.column += columns

    def written(self) -> list[str]:
        """The rows, cells of a column one below the other.

        A row has as many lines as its tallest cell; lines of more than
        CELL_WIDTH characters are folded. A cell over several columns does not
        widen its column; what follows it in its line moves on. Where only one
        column has text, its cells are blocks with their own empty lines around.
        """
        used = sorted({column for row in self.rows for column, _, own, _, _ in row if own})
        if len(used) == 1:
            whole = Page()
            for row in self.rows:
                for _, _, own, before, after in row:
                    if own:
                        whole.empty_line |= before
                        for line in own:
                            whole.line(line)
                        whole.empty_line = after
            return whole.lines
        widths: Counter = Counter()
        rows = []
        for row in self.rows:
            rows.append([])
            for column, columns, own, _, _ in row:
                own = [part for line in own for part in folded(line, CELL_WIDTH)]
                rows[-1].append((column, own))
                if columns == 1:
                    widths[column] = max(widths[column], *map(len, own), 0)
        lines = []
        for row in rows:
            cells = {column: own for column, own in row if own}
            for at in range(max(map(len, cells.values()), default=0)):
                texts = {column: own[at] for column, own in cells.items() if at < len(own)}
                line = CELL_GAP.join(texts.get(column, "").ljust(widths[column]) for column in used)
                lines.append(line.rstrip())
        return lines


def _span(node: Node, name: str, least: int, most: int) -> int:
    found = re.match(r"\s*\+?0*([0-9]{1,9})", node.attrs.get(name) or "")
    return min(max(int(found[1]), least), most) if found else 1


def _items(node: Node) -> int:
    return sum(isinstance(child, Node) and child.tag == "li" for child in node.children)


def _number(node: Node, name: str) -> int | None:
    found = re.match(r"\s*([-+]?\d{1,9})", node.attrs.get(name) or "")
    return int(found[1]) if found else None


def render(root: Node, sheet: Sheet | None = None) -> str:
    """The visible text of a tree."""
    sheet = sheet or Sheet([])
    pages, tables, lists = [Page()], [], []
    # a node, whether it is entered, whether visibility lets its text show
    steps: list = [(root, True, True)]
    pre = 0
    while steps:
        node, entering, shown = steps.pop()
        page = pages[-1]
        if isinstance(node, str):
            if not shown:
                continue
            if pre:
                first, *others = node.replace("\r\n", "\n").split("\n")
                page.run.append(first)
                for line in others:
                    page.line("".join(page.run))
                    page.run = [line]
            else:
                page.text(node)
            continue
        tag = node.tag
        if entering:
            said = sheet.said(node)
            if not is_there(node, said):
                continue
            if said.get("visibility", "inherit") != "inherit":
                shown = said["visibility"] not in ("hidden", "collapse")
            steps.append((node, False, shown))
            children = node.children
            if tag == "details" and "open" not in node.attrs:
                children = [c for c in children if isinstance(c, Node) and c.tag == "summary"]
            steps.extend((child, True, shown) for child in reversed(children))
            if tag == "br":
                if page.run:
                    page.end_line()
                else:
                    page.empty_line = bool(page.lines)
            elif tag == "hr":
                page.block(True)
            elif tag == "input":
                page.text(node.attrs.get("value") or "" if shown else "")
            elif tag in CELLS and tables:
                pages.append(Page())
            elif tag == "caption" and tables:
                pages.append(Page())
            elif tag == "tr" and tables:
                tables[-1].begin_row()
            elif tag == "table":
                page.block(True)
                tables.append(Table())
            elif tag in LISTS:
                page.block(not lists)
                backwards = tag == "ol" and "reversed" in node.attrs
                start = _number(node, "start")
                if start is None:
                    start = _items(node) if backwards else 1
                kind = (node.attrs.get("type") or "1").strip() if tag == "ol" else ""
                lists.append([kind, start, -1 if backwards else 1])
            elif tag == "li":
                mark = "- "
                if lists and lists[-1][0]:
                    own = _number(node, "value")
                    number = lists[-1][1] if own is None else own
                    mark = f"{numeral(number, (node.attrs.get('type') or lists[-1][0]).strip())}. "
                    lists[-1][1] = number + lists[-1][2]
                page.begin_item(mark)
                if not shown:
                    page.mark = None
            elif tag == "dd":
                page.end_line()
                page.indents.append("  " if len(page.indents) < MOST_LEVELS else "")
            elif tag in BLOCKS:
                page.block(tag in SPACED)
            if tag == "pre":
                pre += 1
                if children and isinstance(children[0], str):  # a line end right behind the tag
                    steps[-1] = (children[0].removeprefix("\n"), True, shown)
            continue
        if tag == "pre":
            pre -= 1
            line, page.run = "".join(page.run), []
            if line.strip():
                page.line(line)
        if tag in CELLS and tables:
            columns, rows = _span(node, "colspan", 1, MOST_COLUMNS), _span(node, "rowspan", 0, MOST_ROWS)
            tables[-1].cell(pages.pop(), columns, rows)
        elif tag in SECTIONS and tables:
            tables[-1].end_group()
        elif tag == "caption" and tables:
            tables[-1].captions.append(pages.pop().done())
        elif tag == "table":
            table = tables.pop()
            captions = [line for text in table.captions if text for line in text.split("\n")]
            for line in [*captions, *table.written()]:
                page.line(line)
            page.block(True)
        elif tag in LISTS:
            lists.pop()
            page.block(not lists)
        elif tag == "li":
            page.end_item()
        elif tag == "dd":
            page.end_line()
            page.indents.pop()
        elif tag in BLOCKS:
            page.block(tag in SPACED)
    return pages[0].done()


def visible_text(html: str | None) -> str:
    page = built(html or "")
    return render(page.root, Sheet(page.sheets))


@F.pandas_udf(T.StringType())
def _rendered(pages: pd.Series) -> pd.Series:
    return pd.Series([visible_text(html) for html in pages], dtype="object")


def page_texts(pages: DataFrame) -> DataFrame:
    """page_id and `text`, all that shows of the html, for every row of `pages`.

    Lines follow blocks and line breaks; paragraphs, headings, lists and tables
    have an empty line around them; list items have their mark and indent, cells
    of a table column begin at one place and keep their own lines, folded at 80
    characters. Scripts, heads, comments and whatever is hidden by tag,
    attribute, style or the page's style elements (see `Sheet`) are left out. Cut off
    or wrongly nested markup is mended as browsers do. NULL and empty pages give
    an empty text. Rows stay as they are, repeated ones and NULL ids too; other
    columns are not looked at.
    """
    ship_package(pages.sparkSession)
    return pages.select("page_id", _rendered(whole_text("html")).alias("text"))
