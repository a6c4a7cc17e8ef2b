"""Rendered pages: layouts by hand, and all words against a flat reading."""

import html
import random
import re

import pytest

from tallyweave.llm.html_text import page_texts, tree_of, visible_text

SCHEMA = "page_id long, url string, html string, text string"

LAYOUTS = {
    "": "",
    "plain &amp; simple": "plain & simple",
    "<h1>Title</h1>one<br>two<p>three <b>bold</b>\n  word": "Title\n\none\ntwo\n\nthree bold word",
    "<div>a</div><div>b</div><p>c": "a\nb\n\nc",
    "<p>a<p>b<div>c</div>d": "a\n\nb\n\nc\nd",
    "<ul><li>a<li>b<ol start=3><li>x<li>y</ol><li>c</ul>z": "- a\n- b\n  3. x\n  4. y\n- c\n\nz",
    "<ul><li><p>a</p><p>b</p></li><li></li></ul>": "- a\n\n  b\n\n-",
    "<table><tr><th>Name<th>Size<tr><td>ab<td>1<tr><td>c<td>100</table>": "Name  Size\nab    1\nc     100",
    "<table><caption>T</caption><td>a<td rowspan=2>b<tr><td>c<tr><td colspan=2>wide cell<tr><td>e<td>f</table>":
        "T\na  b\nc\nwide cell\ne  f",
    "<table><tr><td>a</td></tr></table>after": "a\n\nafter",
    "<head><title>no</title></head><style>p{}</style><script>var t='</p>';</script><p>yes": "yes",
    "a<span hidden>b</span><span style='display: NONE'>c</span><!-- d --><template>e</template>f": "af",
    "<details><summary>s</summary>no</details><details open><summary>t</summary>yes</details>": "s\nt\nyes",
    "<pre>\n  x\n    y\n\nz</pre>w": "  x\n    y\n\nz\n\nw",
    "<dl><dt>t<dd>d1<dd>d2</dl>": "t\n  d1\n  d2",
    "</div>a<b>x</i>y</b> 1 < 2": "axy 1 < 2",
    "a<!-- cut": "a",
    "<p>cut off <a href='x": "cut off",
    "<input type=hidden value=h><input type=submit value=Go><input value=typed>": "Go",
    "a&nbsp;b&#8212;c &unknown; &lt;d&gt;": "a\xa0b—c &unknown; <d>",
}


@pytest.mark.parametrize("page", LAYOUTS)
def test_layout(page):
    assert visible_text(page) == LAYOUTS[page]


def test_implied_tags():
    def tags(node):
        return [node.tag, [tags(child) for child in node.children if not isinstance(child, str)]]

    assert tags(tree_of("<title>t</title><table><td>x")) == ["html", [
        ["title", []], ["body", [["table", [["tbody", [["tr", [["td", []]]]]]]]]]]]


def test_depth_and_size():
    assert visible_text("<div>" * 100_000 + "x") == "x"
    assert visible_text("<ul><li>" * 3_000 + "y").endswith("y")
    assert visible_text("<p>word " * 50_000).count("word") == 50_000
    wide = "<table>" + "<tr><td>a<td>b" * 5_000 + f"<tr><td>{'x' * 100_000}<td>c</table>"
    assert len(visible_text(wide)) < 700_000


def flat(page):
    page = re.sub(r"(?is)<!--.*?-->|<(script|style|head)\b.*?</\1>", " ", page)
    return html.unescape(re.sub(r"(?s)<[^>]*>", " ", page)).split()


def test_all_words_of_the_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    source = {row.page_id: row.html for row in pages.collect()}
    for row in page_texts(pages).collect():
        words = [word for word in row.text.split() if word != "-"]
        assert words == [word for word in flat(source[row.page_id]) if word != "-"]


def test_rows(spark):
    data = [(1, "u", None, "x"), (None, None, "<p>a", None), (None, None, "<p>a", None), (2, "u", "", "x")]
    got = sorted((str(r.page_id), r.text) for r in page_texts(spark.createDataFrame(data, SCHEMA)).collect())
    assert got == [("1", ""), ("2", ""), ("None", "a"), ("None", "a")]
    assert page_texts(spark.createDataFrame([], SCHEMA)).count() == 0


SHOWN = {
    "<p style='display:none;display:block'>a": "a",
    "<p style='x-display:none-ish'>a": "a",
    "<p style='display:none !important;display:block'>a</p>b": "b",
    "<div style='visibility:hidden'>a<p style='visibility:visible'>b</p>c</div>": "b",
    "<ul style='visibility:hidden'><li>a<li style='visibility:visible'>b</ul>": "- b",
    "<style>.h{display:none} #i, p.k {visibility:hidden}</style><p class='x h'>a<p id=i>b<p class=k>c<div class=k>d": "d",
    "<style>p{display:none}.s{display:block}/* .s{display:none} */</style><p>a<p class=s>b": "b",
    "<style>.s{display:block} p{display:none}</style><p class=s>b": "b",
    "<style>@media print{.s{display:none}}div .s{display:none}@import 'x';.t{display:none}</style>"
    "<p class=s>b<p class=t>c": "b",
    "<style media=print>p{display:none}</style><p>a": "a",
    "<style>#a{display:none}</style><p id=a style='display:block'>a": "a",
    "<style>p{display:none!important}</style><p style='display:block'>a</p>b": "b",
    "<style>.b{display:block}</style><p hidden>a<p hidden class=b>b": "b",
    "<textarea><b>x</b> &amp; y</textarea>": "<b>x</b> & y",
    "<title><b></title><p>a": "a",
    "<textarea><b>x": "<b>x",
    "<ol><li>a<li value=9>b<li>c</ol>": "1. a\n9. b\n10. c",
    "<ol reversed><li>a<li>b<li>c</ol>": "3. a\n2. b\n1. c",
    "<ol reversed start=10><li>a<li>b</ol>": "10. a\n9. b",
    "<ol type=a start=26><li>a<li>b</ol>": "z. a\naa. b",
    "<ol type=I start=3><li>a<li>b<li type=A>c</ol>": "III. a\nIV. b\nE. c",
    "<ol type=i start=0><li>a<li>b</ol>": "0. a\ni. b",
}


@pytest.mark.parametrize("page", SHOWN)
def test_what_shows(page):
    assert visible_text(page) == SHOWN[page]


def test_long_cells_are_folded():
    words = " ".join(["word"] * 30)
    lines = visible_text(f"<table><tr><td>{words}<td>b<tr><td>{'x' * 90}<td>c</table>").split("\n")
    assert [line.split()[-1] for line in lines] == ["b", "word", "c", "x" * 10]
    assert {lines[0].index("b"), lines[2].index("c")} == {82}
    assert sum(line.count("word") for line in lines) == 30


def made_up(pick, depth=0):
    """A piece of a page and the lines that it shows, made side by side by plain rules.

    Lines come with a flag: whether an empty line has to stand between the
    piece and its neighbours.
    """
    word = lambda: "".join(pick.choices("abcde", k=pick.randint(1, 5)))
    kind = pick.choice(["p", "div", "hidden", "table", "ul", "ol", "blockquote"] if depth < 3 else ["p", "div"])
    if kind in ("p", "div"):
        words = [word() for _ in range(pick.randint(1, 4))]
        return f"<{kind}>{pick.choice([' ', chr(10)]).join(words)}</{kind}>", [" ".join(words)], kind == "p"
    if kind == "hidden":
        return f"<div hidden><p>{word()}</div>", [], False
    if kind == "table":
        cells = [[word() for _ in range(3)] for _ in range(pick.randint(1, 3))]
        widths = [max(len(row[at]) for row in cells) for at in range(3)]
        source = "".join("<tr>" + "".join(f"<td>{cell}" for cell in row) for row in cells)
        lines = ["  ".join(cell.ljust(width) for cell, width in zip(row, widths)).rstrip() for row in cells]
        return f"<table>{source}</table>", lines, True
    if kind == "blockquote":
        source, lines = several(pick, depth + 1)
        return f"<blockquote>{source}</blockquote>", lines, True
    source, lines = "", []
    for number in range(1, pick.randint(2, 4)):
        mark = "- " if kind == "ul" else f"{number}. "
        text = word()
        inner, own = f"<div>{text}</div>", [text]
        if depth < 2 and pick.random() < 0.4:
            more = [word() for _ in range(2)]
            inner += "<ul>" + "".join(f"<li>{item}" for item in more) + "</ul>"
            own += [f"- {item}" for item in more]
        source += f"<li>{inner}"
        lines += [mark + own[0], *[" " * len(mark) + line for line in own[1:]]]
    return f"<{kind}>{source}</{kind}>", lines, True


def several(pick, depth=0):
    source, lines, due = "", [], False
    for _ in range(pick.randint(1, 5)):
        piece, own, apart = made_up(pick, depth)
        source += piece
        if own:
            lines += [""] * bool(lines and (due or apart)) + own
            due = apart
    return source, lines


def test_made_up_pages():
    for seed in range(400):
        source, lines = several(random.Random(seed))
        assert visible_text(source) == "\n".join(lines), (seed, source)


CELLS = {
    "<table><tr><td><h1>T</h1><p>one<p>two<ul><li>a<li>b</ul>end</td></tr></table>z":
        "T\n\none\n\ntwo\n\n- a\n- b\n\nend\n\nz",
    "<table><tr><td>menu<br>home<td>x<td><ul><li>a<li>b<li>c</ul><tr><td>k<td>y<td>l</table>":
        "menu  x  - a\nhome     - b\n         - c\nk     y  l",
    "<table><tr><td>a<td><table><tr><td>p<td>q<tr><td>long<td>r</table><td>z</table>":
        "a  p     q  z\n   long  r",
    "<table><tr><td>c<td><pre>\nx\n  y\n\nz</pre></table>": "c  x\n     y\n\n   z",
    "<table><tr><td>head<tr><td><p>a<p>b<tr><td>foot</table>": "head\n\na\n\nb\n\nfoot",
    "<table><tr><td><table><tr><td><p>a<p>b</table></table>": "a\n\nb",
    "<ul><li><table><tr><td>a<br>b<td>c</table><li>d</ul>": "- a  c\n  b\n\n- d",
    "<table><tr><td>a b\n c<td><tr><td> <td></table>": "a b c",
}


@pytest.mark.parametrize("page", CELLS)
def test_lines_of_cells(page):
    assert visible_text(page) == CELLS[page]


@pytest.mark.parametrize("span, rows", [("1500", 1500), ("0", 1500), ("99999", 1500), ("+2", 2), ("0003", 3), ("x", 1)])
def test_row_spans(span, rows):
    page = f"<table><tr><td rowspan='{span}'>a<td>b" + "<tr><td>c" * 1499 + "<tbody><tr><td>d<td>e</table>"
    lines = ["a  b", *["   c"] * (rows - 1), *["c"] * (1500 - rows), "d  e"]
    assert visible_text(page) == "\n".join(lines)


def test_marks_of_deep_items():
    page = "".join(f"<ol start={n}><li>i{n}" for n in range(1, 61))
    lines = visible_text(page).split("\n")
    assert [line.split() for line in lines] == [[f"{n}.", f"i{n}"] for n in range(1, 61)]
    places = [line.index(".") for line in lines]
    assert places == sorted(set(places))  # every level stands further in
    deep = visible_text("<ul><li>" * 600 + "x").split("\n")[-1]
    assert deep.endswith("- x") and len(deep) == 2 * 512 + 1
