"""Text expressions, all built from Spark's own string functions."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .arrays import let

# Patterns and sizes the results depend on.
YEAR_PATTERN = "[2][0-9][0-9][0-4]"
BYTE_RESIDUE = "xc[^\n]{8}|xe[^\n]{7}"
HEADER_CELL = "<th[^\n]*?>([^\n]+?)</th>"
WORD_LENGTH = 100
WORD_OVERLAP = 3
CHUNK_CHARS = 500
DIGIT_WORD_SHARE = 0.4

BLANKS = "[ \t\n\r\f]+"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def squeeze(text: Column | str) -> Column:
    """Runs of white space become one space, none at the ends."""
    return F.trim(F.regexp_replace(_col(text), BLANKS, " "))


def strip_escapes(text: Column | str) -> Column:
    """Undo printed byte strings: quotes, written-out line ends, residue."""
    text = F.replace(_col(text), F.lit('"'), F.lit(""))
    text = F.replace(text, F.lit("\\n"), F.lit(" "))
    text = F.replace(text, F.lit("\\"), F.lit(""))
    return F.regexp_replace(text, BYTE_RESIDUE, " ")


def tidy_lines(text: Column | str) -> Column:
    """Trim every line and keep at most one empty line in a row."""
    text = F.regexp_replace(_col(text), "[ \t\r\f]*\n[ \t\r\f]*", "\n")
    return F.regexp_replace(F.trim(text), "\n{3,}", "\n\n")


def file_name(path: Column | str) -> Column:
    """What follows the last slash."""
    return F.element_at(F.split(_col(path), "/"), -1)


def years_in(text: Column | str, pattern: str = YEAR_PATTERN) -> Column:
    return F.regexp_extract_all(_col(text), F.lit(pattern), F.lit(0))


def table_title(html: Column | str) -> Column:
    """What follows the last header cell, or all of it when there is none.

    A split on the cell pattern also keeps the cell texts, but never last.
    """
    return F.element_at(F.split(_col(html), HEADER_CELL), -1)


def decode_entities(text: Column | str) -> Column:
    """Named and numeric character references to characters, in one pass."""
    known = [F.lit(part) for name, code in name2codepoint.items() for part in (name, chr(code))]
    table = F.create_map(*known)

    def by_number(name: Column) -> Column:
        decimal = F.regexp_extract(name, "^#([0-9]{1,7})$", 1)
        hexadecimal = F.regexp_extract(name, "^#[xX]([0-9a-fA-F]{1,6})$", 1)
        code = F.coalesce(
            decimal.try_cast("int"), F.conv(F.nullif(hexadecimal, F.lit("")), 16, 10).try_cast("int")
        )
        in_range = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        return F.when(in_range, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))

    def decoded(part: Column) -> Column:
        name = F.substring_index(part, ";", 1)
        meant = F.coalesce(
            F.try_element_at(table, name), F.when(name.startswith("#"), by_number(name))
        )
        rest = F.substr(part, F.length(name) + 2)
        whole = F.when(part.contains(";"), F.concat(meant, rest))
        return F.coalesce(whole, F.concat(F.lit("&"), part))

    def joined(parts: Column) -> Column:
        tail = F.transform(F.slice(parts, F.lit(2), F.size(parts)), decoded)
        return F.concat(F.element_at(parts, 1), F.array_join(tail, ""))

    return let(F.split(_col(text), "&"), joined)


# Scripts, styles, comments and declarations are not text.
_UNSEEN = (
    r"(?is)<script\b[^>]*>.*?</script\s*>",
    r"(?is)<style\b[^>]*>.*?</style\s*>",
    r"(?is)<!--.*?-->",
    r"(?is)<![a-z][^>]*>",
)
_LINK = r"(?is)<a\b[^>]*>.*?</a\s*>"
_TAG = r"(?s)</?[a-zA-Z][^>]*>"


def _without_unseen(html: Column) -> Column:
    for pattern in _UNSEEN:
        html = F.regexp_replace(html, pattern, "")
    return html


def html_text(html: Column | str) -> Column:
    """Visible text of a page: links go with their text, line ends are spaces."""
    html = _without_unseen(_col(html))
    html = F.regexp_replace(html, _LINK, "")
    html = F.regexp_replace(html, _TAG, "")
    return F.replace(decode_entities(html), F.lit("\n"), F.lit(" "))


# Private-use characters that mark element borders while a page is cut up.
_TABLE, _TITLE, _ITEM = "\ue000", "\ue001", "\ue002"
_BLOCKS = (
    "p|div|article|section|nav|header|footer|main|aside|ul|ol|dl|dt|dd|li|br|hr|"
    "body|html|form|blockquote|pre|table|tr|td|th|thead|tbody|h[1-6]"
)


def html_elements(html: Column | str, table_tag: str = "table") -> Column:
    """Page body as an ordered array of (category, text, text_as_html).

    Elements of `table_tag` keep their markup; headings, list items and other
    blocks become plain text. Blocks without text are left out.
    """
    body = _without_unseen(_col(html))
    body = F.regexp_replace(body, "(?is)<head\\b[^>]*>.*?</head\\s*>", "")
    body = F.translate(body, f"\n\r{_TABLE}{_TITLE}{_ITEM}", "  ")
    body = F.regexp_replace(
        body, f"(?is)(<{table_tag}\\b[^>]*>.*?</{table_tag}\\s*>)", f"{_TABLE}$1{_TABLE}"
    )

    def plain(piece: Column) -> Column:
        text = F.regexp_replace(piece, _TAG, "")
        return squeeze(decode_entities(F.translate(text, f"{_TITLE}{_ITEM}", "")))

    def blocks(segment: Column) -> Column:
        marked = F.regexp_replace(segment, "(?is)<h[1-6]\\b[^>]*>", f"\n{_TITLE}")
        marked = F.regexp_replace(marked, "(?is)<li\\b[^>]*>", f"\n{_ITEM}")
        marked = F.regexp_replace(marked, f"(?is)</?(?:{_BLOCKS})\\b[^>]*>", "\n")
        found = F.transform(F.split(marked, "\n"), lambda piece: F.struct(
            F.when(piece.startswith(_TITLE), F.lit("Title"))
            .when(piece.startswith(_ITEM), F.lit("ListItem"))
            .otherwise(F.lit("NarrativeText")).alias("category"),
            plain(piece).alias("text"),
            F.lit(None).cast("string").alias("text_as_html"),
        ))
        return F.filter(found, lambda e: e["text"] != "")

    def table(segment: Column) -> Column:
        # Cells stand apart in the text of a table.
        return F.array(F.struct(
            F.lit("Table").alias("category"),
            squeeze(decode_entities(
                F.regexp_replace(segment, _TAG, " "))).alias("text"),
            segment.alias("text_as_html"),
        ))

    # Cutting at the marker leaves tables at the odd positions.
    return F.flatten(F.transform(
        F.split(body, _TABLE),
        lambda segment, i: F.when(i % 2 == 1, table(segment)).otherwise(blocks(segment)),
    ))


def elements_text(elements: Column | str) -> Column:
    """All elements as one string: markup where there is some, else text."""
    return F.array_join(
        F.transform(_col(elements), lambda e: F.coalesce(e["text_as_html"], e["text"])), ""
    )


def document_text(elements: Column | str) -> Column:
    """Text of everything that is not a table, in order."""
    rest = F.filter(_col(elements), lambda e: e["category"] != "Table")
    return F.array_join(F.transform(rest, lambda e: e["text"]), "")


def table_texts(elements: Column | str) -> Column:
    """One text per table: the titles so far, the latest one, the markup.

    Tables without markup are left out.
    """
    placed = F.transform(_col(elements), lambda e, i: F.struct(
        i.alias("i"), e["category"].alias("category"),
        e["text"].alias("text"), e["text_as_html"].alias("html")))

    def of_kinds(kinds: Column) -> Column:
        def with_titles(t: Column) -> Column:
            before = F.transform(
                F.filter(kinds["titles"], lambda h: h["i"] < t["i"]), lambda h: h["text"])
            return let(before, lambda titles: F.concat(
                F.lit("-- Document title "), F.array_join(titles, ", "), F.lit(" -- \n"),
                F.lit("-- Table title "),
                F.coalesce(F.try_element_at(titles, F.lit(-1)), F.lit("")), F.lit(" -- \n"),
                t["html"],
            ))

        return F.transform(kinds["tables"], with_titles)

    return let(placed, lambda every: let(F.struct(
        F.filter(every, lambda e: e["category"] == "Title").alias("titles"),
        F.filter(every, lambda e: (e["category"] == "Table") & e["html"].isNotNull())
        .alias("tables"),
    ), of_kinds))


def sentences(text: Column | str) -> Column:
    """Split after `.`, `!` or `?` before white space; empty ones left out."""
    marked = F.regexp_replace(squeeze(text), "([.!?]) ", "$1\n")
    return F.filter(F.split(marked, "\n"), lambda s: s != "")


def word_chunks(
    text: Column | str, length: int = WORD_LENGTH, overlap: int = WORD_OVERLAP
) -> Column:
    """Runs of `length` words that share `overlap` words with the next.

    The last run may be shorter but never holds shared words alone.
    """
    def runs(words: Column) -> Column:
        last = F.greatest(F.size(words) - overlap - 1, F.lit(0))
        starts = F.sequence(F.lit(0), last, F.lit(length - overlap))
        return F.transform(
            starts, lambda s: F.array_join(F.slice(words, s + 1, F.lit(length)), " "))

    words = F.filter(F.split(squeeze(text), " "), lambda w: w != "")
    return F.filter(let(words, runs), lambda run: run != "")


def drop_numeric_lines(text: Column | str, share: float = DIGIT_WORD_SHARE) -> Column:
    """Lines with more than `share` digit words go, unless they end a sentence."""
    lines = F.split(_col(text), "\n")

    def kept(line: Column) -> Column:
        words = F.regexp_count(line, F.lit("[^ \t\r\f]+"))
        numeric = F.regexp_count(line, F.lit("[^ \t\r\f0-9]*[0-9][^ \t\r\f]*"))
        heavy = F.coalesce(F.try_divide(numeric, words) > share, F.lit(False))
        ends = F.rtrim(F.translate(line, "\t\r\f", "   ")).endswith(".")
        # Most lines have no digit and need no counting.
        return F.when(line.rlike("[0-9]"), ~heavy | ends).otherwise(F.lit(True))

    return F.array_join(F.filter(lines, kept), "\n")


def packed_chunks(text: Column | str, limit: int = CHUNK_CHARS) -> Column:
    """Whole sentences packed in order into chunks of at most `limit` characters.

    A longer sentence is cut every `limit` characters. The state keeps closed
    chunks and the open one apart, so a step costs the open chunk only.
    """
    def cut(sentence: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(sentence), F.lit(1)), F.lit(limit))
        return F.transform(starts, lambda s: F.substr(sentence, s, F.lit(limit)))

    pieces = F.flatten(F.transform(sentences(text), cut))
    empty = F.struct(
        F.array().cast("array<string>").alias("closed"), F.lit("").alias("open")
    )

    def add(state: Column, piece: Column) -> Column:
        joined = F.when(state["open"] == "", piece).otherwise(
            F.concat(state["open"], F.lit(" "), piece))
        fits = F.length(joined) <= limit
        return F.struct(
            F.when(fits, state["closed"])
            .otherwise(F.concat(state["closed"], F.array(state["open"]))).alias("closed"),
            F.when(fits, joined).otherwise(piece).alias("open"),
        )

    def finish(state: Column) -> Column:
        return F.when(state["open"] == "", state["closed"]).otherwise(
            F.concat(state["closed"], F.array(state["open"])))

    return F.aggregate(pieces, empty, add, finish)


def register(spark: SparkSession) -> None:
    """Text functions by name for SQL.

    They are SQL expressions that Catalyst inlines, so no Python runs per row.
    """
    def define(name: str, result: str, body: str) -> None:
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(value STRING) "
            f"RETURNS {result} RETURN {body}"
        )

    define("file_name", "STRING", "element_at(split(value, '/'), -1)")
    define("years_in", "ARRAY<STRING>", f"regexp_extract_all(value, '{YEAR_PATTERN}', 0)")
    define("squeeze", "STRING", f"trim(regexp_replace(value, r'{_RAW_BLANKS}', ' '))")
    words = f"filter(split(trim(regexp_replace(value, r'{_RAW_BLANKS}', ' ')), ' '), w -> w <> '')"
    define("word_chunks", "ARRAY<STRING>", f"""
        filter(element_at(transform(array({words}), w -> transform(
            sequence(0, greatest(size(w) - {WORD_OVERLAP + 1}, 0), {WORD_LENGTH - WORD_OVERLAP}),
            s -> array_join(slice(w, s + 1, {WORD_LENGTH}), ' '))), 1), run -> run <> '')""")
    define("html_decode", "STRING", _DECODE_SQL)
    stripped = "value"
    for pattern in (*_UNSEEN, _LINK, _TAG):
        stripped = f"regexp_replace({stripped}, r'{pattern}', '')"
    define("html_text", "STRING", f"replace(html_decode({stripped}), '\\n', ' ')")


_RAW_BLANKS = r"[ \t\n\r\f]+"


def _sql_text(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _reference_sql(name: str) -> str:
    """The character a reference stands for, from its name without `&` and `;`."""
    table = ", ".join(f"'{key}', {_sql_text(chr(n))}" for key, n in name2codepoint.items())
    code = (
        f"CASE WHEN {name} RLIKE '^#[0-9]{{1,7}}$' THEN try_cast(substr({name}, 2) AS INT) "
        f"WHEN {name} RLIKE '^#[xX][0-9a-fA-F]{{1,6}}$' "
        f"THEN try_cast(conv(substr({name}, 3), 16, 10) AS INT) END"
    )
    return (
        f"coalesce(try_element_at(map({table}), {name}), "
        f"CASE WHEN {code} BETWEEN 1 AND 55295 OR {code} BETWEEN 57344 AND 1114111 "
        f"THEN decode(unhex(lpad(hex({code}), 8, '0')), 'UTF-32') END)"
    )


_NAME_SQL = "substring_index(part, ';', 1)"
_DECODE_SQL = f"""
    array_join(transform(
        transform(split(value, '&'), (part, i) -> struct(i, part,
            CASE WHEN i > 0 AND contains(part, ';') THEN {_reference_sql(_NAME_SQL)} END AS meant)),
        p -> CASE
            WHEN p.i = 0 THEN p.part
            WHEN p.meant IS NULL THEN concat('&', p.part)
            ELSE concat(p.meant, substr(p.part, length(substring_index(p.part, ';', 1)) + 2))
        END), '')"""
