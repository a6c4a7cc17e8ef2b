"""SQL twins of the page expressions, put together from string functions."""

from __future__ import annotations

BLANKS = "[ \\t\\n\\r\\f]+"


def each(text: str, pattern: str, put: str) -> str:
    return f"regexp_replace({text}, '{pattern}', '{put}', 'g')"


def squeezed(text: str) -> str:
    return f"trim({each(text, BLANKS, ' ')})"


def decoded(text: str) -> str:
    """The references that occur in the pages."""
    for name, letter in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        text = f"replace({text}, '&{name};', '{letter}')"
    return text


def seen(html: str) -> str:
    for pattern in (
        "(?is)<script\\b[^>]*>.*?</script\\s*>", "(?is)<style\\b[^>]*>.*?</style\\s*>",
        "(?is)<!--.*?-->", "(?is)<![a-z][^>]*>",
    ):
        html = each(html, pattern, "")
    return html


TAG = "(?s)</?[a-zA-Z][^>]*>"


def visible(html: str) -> str:
    html = each(seen(html), "(?is)<a\\b[^>]*>.*?</a\\s*>", "")
    return f"replace({decoded(each(html, TAG, ''))}, chr(10), ' ')"


_BLOCKS = (
    "p|div|article|section|nav|header|footer|main|aside|ul|ol|dl|dt|dd|li|br|hr|"
    "body|html|form|blockquote|pre|table|tr|td|th|thead|tbody|h[1-6]"
)


def element_list(table_tag: str) -> str:
    """CTEs that end in `elements`: one row per element of a page, with its place.

    A mark is put around every table, so tables are the even cuts.
    """
    body = each(seen("html"), "(?is)<head\\b[^>]*>.*?</head\\s*>", "")
    body = each(body, "[\\n\\r]", " ")
    body = each(body, f"(?is)(<{table_tag}\\b[^>]*>.*?</{table_tag}\\s*>)", "\ue000\\1\ue000")
    marked = each("segment", "(?is)<h[1-6]\\b[^>]*>", "\n\ue001")
    marked = each(marked, "(?is)<li\\b[^>]*>", "\n\ue002")
    marked = each(marked, f"(?is)</?(?:{_BLOCKS})\\b[^>]*>", "\n")
    plain = squeezed(decoded(each("translate(piece, '\ue001\ue002', '')", TAG, "")))
    return f"""
    bodies AS (SELECT page_id, url, {body} AS body FROM pages),
    segments AS (
        SELECT page_id, url, unnest(string_split(body, '\ue000')) AS segment,
               generate_subscripts(string_split(body, '\ue000'), 1) AS place
        FROM bodies),
    pieces AS (
        SELECT page_id, url, place, segment, NULL AS piece, 1 AS part
        FROM segments WHERE place % 2 = 0
        UNION ALL
        SELECT page_id, url, place, segment, unnest(string_split({marked}, chr(10))),
               generate_subscripts(string_split({marked}, chr(10)), 1)
        FROM segments WHERE place % 2 = 1),
    typed AS (
        SELECT page_id, url, place, part,
               CASE WHEN piece IS NULL THEN 'Table'
                    WHEN starts_with(piece, '\ue001') THEN 'Title'
                    WHEN starts_with(piece, '\ue002') THEN 'ListItem'
                    ELSE 'NarrativeText' END AS category,
               CASE WHEN piece IS NULL
                    THEN {squeezed(decoded(each("segment", TAG, " ")))}
                    ELSE {plain} END AS text,
               CASE WHEN piece IS NULL THEN segment END AS text_as_html
        FROM pieces),
    elements AS (
        SELECT page_id, url, category, text, text_as_html,
               row_number() OVER (PARTITION BY page_id ORDER BY place, part) - 1 AS pos
        FROM typed WHERE text <> '' OR category = 'Table')"""


def document_parts(table_tag: str) -> str:
    """CTEs that end in `tables` and `texts`."""
    return f"""{element_list(table_tag)},
    titled AS (
        SELECT *,
            string_agg(CASE WHEN category = 'Title' THEN text END, ', ') OVER w AS titles,
            last_value(CASE WHEN category = 'Title' THEN text END IGNORE NULLS) OVER w AS latest
        FROM elements
        WINDOW w AS (PARTITION BY page_id ORDER BY pos
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    tables AS (
        SELECT page_id, url,
               CAST(row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS BIGINT) AS part,
               '-- Document title ' || coalesce(titles, '') || ' -- ' || chr(10)
               || '-- Table title ' || coalesce(latest, '') || ' -- ' || chr(10)
               || text_as_html AS content
        FROM titled WHERE category = 'Table'),
    texts AS (
        SELECT p.page_id, p.url,
               (SELECT count(*) FROM tables t WHERE t.page_id = p.page_id) AS part,
               coalesce((SELECT string_agg(text, '' ORDER BY pos) FROM elements e
                         WHERE e.page_id = p.page_id AND category <> 'Table'), '') AS content
        FROM pages p)"""


def sentence_list(text: str) -> str:
    marked = each(squeezed(text), "([.!?]) ", "\\1\n")
    return f"list_filter(string_split({marked}, chr(10)), lambda s: s <> '')"


def packed(text: str, limit: int) -> str:
    """Greedy packing with a marked string as the state of a list reduction."""
    cut = (
        f"flatten(list_transform({sentence_list(text)}, lambda s: list_transform("
        f"range(0, greatest(length(s), 1), {limit}), lambda i: substr(s, i + 1, {limit}))))"
    )
    last = "list_extract(string_split(a, '\ue000'), -1)"
    return (
        f"CASE WHEN len({cut}) = 0 THEN [] ELSE string_split(list_reduce({cut}, lambda a, s: "
        f"a || CASE WHEN length({last}) + 1 + length(s) <= {limit} THEN ' ' ELSE '\ue000' END"
        f" || s), '\ue000') END"
    )
