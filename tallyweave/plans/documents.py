"""Queries over pages and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import documents as dc
from ..operators import edges as ed
from ..operators import languages as lg
from ..sources.tables import parquet_table
from . import html_sql as hs

# The pages hold lists but no tables, so lists stand in for them.
TABLE_TAG = "ul"


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return parquet_table(spark, folder, "documents")


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    return parquet_table(spark, folder, "pages")


def filter_contains(spark: SparkSession, folder: str) -> DataFrame:
    return dc.only_addresses(_pages(spark, folder), "page=", "url").select("page_id", "url")


def html_to_text(spark: SparkSession, folder: str) -> DataFrame:
    return _pages(spark, folder).select("page_id", tx.html_text("html").alias("text"))


def html_elements(spark: SparkSession, folder: str) -> DataFrame:
    return dc.element_rows(_pages(spark, folder), "html", TABLE_TAG)


def html_assemble(spark: SparkSession, folder: str) -> DataFrame:
    return dc.page_texts(_pages(spark, folder), "html", TABLE_TAG)


def _parts(spark: SparkSession, folder: str) -> DataFrame:
    pages = _pages(spark, folder)
    return dc.document_rows(
        pages.select("page_id", "url", tx.html_elements("html", TABLE_TAG).alias("elements"))
    )


def table_titles(spark: SparkSession, folder: str) -> DataFrame:
    return _parts(spark, folder).filter(F.col("content").startswith("-- Document title "))


def doc_assemble(spark: SparkSession, folder: str) -> DataFrame:
    return _parts(spark, folder)


def join_html_pdf(spark: SparkSession, folder: str) -> DataFrame:
    pages = dc.page_texts(_pages(spark, folder), "html", TABLE_TAG).select(
        F.col("page_id").alias("id"), "html_text"
    )
    files = _documents(spark, folder).select(
        F.col("doc_id").alias("id"), "source",
        F.nullif(F.col("text"), F.lit("")).alias("pdf_content"),
    )
    joined = dc.join_page_and_file(pages, files)
    return joined.select("id", "source", F.md5("html_pdf_content").alias("content_md5"),
                         F.length("html_pdf_content").cast("long").alias("n_chars"))


def join_path_id(spark: SparkSession, folder: str) -> DataFrame:
    files = parquet_table(spark, folder, "labels").select(
        F.concat(F.lit("/volumes/files/"), F.col("doc_id").cast("string"), F.lit(".pdf"))
        .alias("file_name"),
        F.col("quality").cast("string").alias("quality"),
    )
    documents = _documents(spark, folder).select(F.col("doc_id").alias("id"), "lang")
    joined = dc.join_by_path_id(documents, files)
    return joined.withColumn("pdf_id", F.col("pdf_id").cast("string"))


def url_file_year(spark: SparkSession, folder: str) -> DataFrame:
    name = tx.file_name("url")
    return _pages(spark, folder).select(
        "page_id", name.alias("file_name"),
        F.array_join(tx.years_in("url"), ",").alias("years"),
    )


def text_clean(spark: SparkSession, folder: str) -> DataFrame:
    return _documents(spark, folder).select(
        "doc_id",
        F.md5(tx.squeeze(tx.strip_escapes("text"))).alias("plain_md5"),
        F.md5(tx.tidy_lines("text")).alias("tidy_md5"),
    )


def numeric_line_filter(spark: SparkSession, folder: str) -> DataFrame:
    english = _documents(spark, folder).filter(F.col("lang") == "en")
    return english.select("doc_id", tx.drop_numeric_lines("text").alias("text"))


def _told(spark: SparkSession, folder: str) -> DataFrame:
    documents = _documents(spark, folder)
    return lg.told_languages(documents, "doc_id", "text", lg.profiles(documents, "text"))


def language_told(spark: SparkSession, folder: str) -> DataFrame:
    """The language that every document's own text tells."""
    return _told(spark, folder)


def told_line_filter(spark: SparkSession, folder: str) -> DataFrame:
    """The lines kept of documents whose text is English, whatever their column says."""
    english = _told(spark, folder).filter("told = 'en'").select("doc_id")
    return _documents(spark, folder).join(english, "doc_id").select(
        "doc_id", tx.drop_numeric_lines("text").alias("text"))


def edge_lines(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without the header and footer lines of their source."""
    return ed.without_edges(_documents(spark, folder), "doc_id", "text", "source")


def sentences(spark: SparkSession, folder: str) -> DataFrame:
    cut = _documents(spark, folder).select(
        "doc_id", F.posexplode(tx.sentences("text")).alias("pos", "sentence")
    )
    return cut.withColumn("pos", F.col("pos").cast("long"))


def sentence_ids(spark: SparkSession, folder: str) -> DataFrame:
    return dc.sentence_rows(_documents(spark, folder), "doc_id", "text")


def word_chunks(spark: SparkSession, folder: str) -> DataFrame:
    cut = _documents(spark, folder).select(
        "doc_id", F.posexplode(tx.word_chunks("text")).alias("chunk_no", "chunk")
    )
    return cut.withColumn("chunk_no", F.col("chunk_no").cast("long"))


def chunk_route(spark: SparkSession, folder: str) -> DataFrame:
    return dc.chunk_rows(_parts(spark, folder), "content", "url").select(
        "page_id", "part", "chunk_no", "chunk", "meta"
    )


def stable_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Word chunks under their own dense key, with the id of their document."""
    numbered = dc.numbered_pieces(
        _documents(spark, folder), "doc_id", tx.word_chunks("text"), "chunks", 0, ["source"]
    )
    return numbered.select("id", "doc_id", "source", F.md5("chunks").alias("chunks_md5"))


_WORDS = f"list_filter(string_split({hs.squeezed('text')}, ' '), lambda w: w <> '')"
_CHUNKS = f"""
    worded AS (SELECT doc_id, source, {_WORDS} AS words FROM documents),
    starts AS (
        SELECT *, unnest(range(0, greatest(len(words) - 4, 0) + 1, 97)) AS first_word
        FROM worded),
    chunks AS (
        SELECT doc_id, source, first_word // 97 AS chunk_no,
               array_to_string(list_slice(words, first_word + 1, first_word + 100), ' ') AS chunk
        FROM starts WHERE len(words) > 0)"""

_SENTENCES = f"""
    cut AS (
        SELECT doc_id, unnest({hs.sentence_list('text')}) AS sentence,
               generate_subscripts({hs.sentence_list('text')}, 1) - 1 AS pos
        FROM documents)"""

_PLAIN = "replace(replace(replace(text, '\"', ''), '\\n', ' '), '\\', '')"

_PARTS = hs.document_parts(TABLE_TAG)

_KEPT_LINES = """
        array_to_string(list_filter(string_split(text, chr(10)), lambda line: NOT (
            coalesce(len(regexp_extract_all(line, '[^ \\t\\r\\f0-9]*[0-9][^ \\t\\r\\f]*'))
                / NULLIF(len(regexp_extract_all(line, '[^ \\t\\r\\f]+')), 0) > 0.4, false)
            AND NOT ends_with(rtrim(translate(line, chr(9) || chr(13) || chr(12), '   ')), '.'))),
            chr(10))"""

_TOLD = f"""
    words AS (
        SELECT doc_id, lang, unnest(regexp_extract_all(lower(coalesce(text, '')), '\\pL{{1,{lg.LONGEST}}}')) AS word
        FROM documents),
    grams AS (
        SELECT doc_id, lang, substring('_' || word || '_', start, {lg.SIZE}) AS gram
        FROM (SELECT *, unnest(range(1, length(word) + 1)) AS start FROM words)),
    lists AS (
        SELECT doc_id, gram, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, gram) AS place
        FROM (SELECT doc_id, gram, count(*) AS n FROM grams GROUP BY ALL)
        QUALIFY place <= {lg.PLACES}),
    known AS (
        SELECT lang, gram, row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) AS place
        FROM (SELECT lang, gram, count(*) AS n FROM grams WHERE lang IS NOT NULL GROUP BY ALL)
        QUALIFY place <= {lg.PLACES}),
    distances AS (
        SELECT l.doc_id, n.lang, sum(coalesce(abs(l.place - k.place), {lg.PLACES})) AS distance
        FROM lists l CROSS JOIN (SELECT DISTINCT lang FROM known) n
        LEFT JOIN known k ON k.lang = n.lang AND k.gram = l.gram GROUP BY ALL),
    told AS (
        SELECT doc_id, lang AS told, CAST(distance AS BIGINT) AS distance FROM distances
        QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY distance, lang) = 1)"""

_EDGES = f"""
    whole AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
    filled AS (
        SELECT source, text, list_filter(
            list_transform(string_split(text, chr(10)), lambda line, i: {{'at': i, 'line': regexp_replace(
                trim(line, ' ' || chr(9) || chr(13) || chr(12)), '[0-9]+', '#', 'g')}}),
            lambda l: l.line <> '') AS lines
        FROM (SELECT DISTINCT source, text FROM whole)),
    ends AS (
        SELECT source, text, 'head' AS side, list_slice(lines, 1, {ed.EDGE}) AS lines FROM filled
        UNION ALL SELECT source, text, 'foot',
               list_slice(lines, greatest(len(lines) - {ed.EDGE}, 0) + 1, len(lines)) FROM filled),
    runs AS (
        SELECT source, text, side, start, length, lines[start].at AS first, lines[start + length - 1].at AS last,
               array_to_string(list_transform(list_slice(lines, start, start + length - 1),
                                              lambda l: l.line), chr(10)) AS run
        FROM ends, range(1, {ed.EDGE + 1}) s(start), range(1, {ed.EDGE + 1}) n(length)
        WHERE start + length - 1 <= len(lines)),
    common AS (
        SELECT source, side, run FROM (
            SELECT source, side, run, count(DISTINCT text) AS n FROM runs GROUP BY ALL)
        JOIN (SELECT source AS of, count(*) AS n_texts FROM filled GROUP BY ALL)
            ON source IS NOT DISTINCT FROM of
        WHERE n >= {ed.FEWEST} AND n * {ed.ONE_IN} >= n_texts),
    longest AS (
        SELECT r.* FROM runs r JOIN common c
            ON r.source IS NOT DISTINCT FROM c.source AND r.side = c.side AND r.run = c.run
        QUALIFY row_number() OVER (PARTITION BY r.source, r.text, r.side ORDER BY length DESC, start) = 1)"""

QUERIES = {
    "filter_contains": (filter_contains,
                        "SELECT page_id, url FROM pages WHERE contains(url, 'page=')"),
    "html_to_text": (html_to_text,
                     f"SELECT page_id, {hs.visible('html')} AS text FROM pages"),
    "html_elements": (html_elements, f"""WITH {hs.element_list(TABLE_TAG)}
        SELECT page_id, url, pos, category, text, text_as_html FROM elements"""),
    "html_assemble": (html_assemble, f"""WITH {hs.element_list(TABLE_TAG)}
        SELECT p.page_id, p.url, coalesce(
            (SELECT string_agg(coalesce(text_as_html, text), '' ORDER BY pos)
             FROM elements e WHERE e.page_id = p.page_id), '') AS html_text
        FROM pages p"""),
    "table_titles": (table_titles, f"WITH {_PARTS} SELECT * FROM tables"),
    "doc_assemble": (doc_assemble,
                     f"WITH {_PARTS} SELECT * FROM tables UNION ALL SELECT * FROM texts"),
    "join_html_pdf": (join_html_pdf, f"""WITH {hs.element_list(TABLE_TAG)},
        page_texts AS (
            SELECT page_id, string_agg(coalesce(text_as_html, text), '' ORDER BY pos) AS html_text
            FROM elements GROUP BY page_id),
        joined AS (
            SELECT doc_id AS id, source, concat_ws('----', coalesce(html_text, ''),
                   NULLIF(text, '')) AS content
            FROM documents JOIN pages ON page_id = doc_id
            LEFT JOIN page_texts USING (page_id))
        SELECT id, source, md5(content) AS content_md5, length(content) AS n_chars FROM joined"""),
    "join_path_id": (join_path_id, """
        SELECT d.doc_id AS id, d.lang,
               CASE WHEN l.doc_id IS NOT NULL THEN '/volumes/files/' || l.doc_id || '.pdf' END
                   AS file_name,
               CAST(l.quality AS VARCHAR) AS quality, CAST(l.doc_id AS VARCHAR) AS pdf_id
        FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id"""),
    "url_file_year": (url_file_year, """
        SELECT page_id, list_extract(string_split(url, '/'), -1) AS file_name,
               array_to_string(regexp_extract_all(url, '[2][0-9][0-9][0-4]'), ',') AS years
        FROM pages"""),
    "text_clean": (text_clean, f"""
        SELECT doc_id,
               md5({hs.squeezed(hs.each(_PLAIN, 'xc[^' + chr(10) + ']{8}|xe[^' + chr(10) + ']{7}', ' '))})
                   AS plain_md5,
               md5({hs.each("trim(" + hs.each("text", "[ \\t\\r\\f]*\\n[ \\t\\r\\f]*", chr(10)) + ")",
                            "\\n{3,}", chr(10) + chr(10))}) AS tidy_md5
        FROM documents"""),
    "numeric_line_filter": (numeric_line_filter, f"""
        SELECT doc_id, {_KEPT_LINES} AS text FROM documents WHERE lang = 'en'"""),
    "language_told": (language_told, f"WITH {_TOLD} SELECT doc_id, told, distance FROM told"),
    "told_line_filter": (told_line_filter, f"""WITH {_TOLD}
        SELECT doc_id, {_KEPT_LINES} AS text FROM documents JOIN told USING (doc_id) WHERE told = 'en'"""),
    "edge_lines": (edge_lines, f"""WITH {_EDGES}
        SELECT doc_id, coalesce(h.length, 0) AS n_head, coalesce(f.length, 0) AS n_foot,
               array_to_string(list_filter(string_split(w.text, chr(10)), lambda line, i:
                   NOT coalesce(i BETWEEN h.first AND h.last, false)
                   AND NOT coalesce(i BETWEEN f.first AND f.last, false)), chr(10)) AS text
        FROM whole w
        LEFT JOIN longest h ON h.side = 'head' AND h.text = w.text AND h.source IS NOT DISTINCT FROM w.source
        LEFT JOIN longest f ON f.side = 'foot' AND f.text = w.text AND f.source IS NOT DISTINCT FROM w.source"""),
    "sentences": (sentences, f"WITH {_SENTENCES} SELECT doc_id, pos, sentence FROM cut"),
    "sentence_ids": (sentence_ids, f"""WITH {_SENTENCES}
        SELECT 99 + row_number() OVER (ORDER BY doc_id, pos) AS id, doc_id AS title,
               sentence AS content FROM cut"""),
    "word_chunks": (word_chunks, f"WITH {_CHUNKS} SELECT doc_id, chunk_no, chunk FROM chunks"),
    "chunk_route": (chunk_route, f"""WITH {_PARTS},
        named AS (
            SELECT *, list_extract(string_split(url, '/'), -1) AS file
            FROM (SELECT * FROM tables UNION ALL SELECT * FROM texts)),
        routed AS (
            SELECT page_id, part,
                   CASE WHEN starts_with(content, '--') THEN [content]
                        ELSE {hs.packed('content', 500)} END AS chunks,
                   CASE WHEN NOT starts_with(content, '--') THEN
                       '{{"file":"' || file || '","year":['
                       || array_to_string(list_transform(
                              regexp_extract_all(file, '[2][0-9][0-9][0-4]'),
                              lambda y: '"' || y || '"'), ',') || ']}}' END AS meta
            FROM named)
        SELECT page_id, part, unnest(chunks) AS chunk, meta,
               generate_subscripts(chunks, 1) - 1 AS chunk_no
        FROM routed"""),
    "stable_ids": (stable_ids, f"""WITH {_CHUNKS}
        SELECT row_number() OVER (ORDER BY doc_id, chunk_no) - 1 AS id, doc_id, source,
               md5(chunk) AS chunks_md5 FROM chunks"""),
}
