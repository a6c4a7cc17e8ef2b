"""Pages and documents to texts, tables, sentences and chunks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import (
    CHUNK_CHARS,
    YEAR_PATTERN,
    document_text,
    elements_text,
    file_name,
    html_elements,
    packed_chunks,
    sentences,
    table_texts,
    years_in,
)
from .numbering import SLICE_ROWS as NUMBERED_ROWS
from .numbering import running_numbers

FIRST_SENTENCE_ID = 100
SLICE_ROWS = 4_096


def gather(
    df: DataFrame, by: Sequence[str], position: str, item: Column, name: str,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Items of a group as one array, ordered by an integer position.

    Runs of `slice_rows` positions are sorted and collected on their own, and
    the runs are put together after. The array itself is one value, so a group
    has to fit the size limit of a value (2 GB), as any document does.
    """
    runs = (
        df.withColumn("_run", F.floor(F.col(position) / slice_rows))
        .groupBy(*by, "_run")
        .agg(F.array_sort(F.collect_list(F.struct(F.col(position).alias("p"), item.alias("v"))))
             .alias("_items"))
    )
    whole = runs.groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct("_run", "_items"))).alias("_runs")
    )
    items = F.flatten(F.transform("_runs", lambda r: r["_items"]))
    return whole.select(*by, F.transform(items, lambda i: i["v"]).alias(name))


def element_rows(pages: DataFrame, html: str = "html", table_tag: str = "table") -> DataFrame:
    """One row per page element, with its position."""
    keys = [c for c in pages.columns if c != html]
    found = pages.select(*keys, F.posexplode(html_elements(html, table_tag)).alias("pos", "e"))
    return found.select(*keys, F.col("pos").cast("long").alias("pos"), "e.*")


def gather_elements(elements: DataFrame, by: Sequence[str]) -> DataFrame:
    """Element rows (pos, category, text, text_as_html) to one array per document."""
    return gather(
        elements, by, "pos", F.struct("category", "text", "text_as_html"), "elements"
    )


def document_rows(documents: DataFrame, elements: str = "elements") -> DataFrame:
    """One row per table and one for the remaining text of each document."""
    keys = [c for c in documents.columns if c != elements]
    texts = F.concat(table_texts(elements), F.array(document_text(elements)))
    parts = documents.select(*keys, F.posexplode(texts).alias("part", "content"))
    return parts.withColumn("part", F.col("part").cast("long"))


def page_texts(pages: DataFrame, html: str = "html", table_tag: str = "table") -> DataFrame:
    """Each page as one string of its elements, markup of tables kept."""
    keys = [c for c in pages.columns if c != html]
    return pages.select(*keys, elements_text(html_elements(html, table_tag)).alias("html_text"))


def join_page_and_file(pages: DataFrame, files: DataFrame, key: str = "id") -> DataFrame:
    """Pages with the text of their file; a missing part leaves no separator."""
    left = pages.withColumnRenamed(key, "html_id")
    return left.join(files, F.col("html_id") == F.col(key), "inner").withColumn(
        "html_pdf_content", F.concat_ws("----", "html_text", "pdf_content")
    )


def id_from_path(path: Column | str, extension: str = "pdf") -> Column:
    """The digits right before the extension; NULL where there are none."""
    digits = F.regexp_extract(path, f"([0-9]+)\\.{extension}$", 1)
    return digits.try_cast("long")


def id_at(path: Column | str, start: int, length: int) -> Column:
    """An id at a fixed place of a path; NULL where it is not a number."""
    return F.substring(path, start, length).try_cast("long")


def join_by_path_id(
    documents: DataFrame, files: DataFrame, path: str = "file_name", key: str = "id"
) -> DataFrame:
    """All documents, with the files whose path carries their id."""
    found = files.withColumn("pdf_id", id_from_path(path))
    return documents.join(found, documents[key] == found["pdf_id"], "left")


def only_addresses(crawl: DataFrame, part: str = ".pdf", column: str = "doc_url") -> DataFrame:
    return crawl.filter(F.col(column).contains(part))


def chunk_rows(
    documents: DataFrame, content: str = "content", path: str = "doc_url",
    limit: int = CHUNK_CHARS, year_pattern: str = YEAR_PATTERN,
) -> DataFrame:
    """Table rows stay whole, other text is packed into chunks with metadata.

    A table row is known by its leading `--`. Missing content gives no chunk.
    """
    is_table = F.col(content).startswith("--")
    name = file_name(path)
    about = F.to_json(F.struct(name.alias("file"), years_in(name, year_pattern).alias("year")))
    pieces = F.when(is_table, F.array(content)).otherwise(packed_chunks(content, limit))
    cut = documents.filter(F.col(content).isNotNull()).select(
        "*", F.when(~is_table, about).alias("meta"),
        F.posexplode(pieces).alias("chunk_no", "chunk"),
    )
    return cut.withColumn("chunk_no", F.col("chunk_no").cast("long"))


def numbered_pieces(
    documents: DataFrame, key: str, pieces: Column, name: str, first: int,
    keep: Sequence[str] = (), slice_rows: int = NUMBERED_ROWS,
) -> DataFrame:
    """Explode an array per document and number the pieces of all documents.

    The numbers are dense and follow the key and the place in the array; rows
    with one key have different numbers. Pieces are cut once; they, the key and
    the columns to `keep` are all that moves.
    """
    exploded = documents.select(key, *keep, F.posexplode(pieces).alias("_place", name))
    numbered = running_numbers(exploded, [key, "_place"], "id", first, slice_rows)
    return numbered.drop("_place")


def sentence_rows(
    documents: DataFrame, key: str, text: str, first: int = FIRST_SENTENCE_ID,
    slice_rows: int = NUMBERED_ROWS,
) -> DataFrame:
    """Sentences of all documents under one running number, in the order of the key."""
    numbered = numbered_pieces(
        documents, key, sentences(text), "content", first, slice_rows=slice_rows
    )
    return numbered.select("id", F.col(key).alias("title"), "content")
