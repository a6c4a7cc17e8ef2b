"""Exact duplicates: 128-bit content hashes, checked byte by byte.

Texts are equal when they are identical after every run of white space
(space, tab to carriage return) became one space.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, whole_text

# Runs that one space has to replace; a single space is one already.
SPACE_RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text: str | Column) -> Column:
    return F.regexp_replace(whole_text(text), SPACE_RUNS, " ")


def content_hash(text: Column) -> Column:
    """128 bits of the text."""
    return F.unhex(F.md5(text))


def exact_groups(
    docs: DataFrame, hashed: Callable[[Column], Column] = content_hash
) -> DataFrame:
    """One row per row of `docs` (doc_id, text): its group and whether it stays.

    Columns: doc_id, keep_id (smallest doc_id of the group), group_size, kept,
    text_sha256, copies (rows of the group with this very doc_id), content.

    Texts are grouped by hash *and* bytes, so two texts with one hash make two
    groups. Copies merge before the exchange: a group of any size sends one row
    per task. Rows then find their group by the hash and the SHA-256 of the
    text; everything but the grouping of texts is narrow.

    A NULL text is an empty one. A NULL doc_id counts as larger than any other.
    Of rows with the same doc_id in a group one is kept, the first as read.
    Empty input gives no rows; other columns of `docs` are not looked at.
    """
    text = normalised("text")
    rows = stored(
        docs.select(
            F.col("doc_id"),
            F.monotonically_increasing_id().alias("row"),
            hashed(text).alias("content"),
            F.sha2(text, 256).alias("text_sha256"),
        ),
        "exact-rows",
    )
    address = ["content", "text_sha256"]
    groups = (
        docs.select("doc_id", hashed(text).alias("content"), text.alias("text"))
        .groupBy("content", "text")
        .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .select("content", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size")
    )
    first = (
        rows.groupBy(*address, "doc_id")
        .agg(F.min("row").alias("first_row"), F.count("*").alias("copies"))
        .groupBy(*address).agg(
            F.coalesce(F.min_by("first_row", "doc_id"), F.min("first_row")).alias("keep_row"),
            F.coalesce(F.min_by("copies", "doc_id"), F.max("copies")).alias("keep_copies"),
        )
    )
    # stored, so that the last join alone meets the rows and can split a group's
    groups = stored(groups.join(first, address), "exact-groups")
    kept = F.col("row") == F.col("keep_row")
    return rows.join(groups, address).select(
        "doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256",
        F.when(kept, F.col("keep_copies")).alias("copies"), "content",
    )


def exact_dedup(docs: DataFrame) -> DataFrame:
    """`docs` with one row of every group of equal texts, that of `exact_groups`.

    All columns come back, whatever their names: a row travels as one struct.
    """
    kept = exact_groups(docs.select("doc_id", "text")).filter("kept").select(
        F.col("doc_id").alias("keep_id"), F.col("content").alias("keep_content"), "copies"
    )
    hashed = docs.select(
        F.struct("*").alias("whole"), F.col("doc_id").alias("own_id"),
        content_hash(normalised("text")).alias("own_content"),
    )
    staying = hashed.join(
        kept,
        F.col("own_id").eqNullSafe(F.col("keep_id"))
        & (F.col("own_content") == F.col("keep_content")),
    )
    single = staying.filter("copies = 1").select("whole.*")
    repeated = (
        staying.filter("copies > 1").dropDuplicates(["keep_id", "own_content"]).select("whole.*")
    )
    return single.unionByName(repeated)
