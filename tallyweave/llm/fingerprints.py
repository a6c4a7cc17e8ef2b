"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every shingle hash below a fixed fraction of all hashes, so its
size follows the text and sketches of very unequal texts compare without bias:
the share of the smaller sketch found in the larger is its containment. A text
with few hashes below that limit keeps its least ones up to a fixed number and
records the limit that they stand for; a text of no more shingles keeps all.
Two sketches are compared below the lower of their two limits, where both are
complete, and so are merged ones.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import let
from .common import stored, whole_text

SHINGLE_WORDS = 5
FRACTION = 4  # one hash in so many is kept
LEAST = 128  # hashes that a text keeps at least, if it has them
HIGHEST = (1 << 63) - 1
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"


def shingle_hashes(text: Column, words: int = SHINGLE_WORDS) -> Column:
    """64-bit hashes of all shingles of `words` words, in order, repeats included.

    A text of fewer words is one shingle, a text without words none.
    """
    trimmed = F.btrim(text, F.lit(WHITE))
    parts = F.split(trimmed, r"[\x20\x09-\x0D]+")
    shingles = let(parts, lambda own: F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(own) - (words - 1), F.lit(1))),
        lambda at: F.xxhash64(F.slice(own, at, words)),
    ))
    return F.when(trimmed == "", F.array().cast("array<long>")).otherwise(shingles)


def sketch(
    text: Column, words: int = SHINGLE_WORDS, fraction: int = FRACTION, least: int = LEAST
) -> Column:
    """The limit of a text's sketch and its distinct hashes up to it, ascending.

    A text without words has the highest limit and no hash.
    """
    fixed = F.lit(-(1 << 63) + (1 << 64) // fraction - 1 if fraction > 1 else HIGHEST)

    def kept(own: Column) -> Column:
        lowest = F.coalesce(F.try_element_at(own, F.lit(least)), F.lit(HIGHEST))
        return let(F.greatest(fixed, lowest), lambda limit: F.struct(
            limit.alias("limit"), F.filter(own, lambda value: value <= limit).alias("hashes")
        ))

    return let(F.sort_array(F.array_distinct(shingle_hashes(text, words))), kept)


def _below(one: Column, limit: Column) -> Column:
    return F.filter(one["hashes"], lambda value: value <= limit)


def merged(left: Column, right: Column) -> Column:
    """The sketch of two texts' shingles together, below the lower of the two limits."""
    return let(F.least(left["limit"], right["limit"]), lambda limit: F.struct(
        limit.alias("limit"),
        F.sort_array(F.array_union(_below(left, limit), _below(right, limit))).alias("hashes"),
    ))


def containment(left: Column, right: Column) -> Column:
    """The share of the smaller sketch that the larger has, below the lower of the two limits.

    Two texts without words are alike; a text that has no hash there is not.
    """
    def share(both: Column) -> Column:
        least = F.least(F.size(both["l"]), F.size(both["r"]))
        nothing = (F.size(left["hashes"]) == 0) & (F.size(right["hashes"]) == 0)
        return F.when(least > 0, F.size(F.array_intersect(both["l"], both["r"])) / least).otherwise(
            nothing.cast("double")
        )

    limit = F.least(left["limit"], right["limit"])
    return let(F.struct(_below(left, limit).alias("l"), _below(right, limit).alias("r")), share)


def written(one: Column) -> Column:
    """A sketch as text: its limit and its hashes in 16 hex digits each, one after the other."""
    return F.array_join(F.transform(
        F.array_prepend(one["hashes"], one["limit"]),
        lambda value: F.lpad(F.lower(F.hex(value)), 16, "0"),
    ), "")


def followers(keys: DataFrame) -> DataFrame:
    """`keys` (key, tie, ...; distinct) with the one that follows each, as next_key, next_tie.

    The order is descending key, then tie, ties that are odd after all others;
    the last is followed by the first. Keys are cut into ranges and stored;
    inside a range a window looks ahead, and only each range's first key meets
    the other ranges' first keys in one task.
    """
    order = [F.col("tie").bitwiseAND(1), F.col("key").desc(), F.col("tie")]
    ranged = stored(
        keys.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "key-ranges"
    )
    inside = Window.partitionBy("range").orderBy(*order)
    placed = (
        ranged.withColumn("place", F.row_number().over(inside))
        .withColumn("ahead", F.lead(F.struct("key", "tie")).over(inside))
    )
    firsts = placed.filter("place = 1").select("range", F.struct("key", "tie").alias("first"))
    ranges = Window.orderBy("range")
    every = ranges.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    onward = firsts.select(
        "range",
        F.coalesce(F.lead("first").over(ranges), F.first("first").over(every)).alias("other"),
    )
    following = F.coalesce("ahead", "other")
    return placed.join(onward, "range").select(
        *keys.columns, following["key"].alias("next_key"), following["tie"].alias("next_tie")
    )


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """One row per row of `docs` (doc_id, text): sketches of the text and an edited one.

    The edited text has its last floor(n_chars / 3) code points replaced by as
    many of the beginning of the next document (all, if it has fewer), in
    descending doc_id; the last document is followed by the first. Columns:
    doc_id, n_chars, edited, fingerprint and edited_fingerprint (structs of limit
    and hashes), near_edited and near_next (containment of the sketches).

    Rows with one doc_id but other texts follow each other by text hash; rows
    equal in both are one document with one next. NULL texts are empty, NULL
    ids come after all others. A text without words has an empty sketch. No
    rows give no rows; other columns of `docs` are not looked at.
    """
    # a row's address has no NULL: the lowest bit of the text hash says if the id is one
    kind = docs.schema["doc_id"].dataType
    text = whole_text("text")
    missing = F.col("doc_id").isNull().cast("long")
    address = [
        F.coalesce("doc_id", F.lit(0).cast(kind)).alias("key"),
        F.xxhash64(text).bitwiseAND(F.lit(-2)).bitwiseOR(missing).alias("tie"),
    ]
    base = docs.select(*address, text.alias("text"))
    keys = docs.select(*address, F.length(text).alias("n_chars")).groupBy("key", "tie").agg(
        F.max("n_chars").alias("n_chars")
    )
    pairs = followers(keys).select(
        F.col("key").alias("own_key"), F.col("tie").alias("own_tie"),
        F.floor(F.col("n_chars") / 3).cast("int").alias("cut"),
        F.col("next_key").alias("key"), F.col("next_tie").alias("tie"),
    )
    # what a document gives to the one before it: the beginning that replaces the other's
    # end, and its sketch. Its equal rows give the same.
    given = (
        base.join(pairs, ["key", "tie"])
        .select(F.col("own_key").alias("key"), F.col("own_tie").alias("tie"),
                F.expr("left(text, cut)").alias("head"), sketch(F.col("text")).alias("next_sketch"))
        .groupBy("key", "tie")
        .agg(F.first("head").alias("head"), F.first("next_sketch").alias("next_sketch"))
    )
    n_chars = F.length("text")
    kept_chars = (n_chars - F.floor(n_chars / 3)).cast("int")
    both = base.join(given, ["key", "tie"]).select(
        F.when(F.col("tie").bitwiseAND(1) == 0, F.col("key")).alias("doc_id"),
        n_chars.cast("long").alias("n_chars"),
        F.concat(F.substring(F.col("text"), F.lit(1), kept_chars), F.col("head")).alias("edited"),
        sketch(F.col("text")).alias("fingerprint"), "next_sketch",
    )
    return both.withColumn("edited_fingerprint", sketch(F.col("edited"))).select(
        "doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint",
        containment(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        containment(F.col("fingerprint"), F.col("next_sketch")).alias("near_next"),
    )
