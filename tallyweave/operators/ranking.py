"""How good a search is: its hits against the passages that hold what was asked for."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import stored
from . import postings as po
from . import trigrams as tg
from .keyword import line_length, line_of
from .scoring import SCORE_DIGITS

ANCHOR = 5  # terms by which a question and the passages that hold it meet


def holders(passages: DataFrame, queries: DataFrame, content: str = "content", text: str = "question") -> DataFrame:
    """(query_id, passage_id) of all passages that hold a question's terms in a row.

    The question's first `ANCHOR` terms are joined with all runs of as many
    terms of the passages by their hash, then the whole question is compared.
    Questions of fewer terms, NULL and empty ones are held by none. Ids are unique.
    """
    asked = queries.select("query_id", line_of(text).alias("_asked")).filter(line_length("_asked") >= ANCHOR)
    heads = _anchors(asked.select(
        "query_id", _padded(F.col("_asked")).alias("_asked"), F.substring_index("_asked", " ", ANCHOR).alias("line")
    ))
    places = _anchors(passages.select("passage_id", line_of(content).alias("line")))
    # pairs that met are few, and known to be before the texts are read for the whole comparison;
    # only texts that met a question move
    met = stored(places.join(heads, "_anchor").select("passage_id", "query_id", "_asked"), "met-questions")
    whole = _padded(line_of(F.col("_content"))).contains(F.col("_asked"))
    ids = stored(met.select("passage_id").distinct(), "met-passages")
    own = passages.select("passage_id", F.col(content).alias("_content")).join(ids, "passage_id", "left_semi")
    return met.join(own, "passage_id").filter(whole).select("query_id", "passage_id")


def _padded(line: Column) -> Column:
    return F.concat(F.lit(" "), line, F.lit(" "))


def _anchors(lines: DataFrame) -> DataFrame:
    """The other columns of every line with its different runs of `ANCHOR` terms, `_anchor`."""
    kept = [field for field in lines.schema.fields if field.name != "line"]
    names = [field.name for field in kept]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, some in tg.slices(batch["line"]):
                rows, runs = po.runs(batch["line"].slice(first, some), ANCHOR)
                own = [batch[name].slice(first, some).take(pa.array(rows)) for name in names]
                yield pa.RecordBatch.from_arrays([*own, pa.array(runs)], names=[*names, "_anchor"])

    return lines.mapInArrow(cut, StructType([*kept, *StructType.fromDDL("_anchor long")]))


def measures(queries: DataFrame, hits: DataFrame, relevant: DataFrame, k: int) -> DataFrame:
    """Per question: n_relevant, n_found, recall, reciprocal_rank and ndcg of its first k hits.

    `hits` has (query_id, passage_id, rank from 1), `relevant` (query_id,
    passage_id) without repeats. Questions with nothing relevant have zero
    counts and NULL measures, those whose search found nothing relevant zeros.
    """
    found = relevant.join(
        hits.filter(F.col("rank") <= k).select("query_id", "passage_id", "rank"), ["query_id", "passage_id"], "left"
    )

    def gain(rank: Column) -> Column:
        return 1 / F.log2(rank + F.lit(1.0))

    per = found.groupBy("query_id").agg(
        F.count("*").alias("n"), F.count("rank").alias("hit"), F.min("rank").alias("first"),
        F.coalesce(F.sum(gain(F.col("rank"))), F.lit(0.0)).alias("gained"),
    )
    best = F.aggregate(
        F.sequence(F.lit(1), F.least("n", F.lit(k)).cast("int")), F.lit(0.0), lambda total, rank: total + gain(rank)
    )
    return queries.select("query_id").join(per, "query_id", "left").select(
        "query_id", F.coalesce("n", F.lit(0)).alias("n_relevant"), F.coalesce("hit", F.lit(0)).alias("n_found"),
        F.round(F.col("hit") / F.col("n"), SCORE_DIGITS).alias("recall"),
        F.when(F.col("n") > 0, F.round(F.coalesce(1 / F.col("first"), F.lit(0.0)), SCORE_DIGITS))
        .alias("reciprocal_rank"),
        F.when(F.col("n") > 0, F.round(F.col("gained") / best, SCORE_DIGITS)).alias("ndcg"),
    )
