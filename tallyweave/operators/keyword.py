"""Keyword search by an inverted index, and the fusion of rankings.

The index has a posting list per term and slice of the passages. Slices are cut
by the passages' ids, so the list of a term that most passages have is spread
over all of them, and each slice is made and searched on its own. How rare a term
is counts over all slices, when it is asked for.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from . import postings as po
from .numbering import first_rows
from .scoring import SCORE_DIGITS

# The usual constants: how soon repeats stop counting, how much the length does.
REPEATS, LENGTH = 1.2, 0.75
FUSION = 60  # the usual constant of reciprocal ranks
SLICE_POSTINGS = 4_000_000  # postings that one task searches
BLOCK_QUERIES = 2_000  # queries that it searches for at a time

_HITS = "query_id long, passage_id long, score double"


def terms_of(text: Column | str) -> Column:
    """Lower-case runs of letters and digits."""
    text = F.col(text) if isinstance(text, str) else text
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(words, lambda word: word != "")


def line_of(text: Column | str) -> Column:
    """The terms of a text, in their order, with a space between them."""
    text = F.col(text) if isinstance(text, str) else text
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))


def line_length(line: Column | str) -> Column:
    """How many terms a line has."""
    line = F.col(line) if isinstance(line, str) else line
    spaces = F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit("")))
    return F.when(line == "", 0).otherwise(spaces + 1).cast("long")


def inverted_index(
    passages: DataFrame, text: str = "content", slice_postings: int = SLICE_POSTINGS
) -> DataFrame:
    """Posting lists of `passages` (passage_id, text): slice, term, ids, shares, having, total.

    A share is the saturated count of a term in a passage (BM25), which the
    passage's length lowers; times the term's rarity it is what the term adds to
    the score. `having` passages are in the list, there are `total` in all slices.
    NULL and empty texts have no postings; ids are unique longs.
    """
    # texts move as they are, to the slice whose task counts their terms and makes its lists
    lines = stored(passages.select("passage_id", line_of(text).alias("line")), "term-lines")
    whole = lines.agg(F.count("*").alias("total"), F.sum(line_length("line")).alias("length")).first()
    total, length = whole["total"], whole["length"] or 0
    mean = length / total if total else 0.0
    slices = length // slice_postings + 1

    def lists(key: tuple, part: pa.Table) -> pa.Table:
        found = po.lists(part["passage_id"].combine_chunks(), part["line"].combine_chunks(), mean, REPEATS, LENGTH)
        count = len(found["term"])
        return pa.table({
            "slice": pa.repeat(pa.scalar(key[0].as_py(), pa.int32()), count), **found,
            "having": pc.list_value_length(found["ids"]).cast(pa.int64()),
            "total": pa.repeat(pa.scalar(total, pa.int64()), count),
        })

    slice_of = F.pmod(F.xxhash64("passage_id"), F.lit(slices)).cast("int").alias("slice")
    return stored(
        lines.filter("line != ''").select(slice_of, "passage_id", "line").groupBy("slice").applyInArrow(
            lists, "slice int, term string, ids array<long>, shares array<double>, having long, total long"),
        "postings",
    )


def keyword_top_k(
    index: DataFrame, queries: DataFrame, k: int, text: str = "question",
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """The k best passages of every query: query_id, passage_id, score, rank.

    `queries` is (query_id, text). A term counts once however often the query
    has it. Passages without any term of the query are no hits; equal scores
    are ranked by id. Only the lists of terms that are asked for are read on;
    blocks of queries meet slices of the index in a task of their own, which
    hands on k hits per query, so pairs never become rows.
    """
    asked = stored(
        queries.select("query_id", F.explode(F.array_distinct(terms_of(text))).alias("term")), "asked-terms"
    )
    blocks = queries.count() // block_queries + 1
    slices = (index.agg(F.max("slice")).first()[0] or 0) + 1

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("_block")
    wanted = asked.select("term", block).distinct()
    having, total = F.sum("having"), F.max("total")
    rarity = index.select("term", "having", "total").join(
        wanted.select("term").distinct(), "term"
    ).groupBy("term").agg(F.log(1 + (total - having + 0.5) / (having + 0.5)).alias("rarity"))
    # stored, so that its size is known and a small one goes to the lists
    rare = stored(wanted.join(rarity, "term"), "wanted-terms")
    left = index.join(rare, "term").select(
        "slice", "_block", "term", "rarity", "ids", "shares")
    right = asked.select("query_id", "term", block, every(slices).alias("slice"))

    def search(lists: pa.Table, terms: pa.Table) -> pa.Table:
        owners, ids, scores = [], [], []
        if lists.num_rows:
            shares = lists["shares"].combine_chunks()
            every_id = lists["ids"].combine_chunks()
            starts = every_id.offsets.to_numpy()
            flat, place = np.unique(every_id.values.to_numpy(), return_inverse=True)
            flat_weights = shares.values.to_numpy() * np.repeat(lists["rarity"].to_numpy(), np.diff(starts))
            row_of = dict(zip(lists["term"].to_pylist(), range(lists.num_rows)))
            own: dict[int, list[str]] = {}
            for query, term in zip(terms["query_id"].to_pylist(), terms["term"].to_pylist()):
                if term in row_of:
                    own.setdefault(query, []).append(term)
            total = np.zeros(len(flat))
            for query, found in own.items():
                total[:] = 0
                for term in sorted(found):
                    row = row_of[term]
                    some = slice(starts[row], starts[row + 1])
                    total[place[some]] += flat_weights[some]
                rounded = np.round(total, SCORE_DIGITS)
                least = np.partition(rounded, -k)[-k] if len(rounded) > k else 0
                best = np.flatnonzero((rounded >= least) & (total > 0))
                best = best[np.lexsort((flat[best], -rounded[best]))][:k]
                owners.append(np.full(len(best), query, np.int64))
                ids.append(flat[best])
                scores.append(rounded[best])
        none = np.zeros(0, np.int64)
        return pa.table({
            "query_id": np.concatenate([none, *owners]), "passage_id": np.concatenate([none, *ids]),
            "score": np.concatenate([np.zeros(0), *scores]),
        })

    pair = ["_block", "slice"]
    hits = left.groupBy(*pair).cogroup(right.groupBy(*pair)).applyInArrow(search, _HITS)
    order = [F.col("score").desc(), F.col("passage_id")]
    return first_rows(hits, ["query_id"], order, k, "rank").withColumn("rank", F.col("rank").cast("long"))


def fused(*rankings: DataFrame, k: int, constant: int = FUSION) -> DataFrame:
    """One ranking of several (query_id, passage_id, rank): score is the sum of 1 / (constant + rank).

    Groups are the hits of a query for a passage, one per ranking. Scores are
    compared at as many digits as those of the search; ties go by id.
    """
    every = reduce(DataFrame.unionByName, [
        hits.select("query_id", "passage_id", (1 / (F.lit(constant) + F.col("rank"))).alias("share"))
        for hits in rankings
    ])
    summed = every.groupBy("query_id", "passage_id").agg(F.round(F.sum("share"), SCORE_DIGITS).alias("score"))
    order = [F.col("score").desc(), F.col("passage_id")]
    return first_rows(summed, ["query_id"], order, k, "rank").withColumn("rank", F.col("rank").cast("long"))
