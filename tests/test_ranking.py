"""Ranking measures against values worked out by hand."""

import math

from tallyweave.operators import ranking as rk


def test_holders(spark):
    docs = spark.createDataFrame(
        [(1, "x One two, three four five six y"), (2, "one two three four five sixth"), (3, None), (4, ""),
         (5, "one two three four five one two three four five six"), (6, "one two")],
        "passage_id long, content string")
    asked = spark.createDataFrame(
        [(1, "one two three four five six"), (2, "one two"), (3, None), (4, ""), (5, "one two three four five")],
        "query_id long, question string")
    got = sorted(tuple(row) for row in rk.holders(docs, asked).collect())
    assert got == [(1, 1), (1, 5), (5, 1), (5, 2), (5, 5)]
    assert rk.holders(docs.limit(0), asked).count() == rk.holders(docs, asked.limit(0)).count() == 0


def test_measures(spark):
    asked = spark.createDataFrame([(1,), (2,), (3,), (4,)], "query_id long")
    hits = spark.createDataFrame(
        [(1, 10, 1), (1, 11, 2), (1, 12, 3), (2, 10, 1), (3, 10, 1)], "query_id long, passage_id long, rank long")
    relevant = spark.createDataFrame([(1, 11), (1, 12), (1, 13), (2, 99), (4, 10)], "query_id long, passage_id long")
    got = {row.query_id: tuple(row)[1:] for row in rk.measures(asked, hits, relevant, 2).collect()}
    ndcg = round((1 / math.log2(3)) / (1 + 1 / math.log2(3)), 9)
    assert got == {1: (3, 1, round(1 / 3, 9), 0.5, ndcg), 2: (1, 0, 0.0, 0.0, 0.0),
                   3: (0, 0, None, None, None), 4: (1, 0, 0.0, 0.0, 0.0)}
