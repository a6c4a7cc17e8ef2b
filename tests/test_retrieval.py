"""Exact search against NumPy, text vectors and index upkeep."""

import random
import re

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyweave.operators import retrieval as rt
from tallyweave.operators.scoring import SCORE_DIGITS, Best, BestOfUnits
from tallyweave.operators.upkeep import current, replace_table
from tallyweave.plans.retrieval import _found, _near_texts
from tallyweave.streaming import index as ix

TEXTS = ["Taxes are due in April.", "Wages and taxes, wages!", "A song about rain", "", "rain rain"]


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    data = rng.normal(size=(120, 8)).astype(np.float32)
    data[40:80] = data[5]  # a third of all vectors are copies
    df = spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(data)],
        "passage_id long, vector array<float>").repartition(5).cache()
    return data.astype(np.float64), df


def brute_force(data, k, skip_same):
    hits = []
    for q, vector in enumerate(data):
        scores = np.round(data @ vector, SCORE_DIGITS)
        order = [i for i in sorted(range(len(data)), key=lambda i: (-scores[i], i))
                 if not (skip_same and i == q)]
        hits += [(q, p, rank + 1) for rank, p in enumerate(order[:k])]
    return sorted(hits)


@pytest.mark.parametrize("how", [
    {}, {"skip_same": True}, {"block_bytes": 500, "slice_bytes": 1_500, "skip_same": True}])
def test_top_k_equals_brute_force(vectors, how):
    data, df = vectors
    queries = df.withColumnRenamed("passage_id", "query_id")
    hits = rt.top_k(df, queries, 5, **how)
    got = sorted((r.query_id, r.passage_id, r["rank"]) for r in hits.collect())
    assert got == brute_force(data, 5, how.get("skip_same", False))


def test_filter_and_no_queries(vectors):
    _, df = vectors
    queries = df.withColumnRenamed("passage_id", "query_id")
    hits = rt.filtered_top_k(df, queries, 2, F.col("passage_id") > 100)
    assert hits.count() == 240 and hits.filter("passage_id <= 100").count() == 0
    assert rt.top_k(df, queries.filter("query_id < 0"), 2).count() == 0


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(10, [nan, 1.0]), (11, [None, 1.0]), (12, [inf, 1.0]), (13, None)]
    corpus = spark.createDataFrame(
        [(i, [1.0, float(i)]) for i in range(5)] + odd, "passage_id long, vector array<double>")
    queries = spark.createDataFrame([(1, [1.0, 1.0]), (2, [nan, 0.0])], "query_id long, vector array<double>")
    hits = rt.top_k(corpus.coalesce(1), queries, 4)
    assert [(r.query_id, r.passage_id) for r in hits.orderBy("rank").collect()] == [(1, 4), (1, 3), (1, 2), (1, 1)]
    wrong = corpus.unionByName(spark.createDataFrame([(77, [1.0] * 3)], corpus.schema))
    with pytest.raises(Exception, match="_id [0-9]+ has a vector of [0-9]+ elements, not 3"):
        rt.top_k(wrong, queries, 2).collect()


def test_contexts_in_rank_order(spark):
    hits = spark.createDataFrame(
        [(1, 2, "b", "u2"), (1, 1, "a", "u1"), (2, 1, "c", "u3")],
        "query_id long, rank long, content string, source string")
    assert rows(rt.contexts(hits)) == [(1, "a\n\nb", ["u1", "u2"]), (2, "c", ["u3"])]


def test_text_vectors_by_hand(spark):
    """Weights follow from word counts; the bucket only picks the place."""
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string")
    model = rt.text_model(df, "text", features=4096)
    got = {r.id: np.array(r.vector) for r in rt.text_vectors(model, df).collect()}
    split = [[w for w in "".join(c if c.isalnum() else " " for c in t.lower()).split()] for t in TEXTS]
    for i, own in enumerate(split):
        weights = {
            w: own.count(w) * np.log((len(split) + 1) / (sum(w in s for s in split) + 1))
            for w in set(own)}
        norm = np.sqrt(sum(x * x for x in weights.values()))
        expected = sorted(x / norm for x in weights.values() if x) if norm else []
        found = sorted(x for x in got[i] if x)
        assert np.allclose(found, expected, atol=1e-6)


@pytest.mark.parametrize("how", [
    {}, {"block_bytes": 300, "slice_bytes": 900}, {"task_pairs": 1}])
def test_top_k_by_counts_equals_top_k_of_vectors(spark, how):
    pick = random.Random(5)
    texts = [" ".join(pick.choices([f"w{i}" for i in range(40)], k=pick.randint(0, 12))) for _ in range(80)]
    docs = spark.createDataFrame(
        [(i, text) for i, text in enumerate([*texts, None, "", texts[3], "unheard"])], "passage_id long, text string")
    asked = docs.filter("passage_id % 3 = 0").withColumnRenamed("passage_id", "query_id")
    model, counts = rt.model_and_counts(docs, "passage_id", "text", 64)
    _, vectors = rt.model_and_vectors(docs, "passage_id", "text", 64, kind="float64")
    queries = rt.text_vectors(model, asked, "float64").select("query_id", "vector")
    near = rt.top_k_by_counts(counts, rt.word_counts(model, asked, "query_id"), 5, model, **how)
    assert rows(near) == rows(rt.top_k(vectors, queries, 5))
    assert rt.top_k_by_counts(counts.limit(0), rt.word_counts(model, asked, "query_id"), 5, model).count() == 0


def test_units_in_single_precision_give_the_hits_of_double():
    """Before, every pair was scored in double precision, rounded and sorted out."""
    pick = np.random.default_rng(4)
    units = pick.random((900, 64)) * (pick.random((900, 64)) < 0.2)
    units[700:] = units[pick.integers(0, 700, 200)] + pick.integers(0, 2, 200)[:, None] * 1e-7  # near ties
    units[[3, 5, 400, 401]] = 0
    norms = np.linalg.norm(units, axis=1)[:, None]
    units = units / np.where(norms, norms, 1)
    queries = np.concatenate([units[::7], np.zeros((3, 64)), np.eye(64)[:5]])
    for k in (1, 4, 1_000):
        best, quick = Best(np.arange(len(queries)), queries, k, False), BestOfUnits(
            np.arange(len(queries)), queries, k)
        for at in (0, 2, 300):
            some = slice(at, {0: 2, 2: 300, 300: 900}[at])
            best.add(np.arange(900)[some], units[some])
            quick.add(np.arange(900)[some], units[some])
        want, got = best.hits(), quick.hits()
        assert all((want[name] == got[name]).all() for name in ("query_id", "passage_id"))
        assert np.allclose(want["score"], got["score"], rtol=0, atol=1.1e-9)


def test_words_are_counted_in_tasks_as_the_model_counts_them(spark, monkeypatch):
    """Before, every occurrence of a word was hashed on its own."""
    monkeypatch.setattr(rt, "TEXT_BYTES", 30)
    texts = [*TEXTS, None, "", " -- ", "ÀÉ\u0130 x²x ٣ 漢字 漢字", "a" * 50, "word " * 300]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    model, counts = rt.model_and_counts(df, "id", "text", 64)
    assert rows(counts) == rows(rt.word_counts(model, df, "id"))
    assert np.allclose(model.stages[-2].idf.toArray(), rt.text_model(df, "text", 64).stages[-2].idf.toArray())


def test_text_search_moves_counts_and_no_vectors(spark):
    asked = spark.createDataFrame([(1, "the of")], "query_id long, question string")
    hits = _near_texts(spark, "/root/testdata/sf0.001", asked, "question", 4)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    moved = re.findall(r"Exchange hashpartitioning\(_block.*\n.*", plan)
    assert len(moved) == 2 and all("buckets" in part and "vector" not in part for part in moved)
    found = _found(spark, "/root/testdata/sf0.001", asked, "question")
    assert "Exchange hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()


def test_index_sync(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string")
    model = rt.text_model(df, "text", features=64)
    index = rt.text_vectors(model, df.filter("id < 4"))
    now = df.filter("id > 0").withColumn(
        "text", F.when(F.col("id") == 2, F.lit("rain again")).otherwise(F.col("text")))
    synced = rt.sync_index(index, now, "id", "text", model)
    assert rows(synced) == rows(rt.text_vectors(model, now))


def test_index_follows_a_stream(spark, tmp_path):
    schema = "id long, text string, version long"
    model = rt.text_model(
        spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string"), "text", features=64)
    replace_table(rt.text_vectors(model, spark.createDataFrame([], schema)), "followed")
    log = str(tmp_path / "log")

    def arrive(data):
        spark.createDataFrame(data, schema).write.mode("append").json(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).json(str(tmp_path / "in"))
        ix.follow_documents(stream, "id", "text", "version", model, log,
                            str(tmp_path / "progress")).awaitTermination()
        now = ix.index_now(
            current(spark, "followed"), spark.read.parquet(log), "id", "text", "version")
        assert rows(now) == rows(rt.text_vectors(model, now.select("id", "text", "version")))
        return [(r.id, r.text) for r in now.orderBy("id").collect()]

    assert arrive([(1, "old", 1), (1, "new", 2), (2, "rain", 1)]) == [(1, "new"), (2, "rain")]
    for _ in range(2):
        ix.compact(spark, "followed", spark.read.parquet(log), "id", "text", "version")
        assert current(spark, "followed").count() == 2
    assert arrive([(2, None, 2), (3, "song", 1), (1, "late", 1)]) == [(1, "new"), (3, "song")]


def test_every_document_can_be_found(spark):
    folder = "/root/testdata/sf0.001"
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    asked = documents.select(F.col("doc_id").alias("query_id"), F.col("text").alias("question"))
    first = _found(spark, folder, asked, "question").filter("rank = 1").join(asked, "query_id").collect()
    assert len(first) == documents.count()
    # its own vector is nearest to each, unless no word of it is rare enough to weigh
    assert sum(abs(row.score - 1) < 1e-6 for row in first) >= 0.99 * len(first)
