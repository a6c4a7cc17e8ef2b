"""Cells and codes against exact search, keywords against plain sums, languages by held-out texts."""

import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tallyweave.operators import cells as ce
from tallyweave.operators import keyword as kw
from tallyweave.operators import languages as lg
from tallyweave.operators import ranking as rk
from tallyweave.operators import retrieval as rt
from tallyweave.plans import documents


def hits_of(df):
    return sorted((r.query_id, r.passage_id, r.score, r["rank"]) for r in df.collect())


def test_cells(spark):
    rng = np.random.default_rng(4)
    middles = rng.normal(size=(12, 24))
    data = middles[rng.integers(0, 12, 600)] + rng.normal(scale=0.6, size=(600, 24))
    data[300:420] = data[7]  # a fifth of all vectors are copies
    vectors = spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(data)] + [(999, None)],
        "passage_id long, vector array<double>")
    queries = vectors.filter("passage_id % 20 = 0").withColumnRenamed("passage_id", "query_id")
    model = ce.fit_cells(vectors, cells=12, parts=5)
    index = ce.cell_index(vectors, model)
    assert index.count() == 600
    exact = hits_of(rt.top_k(vectors, queries, 5, skip_same=True))
    whole = ce.near_top_k(index, vectors, queries, model, 5, 12, 600, skip_same=True,
                          slice_rows=50, block_queries=7)
    got = hits_of(whole)
    assert [hit[:2] + hit[3:] for hit in got] == [hit[:2] + hit[3:] for hit in exact]
    assert np.allclose([hit[2] for hit in got], [hit[2] for hit in exact])
    # of copies an approximate search may find others, so scores tell how good hits are
    few = hits_of(ce.near_top_k(index, vectors, queries, model, 5, 4, 150, skip_same=True))
    least = {query: score for query, _, score, rank in exact if rank == 5}
    good = sum(score >= least[query] - 1e-9 for query, _, score, _ in few)
    assert good >= 0.9 * len(exact)
    assert ce.near_top_k(index, vectors, queries.limit(0), model, 5, 4, 50).count() == 0


def plain_keywords(passages, questions, k):
    words = {i: Counter(w for w in re.split(r"[^\w]+|_", (t or "").lower()) if w) for i, t in passages}
    having = Counter(w for own in words.values() for w in own)
    mean = sum(map(Counter.total, words.values())) / len(words)
    out = []
    for query, text in questions:
        asked = set(re.split(r"[^\w]+|_", (text or "").lower())) - {""}
        scores = {}
        for i, own in words.items():
            room = 1.2 * (0.25 + 0.75 * own.total() / mean)
            some = [math.log(1 + (len(words) - having[w] + 0.5) / (having[w] + 0.5)) * own[w] * 2.2 / (own[w] + room)
                    for w in asked if w in own]
            if some:
                scores[i] = round(sum(some), 9)
        best = sorted(scores, key=lambda i: (-scores[i], i))[:k]
        out += [(query, i, rank) for rank, i in enumerate(best, 1)]
    return sorted(out)


def test_keywords(spark):
    pick = random.Random(6)
    names = [f"w{i}" for i in range(60)] + ["the", "été"]
    passages = [(i, " ".join(["the"] * pick.randint(0, 3) + pick.choices(names, k=pick.randint(0, 30))))
                for i in range(150)] + [(900, None), (901, ""), (902, passage_twice := "w1 w2"), (903, passage_twice)]
    questions = [(i, ", ".join(pick.choices([*names, "unheard"], k=4)) + " THE") for i in range(25)] + [
        (50, None), (51, "unheard")]
    docs = spark.createDataFrame(passages, "passage_id long, content string")
    asked = spark.createDataFrame(questions, "query_id long, question string")
    for slice_postings, block in ((10**6, 1000), (300, 4)):
        index = kw.inverted_index(docs, slice_postings=slice_postings)
        got = kw.keyword_top_k(index, asked, 4, block_queries=block)
        assert sorted((r.query_id, r.passage_id, r["rank"]) for r in got.collect()) == plain_keywords(
            passages, questions, 4)
    nothing = kw.inverted_index(docs.limit(0))
    assert kw.keyword_top_k(nothing, asked, 4).count() == 0


def test_fused(spark):
    one = spark.createDataFrame([(1, 10, 1), (1, 11, 2), (2, 10, 1)], "query_id long, passage_id long, rank long")
    two = spark.createDataFrame([(1, 11, 1), (1, 12, 2)], "query_id long, passage_id long, rank long")
    got = [(r.query_id, r.passage_id, r["rank"]) for r in kw.fused(one, two, k=2).collect()]
    assert sorted(got) == [(1, 10, 2), (1, 11, 1), (2, 10, 1)]


def test_languages_of_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    known = lg.profiles(docs.filter("doc_id % 5 <> 0"), "text")
    assert known.groupBy("lang").count().filter(F.col("count") > lg.PLACES).count() == 0
    unseen = docs.filter("doc_id % 5 = 0")
    told = lg.told_languages(unseen, "doc_id", "text", known).join(unseen, "doc_id")
    right = told.select(F.avg((F.col("told") == F.col("lang")).cast("int"))).first()[0]
    assert right >= 0.95


def test_odd_languages(spark):
    docs = spark.createDataFrame(
        [(1, "the thing", "en"), (2, None, "en"), (3, "12 3", "de"), (4, "und der", "de"), (5, "xyxyx", None)],
        "doc_id long, text string, lang string")
    told = {r.doc_id: r.told for r in lg.told_languages(docs, "doc_id", "text", lg.profiles(docs, "text")).collect()}
    assert told == {1: "en", 4: "de", 5: "de"}


def plain_told(docs):
    """key to (told, distance), rows of a key together."""
    def listed(counts):
        best = sorted(counts, key=lambda gram: (-counts[gram], gram))[:lg.PLACES]
        return {gram: place for place, gram in enumerate(best, 1)}

    own, by_lang = {}, {}
    for key, text, lang in docs:
        words = re.findall(r"[^\W\d_]{1,64}", (text or "").lower())
        grams = Counter(f"_{word}_"[i:i + 3] for word in words for i in range(len(word)))
        own.setdefault(key, Counter()).update(grams)
        if lang and grams:
            by_lang.setdefault(lang, Counter()).update(grams)
    known = {lang: listed(counts) for lang, counts in sorted(by_lang.items())}
    out = {}
    for key, counts in own.items():
        places = listed(counts)
        far = {lang: sum(abs(place - theirs[gram]) if gram in theirs else lg.PLACES for gram, place in places.items())
               for lang, theirs in known.items()}
        if places and key is None:  # meets no key
            out[key] = min(known), len(places) * lg.PLACES
        elif places:
            out[key] = min((distance, lang) for lang, distance in far.items())[::-1]
    return out


def test_told_languages_equal_plain_ones(spark, monkeypatch):
    pick = random.Random(8)
    sounds = {"en": ["th", "the", "ing", "ea", "st"], "de": ["sch", "der", "\u00fc", "ung", "ei"],
              "el": ["\u03bf\u03c5", "\u03ba\u03b1\u03b9", "\u03c2"], "zz": ["\U00010400", "q", "\u4e2d"], None: ["a", "e"]}

    def text(lang):
        return " 7_".join("".join(pick.choices(sounds[lang], k=pick.randint(1, 9))) for _ in range(pick.randint(1, 90)))

    docs = [(i, text(lang), lang) for i, lang in enumerate(pick.choices(list(sounds), k=60))]
    docs += [(70, "x" * 200 + " \U00010400" * 3, "en"), (71, None, "en"), (72, "12_3", "de"), (73, "\u0416\u0416", None)]
    docs += [(3, "the the thing", "en"), (3, "der ung", "de"), (None, "the thing", "en"), (None, "ung", None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3)

    def check():
        told = lg.told_languages(df, "doc_id", "text", lg.profiles(df, "text")).collect()
        assert {r.doc_id: (r.told, r.distance) for r in told} == plain_told(docs)
        assert len(told) == len(plain_told(docs))

    check()
    monkeypatch.setattr(lg.tg, "MOST_CHARS", 300)
    monkeypatch.setattr(lg.tg, "MOST_TEXTS", 4)
    check()
    none = df.filter("lang is null")
    assert lg.told_languages(none, "doc_id", "text", lg.profiles(none, "text")).filter("told is not null").count() == 0


def test_texts_are_told_without_moving(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    told = lg.told_languages(docs, "doc_id", "text", lg.profiles(docs, "text"))
    plan = told._jdf.queryExecution().executedPlan().toString()
    own = plan[plan.index("MapInArrow"):]
    assert "Exchange" not in own[:own.index("FileScan")]


def test_told_lines_count_trigrams_in_tasks(spark):
    plan = documents.told_line_filter(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    own = plan[plan.index("MapInArrow"):]
    assert "Exchange" not in own[:own.index("FileScan")]


def test_index_of_copies_and_long_texts(spark):
    docs = spark.createDataFrame(
        [(1, "a b a"), (2, "a b a"), (2, "a b a"), (3, "b " * 5_000), (4, " _-"), (5, None)],
        "passage_id long, content string")
    index = kw.inverted_index(docs)
    got = {row.term: (row.ids, row.having, row.total) for row in index.collect()}
    assert got == {"a": ([1, 2, 2], 3, 6), "b": ([1, 2, 2, 3], 4, 6)}
    assert kw.inverted_index(docs, slice_postings=2_000).select("slice").distinct().count() > 1


def test_terms_are_counted_in_tasks(spark):
    docs = spark.createDataFrame([(1, "one two three four five")], "passage_id long, content string")
    asked = spark.createDataFrame([(1, "one two three four five")], "query_id long, question string")
    shuffled = []
    made = kw.stored

    def kept(df, purpose):
        shuffled.append((purpose, df._jdf.queryExecution().executedPlan().toString()))
        return made(df, purpose)

    kw.stored = kept
    try:
        kw.inverted_index(docs)
    finally:
        kw.stored = made
    plans = dict(shuffled)
    # one exchange of whole texts, and terms are no rows before they are in their lists
    assert plans["postings"].count("Exchange hash") == 1 and "Join" not in plans["postings"]
    assert not any(word in plan for plan in plans.values() for word in ("Generate", "HashAggregate"))
    held = rk.holders(docs, asked)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in held
