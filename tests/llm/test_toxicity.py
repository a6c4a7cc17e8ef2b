"""Toxicity by held-out accuracy, and its rules for odd rows."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyweave.llm import toxicity
from tallyweave.llm.toxicity import Scorer, fit, is_held_out, toxicity_scores, without_toxic

SCHEMA = "doc_id long, text string, score string, predicted double"
BAD = ["grumblor", "snarkfiend", "vexling"]


def corpus(count=600):
    pick = random.Random(10)
    words = ["".join(pick.choices("abcdehilmnoprstu", k=pick.randint(2, 8))) for _ in range(800)]
    docs, labels = [], []
    for i in range(count):
        text = pick.choices(words, k=pick.randint(5, 400))
        toxic = i % 4 == 0
        for _ in range(pick.randint(1, 3) if toxic else 0):
            text.insert(pick.randrange(len(text)), pick.choice(BAD))
        docs.append((i, " ".join(text), "s", 1.0))
        labels.append((i, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def model(spark):
    docs, labels = corpus()
    labels += [(None, 1), (5, None), (9, 0), (9, 0)]
    return fit(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_held_out_accuracy(spark, model):
    docs, labels = corpus()
    scores = toxicity_scores(spark.createDataFrame(docs, SCHEMA), model).filter(is_held_out()).collect()
    assert len(scores) > 80
    right = sum(row.predicted == dict(labels)[row.doc_id] for row in scores)
    assert right >= 0.97 * len(scores)


def test_unseen_misspellings(model):
    scorer = Scorer(model.margins(), float(model.bias[1] - model.bias[0]), model.share)
    assert (scorer.scores(["a grumblorr b", "snarkfiends c d", "Vexlingg"]) > 0.5).all()


def test_long_text_in_blocks(model, monkeypatch):
    texts = [corpus()[0][0][1] + " Grumblor", "x y z " * 500, "a"]
    parts = float(model.bias[1] - model.bias[0]), model.share
    whole = Scorer(model.margins(), *parts).scores(texts)
    monkeypatch.setattr(toxicity, "BLOCK_WORDS", 2 * toxicity.PASSAGE_WORDS)
    assert np.allclose(Scorer(model.margins(), *parts).scores(texts), whole)


def plain_score(model, text):
    """By the definition: every passage from the embeddings of its n-grams, through the softmax."""
    words = [word for block in toxicity.words_of(text) for word in block]
    if not words:
        return model.share
    bags = [toxicity.grams_of([word])[1] for word in words]
    n = min(toxicity.PASSAGE_WORDS, len(words))
    best = 0.0
    for at in range(len(words) - n + 1):
        mean = model.embeddings[np.concatenate(bags[at:at + n])].astype(float).mean(axis=0)
        row = np.exp(model.softmax.astype(float) @ mean + model.bias)
        best = max(best, row[1] / row.sum())
    return best


def test_plain_scores(model):
    texts = [text[:600] for _, text, *_ in corpus()[0][:25]] + ["", "a", "a Grumblor b", "x " * 30 + "vexling"]
    parts = float(model.bias[1] - model.bias[0]), model.share
    assert np.allclose(
        Scorer(model.margins(), *parts).scores(texts), [plain_score(model, t) for t in texts], atol=1e-4)


def test_words_in_front_turn_nothing_clean(model):
    scorer = Scorer(model.margins(), float(model.bias[1] - model.bias[0]), model.share)
    docs, labels = corpus(80)
    texts = [text for _, text, *_ in docs]
    before = scorer.scores(texts)
    for front in ("well", "well then", "one two three"):
        assert (scorer.scores([f"{front} {text}" for text in texts]) >= before - 1e-6).all()


def test_odd_rows(spark, model):
    data = [(None, None, None, None), (1, "", "x", 1.0), (1, "", "x", 1.0), (2, "grumblor " * 50_000, "", 0.0),
            (3, "!!! ...", "", 0.0)]
    df = spark.createDataFrame(data, SCHEMA)
    got = {(r.doc_id, r.score, r.predicted) for r in toxicity_scores(df, model).collect()}
    share = model.share
    assert {r for r in got if r[0] != 2} == {(None, share, 0), (1, share, 0), (3, share, 0)}
    assert {r[2] for r in got if r[0] == 2} == {1}
    left = without_toxic(df, model)
    assert left.columns == df.columns and left.count() == 4


def test_no_labels_and_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = fit(empty, labels)
    assert toxicity_scores(empty, model).count() == 0
    some = spark.createDataFrame([(1, "a b", "", 0.0)], SCHEMA)
    only = fit(some, spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int"))
    for fitted in (model, only):
        (row,) = toxicity_scores(some, fitted).collect()
        assert row.score < 1e-9 and row.predicted == 0


def test_held_out_rule(spark):
    ids = [-5, 0, 1, 17, 123456789]
    got = spark.createDataFrame([(i,) for i in ids], "doc_id long").select(
        "doc_id", is_held_out().alias("out")).collect()
    assert {r.doc_id: r.out for r in got} == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in ids}
    assert spark.range(1).select(F.crc32(F.lit("x"))).first()


def test_training_rows_come_from_usable_texts(spark, monkeypatch):
    """Labels whose text is too long or missing take no other row's place."""
    monkeypatch.setattr(toxicity, "TRAIN_ROWS", 150)
    docs, labels = corpus()
    docs += [(i, "grumblor " * 3000, "s", 1.0) for i in range(600, 3600)]
    labels += [(i, 1) for i in range(600, 6600)]  # the last 3,000 are not in docs
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda texts, toxic, share: seen.extend(toxic))
    fit(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int"))
    known = [toxic for i, toxic in labels[:600] if zlib.crc32(str(i).encode()) % 5]
    assert seen.count(1) == min(150, sum(known)) and seen.count(0) == 150
