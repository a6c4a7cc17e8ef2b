"""The pipeline against plain versions of its stages."""

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from test_exact import plain
from test_mixing import plain_mix
from test_simhash import plain_print, plain_roots, signed
from tallyweave.llm.queries import MIX_SEED, MIX_WEIGHTS, WORDS
from tallyweave.llm.toxicity import Scorer, fit

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string"
BAD = ["grumblor", "snarkfiend", "vexling"]


def sample():
    pick = random.Random(16)
    words = ["".join(pick.choices("abcdehilmnoprstu", k=pick.randint(2, 8))) for _ in range(900)]
    texts = [" ".join(pick.choices(words, k=pick.randint(1, 200))) for _ in range(160)]
    texts += ["", None, " \n "]
    labels, rows = [], []
    for i in range(500):
        text = pick.choice(texts)
        own = (text or "").split(" ")
        if text and pick.random() < 0.3:
            own.insert(pick.randrange(len(own)), "extra")
        toxic = bool(text) and pick.random() < 0.2
        if toxic:
            own.insert(pick.randrange(len(own)), pick.choice(BAD))
        text = text and (" ".join(own) if pick.random() < 0.7 else "  ".join(own))
        labels.append((i, int(toxic)))
        rows.append((i, text, pick.choice(["en", "de", None]), pick.choice(["src0"] * 3 + ["src1", "src2"]), len(text or ""), "x"))
    return rows, labels


@pytest.fixture
def folder(spark, tmp_path):
    rows, labels = sample()
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def first_of(rows, key):
    least = {}
    for row in sorted(rows):
        least.setdefault(key(row), row)
    return list(least.values())


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    scorer = Scorer(model.margins(), float(model.bias[1] - model.bias[0]), model.share)
    rows, labels = sample()
    kept = [row for row in rows if scorer.scores([row[1]])[0] < 0.5]
    assert sum(dict(labels)[row[0]] for row in kept) <= 2 and len(kept) > 300
    kept = first_of(kept, lambda row: plain(row[1]))
    roots = plain_roots({signed(plain_print(row[1])) for row in kept})
    kept = first_of(kept, lambda row: roots[signed(plain_print(row[1]))])
    domain = lambda source: hashlib.md5(source.encode()).hexdigest()[0]
    taken = {r[0] for r in plain_mix(kept, corpus_pipeline.MIX_SHARE, 1, MIX_SEED, MIX_WEIGHTS, domain)}
    assert 0 < len(taken) < len(kept)
    words = Tokenizer.from_file(public_tokenizers.path(WORDS))
    expected = []
    for row in kept:
        if row[0] in taken:
            ids = words.encode(row[1] or "", add_special_tokens=False).ids
            texts = " ".join(map(str, ids)), words.decode(ids, skip_special_tokens=False)
            expected.append((row[0], len(ids), *(hashlib.sha256(t.encode()).hexdigest() for t in texts)))
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect())) == sorted(expected)


def test_columns_stay(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns
