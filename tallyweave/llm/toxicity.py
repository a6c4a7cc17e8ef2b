"""Toxicity of whole texts: bags of character n-grams under a linear softmax.

Every word is the bag of its n-grams and itself, each n-gram an embedding. The
embeddings of a passage of a few words are averaged and go through a linear
softmax of two classes; a text is as toxic as its most toxic passage, wherever
it begins, so that length does not dilute it. Embeddings and softmax are trained together in
numpy. Misspelt and inflected forms share n-grams, so they score alike.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package
from .common import stored, whole_text

NGRAMS = range(3, 6)
BUCKET_BITS = 17
BUCKETS = 1 << BUCKET_BITS  # embeddings; n-grams are hashed into them
BASE = np.uint64(0x100000001B3)  # of the polynomial that hashes an n-gram
WIDTH = 12
PASSAGE_WORDS = 4
CACHED_WORDS = 500_000  # words that a task remembers; then it starts afresh
BLOCK_WORDS = 65_536 // PASSAGE_WORDS * PASSAGE_WORDS  # words looked at at a time
# Training takes at most this many labelled rows of either class, chosen by the
# hash of their id, and of those the ones up to this length.
TRAIN_ROWS = 2_500
TRAIN_CHARS = 20_000
STEPS = 60
LEARNING_RATE = 0.3
SHARPNESS = 6.0
PRIOR_TEXTS = 5  # texts that smooth the log odds an embedding begins with
SEED = 7

_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> Iterator[list[str]]:
    """Lower-case words, a block at a time."""
    text = text.lower()
    if len(text) < 8 * BLOCK_WORDS:
        yield _WORD.findall(text)
        return
    found = (match[0] for match in _WORD.finditer(text))
    while block := list(islice(found, BLOCK_WORDS)):
        yield block


def grams_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of all words, as (number of the word, bucket) in no order.

    Every word is taken with its edges marked; it is an n-gram itself as well.
    Buckets come from polynomial hashes of the code points.
    """
    marked = [f"<{word}>" for word in words]
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = codes.astype(np.uint64)
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    ends = np.cumsum(sizes)
    word_of = np.repeat(np.arange(len(marked), dtype=np.int32), sizes)
    left = np.repeat(ends, sizes) - np.arange(len(codes))  # characters to the word's end
    powers = BASE ** np.arange(sizes.max(initial=0), dtype=np.uint64)
    whole = np.add.reduceat(codes * powers[left - 1], ends - sizes)
    numbers, hashes = [np.arange(len(marked), dtype=np.int32)], [whole * np.uint64(2) + np.uint64(1)]
    rolling = np.zeros(len(codes), np.uint64)
    for n in range(1, NGRAMS.stop):
        rolling = rolling[:len(codes) - n + 1] * BASE + codes[n - 1:]
        if n in NGRAMS:
            fits = left[:len(rolling)] >= n
            numbers.append(word_of[:len(rolling)][fits])
            hashes.append((rolling[fits] * np.uint64(8) + np.uint64(n)) * np.uint64(2))
    mixed = np.concatenate(hashes) * np.uint64(0x9E3779B97F4A7C15)
    return np.concatenate(numbers), (mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)


@dataclass
class Model:
    """Embeddings, the two softmax rows and their biases, and the share of class 1."""

    embeddings: np.ndarray = field(default_factory=lambda: np.zeros((BUCKETS, WIDTH), np.float32))
    softmax: np.ndarray = field(default_factory=lambda: np.zeros((2, WIDTH), np.float32))
    bias: np.ndarray = field(default_factory=lambda: np.zeros(2, np.float32))
    share: float = 0.0

    def margins(self) -> np.ndarray:
        """What each n-gram adds to class 1 over class 0: both layers are linear."""
        return self.embeddings @ (self.softmax[1] - self.softmax[0])


def train(texts: list[str], labels: list[int], share: float) -> Model:
    """Embeddings and softmax from whole texts with one label each.

    The loss is that of a text's worst passage; its gradient goes to the
    passages by how toxic they look. Every step cuts the texts at other words;
    in the end the bias is set for the worst of all passages. Embeddings begin at the log odds of their
    n-gram among the texts of either class, those of one text alone at zero.
    """
    model = Model(share=share)
    if len(set(labels)) < 2:
        model.bias[1] = np.clip(np.log(max(share, 1e-13) / max(1 - share, 1e-13)), -30, 30)
        return model
    index: dict[str, int] = {}
    tokens, ends = array("i"), []
    for text in texts:
        words = array("i", (
            index.setdefault(word, len(index)) for block in words_of(text) for word in block
        )) or array("i", [index.setdefault("", len(index))])
        tokens += words
        ends.append(len(tokens))
    n_words = len(index)
    word_of, gram_of = grams_of(list(index))
    by_word = np.argsort(word_of, kind="stable")
    word_of, gram_of = word_of[by_word], gram_of[by_word]
    sizes = np.bincount(word_of, minlength=n_words)
    word_end = np.cumsum(sizes)
    begin_word = word_end - sizes
    del index, by_word
    tokens, ends = np.asarray(tokens), np.array(ends)
    firsts = np.r_[0, ends[:-1]]
    token_sizes = sizes[tokens]
    cuts = [_cut(firsts, ends, shift) for shift in range(PASSAGE_WORDS)]
    target = np.array(labels, np.float64)
    balance = np.where(target == 1, 0.5 / target.sum(), 0.5 / (1 - target).sum())

    # the texts of either class that have each n-gram, as smoothed log odds
    having = np.zeros((2, BUCKETS))
    for text, (a, b) in enumerate(zip(firsts, ends)):
        own = np.unique(tokens[a:b])
        of_words = np.concatenate([gram_of[begin_word[word]:word_end[word]] for word in own])
        having[labels[text], np.unique(of_words)] += 1
    common = target.mean()
    odds = np.log(
        (having[1] + PRIOR_TEXTS * common) / (having[0] + PRIOR_TEXTS * (1 - common))
        * (1 - common) / common
    )

    pick = np.random.default_rng(SEED)
    way = np.ones(WIDTH) / np.sqrt(WIDTH)
    embeddings = odds[:, None] * way + pick.normal(0, 0.01, (BUCKETS, WIDTH))
    embeddings[having.sum(axis=0) < 2] = 0
    softmax, bias = np.stack([-way / 2, way / 2]), np.zeros(2)
    speed = [np.zeros_like(p) for p in (embeddings, softmax, bias)]
    for step in range(STEPS):
        begin, starts = cuts[step % PASSAGE_WORDS]
        lengths = np.diff(np.r_[begin, len(tokens)])
        text_of_passage = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(begin)]))
        held = np.add.reduceat(token_sizes, begin)
        way = softmax[1] - softmax[0]
        word_margin = np.add.reduceat((embeddings @ way)[gram_of], begin_word)
        logit = np.add.reduceat(word_margin[tokens], begin) / held + bias[1] - bias[0]
        worst = np.maximum.reduceat(logit, starts)
        weight = np.exp(np.maximum(SHARPNESS * (logit - worst[text_of_passage]), -700))
        weight /= np.add.reduceat(weight, starts)[text_of_passage]
        error = (1 / (1 + np.exp(-np.clip(worst, -30, 30))) - target) * balance
        by_passage = error[text_of_passage] * weight
        by_word = np.bincount(tokens, np.repeat(by_passage / held, lengths), n_words)
        by_gram = np.bincount(gram_of, by_word[word_of], BUCKETS)
        toward = by_gram @ embeddings
        grads = [
            LEARNING_RATE * len(target) * by_gram[:, None] * way,
            np.stack([-toward, toward]),
            np.array([-error.sum(), error.sum()]),
        ]
        for at, (param, grad) in enumerate(zip((embeddings, softmax, bias), grads)):
            speed[at] = 0.8 * speed[at] - LEARNING_RATE * grad
            param += speed[at]
    word_margin = np.add.reduceat((embeddings @ (softmax[1] - softmax[0]))[gram_of], begin_word)
    worst = np.array([
        _worst(word_margin[tokens[a:b]], token_sizes[a:b]) for a, b in zip(firsts, ends)
    ])
    bias = _balanced(worst, target, balance, bias[1] - bias[0])
    return Model(*(p.astype(np.float32) for p in (embeddings, softmax, bias)), share=share)


def _cut(firsts: np.ndarray, ends: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Where passages begin if texts are cut `shift` words later, and each text's first passage."""
    parts = [np.r_[a:a + 1, a + (shift or PASSAGE_WORDS):b:PASSAGE_WORDS] for a, b in zip(firsts, ends)]
    return np.concatenate(parts), np.cumsum([0, *map(len, parts[:-1])])


def _worst(sums: np.ndarray, sizes: np.ndarray) -> float:
    """The largest mean of a passage: every PASSAGE_WORDS words in a row, or all if there are fewer."""
    if len(sums) <= PASSAGE_WORDS:
        return float(sums.sum() / sizes.sum())
    totals = [np.cumsum(np.r_[0.0, values]) for values in (sums, sizes)]
    over, under = (total[PASSAGE_WORDS:] - total[:-PASSAGE_WORDS] for total in totals)
    return float((over / under).max())


def _balanced(worst: np.ndarray, target: np.ndarray, balance: np.ndarray, start: float) -> np.ndarray:
    """The biases under which the worst passages are told apart best."""
    shift = start
    for _ in range(STEPS):
        chance = 1 / (1 + np.exp(-np.clip(worst + shift, -30, 30)))
        slope = (balance * chance * (1 - chance)).sum()
        if slope < 1e-9:
            break
        shift -= np.clip((balance * (chance - target)).sum() / slope, -1, 1)
    return np.array([-shift / 2, shift / 2])


class _Words(dict):
    """Numbers of words; `sums` and `sizes` have their n-grams by number."""

    def __init__(self, margins: np.ndarray):
        self.margins = margins
        self.sums = np.zeros(CACHED_WORDS + BLOCK_WORDS)
        self.sizes = np.zeros(CACHED_WORDS + BLOCK_WORDS)

    def numbers(self, block: list[str]) -> list[int]:
        if len(self) > CACHED_WORDS:
            self.clear()
        new = [word for word in set(block) if word not in self]
        if new:
            begin, count = len(self), len(new)
            word_of, gram_of = grams_of(new)
            self.sums[begin:begin + count] = np.bincount(word_of, self.margins[gram_of], count)
            self.sizes[begin:begin + count] = np.bincount(word_of, minlength=count)
            self.update(zip(new, range(begin, begin + count)))
        return list(map(self.__getitem__, block))


class Scorer:
    """Scores whole texts; remembers words."""

    def __init__(self, margins: np.ndarray, bias: float, share: float):
        self.words, self.bias, self.share = _Words(margins), bias, share

    def scores(self, texts) -> np.ndarray:
        """The score of each text: 0 to 1, the share of class 1 if it has no word."""
        out, words = [], self.words
        for text in texts:
            worst, sums, sizes = -np.inf, np.zeros(0), np.zeros(0)
            for block in words_of(text or ""):
                for at in range(0, len(block), BLOCK_WORDS):
                    numbers = words.numbers(block[at:at + BLOCK_WORDS])
                    # the last words of the block before go on into this one
                    sums = np.r_[sums[1 - PASSAGE_WORDS:], words.sums[numbers]]
                    sizes = np.r_[sizes[1 - PASSAGE_WORDS:], words.sizes[numbers]]
                    if len(sums) >= PASSAGE_WORDS:
                        worst = max(worst, _worst(sums, sizes))
            if worst == -np.inf and len(sums):
                worst = _worst(sums, sizes)
            out.append(
                self.share if worst == -np.inf
                else 1 / (1 + np.exp(-np.clip(worst + self.bias, -30, 30)))
            )
        return np.array(out, float)


def is_held_out(doc_id: str = "doc_id"):
    """One row in five by its id; nothing is learnt from those."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from `docs` (doc_id, text) and `labels` (doc_id, toxic).

    Held-out ids, NULL ids and NULL labels are left out; an id with several
    labels counts as toxic if one says so. Without both classes the model
    gives every text the share of toxic labels, 0 if there are none.
    """
    known = (
        labels.select("doc_id", "toxic").filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .filter(~is_held_out()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    )
    share = known.agg(F.avg("toxic")).first()[0] or 0.0
    order = F.xxhash64("doc_id", F.lit(SEED))
    # only ids with a text short enough are picked from, so that those without take no place
    usable = stored(
        known.join(
            docs.filter(F.length(whole_text("text")) <= TRAIN_CHARS).select("doc_id").distinct(),
            "doc_id", "left_semi",
        ),
        "toxic-labels",
    )
    picked = usable.filter("toxic = 0").orderBy(order, "doc_id").limit(TRAIN_ROWS).unionByName(
        usable.filter("toxic = 1").orderBy(order, "doc_id").limit(TRAIN_ROWS)
    )
    # at most 2 * TRAIN_ROWS ids are sent to every task, and as many texts come back
    rows = (
        docs.select("doc_id", whole_text("text").alias("text"))
        .filter(F.length("text") <= TRAIN_CHARS)
        .join(F.broadcast(picked), "doc_id")
        .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
        .toPandas().sort_values("doc_id")
    )
    return train(rows["text"].tolist(), rows["toxic"].tolist(), float(share))


def scored_by(docs: DataFrame, model: Model, text):
    """The score of a text column of `docs` under `model`."""
    ship_package(docs.sparkSession)
    margins = model.margins().astype(np.float32)
    bias, share = float(model.bias[1] - model.bias[0]), model.share

    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(margins, bias, share)
        for texts in batches:
            yield pd.Series(scorer.scores(texts))

    return score(whole_text(text))


def toxicity_scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and predicted (1 from 0.5 on) for every row of `docs`.

    NULL and empty texts get the share of toxic labels as their score. Rows
    stay as they are, repeated ones and NULL ids too; only `doc_id` and `text`
    are looked at, and the score depends on the text alone.
    """
    return docs.select("doc_id", scored_by(docs, model, "text").alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0)
    )


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs` that the model does not call toxic, with all their columns, whatever their names."""
    scored = docs.select(F.struct("*").alias("whole"), scored_by(docs, model, "text").alias("score"))
    return scored.filter("score < 0.5").select("whole.*")
