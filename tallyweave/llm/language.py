"""Language of whole texts: words first, then ever shorter character n-grams.

Every known word scores each language by the log of its frequency there. A word
that is not known is scored by its longest n-grams: by those of five characters
that are known, if there are none by those of four, and so on down to single
letters. The languages, words and n-grams are counted over all labelled texts.

A word is a run of letters in lower case.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import stored, whole_text

LONGEST_GRAM = 5
# The model keeps at most so many words, and n-grams of each length, over all
# languages together: the most frequent ones of each. Their counts cover all rows.
MODEL_WORDS = 200_000
MODEL_GRAMS = 40_000
MODEL_CELLS = 16_000_000  # words (or n-grams) times languages
STEPS_PER_DOUBLING = 16  # how finely counts are told apart where the model ends
SMOOTHING = 0.5  # added to every count
COUNTED = 200_000  # distinct words that a task counts before it hands them on
CACHED_WORDS = 200_000  # unseen words that a task remembers
BLOCK_WORDS = 65_536
UNKNOWN = "und"

_RUN = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> Iterator[list[str]]:
    """The words, a block at a time."""
    text = text.lower()
    if len(text) < 8 * BLOCK_WORDS:
        blocks = [_RUN.findall(text)]
    else:
        found = (match[0] for match in _RUN.finditer(text))
        blocks = iter(lambda: list(islice(found, BLOCK_WORDS)), [])
    for words in blocks:
        if not "".join(words).isalpha():  # numerals such as a raised two are no letters
            plain = "\n".join(words)
            words = "".join(c if c.isalpha() else " " for c in plain).split()
        if words:
            yield words


def grams_of(word: str, size: int) -> list[str]:
    """The n-grams of one size, edges marked; single ones are letters alone."""
    if size == 1:
        return list(word)
    marked = f"<{word}>"
    return [marked[at:at + size] for at in range(len(marked) - size + 1)]


def _counted(column: str, add) -> callable:
    """A function over Arrow batches that counts by language; `add` counts one row into a counter."""

    def out(counts: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, counter in counts.items():
            items = iter(counter.items())
            while some := list(islice(items, 50_000)):
                keys, times = zip(*some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(some)), pa.array(keys, pa.string()),
                     pa.array(times, pa.int64())], ["lang", column, "n"]
                )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for lang, *row in zip(*(batch.column(at).to_pylist() for at in range(batch.num_columns))):
                counter = counts[lang]
                add(counter, *row)
                if len(counter) * len(counts) > COUNTED:
                    yield from out(counts)
                    counts.clear()
        yield from out(counts)

    return counted


def _add_words(counter: Counter, text: str) -> None:
    for words in words_of(text):
        counter.update(words)


def _add_grams(counter: Counter, word: str, n: int) -> None:
    for size in range(1, LONGEST_GRAM + 1):
        for gram in grams_of(word, size):
            counter[gram] += n


def most_frequent(counts: DataFrame, by: list[str], most: int) -> DataFrame:
    """The rows of `counts` with the largest `n`, at most `most` per group of `by`.

    Counts are sorted into steps of equal ratio and the sizes of the steps, a
    few hundred rows a group, say which are taken: whole steps only, so that the
    choice depends on the counts alone and no task sorts a group.
    """
    step = F.floor(F.log2("n") * STEPS_PER_DOUBLING)
    sizes: dict[tuple, dict[int, int]] = defaultdict(dict)
    for *group, at, rows in counts.groupBy(*by, step.alias("_step")).count().collect():
        sizes[tuple(group)][at] = rows
    cuts = []
    for group, steps in sizes.items():
        room, cut = most, max(steps) + 1
        for at in sorted(steps, reverse=True):
            room -= steps[at]
            if room < 0:
                break
            cut = at
        cuts.append((*group, cut))
    # one row per group
    kinds = ", ".join(f"{field.name} {field.dataType.simpleString()}"
                      for field in counts.select(*by).schema)
    table = counts.sparkSession.createDataFrame(cuts, f"{kinds}, _cut long")
    return counts.join(F.broadcast(table), by).filter(step >= F.col("_cut")).drop("_cut")


def _log_frequencies(rows: pd.DataFrame, langs: list[str], key: str, totals: np.ndarray):
    """Numbers of the keys, and for each the log frequency in every language less their mean."""
    keys = sorted(set(rows[key]))
    index = dict(zip(keys, range(len(keys))))
    place = dict(zip(langs, range(len(langs))))
    counts = np.full((len(keys), len(langs)), SMOOTHING)
    counts[rows[key].map(index).to_numpy(int), rows["lang"].map(place).to_numpy(int)] += rows["n"]
    logs = np.log(counts) - np.log(totals + SMOOTHING * max(1, len(keys)))
    return index, (logs - logs.mean(axis=1, keepdims=True)).astype(np.float32)


@dataclass
class Model:
    """Languages in order, the log of their share, and log frequencies by word and n-gram."""

    langs: list[str] = field(default_factory=list)
    prior: np.ndarray = field(default_factory=lambda: np.zeros(0))
    words: dict[str, int] = field(default_factory=dict)
    word_rows: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))
    grams: dict[str, int] = field(default_factory=dict)
    gram_rows: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))

    def of_unseen(self, word: str) -> np.ndarray | float:
        """The mean over the word's longest known n-grams; 0 if it has none."""
        for size in range(LONGEST_GRAM, 0, -1):
            found = [at for at in map(self.grams.get, grams_of(word, size)) if at is not None]
            if found:
                return self.gram_rows[found].mean(axis=0, dtype=np.float64)
        return 0.0


def is_held_out(doc_id: str = "doc_id") -> Column:
    """One row in five by its id, and those without: nothing is learnt from them."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame) -> Model:
    """A model from `docs` (doc_id, text, lang): all rows with a language, but the held-out.

    Words are counted inside tasks and summed by language and word, so a
    language that most rows have is spread over its words. What comes to the
    driver has the bounds above and one row per language.
    """
    ship_package(docs.sparkSession)
    known = docs.filter(~is_held_out() & F.col("lang").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), whole_text("text").alias("text")
    )
    shares = known.groupBy("lang").count().toPandas().sort_values("lang")
    langs = shares["lang"].tolist()
    if not langs:
        return Model()
    words = stored(
        known.mapInArrow(_counted("word", _add_words), "lang string, word string, n long")
        .groupBy("lang", "word").agg(F.sum("n").alias("n")),
        "language-words",
    )
    grams = stored(
        words.mapInArrow(_counted("gram", _add_grams), "lang string, gram string, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
        .withColumn("size", F.length("gram")),
        "language-grams",
    )
    cells = max(len(langs), MODEL_CELLS // len(langs))
    kept_words = most_frequent(words, ["lang"], min(MODEL_WORDS, cells) // len(langs)).toPandas()
    kept_grams = most_frequent(
        grams, ["lang", "size"], min(MODEL_GRAMS, cells // LONGEST_GRAM) // len(langs)
    ).toPandas()

    def totals(counts: DataFrame) -> np.ndarray:
        sums = dict(counts.groupBy("lang").agg(F.sum("n")).collect())
        return np.array([float(sums.get(lang, 0)) for lang in langs])

    model = Model(langs, np.log(shares["count"].to_numpy(float) / shares["count"].sum()))
    model.words, model.word_rows = _log_frequencies(kept_words, langs, "word", totals(words))
    parts, begin = [], 0
    for size in range(1, LONGEST_GRAM + 1):
        rows = kept_grams[kept_grams["size"] == size]
        index, logs = _log_frequencies(rows, langs, "gram", totals(grams.filter(F.col("size") == size)))
        model.grams.update((gram, begin + at) for gram, at in index.items())
        parts.append(logs)
        begin += len(logs)
    model.gram_rows = np.concatenate(parts)
    return model


class Teller:
    """Tells the language of whole texts; remembers unseen words."""

    def __init__(self, model: Model):
        self.model = model
        self.index = dict(model.words)
        self.rows = np.zeros((len(model.words) + CACHED_WORDS + BLOCK_WORDS, len(model.langs)), np.float32)
        self.rows[:len(model.words)] = model.word_rows

    def numbers(self, block: list[str]) -> list[int]:
        if len(self.index) > len(self.model.words) + CACHED_WORDS:
            self.index = dict(self.model.words)
        index = self.index
        numbers = list(map(index.get, block))
        if None in numbers:
            for word, number in zip(block, numbers):
                if number is None and word not in index:
                    self.rows[len(index)] = self.model.of_unseen(word)
                    index[word] = len(index)
            numbers = list(map(index.__getitem__, block))
        return numbers

    def tell(self, texts: Iterable[str | None]) -> tuple[list[str], list[float]]:
        """The language of each text and its probability under the model."""
        langs, scores = [], []
        for text in texts:
            total, seen = self.model.prior.copy(), False
            for words in words_of(text or ""):
                seen = True
                if len(total):
                    for at in range(0, len(words), BLOCK_WORDS):
                        numbers = self.numbers(words[at:at + BLOCK_WORDS])
                        total += self.rows[numbers].sum(axis=0, dtype=np.float64)
            if not seen or not len(total):
                langs.append(UNKNOWN)
                scores.append(0.0)
                continue
            best = int(total.argmax())
            langs.append(self.model.langs[best])
            scores.append(float(1 / np.exp(np.maximum(total - total[best], -700)).sum()))
        return langs, scores


def languages(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score (0 to 1) for every row of `docs` (doc_id, text).

    The score is the probability of the language among those of the model. A
    text that is NULL, empty or without a letter is `und` with score 0, and so
    is every text if nothing was learnt. Of languages that tie, the first in
    code-point order wins. Rows stay as they are, repeated ones and NULL ids
    too; other columns are not looked at.
    """
    ship_package(docs.sparkSession)

    @F.pandas_udf("lang_pred string, score double")
    def told(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        teller = Teller(model)
        for texts in batches:
            langs, scores = teller.tell(texts)
            yield pd.DataFrame({"lang_pred": langs, "score": scores})

    return docs.select("doc_id", told(whole_text("text")).alias("_told")).select("doc_id", "_told.*")
