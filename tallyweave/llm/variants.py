"""Spelling variants: words one edit apart, joined by asymmetric q-chunks.

Of two words that differ by one edit the shorter (of equal ones, either) gives
disjoint chunks, its halves; the other gives the grams of that length that lie
within a shift of one of them. One edit leaves a chunk whole: the front at its
place, the back moved by the difference in length, at most one. The half with
the edit is cut in the same way again and its whole quarter joins the key, so
that a half that most words have, such as a common ending, does not bring them
all together: what is still free is one quarter. It is verified in the join, so
pairs that are not near never become rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import stored, whole_text

SHORTEST = 7  # code points
SEEN = 2  # occurrences
TIMES = 10  # a form is so many times as frequent
PARTS = 4  # two chunks, each of two
COUNTED = 200_000  # distinct words that a task counts before it hands them on
LONG_TEXT = 1 << 22

_RUN = re.compile("[a-zÀ-ÿ]+")


def misspelt(every: int) -> Callable[[str, list[str]], list[str]]:
    """Deletes one code point of a run if `every` divides the CRC-32 of `<doc_id>:<run>`."""

    def changed(doc_id: str, runs: list[str]) -> list[str]:
        begin = zlib.crc32(f"{doc_id}:".encode())
        out = []
        for run in runs:
            crc = zlib.crc32(run.encode(), begin)
            if crc % every == 0:
                at = crc % len(run)
                run = run[:at] + run[at + 1:]
            out.append(run)
        return out

    return changed


def word_counts(docs: DataFrame, change=None, shortest: int = SHORTEST) -> DataFrame:
    """word, n: how often each lower-case run of Latin letters occurs in `docs` (doc_id, text).

    Only A-Z become lower-case. `change` gives the runs of a document as they
    count, one for each. NULL texts have no words, a NULL id is written as nothing.
    """
    ship_package(docs.sparkSession)

    def out(counts: Counter) -> Iterator[pa.RecordBatch]:
        items = iter(counts.items())
        while some := list(islice(items, 50_000)):
            words, times = zip(*some)
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array(times, pa.int64())], ["word", "n"]
            )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = text.encode().lower().decode()
                own = Counter(_RUN.findall(text)) if len(text) < LONG_TEXT else Counter(
                    match[0] for match in _RUN.finditer(text)
                )
                runs = [run for run in own if len(run) >= shortest]
                for run, word in zip(runs, change(doc_id, runs) if change else runs):
                    if len(word) >= shortest:
                        counts[word] += own[run]
                if len(counts) > COUNTED:
                    yield from out(counts)
                    counts.clear()
        yield from out(counts)

    return (
        docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"),
                    whole_text("text").alias("text"))
        .mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    )


def _cut(size: Column, part: int) -> Column:
    """Where a part of a word of `size` code points begins, from 0."""
    return F.floor(size * part / PARTS).cast("int")


def _keys(size: Column, longer: Column) -> Column:
    """Per part of a word of `size`: the rest around it as a key, and what the part holds.

    The row's own word has `longer` code points more (0 or 1), all in the part.
    """
    word = F.col("word")
    out = []
    for part in range(PARTS):
        begin, end = _cut(size, part), _cut(size, part + 1) + longer
        front = word.substr(F.lit(1), begin)
        back = word.substr(end + 1, F.length(word))
        out.append(F.struct(
            F.concat(size.cast("string"), F.lit(f":{part}:"), front, F.lit(":"), back).alias("key"),
            word.substr(begin + 1, end - begin).alias("free"),
        ))
    return F.explode(F.array(*out)).alias("k")


def links(words: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """Pairs of near words of `words` (word, n), each once: a, a_n, b, b_n.

    Two words are near if they differ by exactly one inserted, deleted or
    replaced code point. Each has at least `shortest` code points, which are at
    least as many as there are parts.
    """
    size = F.length("word")
    chunks = words.select("word", "n", _keys(size, F.lit(0))).select(
        F.col("word").alias("a"), F.col("n").alias("a_n"), "k.key", F.col("k.free").alias("a_free")
    )
    grams = words.select("word", "n", F.explode(F.array(F.lit(0), F.lit(1))).alias("longer")).filter(
        size - F.col("longer") >= shortest
    ).select("word", "n", "longer", _keys(size - F.col("longer"), F.col("longer"))).select(
        F.col("word").alias("b"), F.col("n").alias("b_n"), "longer", "k.key",
        F.col("k.free").alias("b_free"),
    )
    near = (F.col("longer") == 1) | (F.col("a") < F.col("b"))
    found = chunks.join(grams, "key").filter(
        near & (F.levenshtein("a_free", "b_free", 1) == 1)
    )
    # an edit beside a border is found from both sides
    return found.groupBy("a", "b").agg(F.first("a_n").alias("a_n"), F.first("b_n").alias("b_n"))


def followed(forms: DataFrame) -> DataFrame:
    """word, root for `forms` (word, form): where the forms of a word end.

    Every round a word takes the root of its root, so the rounds are the
    logarithm of the longest chain, which is short as each form is many times
    as frequent. Rounds are written to the shared folder.
    """
    roots = stored(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        step = roots.join(onward, "root", "left")
        after = stored(
            step.select("word", F.coalesce("onward", "root").alias("root"),
                        F.col("onward").isNotNull().alias("moved")),
            "variant-roots",
        )
        if after.filter("moved").isEmpty():
            return after.drop("moved")
        roots = after.drop("moved")


def variants(
    docs: DataFrame, change=None, shortest: int = SHORTEST, seen: int = SEEN, times: int = TIMES
) -> DataFrame:
    """The words of `docs` (doc_id, text) grouped by spelling: word, form, root, n, n_near, form_n.

    Words have at least `shortest` code points and occur at least `seen` times.
    n_near counts the near words. form is the near word of largest n (ties: the
    smallest in code-point order), if that is at least `times` the word's own
    n, form_n its n; else both are NULL. root is where the forms end, the word
    itself if it has none.

    Every row counts, repeated ones too; NULL and empty texts have no words, no
    words give no rows; other columns of `docs` are not looked at.
    """
    words = stored(
        word_counts(docs, change, shortest).filter(F.col("n") >= seen), "variant-words"
    )
    pairs = stored(links(words, shortest), "variant-links")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n"))
    both = both.unionByName(pairs.select(
        F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")
    ))
    # the least of (-n, word) is the best near word
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct(-F.col("near_n"), "near")).alias("_best")
    )
    near = words.join(best, "word", "left").withColumn("_best_n", -F.col("_best.col1"))
    is_form = F.col("_best_n") >= F.col("n") * times
    placed = stored(
        near.select(
            "word", F.when(is_form, F.col("_best.near")).alias("form"), "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("_best_n")).alias("form_n"),
        ),
        "variant-forms",
    )
    roots = followed(placed.filter("form IS NOT NULL"))
    return placed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
