"""The language of a text told from the text: rank profiles of character trigrams.

A language's profile is the list of its most frequent trigrams. A text has a
list of its own, and the language whose list puts its trigrams at the nearest
places is told. Words are cut by DataFrame expressions; trigrams are counted in
tasks, over many texts at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import stored
from . import trigrams as tg
from .numbering import first_rows

SIZE = 3  # letters of a gram
LONGEST = 64  # letters of a word, so that its grams are cut out of a short text
PLACES = 300  # grams of a list; one that is not in it counts as that far off


def words_of(text: Column | str) -> Column:
    """Runs of letters in lower case; one of more than LONGEST letters counts as several."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(
        F.lower(F.coalesce(text, F.lit(""))), F.lit(rf"\p{{L}}{{1,{LONGEST}}}"), F.lit(0))


def grams_of(word: Column) -> Column:
    """The trigrams of a word with a mark before and behind it."""
    return F.transform(
        F.sequence(F.lit(1), F.length(word)),
        lambda at: F.concat(F.lit("_"), word, F.lit("_")).substr(at, F.lit(SIZE)),
    )


def _ranked(counts: DataFrame, by: str) -> DataFrame:
    order = [F.col("n").desc(), F.col("gram")]
    return first_rows(counts, [by], order, PLACES, "place").select(by, "gram", "place")


def gram_places(docs: DataFrame, key: str, text: str) -> DataFrame:
    """The list of every text: key, gram, place from 1; keys are unique.

    Equal counts are placed by gram. A text without a letter has no list.
    """
    grams = docs.select(key, F.explode(F.flatten(F.transform(words_of(text), grams_of))).alias("gram"))
    return _ranked(grams.groupBy(key, "gram").agg(F.count("*").alias("n")), key)


def _marked(text: Column | str) -> Column:
    """The words of a text with one mark between them, before the first and behind the last."""
    return F.concat(F.lit("_"), F.array_join(words_of(text), "_"), F.lit("_"))


def profiles(docs: DataFrame, text: str, lang: str = "lang") -> DataFrame:
    """The list of every language: lang, gram, place; rows without a language are left out.

    Trigrams are counted in slices of the texts, so only their counts move, and a
    language that most rows have is spread over its texts. There are PLACES rows a
    language.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, some in tg.slices(batch["words"]):
                langs = batch["lang"].slice(first, some).dictionary_encode()
                owner, gram, n = tg.counted(
                    batch["words"].slice(first, some), langs.indices.to_numpy().astype("int64"))
                yield pa.RecordBatch.from_pydict({
                    "lang": langs.dictionary.take(pa.array(owner)).cast(pa.string()),
                    "gram": pa.array(map(tg.text, gram.tolist()), pa.string()), "n": pa.array(n, pa.int64()),
                })

    words = docs.filter(F.col(lang).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), _marked(text).alias("words"))
    grams = words.mapInArrow(count, "lang string, gram string, n long")
    return _ranked(grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "lang")


def told_languages(docs: DataFrame, key: str, text: str, known: DataFrame) -> DataFrame:
    """key, told and distance for every text of `docs` that has a letter.

    `known` are `profiles`, PLACES rows a language, which every task gets. The
    distance is how far the text's trigrams are from their places in the told
    language's list, summed; equal distances are settled by the language's name.

    A text is told inside its row, so texts do not move. Only those of rows that
    share their key do: they are counted as one text.
    """
    lists = [(row.lang, row.gram, row.place) for row in known.select("lang", "gram", "place").collect()]
    of = tg.Profiles(lists, PLACES)

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, some in tg.slices(batch["words"]):
                rows, best, distance = of.told(batch["words"].slice(first, some))
                told = pa.array(of.langs or [None], pa.string()).take(pa.array(best))
                keys = batch.column(0).slice(first, some).take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [keys, told, pa.array(distance, pa.int64())], names=[key, "told", "distance"])

    shared = stored(
        docs.groupBy(F.col(key).alias("_shared")).count().filter("count > 1 or _shared is null").select("_shared"),
        "shared-keys",
    )
    alike = F.col(key).eqNullSafe(F.col("_shared"))
    result = StructType([docs.schema[key], *StructType.fromDDL("told string, distance long")])
    alone = docs.select(key, _marked(text).alias("words")).mapInArrow(tell, result).join(
        shared, alike, "left_anti")
    together = _told_together(docs.join(shared, alike, "left_semi"), key, text, lists, min(of.langs, default=None))
    return alone.unionByName(together)


def _told_together(
    docs: DataFrame, key: str, text: str, known: list[tuple[str, str, int]], first: str | None
) -> DataFrame:
    """`told_languages` of the rows of a key as one text; a NULL key is told the `first` language."""
    lists = gram_places(docs, key, text)
    sizes = lists.groupBy(key).agg(F.count("*").alias("_size"))
    places = F.broadcast(docs.sparkSession.createDataFrame(known, "lang string, gram string, _known int"))
    nearer = F.sum(F.abs(F.col("place") - F.col("_known")) - PLACES)
    shared = lists.join(places, "gram").groupBy(key, "lang").agg(nearer.alias("_nearer"))
    best = shared.groupBy(key).agg(F.min(F.struct("_nearer", "lang")).alias("_best"))
    # a language that shares no trigram is PLACES off with each, so only a text that
    # shares none with any language lacks a best one: all are as far then
    return sizes.join(best, key, "left").select(
        key, F.coalesce("_best.lang", F.lit(first).cast("string")).alias("told"),
        (F.col("_size") * PLACES + F.coalesce("_best._nearer", F.lit(0))).cast("long").alias("distance"),
    )
