"""Phrases of two to four words that occur together more often than apart.

Words are counted first; those that are frequent get a number, and the texts are
stored once as the numbers of their words. Phrases are then counted length by
length. Frequent phrases of one length stand in double-array tries that go to
all tasks; there all text positions walk them at once, level by level, and end
in the accepting state of the phrase that begins at them. A longer phrase can
only be frequent if two accepting states follow each other, that of its first
words and that of its last: only such pairs are candidates, and tasks count the
pairs that their text has. The counts of all tasks are summed by pair. So
candidates are those that the text shows, and no list of possible ones is made
or sent.

A trie holds a bounded number of phrases. More phrases make more tries, but a
phrase's first two words tell its trie: a task opens one trie after the other
and looks every position up in one of them. So each length takes one pass over
the texts, however many tries there are.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.numbering import first_rows
from ..session import ship_package
from .common import stored, whole_text
from .tries import Trie

SHORTEST, LONGEST = 2, 4  # words
FREQUENT = 30
TOP = 2_000
SCALE = 2_000_000
INSIDE = (80, 100)  # a phrase goes if a longer one around it has this share of its places
UNKNOWN = "und"
TRIE_PHRASES = 1_000_000  # phrases that one trie holds; a task has one open at a time
POSITIONS = 2_000_000  # text positions that a task looks at together
PAIRS = 4_000_000  # distinct pairs that a task counts before it hands them on
PART_POSITIONS = 1_000_000  # text positions whose pairs are summed by one task
COUNTED = 500_000  # distinct words that a task counts before it hands them on
TEXT_BYTES = 8 << 20  # bytes of text that are split together
ROW_POSITIONS = 1_000  # positions of a stored row; one piece may have more

_BLANKS, _BREAKS = b"\x20\x09", b".,;:!?\x0A\x0B\x0C\x0D"
# What a byte of a text is: 0 for part of a word, 1 for a blank, 2 for the end of a piece.
_KINDS = bytes(1 if byte in _BLANKS else 2 if byte in _BREAKS else 0 for byte in range(256))
_LOWER = bytes(range(256)).lower()


def words_of(texts: pa.StringArray) -> tuple[pa.BinaryArray, np.ndarray]:
    """The words of all texts in order, and which of them begin a piece.

    Only A-Z become lower-case. A text begins a piece, too.
    """
    if not len(texts):
        return pa.array([], pa.binary()), np.zeros(0, bool)
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
    content = texts.buffers()[2] or b""
    data = bytes(memoryview(content)[offsets[0]:offsets[-1]])
    begins = np.unique(offsets[:-1] - offsets[0])
    begins = begins[begins < len(data)]
    kind = np.frombuffer(data.translate(_KINDS), np.uint8)
    inside = kind == 0
    edge = inside.copy()  # a word goes on here
    edge[1:] &= inside[:-1]
    edge[begins] = False
    starts = np.flatnonzero(inside & ~edge)
    ends = np.flatnonzero(inside & ~np.append(edge[1:], False)) + 1
    first = np.zeros(len(starts) + 1, bool)
    first[np.searchsorted(starts, np.flatnonzero(kind == 2))] = True
    first[np.searchsorted(starts, begins)] = True
    places = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=places[1:])
    words = pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(data.translate(_LOWER, _BLANKS + _BREAKS))])
    return words, first[:-1]


def _split(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.DictionaryArray, np.ndarray]]:
    """Of texts (lang, text): a language, some of its words and which of them begin a piece."""
    for lang, (texts,) in _by_language(batch.column(0), batch.column(1)):
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        cuts = np.unique(np.searchsorted(ends, np.arange(TEXT_BYTES, ends[-1], TEXT_BYTES)) + 1)
        for begin, end in zip([0, *cuts], [*cuts, len(texts)]):
            words, first = words_of(texts.slice(begin, end - begin))
            if len(words):
                yield lang, words.dictionary_encode(), first


def _by_language(langs: pa.Array, *columns: pa.Array) -> Iterator[tuple[str, list[pa.Array]]]:
    """Each language with its own part of the columns."""
    langs = langs.dictionary_encode()
    numbers = langs.indices.to_numpy()
    order = np.argsort(numbers, kind="stable")
    columns = [column.take(pa.array(order)) for column in columns]
    ends = np.cumsum(np.bincount(numbers, minlength=len(langs.dictionary)))
    for lang, begin, end in zip(langs.dictionary.to_pylist(), [0, *ends], ends):
        yield lang, [column.slice(begin, end - begin) for column in columns]


def _texts(docs: DataFrame) -> DataFrame:
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN))
    return docs.select(lang.alias("lang"), whole_text("text").alias("text"))


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, word, n for every word of `docs` (lang, text)."""

    def summed(parts: list[pa.Table]) -> pa.Table:
        some = pa.concat_tables(parts).group_by("word").aggregate([("n", "sum")])
        return some.select(["word", "n_sum"]).rename_columns(["word", "n"])

    def out(counts: dict[str, list[pa.Table]]) -> Iterator[pa.RecordBatch]:
        for lang, parts in counts.items():
            for some in summed(parts).to_batches(max_chunksize=50_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(some)), some["word"].cast(pa.string()), some["n"]],
                    ["lang", "word", "n"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list[pa.Table]] = defaultdict(list)
        held = 0
        for batch in batches:
            for lang, words, _ in _split(batch):
                times = np.bincount(words.indices.to_numpy(), minlength=len(words.dictionary))
                counts[lang].append(pa.table({"word": words.dictionary, "n": times}))
                held += len(times)
                if held > COUNTED:
                    counts = defaultdict(list, {own: [summed(parts)] for own, parts in counts.items()})
                    held = sum(len(parts[0]) for parts in counts.values())
                    if held > COUNTED // 2:
                        yield from out(counts)
                        counts.clear()
                        held = 0
        yield from out(counts)

    return _texts(docs).mapInArrow(counted, "lang string, word string, n long").groupBy(
        "lang", "word").agg(F.sum("n").alias("n"))


def _each(shards: list) -> Iterator:
    """What the broadcasts hold, one at a time; of several none stays in memory."""
    for shard in shards:
        yield shard.value
        if len(shards) > 1 and getattr(shard, "_path", None):
            vars(shard).pop("_value", None)


def _numbers(lang: str, words: pa.BinaryArray, shards: list) -> np.ndarray:
    """The numbers of words of a language, -1 for those that have none."""
    out = np.full(len(words), -1, np.int32)
    for known in _each(shards):
        if lang in known:
            own, numbers = known[lang]
            at = pc.index_in(words, value_set=own)
            found = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
            out[found] = numbers[at.drop_null().to_numpy()]
    return out


def _runs(numbers: np.ndarray, first: np.ndarray) -> Iterator[bytes]:
    """Numbers of words as rows of int32, with -1 between words that no phrase goes across.

    Words without a number, and those with none beside them, go. Rows end between pieces.
    """
    ahead = np.empty(len(numbers), bool)  # a phrase may go on from the word before
    ahead[0] = False
    ahead[1:] = (numbers[1:] >= 0) & (numbers[:-1] >= 0) & ~first[1:]
    kept = ahead.copy()
    kept[:-1] |= ahead[1:]
    numbers, ahead = numbers[kept], ahead[kept]
    places = np.arange(len(numbers)) + np.cumsum(~ahead)
    out = np.full(places[-1] + 1 if len(places) else 0, -1, np.int32)
    out[places] = numbers
    breaks = np.flatnonzero(out < 0)
    at = np.unique(np.searchsorted(breaks, np.arange(0, len(out), ROW_POSITIONS)))
    cuts = breaks[at[at < len(breaks)]]
    for begin, end in zip(cuts, [*cuts[1:], len(out)]):
        yield out[begin:end].tobytes()


def encoded(docs: DataFrame, words: DataFrame, shard_words: int = TRIE_PHRASES) -> DataFrame:
    """The texts as numbers of words, stored: rows of int32 in `numbers`, -1 between pieces.

    `words` is (id, lang, words) with one word each; other words count as breaks.
    """
    many = words.count() // shard_words + 1
    context, shards = docs.sparkSession.sparkContext, []
    for at in range(many):
        rows = words.filter(F.pmod("id", F.lit(many)) == at).select(
            "lang", F.element_at("words", 1).alias("word"), "id").toArrow()
        shards.append(context.broadcast({
            lang: (own.cast(pa.binary()), numbers.to_numpy().astype(np.int32))
            for lang, (own, numbers) in _by_language(*(column.combine_chunks() for column in rows.columns))}))

    def function(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, found, first in _split(batch):
                numbers = _numbers(lang, found.dictionary, shards)[found.indices.to_numpy()]
                rows = list(_runs(numbers, first))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["numbers"])

    out = stored(_texts(docs).mapInArrow(function, "numbers binary"), "phrase-texts")
    for shard in shards:
        shard.destroy()
    return out


class Shard:
    """Some phrases of one length, from two words on, as a trie over the numbers of their words."""

    def __init__(self, rows: pa.Table, depth: int):
        self.ids = rows["id"].to_numpy().astype(np.int32)
        self.depth = depth
        numbers = rows["numbers"].combine_chunks().flatten().to_numpy().reshape(-1, depth)
        self.trie = Trie(numbers, int(numbers.max(initial=0)) + 1)

    def found(self, numbers: np.ndarray, own: np.ndarray | bool) -> np.ndarray:
        """The phrase that begins at each position, or -1; only those that are `own` are looked up."""
        numbers = np.where(numbers < self.trie.symbols, numbers, -1)
        at = self.trie.accepted(numbers[1:], self.depth - 1, np.where(own, numbers, -1)[:-1])
        out = np.full(len(numbers), -1, np.int32)
        held = np.flatnonzero(at >= 0)
        out[held] = self.ids[at[held]]
        return out


def _shard_of(first, second, many: int):
    """Which of so many tries a phrase stands in, by the numbers of its first two words."""
    return (first + second) % many


def _counted_pairs(texts: DataFrame, shards: list, count: int, parts: int) -> DataFrame:
    """How often each phrase is followed by which, in parts: part, codes, times.

    A code is the first phrase's number times `count` and the second's; those of
    a row are sorted and stand as differences.
    """
    many = len(shards)

    def codes(pieces: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        numbers = np.concatenate([*pieces, np.full(1, -1, np.int32)])
        found = numbers
        if shards:
            found = np.full(len(numbers), -1, np.int32)
            place = _shard_of(numbers, np.append(numbers[1:], -1), many)
            for at, shard in enumerate(_each(shards)):
                found = np.maximum(found, shard.found(numbers, place == at))
        at = np.flatnonzero((found[:-1] >= 0) & (found[1:] >= 0))
        return np.unique(found[at] * np.int64(count) + found[at + 1], return_counts=True)

    def out(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        codes, times = _summed(held)
        mixed = codes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
        part = (mixed % np.uint64(parts)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        part, codes, times = part[order], codes[order], times[order].astype(np.int32)
        begins = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else []
        for begin, end in zip(begins, [*begins[1:], len(part)]):
            some = codes[begin:end]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part[begin]], pa.int32()), pa.array([np.diff(some, prepend=0).tobytes()], pa.binary()),
                 pa.array([times[begin:end].tobytes()], pa.binary())], ["part", "codes", "times"])

    def function(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, positions, held = [], 0, []
        for batch in batches:
            column = batch.column(0)
            for begin in range(0, len(column), 100):
                some = column.slice(begin, 100).to_pylist()
                pieces.append(np.frombuffer(b"".join(some), np.int32))
                positions += len(pieces[-1])
                if positions > POSITIONS:
                    held.append(codes(pieces))
                    pieces, positions = [], 0
                    if sum(len(own) for own, _ in held) > PAIRS:
                        yield from out(held)
                        held = []
        if pieces:
            held.append(codes(pieces))
        if held:
            yield from out(held)

    return texts.mapInArrow(function, "part int, codes binary, times binary")


def _summed(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Codes, each once and sorted, with the sum of their times."""
    if len(held) == 1:
        return held[0]
    codes, times = (np.concatenate(parts) for parts in zip(*held))
    order = np.argsort(codes)
    codes, times = codes[order], times[order]
    begins = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if len(codes) else np.zeros(0, int)
    return codes[begins], np.add.reduceat(times, begins, dtype=np.int64) if len(begins) else times


def _frequent_pairs(counted: DataFrame, count: int, parts: int, frequent: int) -> DataFrame:
    """before, after, n of the pairs that occur often enough over all tasks."""

    def function(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, many = [], 0
        for batch in batches:
            for codes, times in zip(batch.column(1), batch.column(2)):
                held.append((np.cumsum(np.frombuffer(codes.as_buffer(), np.int64)),
                             np.frombuffer(times.as_buffer(), np.int32).astype(np.int64)))
                many += len(held[-1][0])
                if many > 2 * PAIRS:  # of those seen so far each once
                    held = [_summed(held)]
                    many = len(held[0][0]) if len(held[0][0]) < PAIRS else 0
        if held:
            codes, times = _summed(held)
            often = times >= frequent
            before, after = np.divmod(codes[often], count)
            yield from pa.table({"before": before, "after": after, "n": times[often]}).to_batches(100_000)

    # of a code all counts are in one part, and of a part in one partition
    return counted.repartition(parts, "part").mapInArrow(function, "before long, after long, n long")


def _numbered(phrases: DataFrame, purpose: str) -> DataFrame:
    """Phrases stored with a number each, from 0 on without gaps."""
    place = F.monotonically_increasing_id()
    rows = stored(phrases.withColumn("_place", place), purpose)
    task = F.shiftright("_place", 33).cast("int")
    counts = dict(rows.groupBy(task.alias("task")).count().collect())
    begins = np.cumsum([0, *(counts.get(at, 0) for at in range(max(counts, default=0)))])
    begin = F.element_at(F.lit([int(at) for at in begins]).cast("array<long>"), task + 1)
    number = begin + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.withColumn("id", number).drop("_place")


def one_longer(
    texts: DataFrame, phrases: DataFrame, depth: int, parts: int, frequent: int = FREQUENT,
    trie_phrases: int = TRIE_PHRASES,
) -> DataFrame:
    """Frequent phrases of `depth` + 1 words, from all those of `depth` words.

    `texts` is what `encoded` gives; `phrases` is (id, lang, words, numbers, n),
    as is the result. A shard of about `trie_phrases` phrases comes to the driver
    at a time. Pairs are summed in so many `parts`.
    """
    count = phrases.count()
    if not count:
        return phrases
    context, shards = texts.sparkSession.sparkContext, []
    many = count // trie_phrases + 1
    if depth > 1:  # a word is its number
        numbers = F.col("numbers")
        place = _shard_of(numbers[0].cast("long"), numbers[1], F.lit(many))
        for at in range(many):
            rows = phrases.filter(place == at).select("id", "numbers").toArrow()
            shards.append(context.broadcast(Shard(rows, depth)))
    counted = _counted_pairs(texts, shards, count, parts)
    pairs = stored(_frequent_pairs(counted, count, parts, frequent), "phrase-pairs")
    for shard in shards:
        shard.destroy()
    begun = phrases.select(
        F.col("id").alias("before"), "lang", F.col("words").alias("_begun"), F.col("numbers").alias("_from"))
    last = phrases.select(
        F.col("id").alias("after"), F.element_at("words", -1).alias("_last"),
        F.element_at("numbers", -1).alias("_to"))
    return _numbered(
        pairs.join(begun, "before").join(last, "after").select(
            "lang", F.array_append("_begun", F.col("_last")).alias("words"),
            F.array_append("_from", F.col("_to")).alias("numbers"), "n"),
        "phrases",
    )


def _phrase(words: Column) -> Column:
    return F.array_join(words, " ")


def collocations(
    docs: DataFrame, frequent: int = FREQUENT, top: int = TOP, trie_phrases: int = TRIE_PHRASES
) -> DataFrame:
    """The best phrases of every language: lang, rank, phrase, a, l, r, n, score.

    Texts are split into pieces at sentence marks and line ends, pieces into
    words at spaces and tabs. Phrases have 2 to 4 words and occur `a` >=
    `frequent` times inside pieces. A cut into two parts that occur l and r
    times scores floor(2,000,000 * a / (l + r)); the lowest counts, of equal
    ones that after the fewest words. A phrase inside a longer frequent one
    that has 80 % of its occurrences is dropped. n is the number of words of
    the language; the first `top` come by score, a and phrase.

    Products are decimals of 38 digits. Every row counts, repeated ones too. A
    NULL language is `und`, a NULL text empty; no frequent phrase gives no row;
    columns but `lang` and `text` are not looked at.
    """
    ship_package(docs.sparkSession)
    words = stored(word_counts(docs), "phrase-words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    positions = totals.agg(F.sum("n")).first()[0] or 0
    parts = positions // PART_POSITIONS + 1
    first = _numbered(
        words.filter(F.col("n") >= frequent).select("lang", F.array("word").alias("words"), "n"),
        "phrases",
    ).withColumn("numbers", F.array(F.col("id").cast("int")))
    levels = [first]
    texts = encoded(docs, first, trie_phrases)
    for depth in range(1, LONGEST):
        levels.append(one_longer(texts, levels[-1], depth, parts, frequent, trie_phrases))
    counts = reduce(DataFrame.unionByName, levels).select(
        "lang", "words", _phrase(F.col("words")).alias("phrase"), "n"
    )
    candidates = counts.filter(F.size("words") >= SHORTEST).withColumnRenamed("n", "a")

    size = F.size("words")
    cut = F.explode(F.sequence(F.lit(1), size - 1)).alias("k")
    cuts = candidates.select("lang", "phrase", "words", "a", cut).select(
        "lang", "phrase", "a", "k", _phrase(F.slice("words", F.lit(1), F.col("k"))).alias("first"),
        _phrase(F.slice("words", F.col("k") + 1, size - F.col("k"))).alias("rest"),
    )
    for part, name in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(
            counts.select("lang", F.col("phrase").alias(part), F.col("n").alias(name)), ["lang", part]
        )
    score = F.expr(f"cast({SCALE} AS decimal(18,0)) * a div (cast(l AS decimal(19,0)) + r)")
    best = cuts.groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    )

    def inner(length: int) -> Column:
        """The parts of so many words; of phrases that are no longer there are none."""
        places = F.when(size > length, F.sequence(F.lit(1), F.greatest(size - length + 1, F.lit(1))))
        return F.coalesce(
            F.transform(places, lambda at: _phrase(F.slice("words", at, length))),
            F.array().cast("array<string>"),
        )

    inside = candidates.select(
        "lang", "a", F.explode(F.concat(*[inner(length) for length in range(SHORTEST, LONGEST)])).alias("phrase")
    ).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    share, whole = INSIDE
    swallowed = F.expr(f"longer * cast({whole} AS decimal(18,0)) >= a * cast({share} AS decimal(18,0))")
    kept = best.join(inside, ["lang", "phrase"], "left").filter(~F.coalesce(swallowed, F.lit(False)))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    ranked = first_rows(
        kept.select("lang", "phrase", "a", "cut.l", "cut.r", F.col("cut.score").alias("score")),
        ["lang"], order, top, "rank",
    )
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
