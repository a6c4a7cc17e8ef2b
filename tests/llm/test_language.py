"""Language of texts: the model and its answers against plain counts, and held-out accuracy."""

import math
import random
import zlib
from collections import Counter, defaultdict

import pytest

from tallyweave.llm import language as lg

SCHEMA = "doc_id long, text string, lang string, _told string, word int"
SPEECH = {
    "en": "the of and house thing which water with there other walking".split(),
    "de": "der und das haus schön über wasser nicht gehen größer".split(),
    "fr": "le la et maison été cœur rivière avec aller où".split(),
}


def text_in(lang, pick, words):
    return " ".join(pick.choice(SPEECH[lang]) + pick.choice(["", "", "s", "e"]) for _ in range(words))


def sample():
    pick = random.Random(3)
    rows = []
    for at in range(240):
        lang = pick.choice(["en"] * 4 + ["de", "fr"])
        rows.append((at, text_in(lang, pick, pick.randint(3, 40)), lang, "x", at))
    rows += [
        (1000, None, "en", None, None), (1001, "", "de", None, None), (1002, "12 !! ² ½", "fr", None, None),
        (1003, "the house", None, None, None), (None, "der und das", "de", None, None),
        (1004, "the " * 150_000, "en", None, None), (1005, "q" * 200_000, "en", None, None),
        (1005, "q" * 200_000, "en", None, None), (1006, "Ω漢字", "en", None, None),
    ]
    return rows


def held(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 == 0


def letters(text):
    return "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()


def grams(word, size):
    marked = word if size == 1 else f"<{word}>"
    return [marked[at:at + size] for at in range(len(marked) - size + 1)]


def plain_answers(rows):
    """Every text by the same rules, word by word, from dictionaries."""
    langs = sorted({row[2] for row in rows if row[2] is not None and not held(row[0])})
    share, words, by_size = Counter(), defaultdict(Counter), defaultdict(lambda: defaultdict(Counter))
    for doc_id, text, lang, *_ in rows:
        if lang is None or held(doc_id):
            continue
        share[lang] += 1
        for word in letters(text):
            words[lang][word] += 1
    for lang, counter in words.items():
        for word, n in counter.items():
            for size in range(1, 6):
                for gram in grams(word, size):
                    by_size[size][lang][gram] += n

    def scores(counts, key):
        keys = {k for counter in counts.values() for k in counter}
        if key not in keys:
            return None
        logs = [math.log((counts[la][key] + 0.5) / (sum(counts[la].values()) + 0.5 * len(keys)))
                for la in langs]
        return [value - sum(logs) / len(logs) for value in logs]

    known = {}

    def word_scores(word):
        if word not in known:
            found = scores(words, word)
            for size in range(5, 0, -1):
                if found is None:
                    some = [s for gram in grams(word, size) if (s := scores(by_size[size], gram))]
                    found = [sum(col) / len(some) for col in zip(*some)] if some else None
            known[word] = found or [0.0] * len(langs)
        return known[word]

    out = []
    for doc_id, text, *_ in rows:
        own = Counter(letters(text))
        if not own:
            out.append((doc_id, "und", 0.0))
            continue
        total = [math.log(share[la] / sum(share.values())) for la in langs]
        for word, n in own.items():
            total = [a + n * b for a, b in zip(total, word_scores(word))]
        best = max(total)
        score = 1 / sum(math.exp(max(value - best, -700)) for value in total)
        out.append((doc_id, langs[total.index(best)], score))
    return out


def test_answers_are_those_of_plain_counts(spark):
    rows = [row for row in sample() if row[0] != 1005]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    model = lg.fit(docs)
    got = lg.languages(docs, model).collect()
    want = plain_answers(rows)
    key = lambda row: (row[0] is None, row[0] or 0)
    assert len(got) == len(want)
    for mine, other in zip(sorted(got, key=key), sorted(want, key=key)):
        assert mine[:2] == other[:2]
        assert mine[2] == pytest.approx(other[2], abs=1e-4)


def test_held_out_texts_and_odd_ones(spark):
    rows = sample()
    docs = spark.createDataFrame(rows, SCHEMA)
    told = lg.languages(docs, lg.fit(docs)).select("doc_id", "lang_pred").collect()
    by_id = {row[0]: row[1] for row in told}
    assert [by_id[at] for at in (1000, 1001, 1002)] == ["und"] * 3
    assert by_id[None] == "de" and by_id[1003] == "en"
    assert sum(row[0] == 1005 for row in told) == 2  # repeated rows stay
    unseen = [row for row in rows[:240] if held(row[0])]
    assert sum(by_id[row[0]] == row[2] for row in unseen) / len(unseen) > 0.95


def test_word_in_two_languages_falls_to_the_one_that_says_it_more(spark):
    rows = [(1, "on on on on", "en"), (3, "on est", "fr"), (6, "est est est", "fr")]
    rows = [row for row in rows if not held(row[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    asked = spark.createDataFrame([(0, "on"), (1, "est"), (2, "esta")], "doc_id long, text string")
    told = dict(lg.languages(asked, lg.fit(docs)).select("doc_id", "lang_pred").collect())
    assert told == {0: "en", 1: "fr", 2: "fr"}


def test_nothing_learnt(spark):
    docs = spark.createDataFrame([(1, "words here", None)], "doc_id long, text string, lang string")
    assert [tuple(r) for r in lg.languages(docs, lg.fit(docs)).collect()] == [(1, "und", 0.0)]
    assert lg.languages(docs.limit(0), lg.fit(docs.limit(0))).collect() == []


def test_most_frequent_takes_whole_steps(spark):
    rows = [("a", f"w{at}", n) for at, n in enumerate([100, 90, 50, 2, 1, 1, 1])] + [("b", "z", 1)]
    counts = spark.createDataFrame(rows, "lang string, word string, n long")
    for most, kept in ((7, 7), (6, 4), (3, 3), (1, 1), (0, 0)):
        got = lg.most_frequent(counts, ["lang"], most).filter("lang = 'a'").collect()
        assert len(got) == kept


def test_cache_changes_nothing(spark, monkeypatch):
    docs = spark.createDataFrame(sample()[:60], SCHEMA)
    model = lg.fit(docs)
    texts = [f"{text_in('fr', random.Random(at), 9)} neuword{at}x" for at in range(40)]
    want = lg.Teller(model).tell(texts)
    monkeypatch.setattr(lg, "CACHED_WORDS", 3)
    assert lg.Teller(model).tell(texts) == want
