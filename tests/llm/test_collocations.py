"""Phrases against plain counts, and tries against dictionaries."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from conftest import rows
from tallyweave.llm import collocations as co
from tallyweave.llm.common import stored
from tallyweave.llm.tries import Trie

SCHEMA = "text string, lang string, phrase string, words string, n int"
COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def brute(data, frequent=30, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang, *_ in data:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for size in range(1, 5):
                for at in range(len(words) - size + 1):
                    counts[lang][tuple(words[at:at + size])] += 1
    out = []
    for lang, own in counts.items():
        kept = {p: a for p, a in own.items() if len(p) > 1 and a >= frequent}
        longer = Counter()
        for p, a in kept.items():
            for size in range(2, len(p)):
                for at in range(len(p) - size + 1):
                    longer[p[at:at + size]] = max(longer[p[at:at + size]], a)
        found = []
        for p, a in kept.items():
            if 100 * longer[p] >= 80 * a:
                continue
            score, k = min((2_000_000 * a // (own[p[:k]] + own[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out, key=lambda r: tuple(map(str, r)))


def sample(seed=1):
    pick = random.Random(seed)
    words = [f"w{at}" for at in range(30)] + ["New", "york", "city", "été", " ", "\x85x", "-"]
    common = [1 / (at + 1) for at in range(len(words))]
    data = []
    for _ in range(120):
        some = []
        for _ in range(pick.randint(0, 80)):
            some += pick.choice([["new", "York", "city", "hall"], ["over", "the", "moon"]]) if (
                pick.random() < 0.08) else pick.choices(words, common)
        seps = [" "] * 12 + ["\t", "  ", ". ", ",", "\n", "\r\n", "!"]
        data.append(("".join(w + pick.choice(seps) for w in some), pick.choice(["en"] * 3 + ["de", None, ""]),
                     "p", "w", 1))
    return data + [(None, "en", None, None, None), ("", "de", None, None, None), (".,;", None, None, None, None),
                   ("na " * 50_000, "long", "p", "w", 1), ("New York" * 1, "en", "p", "w", 1)] + [data[0]] * 3


def test_plain_counts(spark):
    data = sample()
    docs = spark.createDataFrame(data, SCHEMA).repartition(3)
    for how in ({}, {"frequent": 12, "top": 5}):
        assert rows(co.collocations(docs, **how).select(*COLUMNS)) == brute(data, **how)


def test_several_tries_give_the_same(spark, monkeypatch):
    data = sample(2)
    docs = spark.createDataFrame(data, SCHEMA)
    monkeypatch.setattr(co, "POSITIONS", 100)
    assert rows(co.collocations(docs, trie_phrases=100).select(*COLUMNS)) == brute(data)


def test_a_pass_for_each_length_however_many_tries(spark, monkeypatch):
    """Before, each two tries took a pass over the texts."""
    data, purposes = sample(3), []

    def noted(rows, purpose):
        purposes.append(purpose)
        return stored(rows, purpose)

    monkeypatch.setattr(co, "stored", noted)
    docs = spark.createDataFrame(data, SCHEMA)
    assert rows(co.collocations(docs, trie_phrases=20).select(*COLUMNS)) == brute(data)
    assert purposes.count("phrase-texts") == 1 and purposes.count("phrase-pairs") == 3


def test_words_and_pieces_like_a_regex(monkeypatch):
    monkeypatch.setattr(co, "TEXT_BYTES", 40)
    texts = ["One two. THREE\tfour", "", "Été  no-break\x85x", ".,;", " lone ", "a\nb\x0bc", "x" * 100, "End", "on"]
    batch = pa.record_batch([pa.array(["en"] * 8 + ["de"]), pa.array(texts)], ["lang", "text"])
    got = []
    for part in (batch, batch.slice(2), batch.slice(3, 1), batch.slice(0, 0)):
        some = list(co._split(part))
        words = [(lang, word.decode(), bool(at)) for lang, found, first in some
                 for word, at in zip(found.to_pylist(), first)]
        want = [(lang, "".join(c.lower() if "A" <= c <= "Z" else c for c in word), at == 0)
                for lang, text in zip(*part.to_pydict().values())
                for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text)
                for at, word in enumerate(re.findall("[^ \t]+", piece))]
        assert words == want
        got += words
    assert len(got) > 20


def test_nothing_frequent(spark):
    docs = spark.createDataFrame([("one two", "en"), (None, None)], "text string, lang string")
    for some in (docs, docs.limit(0)):
        assert co.collocations(some).collect() == []


def test_score_beyond_64_bits(spark):
    docs = spark.createDataFrame([("a b", "en")], "text string, lang string")
    phrases = spark.createDataFrame([(9 * 10**18, 9 * 10**18, 9 * 10**18)], "a long, l long, r long")
    score = phrases.selectExpr("cast(2000000 AS decimal(18,0)) * a div (cast(l AS decimal(19,0)) + r)")
    assert score.first()[0] == 1_000_000
    assert co.collocations(docs, frequent=1).first()["score"] == 1_000_000


def test_tries_walk_like_dictionaries():
    pick = np.random.default_rng(1)
    for symbols, depth, count in ((3, 1, 2), (300, 2, 900), (70_000, 3, 3_000), (50, 4, 2_000)):
        paths = np.unique(pick.integers(0, symbols, (count, depth + 1)) ** 2 // symbols, axis=0)
        trie = Trie(paths, symbols)
        text = pick.integers(-1, symbols, 5_000) ** 2 // symbols
        text[pick.random(5_000) < 0.1] = -1
        for row in paths[:200]:
            at = pick.integers(0, 4_990)
            text[at:at + depth] = row[1:]
        heads = np.full(5_000, paths[0, 0])
        index = {tuple(map(int, row)): at for at, row in enumerate(paths)}
        want = [index.get((int(heads[at]), *map(int, text[at:at + depth])), -1)
                if at + depth <= 5_000 and (text[at:at + depth] >= 0).all() else -1 for at in range(5_000)]
        assert trie.accepted(text, depth, heads).tolist() == want
        assert max(want) >= 0
