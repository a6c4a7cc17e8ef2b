"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

from conftest import rows
from tallyweave.llm import variants as vr

SCHEMA = "doc_id long, text string, word string, key int, n long"
COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def near(a, b):
    """Exactly one edit apart, by the definition."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(a) + 1 == len(b) and any(b[:at] + b[at + 1:] == a for at in range(len(b)))


def brute(data, every=None, shortest=7, seen=2, times=10):
    counts = Counter()
    for doc_id, text, *_ in data:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[a-zÀ-ÿ]+", text):
            if every:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                if h % every == 0:
                    run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= shortest and n >= seen}
    form, count = {}, {}
    for word, n in words.items():
        close = [other for other in words if near(word, other)]
        count[word] = len(close)
        best = min(close, key=lambda w: (-words[w], w), default=None)
        if best and words[best] >= times * n:
            form[word] = best
    out = []
    for word, n in words.items():
        root = word
        while root in form:
            root = form[root]
        out.append((word, form.get(word), root, n, count[word], words.get(form.get(word))))
    return sorted(out, key=lambda r: tuple(map(str, r)))


def sample(seed=1, texts=60):
    pick = random.Random(seed)
    base = ["ability", "abbility", "éléphant", "aaaaaaa", "aaaaaaaa", "aaaaaab", "station", "nations",
            "xylophone", "xylophones", "Überlegt", "Ñandúes", "short", "a×b÷cdefg"]
    spread = [400, 30, 9, 60, 3, 5]
    data = []
    for at in range(texts):
        words = []
        for _ in range(pick.randint(0, 60)):
            word = pick.choices(base[:6], spread)[0] if pick.random() < 0.5 else pick.choice(base)
            if pick.random() < 0.2:
                place = pick.randrange(len(word))
                word = word[:place] + pick.choice(["", "a", "xa", "é"]) + word[place + pick.randint(0, 1):]
            words.append(word.upper() if pick.random() < 0.1 else word)
        data.append((at, pick.choice([" ", "_", "1", "\n"]).join(words), "w", at, 1))
    return data + [
        (None, "ability ability", None, None, None), (5, None, None, None, None), (6, "", None, None, None),
        (70, "ability " * 70_000, "x", 1, 1), (71, "z" * 100_000 + " " + "z" * 100_000, "x", 1, 1),
        (70, "station", "x", 1, 1), (70, "station", "x", 1, 1), (None, "İstanbul İstanbul ﬁnality", "x", 1, 1),
    ]


def test_all_pairs(spark):
    for every in (None, 3):
        data = sample()
        docs = spark.createDataFrame(data, SCHEMA).repartition(4)
        got = vr.variants(docs, every and vr.misspelt(every)).select(*COLUMNS)
        assert rows(got) == brute(data, every)


def test_forms_of_forms(spark):
    text = " ".join(["cabbage"] * 2000 + ["cabbaga"] * 200 + ["cabbaxa"] * 20 + ["cubbaxa"] * 2)
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = {row["word"]: row["root"] for row in vr.variants(docs).collect()}
    assert set(got.values()) == {"cabbage"} and len(got) == 4
    assert rows(vr.variants(docs).select(*COLUMNS)) == brute([(1, text)])


def test_links_of_many_words_with_one_ending(spark):
    """A half that all words have brings no pair that is not near."""
    pick = random.Random(2)
    words = sorted({"".join(pick.choices("abc", k=pick.randint(3, 5))) + "ation" for _ in range(400)})
    table = spark.createDataFrame([(word, 2) for word in words], "word string, n long")
    got = {(row["a"], row["b"]) for row in vr.links(table).collect()}
    assert len(got) == vr.links(table).count()
    want = {frozenset((a, b)) for a in words for b in words if near(a, b)}
    assert {frozenset(pair) for pair in got} == want


def test_no_words(spark):
    docs = spark.createDataFrame([(1, None), (2, "short words")], "doc_id long, text string")
    for some in (docs, docs.limit(0)):
        assert vr.variants(some).collect() == []
