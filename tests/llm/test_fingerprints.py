"""Fingerprints against plain sketches."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tallyweave.llm.fingerprints import (
    FRACTION, LEAST, containment, edited_fingerprints, followers, merged, sketch, written,
)

SCHEMA = "doc_id long, text string, tie string, n_chars long"


def signed(value):
    return value - 2**64 if value >= 2**63 else value


def plain_sketch(text, words=5):
    own = re.findall("[^\x20\x09-\x0d]+", text or "")
    hashes = set()
    for i in range(max(len(own) - words + 1, 1) if own else 0):
        value = 42
        for word in own[i:i + words]:
            value = xxhash.xxh64_intdigest(word.encode(), value)
        hashes.add(signed(value))
    own = sorted(hashes)
    limit = -2**63 + 2**64 // FRACTION - 1
    limit = max(limit, own[LEAST - 1] if len(own) >= LEAST else 2**63 - 1)
    return limit, [h for h in own if h <= limit]


def alike(a, b):
    limit = min(a[0], b[0])
    left, right = ({h for h in own[1] if h <= limit} for own in (a, b))
    least = min(len(left), len(right))
    return len(left & right) / least if least else float(not a[1] and not b[1])


def sample():
    pick = random.Random(13)
    words = ["über", "a", "b", "日本", "𝔘", "\x0b", "c\n", "  ", "d\te"]
    data = [(i, " ".join(pick.choices(words, k=pick.choice([5, 60, 900]))), "x", 1) for i in range(0, 120, 2)]
    return [*data, (301, "", "x", 1), (302, None, "x", 1), (303, " \n ", None, None), (304, "one two", "x", 1),
            (305, "word " * 50_000, "x", 1)]


def plain(data):
    order = sorted(data, key=lambda r: -r[0])
    out = []
    for row, other in zip(order, [*order[1:], order[0]]):
        text, following = row[1] or "", other[1] or ""
        n = len(text)
        edited = text[:n - n // 3] + following[:n // 3]
        own, changed = plain_sketch(text), plain_sketch(edited)
        out.append((row[0], n, edited, own, changed, alike(own, changed), alike(own, plain_sketch(following))))
    return sorted(out)


def test_against_plain(spark):
    got = edited_fingerprints(spark.createDataFrame(sample(), SCHEMA))
    assert sorted(map(tuple, got.collect())) == plain(sample())


def test_odd_rows(spark):
    data = [(1, "a b c d e f", "x", 1)] * 3 + [(1, "other", "x", 1), (None, "g h", None, None), (None, None, None, None)]
    got = edited_fingerprints(spark.createDataFrame(data, SCHEMA)).collect()
    assert len(got) == len(data)
    assert len({tuple(map(str, r)) for r in got if r.n_chars == 11}) == 1
    assert edited_fingerprints(spark.createDataFrame([], SCHEMA)).count() == 0
    alone = edited_fingerprints(spark.createDataFrame([(4, "abcdef", None, None)], SCHEMA)).first()
    assert (alone.edited, alone.near_next) == ("abcdab", 1.0)


@pytest.mark.parametrize("n", [1, 2, 1000])
def test_followers(spark, n):
    keys = spark.range(n).select((F.col("id") * 3).alias("key"), F.lit(0).alias("tie"))
    got = {r.key: r.next_key for r in followers(keys).collect()}
    assert got == {3 * i: 3 * ((i - 1) % n) for i in range(n)}


def test_merging(spark):
    pick = random.Random(16)
    a, b = (" ".join(str(pick.random()) for _ in range(n)) for n in (40, 2_000))
    df = spark.createDataFrame([(a, b)], "a string, b string").select(
        sketch(F.col("a")).alias("a"), sketch(F.col("b")).alias("b"))
    row = df.select(merged(F.col("a"), F.col("b")).alias("both"), containment(F.col("a"), F.col("b")).alias("near"),
                    written(F.col("a")).alias("text")).first()
    own, other = plain_sketch(a), plain_sketch(b)
    limit = min(own[0], other[0])
    assert tuple(row.both) == (limit, sorted(h for h in {*own[1], *other[1]} if h <= limit))
    assert row.near == 0.0
    assert row.text == "".join(f"{h % 2**64:016x}" for h in [own[0], *own[1]])


def test_likeness_estimates(spark):
    pick = random.Random(14)
    data = [(i, " ".join(str(pick.random()) for _ in range(600)), "x", 1) for i in range(60)]
    got = edited_fingerprints(spark.createDataFrame(data, SCHEMA)).collect()
    assert all(0.4 < row.near_edited < 0.9 and row.near_next < 0.05 for row in got)


def shingles(text, words=5):
    own = re.findall("[^\x20\x09-\x0d]+", text)
    return {tuple(own[i:i + words]) for i in range(max(len(own) - words + 1, 1) if own else 0)}


def test_error_of_estimates(spark):
    """Exact up to LEAST shingles on both sides; above, the mean error falls with the shorter text."""
    pick = random.Random(15)
    words = ["".join(pick.choices("abcdehilmnoprstu", k=4)) for _ in range(3000)]
    data = []
    for long in (60, 400, 4_000):
        for n in [8, 20, 60, 200, 400] * 12:
            text = pick.choices(words, k=long)
            at = pick.randrange(max(1, len(text) - n + 1))
            own = text[at:at + n]
            data.append((" ".join(text), " ".join(pick.choices(words, k=n // 2) + own), long, n))
    near = containment(sketch(F.col("a")), sketch(F.col("b")))
    got = spark.createDataFrame(data, "a string, b string, long int, n int").withColumn("near", near).collect()
    errors = {}
    for row in got:
        own, other = shingles(row.a), shingles(row.b)
        error = abs(row.near - len(own & other) / min(len(own), len(other)))
        errors.setdefault((row.long, row.n), []).append(error)
        if max(len(own), len(other)) < LEAST:
            assert error == 0
    mean = {key: sum(some) / len(some) for key, some in errors.items()}
    print({key: round(value, 3) for key, value in sorted(mean.items())})
    assert mean[400, 200] < 0.12 and mean[4_000, 400] < 0.12 and mean[400, 400] < 0.1
