"""Exact duplicates against a dictionary of texts."""

import hashlib
import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from conftest import rows
from tallyweave.llm.exact import exact_dedup, exact_groups

SCHEMA = "doc_id long, text string, kept string, content long"
COLUMNS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def plain(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def brute(data):
    groups = defaultdict(list)
    for at, row in enumerate(data):
        groups[plain(row[1])].append((row[0] is None, row[0] or 0, at, row[0]))
    out = []
    for text, members in groups.items():
        keep = min(members)
        out += [(m[3], keep[3], len(members), m == keep, hashlib.sha256(text.encode()).hexdigest())
                for m in members]
    return sorted(out, key=lambda r: tuple(map(str, r)))


def sample():
    words = ["a", "b", "ü", " ", "\t", "\n", "  ", "\x0b", " "]
    pick = random.Random(1)
    data = [(i, "".join(pick.choices(words, k=pick.randint(0, 4))), "x", i) for i in range(300)]
    data += [(None, None, None, None), (7, "a", "y", 0), (7, "a", "y", 0), (900, None, "z", 1),
             (901, "long " * 100_000, None, None), (902, "long  " * 100_000, None, None)]
    return data


def test_groups(spark):
    data = sample()
    df = spark.createDataFrame(data, SCHEMA).coalesce(1)
    assert rows(exact_groups(df).select(*COLUMNS)) == brute(data)


def test_collisions_are_told_apart(spark):
    data = sample()
    df = spark.createDataFrame(data, SCHEMA).coalesce(1)
    weak = exact_groups(df, lambda text: F.unhex(F.md5(F.substring(text, 1, 1))))
    assert rows(weak.select(*COLUMNS)) == brute(data)


def test_dedup_keeps_every_column(spark):
    data = sample()
    df = spark.createDataFrame(data, SCHEMA)
    out = exact_dedup(df)
    assert out.columns == df.columns
    staying = [row for row in brute(data) if row[3]]
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(str(r[0]) for r in staying)


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert exact_groups(df).count() == 0
    assert exact_dedup(df).count() == 0
