"""SimHash components against all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyweave.llm import simhash
from tallyweave.llm.simhash import connected, fingerprint, linked_prints, simhash_dedup, simhash_groups

SCHEMA = "doc_id long, text string, root string, fp long"


def plain_print(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_roots(prints):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    prints = sorted(prints)
    for i, a in enumerate(prints):
        for b in prints[:i]:
            if ((a ^ b) % 2**64).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {p: find(p) for p in prints}


def signed(value):
    return value - 2**64 if value >= 2**63 else value


def flipped(pick, value, most):
    for bit in pick.sample(range(64), pick.randint(0, most)):
        value ^= 1 << bit
    return value


@pytest.mark.parametrize("text", [
    None, "", "  ", "a", "A b", "One two THREE four", "Ä Ö Ü ß\x0bx\x1cy", "x " * 1000, "a b c " * 30_000,
])
def test_fingerprint(text):
    assert fingerprint(text) % 2**64 == plain_print(text)


def test_blocks_make_no_difference(monkeypatch):
    text = " ".join(str(random.Random(2).random()) for _ in range(50)) + " end \n x"
    whole = fingerprint(text)
    monkeypatch.setattr(simhash, "BLOCK_WORDS", 7)
    assert fingerprint(text) == whole


def test_codewords_meet():
    pick = np.random.default_rng(3)
    vectors = pick.integers(0, 1 << 23, 4000)
    own = simhash.golay_indices(vectors)
    for bit in range(23):
        other = simhash.golay_indices(vectors ^ (1 << bit))
        meet = (own[:, :, None] == other[:, None, :]) & (own[:, :, None] >= 0)
        assert meet.any(axis=(1, 2)).all()


def test_every_link_shares_a_key():
    pick = random.Random(4)
    one = [signed(pick.getrandbits(64)) for _ in range(3000)]
    two = [signed(flipped(pick, value % 2**64, 3)) for value in one]
    for a, b in zip(simhash.link_keys(np.array(one)), simhash.link_keys(np.array(two))):
        assert set(a[a >= 0]) & set(b[b >= 0])


@pytest.mark.parametrize("chunk", [16, simhash.CHUNK])
def test_components(spark, chunk):
    pick = random.Random(5)
    prints = {pick.getrandbits(64) for _ in range(200)}
    centre = pick.getrandbits(64)
    prints |= {flipped(pick, centre, 7) for _ in range(500)}  # one dense group
    for value in list(prints)[:150]:
        for _ in range(pick.randint(1, 4)):
            value = flipped(pick, value, 4)
            prints.add(value)
    prints |= {0, 2**64 - 1, 7, 2**63}
    prints = [signed(value) for value in prints]
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    found = dict(map(tuple, connected(linked_prints(df, chunk)).collect()))
    assert {p: found.get(p, p) for p in prints} == plain_roots(prints)


def texts():
    pick = random.Random(6)
    words = [str(n) for n in range(400)]
    data = []
    for _ in range(60):
        text = pick.choices(words, k=pick.randint(0, 300))
        for _ in range(pick.randint(1, 5)):
            data.append(" ".join(text))
            if text:
                text = [*text]
                text[pick.randrange(len(text))] = "changed"
    data += ["", " \t", None, "one two", "One  TWO"]
    pick.shuffle(data)
    out = [(i, text, "r", i) for i, text in enumerate(data)]
    return [*out, (None, "one two", None, None), (3, data[3], "r", 3), (None, "no id " * 9, None, 1)]


def test_groups_and_dedup(spark):
    data = texts()
    df = spark.createDataFrame(data, SCHEMA)
    roots = plain_roots({signed(plain_print(row[1])) for row in data})
    least = {}
    for row in data:
        root = roots[signed(plain_print(row[1]))]
        if row[0] is not None:
            least[root] = min(least.get(root, row[0]), row[0])
    expected = [(row[0], signed(plain_print(row[1])), least.get(roots[signed(plain_print(row[1]))]))
                for row in data]
    got = simhash_groups(df).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
    staying = simhash_dedup(df)
    assert staying.columns == df.columns
    assert sorted(str(row.doc_id) for row in staying.collect()) == sorted(
        str(least.get(root)) for root in set(roots.values()))


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert simhash_groups(df).count() == 0
    assert simhash_dedup(df).count() == 0


def test_connected_path(spark):
    edges = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {row.root for row in connected(edges).collect()} == {0}
