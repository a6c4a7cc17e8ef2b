"""Mixtures against a plain tree in Python."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tallyweave.llm.mixing import leaf_budgets, mix, mixed

SCHEMA = "doc_id long, text string, lang string, source string, tokens string, epoch long"
WEIGHTS = {"domain": {"x": 3}, "lang": {"en": 5, "de": 2}, "source": {"s1": 4}}


def water(above, rooms, weights):
    """Budgets of siblings, by raising one level until the budget is used."""
    order = sorted(rooms, key=lambda k: (rooms[k] / weights[k], str(k)))
    out, rest, total = {}, above, sum(weights.values())
    rate = None
    for key in order:
        if rate is None and rest * weights[key] // total < rooms[key]:
            rate = (rest, total)
        out[key] = rooms[key] if rate is None else min(rooms[key], rate[0] * weights[key] // rate[1])
        rest, total = rest - rooms[key], total - weights[key]
    return out


def plain_budgets(tokens, budget, epochs, weights):
    rooms = {leaf: n * epochs for leaf, n in tokens.items()}
    out = {(): budget}
    for depth in (1, 2, 3):
        level = defaultdict(int)
        for leaf, room in rooms.items():
            level[leaf[:depth]] += room
        named = weights.get(("domain", "lang", "source")[depth - 1], {})
        new = {}
        for parent, above in out.items():
            own = {k: r for k, r in level.items() if k[:depth - 1] == parent}
            new |= water(above, own, {k: named.get(k[-1], 1) for k in own})
        out = new
    return out


def plain_mix(data, share, epochs, seed, weights, domain=lambda source: "x" if source == "s1" else "y"):
    units = defaultdict(int)
    for doc_id, text, lang, source, *_ in data:
        n = len(re.findall("[^\x20\x09-\x0d]+", text or ""))
        units[(domain(source), lang, source, doc_id)] += n
    tokens = defaultdict(int)
    for unit, n in units.items():
        tokens[unit[:3]] += n
    budgets = plain_budgets(tokens, sum(tokens.values()) * share[0] // share[1], epochs, weights)
    out = []
    for leaf, total in tokens.items():
        own = {u[3]: n for u, n in units.items() if u[:3] == leaf}
        whole, part = divmod(budgets[leaf], total) if total else (1, 0)
        out += [(i, *leaf, e, n, None, n) for i, n in own.items() for e in range(whole)]
        place = lambda i: hashlib.md5(f"{seed}|{whole}|{'' if i is None else i}".encode()).hexdigest()[:15]  # noqa: B023, E731
        before = 0
        for i in sorted(own, key=lambda i: (place(i), i is not None, i or 0)):
            if before < part:
                out.append((i, *leaf, whole, own[i], before, min(own[i], part - before)))
            before += own[i]
    return sorted(out, key=lambda r: tuple(map(str, r)))


def sample():
    pick = random.Random(11)
    data = []
    for i in range(800):
        source = pick.choice(["s1"] * 6 + ["s2", "s3", "s4", None])
        lang = pick.choice(["en"] * 5 + ["de", "fr", None])
        data.append((i, "w " * pick.randint(0, 60), lang, source, "t", 1))
    data += [(3, data[3][1], data[3][2], data[3][3], "t", 1), (None, "a b c", "en", "s1", None, None),
             (None, "a b", "en", "s1", None, None), (9000, "", "empty", "none", "t", 1),
             (9001, None, "empty", "none", "t", 1), (9002, "long " * 60_000, "fr", "s2", "t", 1)]
    return data


def domain():
    return F.when(F.col("source") == "s1", "x").otherwise("y")


@pytest.mark.parametrize("share, epochs", [((3, 2), 4), ((1, 2), 1), ((9, 1), 3), ((0, 1), 2)])
def test_mix(spark, share, epochs):
    df = spark.createDataFrame(sample(), SCHEMA)
    got = mix(df, domain(), share, epochs, seed=5, weights=WEIGHTS, slice_docs=16)
    assert rows(got) == plain_mix(sample(), share, epochs, 5, WEIGHTS)


def test_shortage_goes_to_siblings_first(spark):
    leaves = spark.createDataFrame(
        [("a", "x", "small", 10), ("a", "x", "large", 1000), ("b", "y", "only", 1000)],
        "domain string, lang string, source string, tokens long")
    got = {r.source: r.budget for r in leaf_budgets(leaves, 400, 1).collect()}
    assert got == {"small": 10, "large": 190, "only": 200}
    got = {r.source: r.budget for r in leaf_budgets(leaves, 2004, 1).collect()}
    assert got == {"small": 10, "large": 994, "only": 1000}


def test_mixed_keeps_rows(spark):
    df = spark.createDataFrame(sample(), SCHEMA)
    got = mixed(df, domain(), (1, 2), seed=5, weights=WEIGHTS)
    taken = {r[:4] for r in plain_mix(sample(), (1, 2), 1, 5, WEIGHTS)}
    expected = [r for r in sample() if (r[0], "x" if r[3] == "s1" else "y", r[2], r[3]) in taken]
    assert got.columns == df.columns
    assert rows(got) == sorted(map(tuple, expected), key=lambda r: tuple(map(str, r)))


def test_no_rows(spark):
    assert mix(spark.createDataFrame([], SCHEMA), domain(), (1, 2)).count() == 0
