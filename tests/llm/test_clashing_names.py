"""Columns of the user named like any column that a function makes on its way stay as they are."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyweave.llm import exact, mixing, simhash, toxicity

BASE = "doc_id long, text string, lang string, source string"


def helper_names():
    """Every name that the modules give to a column, and those of round two."""
    names = set("_exact_hash _near_own _mix _exact_id _exact_copies _near_root _mix_lang _toxic_score".split())
    for module in (exact, mixing, simhash, toxicity):
        text = Path(module.__file__).read_text()
        names |= set(re.findall(r'(?:alias|withColumn)\("(\w+)"', text))
    return sorted(names - set("doc_id text lang source".split()))


@pytest.fixture(scope="module")
def docs(spark):
    names = helper_names()
    assert {"whole", "own_id", "copies", "score"} <= set(names)
    rows = [(at, text, "en", f"s{at % 2}", *[f"{at} {name}" for name in names]) for at, text in enumerate(
        ["one two three four", "one two  three four", "other words are here", "bad grumblor text", ""])]
    schema = ", ".join([BASE, *[f"`{name}` string" for name in names]])
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("function", [
    exact.exact_dedup, simhash.simhash_dedup,
    lambda docs: mixing.mixed(docs, F.col("source"), (9, 10)),
    lambda docs: toxicity.without_toxic(docs, toxicity.Model()),
], ids=["exact", "simhash", "mixed", "toxic"])
def test_values_come_back(docs, function):
    given = {tuple(row) for row in docs.collect()}
    got = function(docs)
    rows = [tuple(row) for row in got.collect()]
    assert got.columns == docs.columns and rows and set(rows) <= given
