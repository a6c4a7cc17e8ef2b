"""Row numbers with and without hot groups."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyweave.operators import numbering as nb


def _skewed(spark):
    rng = random.Random(7)
    data = [("hot", "same", 0)] * 900  # a third of all rows are copies
    data += [("hot", f"l{rng.randrange(40)}", rng.randrange(5)) for _ in range(900)]
    data += [(None, f"l{rng.randrange(9)}", rng.randrange(9)) for _ in range(300)]
    data += [(f"g{i % 300}", f"l{rng.randrange(9)}", i) for i in range(600)]
    return spark.createDataFrame(data, "g string, label string, n int").repartition(6)


@pytest.mark.parametrize("slice_rows", [1_000_000, 200, 37])
def test_numbers_do_not_depend_on_slices(spark, slice_rows):
    df = _skewed(spark)
    got = nb.number_rows(df, ["g"], ["label", "n"], "rn", slice_rows)
    groups = {}
    for row in sorted(df.collect(), key=lambda r: (r.label, r.n)):
        groups.setdefault(row.g, []).append(row)
    expected = [(*row, rn) for own in groups.values() for rn, row in enumerate(own, 1)]
    assert rows(got) == sorted(expected, key=lambda r: tuple(map(str, r)))


def test_a_hot_group_spans_many_slices(spark):
    df = _skewed(spark).filter("g = 'hot'").withColumn("n", F.lit(0)).withColumn("label", F.lit("x"))
    sizes = nb.in_slices(df, ["g", "label", "n"], 200).groupBy("_slice").count().collect()
    assert len(sizes) > 5 and max(r["count"] for r in sizes) < 600
    numbered = nb.number_rows(df, ["g"], ["label", "n"], "rn", 200)
    assert [r.rn for r in numbered.orderBy("rn").collect()] == list(range(1, 1801))


def test_group_limit_before_the_exchange(spark):
    plan = nb.first_rows(_skewed(spark), ["g"], ["label", "n"], 2, "rn")._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


@pytest.mark.parametrize("slice_rows", [1_000_000, 64])
def test_running_numbers(spark, slice_rows):
    # Keys far apart and unevenly spread, each of them three times.
    keys = spark.range(500).select((F.col("id") * F.col("id") * 1_000_003).alias("key"))
    df = keys.unionByName(keys).unionByName(keys).repartition(5)
    got = nb.running_numbers(df, ["key"], "id", 100, slice_rows).orderBy("id").collect()
    assert [row.id for row in got] == list(range(100, 1600))
    assert [row.key for row in got] == sorted(row.key for row in got)


def test_no_rows(spark):
    df = spark.createDataFrame([], "g string, n int")
    assert nb.number_rows(df, ["g"], ["n"], "rn").count() == 0
    assert nb.running_numbers(df, ["n"], "id").count() == 0
