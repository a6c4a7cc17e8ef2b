"""Merges, deletes, change feeds and table versions."""

import __spark_entry__ as entry_module
import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as some
from pyspark.sql import functions as F

from tallyweave.operators import upkeep as up
from tallyweave.sources import tables as tb

SCHEMA = "symbol string, year string, quarter string, ratio double"
KEY = ["symbol", "year", "quarter"]


def _table(spark, data):
    return spark.createDataFrame(data, SCHEMA)


TARGET = [("A", "2022", "1", 1.0), ("A", "2022", "2", 2.0), (None, "2022", "1", 9.0)]
SOURCE = [("A", "2022", "2", 2.5), ("B", "2022", "1", 3.0), (None, "2022", "1", 8.0)]


def test_upsert(spark):
    merged = up.merge_upsert(_table(spark, TARGET), _table(spark, SOURCE), KEY)
    assert rows(merged) == sorted(
        [("A", "2022", "1", 1.0), ("A", "2022", "2", 2.5), ("B", "2022", "1", 3.0),
         (None, "2022", "1", 8.0), (None, "2022", "1", 9.0)], key=lambda r: tuple(map(str, r)))


def test_upsert_takes_null_values(spark):
    merged = up.merge_upsert(
        _table(spark, TARGET[:1]), _table(spark, [("A", "2022", "1", None)]), KEY)
    assert rows(merged) == [("A", "2022", "1", None)]


def test_two_source_rows_for_one_target_row_raise(spark):
    twice = _table(spark, [("A", "2022", "2", 1.0), ("A", "2022", "2", 2.0)])
    with pytest.raises(Exception, match="several source rows"):
        up.merge_upsert(_table(spark, TARGET), twice, KEY).collect()
    # Without a partner both are new rows.
    assert up.merge_upsert(_table(spark, TARGET[:1]), twice, KEY).count() == 3


@pytest.mark.parametrize("merge", [
    up.merge_upsert, lambda t, s, k: up.merge_when_changed(t, s, k, "ratio")])
def test_clashes_raise_whatever_is_read(spark, merge):
    twice = _table(spark, [("A", "2022", "2", 1.0), ("A", "2022", "2", 2.0)])
    merged = merge(_table(spark, TARGET), twice, KEY)
    for read in (merged.count, merged.select("symbol").collect, merged.collect):
        with pytest.raises(Exception, match="several source rows"):
            read()


def test_feed_of_repeated_keys_raises(spark):
    twice = _table(spark, [("A", "2022", "2", 1.0), ("A", "2022", "2", 2.0)])
    for old, new in ((TARGET, twice), (twice, TARGET)):
        sides = [side if not isinstance(side, list) else _table(spark, side) for side in (old, new)]
        with pytest.raises(Exception, match="a key is repeated"):
            up.change_feed(*sides, KEY).count()


def test_replaced_table_keeps_its_partitions_and_place(spark):
    tb.use_namespace(spark, "kept")
    up.create_table(_table(spark, TARGET), "parted", ["quarter"])
    folder = up._location(spark, "parted").rpartition("/")[0]
    for wider in (False, True):
        new = _table(spark, SOURCE + [("C", "2023", "2", 4.0)])
        up.replace_table(new.withColumn("rank", F.lit(1)) if wider else new, "parted")
        assert up._partition_columns(spark, "parted") == ["quarter"]
        assert up._location(spark, "parted").rpartition("/")[0] == folder
        first = spark.table("parted").filter("quarter = '2'")
        assert rows(first.select("symbol")) == [("A",), ("C",)]
        assert "PartitionFilters: [isnotnull(quarter" in (
            first._jdf.queryExecution().executedPlan().toString())
    assert up.drop_superseded(spark, "parted") == 1
    assert up.drop_superseded(spark, "parted") == 0
    assert spark.table("parted").count() == 4
    up.create_view(spark, "seen", "SELECT symbol FROM parted WHERE quarter = '2'")
    up.create_view(spark, "seen", "SELECT symbol FROM parted WHERE quarter = '1'")
    assert rows(spark.table("seen")) == [("B",), (None,)]
    tb.use_namespace(spark, "default")


def test_insert_only(spark):
    merged = up.merge_insert_only(_table(spark, TARGET), _table(spark, SOURCE), KEY)
    assert (("A", "2022", "2", 2.0) in rows(merged)) and merged.count() == 5


def test_update_one_column_when_changed(spark):
    schema = "id long, title string, content string"
    target = spark.createDataFrame(
        [(100, "t", "a"), (101, "t", "b"), (102, "t", None), (103, "t", "d")], schema)
    source = spark.createDataFrame(
        [(100, "u", "a"), (101, "u", "B"), (102, "u", "c"), (103, "u", None), (104, "u", "e")],
        schema)
    assert rows(up.merge_when_changed(target, source, ["id"], "content")) == [
        (100, "t", "a"), (101, "t", "B"), (102, "t", None), (103, "t", "d"), (104, "u", "e")]


def test_delete_keeps_unknown(spark):
    left = up.delete_where(_table(spark, TARGET), F.col("symbol") == "A")
    assert rows(left) == [(None, "2022", "1", 9.0)]


rows_of = some.lists(
    some.tuples(some.sampled_from("ABCDE"), some.sampled_from(["1", "2"])), unique=True
).flatmap(lambda keys: some.tuples(*[
    some.tuples(some.just(s), some.just("2022"), some.just(q),
                some.one_of(some.none(), some.sampled_from([1.0, 2.0]))) for s, q in keys]))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows_of, rows_of)
def test_change_feed_leads_from_old_to_new(spark, old, new):
    before, after = _table(spark, list(old)), _table(spark, list(new))
    feed = up.change_feed(before, after, KEY)
    assert rows(up.apply_changes(before, feed, KEY)) == rows(after)
    assert {(r.change, r.symbol, r.quarter) for r in feed.collect()} == (
        {("insert", s, q) for s, _, q, _ in new if not any((s, q) == (o[0], o[2]) for o in old)}
        | {("delete", s, q) for s, _, q, _ in old if not any((s, q) == (n[0], n[2]) for n in new)}
        | {("update", n[0], n[2]) for n in new for o in old
           if (n[0], n[2]) == (o[0], o[2]) and n[3] != o[3]})


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows_of, rows_of)
def test_upsert_twice_is_upsert_once(spark, old, new):
    once = up.merge_upsert(_table(spark, list(old)), _table(spark, list(new)), KEY)
    assert rows(up.merge_upsert(once, _table(spark, list(new)), KEY)) == rows(once)


def test_tables(spark):
    tb.use_namespace(spark, "books")
    up.create_table_if_absent(spark, "ratios", "symbol STRING, year STRING, quarter STRING, ratio DOUBLE")
    up.create_table_if_absent(spark, "ratios", "other INT")
    assert tb.describe(spark, "ratios").count() == 4
    up.replace_table(_table(spark, TARGET), "ratios")
    # The new content may come from the table itself, more than once.
    for _ in range(2):
        merged = up.merge_upsert(tb.scan_table(spark, "ratios"), _table(spark, SOURCE[:2]), KEY)
        up.replace_table(merged, "ratios")
    assert tb.scan_table(spark, "ratios").count() == 4

    up.create_table(_table(spark, TARGET), "fresh")
    with pytest.raises(Exception, match="exist"):
        up.create_table(_table(spark, TARGET), "fresh")
    up.create_table(_table(spark, TARGET), "by_quarter", ["quarter"])
    first = spark.table("by_quarter").filter("quarter = '1'")
    assert first.count() == 2
    assert "PartitionFilters: [isnotnull(quarter" in (
        first._jdf.queryExecution().executedPlan().toString())
    up.create_table_as(spark, "derived", "SELECT symbol FROM fresh WHERE symbol IS NOT NULL")
    assert spark.table("derived").count() == 2

    copy = up.snapshot(spark.table("fresh"), "copy")
    up.replace_table(_table(spark, TARGET[:1]), "fresh")
    assert up.snapshot(spark.table("fresh"), "copy").count() == copy.count() == 3
    # A wider schema replaces the table as well.
    wider = up.union_with_new_columns(
        spark.table("fresh"), spark.createDataFrame([("C", 1)], "symbol string, rank int"))
    up.replace_table(wider, "fresh")
    assert spark.table("fresh").columns[-1] == "rank" and spark.table("fresh").count() == 2
    up.replace_table(up.drop_columns(spark.table("fresh"), "rank", "absent"), "fresh")
    assert "rank" not in spark.table("fresh").columns
    tb.use_namespace(spark, "default")


def test_all_orders_are_saved(spark):
    folder = "/root/testdata/sf0.001"
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    saved = entry_module.queries()["table_save_all"](spark, folder)
    counts = [dict(df.groupBy("o_orderstatus").count().collect()) for df in (orders, saved)]
    assert counts[0] == counts[1] and "O" in counts[1]


def _files(spark, name):
    return {row.path: row.year for row in spark.table(name).select(
        "year", F.input_file_name().alias("path")).distinct().collect()}


def test_upsert_leaves_other_partitions_alone(spark):
    start = [("A", "2021", "1", 1.0), ("A", "2022", "1", 2.0), ("B", "2022", "1", 3.0), ("C", "2023", "1", 4.0)]
    up.create_table(_table(spark, start), "by_year_test", ["year"])
    before = _files(spark, "by_year_test")
    source = _table(spark, [("A", "2022", "1", 2.5), (None, "2022", "1", 8.0), ("D", "2024", "1", 9.0)])
    for _ in range(2):  # a row without a key matches nothing and comes once a call
        up.upsert_partitions(source, "by_year_test", KEY)
        after = _files(spark, "by_year_test")
        kept = {path for path, year in before.items() if year in ("2021", "2023")}
        assert kept == {path for path, year in after.items() if year in ("2021", "2023")}
        assert not {path for path, year in before.items() if year == "2022"} & set(after)
    got = rows(spark.table("by_year_test").select("symbol", "year", "ratio"))
    assert got == rows(spark.createDataFrame(
        [("A", "2021", 1.0), ("A", "2022", 2.5), ("B", "2022", 3.0), ("C", "2023", 4.0),
         (None, "2022", 8.0), (None, "2022", 8.0), ("D", "2024", 9.0)],
        "symbol string, year string, ratio double"))
    up.upsert_partitions(source.limit(0), "by_year_test", KEY)
    assert _files(spark, "by_year_test") == after
    for bad, message in [(("E", None, "1", 1.0), "partition column"), (("A", "2022", "1", 1.0), "several source")]:
        with pytest.raises(Exception, match=message):
            up.upsert_partitions(_table(spark, [bad, bad]), "by_year_test", KEY)
        assert _files(spark, "by_year_test") == after
    with pytest.raises(ValueError, match="partition columns"):
        up.upsert_partitions(source, "by_year_test", ["symbol"])
