"""What the plans must and must not hold, so that they stand larger data."""

import re

import pytest

import __spark_entry__ as entry_module

FOLDER = "/root/testdata/sf0.001"
QUERIES = entry_module.queries()


def plan(spark, name):
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return len(re.findall(r"(?<!Broadcast)Exchange (?:hash|range|Single|RoundRobin)", text))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairs_and_no_python_rows(spark, name):
    text = plan(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in text


@pytest.mark.parametrize("name", [
    "html_to_text", "html_elements", "html_assemble", "doc_assemble", "table_titles",
    "chunk_route", "word_chunks", "sentences", "text_clean", "numeric_line_filter",
    "explode_nested", "explode_two_level", "json_array_explode", "filter_like_or",
])
def test_row_work_has_no_exchange(spark, name):
    assert exchanges(plan(spark, name)) == 0


@pytest.mark.parametrize("name,most", [
    ("ratios_left", 1), ("pick_first", 1), ("dedupe_keep_first", 1),
    ("change_feed", 2), ("vector_topk", 4), ("fin_stmts_silver", 5),
])
def test_number_of_exchanges(spark, name, most):
    assert 0 < exchanges(plan(spark, name)) <= most


def test_ratios_need_no_join_and_read_few_columns(spark):
    text = plan(spark, "ratios_left")
    assert "Join" not in text
    assert "l_comment" not in text and "l_quantity" not in text


def test_filters_reach_the_scan(spark):
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in plan(spark, "filter_eq")
    assert "StringContains(url,page=)" in plan(spark, "filter_contains")
    assert "StringEndsWith(p_name,widget)" in plan(spark, "filter_like")


def test_ranks_are_limited_before_the_exchange(spark):
    for name in ("pick_first", "pick_nth", "dedupe_keep_first", "vector_topk"):
        assert "WindowGroupLimit" in plan(spark, name)
