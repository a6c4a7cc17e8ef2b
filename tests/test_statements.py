"""Statement sets and company facts on small files."""

import datetime
import json

from conftest import rows

from tallyweave.operators import statements as st
from tallyweave.sources import files

SUB = "adsh\tcik\tname\tein\tform\tperiod\tfy\tfp\n" + "".join(
    f"{a}\t1\tname {a}\t9\t{form}\t20221231\t2022\tFY\n"
    for a, form in (("f1", "10-K"), ("f2", "10-K"), ("f3", "10-Q"), ("f4", "10-K")))
PRE = "adsh\tstmt\ttag\tversion\n" + "".join(
    f"{a}\t{stmt}\t{tag}\tv1\n" for a in ("f1", "f2", "f3", "f4") for stmt, tag in (
        ("BS", "Assets"), ("BS", "Liabilities"), ("IS", "Revenues"))
) + "f4\tBS\tAssets\tv1\n"
NUM = "adsh\ttag\tversion\tddate\tuom\tvalue\n" + "".join(
    f"{a}\t{tag}\t{v}\t{day}\tUSD\t{value}\n" for a, tag, v, day, value in (
        ("f1", "Assets", "v1", 20211231, 1), ("f1", "Assets", "v1", 20221231, 2),
        ("f1", "Assets", "v1", 20231231, 3), ("f1", "Liabilities", "v1", 20211231, 4),
        ("f1", "Liabilities", "v1", 20221231, 5), ("f1", "Revenues", "v1", 20221231, 6),
        ("f2", "Assets", "v1", 20211231, 7), ("f2", "Assets", "v1", 20211231, 8),
        ("f2", "Assets", "v2", 20201231, 0),
        ("f3", "Assets", "v1", 20211231, 9), ("f3", "Assets", "v1", 20221231, 9),
        ("f4", "Assets", "v1", 20211231, 10), ("f4", "Liabilities", "v1", 20211231, 1),
        ("f4", "Liabilities", "v1", 20221231, 11), ("f4", "Assets", "v1", 20221231, 12)))


def _sets(spark, tmp_path):
    # The periods are read from every folder at once.
    for table, text in (("sub", SUB), ("pre", PRE), ("num", NUM)):
        head, *lines = text.splitlines()
        for folder, part in (("2021q4", lines[::2]), ("2022q1", lines[1::2])):
            (tmp_path / folder).mkdir(exist_ok=True)
            (tmp_path / folder / f"{table}.txt").write_text("\n".join([head, *part]) + "\n")
    return [files.read_statement_set(spark, str(tmp_path), t) for t in ("sub", "pre", "num")]


def test_second_value_by_date(spark, tmp_path):
    picked = st.pick_nth(*_sets(spark, tmp_path)).select("adsh", "tag", "value")
    # f2: equal dates, the value decides; f4: one line twice, so its first
    # number is also its second; other versions and forms do not count.
    assert rows(picked) == [
        ("f1", "Assets", 2), ("f1", "Liabilities", 5), ("f2", "Assets", 8),
        ("f4", "Assets", 10), ("f4", "Liabilities", 11)]


def test_wide_table_needs_liabilities(spark, tmp_path):
    sets = _sets(spark, tmp_path)
    wide = st.statement_table(*sets)
    assert rows(wide.select("adsh", "total_assets", "total_liabilities", "revenues")) == [
        ("f1", 2, 5, None), ("f4", 10, 11, None)]
    assert rows(wide) == rows(st.statement_table_by_joins(*sets).select(*wide.columns))


def test_view_numbers_all_rows(spark, tmp_path):
    view = st.statement_view(*_sets(spark, tmp_path), "total_assets")
    assert rows(view.filter("adsh = 'f4'").select("total_assets", "dup")) == [
        (10, 1), (10, 2), (12, 3), (12, 4)]


def test_lines_are_sorted(spark, tmp_path):
    lines = st.statement_lines(*_sets(spark, tmp_path), "BS", "Assets").collect()
    assert [line.adsh for line in lines] == sorted(line.adsh for line in lines)
    assert len(lines) == 3 + 2 + 4


def test_company_facts_with_learnt_schema(spark, tmp_path):
    fact = {"accn": "x", "end": "2022-12-31", "filed": "oops", "form": "10-K", "fp": "FY",
            "frame": "F", "fy": 2022, "val": 5}
    sample = {"cik": 1, "entityName": "One", "facts": {"us-gaap": {
        "Assets": {"units": {"USD": [fact]}}, "Other": {"units": {"USD": [fact]}}}}}
    (tmp_path / "sample.json").write_text(json.dumps(sample, indent=1))
    without = {"cik": 2, "entityName": "Two", "facts": {"us-gaap": {"New": {"units": {}}}}}
    (tmp_path / "all").mkdir()
    (tmp_path / "all" / "part.json").write_text(json.dumps(sample) + "\n" + json.dumps(without))
    schema = files.learn_schema(spark, str(tmp_path / "sample.json"))
    companies = st.expand_concepts(files.read_company_facts(spark, str(tmp_path / "all"), schema))
    assert companies.columns == ["cik", "entityName", "Assets", "Other"]
    (row,) = st.concept_facts(companies, "Assets").collect()
    assert (row.cik, row.end, row.filed, row.val) == (1, datetime.date(2022, 12, 31), None, 5)
    assert [r.entityName for r in st.distinct_sorted(companies, "entityName").collect()] == ["One", "Two"]


def test_piped_files_and_listing(spark, tmp_path):
    (tmp_path / "a.csv").write_text("parent_url|doc_url\nhttp://p|http://d/1.pdf\nhttp://q|\n")
    (tmp_path / "b.csv").write_text("parent_url|doc_url\nhttp://p|http://d/2.html\n")
    crawl = files.read_piped(spark, str(tmp_path / "*.csv"), "parent_url STRING, doc_url STRING")
    assert crawl.count() == 3
    from tallyweave.operators.documents import only_addresses
    assert [r.doc_url for r in only_addresses(crawl).collect()] == ["http://d/1.pdf"]
    (tmp_path / "5.pdf").write_bytes(b"%PDF-1")
    (listed,) = files.list_files(spark, str(tmp_path)).collect()
    assert listed.path.endswith("/5.pdf") and listed.length == 6
    (read,) = files.read_files(spark, str(tmp_path)).collect()
    assert bytes(read.content) == b"%PDF-1"
