"""Facts and ratios on small hand-made filings."""

import datetime
import json

from conftest import rows

from tallyweave.operators import facts as ft
from tallyweave.sources import files


def _fact(label, concept, value, unit="usd"):
    return {"label": label, "concept": concept, "unit": unit, "value": value}


def _filing(year, quarter, facts, **more):
    filing = {
        "accessNumber": "a", "cik": "1", "year": year, "quarter": quarter, "form": "10-K",
        "startDate": "2022-01-01", "endDate": "bad date", "filedDate": "", "acceptedDate": "",
        "report": {"bs": facts},
    }
    filing.update(more)
    return filing


FULL = [
    _fact("Total assets", "us-gaap_Assets", "100"),
    _fact("Z assets", "custom:us-gaap_Assets", "999"),
    _fact("L and E", "us-gaap_LiabilitiesAndStockholdersEquity", "100"),
    _fact("Equity", "StockholdersEquity", "40"),
    _fact("Retained", "us-gaap_RetainedEarningsAccumulatedDeficit", "10"),
    _fact("Current assets", "us-gaap_AssetsCurrent", "30"),
    _fact("Current liabilities", "us-gaap_LiabilitiesCurrent", "20"),
    _fact("Inventory", "InventoryNet", "5"),
]


def _read(spark, tmp_path, data, symbol="ACME"):
    (tmp_path / f"{symbol}.json").write_text(
        json.dumps({"cik": "1", "symbol": symbol, "data": data}, indent=1))
    return ft.flatten_filings(files.read_filings(spark, str(tmp_path))).cache()


def test_empty_and_missing_arrays_give_no_rows(spark, tmp_path):
    missing = _filing("2022", "2", [])
    del missing["report"]
    facts = _read(spark, tmp_path, [
        _filing("2022", "1", FULL), _filing("2022", "3", []), missing])
    assert facts.count() == len(FULL)
    assert set(facts.columns) >= {"cik", "symbol", "accessNumber", "form", "label", "value"}


def test_duplicates_compare_value_text(spark, tmp_path):
    facts = _read(spark, tmp_path, [_filing("2022", "1", [
        _fact("b", "c1", "1"), _fact("a", "c2", "1"), _fact("a", "c3", "1.0"),
        _fact("a", "c4", "N/A")])])
    numbered = rows(ft.annotate_duplicates(facts).select(
        "label", "concept", "value", "DuplicateCount", "startDate", "endDate"))
    day = datetime.date(2022, 1, 1)
    assert numbered == [
        ("a", "c2", 1.0, 1, day, None), ("a", "c3", 1.0, 1, day, None),
        ("a", "c4", None, 1, day, None), ("b", "c1", 1.0, 2, day, None),
    ]
    kept = rows(ft.keep_first(facts).select("label", "concept"))
    assert kept == [("a", "c2"), ("a", "c3"), ("a", "c4")]


def test_ratios(spark, tmp_path):
    facts = _read(spark, tmp_path, [_filing("2022", "1", FULL)])
    (row,) = ft.ratios_left(facts).collect()
    assert row.total_assets == 100 and row.total_liabilities == 60
    assert row.debt_equity_ratio == 1.5 and row.debt_asset_ratio == 0.6
    assert row.return_on_assets == 0.1 and row.working_capital == 10
    assert row.current_ratio == 1.5 and row.quick_ratio == 1.25


def test_zero_divisor_missing_concept_and_other_unit(spark, tmp_path):
    zero = [_fact("A", "us-gaap_Assets", "0"), _fact("R", "us-gaap_RetainedEarningsAccumulatedDeficit", "3"),
            _fact("E", "StockholdersEquity", "7", unit="eur")]
    no_assets = [_fact("E", "StockholdersEquity", "7")]
    facts = _read(spark, tmp_path, [_filing("2021", "4", zero), _filing("2020", "4", no_assets)])
    (row,) = ft.ratios_left(facts).collect()
    assert row.year == "2021" and row.return_on_assets is None
    # The equity is picked whatever its unit, and then its unit does not match.
    assert row.total_equities is None and row.retained_earnings == 3


def test_first_label_wins_before_unit(spark, tmp_path):
    facts = _read(spark, tmp_path, [_filing("2022", "1", [
        _fact("B", "us-gaap_Assets", "2"), _fact("A", "us-gaap_Assets", "1", unit="shares"),
        _fact("E", "StockholdersEquity", "5")])])
    (row,) = ft.ratios_left(facts).collect()
    assert (row.unit, row.total_assets, row.total_equities) == ("shares", 1.0, None)


def test_underscore_is_a_wildcard_unless_exact(spark, tmp_path):
    facts = _read(spark, tmp_path, [_filing("2022", "1", [_fact("A", "us-gaapXAssets", "1")])])
    assert ft.ratios_left(facts).count() == 1
    assert ft.ratios_left(facts, exact=True).count() == 0
    assert ft.concept_view(facts, ["%us-gaap_Assets"]).count() == 1
    assert ft.concept_view(facts, ["%us-gaap_Assets"], exact=True).count() == 0


def test_one_pass_equals_joins(spark, tmp_path):
    other = [dict(f, value=str(float(f["value"]) * 2)) for f in FULL[:5]] + [
        _fact("Equity", "us-gaap_StockholdersEquity", "N/A", unit="eur"),
        _fact(None, "us-gaap_AssetsCurrent", "3"),
    ]
    nulls = _filing(None, "1", FULL)
    facts = _read(spark, tmp_path, [
        _filing("2022", "1", FULL), _filing("2022", "2", other), _filing("2023", "1", FULL[2:]),
        _filing("2022", "1", other), nulls])
    once = ft.ratios_left(facts)
    assert rows(once) == rows(ft.ratios_left_by_joins(facts).select(*once.columns))


def test_inner_ratios_multiply_repeated_facts(spark, tmp_path):
    (tmp_path / "q.json").write_text(json.dumps({
        "startDate": "2022-01-01", "endDate": "2022-03-31", "year": "2022", "quarter": "1",
        "symbol": "ACME", "data": {"bs": [
            _fact("Total current assets", "x", "30"), _fact("Total current assets", "y", "60"),
            _fact("Total current liabilities", "x", "20"), _fact("i", "InventoryNet", "5"),
            _fact("Total assets", "x", "100"), _fact("Total liabilities", "x", "50")]}}, indent=1))
    facts = ft.keep_first(ft.flatten_quarterly(files.read_quarterly(spark, str(tmp_path))))
    got = rows(ft.ratios_inner(facts).select("total_current_assets", "quick_ratio", "debt_asset_ratio"))
    assert got == [(30.0, 1.25, 0.5), (60.0, 2.75, 0.5)]
