"""Balance-sheet facts: flatten, remove repeats, pick one per concept, ratios."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import any_of, as_date, as_double, like_any, ratio
from ..session import stored
from .numbering import SLICE_ROWS, first_rows, number_rows

# The concept patterns of the seven balance-sheet views.
CONCEPTS = {
    "total_assets": ["%us-gaap_Assets"],
    "liabilities_and_equity": ["%LiabilitiesAndStockholdersEquity"],
    "total_equities": ["StockholdersEquity", "us-gaap_StockholdersEquity"],
    "retained_earnings": ["%RetainedEarningsAccumulatedDeficit"],
    "current_assets": ["us-gaap_AssetsCurrent"],
    "current_liabilities": ["us-gaap_LiabilitiesCurrent"],
    "net_inventories": ["us-gaap_InventoryNet", "InventoryNet"],
}

# The column and the exact text behind each view of the
# inner-join ratio table.
LABELS = {
    "total_current_assets": ("label", "Total current assets"),
    "total_current_liabilities": ("label", "Total current liabilities"),
    "net_inventories": ("concept", "InventoryNet"),
    "total_assets": ("label", "Total assets"),
    "total_liabilities": ("label", "Total liabilities"),
}

PERIOD = ["symbol", "year", "quarter"]
# Label and concept first; the rest only settles ties.
FACT_ORDER = ["label", "concept", "unit", "value"]


def flatten_filings(filings: DataFrame) -> DataFrame:
    """Companies to facts, through two arrays. Empty arrays give no rows."""
    reports = filings.select("cik", "symbol", F.explode("data").alias("f"))
    facts = reports.select("cik", "symbol", "f", F.explode("f.report.bs").alias("b"))
    return facts.select(
        "cik", "symbol",
        *[F.col(f"f.{name}") for name in (
            "accessNumber", "year", "quarter", "form",
            "startDate", "endDate", "filedDate", "acceptedDate")],
        *[F.col(f"b.{name}") for name in ("label", "concept", "unit", "value")],
    )


def flatten_quarterly(quarters: DataFrame) -> DataFrame:
    """Quarterly files to facts, through one array inside a struct."""
    facts = quarters.select(
        "startDate", "endDate", "year", "quarter", "symbol", F.explode("data.bs").alias("b")
    )
    return facts.select(
        "startDate", "endDate", "symbol", "year", "quarter",
        *[F.col(f"b.{name}") for name in ("label", "concept", "unit", "value")],
    )


def _typed(facts: DataFrame, *more: str) -> DataFrame:
    return facts.select(
        "label", "concept", "symbol", "unit",
        as_double("value").alias("value"),
        as_date("startDate").alias("startDate"),
        as_date("endDate").alias("endDate"),
        "year", "quarter", *more,
    )


def annotate_duplicates(facts: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Number the facts that repeat one value text inside a period.

    The value is compared as text: `1` and `1.0` differ.
    """
    order = ["label", "concept", "unit", "startDate", "endDate"]
    numbered = number_rows(facts, ["value", *PERIOD], order, "DuplicateCount", slice_rows)
    return _typed(numbered, "DuplicateCount")


def keep_first(facts: DataFrame) -> DataFrame:
    """The first fact of every repeated value."""
    order = ["label", "concept", "unit", "startDate", "endDate"]
    return _typed(first_rows(facts, ["value", *PERIOD], order, 1, "DuplicateCount"))


def _by_role(
    facts: DataFrame, concepts: Mapping[str, Sequence[str]], exact: bool
) -> DataFrame:
    """Facts of the wanted concepts, once per role they match, in one scan.

    Most facts of a filing have no role, so they go before the array of roles
    is built; the tests reach the scan.
    """
    tests = {role: like_any("concept", patterns, exact) for role, patterns in concepts.items()}
    roles = F.array(*[F.when(test, F.lit(role)) for role, test in tests.items()])
    wanted = facts.filter(any_of(tests.values()))
    return wanted.withColumn("role", F.explode(roles)).filter("role is not null")


def concept_views(
    facts: DataFrame,
    concepts: Mapping[str, Sequence[str]] = CONCEPTS,
    exact: bool = False,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """All concept views in one table: facts per role, numbered per period."""
    picked = _by_role(facts, concepts, exact).select("role", *FACT_ORDER, *PERIOD)
    return number_rows(picked, [*PERIOD, "role"], FACT_ORDER, "dup", slice_rows)


def concept_view(
    facts: DataFrame, patterns: Sequence[str], exact: bool = False, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """One concept view."""
    return concept_views(facts, {"one": patterns}, exact, slice_rows).drop("role")


def pick_first(
    facts: DataFrame, concepts: Mapping[str, Sequence[str]] = CONCEPTS, exact: bool = False
) -> DataFrame:
    """The first fact per period and role, whatever its unit."""
    picked = _by_role(facts, concepts, exact).select("role", *FACT_ORDER, *PERIOD)
    return first_rows(picked, [*PERIOD, "role"], FACT_ORDER, 1, "dup").drop("dup")


def _ratio_columns(df: DataFrame) -> DataFrame:
    """Ratios from the seven values, under the names the table has had.

    `total_liabilities` is liabilities and equity less equity, and
    `return_on_assets` is retained earnings over total assets.
    """
    owed = F.col("liabilities_and_equity") - F.col("total_equities")
    return df.select(
        "symbol", "year", "unit", "total_assets", "quarter", "total_equities",
        owed.alias("total_liabilities"),
        ratio(owed, "total_equities").alias("debt_equity_ratio"),
        ratio(owed, "total_assets").alias("debt_asset_ratio"),
        "retained_earnings",
        ratio("retained_earnings", "total_assets").alias("return_on_assets"),
        "current_assets", "current_liabilities",
        (F.col("current_assets") - F.col("current_liabilities")).alias("working_capital"),
        ratio("current_assets", "current_liabilities").alias("current_ratio"),
        "net_inventories",
        ratio(F.col("current_assets") - F.col("net_inventories"), "current_liabilities")
        .alias("quick_ratio"),
    )


def ratios_left(
    facts: DataFrame, concepts: Mapping[str, Sequence[str]] = CONCEPTS, exact: bool = False
) -> DataFrame:
    """Ratio table with one row per period that reports total assets.

    One scan and one exchange: the first fact of every role is the least
    struct in (label, concept, ...) order, found by conditional aggregates
    that combine map side, so neither seven windows nor six joins are needed.
    Another role counts only when its unit is that of the total assets.
    """
    fact = F.struct(*FACT_ORDER)
    firsts = [F.min(F.when(F.col("role") == role, fact)).alias(role) for role in concepts]
    periods = (
        _by_role(facts, concepts, exact)
        .groupBy(*PERIOD).agg(*firsts)
        .filter(F.col("total_assets").isNotNull())
    )
    keyed = F.col("total_assets.unit").isNotNull()
    for key in PERIOD:
        keyed = keyed & F.col(key).isNotNull()

    def value_of(role: str) -> Column:
        same_unit = F.col(f"{role}.unit") == F.col("total_assets.unit")
        return F.when(keyed & same_unit, as_double(f"{role}.value"))

    values = periods.select(
        *PERIOD,
        F.col("total_assets.unit").alias("unit"),
        as_double("total_assets.value").alias("total_assets"),
        *[value_of(role).alias(role) for role in concepts if role != "total_assets"],
    )
    return _ratio_columns(values)


def ratios_left_by_joins(
    facts: DataFrame, concepts: Mapping[str, Sequence[str]] = CONCEPTS, exact: bool = False
) -> DataFrame:
    """The same table as a chain of left joins; the plain form to compare with."""
    first = pick_first(facts, concepts, exact)
    keys = [*PERIOD, "unit"]

    def values(role: str) -> DataFrame:
        return first.filter(F.col("role") == role).select(*keys, as_double("value").alias(role))

    wide = values("total_assets")
    for role in concepts:
        if role != "total_assets":
            wide = wide.join(values(role), keys, "left")
    return _ratio_columns(wide)


def ratios_inner(
    facts: DataFrame, labels: Mapping[str, tuple[str, str]] = LABELS
) -> DataFrame:
    """Ratio table from equal labels or concepts, inner joins on four keys.

    Facts that occur more than once per key and view multiply, as joins do.
    The few facts that have a role are stored first, so whatever made `facts`
    runs once and not for each of the five views.
    """
    keys = [*PERIOD, "unit"]
    tests = {role: F.col(column) == text for role, (column, text) in labels.items()}
    held = stored(
        facts.filter(any_of(tests.values())).select(
            *keys, as_double("value").alias("value"),
            *[F.coalesce(test, F.lit(False)).alias(f"_{role}") for role, test in tests.items()],
        ),
        "ratios",
    )

    def view(role: str) -> DataFrame:
        return held.filter(f"_{role}").select(*keys, F.col("value").alias(role))

    wide = view("total_current_assets")
    for role in ("total_current_liabilities", "net_inventories", "total_assets",
                 "total_liabilities"):
        wide = wide.join(view(role), keys, "inner")
    return wide.select(
        "symbol", "year", "unit", "total_current_assets", "quarter",
        "total_current_liabilities",
        (F.col("total_current_assets") - F.col("total_current_liabilities"))
        .alias("working_capital"),
        ratio("total_current_assets", "total_current_liabilities").alias("current_ratio"),
        "net_inventories",
        ratio(F.col("total_current_assets") - F.col("net_inventories"),
              "total_current_liabilities").alias("quick_ratio"),
        "total_assets", "total_liabilities",
        ratio("total_liabilities", "total_assets").alias("debt_asset_ratio"),
    )
