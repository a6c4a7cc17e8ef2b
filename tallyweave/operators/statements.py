"""Annual-filing statements from the submission, number and line tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import any_of, as_date
from .numbering import SLICE_ROWS, first_rows, number_rows

# Output column -> (statement, tag) of the eleven views.
STATEMENTS = {
    "total_assets": ("BS", "Assets"),
    "total_liabilities": ("BS", "Liabilities"),
    "inventories": ("BS", "InventoryNet"),
    "current_assets": ("BS", "AssetsCurrent"),
    "current_liabilities": ("BS", "LiabilitiesCurrent"),
    "total_equities": ("BS", "StockholdersEquity"),
    "cogs": ("IS", "CostOfGoodsAndServicesSold"),
    "gross_profit": ("IS", "GrossProfit"),
    "operating_expenses": ("IS", "OperatingExpenses"),
    "profit_loss": ("IS", "ProfitLoss"),
    "revenues": ("IS", "Revenues"),
}

FILING_COLUMNS = ["cik", "name", "ein", "form", "period", "fy", "fp"]
# Date first; unit and value only settle ties.
REPORT_ORDER = ["ddate", "uom", "value"]


def _is_role(stmt: str, tag: str) -> Column:
    return (F.col("stmt") == stmt) & (F.col("tag") == tag)


def _wanted(roles: Mapping[str, tuple[str, str]]) -> Column:
    return any_of(_is_role(*pair) for pair in roles.values())


def _lines(pre: DataFrame, roles: Mapping[str, tuple[str, str]]) -> DataFrame:
    """How often each number key stands on a statement.

    Counted per join key with one count per statement, so the join that
    follows needs no further exchange.
    """
    names = sorted({stmt for stmt, _ in roles.values()})
    counts = [F.count(F.when(F.col("stmt") == name, True)).alias(f"_{name}") for name in names]
    found = F.explode(F.array(*[
        F.struct(F.lit(name).alias("stmt"), F.col(f"_{name}").alias("copies")) for name in names
    ]))
    return (
        pre.filter(_wanted(roles)).groupBy("adsh", "tag", "version").agg(*counts)
        .select("adsh", "tag", "version", found.alias("_s"))
        .select("adsh", "tag", "version", "_s.stmt", "_s.copies")
        .filter("copies > 0")
    )


def _reported(
    sub: DataFrame, pre: DataFrame, num: DataFrame,
    roles: Mapping[str, tuple[str, str]], form: str, most: int | None,
) -> DataFrame:
    """Numbers on the wanted statements of one form, once per line.

    Where only the first `most` rows per group matter, the line table is
    reduced to one row per key before the join, so a key with many lines and
    many numbers meets as rows times one. Copies of a row are equal, so the
    first `most` rows stay the same with at most `most` copies of each.
    """
    tags = sorted({tag for _, tag in roles.values()})
    filings = sub.filter(F.col("form") == form).select("adsh", *FILING_COLUMNS)
    numbers = num.filter(F.col("tag").isin(tags)).select("adsh", "tag", "version", *REPORT_ORDER)
    key = ["adsh", "tag", "version"]
    if most is None:
        lines = pre.filter(_wanted(roles)).select(*key, "stmt")
        return numbers.join(lines, key).join(filings, "adsh").drop("version")
    copies = F.sequence(F.lit(1), F.least("copies", F.lit(most)).cast("int"))
    return (
        numbers.join(_lines(pre, roles), key)
        .join(filings, "adsh")
        .withColumn("_copy", F.explode(copies))
        .drop("copies", "_copy", "version")
    )


def statement_rows(
    sub: DataFrame, pre: DataFrame, num: DataFrame,
    roles: Mapping[str, tuple[str, str]] = STATEMENTS,
    form: str = "10-K", slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """All statement views in one table, numbered by date per filing and tag.

    A reader that wants an order sorts the result; a view keeps none.
    """
    rows = _reported(sub, pre, num, roles, form, None)
    return number_rows(rows, ["adsh", "stmt", "tag"], REPORT_ORDER, "dup", slice_rows)


def statement_view(
    sub: DataFrame, pre: DataFrame, num: DataFrame, role: str,
    roles: Mapping[str, tuple[str, str]] = STATEMENTS,
    form: str = "10-K", slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """One statement view, its value under the name of the role."""
    rows = statement_rows(sub, pre, num, {role: roles[role]}, form, slice_rows)
    return rows.withColumnRenamed("value", role)


def pick_nth(
    sub: DataFrame, pre: DataFrame, num: DataFrame,
    roles: Mapping[str, tuple[str, str]] = STATEMENTS,
    form: str = "10-K", n: int = 2,
) -> DataFrame:
    """The n-th reported value by date, per filing and tag.

    Filings with fewer than `n` values of a tag give no row for it.
    """
    rows = _reported(sub, pre, num, roles, form, n)
    return first_rows(rows, ["adsh", "stmt", "tag"], REPORT_ORDER, n, "dup").filter(
        F.col("dup") == n
    )


def statement_table(
    sub: DataFrame, pre: DataFrame, num: DataFrame,
    roles: Mapping[str, tuple[str, str]] = STATEMENTS,
    form: str = "10-K", n: int = 2,
    base: str = "total_assets", required: str | None = "total_liabilities",
) -> DataFrame:
    """One wide row per filing: the n-th value of every role.

    A filing needs the `base` and `required` roles; other roles may be NULL.
    Each role has one row per filing here, so a conditional aggregate takes
    the place of the chain of joins. The picked rows carry a marker each, so
    a reported NULL value still counts as present.
    """
    picked = pick_nth(sub, pre, num, roles, form, n)
    found = {
        role: F.max(F.when(_is_role(*pair), F.struct("value", "uom")))
        for role, pair in roles.items()
    }
    wide = picked.groupBy("adsh", *FILING_COLUMNS).agg(
        *[value.alias(f"_{role}") for role, value in found.items()]
    ).filter(F.col(f"_{base}").isNotNull())
    if required:
        wide = wide.filter(F.col(f"_{required}").isNotNull())
    return wide.select(
        "adsh", *FILING_COLUMNS,
        F.col(f"_{base}.uom").alias("uom"),
        *[F.col(f"_{role}.value").alias(role) for role in roles],
    )


def statement_table_by_joins(
    sub: DataFrame, pre: DataFrame, num: DataFrame,
    roles: Mapping[str, tuple[str, str]] = STATEMENTS,
    form: str = "10-K", n: int = 2,
    base: str = "total_assets", required: str | None = "total_liabilities",
) -> DataFrame:
    """The same table as a chain of joins; the plain form to compare with."""
    picked = pick_nth(sub, pre, num, roles, form, n)

    def values(role: str) -> DataFrame:
        return picked.filter(_is_role(*roles[role])).withColumnRenamed("value", role)

    wide = values(base).select("adsh", *FILING_COLUMNS, "uom", base)
    for role in roles:
        if role != base:
            how = "inner" if role == required else "left"
            wide = wide.join(values(role).select("adsh", role), "adsh", how)
    return wide.select("adsh", *FILING_COLUMNS, "uom", *roles)


def statement_lines(
    sub: DataFrame, pre: DataFrame, num: DataFrame, stmt: str, tag: str, form: str = "10-K"
) -> DataFrame:
    """Three-way join for inspection, every line of every number, tags descending.

    The tag is the same everywhere, so filing and date follow it in the order;
    a sort on the tag alone would put all rows in one task.
    """
    return (
        num.filter(F.col("tag") == tag)
        .join(pre.filter(F.col("stmt") == stmt), ["adsh", "tag", "version"])
        .join(sub.filter(F.col("form") == form), "adsh")
        .orderBy(F.col("tag").desc(), "adsh", *REPORT_ORDER)
    )


def concept_facts(companies: DataFrame, concept: str, unit: str = "USD") -> DataFrame:
    """Long fact table of one concept, with typed dates.

    `companies` has one column per concept, as `expand_concepts` gives it.
    """
    facts = companies.select(
        "cik", "entityName", F.explode(F.col(f"`{concept}`.units.`{unit}`")).alias("x")
    )
    return facts.select(
        "cik", "entityName", "x.accn",
        as_date("x.end").alias("end"), as_date("x.filed").alias("filed"),
        "x.form", "x.fp", "x.frame", "x.fy", "x.val",
    )


def expand_concepts(companies: DataFrame, taxonomy: str = "us-gaap") -> DataFrame:
    """One column per concept of a taxonomy."""
    return companies.select("cik", "entityName", f"facts.`{taxonomy}`.*")


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)
