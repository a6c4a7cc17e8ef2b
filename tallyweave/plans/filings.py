"""Queries over facts, ratios and statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import as_date, as_double, like_any
from ..operators import facts as facts_
from ..operators import statements as st
from ..sources.tables import describe, parquet_table, scan_table
from . import roles


def scan(spark: SparkSession, folder: str) -> DataFrame:
    parquet_table(spark, folder, "customer").createOrReplaceTempView("tallyweave_customer")
    return scan_table(spark, "tallyweave_customer")


def project_rename(spark: SparkSession, folder: str) -> DataFrame:
    return parquet_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice"
    ).withColumnsRenamed({
        "l_orderkey": "symbol_a", "l_linenumber": "concept_a",
        "l_returnflag": "label_a", "l_extendedprice": "value_a",
    })


def filter_eq(spark: SparkSession, folder: str) -> DataFrame:
    lines = parquet_table(spark, folder, "lineitem")
    return lines.filter(F.col("l_returnflag") == "R").select(
        "l_orderkey", "l_partkey", "l_returnflag", "l_extendedprice"
    )


def filter_like(spark: SparkSession, folder: str) -> DataFrame:
    parts = parquet_table(spark, folder, "part")
    return parts.filter(F.col("p_name").like("%widget") & F.col("p_type").like("ECON%")).select(
        "p_partkey", "p_name", "p_type", "p_retailprice"
    ).orderBy("p_retailprice", "p_partkey")


def filter_like_or(spark: SparkSession, folder: str) -> DataFrame:
    parts = parquet_table(spark, folder, "part")
    return parts.filter(like_any("p_name", ["%ring", "red w_dget"])).select(
        "p_partkey", "p_name", "p_type"
    )


def safe_casts(spark: SparkSession, folder: str) -> DataFrame:
    orders = parquet_table(spark, folder, "orders")
    return orders.select(
        "o_orderkey",
        as_double("o_orderpriority").alias("not_a_number"),
        as_double(F.substring("o_orderpriority", 1, 1)).alias("priority"),
        as_date(roles.day("o_orderdate")).cast("string").alias("day"),
        as_date("o_orderstatus").cast("string").alias("not_a_day"),
    )


def count_rows(spark: SparkSession, folder: str) -> DataFrame:
    return parquet_table(spark, folder, "lineitem").agg(F.count("*").alias("n"))


_TYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint",
    "l_linenumber": "int", "l_quantity": "double", "l_extendedprice": "double",
    "l_discount": "double", "l_tax": "double", "l_returnflag": "string",
    "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
}


def describe_schema(spark: SparkSession, folder: str) -> DataFrame:
    """Columns and types of a table, with the values each column holds."""
    lines = parquet_table(spark, folder, "lineitem")
    lines.createOrReplaceTempView("tallyweave_lineitem")
    counts = lines.agg(*[F.count(name).alias(name) for name in lines.columns])
    held = counts.unpivot([], lines.columns, "col_name", "n_values")
    return describe(spark, "tallyweave_lineitem").join(held, "col_name")


def nested(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as quarterly files: one array of four facts in a struct."""
    def fact(column: str, unit: str):
        return F.struct(
            F.col("l_returnflag").alias("label"), F.lit(column).alias("concept"),
            F.lit(unit).alias("unit"), roles.text(column).alias("value"),
        )

    report = F.struct(F.array(
        fact("l_quantity", "pieces"), fact("l_extendedprice", "USD"),
        fact("l_discount", "pure"), fact("l_tax", "pure"),
    ).alias("bs"))
    return parquet_table(spark, folder, "lineitem").select(
        roles.day("l_shipdate").alias("startDate"), roles.day("l_shipdate").alias("endDate"),
        F.year("l_shipdate").cast("string").alias("year"),
        F.quarter("l_shipdate").cast("string").alias("quarter"),
        roles.text("l_suppkey").alias("symbol"), "l_orderkey",
        report.alias("data"),
    )


def explode_nested(spark: SparkSession, folder: str) -> DataFrame:
    flat = facts_.flatten_quarterly(nested(spark, folder))
    return flat.withColumn("value", as_double("value"))


_NESTED = " UNION ALL ".join(
    f"""SELECT strftime(l_shipdate, '%Y-%m-%d') AS startDate,
        strftime(l_shipdate, '%Y-%m-%d') AS endDate, CAST(l_suppkey AS VARCHAR) AS symbol,
        CAST(year(l_shipdate) AS VARCHAR) AS year, CAST(quarter(l_shipdate) AS VARCHAR) AS quarter,
        l_returnflag AS label, '{column}' AS concept, '{unit}' AS unit, {column} AS value
    FROM lineitem"""
    for column, unit in (("l_quantity", "pieces"), ("l_extendedprice", "USD"),
                         ("l_discount", "pure"), ("l_tax", "pure"))
)


def explode_two_level(spark: SparkSession, folder: str) -> DataFrame:
    """Each line item as a company with a filing and its amendment."""
    quarter = nested(spark, folder)

    def filing(form: str):
        return F.struct(
            roles.text("l_orderkey").alias("accessNumber"), F.col("symbol").alias("cik"),
            "year", "quarter", F.lit(form).alias("form"), "startDate", "endDate",
            F.col("endDate").alias("filedDate"), F.col("endDate").alias("acceptedDate"),
            F.col("data").alias("report"),
        )

    companies = quarter.select(
        F.col("symbol").alias("cik"), "symbol",
        F.array(filing("10-K"), filing("10-K/A")).alias("data"),
    )
    return facts_.flatten_filings(companies).select(
        "symbol", "accessNumber", "form", "label", "concept", as_double("value").alias("value")
    )


_TWO_LEVEL = " UNION ALL ".join(
    f"""SELECT CAST(l_suppkey AS VARCHAR) AS symbol, CAST(l_orderkey AS VARCHAR) AS accessNumber,
        '{form}' AS form, l_returnflag AS label, '{column}' AS concept, {column} AS value
    FROM lineitem"""
    for form in ("10-K", "10-K/A")
    for column in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
)


def struct_star(spark: SparkSession, folder: str) -> DataFrame:
    companies = parquet_table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("cik"), F.col("l_returnflag").alias("entityName"),
        F.struct(F.struct(
            F.col("l_extendedprice").alias("Assets"), F.col("l_tax").alias("Liabilities"),
        ).alias("us-gaap")).alias("facts"),
    )
    return st.expand_concepts(companies)


def dedupe_annotate(spark: SparkSession, folder: str) -> DataFrame:
    numbered = facts_.annotate_duplicates(roles.facts(spark, folder, "l_quantity"))
    return numbered.withColumns({
        name: F.col(name).cast("string") for name in ("startDate", "endDate")
    })


def dedupe_keep_first(spark: SparkSession, folder: str) -> DataFrame:
    kept = facts_.keep_first(roles.facts(spark, folder, "l_quantity"))
    return kept.withColumns({
        name: F.col(name).cast("string") for name in ("startDate", "endDate")
    })


_BUFF = """buff AS (
        SELECT label, concept, symbol, unit, CAST(value AS DOUBLE) AS value, startDate, endDate,
               year, quarter,
               CAST(row_number() OVER (PARTITION BY value, symbol, year, quarter
                    ORDER BY label, concept, unit, startDate, endDate) AS BIGINT)
                   AS "DuplicateCount"
        FROM facts)"""
_NUMBERED = f"WITH {roles.REPEATED_FACTS}, {_BUFF}"
_KEPT = "SELECT * EXCLUDE (\"DuplicateCount\") FROM buff WHERE \"DuplicateCount\" = 1"


def _role_rows() -> str:
    tests = {
        role: " OR ".join(f"concept LIKE '{p}'" for p in patterns)
        for role, patterns in roles.CONCEPTS.items()
    }
    views = " UNION ALL ".join(
        f"""SELECT '{role}' AS role, label, concept, unit, value, symbol, year, quarter,
            CAST(row_number() OVER (PARTITION BY symbol, year, quarter
                 ORDER BY label, concept, unit, value) AS BIGINT) AS dup
        FROM facts WHERE {test}"""
        for role, test in tests.items()
    )
    return f"WITH {roles.FACTS}, views AS MATERIALIZED ({views})"


def concept_view(spark: SparkSession, folder: str) -> DataFrame:
    return facts_.concept_views(roles.facts(spark, folder), roles.CONCEPTS)


def pick_first(spark: SparkSession, folder: str) -> DataFrame:
    return facts_.pick_first(roles.facts(spark, folder), roles.CONCEPTS)


def ratios_left(spark: SparkSession, folder: str) -> DataFrame:
    return facts_.ratios_left(roles.facts(spark, folder), roles.CONCEPTS)


def _left_join(role: str) -> str:
    return (
        f"LEFT JOIN views {role} ON {role}.role = '{role}' AND {role}.dup = 1 "
        f"AND {role}.symbol = b.symbol AND {role}.year = b.year "
        f"AND {role}.quarter = b.quarter AND {role}.unit = b.unit"
    )


_RATIOS_LEFT = f"""{_role_rows()},
    wide AS (
        SELECT b.symbol, b.year, b.unit, b.quarter, CAST(b.value AS DOUBLE) AS total_assets,
            {", ".join(f"CAST({r}.value AS DOUBLE) AS {r}"
                       for r in roles.CONCEPTS if r != "total_assets")}
        FROM views b {" ".join(_left_join(r) for r in roles.CONCEPTS if r != "total_assets")}
        WHERE b.role = 'total_assets' AND b.dup = 1)
    SELECT symbol, year, unit, total_assets, quarter, total_equities,
        liabilities_and_equity - total_equities AS total_liabilities,
        (liabilities_and_equity - total_equities) / NULLIF(total_equities, 0)
            AS debt_equity_ratio,
        (liabilities_and_equity - total_equities) / NULLIF(total_assets, 0) AS debt_asset_ratio,
        retained_earnings, retained_earnings / NULLIF(total_assets, 0) AS return_on_assets,
        current_assets, current_liabilities,
        current_assets - current_liabilities AS working_capital,
        current_assets / NULLIF(current_liabilities, 0) AS current_ratio,
        net_inventories,
        (current_assets - net_inventories) / NULLIF(current_liabilities, 0) AS quick_ratio
    FROM wide"""


def ratios_inner(spark: SparkSession, folder: str) -> DataFrame:
    kept = facts_.keep_first(roles.facts(spark, folder))
    return facts_.ratios_inner(kept, roles.LABELS)


def _view(name: str, role: str) -> str:
    column, value = roles.LABELS[role]
    return f"{name} AS (SELECT * FROM kept WHERE {column} = '{value}')"


_RATIOS_INNER = f"""WITH {roles.FACTS}, {_BUFF}, kept AS ({_KEPT}),
    {_view("ca", "total_current_assets")}, {_view("cl", "total_current_liabilities")},
    {_view("ni", "net_inventories")}, {_view("ta", "total_assets")},
    {_view("tl", "total_liabilities")}
    SELECT ca.symbol, ca.year, ca.unit, ca.value AS total_current_assets, ca.quarter,
        cl.value AS total_current_liabilities, ca.value - cl.value AS working_capital,
        ca.value / NULLIF(cl.value, 0) AS current_ratio, ni.value AS net_inventories,
        (ca.value - ni.value) / NULLIF(cl.value, 0) AS quick_ratio,
        ta.value AS total_assets, tl.value AS total_liabilities,
        tl.value / NULLIF(ta.value, 0) AS debt_asset_ratio
    FROM ca {" ".join(
        f"JOIN {v} ON {v}.symbol = ca.symbol AND {v}.year = ca.year "
        f"AND {v}.quarter = ca.quarter AND {v}.unit = ca.unit" for v in ("cl", "ni", "ta", "tl"))}"""


def _sets(spark: SparkSession, folder: str):
    return roles.sub(spark, folder), roles.pre(spark, folder), roles.num(spark, folder)


def stmt_view(spark: SparkSession, folder: str) -> DataFrame:
    return st.statement_rows(*_sets(spark, folder), roles.STATEMENTS, roles.FORM)


def pick_nth(spark: SparkSession, folder: str) -> DataFrame:
    picked = st.pick_nth(*_sets(spark, folder), roles.STATEMENTS, roles.FORM, 2)
    return picked.withColumn("dup", F.col("dup").cast("long"))


def fin_stmts_silver(spark: SparkSession, folder: str) -> DataFrame:
    return st.statement_table(*_sets(spark, folder), roles.STATEMENTS, roles.FORM, 2)


def _second(role: str) -> str:
    stmt, tag = roles.STATEMENTS[role]
    how = "JOIN" if role == "total_liabilities" else "LEFT JOIN"
    return f"{how} picked {role} ON {role}.adsh = a.adsh AND {role}.tag = '{tag}' AND {role}.stmt = '{stmt}'"


_OTHERS = [role for role in roles.STATEMENTS if role != "total_assets"]
_TAGS = ", ".join(f"'{tag}'" for _, tag in roles.STATEMENTS.values())
_SILVER = f"""WITH {roles.SETS},
    picked AS (SELECT * FROM reported WHERE dup = 2)
    SELECT a.adsh, a.cik, a.name, a.ein, a.form, a.period, a.fy, a.fp, a.uom,
           a.value AS total_assets, {", ".join(f"{r}.value AS {r}" for r in _OTHERS)}
    FROM picked a {" ".join(_second(role) for role in _OTHERS)}
    WHERE a.stmt = 'BS' AND a.tag = 'A0'"""


def order_desc(spark: SparkSession, folder: str) -> DataFrame:
    return st.statement_lines(*_sets(spark, folder), "IS", "R0", roles.FORM)


def distinct_names(spark: SparkSession, folder: str) -> DataFrame:
    return st.distinct_sorted(fin_stmts_silver(spark, folder), "name")


QUERIES = {
    "scan_table": (scan, "SELECT * FROM customer"),
    "project_rename": (project_rename, """
        SELECT l_orderkey AS symbol_a, l_linenumber AS concept_a, l_returnflag AS label_a,
               l_extendedprice AS value_a FROM lineitem"""),
    "filter_eq": (filter_eq, """
        SELECT l_orderkey, l_partkey, l_returnflag, l_extendedprice
        FROM lineitem WHERE l_returnflag = 'R'"""),
    "filter_like": (filter_like, """
        SELECT p_partkey, p_name, p_type, p_retailprice FROM part
        WHERE p_name LIKE '%widget' AND p_type LIKE 'ECON%' ORDER BY p_retailprice, p_partkey"""),
    "filter_like_or": (filter_like_or, """
        SELECT p_partkey, p_name, p_type FROM part
        WHERE p_name LIKE '%ring' OR p_name LIKE 'red w_dget'"""),
    "safe_casts": (safe_casts, """
        SELECT o_orderkey, TRY_CAST(o_orderpriority AS DOUBLE) AS not_a_number,
               TRY_CAST(substring(o_orderpriority, 1, 1) AS DOUBLE) AS priority,
               CAST(TRY_CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS VARCHAR) AS day,
               CAST(TRY_CAST(o_orderstatus AS DATE) AS VARCHAR) AS not_a_day
        FROM orders"""),
    "count_rows": (count_rows, "SELECT count(*) AS n FROM lineitem"),
    "describe_schema": (describe_schema, " UNION ALL ".join(
        f"SELECT '{name}' AS col_name, '{kind}' AS data_type, count({name}) AS n_values "
        f"FROM lineitem" for name, kind in _TYPES.items())),
    "explode_nested": (explode_nested, _NESTED),
    "explode_two_level": (explode_two_level, _TWO_LEVEL),
    "struct_star": (struct_star, """
        SELECT l_orderkey AS cik, l_returnflag AS "entityName", l_extendedprice AS "Assets",
               l_tax AS "Liabilities" FROM lineitem"""),
    "dedupe_annotate": (dedupe_annotate, f"{_NUMBERED} SELECT * FROM buff"),
    "dedupe_keep_first": (dedupe_keep_first, f"{_NUMBERED} {_KEPT}"),
    "concept_view": (concept_view, f"{_role_rows()} SELECT * FROM views"),
    "pick_first": (pick_first, f"{_role_rows()} SELECT * EXCLUDE (dup) FROM views WHERE dup = 1"),
    "ratios_left": (ratios_left, _RATIOS_LEFT),
    "ratios_inner": (ratios_inner, _RATIOS_INNER),
    "stmt_view": (stmt_view, f"""WITH {roles.SETS}
        SELECT * FROM reported WHERE tag IN ({_TAGS})"""),
    "pick_nth": (pick_nth, f"""WITH {roles.SETS}
        SELECT * FROM reported WHERE tag IN ({_TAGS}) AND dup = 2"""),
    "fin_stmts_silver": (fin_stmts_silver, _SILVER),
    "order_desc": (order_desc, f"""WITH {roles.SETS}
        SELECT num.adsh, cik, name, ein, form, period, fy, fp, stmt, num.tag,
               num.version, ddate, uom, value
        FROM sub, num, pre
        WHERE sub.adsh = pre.adsh AND sub.adsh = num.adsh AND pre.tag = num.tag
          AND pre.version = num.version AND stmt = 'IS' AND form = 'F' AND num.tag = 'R0'
        ORDER BY num.tag DESC, num.adsh, ddate, uom, value"""),
    "distinct_names": (distinct_names, f"SELECT DISTINCT name FROM ({_SILVER}) ORDER BY name"),
}
