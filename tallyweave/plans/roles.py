"""The benchmark tables in the roles of filings, statements and candles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import parquet_table


def text(column: str):
    return F.col(column).cast("string")


def day(column: str):
    return F.col(column).cast("date").cast("string")


def facts(spark: SparkSession, folder: str, value: str = "l_extendedprice") -> DataFrame:
    """Line items as balance-sheet facts."""
    return parquet_table(spark, folder, "lineitem").select(
        text("l_suppkey").alias("symbol"),
        F.year("l_shipdate").cast("string").alias("year"),
        F.quarter("l_shipdate").cast("string").alias("quarter"),
        F.col("l_returnflag").alias("label"),
        F.concat(F.lit("us-gaap_LN"), text("l_linenumber")).alias("concept"),
        F.col("l_linestatus").alias("unit"),
        text(value).alias("value"),
        day("l_shipdate").alias("startDate"),
        F.date_add("l_shipdate", 30).cast("string").alias("endDate"),
    )


FACTS = """facts AS (
    SELECT CAST(l_suppkey AS VARCHAR) AS symbol,
           CAST(year(l_shipdate) AS VARCHAR) AS year,
           CAST(quarter(l_shipdate) AS VARCHAR) AS quarter,
           l_returnflag AS label, 'us-gaap_LN' || l_linenumber AS concept,
           l_linestatus AS unit, CAST(l_extendedprice AS VARCHAR) AS value,
           strftime(l_shipdate, '%Y-%m-%d') AS startDate,
           strftime(l_shipdate + INTERVAL 30 DAY, '%Y-%m-%d') AS endDate
    FROM lineitem)"""

# The same with quantities for values, which repeat inside a period.
REPEATED_FACTS = FACTS.replace("l_extendedprice", "l_quantity")

CONCEPTS = {
    "total_assets": ["%us-gaap_LN1"],
    "liabilities_and_equity": ["%LN2"],
    "total_equities": ["LN3", "us-gaap_LN3"],
    "retained_earnings": ["%LN4"],
    "current_assets": ["us-gaap_LN5"],
    "current_liabilities": ["us-gaap_LN6"],
    "net_inventories": ["us-gaap_LN7", "LN7"],
}

LABELS = {
    "total_current_assets": ("concept", "us-gaap_LN5"),
    "total_current_liabilities": ("concept", "us-gaap_LN6"),
    "net_inventories": ("concept", "us-gaap_LN7"),
    "total_assets": ("concept", "us-gaap_LN1"),
    "total_liabilities": ("concept", "us-gaap_LN2"),
}


def sub(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers with their nation as submissions."""
    suppliers = parquet_table(spark, folder, "supplier")
    nations = parquet_table(spark, folder, "nation")
    form = F.when(F.col("s_suppkey") % 4 == 3, "O").otherwise("F")
    return suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("adsh"), (F.col("s_suppkey") * 10).alias("cik"),
        F.col("s_name").alias("name"), F.col("n_name").alias("ein"), form.alias("form"),
        F.lit("2022-12-31").alias("period"), F.lit(2022).cast("long").alias("fy"),
        F.lit("FY").alias("fp"),
    )


def _tag():
    return F.concat("l_returnflag", (F.col("l_linenumber") % 4).cast("string"))


def num(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as reported numbers."""
    return parquet_table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("adsh"), _tag().alias("tag"),
        F.col("l_linestatus").alias("version"), day("l_shipdate").alias("ddate"),
        text("l_linenumber").alias("uom"), F.col("l_extendedprice").alias("value"),
    )


def pre(spark: SparkSession, folder: str) -> DataFrame:
    """The distinct number keys as statement lines."""
    keys = parquet_table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("adsh"), _tag().alias("tag"), F.col("l_linestatus").alias("version"),
    )
    income = F.col("tag").startswith("R") | F.col("tag").isin("N2", "N3")
    return keys.distinct().withColumn("stmt", F.when(income, "IS").otherwise("BS"))


# The eleven statement roles; no role takes the lines tagged N3.
STATEMENTS = {
    "total_assets": ("BS", "A0"),
    "total_liabilities": ("BS", "N0"),
    "inventories": ("BS", "A1"),
    "current_assets": ("BS", "A2"),
    "current_liabilities": ("BS", "N1"),
    "total_equities": ("BS", "A3"),
    "cogs": ("IS", "R0"),
    "gross_profit": ("IS", "R1"),
    "operating_expenses": ("IS", "R2"),
    "profit_loss": ("IS", "R3"),
    "revenues": ("IS", "N2"),
}
FORM = "F"

_KEYS = "l_suppkey AS adsh, l_returnflag || l_linenumber % 4 AS tag, l_linestatus AS version"

SETS = f"""sub AS (
    SELECT s_suppkey AS adsh, s_suppkey * 10 AS cik, s_name AS name, n_name AS ein,
           CASE WHEN s_suppkey % 4 = 3 THEN 'O' ELSE 'F' END AS form, '2022-12-31' AS period,
           CAST(2022 AS BIGINT) AS fy, 'FY' AS fp
    FROM supplier JOIN nation ON s_nationkey = n_nationkey),
num AS (
    SELECT {_KEYS}, strftime(l_shipdate, '%Y-%m-%d') AS ddate,
           CAST(l_linenumber AS VARCHAR) AS uom, l_extendedprice AS value
    FROM lineitem),
pre AS (
    SELECT *, CASE WHEN tag LIKE 'R%' OR tag IN ('N2', 'N3') THEN 'IS' ELSE 'BS' END AS stmt
    FROM (SELECT DISTINCT {_KEYS} FROM lineitem)),
reported AS (
    SELECT num.adsh, cik, name, ein, form, period, fy, fp, stmt, num.tag, ddate, uom, value,
           CAST(row_number() OVER (PARTITION BY num.adsh, stmt, num.tag
                                   ORDER BY ddate, uom, value) AS BIGINT) AS dup
    FROM sub, pre, num
    WHERE sub.adsh = pre.adsh AND sub.adsh = num.adsh
      AND pre.tag = num.tag AND pre.version = num.version AND form = 'F')"""

BLOCK_EVENTS = 512


def candles(spark: SparkSession, folder: str) -> DataFrame:
    """Events as candle messages: parallel JSON arrays per user.

    Event ids are unique, so a message holds at most BLOCK_EVENTS events.
    """
    events = parquet_table(spark, folder, "events")
    one = F.struct(
        "event_id", "ts", "value", "event_type", "user_id",
    )
    messages = (
        events.groupBy("user_id", F.floor(F.col("event_id") / BLOCK_EVENTS).alias("block"))
        .agg(F.array_sort(F.collect_list(one)).alias("e"))
    )

    def array(of):
        return F.to_json(F.transform("e", of))

    return messages.select(
        array(lambda e: e["value"]).alias("c"),
        array(lambda e: e["value"] + 2.0).alias("h"),
        array(lambda e: e["value"] - 2.0).alias("l"),
        array(lambda e: e["value"] + 1.0).alias("o"),
        array(lambda e: F.date_format(e["ts"], "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("t"),
        array(lambda e: e["event_id"]).alias("v"),
        array(lambda e: F.concat(F.lit("U"), e["user_id"].cast("string"))).alias("symbol"),
        array(lambda e: F.concat(e["event_type"], F.lit(".json"))).alias("file"),
    )


CANDLE_ROWS = """
    SELECT value AS Close_Prices, value + 2.0 AS High_Prices, value - 2.0 AS Low_Prices,
           value + 1.0 AS Open_Prices, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS Timestamp,
           event_id AS Volume, 'U' || user_id AS Stock, event_type || '.json' AS File
    FROM events"""
