"""Queries that write catalog tables, change them and read them back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import upkeep as up
from ..sources import tables as tb
from ..sources.tables import parquet_table
from . import upkeep as cases
from .documents import QUERIES as DOCUMENT_QUERIES

DATABASE = "tallyweave"


def _fresh(spark: SparkSession, purpose: str) -> str:
    """The name of a table that no run has used."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {DATABASE}")
    return f"{DATABASE}.{purpose}_{uuid.uuid4().hex}"


def table_save(spark: SparkSession, folder: str) -> DataFrame:
    """All orders saved as a table in one piece."""
    name = _fresh(spark, "saved")
    up.create_table(parquet_table(spark, folder, "orders"), name)
    return tb.scan_table(spark, name)


def table_save_all(spark: SparkSession, folder: str) -> DataFrame:
    """All orders saved as a table in partitions."""
    name = _fresh(spark, "saved_all")
    up.create_table(parquet_table(spark, folder, "orders"), name, ["o_orderstatus"])
    return tb.scan_table(spark, name)


def table_replace(spark: SparkSession, folder: str) -> DataFrame:
    """A table replaced by its own content and what has come in."""
    name = _fresh(spark, "replaced")
    up.create_table(cases._old_orders(spark, folder), name, ["o_orderstatus"])
    new = cases._new_orders(spark, folder)
    up.replace_table(up.merge_upsert(tb.scan_table(spark, name), new, ["o_orderkey"]), name)
    up.drop_superseded(spark, name)
    return up.current(spark, name)


def _by_year(orders: DataFrame) -> DataFrame:
    return orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("o_year"))


def merge_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """Finished orders by year; those since 1999 that are urgent or open are laid over them."""
    orders = parquet_table(spark, folder, "orders")
    name = _fresh(spark, "by_year")
    up.create_table(_by_year(orders.filter("o_orderstatus <> 'O'")), name, ["o_year"])
    urgent = F.col("o_orderpriority") == "1-URGENT"
    late = orders.filter((F.year("o_orderdate") >= 1999) & (urgent | (F.col("o_orderstatus") == "O")))
    price = F.when(urgent, F.col("o_totalprice") + 1000.0).otherwise(F.col("o_totalprice"))
    up.upsert_partitions(_by_year(late.withColumn("o_totalprice", price)), name, ["o_year", "o_orderkey"])
    return up.current(spark, name)


def table_widen(spark: SparkSession, folder: str) -> DataFrame:
    """A table replaced by one with a column more."""
    name = _fresh(spark, "widened")
    old, new = cases._people(spark, folder)
    up.create_table(old, name)
    up.replace_table(up.union_with_new_columns(tb.scan_table(spark, name), new), name)
    return up.current(spark, name)


def table_as_query(spark: SparkSession, folder: str) -> DataFrame:
    name = _fresh(spark, "derived")
    up.create_table_as(spark, name, f"""
        SELECT o_custkey, count(*) AS n_orders, max(o_orderkey) AS last_order
        FROM parquet.`{folder}/orders.parquet` GROUP BY o_custkey""")
    return tb.scan_table(spark, name)


def table_if_absent(spark: SparkSession, folder: str) -> DataFrame:
    """A typed table made once, filled after, left alone by a second attempt."""
    name = _fresh(spark, "typed")
    up.create_table_if_absent(spark, name, "n_nationkey BIGINT, n_name STRING")
    nations = parquet_table(spark, folder, "nation")
    up.replace_table(nations.select(F.col("n_nationkey").cast("long"), "n_name"), name)
    up.create_table_if_absent(spark, name, "other INT")
    return up.current(spark, name)


def table_in_namespace(spark: SparkSession, folder: str) -> DataFrame:
    """A table written and read by its short name in a schema of its own."""
    before = spark.catalog.currentDatabase()
    tb.use_namespace(spark, f"{DATABASE}_books")
    name = f"regions_{uuid.uuid4().hex}"
    up.create_table(parquet_table(spark, folder, "region"), name)
    read = tb.scan_table(spark, name)
    spark.catalog.setCurrentDatabase(before)
    return read


def view_kept(spark: SparkSession, folder: str) -> DataFrame:
    """A view of a table that shows what the table holds now."""
    name = _fresh(spark, "viewed")
    up.create_table(cases._old_orders(spark, folder), name)
    up.create_view(spark, f"{name}_view", f"""
        SELECT o_orderstatus, count(*) AS n_orders FROM {name} GROUP BY o_orderstatus""")
    up.replace_table(cases._new_orders(spark, folder), name)
    return tb.scan_table(spark, f"{name}_view")


def cache_reuse(spark: SparkSession, folder: str) -> DataFrame:
    """Two counts over one scan that is kept in between."""
    lines = tb.cached(parquet_table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus"))
    by = [lines.groupBy(F.col(name).alias("value")).agg(F.count("*").alias("n"))
          for name in lines.columns]
    return by[0].unionByName(by[1])


def sql_functions(spark: SparkSession, folder: str) -> DataFrame:
    """Text functions called by name from SQL."""
    tx.register(spark)
    return spark.sql(f"""
        SELECT page_id, file_name(url) AS file_name, array_join(years_in(url), ',') AS years
        FROM parquet.`{folder}/pages.parquet`""")


def header_titles(spark: SparkSession, folder: str) -> DataFrame:
    """What follows the last header cell of a page, its headings taken for header cells."""
    cells = F.regexp_replace("html", "(</?)h1>", "$1th>")
    return parquet_table(spark, folder, "pages").select(
        "page_id", F.md5(tx.table_title(cells)).alias("title_md5")
    )


QUERIES = {
    "table_save": (table_save, "SELECT * FROM orders"),
    "table_save_all": (table_save_all, "SELECT * EXCLUDE (o_orderstatus), o_orderstatus FROM orders"),
    "table_replace": (table_replace, cases.QUERIES["merge_upsert"][1]),
    "merge_partitions": (merge_partitions, """
        SELECT o_orderkey, CASE WHEN year(o_orderdate) >= 1999 AND o_orderpriority = '1-URGENT'
                                THEN o_totalprice + 1000.0 ELSE o_totalprice END AS o_totalprice,
               CAST(year(o_orderdate) AS INTEGER) AS o_year
        FROM orders WHERE o_orderstatus <> 'O' OR year(o_orderdate) >= 1999"""),
    "table_widen": (table_widen, cases.QUERIES["schema_merge_union"][1]),
    "table_as_query": (table_as_query, """
        SELECT o_custkey, count(*) AS n_orders, max(o_orderkey) AS last_order
        FROM orders GROUP BY o_custkey"""),
    "table_if_absent": (table_if_absent,
                        "SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name FROM nation"),
    "table_in_namespace": (table_in_namespace, "SELECT * FROM region"),
    "view_kept": (view_kept, f"""WITH {cases._ORDERS}
        SELECT o_orderstatus, count(*) AS n_orders FROM new GROUP BY o_orderstatus"""),
    "cache_reuse": (cache_reuse, """
        SELECT l_returnflag AS value, count(*) AS n FROM lineitem GROUP BY ALL
        UNION ALL SELECT l_linestatus, count(*) FROM lineitem GROUP BY ALL"""),
    "sql_functions": (sql_functions, DOCUMENT_QUERIES["url_file_year"][1]),
    "header_titles": (header_titles, """
        SELECT page_id, md5(list_extract(regexp_split_to_array(
                   regexp_replace(html, '(</?)h1>', '\\1th>', 'g'), '<th[^\n]*?>([^\n]+?)</th>'),
               -1)) AS title_md5
        FROM pages"""),
}
