"""Queries over table maintenance: merges, deletes, change feeds, copies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import upkeep as up
from ..sources.tables import parquet_table

# Orders fall into three states: finished ones are only in the old table, open
# ones only in the new one, and those in progress are in both.
_ORDER = ["o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice"]


def _old_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = parquet_table(spark, folder, "orders").select(*_ORDER)
    return orders.filter(F.col("o_orderstatus").isin("F", "P"))


def _new_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Urgent orders have a new price."""
    orders = parquet_table(spark, folder, "orders").select(*_ORDER)
    urgent = F.col("o_orderpriority") == "1-URGENT"
    price = F.when(urgent, F.col("o_totalprice") + 1000.0).otherwise(F.col("o_totalprice"))
    return orders.filter(F.col("o_orderstatus").isin("O", "P")).withColumn("o_totalprice", price)


_ORDERS = """old AS (
    SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice
    FROM orders WHERE o_orderstatus IN ('F', 'P')),
new AS (
    SELECT o_orderkey, o_orderstatus, o_orderpriority,
           CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1000.0
                ELSE o_totalprice END AS o_totalprice
    FROM orders WHERE o_orderstatus IN ('O', 'P'))"""


def merge_upsert(spark: SparkSession, folder: str) -> DataFrame:
    return up.merge_upsert(
        _old_orders(spark, folder), _new_orders(spark, folder), ["o_orderkey"]
    )


def merge_insert_only(spark: SparkSession, folder: str) -> DataFrame:
    return up.merge_insert_only(
        _old_orders(spark, folder), _new_orders(spark, folder), ["o_orderkey"]
    )


def _contents(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Documents before and after: German ones come, English ones stay behind,
    French ones are revised."""
    documents = parquet_table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), "lang", F.col("text").alias("content")
    )
    revised = F.when(F.col("lang") == "fr", F.concat("content", F.lit(" (revised)")))
    return (
        documents.filter("lang <> 'de'"),
        documents.filter("lang <> 'en'").withColumn("content", F.coalesce(revised, "content")),
    )


def merge_when_changed(spark: SparkSession, folder: str) -> DataFrame:
    target, source = _contents(spark, folder)
    merged = up.merge_when_changed(target, source, ["id"], "content")
    return merged.select("id", "lang", F.md5("content").alias("content_md5"))


def delete_where(spark: SparkSession, folder: str) -> DataFrame:
    orders = parquet_table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return up.delete_where(orders.withColumn("status", status), F.col("status") == "F")


def drop_column(spark: SparkSession, folder: str) -> DataFrame:
    return up.drop_columns(
        parquet_table(spark, folder, "orders"), "o_orderdate", "o_totalprice", "no_such_column"
    )


def _people(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Customers, and suppliers with another last column."""
    old = parquet_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
    )
    new = parquet_table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("balance"),
    )
    return old, new


def schema_merge_union(spark: SparkSession, folder: str) -> DataFrame:
    return up.union_with_new_columns(*_people(spark, folder))


def snapshot_copy(spark: SparkSession, folder: str) -> DataFrame:
    return up.snapshot(parquet_table(spark, folder, "orders").select(*_ORDER))


def change_feed(spark: SparkSession, folder: str) -> DataFrame:
    return up.change_feed(
        _old_orders(spark, folder), _new_orders(spark, folder), ["o_orderkey"]
    )


QUERIES = {
    "merge_upsert": (merge_upsert, f"""WITH {_ORDERS}
        SELECT coalesce(n.o_orderkey, o.o_orderkey) AS o_orderkey,
               CASE WHEN n.o_orderkey IS NULL THEN o.o_orderstatus ELSE n.o_orderstatus END
                   AS o_orderstatus,
               CASE WHEN n.o_orderkey IS NULL THEN o.o_orderpriority ELSE n.o_orderpriority END
                   AS o_orderpriority,
               CASE WHEN n.o_orderkey IS NULL THEN o.o_totalprice ELSE n.o_totalprice END
                   AS o_totalprice
        FROM old o FULL JOIN new n ON o.o_orderkey = n.o_orderkey"""),
    "merge_insert_only": (merge_insert_only, f"""WITH {_ORDERS}
        SELECT * FROM old UNION ALL
        SELECT * FROM new WHERE o_orderkey NOT IN (SELECT o_orderkey FROM old)"""),
    "merge_when_changed": (merge_when_changed, """WITH
        t AS (SELECT doc_id AS id, lang, text AS content FROM documents WHERE lang <> 'de'),
        s AS (SELECT doc_id AS id, lang,
                     CASE WHEN lang = 'fr' THEN text || ' (revised)' ELSE text END AS content
              FROM documents WHERE lang <> 'en')
        SELECT coalesce(t.id, s.id) AS id, coalesce(t.lang, s.lang) AS lang,
               md5(CASE WHEN s.id IS NULL THEN t.content ELSE s.content END) AS content_md5
        FROM t FULL JOIN s ON t.id = s.id"""),
    "delete_where": (delete_where, """
        SELECT o_orderkey, o_orderstatus, NULLIF(o_orderstatus, 'P') AS status
        FROM orders WHERE (NULLIF(o_orderstatus, 'P') = 'F') IS NOT TRUE"""),
    "drop_column": (drop_column,
                    "SELECT * EXCLUDE (o_orderdate, o_totalprice) FROM orders"),
    "schema_merge_union": (schema_merge_union, """
        SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment,
               CAST(NULL AS DOUBLE) AS balance FROM customer
        UNION ALL
        SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier"""),
    "snapshot_copy": (snapshot_copy, """
        SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice FROM orders"""),
    "change_feed": (change_feed, f"""WITH {_ORDERS}
        SELECT 'insert' AS change, * FROM new
        WHERE o_orderkey NOT IN (SELECT o_orderkey FROM old)
        UNION ALL
        SELECT 'delete', * FROM old WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new)
        UNION ALL
        SELECT 'update', n.* FROM new n JOIN old o ON n.o_orderkey = o.o_orderkey
        WHERE n.o_totalprice <> o.o_totalprice"""),
}
