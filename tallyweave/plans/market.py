"""Queries over candles, in batch and as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arrays import json_array
from ..session import scratch_path
from ..sources.tables import parquet_table
from ..streaming import candles as cs
from . import roles


def json_array_explode(spark: SparkSession, folder: str) -> DataFrame:
    texts = parquet_table(spark, folder, "embeddings").select(
        "vec_id", F.to_json(F.col("embedding").cast("array<double>")).alias("c")
    )
    return texts.select("vec_id", F.explode(json_array("c", "double")).alias("value"))


def candles_silver(spark: SparkSession, folder: str) -> DataFrame:
    return cs.silver(roles.candles(spark, folder))


def stream_bronze(spark: SparkSession, folder: str) -> DataFrame:
    """Candle files streamed to a bronze table, and its candles."""
    arriving, table, progress = (
        scratch_path(spark, name) for name in ("arriving", "bronze", "progress")
    )
    roles.candles(spark, folder).write.json(arriving)
    run = cs.append_to_table(cs.candle_stream(spark, arriving), table, progress)
    run.awaitTermination()
    return cs.silver(cs.bronze(spark, table))


def table_flow(spark: SparkSession, folder: str) -> DataFrame:
    """The tables of the candle flow, made by their names."""
    arriving, table, progress = (
        scratch_path(spark, name) for name in ("flow", "stocks-bronze", "flow-progress")
    )
    roles.candles(spark, folder).write.json(arriving)
    stream = cs.TABLES["stocks_bronze"](spark, arriving)
    cs.append_to_table(stream, table, progress).awaitTermination()
    return cs.TABLES["stocks_silver"](cs.bronze(spark, table)).groupBy("Stock").agg(
        F.count("*").alias("n_candles"), F.max("High_Prices").alias("highest")
    )


QUERIES = {
    "json_array_explode": (json_array_explode, """
        SELECT vec_id, unnest(CAST(embedding AS DOUBLE[])) AS value FROM embeddings"""),
    "candles_silver": (candles_silver, roles.CANDLE_ROWS),
    "stream_bronze": (stream_bronze, roles.CANDLE_ROWS),
    "table_flow": (table_flow, """
        SELECT 'U' || user_id AS Stock, count(*) AS n_candles, max(value + 2.0) AS highest
        FROM events GROUP BY user_id"""),
}
