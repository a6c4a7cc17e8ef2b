"""Stock candles: files to a bronze table, bronze to one row per candle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.arrays import json_array, zip_shortest
from ..sources.files import CANDLES


def candle_stream(spark: SparkSession, folder: str, schema: T.StructType = CANDLES) -> DataFrame:
    """Arriving JSON files as a stream of text columns."""
    return spark.readStream.schema(schema).json(folder)


def append_to_table(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what has arrived since the last run, then stop.

    Progress is kept in `checkpoint`, so files are read once even when a run
    is cut short. A wider schema takes a new run with the same checkpoint;
    files written before read back with NULL in the new columns.
    """
    return (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def bronze(spark: SparkSession, path: str, schema: T.StructType = CANDLES) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def silver(messages: DataFrame) -> DataFrame:
    """One row per candle, in batch or stream.

    The arrays of a message are zipped by position and cut to the shortest;
    a message with a missing or malformed array gives no candle.
    """
    # The column names of the candle table.
    rows = zip_shortest(
        Close_Prices=json_array("c", "double"),
        High_Prices=json_array("h", "double"),
        Low_Prices=json_array("l", "double"),
        Open_Prices=json_array("o", "double"),
        Timestamp=json_array("t", "string"),
        Volume=json_array("v", "bigint"),
        Stock=json_array("symbol", "string"),
        File=json_array("file", "string"),
    )
    return messages.select(F.inline(rows))


# The tables of the candle flow by name, each a function of its input.
TABLES = {"stocks_bronze": candle_stream, "stocks_silver": silver}
