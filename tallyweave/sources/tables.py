"""Tables by name: Parquet folders and catalog entries."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def parquet_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table or view, as a DataFrame."""
    return spark.read.table(name)


def cached(df: DataFrame) -> DataFrame:
    """`df` kept by the executors for several uses; what does not fit goes to disk.

    Lost parts are worked out again, so nothing may depend on a row's position.
    """
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def use_namespace(spark: SparkSession, name: str) -> None:
    """Make `name` the current schema, creating it on first use."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
    spark.catalog.setCurrentDatabase(name)


def describe(spark: SparkSession, name: str) -> DataFrame:
    """Column names and types of a table."""
    return spark.sql(f"DESCRIBE TABLE `{name}`").select("col_name", "data_type")
