"""File readers. Schemas are given, or learnt from a small sample file."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType(), True) for name in names]


# The fields of the files, by name.
FACT = T.StructType(_strings("label", "concept", "unit", "value"))

_REPORT = T.StructType([T.StructField("bs", T.ArrayType(FACT))])

FILING = T.StructType(
    _strings(
        "accessNumber", "cik", "year", "quarter", "form",
        "startDate", "endDate", "filedDate", "acceptedDate",
    )
    + [T.StructField("report", _REPORT)]
)

COMPANY_FILINGS = T.StructType(
    _strings("cik", "symbol") + [T.StructField("data", T.ArrayType(FILING))]
)

QUARTERLY = T.StructType(
    _strings("startDate", "endDate", "year", "quarter", "symbol")
    + [T.StructField("data", _REPORT)]
)

CANDLES = T.StructType(_strings("c", "h", "l", "o", "t", "v", "symbol", "file"))


def read_filings(spark: SparkSession, path: str) -> DataFrame:
    """One JSON document per company, with all its filings."""
    return spark.read.schema(COMPANY_FILINGS).option("multiLine", True).json(path)


def read_quarterly(spark: SparkSession, path: str) -> DataFrame:
    """One JSON document per company and quarter."""
    return spark.read.schema(QUARTERLY).option("multiLine", True).json(path)


def learn_schema(spark: SparkSession, sample_path: str) -> str:
    """Schema of one multi-line JSON sample file, as text to keep."""
    return spark.read.option("multiLine", True).json(sample_path).schema.json()


def read_company_facts(spark: SparkSession, path: str, schema_text: str) -> DataFrame:
    """Facts, one JSON object per line, under a schema learnt before."""
    schema = T.StructType.fromJson(json.loads(schema_text))
    return spark.read.schema(schema).json(path)


def read_statement_set(
    spark: SparkSession, folder: str, table: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """One table of every period folder: tab-separated text with a header.

    Without a schema the types are inferred, at the price of one more pass.
    """
    reader = spark.read.option("sep", "\t").option("header", True)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(f"{folder}/*/{table}.txt")


def read_piped(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """Pipe-separated text with a header; `path` may be a glob."""
    reader = spark.read.option("sep", "|").option("header", True)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def list_files(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """Path and size of the matching files; their bytes are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .load(folder)
        .select("path", "length", "modificationTime")
    )


def read_files(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """Path and bytes of the matching files."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    ).select("path", "length", "content")
