"""Queries that read files: tables are written in each format and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import facts as facts_
from ..operators import statements as st
from ..session import scratch_path
from ..sources import files
from ..sources.tables import parquet_table
from . import roles


# Supplier keys are unique, so a file holds at most this many companies.
BLOCK = 1_000


def _write_blocks(documents: DataFrame, key: str, text, path: str) -> None:
    """One file per block of keys; `text` makes its content from `documents`."""
    blocks = documents.groupBy(F.floor(F.col(key) / BLOCK).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct(*documents.columns))).alias("d")
    )
    blocks.select(text(F.col("d"))).write.option("maxRecordsPerFile", 1).text(path)


def source_filings(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as companies in JSON files, with a filing and its amendment."""
    suppliers = parquet_table(spark, folder, "supplier")
    bs = F.array(F.struct(
        F.lit("Balance").alias("label"), F.lit("us-gaap_Assets").alias("concept"),
        F.lit("USD").alias("unit"), roles.text("s_acctbal").alias("value"),
    ))

    def filing(form: str):
        return F.struct(
            F.col("s_name").alias("accessNumber"), F.lit("2022").alias("year"),
            F.lit("1").alias("quarter"), F.lit(form).alias("form"),
            F.struct(bs.alias("bs")).alias("report"),
        )

    path = scratch_path(spark, "filings")
    companies = suppliers.select(
        F.col("s_suppkey").alias("cik"), F.col("s_name").alias("symbol"),
        F.array(filing("10-K"), filing("10-K/A")).alias("data"),
    )
    _write_blocks(companies, "cik", F.to_json, path)
    return facts_.flatten_filings(files.read_filings(spark, path)).select(
        "cik", "symbol", "accessNumber", "form", "concept", "value"
    )


def source_quarterly(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as quarterly files."""
    suppliers = parquet_table(spark, folder, "supplier")
    bs = F.array(*[
        F.struct(F.lit(label).alias("label"), F.lit("c").alias("concept"),
                 F.lit("USD").alias("unit"), roles.text(column).alias("value"))
        for label, column in (("Balance", "s_acctbal"), ("Nation", "s_nationkey"))
    ])
    path = scratch_path(spark, "quarterly")
    quarters = suppliers.select(
        "s_suppkey", F.lit("2022-01-01").alias("startDate"), F.lit("2022-03-31").alias("endDate"),
        F.lit("2022").alias("year"), F.lit("1").alias("quarter"),
        F.col("s_name").alias("symbol"), F.struct(bs.alias("bs")).alias("data"),
    )
    _write_blocks(quarters, "s_suppkey", F.to_json, path)
    return facts_.flatten_quarterly(files.read_quarterly(spark, path))


def _company_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as companies with one reported fact per concept."""
    fact = F.struct(
        roles.text("o_orderkey").alias("accn"), roles.day("o_orderdate").alias("end"),
        F.lit("not a date").alias("filed"), F.col("o_orderstatus").alias("form"),
        F.lit("FY").alias("fp"), F.lit("CY").alias("frame"),
        F.year("o_orderdate").cast("long").alias("fy"), F.col("o_totalprice").alias("val"),
    )
    units = F.struct(F.array(fact).alias("USD")).alias("units")
    return parquet_table(spark, folder, "orders").select(
        F.col("o_custkey").alias("cik"), F.col("o_orderpriority").alias("entityName"),
        F.struct(F.struct(
            F.struct(units).alias("Assets"), F.struct(units).alias("Liabilities"),
        ).alias("us-gaap")).alias("facts"),
    )


def source_company_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Facts read under the schema of a sample file, assets as a long table."""
    companies = _company_facts(spark, folder)
    sample, path = scratch_path(spark, "sample"), scratch_path(spark, "companies")
    companies.limit(1).write.json(sample)
    companies.write.json(path)
    schema = files.learn_schema(spark, sample)
    wide = st.expand_concepts(files.read_company_facts(spark, path, schema))
    return st.concept_facts(wide, "Assets").withColumns({
        name: F.col(name).cast("string") for name in ("end", "filed")
    })


def source_statement_set(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers as tab-separated text, one folder per status, read under a schema."""
    root = scratch_path(spark, "statements")
    numbers = roles.num(spark, folder)
    numbers.withColumns({"period": F.col("version"), "file": F.lit("num.txt")}).write.partitionBy(
        "period", "file").option("sep", "\t").option("header", True).csv(root)
    schema = "adsh LONG, tag STRING, version STRING, ddate STRING, uom LONG, value DOUBLE"
    return files.read_statement_set(spark, root, "file=num", schema)


def source_piped(spark: SparkSession, folder: str) -> DataFrame:
    """Page addresses as pipe-separated text under a given schema."""
    path = scratch_path(spark, "crawl")
    parquet_table(spark, folder, "pages").select("page_id", "url").write.option(
        "sep", "|").option("header", True).csv(path)
    return files.read_piped(spark, f"{path}/*.csv", "page_id LONG, url STRING")


def source_listing(spark: SparkSession, folder: str) -> DataFrame:
    """Supplier names in text files, listed by size and read whole."""
    path = scratch_path(spark, "texts")
    suppliers = parquet_table(spark, folder, "supplier").select("s_suppkey", "s_name")
    _write_blocks(
        suppliers, "s_suppkey",
        lambda d: F.array_join(F.transform(d, lambda s: s["s_name"]), "\n"), path,
    )
    listed = files.list_files(spark, path, "*.txt").select("path", "length")
    read = files.read_files(spark, path, "*.txt").select("path", "content")
    return listed.join(read, "path").select(
        (F.col("length") == F.octet_length("content")).alias("whole"),
        F.explode(F.split(F.trim(F.decode("content", "UTF-8")), "\n")).alias("text"),
    ).filter("text <> ''")


QUERIES = {
    "source_filings": (source_filings, " UNION ALL ".join(
        f"""SELECT CAST(s_suppkey AS VARCHAR) AS cik, s_name AS symbol, s_name AS "accessNumber",
            '{form}' AS form, 'us-gaap_Assets' AS concept, CAST(s_acctbal AS VARCHAR) AS value
        FROM supplier""" for form in ("10-K", "10-K/A"))),
    "source_quarterly": (source_quarterly, " UNION ALL ".join(
        f"""SELECT '2022-01-01' AS "startDate", '2022-03-31' AS "endDate", s_name AS symbol,
            '2022' AS year, '1' AS quarter, '{label}' AS label, 'c' AS concept, 'USD' AS unit,
            CAST({column} AS VARCHAR) AS value
        FROM supplier""" for label, column in (("Balance", "s_acctbal"), ("Nation", "s_nationkey")))),
    "source_company_facts": (source_company_facts, """
        SELECT o_custkey AS cik, o_orderpriority AS "entityName",
               CAST(o_orderkey AS VARCHAR) AS accn, strftime(o_orderdate, '%Y-%m-%d') AS end,
               CAST(NULL AS VARCHAR) AS filed, o_orderstatus AS form, 'FY' AS fp, 'CY' AS frame,
               CAST(year(o_orderdate) AS BIGINT) AS fy, o_totalprice AS val FROM orders"""),
    "source_statement_set": (source_statement_set, """
        SELECT l_suppkey AS adsh, l_returnflag || l_linenumber % 4 AS tag,
               l_linestatus AS version,
               strftime(l_shipdate, '%Y-%m-%d') AS ddate, CAST(l_linenumber AS BIGINT) AS uom,
               l_extendedprice AS value FROM lineitem"""),
    "source_piped": (source_piped, "SELECT page_id, url FROM pages"),
    "source_listing": (source_listing, "SELECT true AS whole, s_name AS text FROM supplier"),
}
