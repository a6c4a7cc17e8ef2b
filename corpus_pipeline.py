"""The corpus pipeline: documents through five stages, each written and read again.

Toxic documents go, then all but one of equal texts, then all but one of nearly
equal ones; of the rest a mixture by language and source is taken, and its
texts are encoded and decoded. Every stage works on all rows the one before
kept; all but the last return the columns of `documents`.

The share of tokens and the weights of the mixture are parameters below. One
pass is mixed, so no document comes twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.llm.bpe import bpe_digests
from tallyweave.llm.common import stored
from tallyweave.llm.exact import exact_dedup
from tallyweave.llm.mixing import mixed
from tallyweave.llm.queries import DOMAIN, MIX_SEED, MIX_WEIGHTS, WORDS, vocabulary
from tallyweave.llm.simhash import simhash_dedup
from tallyweave.llm.toxicity import fit, without_toxic
from tallyweave.session import ship_package

MIX_SHARE = (9, 10)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model of `labels` does not call toxic."""
    ship_package(spark)
    return without_toxic(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of equal texts."""
    return exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked fingerprints."""
    ship_package(spark)
    return simhash_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that a mixture of MIX_SHARE of all tokens takes."""
    return mixed(docs, F.expr(DOMAIN), MIX_SHARE, seed=MIX_SEED, weights=MIX_WEIGHTS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and decoded texts."""
    ship_package(spark)
    return bpe_digests(docs, vocabulary(WORDS))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]
ORACLE_SQL = None  # no stage but the second can be said in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES):
            docs = stored(docs, "pipeline-stage")
    return docs
