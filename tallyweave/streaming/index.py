"""A vector index kept in step with a stream of document versions.

The stream only appends the vectors of what arrived to a log, so a run costs
as much as its documents. A reader lays the log over the base table, and
`compact` folds it in on its own schedule.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.numbering import first_rows
from ..operators.retrieval import text_vectors
from ..operators.upkeep import current, replace_table


def follow_documents(
    stream: DataFrame, key: str, text: str, version: str, model: PipelineModel,
    log: str, checkpoint: str, every: str | None = None,
) -> StreamingQuery:
    """Append the vectors of arriving documents, once or every interval.

    A document whose text is NULL is to leave the index.
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}
    vectors = text_vectors(model, stream.select(key, text, version))
    return (
        vectors.writeStream.format("parquet").outputMode("append")
        .option("path", log).option("checkpointLocation", checkpoint)
        .trigger(**trigger).start()
    )


def index_now(base: DataFrame, log: DataFrame, key: str, text: str, version: str) -> DataFrame:
    """The newest version of every document; older log entries change nothing."""
    latest = first_rows(log, [key], [F.col(version).desc(), text], 1, "_n").drop("_n")
    held = base.select(key, F.col(version).alias("_held"))
    newer = latest.join(held, key, "left").filter(
        F.col("_held").isNull() | (F.col(version) > F.col("_held"))
    ).drop("_held")
    kept = base.join(newer.select(key), key, "left_anti")
    return kept.unionByName(newer.filter(F.col(text).isNotNull()).select(*base.columns))


def compact(
    spark: SparkSession, table: str, log: DataFrame, key: str, text: str, version: str
) -> None:
    """Fold the log into the base table. Running it again changes nothing."""
    replace_table(index_now(current(spark, table), log, key, text, version), table)
