"""Session settings and the shared folder for intermediate data that is kept."""

from __future__ import annotations

import io
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Runtime re-planning does the join choice, partition coalescing and the
# splitting of skewed join partitions; `force` keeps the split even when it
# costs one more exchange below a window or an aggregate.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "tallyweave", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SCALE_CONF, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_SCRATCH: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """The shared folder: that of `spark.checkpoint.dir`, else one in the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the shared folder, never used before."""
    path = f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Functions that run there are found by name, so the executors need the
    package; it goes to the shared folder as a zip file and from there to them.
    """
    context, root = spark.sparkContext, Path(__file__).parent
    if context.applicationId in _SHIPPED or not root.is_dir():
        return
    content = io.BytesIO()
    with zipfile.ZipFile(content, "w", zipfile.ZIP_DEFLATED) as package:
        for file in sorted(root.rglob("*.py")):
            package.write(file, file.relative_to(root.parent))
    gateway = context._jvm
    place = gateway.org.apache.hadoop.fs.Path(f"{shared_root(spark)}/{uuid.uuid4().hex}/{root.name}.zip")
    files = place.getFileSystem(context._jsc.hadoopConfiguration())
    stream = files.create(place)
    stream.write(bytearray(content.getvalue()))
    stream.close()
    context.addPyFile(files.makeQualified(place).toString())
    _SHIPPED.add(context.applicationId)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of this session, wherever Spark's file systems keep it."""
    gateway = spark.sparkContext._jvm
    place = gateway.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete what `scratch_path` has given out in this process.

    For the end of a job: DataFrames made before then read nothing any more.
    """
    while _SCRATCH:
        remove_path(spark, _SCRATCH.pop())


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write `df` once as Parquet in the shared folder and go on from there.

    Used where branches must see the very same rows, also after an executor
    was lost. Unlike a checkpoint the rows keep their columns apart and their
    size known, so later scans are narrow and joins can be planned.
    """
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
