"""The shared folder, and the package on executors."""

from pathlib import Path
from types import SimpleNamespace

from pyspark.sql import functions as F

from tallyweave import session


def local(path):
    return Path(path.removeprefix("file:"))


class Conf(dict):
    set = dict.__setitem__


def test_the_folder_that_is_named_or_else_the_warehouse():
    warehouse = {"spark.sql.warehouse.dir": "hdfs://x/warehouse/"}
    named = SimpleNamespace(conf=Conf(warehouse | {"spark.checkpoint.dir": "s3a://shared/"}))
    assert session.shared_root(named) == "s3a://shared"
    unnamed = SimpleNamespace(conf=Conf(warehouse))
    assert session.shared_root(unnamed) == "hdfs://x/warehouse/_scratch"
    assert unnamed.conf["spark.checkpoint.dir"] == "hdfs://x/warehouse/_scratch"


def test_scratch_goes_when_cleared(spark):
    before = list(session._SCRATCH)
    session._SCRATCH.clear()
    kept = session.stored(spark.range(5).withColumn("x", F.lit(None).cast("string")), "test")
    assert kept.count() == 5 and kept.schema["x"].dataType.simpleString() == "string"
    (path,) = session._SCRATCH
    assert local(path).exists()
    session.clear_scratch(spark)
    assert not local(path).exists() and session._SCRATCH == []
    session._SCRATCH.extend(before)


def test_package_is_shipped_once(spark):
    session.ship_package(spark)
    session.ship_package(spark)
    names = [name for name in spark.sparkContext._python_includes if name == "tallyweave.zip"]
    assert len(names) == 1
