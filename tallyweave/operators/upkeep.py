"""Keeping tables up to date: merges, deletes, change feeds, table versions.

Parquet tables have no row-level updates, so each operator gives the new
content as a DataFrame and `replace_table` publishes it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.values import all_of, any_of
from ..session import remove_path, scratch_path, stored

WRITERS = 16  # tasks that may write one partition of a table


def _known(keys: Sequence[str]) -> Column:
    """No part of the key is missing; a missing key never equals another."""
    return all_of(F.col(key).isNotNull() for key in keys)


def _unmatched(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows without a partner. Rows with a missing key skip the join."""
    held = target.select(*keys).filter(_known(keys))
    fresh = source.filter(_known(keys)).join(held, list(keys), "left_anti")
    return fresh.unionByName(source.filter(~_known(keys)))


def _never(condition: Column, message: str) -> Column:
    """True, or an error where the condition holds; as a filter nothing prunes it."""
    return F.when(condition, F.raise_error(F.lit(message)).cast("boolean")).otherwise(F.lit(True))


def _met(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target and source rows side by side, in the structs `_old` and `_new`.

    One full outer join by key. Raises where several source rows claim one
    target row; the source's rows per key are counted before they meet, so a
    key that many source rows share alone is no single task's work.
    """
    counts = source.filter(_known(keys)).groupBy(*keys).agg(F.count("*").alias("_rows"))
    held = target.filter(_known(keys)).join(counts, list(keys), "left").select(
        *keys, "_rows", F.struct(*target.columns).alias("_old")
    ).filter(_never(F.col("_rows") > 1, "several source rows match one target row"))
    fresh = source.filter(_known(keys)).select(*keys, F.struct(*source.columns).alias("_new"))
    return held.join(fresh, list(keys), "full_outer").select("_old", "_new")


def _missing_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of both sides whose key is missing; they match nothing."""
    return target.unionByName(source.select(*target.columns)).filter(~_known(keys))


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Matched rows take all source values, other source rows are added."""
    columns = target.columns
    merged = _met(target, source.select(*columns), keys).select(*[
        F.when(F.col("_new").isNotNull(), F.col(f"_new.{name}"))
        .otherwise(F.col(f"_old.{name}")).alias(name) for name in columns
    ])
    return merged.unionByName(_missing_keys(target, source, keys))


def upsert_partitions(source: DataFrame, name: str, keys: Sequence[str]) -> None:
    """Upsert into table `name`, reading and writing only the partitions that `source` has.

    The partition columns must be among the keys, so no row changes its
    partition and a matching row can only lie in the source's own partitions:
    the join with these prunes the scan of the table as it runs. Partitions are
    replaced one by one, each as a whole; after a loss in between the same
    call leads to the same table. Raises where a partition column is missing in
    a source row, or several source rows claim one target row; nothing is
    written then. An empty source changes nothing.
    """
    spark = source.sparkSession
    by = _partition_columns(spark, name)
    if not by or not set(by) <= set(keys):
        raise ValueError(f"the partition columns {by} of {name} have to be some of the keys {list(keys)}")
    target = current(spark, name)
    # the source is met several times, and must be the same each time
    source = stored(source.select(*target.columns).filter(
        _never(~_known(by), "a partition column is missing")), "upsert")
    # the table's own folders are its partitions, so there are no more of these rows than folders
    touched = source.select(*by).distinct()
    merged = merge_upsert(target.join(F.broadcast(touched), by, "left_semi"), source, keys)
    placed = merged.select(*target.columns).repartition(*by, F.pmod(F.xxhash64(*keys), F.lit(WRITERS)))
    with _setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        placed.write.insertInto(name, overwrite=True)
    spark.catalog.refreshTable(name)


def merge_insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Only source rows without a partner are added."""
    return target.unionByName(_unmatched(source.select(*target.columns), target, keys))


def merge_when_changed(
    target: DataFrame, source: DataFrame, keys: Sequence[str], column: str
) -> DataFrame:
    """Matched rows take one column, and only where it differs.

    A NULL on either side counts as no difference, as `<>` does.
    """
    changed = F.coalesce(F.col(f"_new.{column}") != F.col(f"_old.{column}"), F.lit(False))
    merged = _met(target, source.select(*target.columns), keys).select(*[
        F.when(F.col("_old").isNull() | (changed if name == column else F.lit(False)),
               F.col(f"_new.{name}")).otherwise(F.col(f"_old.{name}")).alias(name)
        for name in target.columns
    ])
    return merged.unionByName(_missing_keys(target, source, keys))


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows the condition does not hold for; an unknown result keeps the row."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Without the named columns; absent names are ignored."""
    return df.drop(*names)


def union_with_new_columns(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both; a column only one side has is NULL for the other."""
    return old.unionByName(new, allowMissingColumns=True)


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that differ between two snapshots, with the kind of change.

    Inserts and updates carry the new row, deletes the old one. A key is unique
    inside a snapshot; a repeated one raises. A missing key equals no other, so
    its old rows are deletes and its new ones inserts. Each snapshot is
    exchanged and sorted once, for the count per key and the join alike.
    """
    columns = new.columns
    same_key = Window.partitionBy(*keys)

    def side(df: DataFrame, name: str) -> DataFrame:
        counted = df.withColumn("_rows", F.count("*").over(same_key))
        unique = _never((F.col("_rows") > 1) & _known(keys), f"a key is repeated in the {name} rows")
        return counted.filter(unique).select(*keys, F.struct(*columns).alias(f"_{name}"))

    pairs = side(old, "old").join(side(new, "new"), list(keys), "full_outer")
    differs = any_of(
        ~F.col(f"_old.{name}").eqNullSafe(F.col(f"_new.{name}")) for name in columns
    )
    change = (
        F.when(F.col("_old").isNull(), "insert")
        .when(F.col("_new").isNull(), "delete")
        .when(differs, "update")
    )
    return (
        pairs.withColumn("change", change).filter(F.col("change").isNotNull())
        .withColumn("_row", F.coalesce("_new", "_old"))
        .select("change", *[F.col(f"_row.{name}").alias(name) for name in columns])
    )


def apply_changes(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target after a change feed: touched keys out, new rows in."""
    kept = target.join(changes.select(*keys), list(keys), "left_anti")
    arrived = changes.filter(F.col("change") != "delete").select(*target.columns)
    return kept.unionByName(arrived)


def create_table(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
    """Save as a table; fails when the name is taken.

    A table partitioned by, say, year lets readers of one year skip the rest.
    """
    writer = df.write.format("parquet").mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with _partitions_by_folder(df.sparkSession):
        writer.saveAsTable(name)


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _partitions_by_folder(spark: SparkSession) -> AbstractContextManager:
    """Tables created meanwhile find their partitions in their folder.

    The catalog would else keep a place for each, and a table could not move
    to another folder in one step.
    """
    return _setting(spark, "spark.sql.hive.manageFilesourcePartitions", "false")


def replace_table(df: DataFrame, name: str, partition_by: Sequence[str] | None = None) -> None:
    """Publish `df` as the content of table `name`.

    The rows go to a fresh folder beside the table's own first and the table is
    pointed at it after, so `df` may read the table it replaces and a failed
    write changes nothing. The table keeps its partition columns, unless others
    are given. It stays in place when `df` has its columns, or more at the end;
    any other schema makes it anew, and only then, or if the catalog keeps the
    places of its partitions, is there a moment without it.

    Readers that have already planned keep the old folder, which stays until
    `drop_superseded`; other sessions see the new one through `current`.
    """
    spark = df.sparkSession
    exists = spark.catalog.tableExists(name)
    held_by = _partition_columns(spark, name) if exists else []
    by = held_by if partition_by is None else list(partition_by)
    df = df.select(*[c for c in df.columns if c not in by], *by)  # as the table has them
    place = _location(spark, name) if exists else None
    folder, _, _ = (place or _default_location(spark, name)).rpartition("/")
    path = f"{folder}/{_stem(name)}{uuid.uuid4().hex}"
    writer = df.write.format("parquet")
    (writer.partitionBy(*by) if by else writer).save(path)
    if exists and by == held_by and not _tracked(spark, name) and _widen(spark, name, df, by):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        parts = f"PARTITIONED BY ({', '.join(by)})" if by else ""
        with _partitions_by_folder(spark):
            spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {parts} LOCATION '{path}'")
    spark.catalog.refreshTable(name)


def drop_superseded(spark: SparkSession, name: str) -> int:
    """Delete the folders that `replace_table` has left behind; gives their number."""
    place = _location(spark, name)
    folder, _, own = place.rpartition("/")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in files.listStatus(path)]
    gone = [other for other in names if other.startswith(_stem(name)) and other != own]
    for other in gone:
        remove_path(spark, f"{folder}/{other}")
    return len(gone)


def _stem(name: str) -> str:
    """What the folders of a table's versions begin with."""
    return f"{name.rpartition('.')[2].strip('`').lower()}--"


def _default_location(spark: SparkSession, name: str) -> str:
    base = spark.sql("DESCRIBE DATABASE " + (name.rpartition(".")[0] or spark.catalog.currentDatabase()))
    (row,) = base.filter("info_name = 'Location'").collect()
    return f"{row.info_value.rstrip('/')}/{name.rpartition('.')[2]}"


def _location(spark: SparkSession, name: str) -> str:
    (row,) = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").collect()
    return row.data_type.rstrip("/")


def _tracked(spark: SparkSession, name: str) -> bool:
    about = spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
    return not about.filter("col_name = 'Partition Provider' AND data_type = 'Catalog'").isEmpty()


def _partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [column.name for column in spark.catalog.listColumns(name) if column.isPartition]


def _widen(spark: SparkSession, name: str, df: DataFrame, by: Sequence[str]) -> bool:
    """Whether the table has the columns of `df`, if need be after adding some."""

    def plain(fields) -> list:
        return [(f.name, f.dataType) for f in fields if f.name not in by]

    held, wanted = plain(spark.table(name).schema), plain(df.schema)
    if wanted[:len(held)] != held:
        return False
    if more := wanted[len(held):]:
        columns = ", ".join(f"`{column}` {kind.simpleString()}" for column, kind in more)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
    return True


def current(spark: SparkSession, name: str) -> DataFrame:
    """The table as last published, also when another session did so."""
    spark.catalog.refreshTable(name)
    return spark.read.table(name)


def create_table_as(spark: SparkSession, name: str, query: str) -> None:
    spark.sql(f"CREATE TABLE {name} USING parquet AS {query}")


def create_view(spark: SparkSession, name: str, query: str) -> None:
    """A view that stays in the catalog; an earlier one of the name is replaced."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")


def create_table_if_absent(spark: SparkSession, name: str, columns: str) -> None:
    """Typed empty table, unless the name is taken; `columns` is a DDL list."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet")


def snapshot(df: DataFrame, name: str | None = None) -> DataFrame:
    """A copy that later changes to the source do not reach.

    With a name the copy is a table, kept when it is already there.
    """
    spark = df.sparkSession
    if name is not None:
        if not spark.catalog.tableExists(name):
            create_table(df, name)
        return spark.read.table(name)
    path = scratch_path(spark, "snapshot")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
