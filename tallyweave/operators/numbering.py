"""Row numbers by one path, however many rows a group has."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

# Rows that one task sorts and numbers; more rows make more slices.
SLICE_ROWS = 1_000_000
# Spark's row ids count from 0 in each partition, above this many bits.
_ID_BITS = 33


def in_slices(df: DataFrame, keys: Sequence[str], slice_rows: int = SLICE_ROWS) -> DataFrame:
    """`df` sorted by `keys` and cut into slices, stored, with `_slice` and `_at`.

    `_slice` ascends with the keys and `_at` counts from 0 in each slice.
    Slices have about `slice_rows` rows even where all keys are equal: a
    position breaks ties. It is stored first, so a task run again sends the
    same rows to the same slices.
    """
    placed = stored(df.withColumn("_position", F.monotonically_increasing_id()), "rows")
    slices = placed.count() // slice_rows + 1
    order = [*keys, "_position"]
    numbered = stored(
        placed.repartitionByRange(slices, *order).sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id()).drop("_position"),
        "slices",
    )
    return numbered.withColumns({
        "_slice": F.shiftright("_id", _ID_BITS),
        "_at": F.col("_id").bitwiseAND(F.lit((1 << _ID_BITS) - 1)),
    }).drop("_id")


def running_numbers(
    df: DataFrame, keys: Sequence[str], name: str, first: int = 0, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """`df` with dense numbers over all rows in the order of `keys`.

    Rows are shuffled once; the sizes of the slices, one row each, are summed
    in one task and come back to the rows. Equal keys get different numbers.
    """
    sliced = in_slices(df, keys, slice_rows)
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sliced.groupBy("_slice").agg(F.count("*").alias("_size")).select(
        "_slice", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start")
    )
    # one row per slice, of which there is one for each `slice_rows` rows
    return sliced.join(F.broadcast(starts), "_slice").select(
        *df.columns, (F.col("_start") + F.col("_at") + F.lit(first)).cast("long").alias(name)
    )


def number_rows(
    df: DataFrame, by: Sequence[str], order: Sequence[str], name: str,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """`row_number` per group of `by` in `order`, for every row.

    A group may span many slices. Every slice numbers its part; only the group
    that a slice begins with can have rows before it, so there is at most one
    offset per slice. Where only the first few rows per group are wanted use
    `first_rows` instead.
    """
    sliced = in_slices(df, [*by, *order], slice_rows)
    part = Window.partitionBy("_slice", *by)
    begun = sliced.withColumn("_inside", F.col("_at") - F.min("_at").over(part))
    edges = (
        sliced.groupBy("_slice", *by).agg(F.count("*").alias("_size"), F.min("_at").alias("_from"))
    )
    before = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        edges.withColumn("_offset", F.sum("_size").over(before))
        .filter("_offset > 0 AND _from = 0")
        .select(F.col("_slice").alias("_of"), *[F.col(key).alias(f"_of_{key}") for key in by], "_offset")
    )
    same = F.col("_slice") == F.col("_of")
    for key in by:
        same = same & F.col(key).eqNullSafe(F.col(f"_of_{key}"))
    return begun.join(F.broadcast(offsets), same, "left").select(
        *df.columns,
        (F.col("_inside") + F.coalesce("_offset", F.lit(0)) + 1).cast("long").alias(name),
    )


def first_rows(
    df: DataFrame, by: Sequence[str], order: Sequence[str | Column], n: int, name: str
) -> DataFrame:
    """The first `n` rows per group, numbered.

    The rank filter becomes a group limit before the exchange, so no task
    receives more than `n` rows per group and upstream task.
    """
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)
