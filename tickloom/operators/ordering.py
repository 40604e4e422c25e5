"""Tape order, total and at any skew.

A tape is sorted by capture time and sequence number, missing values last, and
by archive and record number where these are equal. Rows are range-partitioned
on the whole of that key: it is unique, so a symbol with most of the rows is
spread over many tasks instead of filling one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.sizing import broadcast_if_small
from tickloom.session import checkpointed, work_folder

TIME_KEYS = ("capture_ns", "seq_no")
TIE_KEYS = ("archive_stem", "record_no")


def order_keys(df: DataFrame, keys: Sequence[str]) -> list:
    ties = [name for name in TIE_KEYS if name in df.columns]
    return [F.col(name).asc() for name in keys] + [
        F.col(name).asc_nulls_last() for name in (*TIME_KEYS, *ties)]


def sort_tape(df: DataFrame, *keys: str, partitions: int | None = None) -> DataFrame:
    """Sort by ``keys``, then in tape order; partitions follow one another."""
    order = order_keys(df, keys)
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order)


def number_tape(df: DataFrame, *keys: str, partitions: int | None = None) -> DataFrame:
    """Adds ``tape_no``, the 1-based place of each row in its group's tape.

    The sorted rows are written once to the shared folder, so that counting and
    numbering see the same row ids. Counting reads the key columns only and
    yields one row per group and partition it touches; running sums over those
    give each partition's start. No group is ever gathered in one task.
    """
    spark = df.sparkSession
    folder = work_folder(spark, "tape")
    sort_tape(df, *keys, partitions=partitions).withColumn(
        "place", F.monotonically_increasing_id()).write.parquet(folder)
    placed = spark.read.parquet(folder).withColumn("part", F.shiftright("place", 33))
    runs = placed.groupBy(*keys, "part").agg(
        F.count("*").alias("run_rows"), F.min("place").alias("run_start"))
    before = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("run_rows").over(before), F.lit(0)) - F.col("run_start") + 1
    starts = checkpointed(runs.select(*keys, "part", shift.alias("shift")))
    numbered = placed.join(broadcast_if_small(starts), [*keys, "part"])
    return numbered.withColumn("tape_no", F.col("place") + F.col("shift")).drop("place", "part", "shift")
