"""What is still to do: archives not yet ingested, tapes not yet exported."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions import text


def completed_archives(shards: DataFrame) -> DataFrame:
    """Archives named by shard files."""
    return shards.select(text.shard_archive(F.col("path")).alias("archive_stem")).distinct()


def remaining_archives(archives: DataFrame, done: DataFrame) -> DataFrame:
    return archives.join(done.select("archive_stem"), "archive_stem", "left_anti")


def export_work(targets: DataFrame, existing: DataFrame, *keys: str, overwrite: bool = False) -> DataFrame:
    """Targets whose two tapes do not both exist; all of them to overwrite."""
    return targets if overwrite else targets.join(existing.select(*keys), list(keys), "left_anti")


def export_existing(targets: DataFrame, existing: DataFrame, *keys: str) -> DataFrame:
    return targets.join(existing.select(*keys), list(keys), "left_semi")


def both_tapes(written: DataFrame, *keys: str) -> DataFrame:
    """Groups for which the main and the aux tape have been written."""
    return written.groupBy(*keys).agg(
        F.bool_or(F.col("tape") == "main").alias("m"), F.bool_or(F.col("tape") == "aux").alias("a"),
    ).filter("m AND a").select(*keys)


def export_summary(tapes: DataFrame, *keys: str) -> DataFrame:
    """Rows of the main tape per group, written status."""
    return tapes.groupBy(*keys).agg(
        F.count_if(F.col("tape") == "main").alias("rows")).withColumn("status", F.lit("written"))
