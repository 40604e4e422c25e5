"""Size reports over file listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.schema import FO_INSTRUMENTS


def with_layout(files: DataFrame, *keys: str) -> DataFrame:
    """Partition values of each file, read from its path."""
    for key in keys:
        raw = F.regexp_extract("path", rf"/{key}=([^/]+)/", 1)
        files = files.withColumn(key, F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B"))))
    return files


def instrument_sizes(finals: DataFrame, instruments: tuple[str, ...] = FO_INSTRUMENTS) -> DataFrame:
    """Bytes, files, expiries and symbol groups per instrument and in total.

    Only expiries that have files count; the total row counts each expiry once.
    """
    groups = finals.groupBy("instrument", "expiry", "symbol").agg(
        F.sum("length").alias("bytes"), F.count("*").alias("files"))
    per = groups.rollup("instrument").agg(
        F.sum("bytes").alias("bytes"), F.sum("files").alias("files"),
        F.count_distinct("expiry").alias("expiries"), F.count("*").alias("symbol_groups"))
    per = per.withColumn("instrument", F.coalesce("instrument", F.lit("TOTAL")))
    domain = finals.sparkSession.range(0, 1, 1, 1).select(
        F.explode(F.array(*[F.lit(name) for name in (*instruments, "TOTAL")])).alias("instrument"))
    return domain.join(per, "instrument", "left").fillna(0)


def compression_report(inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    """Input and output bytes, their ratio and the percentage saved."""
    return _compare(inputs, "input_bytes", outputs, "output_bytes").select(
        "input_bytes", "output_bytes",
        F.round(F.col("input_bytes") / 1e9, 3).alias("input_gb"),
        F.round(F.col("output_bytes") / 1e9, 3).alias("output_gb"),
        F.when(F.col("input_bytes") > 0, F.col("output_bytes") / F.col("input_bytes"))
        .otherwise(F.lit(0.0)).alias("ratio"),
    ).withColumn("pct_smaller", (1 - F.col("ratio")) * 100)


def codec_saving(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old against new bytes; a row only when both exist and are not empty.

    Old files count only when their Parquet magic is sound.
    """
    both = _compare(old.filter("magic_ok"), "old_bytes", new, "new_bytes")
    return both.filter("old_bytes > 0 AND new_bytes > 0").withColumn(
        "saving_pct", (1 - F.col("new_bytes") / F.col("old_bytes")) * 100)


def _compare(left: DataFrame, left_name: str, right: DataFrame, right_name: str) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    parts = left.select(F.col("length").alias(left_name), zero.alias(right_name)).unionByName(
        right.select(zero.alias(left_name), F.col("length").alias(right_name)))
    return parts.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in (left_name, right_name)])


def cash_sizes(ledger: DataFrame, files: DataFrame) -> DataFrame:
    """Rows and MiB per cash group."""
    rows = ledger.groupBy("symbol", "series").agg(
        F.first("safe_name").alias("safe_name"), F.sum("rows").alias("rows"))
    sizes = files.groupBy("symbol", "series").agg(F.sum("length").alias("bytes"))
    return rows.join(sizes, ["symbol", "series"], "left").select(
        "symbol", "series", "safe_name", "rows",
        F.round(F.coalesce("bytes", F.lit(0)) / 1048576, 2).alias("file_size_mb"))
