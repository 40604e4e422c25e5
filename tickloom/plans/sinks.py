"""Where results go. Writers are separate from operators.

Every partitioned write replaces only the partitions it produces, so running a
job again gives the same table instead of more rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from tickloom.schema import SHARED_SKIP_INSTRUMENTS

ROWS_PER_FILE = 50_000_000


def _replace_partitions(df: DataFrame, *keys: str, codec: str) -> DataFrameWriter:
    return (
        df.write.mode("overwrite").partitionBy(*keys)
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .option("compression", codec)
    )


#: Files a task of the shard write keeps open before it sorts what is left.
SHARD_WRITERS = 4


@contextmanager
def setting(spark: SparkSession, key: str, value: object) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(value))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def write_shards(rows: DataFrame, path: str) -> None:
    """Decoded rows by ``kind`` (shard or quarantine) and archive: two tables from one pass.

    A scan task holds rows of one archive, or of a few small ones, so this
    needs no shuffle, and with a file open for each no sort either. Expiry and
    symbol stay columns.
    """
    with setting(rows.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", SHARD_WRITERS):
        _replace_partitions(rows, "kind", "archive_stem", codec="snappy").parquet(path)


def write_derivatives(rows: DataFrame, path: str, *below: str) -> None:
    """One directory per trade date, instrument, symbol and expiry.

    Rebalancing gathers small groups and lets the engine cut large ones, so a
    hot symbol becomes several files written by several tasks. ``below`` names
    columns that divide these directories further.
    """
    keys = ("trade_date", "instrument", "symbol", "expiry", *below)
    _replace_partitions(rows.hint("rebalance", *keys), *keys, codec="zstd").parquet(path)


def write_cash(rows: DataFrame, path: str) -> None:
    keys = ("trade_date", "symbol", "series")
    _replace_partitions(rows.hint("rebalance", *keys), *keys, codec="snappy").parquet(path)


def write_groups(rows: DataFrame, path: str, keys: tuple[str, ...], codec: str) -> None:
    """One directory per group below a folder of its own."""
    (rows.hint("rebalance", *keys).write.partitionBy(*keys).option("maxRecordsPerFile", ROWS_PER_FILE)
     .option("compression", codec).parquet(path))


def clear(spark: SparkSession, path: str, schema: str, *keys: str) -> None:
    """An empty table in the place of whatever was there."""
    (spark.createDataFrame([], schema).write.mode("overwrite").partitionBy(*keys)
     .option("partitionOverwriteMode", "static").parquet(path))


def publishable(rows: DataFrame, skip: tuple[str, ...] = SHARED_SKIP_INSTRUMENTS) -> DataFrame:
    return rows.filter(~F.col("instrument").isin(*skip)) if skip else rows


def write_ledger(ledger: DataFrame, path: str) -> None:
    """Ledger rows by archive; an archive done again replaces its rows."""
    _replace_partitions(ledger.hint("rebalance", "archive_stem"), "archive_stem", codec="snappy").parquet(path)


def write_tapes(tapes: DataFrame, path: str, *keys: str) -> None:
    """Sorted tapes. Rows arrive range-partitioned and sorted by exactly these
    keys and then in tape order, so the writer sorts nothing again: the files of
    a group follow one another by name and each is sorted."""
    _replace_partitions(tapes, "tape", *keys, codec="zstd").parquet(path)


def write_summary(summary: DataFrame, path: str) -> None:
    """One row per exported group; a date's rows are written as a whole."""
    _replace_partitions(summary.hint("rebalance", "trade_date"), "trade_date", codec="snappy").parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").option("header", True).csv(path)
