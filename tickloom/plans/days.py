"""A day's table in versions: each is written beside the others, and one object, made last, says which one is current.

Layout below a table's folder::

    trade_date=D/version=V/<keys>/part-…     rows of one version
    _current/D/<number>.<V>                  empty; the greatest name is the current version

Making an empty object is one step on any file system, so a reader finds the
version before or the one after, never a part. Nothing of the current version
is touched while another one is written.
"""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.plans import sinks
from tickloom.sources.files import filesystem_of, remove_folders


def _names(folder: str) -> list[str]:
    files, inner = filesystem_of(folder)
    found = files.get_file_info(fs.FileSelector(inner, allow_not_found=True))
    return sorted(info.base_name for info in found)


def history(path: str, trade_date: str) -> list[str]:
    """Versions that were made current and are still kept, oldest first."""
    return [name.partition(".")[2] for name in _names(f"{path}/_current/{trade_date}") if not name.startswith(".")]


def version_folder(path: str, trade_date: str, version: str) -> str:
    return f"{path}/trade_date={trade_date}/version={version}"


def current_folder(path: str, trade_date: str) -> str | None:
    """Where a day's rows are now; None for a day without any."""
    versions = history(path, trade_date)
    return version_folder(path, trade_date, versions[-1]) if versions else None


def make_current(path: str, trade_date: str, version: str) -> None:
    folder = f"{path}/_current/{trade_date}"
    files, inner = filesystem_of(folder)
    files.create_dir(inner, recursive=True)
    numbers = [int(name.partition(".")[0]) for name in _names(folder) if not name.startswith(".")]
    with files.open_output_stream(f"{inner}/{max(numbers, default=0) + 1:012d}.{version}"):
        pass


def replace_day(rows: DataFrame, path: str, trade_date: str, keys: tuple[str, ...], codec: str, keep: int = 1) -> str:
    """A day's whole table as a new version; returns the version.

    A write that fails leaves the former version current and takes its own
    files away. The ``keep`` versions before the new one stay for queries that
    have begun on them; older ones go.
    """
    version = uuid.uuid4().hex
    folder = version_folder(path, trade_date, version)
    try:
        sinks.write_groups(rows.drop("trade_date"), folder, keys, codec)
    except Exception:
        remove_versions(rows.sparkSession, path, trade_date, [version])
        raise
    make_current(path, trade_date, version)
    retire(rows.sparkSession, path, trade_date, keep)
    return version


def retire(spark: SparkSession, path: str, trade_date: str, keep: int) -> None:
    """Forget all but the current version and ``keep`` before it: first their pointers, then their rows."""
    files, inner = filesystem_of(f"{path}/_current/{trade_date}")
    names = [name for name in _names(f"{path}/_current/{trade_date}") if not name.startswith(".")]
    gone = names[: max(0, len(names) - keep - 1)]
    for name in gone:
        files.delete_file(f"{inner}/{name}")
    remove_versions(spark, path, trade_date, [name.partition(".")[2] for name in gone])


def sweep(spark: SparkSession, path: str, trade_date: str) -> list[str]:
    """Remove versions that were never made current, as a lost driver leaves them; not while a write is under way."""
    known = set(history(path, trade_date))
    written = [name.partition("=")[2] for name in _names(f"{path}/trade_date={trade_date}") if name.startswith("version=")]
    lost = [version for version in written if version not in known]
    remove_versions(spark, path, trade_date, lost)
    return lost


def remove_versions(spark: SparkSession, path: str, trade_date: str, versions: list[str]) -> None:
    if versions:
        remove_folders(spark.createDataFrame([(version_folder(path, trade_date, version),) for version in versions], "folder STRING"))


def read_day(spark: SparkSession, path: str, trade_date: str, schema: str) -> DataFrame:
    """The rows of a day's current version; none for a day never written. ``schema`` has ``trade_date`` and the keys."""
    folder = current_folder(path, trade_date)
    if folder is None or not _names(folder):
        return spark.createDataFrame([], schema)
    names = spark.createDataFrame([], schema).columns
    stored = ", ".join(field for field in _fields(schema) if field.split()[0] != "trade_date")
    return spark.read.schema(stored).parquet(folder).withColumn("trade_date", F.lit(trade_date)).select(names)


def _fields(schema: str) -> list[str]:
    return schema.split(", ")
