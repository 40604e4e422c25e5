"""File listings as DataFrames: discovery, capture choice, name parsing."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import text
from tickloom.session import ship_package
from tickloom.sources.files import filesystem_of

PARQUET_MAGIC = b"PAR1"
LISTING_DDL = "path STRING, length BIGINT"


def list_files(spark: SparkSession, folder: str, glob: str = "*", recursive: bool = False,
               exclude: str | None = None) -> DataFrame:
    """``path, length`` of the files of a folder; contents are never read.

    Without ``recursive`` only the folder itself is listed, whatever directories
    lie beside the files. Nothing found gives no rows.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    try:
        if recursive:
            files = reader.option("pathGlobFilter", glob).load(folder)
        else:
            files = reader.load(f"{folder.rstrip('/')}/{glob}").filter(directly_in(F.col("path"), folder))
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LISTING_DDL)
    files = files.select("path", "length")
    if exclude:
        files = files.filter(~text.base_name(F.col("path")).rlike(exclude))
    return files


def directly_in(path: Column, folder: str) -> Column:
    bare = re.sub(r"^[a-z0-9]+:", "", folder).strip("/")
    return F.regexp_replace(path, "/[^/]*$", "").endswith("/" + bare)


def discover_archives(spark: SparkSession, folder: str, glob: str, exclude: str | None = None,
                      required: bool = True) -> DataFrame:
    files = list_files(spark, folder, glob, exclude=exclude)
    if required and files.isEmpty():
        raise FileNotFoundError(f"no {glob} under {folder}")
    return files.withColumn("archive_stem", text.archive_stem(F.col("path")))


def choose_capture(files: DataFrame, *keys: str) -> DataFrame:
    """The one plain capture to use, per ``keys``.

    First by name within each kind; the recovery file wins unless the stitched
    one is larger. Folders with neither yield no row.
    """
    name = text.base_name(F.col("path"))
    kind = F.when(name.startswith("recovery_efvi_"), "recovery").when(name.startswith("stitched_efvi_"), "stitched")
    kind = F.when(name.endswith(".cap"), kind)
    firsts = (
        files.withColumn("kind", kind).filter("kind IS NOT NULL")
        .groupBy(*keys, "kind").agg(F.min(F.struct("path", "length")).alias("file"))
    )
    preference = F.struct(F.col("file.length"), (F.col("kind") == "recovery").cast("int"))
    return (
        firsts.groupBy(*keys)
        .agg(F.max_by(F.struct("kind", "file.path", "file.length"), preference).alias("pick"))
        .filter("pick IS NOT NULL")
        .select(*keys, "pick.kind", "pick.path", "pick.length")
    )


def with_chosen_capture(archives: DataFrame, chosen: DataFrame) -> DataFrame:
    """Archive list with the chosen plain capture added."""
    plain = chosen.withColumn("archive_stem", text.archive_stem(F.col("path")))
    return archives.unionByName(plain.select(*archives.columns))


def parse_derivative_names(files: DataFrame, trade_date: str, instrument: str = "FUTSTK") -> DataFrame:
    """Manifest of ``<date>_<instrument>_<symbol>_<expiry>.parquet`` files."""
    return _parse_names(files, rf"^{trade_date}_{instrument}_(.*)_([0-9]+)\.parquet$", "expiry_epoch")


def parse_cash_names(files: DataFrame, trade_date: str, series: str = "EQ") -> DataFrame:
    """Manifest of ``<date>_<symbol>_<series>.parquet`` files of the wanted series."""
    manifest = _parse_names(files, rf"^{trade_date}_(.*)_([^_]+)\.parquet$", "series")
    return keep_listed(manifest, "series", series)


def keep_listed(df: DataFrame, column: str, wanted: str) -> DataFrame:
    """Rows whose value is in a comma list; empty, ``ALL`` or ``*`` keeps all."""
    names = [name.strip() for name in wanted.split(",")] if wanted else []
    if not names or names in (["ALL"], ["*"]):
        return df
    return df.filter(F.col(column).isin(*names))


def _parse_names(files: DataFrame, pattern: str, last: str) -> DataFrame:
    name = text.base_name(F.col("path"))
    return (
        files.filter(name.rlike(pattern))
        .withColumn("symbol", F.regexp_extract(name, pattern, 1))
        .withColumn(last, F.regexp_extract(name, pattern, 2))
    )


def require_rows(manifest: DataFrame, complaint: str) -> DataFrame:
    if manifest.isEmpty():
        raise FileNotFoundError(complaint)
    return manifest


def first_file_per_symbol(manifest: DataFrame, *keys: str) -> DataFrame:
    """One file per symbol, the first by path."""
    rest = [name for name in manifest.columns if name not in keys and name != "path"]
    return (
        manifest.groupBy(*keys)
        .agg(F.min(F.struct("path", *rest)).alias("first"))
        .select(*keys, "first.path", *[f"first.{name}" for name in rest])
    )


def with_magic(files: DataFrame) -> DataFrame:
    """Adds ``magic_ok``: both ends of the file carry the Parquet magic.

    Each task opens its own files and reads eight bytes of each.
    """
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            verdicts = []
            for path in batch.column("path").to_pylist():
                store, inner = filesystem_of(path)
                with store.open_input_file(inner) as handle:
                    size = handle.size()
                    whole = size >= 8 and handle.read(4) == PARQUET_MAGIC
                    if whole:
                        handle.seek(size - 4)
                        whole = handle.read(4) == PARQUET_MAGIC
                verdicts.append(whole)
            yield batch.append_column("magic_ok", pa.array(verdicts, pa.bool_()))

    ship_package(files.sparkSession)
    schema = files.schema.simpleString()[len("struct<"):-1]
    return files.mapInArrow(probe, schema + ",magic_ok:boolean")
