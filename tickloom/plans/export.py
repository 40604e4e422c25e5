"""Research export: final tables -> sorted main and aux tapes per symbol."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import ordering, research, resume, sizes
from tickloom.operators.sizing import broadcast_if_small
from tickloom.plans import sinks
from tickloom.plans.ingest import read_table
from tickloom.session import checkpointed, ship_package
from tickloom.sources import listing
from tickloom.sources.files import filesystem_of, remove_folders


def summary_schema(keys: Sequence[str]) -> str:
    return "rows BIGINT, status STRING, path STRING, trade_date STRING, " + ", ".join(f"{key} STRING" for key in keys)


def export_tapes(spark: SparkSession, rows: DataFrame, out: str, trade_date: str, keys: Sequence[str],
                 overwrite: bool = False, ready: bool = False) -> DataFrame:
    """Export every group of ``rows`` not exported yet; returns one row per group.

    ``keys`` are ``symbol`` or ``symbol, series``. The tapes are written first
    and the summary last, so a group counts as existing only when complete.
    ``ready`` says that the rows hold the research columns already. The path of
    a group is the folder of its main tape, or of its aux tape if it has no other.
    """
    keys = list(keys)
    schema = summary_schema(keys)
    targets = rows.select(*keys).distinct()
    before = read_table(spark, f"{out}/summary", schema)
    done = spark.createDataFrame([], schema) if before is None else before.filter(F.col("trade_date") == trade_date)
    done = checkpointed(done)
    todo = checkpointed(resume.export_work(targets, done, *keys, overwrite=overwrite))
    skipped = done if overwrite else resume.export_existing(done, targets, *keys)
    skipped = skipped.withColumn("rows", F.lit(None).cast("bigint")).withColumn("status", F.lit("exists"))
    if todo.isEmpty():
        return skipped
    wanted = broadcast_if_small(todo)
    chosen = rows.join(wanted, keys, "left_semi")
    tapes = research.split_tapes(chosen if ready else prepared(chosen, keys))
    place = f"{out}/tapes/trade_date={trade_date}"
    held = checkpointed(tape_files(spark, place, keys).join(wanted, keys, "left_semi"))
    sinks.write_tapes(ordering.sort_tape(tapes, "tape", *keys), place, *keys)
    layout = "seq_no INT, tape STRING, " + ", ".join(f"{key} STRING" for key in keys)
    if not held.isEmpty():
        # A written tape has new files only. One that has become empty writes nothing, so its old files are still there and must go.
        remove_folders(tape_files(spark, place, keys).join(held.select("path"), "path", "left_semi").select("folder").distinct())
    counts = resume.export_summary(spark.read.schema(layout).parquet(place).join(wanted, keys, "left_semi"), *keys)
    paths = tape_files(spark, place, keys).groupBy(*keys).agg(
        F.min_by("folder", F.struct(F.col("tape") != "main", "folder")).alias("path"))
    fresh = checkpointed(
        todo.join(counts, keys, "left").join(paths, keys, "left").fillna({"rows": 0, "status": "written"})
        .select("rows", "status", "path", F.lit(trade_date).alias("trade_date"), *keys))
    kept = done.join(fresh.select(*keys), keys, "left_anti")
    sinks.write_summary(fresh.unionByName(kept), f"{out}/summary")
    return fresh.unionByName(skipped) if not overwrite else fresh


def tape_files(spark: SparkSession, place: str, keys: Sequence[str]) -> DataFrame:
    """The files of a day's tapes, with their folder, tape and group."""
    files = listing.list_files(spark, place, "*.parquet", recursive=True)
    folder = F.regexp_replace("path", "/[^/]*$", "").alias("folder")
    return sizes.with_layout(files, "tape", *keys).select("path", folder, "tape", *keys)


def prepared(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Research columns plus the keys and what breaks ties in the order."""
    ties = [name for name in ordering.TIE_KEYS if name in rows.columns]
    return research.prepare(rows, *keys, *ties)


def with_columns_found(files: DataFrame) -> DataFrame:
    """Adds ``columns``: names and types in each file's footer, read in tasks; NULL where it cannot be read."""
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path in batch.column("path").to_pylist():
                store, inner = filesystem_of(path)
                try:
                    with store.open_input_file(inner) as handle:
                        found.append("\n".join(f"{field.name}\t{field.type}" for field in pq.read_schema(handle)))
                except pa.ArrowInvalid:
                    found.append(None)
            yield batch.append_column("columns", pa.array(found, pa.string()))

    ship_package(files.sparkSession)
    schema = files.schema.simpleString()[len("struct<"):-1]
    return files.mapInArrow(probe, schema + ",columns:string")


def export_derivative_files(spark: SparkSession, folder: str, out: str, trade_date: str, expiry: str = "",
                            symbols: str = "", overwrite: bool = False) -> DataFrame:
    """Export the front (or the requested) expiry of a folder of futures files."""
    files = listing.list_files(spark, folder, "*.parquet", recursive=True)
    manifest = listing.require_rows(listing.parse_derivative_names(files, trade_date),
                                    f"no futures files of {trade_date} under {folder}")
    chosen = research.select_expiry(manifest, trade_date, expiry)
    firsts = listing.first_file_per_symbol(manifest.filter(F.col("expiry_epoch") == chosen), "symbol")
    wanted = listing.keep_listed(firsts, "symbol", symbols).select("path", "length", "symbol")
    return _export_files(spark, wanted, out, trade_date, ["symbol"], overwrite, "extract_futstk_summary")


def export_cash_files(spark: SparkSession, folder: str, out: str, trade_date: str, series: str = "EQ",
                      symbols: str = "", overwrite: bool = False) -> DataFrame:
    """Export the wanted series of a folder of cash files."""
    manifest = listing.parse_cash_names(listing.list_files(spark, folder, "*.parquet"), trade_date, series)
    wanted = listing.keep_listed(manifest, "symbol", symbols)
    return _export_files(spark, wanted, out, trade_date, ["symbol", "series"], overwrite, "extract_cm_summary")


def _export_files(spark: SparkSession, manifest: DataFrame, out: str, trade_date: str, keys: list[str],
                  overwrite: bool, report: str) -> DataFrame:
    """Export the files of a manifest and write the summary report.

    Files are read in groups of equal columns, and each group's columns are
    resolved by its own names. A damaged file, or one without a required
    column, becomes an error row and the rest goes on. The files' paths reach
    the driver, as for any scan; their rows do not.
    """
    checked = checkpointed(with_columns_found(listing.require_rows(manifest, "no files matched")))
    alike: dict[str, list[str]] = {}
    for row in checked.filter("columns IS NOT NULL").select("path", "columns").collect():
        alike.setdefault(row["columns"], []).append(row.path)
    parts, lacking = [], []
    for columns, paths in alike.items():
        rows = spark.read.parquet(*paths)
        if research.missing_columns(research.resolve_columns(rows)):
            lacking.append(columns)
            continue
        # The scan reports percent-encoded paths.
        encoded = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
        place = F.regexp_replace(F.url_decode(encoded), "^file:/+", "/")
        parts.append(prepared(rows.withColumn("tape_source", place), ["tape_source"]))
    wrong = F.col("columns").isNull() | F.col("columns").isin(lacking) if lacking else F.col("columns").isNull()
    failed = checked.filter(wrong).select(
        F.lit(None).cast("bigint").alias("rows"), F.lit("error").alias("status"), "path",
        F.lit(trade_date).alias("trade_date"), *keys)
    summary = failed
    if parts:
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        names = checked.select(F.regexp_replace("path", "^file:/+", "/").alias("tape_source"), *keys)
        clashing = [key for key in keys if key in rows.columns]
        named = rows.drop(*clashing).join(broadcast_if_small(names), "tape_source").drop("tape_source")
        summary = export_tapes(spark, named, out, trade_date, keys, overwrite, ready=True).unionByName(failed)
    sinks.write_report(summary, f"{out}/{report}_{trade_date}")
    return summary
