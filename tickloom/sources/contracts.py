"""Contract files: positional CSV with a first line of its own kind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.text import strip, to_integer, to_integer_strict
from tickloom.operators.contract import Contract, resolve
from tickloom.schema import CM_INSTRUMENT, FO_INSTRUMENTS

END_MARK = "\u0001end"


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a file with ``line_key``, which orders them as in the file.

    A folder counts as its files one after another, by name. A file may be read
    in several blocks: the block's offset orders blocks, the row id orders the
    lines inside one. Bytes that are not UTF-8 are dropped.
    """
    return spark.read.text(path).select(
        F.regexp_replace("value", "�", "").alias("line"),
        F.struct(
            F.col("_metadata.file_name").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("line_key"),
    )


def split_fields(lines: DataFrame, width: int) -> DataFrame:
    """``c0 ..`` of the lines that have at least ``width`` fields.

    An end mark is added to every line, so that a line that is too short can
    be told from one whose last fields are empty. Fields come out of a
    generator, so that a line is parsed once and not again for each use of one.
    """
    names = [f"c{i}" for i in range(width)]
    marked = F.concat(F.col("line"), F.lit("," + END_MARK))
    parsed = F.from_csv(marked, ", ".join(f"{name} STRING" for name in [*names, "tail"]))
    fields = lines.select("line_key", F.inline(F.array(parsed))).select(
        "line_key", *[F.coalesce(F.col(name), F.lit("")).alias(name) for name in names])
    short = F.lit(False)
    for name in names:
        short = short | (F.col(name) == END_MARK)
    return fields.filter(~short)


def without_first_line(lines: DataFrame, only_if: Column | None = None) -> DataFrame:
    first = lines.agg(F.min("line_key").alias("k")).first().k
    if first is None:
        return lines
    is_first = (F.col("line_key.file") == first.file) & (F.col("line_key.block") == first.block) & (F.col("line_key.row") == first.row)
    return lines.filter(~(is_first if only_if is None else is_first & only_if))


def parse_fo_lines(lines: DataFrame, instruments: tuple[str, ...] = FO_INSTRUMENTS) -> DataFrame:
    """Derivative contracts of the wanted instruments; bad numbers fail."""
    wanted = split_fields(lines, 6).filter(strip(F.col("c3")).isin(*instruments))
    return wanted.select(
        "line_key",
        to_integer_strict(strip(F.col("c2")), "token").alias("token"),
        strip(F.col("c3")).alias("instrument"),
        strip(F.col("c4")).alias("symbol"),
        to_integer_strict(strip(F.col("c5")), "expiry").alias("expiry"),
    )


def parse_cm_lines(lines: DataFrame) -> DataFrame:
    """Cash contracts; lines with a bad token are left out."""
    wanted = split_fields(lines, 8).filter(strip(F.col("c3")) == CM_INSTRUMENT)
    return wanted.select(
        "line_key",
        to_integer(strip(F.col("c2"))).alias("token"),
        strip(F.col("c4")).alias("symbol"),
        strip(F.col("c7")).alias("series"),
    ).filter("token IS NOT NULL")


def read_fo_contract(spark: SparkSession, path: str, instruments: tuple[str, ...] = FO_INSTRUMENTS,
                     on_conflict: str = "error") -> Contract:
    lines = without_first_line(numbered_lines(spark, path))
    return resolve(parse_fo_lines(lines, instruments), ("symbol", "expiry"), on_conflict,
                   also=("instrument",))


def read_cm_contract(spark: SparkSession, path: str) -> Contract:
    digits = strip(F.split("line", ",")[0]).rlike("^[0-9]+$")
    lines = without_first_line(numbered_lines(spark, path), digits)
    return resolve(parse_cm_lines(lines), ("symbol", "series"), "first")
