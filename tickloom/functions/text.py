"""Names, ids and file names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.schema import ARCHIVE_SUFFIXES, BLANK_WORDS

UNICODE_BLANKS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
# Doubles below the first fit a long, below the second a decimal of 38 digits.
LONG_RANGE, DECIMAL_RANGE = 2.0**63, 1e38
LINE_BLANKS = " \t\r\n"


def strip(text: Column) -> Column:
    """Drop any Unicode white space from both ends."""
    return F.regexp_replace(text, UNICODE_BLANKS, "")


def sanitize_symbol(symbol: Column) -> Column:
    """Keep letters, digits, dot, underscore and minus; the rest becomes ``_``."""
    return F.regexp_replace(symbol, r"[^\p{L}\p{N}._-]", "_")


def cash_group_name(symbol: Column, series: Column) -> Column:
    return F.concat_ws("_", sanitize_symbol(symbol), sanitize_symbol(series))


def clean_column_name(name: str) -> str:
    return re.sub(r"[^a-z0-9]+", "_", name.lower())


def is_blank(value: Column, numeric: bool, floating: bool = False) -> Column:
    """Missing-value test: NULL or NaN for numbers, also blank words for text."""
    if numeric:
        return (value.isNull() | F.isnan(value)) if floating else value.isNull()
    word = F.lower(F.btrim(value.cast("string"), F.lit(LINE_BLANKS)))
    return value.isNull() | word.isin(*BLANK_WORDS)


def whole_number(value: Column) -> Column:
    """A float as its nearest whole number, ties to even, with all its digits up to 38 of them.

    A double past the range of a long is a whole number already; its two halves
    of 64 bits are exact, and so is their sum as a decimal. Numbers of more
    digits, which no id has, show 17 exact ones.
    """
    size = F.abs(value)
    high = F.floor(size / F.lit(2.0**64)).cast("double")
    low = size - high * F.lit(2.0**64)
    # Such doubles are even, so half of the low part fits a long.
    exact = high.cast("bigint").cast("decimal(19,0)") * F.expr("cast('18446744073709551616' AS decimal(20,0))") \
        + (low / 2).cast("bigint").cast("decimal(19,0)") * F.expr("cast(2 AS decimal(1,0))")
    large = F.concat(F.when(value < 0, "-").otherwise(""), exact.cast("decimal(38,0)").cast("string"))
    return F.when(size < LONG_RANGE, F.rint(value).cast("bigint").cast("string")).when(size < DECIMAL_RANGE, large).otherwise(
        F.format_string("%.0f", value))


def clean_id(value: Column, numeric: bool, floating: bool = False) -> Column:
    """Order id as text: whole digits, ``0`` where it is missing."""
    if numeric:
        shown = whole_number(value) if floating else value.cast("string")
        return F.when(is_blank(value, True, floating), F.lit("0")).otherwise(shown)
    trimmed = F.btrim(value.cast("string"), F.lit(LINE_BLANKS))
    digits = F.regexp_replace(trimmed, r"\.0+$", "")
    return (
        F.when(is_blank(value, False), F.lit("0"))
        .when(digits == "", F.lit("0"))
        .otherwise(digits)
    )


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


#: What a partition's directory shows as a percent sign and two digits, the percent sign first.
ESCAPED = "%\"#'*/:=?\\{[]^\x7f" + "".join(map(chr, range(1, 32)))


def directory_value(value: Column) -> Column:
    """A text as it stands in the name of a partition's directory."""
    for char in ESCAPED:
        value = F.replace(value, F.lit(char), F.lit(f"%{ord(char):02X}"))
    return value


def archive_stem(path: Column) -> Column:
    """File name without its archive suffixes, each tried once, in their order.

    The suffix tried first stands last in the name, hence the reversed pattern.
    """
    tail = "".join(f"({re.escape(suffix)})?" for suffix in reversed(ARCHIVE_SUFFIXES))
    return F.regexp_replace(base_name(path), tail + "$", "")


def archive_stem_of(path: str) -> str:
    """The same rule for one path, for use where a scan is planned."""
    stem = path.rsplit("/", 1)[-1]
    for suffix in ARCHIVE_SUFFIXES:
        stem = stem.removesuffix(suffix)
    return stem


def shard_archive(path: Column) -> Column:
    """Archive a shard file came from: ``<archive>_b<4 digits>.parquet``."""
    stem = F.regexp_replace(base_name(path), r"\.parquet$", "")
    archive = F.regexp_extract(stem, r"^(.*)_b([0-9]{4})$", 1)
    return F.when(stem.rlike(r"^(.*)_b([0-9]{4})$"), archive).otherwise(stem)


def shard_batch(path: Column) -> Column:
    digits = F.regexp_extract(base_name(path), r"^.*_b([0-9]{4})\.parquet$", 1)
    return F.when(digits == "", F.lit(None)).otherwise(digits).cast("int")


def batch_no(record_no: Column, batch_records: int) -> Column:
    """1-based number of the read batch a record falls into."""
    return (F.floor(record_no / F.lit(batch_records)) + 1).cast("int")


def derivative_file_name(trade_date: Column, instrument: Column, symbol: Column, expiry: Column) -> Column:
    return F.format_string("%s_%s_%s_%s.parquet", trade_date, instrument, sanitize_symbol(symbol), expiry.cast("string"))


def cash_file_name(trade_date: Column, symbol: Column, series: Column) -> Column:
    return F.format_string("%s_%s.parquet", trade_date, cash_group_name(symbol, series))


def tape_name(symbol: Column, trade_date: Column) -> Column:
    return F.format_string("TBT_%s_%s", symbol, trade_date)


def to_integer(text: Column) -> Column:
    """Tolerant parse: NULL where the text is not an integer."""
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("bigint"))


def to_integer_strict(text: Column, what: str) -> Column:
    """Strict parse: the query fails on text that is not an integer."""
    complaint = F.concat(F.lit(f"bad {what}: "), F.coalesce(text, F.lit("NULL")))
    return F.coalesce(to_integer(text), F.raise_error(complaint).cast("bigint"))
