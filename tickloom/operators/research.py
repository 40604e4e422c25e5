"""Research export: column resolution, id cleaning, tapes, expiry choice."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType

from tickloom.functions import clock, text
from tickloom.schema import (
    AUX_TAPE_TYPES,
    COLUMN_ALIASES,
    CORE_COLUMNS,
    ID_COLUMNS,
    MAIN_TAPE_TYPES,
    OPTIONAL_CORE_COLUMNS,
)


def resolve_columns(df: DataFrame) -> DataFrame:
    """Clean the column names, then rename the first alias of each missing one."""
    names = [text.clean_column_name(name) for name in df.columns]
    for target, aliases in COLUMN_ALIASES.items():
        if target in names:
            continue
        present = [alias for alias in aliases if alias in names]
        if present:
            names[names.index(present[0])] = target
    return df.toDF(*names)


def missing_columns(df: DataFrame) -> list[str]:
    return [name for name in CORE_COLUMNS if name not in df.columns and name not in OPTIONAL_CORE_COLUMNS]


def core_columns(df: DataFrame, *keys: str) -> DataFrame:
    """The core columns in their fixed order; the optional ones may be absent."""
    missing = missing_columns(df)
    if missing:
        raise ValueError("missing column(s): " + ", ".join(missing))
    kinds = {"stream_id": "smallint", "token": "int"}
    return df.select(*keys, *[
        F.col(name) if name in df.columns else F.lit(None).cast(kinds[name]).alias(name)
        for name in CORE_COLUMNS])


def clean_ids(df: DataFrame) -> DataFrame:
    """Flag missing ids, then turn all ids into text."""
    flags, ids = {}, {}
    for name in ID_COLUMNS:
        kind = df.schema[name].dataType
        number = isinstance(kind, NumericType)
        floating = isinstance(kind, (DoubleType, FloatType))
        flags[f"{name}_was_na"] = text.is_blank(F.col(name), number, floating)
        ids[name] = text.clean_id(F.col(name), number, floating)
    return df.withColumns(flags).withColumns(ids)


def prepare(df: DataFrame, *keys: str) -> DataFrame:
    """Any tick table as a research table."""
    core = core_columns(resolve_columns(df), *keys)
    typed = core.withColumns({name: F.col(name).cast("string") for name in ("msg_type", "side")})
    return clean_ids(typed)


def tape_of(msg_type):
    """``main`` or ``aux``; NULL for types that go to neither tape."""
    return F.when(msg_type.isin(*MAIN_TAPE_TYPES), F.lit("main")).when(
        msg_type.isin(*AUX_TAPE_TYPES), F.lit("aux"))


def tape(df: DataFrame, which: str) -> DataFrame:
    return df.filter(F.col("msg_type").isin(*(MAIN_TAPE_TYPES if which == "main" else AUX_TAPE_TYPES)))


def split_tapes(df: DataFrame) -> DataFrame:
    """Both tapes in one pass, told apart by the column ``tape``."""
    return df.withColumn("tape", tape_of(F.col("msg_type"))).filter("tape IS NOT NULL")


def with_expiry_date(manifest: DataFrame, origin: str = "utc") -> DataFrame:
    return manifest.withColumn("expiry_date", clock.expiry_date(F.col("expiry_epoch"), origin))


def front_expiry(manifest: DataFrame, on_or_after: Column | datetime.date, *keys: str) -> DataFrame:
    """Nearest expiry not before the trade date; ties go to the smaller text."""
    dated = with_expiry_date(manifest).filter(F.col("expiry_date") >= F.lit(on_or_after))
    nearest = F.min(F.struct("expiry_date", "expiry_epoch")).alias("nearest")
    return dated.groupBy(*keys).agg(nearest).filter("nearest IS NOT NULL").select(*keys, "nearest.*")


def select_expiry(manifest: DataFrame, trade_date: str, requested: str = "") -> str:
    """The requested expiry, which must exist, or the front expiry."""
    if requested:
        if manifest.filter(F.col("expiry_epoch") == requested).isEmpty():
            known = [row.expiry_epoch for row in
                     manifest.select("expiry_epoch").distinct().orderBy("expiry_epoch").collect()]
            raise ValueError(f"expiry {requested} not found; available: {', '.join(known)}")
        return requested
    front = front_expiry(manifest, clock.trade_date(F.lit(trade_date))).first()
    if front is None:
        raise ValueError(f"no expiry on or after {trade_date}")
    return front.expiry_epoch
