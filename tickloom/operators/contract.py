"""Contract metadata: one mapping per token, conflicts and profiles.

Mappings are picked with ``min_by``/``max_by`` aggregates, which combine before
the shuffle, so a token with very many lines never gathers in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.sizing import measure
from tickloom.schema import TOKEN_SLOTS


@dataclass(frozen=True)
class Contract:
    """One row per token, with the size measured when it was checked."""

    rows: DataFrame
    row_count: int
    byte_count: int
    entries: DataFrame


def keep_first(entries: DataFrame, meta: Sequence[str]) -> DataFrame:
    return _pick(entries, meta, F.min_by)


def keep_last(entries: DataFrame, meta: Sequence[str]) -> DataFrame:
    return _pick(entries, meta, F.max_by)


def _pick(entries: DataFrame, meta: Sequence[str], by) -> DataFrame:
    picked = entries.groupBy("token").agg(by(F.struct(*meta), F.col("line_key")).alias("m"))
    return picked.select("token", *[F.col(f"m.{name}").alias(name) for name in meta])


def conflicts(entries: DataFrame, meta: Sequence[str]) -> DataFrame:
    """Tokens that map to more than one meaning."""
    return (
        entries.groupBy("token", *meta).agg(F.count("*").alias("lines"))
        .groupBy("token").agg(F.count("*").alias("mappings"), F.sum("lines").alias("lines"))
        .filter("mappings > 1")
    )


def usable_tokens(entries: DataFrame) -> DataFrame:
    """Only tokens a message lookup can hit: 0 up to the number of slots."""
    return entries.filter((F.col("token") >= 0) & (F.col("token") < TOKEN_SLOTS))


def resolve(entries: DataFrame, meta: Sequence[str], on_conflict: str = "error",
            also: Sequence[str] = ()) -> Contract:
    """Checked mapping token -> ``meta``.

    ``on_conflict`` is ``error``, ``first`` or ``last``. ``also`` names columns
    that come along as the set of all values seen for the token; their domain
    must be small and fixed, as that of the instruments is.
    """
    if on_conflict == "error":
        clash = conflicts(entries, meta).orderBy("token").first()
        if clash is not None:
            raise ValueError(f"token {clash.token} maps inconsistently ({clash.mappings} ways)")
    by = F.max_by if on_conflict == "last" else F.min_by
    usable = usable_tokens(entries)
    picked = usable.groupBy("token").agg(
        by(F.struct(*meta), F.col("line_key")).alias("m"),
        *[F.collect_set(name).alias(f"{name}s") for name in also],
    )
    rows = picked.select(
        F.col("token").cast("int").alias("token"),
        *[F.col(f"m.{name}").alias(name) for name in meta],
        *[f"{name}s" for name in also],
    )
    size = measure(rows)
    if size[0] == 0 and entries.isEmpty():
        raise ValueError("no contract lines of the wanted instruments")
    return Contract(rows, *size, entries)


def tokens_per_instrument(entries: DataFrame) -> DataFrame:
    return entries.groupBy("instrument").agg(F.count_distinct("token").alias("tokens"))


def expiry_profile(entries: DataFrame) -> DataFrame:
    """Distinct tokens and symbols per expiry."""
    return entries.groupBy("expiry").agg(
        F.count_distinct("token").alias("tokens"), F.count_distinct("symbol").alias("symbols"))


def top_series(entries: DataFrame, limit: int = 10) -> DataFrame:
    """Series with most accepted lines, shown by name.

    A line is accepted when it agrees with the token's first mapping. Equal
    counts go to the series seen first.
    """
    grouped = entries.groupBy("token", "symbol", "series").agg(
        F.count("*").alias("lines"), F.min("line_key").alias("line_key"))
    accepted = grouped.groupBy("token").agg(
        F.min_by(F.struct("series", "lines"), "line_key").alias("m"), F.min("line_key").alias("line_key"))
    return (
        accepted.groupBy("m.series")
        .agg(F.sum("m.lines").alias("tokens"), F.min("line_key").alias("line_key"))
        .orderBy(F.desc("tokens"), "line_key").limit(limit)
        .select("series", "tokens").orderBy("series")
    )
