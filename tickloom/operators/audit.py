"""Row ledgers, token checks, roll-ups and cross-checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import text
from tickloom.schema import FO_INSTRUMENTS


def derivative_ledger(attached: DataFrame) -> DataFrame:
    """Rows per archive, expiry and symbol."""
    counted = attached.groupBy("archive_stem", "expiry", "symbol").agg(F.count("*").alias("rows"))
    return counted.select("archive_stem", "expiry", "symbol",
                          text.sanitize_symbol(F.col("symbol")).alias("safe_symbol"), "rows")


def cash_ledger(attached: DataFrame) -> DataFrame:
    """Rows per archive, symbol and series."""
    counted = attached.groupBy("archive_stem", "symbol", "series").agg(F.count("*").alias("rows"))
    return counted.select("archive_stem", "symbol", "series",
                          text.cash_group_name(F.col("symbol"), F.col("series")).alias("safe_name"), "rows")


def pass_fail(test: Column) -> Column:
    return F.when(test, F.lit("PASS")).otherwise(F.lit("FAIL"))


def token_profile(rows: DataFrame, *keys: str) -> DataFrame:
    """Row count and token digit profile per group; tokens have 5 or 6 digits."""
    token = F.col("token")
    return rows.groupBy(*keys).agg(
        F.count("*").alias("row_count"),
        F.count_if((token < 10_000) | (token > 999_999)).alias("bad_tokens"),
        F.count_if(token.between(10_000, 99_999)).alias("five_digit"),
        F.count_if(token.between(100_000, 999_999)).alias("six_digit"),
    ).withColumn("token_check", pass_fail(F.col("bad_tokens") == 0))


def with_status(profile: DataFrame, magic_ok: Column | None = None) -> DataFrame:
    sound = (F.col("row_count") > 0) & (F.col("token_check") == "PASS")
    if magic_ok is not None:
        sound = magic_ok & sound
    return profile.withColumn("status", pass_fail(sound))


def instrument_totals(rows: DataFrame, instruments: tuple[str, ...] = FO_INSTRUMENTS) -> DataFrame:
    """Rows per instrument and in total; instruments without rows show 0.

    Counting comes first, so what is joined to the fixed domain is at most one
    row per instrument.
    """
    counted = rows.groupBy("instrument").agg(F.count("*").alias("rows"))
    domain = rows.sparkSession.range(0, 1, 1, 1).select(
        F.explode(F.array(*[F.lit(name) for name in instruments])).alias("instrument"))
    return (
        domain.join(counted, "instrument", "left")
        .rollup("instrument").agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("rows"))
        .withColumn("instrument", F.coalesce("instrument", F.lit("TOTAL")))
    )


def ledger_total(lines: DataFrame) -> DataFrame:
    """Sum of the last field of each ledger line; headers do not count."""
    last = F.regexp_extract("value", r"([^,]*)$", 1)
    number = text.to_integer(text.strip(F.regexp_replace(last, '^"|"$', "")))
    return lines.agg(F.coalesce(F.sum(number), F.lit(0)).cast("bigint").alias("parser_total"))


def verdict(totals: DataFrame) -> DataFrame:
    """``match``, ``diff``, ``direction`` and ``pct`` of two totals."""
    parser, parquet = F.col("parser_total"), F.col("parquet_total")
    differs = (parser > 0) & (parser != parquet)
    diff = F.abs(parser - parquet)
    return totals.select(
        "*",
        F.when(parser <= 0, "UNKNOWN").when(parser == parquet, "YES").otherwise("NO").alias("match"),
        F.when(differs, diff).alias("diff"),
        F.when(differs & (parquet > parser), "MORE").when(differs, "FEWER").alias("direction"),
        F.when(differs, F.round(diff / parser * 100, 4)).alias("pct"),
    )


def cross_check(ledger: DataFrame, finals: DataFrame, drops: DataFrame, gains: DataFrame) -> DataFrame:
    """Ledger rows against written rows, raw and after the intended drops and the split by instrument.

    The totals are single rows; they are added up rather than joined.
    """
    names = ("parser_total", "parquet_total", "dropped", "gained")

    def part(name: str, total: DataFrame) -> DataFrame:
        return total.select(*[(F.col("n") if name == other else F.lit(0)).cast("bigint").alias(other) for other in names])

    parts = (
        part("parser_total", ledger.agg(F.sum("rows").alias("n")))
        .unionByName(part("parquet_total", finals.agg(F.count("*").alias("n"))))
        .unionByName(part("dropped", drops.agg(F.sum(F.col("dropped_heartbeat") + F.col("dropped_test")).alias("n"))))
        .unionByName(part("gained", gains.agg(F.sum("gained").alias("n"))))
    )
    totals = parts.agg(*[F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name) for name in names])
    checked = verdict(totals).withColumn("expected_total", F.col("parser_total") - F.col("dropped") + F.col("gained"))
    return checked.withColumn("expected_match", F.col("expected_total") == F.col("parquet_total"))


def cross_check_by_key(ledger: DataFrame, finals: DataFrame) -> DataFrame:
    """The same comparison per expiry and symbol, for keys of either side.

    Both sides are counted per key before they meet, so no key is hot.
    """
    left = ledger.groupBy("expiry", "symbol").agg(F.sum("rows").alias("parser_total"))
    right = finals.groupBy("expiry", "symbol").agg(F.count("*").alias("parquet_total"))
    both = left.join(right, ["expiry", "symbol"], "full_outer")
    filled = both.select("expiry", "symbol", *[F.coalesce(name, F.lit(0)).cast("bigint").alias(name)
                                               for name in ("parser_total", "parquet_total")])
    return verdict(filled)


def sanity_report(profile: DataFrame, files: DataFrame, *keys: str) -> DataFrame:
    """Per-key verdict; ``files`` has ``magic_ok`` per file of the key."""
    magic = files.groupBy(*keys).agg(F.bool_and("magic_ok").alias("magic_ok"),
                                     F.count("*").alias("files"))
    joined = magic.join(profile, list(keys), "left").fillna(
        0, ["row_count", "bad_tokens", "five_digit", "six_digit"]).fillna("FAIL", ["token_check"])
    checked = with_status(joined, F.col("magic_ok"))
    return checked.withColumn("magic_bytes", pass_fail(F.col("magic_ok"))).drop("magic_ok")
