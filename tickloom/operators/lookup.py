"""Message -> contract joins and the filters around them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.contract import Contract
from tickloom.operators.sizing import BROADCAST_BYTES
from tickloom.schema import FO_INSTRUMENTS, HEARTBEAT_TYPE, PROVENANCE_COLUMNS, TEST_PREFIX, TOKEN_SLOTS

SALTS = 64


def attach(messages: DataFrame, contract: Contract, how: str = "inner",
           broadcast_bytes: int = BROADCAST_BYTES, salts: int = SALTS) -> DataFrame:
    """Join messages to the contract on ``token``.

    The contract holds one row per token below a million; when its measured
    size is under ``broadcast_bytes`` it is broadcast and the messages stay
    where they are. Otherwise both sides are shuffled, and every token is
    spread over ``salts`` parts so that a hot one does not fill one task. The
    part follows from the record's place, so a repeated task repeats it.
    """
    if contract.byte_count <= broadcast_bytes:
        return messages.join(F.broadcast(contract.rows), "token", how)
    place = [name for name in PROVENANCE_COLUMNS if name in messages.columns] or messages.columns
    spread = F.pmod(F.xxhash64(*place), F.lit(salts)).cast("int")
    if how == "inner":
        messages = messages.filter(F.col("token").between(0, TOKEN_SLOTS - 1))
    copies = contract.rows.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    joined = messages.withColumn("salt", spread).join(copies.hint("shuffle_hash"), ["token", "salt"], how)
    return joined.drop("salt")


def coverage(messages: DataFrame, contract: Contract, *keys: str) -> DataFrame:
    """Messages with a known and with an unknown token."""
    known = F.col("symbol").isNotNull()
    return attach(messages, contract, "left").groupBy(*keys).agg(
        F.count_if(known).alias("known_tokens"), F.count_if(~known).alias("unknown_tokens"))


def is_heartbeat():
    return F.col("msg_type") == HEARTBEAT_TYPE


def is_test():
    return F.col("symbol").startswith(TEST_PREFIX)


def drop_heartbeats(messages: DataFrame) -> DataFrame:
    return messages.filter(~is_heartbeat())


def drop_test_symbols(messages: DataFrame, drop_test: bool = True) -> DataFrame:
    return messages.filter(~is_test()) if drop_test else messages


def keep_instruments(rows: DataFrame, instruments: tuple[str, ...] = FO_INSTRUMENTS) -> DataFrame:
    return rows.filter(F.col("instrument").isin(*instruments))


def split_by_instrument(attached: DataFrame) -> DataFrame:
    """One row per matching instrument; a token of two instruments gives two."""
    return attached.withColumn("instrument", F.explode("instruments")).drop("instruments")


def split_gain(attached: DataFrame) -> DataFrame:
    """Rows that splitting by instrument adds to those kept: one row, ``gained``."""
    kept = ~is_heartbeat() & ~is_test()
    return attached.agg(F.coalesce(F.sum(F.when(kept, F.size("instruments") - 1)), F.lit(0)).cast("bigint").alias("gained"))


def drop_counts(attached: DataFrame, *keys: str) -> DataFrame:
    """Heartbeats dropped, then TEST rows dropped from what is left."""
    return attached.groupBy(*keys).agg(
        F.count_if(is_heartbeat()).alias("dropped_heartbeat"),
        F.count_if(~is_heartbeat() & is_test()).alias("dropped_test"),
        F.count("*").alias("rows_before"),
    )
