"""Measured sizes, and broadcasts that depend on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 128 << 20


def measure(df: DataFrame) -> tuple[int, int]:
    """Row count and an upper estimate of the bytes in memory."""
    width = F.lit(32)
    for name, kind in df.dtypes:
        if kind == "string":
            width = width + F.coalesce(F.octet_length(name), F.lit(0)) + 16
        elif kind.startswith("array"):
            width = width + 32 * F.size(name)
        else:
            width = width + 8
    found = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b")).first()
    return found.n, found.b


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast a materialised side under the limit; leave it to shuffle above."""
    return F.broadcast(df) if measure(df)[1] <= limit else df
