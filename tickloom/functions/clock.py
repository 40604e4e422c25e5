"""Capture, exchange and expiry clocks."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.schema import (
    EXCHANGE_EPOCH_NS,
    INDIA_OFFSET_SECONDS,
    NANOS,
    SECONDS_1970_TO_1980,
)

SECONDS_PER_DAY = 86_400
UNIX_DAY_ZERO = datetime.date(1970, 1, 1)


def capture_ns(seconds: Column, nanos: Column) -> Column:
    """Capture time in nanoseconds since 1970; unsigned seconds arrive widened."""
    return seconds.cast("bigint") * F.lit(NANOS) + nanos.cast("bigint")


def exchange_ns(raw: Column) -> Column:
    """Exchange time in nanoseconds since 1970, NULL where it leaves 64 bits."""
    return F.try_add(raw, F.lit(EXCHANGE_EPOCH_NS).cast("bigint"))


def expiry_seconds(expiry: Column, origin: str = "utc") -> Column:
    """Expiry epoch (seconds since 1980-01-01) as seconds since 1970.

    ``origin`` names the midnight the epoch counts from: ``utc`` for the rule
    of the research export, ``ist`` for the rule of the exchange clock.
    """
    shift = {"utc": 0, "ist": INDIA_OFFSET_SECONDS}[origin]
    return expiry.cast("bigint") + F.lit(SECONDS_1970_TO_1980 - shift)


def expiry_date(expiry: Column, origin: str = "utc") -> Column:
    """Calendar date of the expiry in India.

    India has kept UTC+5:30 since 1945, so day arithmetic is exact and does not
    depend on the session time zone.
    """
    local = expiry_seconds(expiry, origin) + F.lit(INDIA_OFFSET_SECONDS)
    day = F.floor(local / F.lit(SECONDS_PER_DAY)).cast("int")
    return F.date_add(F.lit(UNIX_DAY_ZERO), day)


def trade_date(text: Column) -> Column:
    return F.to_date(text, "yyyyMMdd")
