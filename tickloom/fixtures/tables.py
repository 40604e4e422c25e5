"""Message, contract and file-name tables derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from tickloom.functions.messages import message_class

KINDS = "NMXTCGHJKZ?"
FIRST_EXPIRY = 1459348200
FOUR_WEEKS = 2419200
TRADE_DATE = "20260327"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def micros(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', {name})")
    return F.unix_micros(name)


def token_of(key: str) -> str:
    """Bad, six-digit and five-digit tokens, by turns."""
    k = f"({key} % 1000000000)"
    return f"cast(case when {k}%29=0 then {k} when {k}%3=0 then 100000+{k} else 10000+{k} end as int)"


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """Events as messages before validation, defects and unknown types included.

    Heartbeats keep their token here, so that dropping them has an effect.
    """
    events = table(spark, folder, "events")
    base = events.select("event_id", "user_id", "value", micros(events, "ts").alias("us"))
    rows = base.select(
        F.col("event_id").alias("record_no"),
        F.expr("concat('arc', cast(event_id%4 as string))").alias("archive_stem"),
        F.expr(f"array({', '.join(repr(kind) for kind in KINDS)})[cast(event_id%11 as int)]").alias("msg_type"),
        F.expr("us*1000 + event_id%1000").alias("capture_ns"),
        F.expr("us*1000 + event_id%1000 - 315513000000000000 - 1000000").alias("exch_raw"),
        F.expr("cast(event_id%16 as smallint)").alias("stream_id"),
        F.expr("cast(event_id%2000000000 as int)").alias("seq_no"),
        F.expr(token_of("user_id")).alias("token"),
        F.expr("case when event_id%97=0 then '?' when event_id%2=0 then 'B' else 'S' end").alias("side_byte"),
        F.expr("cast(event_id as double)").alias("id_a"),
        F.expr("cast(event_id+1000000 as double)").alias("id_b"),
        F.expr("cast(floor(value*100) as int)").alias("price"),
        F.expr("cast(1+event_id%500 as int)").alias("quantity"),
        F.expr("cast(case when event_id%101=0 then 0 when event_id%103=0 then 3 else 36 end as smallint)").alias("msg_len"),
        F.expr("cast(case when event_id%499=0 then 1 else 0 end as bigint)").alias("pad0"),
    )
    return rows


def lanes(spark: SparkSession, folder: str) -> DataFrame:
    """The same messages as capture lanes; every lane of a class differs."""
    codes = ", ".join(str(ord(kind)) for kind in KINDS)
    return messages(spark, folder).selectExpr(
        "archive_stem", "record_no",
        "capture_ns div 1000000000 AS cap_s", "pad0",
        "capture_ns % 1000000000 AS cap_ns_part",
        "cast(case when record_no%997=0 then 1 else 0 end as bigint) AS pad1",
        "msg_len", "stream_id", "seq_no",
        f"cast(array({codes})[cast(record_no%11 as int)] as smallint) AS msg_type_code",
        "exch_raw AS b0_i64", "id_a AS b8_f64", "id_b AS b16_f64",
        "cast(record_no%100 as int) AS b0_i32", "token AS b16_i32",
        "cast(case when record_no%97=0 then 63 when record_no%2=0 then 66 else 83 end as smallint) AS b20_u8",
        "case when record_no%11 in (5, 6, 7) then -price else price end AS b21_i32",
        "token+1 AS b24_i32", "quantity AS b25_i32",
        "price+5 AS b28_i32", "quantity+7 AS b32_i32",
    )


def sound_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Messages of known type in the columns of the message table."""
    rows = messages(spark, folder).filter("msg_type <> '?'")
    cls = message_class(F.col("msg_type"))
    nan = F.lit(float("nan"))
    return rows.select(
        "archive_stem", "record_no", "capture_ns",
        F.when(cls == "heartbeat", F.lit(0).cast("bigint")).otherwise(
            F.col("exch_raw") + F.lit(315513000000000000)).alias("exchange_ns"),
        "stream_id", "seq_no", "msg_type", "token",
        F.when((cls == "order") & F.col("side_byte").isin("B", "S"), F.col("side_byte")).otherwise("").alias("side"),
        F.when(cls == "order", F.col("id_a")).otherwise(nan).alias("order_id"),
        F.when(cls == "trade", F.col("id_a")).otherwise(nan).alias("buy_order_id"),
        F.when(cls == "trade", F.col("id_b")).otherwise(nan).alias("sell_order_id"),
        "price", "quantity",
    )


def contract(spark: SparkSession, folder: str) -> DataFrame:
    """Contract entries of all instruments; line order is the customer key."""
    customers = table(spark, folder, "customer")
    return customers.select(
        F.col("c_custkey").alias("line_key"),
        F.expr(token_of("c_custkey")).cast("bigint").alias("token"),
        F.expr("case c_mktsegment when 'BUILDING' then 'FUTSTK' when 'AUTOMOBILE' then 'FUTIDX' "
               "when 'MACHINERY' then 'OPTSTK' when 'HOUSEHOLD' then 'OPTIDX' else 'EQUITY' end").alias("instrument"),
        F.expr("case when c_custkey%23=0 then concat('TEST', cast(c_custkey%5 as string)) "
               "else concat('SYM&', cast(c_custkey%40 as string)) end").alias("symbol"),
        F.expr(f"cast({FIRST_EXPIRY} + (c_nationkey%3)*{FOUR_WEEKS} as bigint)").alias("expiry"),
        F.expr("case c_custkey%4 when 0 then 'BE' when 1 then 'SM' else 'EQ' end").alias("series"),
    )


def contract_with_conflicts(spark: SparkSession, folder: str) -> DataFrame:
    """Contract entries in which many tokens have several meanings."""
    orders = table(spark, folder, "orders")
    return orders.select(
        F.col("o_orderkey").alias("line_key"),
        F.expr("10000 + o_custkey").alias("token"),
        F.col("o_orderpriority").alias("symbol"),
        F.expr(f"cast({FIRST_EXPIRY} + (o_custkey%3)*{FOUR_WEEKS} as bigint)").alias("expiry"),
        F.expr("concat('S', cast(o_orderkey%37 as string))").alias("series"),
    )
