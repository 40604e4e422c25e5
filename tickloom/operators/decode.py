"""From capture lanes to messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions import clock, messages
from tickloom.schema import MESSAGE_COLUMNS, PROVENANCE_COLUMNS, UNREADABLE


def classify(lanes: DataFrame) -> DataFrame:
    """Adds ``msg_type``, ``msg_class`` and ``defect`` to the lanes."""
    code = F.col("msg_type_code")
    typed = lanes.withColumns({"msg_type": messages.msg_type(code), "msg_class": messages.class_of_code(code)})
    rule = messages.defect(
        F.col("pad0"), F.col("pad1"), F.col("msg_class"), F.col("msg_len"),
        messages.min_msg_len_of_code(code), F.col("b20_u8"), F.col("b0_i64"))
    if "record_no" in lanes.columns:
        rule = F.when(F.col("record_no") == UNREADABLE, F.lit("unreadable")).otherwise(rule)
    return typed.withColumn("defect", rule)


def sound_lanes(lanes: DataFrame) -> DataFrame:
    """Records of known type without defects."""
    return lanes.filter(messages.is_sound(*[
        F.col(name) for name in ("pad0", "pad1", "msg_type_code", "msg_len", "b20_u8", "b0_i64")]))


def fail_on_defects(classified: DataFrame) -> DataFrame:
    """The query fails at the first defect, naming its rule and place."""
    place = F.concat_ws(" ", F.lit("defect"), F.col("defect"), F.lit("in"), F.col("archive_stem"),
                        F.lit("record"), F.col("record_no").cast("string"))
    sound = F.when(F.col("defect").isNull(), F.lit(True)).otherwise(F.raise_error(place).cast("boolean"))
    return classified.filter(sound)


def known_types(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("msg_class").isNotNull())


def to_messages(classified: DataFrame, *extra: str) -> DataFrame:
    """Pick every field from the lane its message class stores it in."""
    cls = F.col("msg_class")
    zero, nan = F.lit(0), F.lit(float("nan"))
    fields = {
        "capture_ns": clock.capture_ns(F.col("cap_s"), F.col("cap_ns_part")),
        "exchange_ns": F.when(cls.isin("order", "trade"), clock.exchange_ns(F.col("b0_i64")))
        .otherwise(F.lit(0).cast("bigint")),
        "stream_id": F.col("stream_id"),
        "seq_no": F.col("seq_no"),
        "msg_type": F.col("msg_type"),
        "token": messages.by_class(cls, F.col("b16_i32"), F.col("b24_i32"), zero),
        "side": messages.side(cls, F.col("b20_u8")),
        "order_id": F.when(cls == "order", F.col("b8_f64")).otherwise(nan),
        "buy_order_id": F.when(cls == "trade", F.col("b8_f64")).otherwise(nan),
        "sell_order_id": F.when(cls == "trade", F.col("b16_f64")).otherwise(nan),
        "price": messages.by_class(cls, F.col("b21_i32"), F.col("b28_i32"), F.col("b0_i32")),
        "quantity": messages.by_class(cls, F.col("b25_i32"), F.col("b32_i32"), zero),
    }
    kept = [name for name in PROVENANCE_COLUMNS if name in classified.columns]
    return classified.select(*kept, *[fields[name].alias(name) for name in MESSAGE_COLUMNS], *extra)


def decode(lanes: DataFrame, policy: str = "fail") -> DataFrame:
    """Messages of all records of known type; defects ``fail`` or are dropped."""
    if policy == "drop":
        return to_messages(classify(sound_lanes(lanes)))
    if policy != "fail":
        raise ValueError(f"unknown defect policy: {policy}")
    return to_messages(known_types(fail_on_defects(classify(lanes))))


def unknown_type_counts(classified: DataFrame) -> DataFrame:
    """Records dropped for their type, by code; padding defects come first."""
    unknown = classified.filter(F.col("msg_class").isNull() & F.col("defect").isNull())
    return unknown.groupBy("msg_type_code").agg(F.count("*").alias("rows"))


def type_counts(messages_df: DataFrame) -> DataFrame:
    return messages_df.groupBy("msg_type").agg(F.count("*").alias("rows"))


def archive_profile(classified: DataFrame) -> DataFrame:
    """Records, unknown types, heartbeats and defects per archive, before any lookup."""
    sound = F.col("defect").isNull()
    return classified.groupBy("archive_stem").agg(
        F.count("*").alias("records"),
        F.count_if(sound & F.col("msg_class").isNull()).alias("unknown_types"),
        F.count_if(sound & (F.col("msg_class") == "heartbeat")).alias("heartbeats"),
        F.count("defect").alias("defects"),
    )


def defect_counts(classified: DataFrame, *keys: str) -> DataFrame:
    """Defective records per rule, with the first place each rule broke."""
    return (
        classified.filter(F.col("defect").isNotNull())
        .groupBy(*keys, "defect")
        .agg(F.count("*").alias("rows"), F.min("record_no").alias("first_record_no"))
    )
