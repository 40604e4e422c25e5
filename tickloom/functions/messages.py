"""Message class, type-dispatched fields and record defects.

Types are compared as the byte codes they have on the wire. Class and least
length come from small constant tables indexed by that letter, which keeps the
expressions short wherever the optimizer repeats them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.schema import EXCHANGE_EPOCH_NS, HEARTBEAT_TYPE, MIN_MSG_LEN, ORDER_TYPES, TRADE_TYPES

CLASSES = {"order": ORDER_TYPES, "trade": TRADE_TYPES, "heartbeat": (HEARTBEAT_TYPE,)}
CLASS_OF = {kind: name for name, kinds in CLASSES.items() for kind in kinds}
LETTERS = [chr(code) for code in range(ord("A"), ord("Z") + 1)]
SIDE_BYTES = (ord("B"), ord("S"))
LAST_EXCHANGE_RAW = 2**63 - 1 - EXCHANGE_EPOCH_NS


def _by_letter(code: Column, value_of) -> Column:
    """A value per type letter; NULL for unknown letters and other bytes."""
    shown = ", ".join("NULL" if value is None else repr(value)
                      for value in (value_of(CLASS_OF.get(letter)) for letter in LETTERS))
    return F.get(F.expr(f"array({shown})"), code.cast("int") - ord("A"))


def msg_type(code: Column) -> Column:
    return F.char(code.cast("int"))


def class_of_code(code: Column) -> Column:
    """``order``, ``trade`` or ``heartbeat``; NULL for an unknown type."""
    return _by_letter(code, lambda name: name)


def message_class(kind: Column) -> Column:
    """The class of a type given as a character."""
    return class_of_code(F.ascii(kind))


def min_msg_len_of_code(code: Column) -> Column:
    return _by_letter(code, MIN_MSG_LEN.get)


def by_class(cls: Column, order: Column, trade: Column, other: Column) -> Column:
    return F.when(cls == "order", order).when(cls == "trade", trade).otherwise(other)


def min_msg_len(cls: Column) -> Column:
    return by_class(cls, *[F.lit(MIN_MSG_LEN[name]) for name in ("order", "trade", "heartbeat")])


def side(cls: Column, side_byte: Column) -> Column:
    return (
        F.when((cls == "order") & (side_byte == SIDE_BYTES[0]), F.lit("B"))
        .when((cls == "order") & (side_byte == SIDE_BYTES[1]), F.lit("S"))
        .otherwise(F.lit(""))
    )


def is_sound(pad0: Column, pad1: Column, code: Column, msg_len: Column, side_byte: Column,
             exchange_raw: Column) -> Column:
    """Of known type and without any defect, as one flat condition."""
    cls = class_of_code(code)
    return (
        (pad0 == 0) & (pad1 == 0) & (msg_len >= min_msg_len_of_code(code))
        & ((cls != "order") | side_byte.isin(*SIDE_BYTES))
        & ((cls == "heartbeat") | (exchange_raw <= LAST_EXCHANGE_RAW))
    )


def defect(pad0: Column, pad1: Column, cls: Column, msg_len: Column, least: Column, side_byte: Column,
           exchange_raw: Column) -> Column:
    """First rule a record breaks, NULL when it is sound.

    Padding is checked before the type, so a record of unknown type can still
    have a padding defect; the other rules apply to known types only.
    """
    return (
        F.when(pad0 != 0, F.lit("pad0"))
        .when(pad1 != 0, F.lit("pad1"))
        .when(cls.isNull(), F.lit(None).cast("string"))
        .when(msg_len <= 0, F.lit("msg_len"))
        .when(msg_len < least, F.lit("short_body"))
        .when((cls == "order") & ~side_byte.isin(*SIDE_BYTES), F.lit("side"))
        .when((cls != "heartbeat") & (exchange_raw > LAST_EXCHANGE_RAW), F.lit("exchange_time"))
    )
