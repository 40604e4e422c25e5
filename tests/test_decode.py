import os

import pytest
import wire

from tickloom.operators import decode
from tickloom.sources import capture, listing


def lanes_of(spark, folder, *records):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/a.cap", "wb") as out:
        out.write(b"".join(records))
    return capture.read_capture(spark, listing.list_files(spark, folder))


def defects(lanes):
    return [row.defect for row in decode.classify(lanes).orderBy("record_no").collect()]


def test_rules_apply_in_order(spark, folder):
    lanes = lanes_of(
        spark, folder,
        wire.record(), wire.record(pad0=1, pad1=1), wire.record(pad1=1), wire.record(kind="?", pad0=9),
        wire.record(kind="?", msg_len=0), wire.record(msg_len=0), wire.record(msg_len=-5), wire.record(side="Q"),
        wire.record(kind="T", side="Q"), wire.record(msg_len=28, side="Q"), wire.record(ts=2**63 - 1))
    assert defects(lanes) == [None, "pad0", "pad1", "pad0", None, "msg_len", "msg_len", "side", None, "short_body",
                              "exchange_time"]
    assert decode.decode(lanes, "drop").count() == 2
    counts = {row.defect: (row.rows, row.first_record_no) for row in decode.defect_counts(decode.classify(lanes)).collect()}
    assert counts["pad0"] == (2, 1) and counts["msg_len"] == (2, 5)
    assert [tuple(r) for r in decode.unknown_type_counts(decode.classify(lanes)).collect()] == [(ord("?"), 1)]


@pytest.mark.parametrize("kinds, least", [("NMXGHJ", 29), ("TCK", 36), ("Z", 4)])
def test_least_length_of_each_type(spark, folder, kinds, least):
    lanes = lanes_of(spark, folder, *[wire.record(kind=k, msg_len=n) for k in kinds for n in (least - 1, least, least + 1)])
    assert defects(lanes) == ["short_body", None, None] * len(kinds)
    assert decode.decode(lanes, "drop").count() == 2 * len(kinds)


def test_fail_policy_names_rule_and_place(spark, folder):
    lanes = lanes_of(spark, folder, wire.record(), wire.record(side="?"))
    with pytest.raises(Exception, match="defect side in a record 1"):
        decode.decode(lanes).count()
    with pytest.raises(ValueError):
        decode.decode(lanes, "other")


def test_every_byte_has_a_class_or_none(spark, folder):
    lanes = lanes_of(spark, folder, *[wire.record().replace(b"\x24\x00", b"\x24\x00")[:34] + bytes([code]) + b"\0" * 20 + b"B" + b"\0" * 16
                                      for code in range(256)])
    known = {r.msg_type_code: r.msg_class for r in decode.classify(lanes).filter("msg_class IS NOT NULL").collect()}
    assert {chr(code) for code in known} == set("NMXTCGHJKZ")
    assert {chr(c) for c, name in known.items() if name == "trade"} == set("TCK")


def test_type_counts(spark, folder):
    lanes = lanes_of(spark, folder, *[wire.record(kind=k) for k in "NNTZZZ?"])
    assert {r.msg_type: r.rows for r in decode.type_counts(decode.decode(lanes)).collect()} == {"N": 2, "T": 1, "Z": 3}
