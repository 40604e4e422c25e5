import datetime
import random

import pytest

from tickloom.operators import ordering, research
from tickloom.schema import CORE_COLUMNS
from tickloom.sources import listing


def test_aliases_resolve_in_their_order(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], "`Buy-ID` int, BuyOrderID int, Message int, `Type` int, seq_no int")
    assert research.resolve_columns(df).columns == ["buy_id", "buy_order_id", "message", "msg_type", "seq_no"]
    taken = spark.createDataFrame([(1, 2)], "side int, order_side int")
    assert research.resolve_columns(taken).columns == ["side", "order_side"]


def test_core_columns(spark):
    names = [name for name in CORE_COLUMNS if name not in ("stream_id", "token")]
    df = spark.createDataFrame([tuple("1" for _ in names)], ", ".join(f"{name} string" for name in reversed(names)))
    assert research.core_columns(df).columns == list(CORE_COLUMNS)
    with pytest.raises(ValueError, match=r"missing column\(s\): seq_no, price"):
        research.core_columns(df.drop("price", "seq_no"))


def test_blank_flags_are_taken_before_cleaning(spark):
    df = spark.createDataFrame([("nan", None, "5.0")], "order_id string, buy_order_id double, sell_order_id string")
    row = research.clean_ids(df).first()
    assert (row.order_id, row.buy_order_id, row.sell_order_id) == ("0", "0", "5")
    assert (row.order_id_was_na, row.buy_order_id_was_na, row.sell_order_id_was_na) == (True, True, False)


def test_tapes_are_disjoint_and_leave_two_types_out(spark):
    df = spark.createDataFrame([(kind,) for kind in "NMXTCGHJKZ"], "msg_type string")
    assert {r.msg_type for r in research.tape(df, "main").collect()} == set("NMXT")
    assert {r.msg_type for r in research.tape(df, "aux").collect()} == set("GHJK")
    assert {r.msg_type: r.tape for r in research.split_tapes(df).collect()} == {
        **{k: "main" for k in "NMXT"}, **{k: "aux" for k in "GHJK"}}


def test_expiry_selection(spark):
    day = 86_400
    start = 1459348200
    manifest = spark.createDataFrame([(str(start + i * day),) for i in (-9, 0, 7, 0)] + [(str(start + 60),)], "expiry_epoch string")
    assert research.select_expiry(manifest, "20260327") == str(start)
    assert research.select_expiry(manifest, "20260330") == str(start)
    assert research.select_expiry(manifest, "20260331") == str(start + 7 * day)
    assert research.select_expiry(manifest, "20260327", str(start - 9 * day)) == str(start - 9 * day)
    with pytest.raises(ValueError, match="no expiry on or after"):
        research.select_expiry(manifest, "20300101")
    with pytest.raises(ValueError, match="expiry 5 not found"):
        research.select_expiry(manifest, "20260327", "5")
    assert research.front_expiry(manifest, datetime.date(2030, 1, 1)).count() == 0


def test_manifests(spark):
    names = ["/b/20260327_FUTSTK_A_B_1459348200.parquet", "/a/20260327_FUTSTK_A_B_1459348200.parquet",
             "/a/20260327_OPTSTK_C_1.parquet", "/a/20260326_FUTSTK_D_1.parquet", "/a/20260327_X_Y_EQ.parquet",
             "/a/20260327_X_BE.parquet", "/a/x20260327_X_EQ.parquet"]
    files = spark.createDataFrame([(name,) for name in names], "path string")
    futures = listing.parse_derivative_names(files, "20260327")
    assert {(r.symbol, r.expiry_epoch) for r in futures.collect()} == {("A_B", "1459348200")}
    assert listing.first_file_per_symbol(futures, "symbol").first().path == names[1]
    cash = lambda wanted: sorted((r.symbol, r.series) for r in listing.parse_cash_names(files, "20260327", wanted).collect())
    assert cash("EQ") == [("X_Y", "EQ")]
    assert cash("EQ, BE") == [("X", "BE"), ("X_Y", "EQ")]
    assert ("FUTSTK_D", "1") not in cash("ALL") and ("OPTSTK_C", "1") in cash("*")
    with pytest.raises(FileNotFoundError):
        listing.require_rows(listing.parse_cash_names(files, "20260327", "ZZ"), "no cash files")


def tape_rows(count, hot):
    rng = random.Random(3)
    return [("HOT" if rng.random() < hot else f"S{rng.randrange(5)}", None if rng.random() < 0.05 else rng.randrange(20),
             None if rng.random() < 0.05 else rng.randrange(3), f"a{rng.randrange(2)}", i) for i in range(count)]


def expected_order(rows):
    last = lambda value: (value is None, value or 0)
    return sorted(rows, key=lambda r: (r[0], last(r[1]), last(r[2]), r[3], r[4]))


SCHEMA = "symbol string, capture_ns bigint, seq_no int, archive_stem string, record_no bigint"


@pytest.mark.parametrize("hot", [0.0, 0.8])
def test_tape_numbers_match_a_plain_sort(spark, hot):
    rows = tape_rows(2000, hot)
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    got = {(r.symbol, r.tape_no): r.record_no for r in ordering.number_tape(df, "symbol", partitions=6).collect()}
    wanted, place = {}, {}
    for row in expected_order(rows):
        place[row[0]] = place.get(row[0], 0) + 1
        wanted[row[0], place[row[0]]] = row[4]
    assert got == wanted


def test_sorted_tape_spreads_a_hot_symbol(spark):
    rows = tape_rows(4000, 1.0)
    df = ordering.sort_tape(spark.createDataFrame(rows, SCHEMA).repartition(5), "symbol", partitions=8)
    assert [tuple(r) for r in df.collect()] == expected_order(rows)
    sizes = df.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert len(sizes) == 8 and max(sizes) < 1500
