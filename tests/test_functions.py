import datetime
import os

import pytest
from pyspark.sql import functions as F

from tickloom.functions import clock, text


def values(spark, column, kind, items):
    df = spark.createDataFrame([(i, item) for i, item in enumerate(items)], f"i INT, x {kind}")
    return [row.y for row in df.orderBy("i").select(column(F.col("x")).alias("y")).collect()]


def test_sanitize_symbol(spark):
    assert values(spark, text.sanitize_symbol, "string", ["M&M-A.B_ É9", "A B", "क1/2"]) == ["M_M-A.B__É9", "A_B", "क1_2"]


def test_archive_stem_strips_each_suffix_once_in_order(spark):
    names = ["/d/efvi_1.cap.tar.xz", "x.tar.gz", "x.cap", "x.cap.cap", "x.tgz", "x.tar.bz2.tar.xz",
             "x.tar.xz.tar.gz", "plain", "x.cap.gz"]
    wanted = ["efvi_1", "x", "x", "x.cap", "x", "x", "x.tar.xz", "plain", "x.cap.gz"]
    assert values(spark, text.archive_stem, "string", names) == wanted
    assert [text.archive_stem_of(name) for name in names] == wanted


def test_shard_names(spark):
    names = ["/s/arc_b0012.parquet", "arc_b_b0001.parquet", "arc_b12.parquet", "arc.parquet"]
    assert values(spark, text.shard_archive, "string", names) == ["arc", "arc_b", "arc_b12", "arc"]
    assert values(spark, text.shard_batch, "string", names) == [12, 1, None, None]


def test_clean_id_of_floats(spark):
    nan = float("nan")
    got = values(spark, lambda c: text.clean_id(c, True, True), "double", [nan, None, 1300000000000123.0, 0.0, 2.5, 3.5, -7.0])
    assert got == ["0", "0", "1300000000000123", "0", "2", "4", "-7"]
    assert values(spark, lambda c: text.is_blank(c, True, True), "double", [nan, None, 1.0]) == [True, True, False]


def test_clean_id_of_text(spark):
    items = [" 12.000 ", "NaN", " null", "", None, ".0", "7", "1.50", "NA", "\t9\r\n"]
    assert values(spark, lambda c: text.clean_id(c, False), "string", items) == [
        "12", "0", "0", "0", "0", "0", "7", "1.50", "0", "9"]
    assert values(spark, lambda c: text.is_blank(c, False), "string", items) == [
        False, True, True, True, True, False, False, False, True, False]


def test_integers(spark):
    assert values(spark, text.to_integer, "string", ["12", "-3", "1.5", "x", "", None]) == [12, -3, None, None, None, None]
    with pytest.raises(Exception, match="bad token: x"):
        values(spark, lambda c: text.to_integer_strict(c, "token"), "string", ["1", "x"])


def test_expiry_date_does_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", name)
            assert values(spark, clock.expiry_date, "bigint", [1459348200, 0]) == [
                datetime.date(2026, 3, 30), datetime.date(1980, 1, 1)]
            assert values(spark, lambda c: clock.expiry_seconds(c, "ist"), "bigint", [1459348200]) == [1774861200]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_file_names(spark):
    df = spark.createDataFrame([("20260327", "FUTSTK", "M&M", 1459348200, "EQ")], "d string, i string, s string, e bigint, r string")
    row = df.select(
        text.derivative_file_name(F.col("d"), F.col("i"), F.col("s"), F.col("e")).alias("a"),
        text.cash_file_name(F.col("d"), F.col("s"), F.col("r")).alias("b"),
        text.tape_name(F.col("s"), F.col("d")).alias("c")).first()
    assert tuple(row) == ("20260327_FUTSTK_M_M_1459348200.parquet", "20260327_M_M_EQ.parquet", "TBT_M&M_20260327")


def test_whole_numbers_have_all_their_digits(spark):
    numbers = [0.5, 1.5, 2.0**63, -(2.0**63), 1e22, 1e23, -1.7e30, 9.9e37, 9.3e18, 9223372036854774784.0]
    assert values(spark, text.whole_number, "double", numbers) == [f"{number:.0f}" for number in numbers]


def test_directory_values_are_those_of_a_written_table(spark, folder):
    names = ["plain", "a%b", "c=d/e:f", "x y&z+é", "q?[w]^{v}", "t\tn'\"#*\\", "h\x7f"]
    spark.createDataFrame([(name, 1) for name in names], "k string, x int").write.partitionBy("k").parquet(folder)
    shown = values(spark, text.directory_value, "string", names)
    assert sorted(f"k={name}" for name in shown) == sorted(name for name in os.listdir(folder) if name.startswith("k="))
