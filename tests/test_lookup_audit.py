import os

import pytest
from pyspark.sql import functions as F

from tickloom.fixtures import tables
from tickloom.operators import audit, contract, lookup, sizes
from tickloom.plans import catalog
from tickloom.sources import listing

SF = "/root/testdata/sf0.01"


def found(spark, rows):
    entries = spark.createDataFrame(rows, "line_key bigint, token bigint, instrument string, symbol string, expiry bigint")
    return contract.resolve(entries, ("symbol", "expiry"), "first", also=("instrument",))


def messages(spark, rows):
    return spark.createDataFrame(rows, "record_no bigint, msg_type string, token int")


def test_hot_token_joins_alike_both_ways(spark):
    rows = [(i, "N", 7 if i % 3 else i % 50) for i in range(3000)] + [(9000, "N", -1), (9001, "N", 2_000_000), (9002, "N", None)]
    con = found(spark, [(i, i, "FUTSTK", f"S{i}", 5) for i in range(0, 50, 2)] + [(99, 7, "FUTIDX", "HOT", 6)])
    msgs = messages(spark, rows)
    broadcast = lookup.attach(msgs, con)
    shuffled = lookup.attach(msgs, con, broadcast_bytes=0, salts=8)
    assert "BroadcastHashJoin" in broadcast._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in shuffled._jdf.queryExecution().executedPlan().toString()
    key = lambda df: sorted((r.record_no, r.token, r.symbol, r.expiry) for r in df.collect())
    assert key(broadcast) == key(shuffled) and len(key(broadcast)) > 2000
    left = lookup.attach(msgs, con, "left", broadcast_bytes=0)
    assert left.count() == len(rows)


def test_split_filters_and_drop_counts(spark):
    con = found(spark, [(1, 1, "FUTSTK", "A", 5), (2, 1, "OPTSTK", "A", 5), (3, 2, "FUTIDX", "TESTX", 5)])
    attached = lookup.attach(messages(spark, [(1, "N", 1), (2, "Z", 1), (3, "T", 2), (4, "Z", 2), (5, "N", 3)]), con)
    counts = lookup.drop_counts(attached).first()
    assert tuple(counts) == (2, 1, 4)
    kept = lookup.split_by_instrument(lookup.drop_test_symbols(lookup.drop_heartbeats(attached)))
    assert sorted((r.record_no, r.instrument) for r in kept.collect()) == [(1, "FUTSTK"), (1, "OPTSTK")]
    assert lookup.drop_test_symbols(attached, drop_test=False).count() == 4


def test_check_values_of_the_fixture(spark):
    rows = tables.sound_messages(spark, SF)
    split = lookup.split_by_instrument(lookup.attach(rows, catalog.fo_contract(spark, SF)))
    got = {r.instrument: (r.n, r.z, r.t, r.low) for r in split.groupBy("instrument").agg(
        F.count("*").alias("n"), F.count_if(lookup.is_heartbeat()).alias("z"),
        F.count_if(lookup.is_test()).alias("t"), F.count_if(F.col("token") < 10000).alias("low")).collect()}
    assert got == {"FUTIDX": (1630, 153, 59, 126), "FUTSTK": (2071, 214, 64, 0),
                   "OPTIDX": (2077, 210, 110, 106), "OPTSTK": (1618, 168, 121, 110)}


@pytest.mark.parametrize("parser, parquet, wanted", [
    (0, 5, ("UNKNOWN", None, None, None)), (5, 5, ("YES", None, None, None)),
    (8, 10, ("NO", 2, "MORE", 25.0)), (3, 2, ("NO", 1, "FEWER", 33.3333))])
def test_verdict(spark, parser, parquet, wanted):
    row = audit.verdict(spark.createDataFrame([(parser, parquet)], "parser_total bigint, parquet_total bigint")).first()
    assert (row.match, row.diff, row.direction, row.pct) == wanted


def test_ledger_total_ignores_headers_and_bad_numbers(spark, folder):
    os.makedirs(folder)
    with open(f"{folder}/l.csv", "w") as out:
        out.write("archive_stem,expiry,symbol,safe_symbol,rows\na,1,S,S,10\n\na,1,S,S, 5 \na,1,S,S,x\nb,1,S,S,-2\n")
    assert audit.ledger_total(spark.read.text(folder)).first().parser_total == 13


def test_token_profile_edges(spark):
    df = spark.createDataFrame([(t,) for t in (9_999, 10_000, 99_999, 100_000, 999_999, 1_000_000)], "token int")
    row = audit.with_status(audit.token_profile(df)).first()
    assert (row.row_count, row.bad_tokens, row.five_digit, row.six_digit, row.status) == (6, 2, 2, 2, "FAIL")


def test_totals_show_instruments_without_rows(spark):
    df = spark.createDataFrame([("FUTSTK",)] * 3 + [("OPTIDX",)], "instrument string")
    assert {r.instrument: r.rows for r in audit.instrument_totals(df).collect()} == {
        "FUTSTK": 3, "FUTIDX": 0, "OPTSTK": 0, "OPTIDX": 1, "TOTAL": 4}


def test_sanity_report_of_a_damaged_file(spark, folder):
    rows = spark.createDataFrame([("A", 45_000), ("B", 45_001), ("C", 7)], "symbol string, token int")
    rows.repartition(1).write.partitionBy("symbol").parquet(folder)
    files = listing.list_files(spark, folder, "*.parquet", recursive=True)
    broken = [r.path for r in files.collect() if "symbol=B" in r.path][0].removeprefix("file:")
    with open(broken, "r+b") as handle:
        handle.truncate(20)
    magic = sizes.with_layout(listing.with_magic(files), "symbol")
    sound = [r.path for r in magic.filter("magic_ok").collect()]
    profile = audit.token_profile(spark.read.option("basePath", folder).parquet(*sound), "symbol")
    report = {r.symbol: (r.magic_bytes, r.row_count, r.token_check, r.status)
              for r in audit.sanity_report(profile, magic, "symbol").collect()}
    assert report == {"A": ("PASS", 1, "PASS", "PASS"), "B": ("FAIL", 0, "FAIL", "FAIL"), "C": ("PASS", 1, "FAIL", "FAIL")}


def test_codec_saving_needs_both_sides(spark):
    old = spark.createDataFrame([(100, True), (50, False)], "length bigint, magic_ok boolean")
    new = spark.createDataFrame([(25,)], "length bigint")
    row = sizes.codec_saving(old, new).first()
    assert (row.old_bytes, row.new_bytes, row.saving_pct) == (100, 25, 75.0)
    assert sizes.codec_saving(old.filter("NOT magic_ok"), new).isEmpty()
    report = sizes.compression_report(new.limit(0), new).first()
    assert (report.input_bytes, report.ratio) == (0, 0.0)
