"""Versions of a day, footers, commit groups, profiles and quarantine, on written files."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import wire
from pyspark.sql import functions as F
from test_jobs import DAY, add, archives, capture_of, fo_contract, orders, statuses

from tickloom.plans import days, ingest
from tickloom.sources import capture, footers, listing

SCHEMA = "price INT, symbol STRING, trade_date STRING"
KEYS = ("symbol",)


def day(spark, *prices, symbol="A&B"):
    return spark.createDataFrame([(price, symbol, DAY) for price in prices], SCHEMA)


def prices(spark, folder):
    return sorted(row.price for row in days.read_day(spark, folder, DAY, SCHEMA).collect())


def broken(spark):
    price = F.when(F.col("price") > 1, F.raise_error(F.lit("lost"))).otherwise(F.col("price")).cast("int")
    return day(spark, 1, 2, 3).repartition(3).withColumn("price", price)


def versions(folder):
    return sorted(name for name in os.listdir(f"{folder}/trade_date={DAY}"))


def test_a_day_is_swapped_as_a_whole(spark, folder):
    assert days.read_day(spark, folder, DAY, SCHEMA).count() == 0
    assert days.current_folder(folder, DAY) is None
    first = days.replace_day(day(spark, 1, 2), folder, DAY, KEYS, "zstd")
    assert prices(spark, folder) == [1, 2]
    assert [(row.symbol, row.trade_date) for row in days.read_day(spark, folder, DAY, SCHEMA).collect()] == [("A&B", DAY)] * 2
    with pytest.raises(Exception, match="lost"):
        days.replace_day(broken(spark), folder, DAY, KEYS, "zstd")
    assert prices(spark, folder) == [1, 2] and versions(folder) == [f"version={first}"]
    second = days.replace_day(day(spark, 3, symbol="C"), folder, DAY, KEYS, "zstd")
    assert prices(spark, folder) == [3] and days.history(folder, DAY) == [first, second]
    days.replace_day(day(spark, 4), folder, DAY, KEYS, "zstd")
    assert prices(spark, folder) == [4] and first not in str(versions(folder)) and len(versions(folder)) == 2


def test_a_query_begun_before_the_swap_keeps_its_rows(spark, folder):
    days.replace_day(day(spark, 1), folder, DAY, KEYS, "zstd")
    begun = days.read_day(spark, folder, DAY, SCHEMA)
    days.replace_day(day(spark, 2), folder, DAY, KEYS, "zstd")
    assert [row.price for row in begun.collect()] == [1]


def test_lost_versions_are_swept(spark, folder):
    """What a driver leaves that dies between the write and the swap is not read, and goes when asked."""
    kept = days.replace_day(day(spark, 1), folder, DAY, KEYS, "zstd")
    day(spark, 9).drop("trade_date").write.partitionBy("symbol").parquet(days.version_folder(folder, DAY, "lost"))
    assert prices(spark, folder) == [1]
    assert days.sweep(spark, folder, DAY) == ["lost"]
    assert versions(folder) == [f"version={kept}"] and prices(spark, folder) == [1]


def test_an_empty_day_replaces_a_full_one(spark, folder):
    days.replace_day(day(spark, 1), folder, DAY, KEYS, "zstd")
    days.replace_day(day(spark).limit(0), folder, DAY, KEYS, "zstd")
    assert days.read_day(spark, folder, DAY, SCHEMA).count() == 0


def test_footers(spark, folder):
    os.makedirs(f"{folder}/k=a%26b")
    pq.write_table(pa.table({"x": [1, 2, 3]}), f"{folder}/k=a%26b/1.parquet")
    pq.write_table(pa.table({"x": [4]}), f"{folder}/k=a%26b/2.parquet")
    files = listing.list_files(spark, folder, "*.parquet", recursive=True)
    assert [tuple(row) for row in footers.footer_counts(files, "k").collect()] == [("a&b", 4, 2)]
    with open(f"{folder}/k=a%26b/3.parquet", "wb") as out:
        out.write(b"PAR1 but nothing else")
    files = listing.list_files(spark, folder, "*.parquet", recursive=True)
    found = {os.path.basename(row.path): (row.rows, row.problem is None) for row in footers.with_footer(files).collect()}
    assert found == {"1.parquet": (3, True), "2.parquet": (1, True), "3.parquet": (None, False)}
    with pytest.raises(Exception, match="3.parquet"):
        footers.footer_counts(files, "k").collect()


def test_commit_groups():
    class Row:
        def __init__(self, stem, length):
            self.archive_stem, self.path, self.length = stem, stem, length

    rows = [Row(f"a{i:03d}", 10) for i in range(25)]
    groups = ingest.commit_groups(list(reversed(rows)), 40)
    assert [len(group) for group in groups] == [4] * 6 + [1]
    assert [row for group in groups for row in group] == rows
    assert [len(group) for group in ingest.commit_groups(rows, 1)] == [1] * 25
    assert len(ingest.commit_groups(rows, 10**9)) == 1


def test_a_lost_run_repeats_its_last_group_only(spark, folder):
    for name in ("e1", "e2", "e3", "e4"):
        add(f"{folder}/in", name, orders(45_001, 45_002))
    found, work = archives(spark, f"{folder}/in"), f"{folder}/work"
    with open(f"{folder}/in/e3.cap.tar.xz", "wb") as out:
        out.write(b"no archive" * 100)
    with pytest.raises(Exception):
        ingest.ingest(spark, found, fo_contract(spark), work, group_bytes=1, unreadable="fail")
    assert statuses(spark, work) == {"e1": (2, 0, "done"), "e2": (2, 0, "done")}
    before = {name: os.path.getmtime(f"{work}/fo/status/archive_stem={name}") for name in ("e1", "e2")}
    add(f"{folder}/in", "e3", orders(45_001))
    again = ingest.ingest(spark, archives(spark, f"{folder}/in"), fo_contract(spark), work, group_bytes=1, unreadable="fail")
    assert {(row.archive_stem, row.rows) for row in again.collect()} == {("e3", 1), ("e4", 2)}
    assert before == {name: os.path.getmtime(f"{work}/fo/status/archive_stem={name}") for name in ("e1", "e2")}


def test_profile_and_quarantine(spark, folder):
    rows = [wire.record(kind=kind, token=token, seq=i) for i, (kind, token) in enumerate([("N", 45_001), ("T", 9), ("Z", 1), ("?", 1), ("N", 9)])]
    bad = [wire.record(token=45_001, side="?"), wire.record(token=9, pad0=1), wire.record(kind="T", msg_len=30)]
    add(f"{folder}/in", "e1", capture_of(*rows) + b"torn")
    add(f"{folder}/in", "e2", capture_of(*bad, rows[0]))
    with open(f"{folder}/in/e3.cap.tar.xz", "wb") as out:
        out.write(b"no archive" * 100)
    work = f"{folder}/work"
    with pytest.raises(RuntimeError, match="defect side in e2 record 0"):
        ingest.ingest(spark, archives(spark, f"{folder}/in"), fo_contract(spark), work)
    seen, = ingest.read_profile(spark, work, ingest.FO).collect()
    assert {name: getattr(seen, name) for name in ("archives", "records", "unknown_types", "heartbeats", "known_tokens", "unknown_tokens",
                                                   "defect_side", "defect_pad0", "defect_short_body", "defect_unreadable", "torn_records", "torn_bytes")} == {
        "archives": 3, "records": 9, "unknown_types": 1, "heartbeats": 1, "known_tokens": 2, "unknown_tokens": 3,
        "defect_side": 1, "defect_pad0": 1, "defect_short_body": 1, "defect_unreadable": 1, "torn_records": 1, "torn_bytes": 4}
    put_aside = {(row.archive_stem, row.record_no, row.defect) for row in ingest.quarantine(spark, ingest.FO.place(work)).collect()}
    assert put_aside == {("e2", 0, "side"), ("e2", 1, "pad0"), ("e2", 2, "short_body"), ("e3", -1, "unreadable")}
    assert {(row.archive_stem, row.batch) for row in ingest.shards(spark, ingest.FO.place(work), ingest.FO).collect()} == {("e1", 1), ("e2", 1)}
    status = {row.archive_stem: row.torn_bytes for row in spark.read.parquet(f"{work}/fo/status").collect()}
    assert status == {"e1": 4, "e2": 0, "e3": 0}


def test_the_writing_pass_scans_once(spark, folder):
    add(f"{folder}/in", "e1", orders(45_001))
    lanes = capture.read_capture(spark, archives(spark, f"{folder}/in"))
    plan = ingest.shard_rows(lanes, fo_contract(spark), ingest.Profile())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BatchScan") == 1 and plan.count("CollectMetrics") == 2
    # Whatever is exchanged is the contract's; the records' side of the join is the scan and what is computed of it.
    assert "Exchange" not in plan.partition("BroadcastHashJoin")[2].partition("BroadcastExchange")[0]


def test_small_captures_share_tasks():
    files = [(f"/c/{i:05d}.cap", 72 * 1000) for i in range(10_000)]
    sized = [(split, split.count * 72) for split in capture.plan_splits(files, 256 << 20, 100_000)]
    tasks = capture.bundles(sized, 256 << 20, 100_000, 8)
    cost = sum(size + capture.OPEN_BYTES for _, size in sized)
    assert len(tasks) <= 2 * cost / (256 << 20)
    assert sorted(split.path for task in tasks for split in getattr(task, "splits", [task])) == sorted(path for path, _ in files)
    # Few and small: no more to a task than all cores have to do.
    assert len(capture.bundles(sized[:16], 256 << 20, 100_000, 8)) >= 8
    large = [(capture.CaptureSplit("/l.cap", i, 10), 256 << 20) for i in range(5)]
    assert len(capture.bundles(large + sized[:3], 256 << 20, 100_000, 1)) == 6


@pytest.mark.parametrize("form", ["plain", "whole", "blocks"])
@pytest.mark.parametrize("torn", [0, 1, 71])
def test_torn_records(spark, folder, form, torn):
    os.makedirs(folder)
    data = orders(*[45_001] * 40) + b"\x01" * torn
    if form == "plain":
        with open(f"{folder}/a.cap", "wb") as out:
            out.write(data)
    elif form == "whole":
        wire.archive(f"{folder}/a.cap.tar.xz", notes__txt=b"x" * 700, a__cap=data)
    else:
        wire.blocked_archive(f"{folder}/a.cap.tar.xz", 300, notes__txt=b"x" * 700, a__cap=data)
    found, = capture.torn_records(listing.list_files(spark, folder)).collect()
    assert (found.archive_stem, found.form, found.records, found.torn_bytes, found.problem) == ("a", form, 40, torn, None)


def test_torn_records_of_what_cannot_be_read(spark, folder):
    os.makedirs(folder)
    with open(f"{folder}/a.cap.tar.xz", "wb") as out:
        out.write(b"no archive")
    wire.archive(f"{folder}/b.cap.tar.xz", b__txt=b"no capture")
    files = listing.list_files(spark, folder)
    marked = {row.archive_stem: (row.records, row.torn_bytes, bool(row.problem)) for row in capture.torn_records(files, "mark").collect()}
    assert marked == {"a": (None, None, True), "b": (None, None, True)}
    with pytest.raises(Exception):
        capture.torn_records(files).collect()
