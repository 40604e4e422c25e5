import os

import pandas
import pytest
import wire
from pyspark.sql import functions as F

from tickloom.operators import contract, resume
from tickloom.plans import export, ingest, sinks
from tickloom.sources import listing
from tickloom.streaming import captures, shards

DAY = "20260327"


def fo_contract(spark):
    rows = [(1, 45_001, "FUTSTK", "A&B", 5), (2, 45_002, "OPTIDX", "IDX", 6), (3, 45_003, "FUTSTK", "TEST1", 5)]
    entries = spark.createDataFrame(rows, "line_key bigint, token bigint, instrument string, symbol string, expiry bigint")
    return contract.resolve(entries, ("symbol", "expiry"), also=("instrument",))


def cm_contract(spark):
    entries = spark.createDataFrame([(1, 45_001, "BANK", "EQ"), (2, 45_002, "BANK", "BE")],
                                    "line_key bigint, token bigint, symbol string, series string")
    return contract.resolve(entries, ("symbol", "series"), "first")


def capture_of(*records):
    return b"".join(records)


def orders(*tokens, **fields):
    return capture_of(*[wire.record(token=t, seq=i, cap_ns=100 - i, **fields) for i, t in enumerate(tokens)])


def archives(spark, path, glob="*.cap.tar.xz"):
    return listing.discover_archives(spark, path, glob)


def add(path, name, data):
    os.makedirs(path, exist_ok=True)
    wire.archive(f"{path}/{name}.cap.tar.xz", c__cap=data)


def statuses(spark, work, segment=ingest.FO):
    rows = spark.read.parquet(f"{segment.place(work)}/status").collect()
    return {r.archive_stem: (r.rows, r.defects, r.status) for r in rows}


def test_derivative_ingest_resumes(spark, folder):
    add(f"{folder}/in", "e1", orders(45_001, 45_002, 45_003, 9))
    add(f"{folder}/in", "e2", orders(9, 9))
    con, work = fo_contract(spark), f"{folder}/work"
    first = ingest.ingest(spark, archives(spark, f"{folder}/in"), con, work)
    assert {(r.archive_stem, r.rows, r.status) for r in first.collect()} == {("e1", 3, "done"), ("e2", 0, "done")}
    assert ingest.ingest(spark, archives(spark, f"{folder}/in"), con, work).count() == 0
    add(f"{folder}/in", "e3", orders(45_001))
    again = ingest.ingest(spark, archives(spark, f"{folder}/in"), con, work)
    assert [r.archive_stem for r in again.collect()] == ["e3"]
    finals = ingest.finalize_derivatives(spark, work, DAY)
    assert sorted((r.instrument, r.symbol, r.expiry) for r in finals.collect()) == [
        ("FUTSTK", "A&B", 5), ("FUTSTK", "A&B", 5), ("OPTIDX", "IDX", 6)]
    assert ingest.finalize_derivatives(spark, work, DAY).count() == 3
    ledger = spark.read.parquet(f"{work}/fo/ledger").groupBy("symbol").agg(F.sum("rows").alias("n")).collect()
    assert {r.symbol: r.n for r in ledger} == {"A&B": 2, "IDX": 1, "TEST1": 1}
    restarted = ingest.ingest(spark, archives(spark, f"{folder}/in"), con, work, clean_start=True)
    assert restarted.count() == 3 and ingest.finalize_derivatives(spark, work, DAY).count() == 3
    only = archives(spark, f"{folder}/in").filter("archive_stem = 'e3'")
    assert ingest.ingest(spark, only, con, work, clean_start=True).count() == 1
    assert [r.symbol for r in ingest.finalize_derivatives(spark, work, DAY).collect()] == ["A&B"]
    assert set(statuses(spark, work)) == {"e3"} and ingest.sound_ledger(spark, work, ingest.FO).count() == 1


def test_derivative_ingest_stops_at_a_defect(spark, folder):
    add(f"{folder}/in", "bad", capture_of(wire.record(token=45_001), wire.record(token=45_001, side="?")))
    work = f"{folder}/work"
    with pytest.raises(Exception, match="defect side in bad record 1"):
        ingest.ingest(spark, archives(spark, f"{folder}/in"), fo_contract(spark), work)
    assert statuses(spark, work) == {"bad": (1, 1, "failed")}
    add(f"{folder}/in", "good", orders(45_001))
    with pytest.raises(Exception, match="defect side in bad record 1"):
        ingest.ingest(spark, archives(spark, f"{folder}/in"), fo_contract(spark), work)
    assert statuses(spark, work) == {"bad": (1, 1, "failed"), "good": (1, 0, "done")}
    assert ingest.finalize_derivatives(spark, work, DAY).count() == 1
    add(f"{folder}/in", "bad", orders(9))
    redone = ingest.ingest(spark, archives(spark, f"{folder}/in"), fo_contract(spark), work)
    assert [(r.archive_stem, r.rows, r.status) for r in redone.collect()] == [("bad", 0, "done")]
    assert ingest.sound_shards(spark, work, ingest.FO).count() == 1


def test_cash_ingest_leaves_failed_archives_out(spark, folder):
    add(f"{folder}/in", "e_16641", orders(45_001, 45_002, 45_002))
    add(f"{folder}/in", "e_16642", capture_of(wire.record(token=45_001), wire.record(token=9, msg_len=0)))
    add(f"{folder}/in", "e_16643", orders(45_001))
    with open(f"{folder}/in/e_16643.cap.tar.xz", "r+b") as handle:
        handle.truncate(40)
    work = f"{folder}/work"
    found = archives(spark, f"{folder}/in", ingest.CM.glob)
    ingest.ingest(spark, found, cm_contract(spark), work, ingest.CM)
    assert statuses(spark, work, ingest.CM) == {"e_16641": (3, 0, "done"), "e_16642": (1, 1, "failed"), "e_16643": (0, 1, "failed")}
    finals = ingest.finalize_cash(spark, work, DAY)
    assert {(r.symbol, r.series): r["count"] for r in finals.groupBy("symbol", "series").count().collect()} == {
        ("BANK", "EQ"): 1, ("BANK", "BE"): 2}
    add(f"{folder}/in", "e_16642", orders(45_001))
    redone = ingest.ingest(spark, found, cm_contract(spark), work, ingest.CM)
    assert {(r.archive_stem, r.status) for r in redone.collect()} == {("e_16642", "done"), ("e_16643", "failed")}
    assert ingest.finalize_cash(spark, work, DAY).count() == 4


def test_publish_waits_for_the_audit(spark, folder):
    add(f"{folder}/in", "e1", orders(45_001, 45_002))
    work, target = f"{folder}/work", f"{folder}/shared"
    ingest.ingest(spark, archives(spark, f"{folder}/in"), fo_contract(spark), work)
    ingest.finalize_derivatives(spark, work, DAY)
    assert ingest.publish(spark, work, DAY, target)
    shared = spark.read.schema(ingest.DERIVATIVE_DDL).parquet(target)
    assert {r.instrument for r in shared.collect()} == {"FUTSTK"}
    assert os.path.isdir(f"{work}/audit/{DAY}/cross_check")
    add(f"{folder}/in", "e2", orders(45_001))
    ingest.ingest(spark, archives(spark, f"{folder}/in"), fo_contract(spark), work)
    assert not ingest.publish(spark, work, DAY, f"{folder}/other")
    assert not os.path.exists(f"{folder}/other")
    assert not ingest.publish(spark, work, DAY, f"{folder}/other", publish_on_fail=True)
    assert os.path.exists(f"{folder}/other")


def test_captures_are_taken_up_as_they_arrive(spark, folder):
    con, work, state = fo_contract(spark), f"{folder}/work", f"{folder}/state"
    add(f"{folder}/in", "e1", orders(45_001))
    captures.run_available(spark, f"{folder}/in", con, work, state)
    captures.run_available(spark, f"{folder}/in", con, work, state)
    assert statuses(spark, work) == {"e1": (1, 0, "done")}
    add(f"{folder}/in", "e2", orders(45_001, 45_002))
    add(f"{folder}/in", "e2_16641", orders(45_001))
    captures.run_available(spark, f"{folder}/in", con, work, state)
    assert statuses(spark, work) == {"e1": (1, 0, "done"), "e2": (2, 0, "done")}


def test_shard_stream_adds_only_what_is_new(spark, folder):
    con = fo_contract(spark)
    add(f"{folder}/in", "e1", orders(45_001, 45_003))
    ingest.ingest(spark, archives(spark, f"{folder}/in"), con, f"{folder}/work")
    take = lambda: shards.run_available(spark, f"{folder}/work", f"{folder}/final", f"{folder}/state", DAY)
    count = lambda: spark.read.schema(ingest.DERIVATIVE_DDL).parquet(f"{folder}/final").count()
    take()
    take()
    assert count() == 1
    add(f"{folder}/in", "e2", orders(45_001, 45_002))
    ingest.ingest(spark, archives(spark, f"{folder}/in"), con, f"{folder}/work")
    take()
    assert count() == 3


def research_input(spark):
    rows = [("A", "EQ", k, i, 100 - i, float(i)) for i, k in enumerate("NMXTCGHJKZ")] + [("B", "EQ", "G", 50, 1, None)]
    df = spark.createDataFrame(rows, "symbol string, series string, msg_type string, seq_no int, capture_ns bigint, order_id double")
    blank = {name: F.lit(None).cast("double") for name in ("buy_order_id", "sell_order_id")}
    return df.withColumns({**blank, "exchange_ns": F.lit(1), "side": F.lit(""), "price": F.lit(1), "quantity": F.lit(2)})


def test_export_writes_sorted_tapes_once(spark, folder):
    keys = ["symbol", "series"]
    first = export.export_tapes(spark, research_input(spark), folder, DAY, keys)
    assert {(r.symbol, r.rows, r.status) for r in first.collect()} == {("A", 4, "written"), ("B", 0, "written")}
    tapes = spark.read.parquet(f"{folder}/tapes")
    main = [r.msg_type for r in tapes.filter("tape = 'main' AND symbol = 'A'").collect()]
    assert main == ["T", "X", "M", "N"]
    assert tapes.filter("tape = 'aux'").count() == 5
    again = export.export_tapes(spark, research_input(spark), folder, DAY, keys)
    assert {(r.symbol, r.rows, r.status) for r in again.collect()} == {("A", None, "exists"), ("B", None, "exists")}
    more = research_input(spark).unionByName(research_input(spark).filter("symbol = 'B'").withColumn("symbol", F.lit("C")))
    third = export.export_tapes(spark, more, folder, DAY, keys)
    assert {(r.symbol, r.status) for r in third.collect()} == {("A", "exists"), ("B", "exists"), ("C", "written")}
    over = export.export_tapes(spark, more, folder, DAY, keys, overwrite=True)
    assert {(r.symbol, r.rows, r.status) for r in over.collect()} == {("A", 4, "written"), ("B", 0, "written"), ("C", 0, "written")}
    assert spark.read.parquet(f"{folder}/tapes").count() == 10
    assert spark.read.parquet(f"{folder}/summary").count() == 3
    moved = research_input(spark).filter("symbol = 'B'").withColumn("msg_type", F.lit("N"))
    export.export_tapes(spark, moved, folder, DAY, keys, overwrite=True)
    left = spark.read.parquet(f"{folder}/tapes")
    assert {(r.symbol, r.tape): r["count"] for r in left.groupBy("symbol", "tape").count().collect()} == {
        ("A", "main"): 4, ("A", "aux"): 4, ("B", "main"): 1, ("C", "aux"): 1}
    assert {(r.symbol, r.rows) for r in spark.read.parquet(f"{folder}/summary").collect()} == {("A", 4), ("B", 1), ("C", 0)}


def test_resume_from_shard_names(spark):
    done = resume.completed_archives(spark.createDataFrame([("/s/5/A/e1_b0001.parquet",), ("/s/5/A/e1_b0002.parquet",)], "path string"))
    todo = spark.createDataFrame([("e1",), ("e2",)], "archive_stem string")
    assert [r.archive_stem for r in resume.remaining_archives(todo, done).collect()] == ["e2"]


def test_unreadable_shards_fail_unless_skipped(spark, folder):
    add(f"{folder}/in", "e1", orders(45_001, 45_002))
    add(f"{folder}/in", "e2", orders(45_001))
    work = f"{folder}/work"
    ingest.ingest(spark, archives(spark, f"{folder}/in"), fo_contract(spark), work)
    place = f"{work}/fo/rows/kind=shard/archive_stem=e2"
    victim, = [name for name in os.listdir(place) if name.endswith(".parquet")]
    os.remove(f"{place}/.{victim}.crc")
    with open(f"{place}/{victim}", "r+b") as handle:
        handle.truncate(30)
    with pytest.raises(Exception):
        ingest.sound_shards(spark, work, ingest.FO).collect()
    kept = ingest.sound_shards(spark, work, ingest.FO, skip_unreadable=True)
    assert {r.archive_stem for r in kept.collect()} == {"e1"}


def test_publishable(spark):
    df = spark.createDataFrame([("FUTSTK",), ("OPTIDX",), ("OPTSTK",)], "instrument string")
    assert [r.instrument for r in sinks.publishable(df).collect()] == ["FUTSTK"]
    assert sinks.publishable(df, ()).count() == 3


def test_written_tapes_stay_sorted_and_spread(spark, folder):
    rows = spark.range(0, 200_000, 1, 6).selectExpr(
        "case when id%3=0 then concat('S', id%50) else 'HOT' end AS symbol", "element_at(array('N','T','G'), cast(id%3 as int)+1) AS msg_type",
        "cast(id*7919%100003 as bigint) AS capture_ns", "cast(id%11 as int) AS seq_no", "'a' AS archive_stem", "id AS record_no",
        "1 AS exchange_ns", "'' AS side", "1 AS price", "1 AS quantity", "1D AS order_id", "1D AS buy_order_id", "1D AS sell_order_id")
    export.export_tapes(spark, rows, folder, DAY, ["symbol"])
    root = f"{folder}/tapes/trade_date={DAY}/tape=main/symbol=HOT"
    files = sorted(name for name in os.listdir(root) if name.endswith(".parquet"))
    assert len(files) > 1
    got = []
    for name in files:
        got += [tuple(r) for r in spark.read.parquet(f"{root}/{name}").select("capture_ns", "seq_no", "record_no").toLocalIterator()]
    assert got == sorted(got) and len(got) == rows.filter("symbol = 'HOT' AND msg_type = 'T'").count()


def test_parsed_records_add_up(spark, folder):
    from tickloom.operators import decode, lookup
    from tickloom.sources import capture
    os.makedirs(folder)
    with open(f"{folder}/a.cap", "wb") as out:
        out.write(capture_of(*[wire.record(kind=k, token=t) for k in "NTZ?GX" for t in (45_001, 9, 45_003)]))
    classified = decode.classify(capture.read_capture(spark, listing.list_files(spark, folder)))
    profile = decode.archive_profile(classified).first()
    tokens = lookup.coverage(decode.to_messages(decode.known_types(classified)), fo_contract(spark), "archive_stem").first()
    assert profile.records == tokens.known_tokens + tokens.unknown_tokens + profile.unknown_types == 18
    assert (profile.unknown_types, profile.heartbeats, profile.defects) == (3, 3, 0)
    assert tokens.known_tokens == 8


def tick_file(spark, path, *kinds, capture_ns=5):
    rows = [(capture_ns, 1, i, kind, "", float(i), None, None, 100, 5) for i, kind in enumerate(kinds)]
    df = spark.createDataFrame(rows, "capture_ns bigint, exchange_ns bigint, seqno int, msg_type string, side string, order_id double, "
                                     "buy_order_id double, sell_order_id double, price int, qty int")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    df.toPandas().to_parquet(path)


def test_export_of_derivative_files(spark, folder):
    front, later = "1459348200", "1461767400"
    tick_file(spark, f"{folder}/in/A/{DAY}_FUTSTK_A_{front}.parquet", *"NMTGC")
    tick_file(spark, f"{folder}/in/B C+é/{DAY}_FUTSTK_B_C_{front}.parquet", *"NG")
    tick_file(spark, f"{folder}/in/A/{DAY}_FUTSTK_A_{later}.parquet", *"NNNNNN")
    tick_file(spark, f"{folder}/in/D/{DAY}_FUTSTK_D_{front}.parquet", "N")
    with open(f"{folder}/in/D/{DAY}_FUTSTK_D_{front}.parquet", "r+b") as handle:
        handle.truncate(50)
    out = f"{folder}/out"
    got = export.export_derivative_files(spark, f"{folder}/in", out, DAY)
    assert {(r.symbol, r.rows, r.status) for r in got.collect()} == {
        ("A", 3, "written"), ("B_C", 1, "written"), ("D", None, "error")}
    tape = spark.read.parquet(f"{out}/tapes").filter("symbol = 'A' AND tape = 'main'").collect()
    assert [(r.seq_no, r.order_id, r.quantity, r.token) for r in tape] == [(0, "0", 5, None), (1, "1", 5, None), (2, "2", 5, None)]
    again = export.export_derivative_files(spark, f"{folder}/in", out, DAY, symbols="A, D")
    assert {(r.symbol, r.status) for r in again.collect()} == {("A", "exists"), ("D", "error")}
    other = export.export_derivative_files(spark, f"{folder}/in", f"{folder}/out2", DAY, expiry=later)
    assert {(r.symbol, r.rows) for r in other.collect()} == {("A", 6)}
    assert spark.read.option("header", True).csv(f"{out}/extract_futstk_summary_{DAY}").count() == 2
    with pytest.raises(FileNotFoundError):
        export.export_derivative_files(spark, f"{folder}/in", out, "20260101")
    with pytest.raises(ValueError, match="not found"):
        export.export_derivative_files(spark, f"{folder}/in", out, DAY, expiry="7")


def test_export_resolves_the_columns_of_each_file(spark, folder):
    front = "1459348200"
    for symbol, names in {"A": {}, "B": {"capture_ns": "capture_time_ns", "seqno": "seq_no"}, "C": {"qty": "quantity"}, "D": {"price": "cost"}}.items():
        path = f"{folder}/in/{symbol}/{DAY}_FUTSTK_{symbol}_{front}.parquet"
        tick_file(spark, path, *"NTG")
        pandas.read_parquet(path).rename(columns=names).to_parquet(path)
    got = {r.symbol: r for r in export.export_derivative_files(spark, f"{folder}/in", f"{folder}/out", DAY).collect()}
    assert {s: (r.rows, r.status) for s, r in got.items()} == {
        "A": (2, "written"), "B": (2, "written"), "C": (2, "written"), "D": (None, "error")}
    assert all(os.path.isdir(got[s].path.removeprefix("file:")) and f"tape=main/symbol={s}" in got[s].path for s in "ABC")
    rows = spark.read.parquet(f"{folder}/out/tapes").filter("tape = 'main'").collect()
    assert {(r.symbol, r.capture_ns, r.quantity) for r in rows} == {(s, 5, 5) for s in "ABC"}


def test_export_of_cash_files(spark, folder):
    for name in ("X_EQ", "X_BE", "Y_EQ"):
        tick_file(spark, f"{folder}/in/{DAY}_{name}.parquet", *"NTK")
    got = export.export_cash_files(spark, f"{folder}/in", f"{folder}/out", DAY)
    assert {(r.symbol, r.series, r.rows) for r in got.collect()} == {("X", "EQ", 2), ("Y", "EQ", 2)}
    every = export.export_cash_files(spark, f"{folder}/in", f"{folder}/out", DAY, series="ALL", symbols="X")
    assert {(r.symbol, r.series, r.status) for r in every.collect()} == {("X", "EQ", "exists"), ("X", "BE", "written")}


def test_cash_audit(spark, folder):
    add(f"{folder}/in", "e_16641", orders(45_001, 45_002, 45_002))
    add(f"{folder}/in", "e_16642", capture_of(wire.record(token=45_001), wire.record(token=9, pad0=1)))
    work = f"{folder}/work"
    ingest.ingest(spark, archives(spark, f"{folder}/in", ingest.CM.glob), cm_contract(spark), work, ingest.CM)
    ingest.finalize_cash(spark, work, DAY)
    assert {(r.safe_name, r.rows) for r in ingest.audit_cash(spark, work, DAY).collect()} == {("BANK_EQ", 1), ("BANK_BE", 2)}
    ingest.publish_cash(spark, work, DAY, f"{folder}/shared")
    assert spark.read.schema(ingest.CASH_DDL).parquet(f"{folder}/shared").count() == 3


def test_hot_group_is_written_by_many_tasks(spark, folder):
    # As on a cluster: more shuffle partitions than groups, so that groups rarely share one.
    wanted = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k", "spark.sql.shuffle.partitions": "200"}
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        rows = spark.range(0, 200_000, 1, 16).selectExpr(
            f"'{DAY}' AS trade_date", "'FUTSTK' AS instrument", "case when id%3=0 then concat('S', id%20) else 'HOT' end AS symbol",
            "5 AS expiry", "id AS record_no", "hash(id) AS price")
        sinks.write_derivatives(rows, folder)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    count = lambda symbol: len([n for n in os.listdir(f"{folder}/trade_date={DAY}/instrument=FUTSTK/symbol={symbol}/expiry=5")
                                if n.endswith(".parquet")])
    assert count("HOT") > 3 and count("S1") <= 2
    assert spark.read.parquet(folder).count() == 200_000
