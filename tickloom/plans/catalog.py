"""Every operator as a query over the driver's tables: name -> (spark, folder)."""

from __future__ import annotations

import datetime
import re
from collections.abc import Callable
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.fixtures import tables
from tickloom.fixtures.capture_files import write_capture
from tickloom.fixtures.named_files import write_files
from tickloom.functions import clock, messages, text
from tickloom.operators import audit, decode, lookup, ordering, research, resume, sizes
from tickloom.operators import contract as contracts
from tickloom.operators.contract import Contract
from tickloom.plans import days, export, ingest, sinks
from tickloom.schema import FO_ARCHIVE_GLOB, FO_INSTRUMENTS, ID_COLUMNS, MESSAGE_COLUMNS
from tickloom.session import checkpointed, work_folder
from tickloom.sources import capture, contracts as contract_files, footers, listing
from tickloom.sources.files import filesystem_of
from tickloom.streaming import shards as shard_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TRADE_DATE = tables.TRADE_DATE
TRADE_DAY = datetime.datetime.strptime(TRADE_DATE, "%Y%m%d").date()


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


# --- shared inputs -------------------------------------------------------------


def fo_contract(spark: SparkSession, folder: str) -> Contract:
    entries = tables.contract(spark, folder).filter(F.col("instrument").isin(*FO_INSTRUMENTS))
    return contracts.resolve(entries, ("symbol", "expiry"), "first", also=("instrument",))


def cm_contract(spark: SparkSession, folder: str) -> Contract:
    entries = tables.contract(spark, folder).filter("instrument = 'EQUITY'")
    return contracts.resolve(entries, ("symbol", "series"), "first")


def fo_attached(spark: SparkSession, folder: str) -> DataFrame:
    return lookup.attach(tables.sound_messages(spark, folder), fo_contract(spark, folder))


def cm_attached(spark: SparkSession, folder: str) -> DataFrame:
    return lookup.attach(tables.sound_messages(spark, folder), cm_contract(spark, folder))


def fo_final(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.derivative_rows(fo_attached(spark, folder), TRADE_DATE)


def shown_ids(df: DataFrame) -> DataFrame:
    """Ids as text, so that a missing id compares as a value."""
    return df.withColumns({
        name: F.when(F.isnan(name), F.lit("NaN")).otherwise(text.whole_number(F.col(name)))
        for name in ID_COLUMNS})


# --- decoding and validation ---------------------------------------------------


@query
def decode_messages(spark, folder):
    return shown_ids(decode.decode(tables.lanes(spark, folder), "drop"))


@query
def msg_type_counts(spark, folder):
    return decode.type_counts(decode.decode(tables.lanes(spark, folder), "drop"))


@query
def unknown_types(spark, folder):
    return decode.unknown_type_counts(decode.classify(tables.lanes(spark, folder)))


@query
def message_class_profile(spark, folder):
    cls = messages.message_class(F.col("msg_type"))
    rows = tables.messages(spark, folder).withColumn("msg_class", F.coalesce(cls, F.lit("unknown")))
    return rows.groupBy("msg_class").agg(
        F.count("*").alias("rows"), F.min("msg_len").alias("shortest"),
        F.min(messages.min_msg_len(F.col("msg_class"))).alias("required"))


@query
def defect_report(spark, folder):
    return decode.defect_counts(decode.classify(tables.lanes(spark, folder)))


@query
def defects_by_archive(spark, folder):
    return decode.defect_counts(decode.classify(tables.lanes(spark, folder)), "archive_stem")


@query
def archive_profile(spark, folder):
    return decode.archive_profile(decode.classify(tables.lanes(spark, folder)))


@query
def token_coverage(spark, folder):
    rows = decode.decode(tables.lanes(spark, folder), "drop")
    return lookup.coverage(rows, fo_contract(spark, folder), "archive_stem")


@query
def read_batches(spark, folder):
    batch = text.batch_no(F.col("record_no"), 1000)
    return tables.lanes(spark, folder).select(batch.alias("batch"), "seq_no").groupBy("batch").agg(
        F.count("*").alias("records"), F.max("seq_no").alias("last_seq_no"))


# --- lookups and splits ----------------------------------------------------------


@query
def token_lookup(spark, folder):
    return fo_attached(spark, folder).select(
        "record_no", "archive_stem", "msg_type", "token", "symbol", "expiry")


@query
def token_lookup_shuffled(spark, folder):
    """The same join the way it goes when the contract is too large to broadcast."""
    rows = tables.sound_messages(spark, folder)
    return lookup.attach(rows, fo_contract(spark, folder), broadcast_bytes=0).select(
        "record_no", "archive_stem", "msg_type", "token", "symbol", "expiry")


@query
def instrument_split_counts(spark, folder):
    split = lookup.split_by_instrument(fo_attached(spark, folder))
    return split.groupBy("instrument").agg(
        F.count("*").alias("rows"), F.count_if(lookup.is_heartbeat()).alias("heartbeats"),
        F.count_if(lookup.is_test()).alias("test_rows"))


@query
def instrument_split_rows(spark, folder):
    return fo_final(spark, folder).select("record_no", "instrument", "symbol", "expiry", "msg_type")


@query
def instrument_subset(spark, folder):
    return lookup.keep_instruments(fo_final(spark, folder), ("FUTSTK",)).groupBy("symbol").agg(
        F.count("*").alias("rows"))


@query
def drop_counts(spark, folder):
    return lookup.drop_counts(fo_attached(spark, folder), "expiry")


@query
def cm_lookup_counts(spark, folder):
    rows = cm_attached(spark, folder).withColumn(
        "safe_name", text.cash_group_name(F.col("symbol"), F.col("series")))
    return rows.groupBy("safe_name").agg(F.count("*").alias("rows"))


@query
def cm_series_filter(spark, folder):
    return listing.keep_listed(cm_attached(spark, folder), "series", "EQ, BE").groupBy("symbol", "series").agg(
        F.count("*").alias("rows"))


@query
def publish_filter(spark, folder):
    return sinks.publishable(fo_final(spark, folder)).groupBy("instrument", "symbol").agg(
        F.count("*").alias("rows"))


# --- contracts -------------------------------------------------------------------


@query
def contract_keep_first(spark, folder):
    return contracts.keep_first(tables.contract_with_conflicts(spark, folder), ("symbol", "expiry"))


@query
def contract_keep_last(spark, folder):
    return contracts.keep_last(tables.contract_with_conflicts(spark, folder), ("symbol", "expiry"))


@query
def contract_conflicts(spark, folder):
    return contracts.conflicts(tables.contract_with_conflicts(spark, folder), ("symbol", "expiry"))


@query
def contract_profile(spark, folder):
    return contracts.tokens_per_instrument(tables.contract(spark, folder))


@query
def contract_expiry_profile(spark, folder):
    return contracts.expiry_profile(tables.contract(spark, folder))


@query
def top_series(spark, folder):
    return contracts.top_series(tables.contract_with_conflicts(spark, folder))


@query
def contract_fo_file(spark, folder):
    """Contract lines written as a file, then read with its loader."""
    path = work_folder(spark, "contract")
    lines = tables.contract(spark, folder).selectExpr(
        "case when line_key%50=7 then concat_ws(',', 'C', '1', token, instrument, symbol) "
        "else concat_ws(',', 'C', '1', concat(' ', token, ' '), instrument, concat(symbol, ' '), expiry, 'x') end AS value")
    lines.write.text(path)
    parsed = contract_files.parse_fo_lines(contract_files.numbered_lines(spark, path))
    return parsed.select("token", "instrument", "symbol", "expiry")


@query
def contract_cm_file(spark, folder):
    path = work_folder(spark, "contract")
    lines = tables.contract(spark, folder).selectExpr(
        "concat_ws(',', 'C', '1', case when line_key%50=7 then 'bad' else cast(token as string) end, "
        "instrument, concat(' ', symbol), '0', '0', series) AS value")
    lines.write.text(path)
    return contract_files.parse_cm_lines(contract_files.numbered_lines(spark, path)).select(
        "token", "symbol", "series")


def written_lines(lines: DataFrame, *first: str) -> str:
    """Contract lines (line_key, value) in their order, below the given first lines: files of a folder, one after another by name."""
    spark, path = lines.sparkSession, work_folder(lines.sparkSession, "contract")
    above = [(at - len(first), value) for at, value in enumerate(first)]
    if above:
        lines = spark.createDataFrame(above, "line_key BIGINT, value STRING").unionByName(lines.select("line_key", "value"))
    lines.orderBy("line_key").select("value").write.text(path)
    return path


def fo_lines(spark: SparkSession, folder: str) -> DataFrame:
    return tables.contract_with_conflicts(spark, folder).selectExpr(
        "line_key", "element_at(array('FUTSTK', 'FUTIDX', 'OPTSTK', 'OPTIDX', 'EQUITY'), cast(line_key%5 as int)+1) AS instrument",
        "concat_ws(',', 'C', '1', concat(' ', token), element_at(array('FUTSTK', 'FUTIDX', 'OPTSTK', 'OPTIDX', 'EQUITY'), cast(line_key%5 as int)+1), "
        "concat(symbol, ' '), expiry, 'x') AS value")


@query
def contract_fo_read(spark, folder):
    """A derivatives contract file with conflicts, by each policy that takes it."""
    path = written_lines(fo_lines(spark, folder), "token file,1,2,FUTSTK,A,5")
    return reduce(DataFrame.unionByName, [
        contract_files.read_fo_contract(spark, path, on_conflict=policy).rows.select(
            F.lit(policy).alias("policy"), "token", "symbol", "expiry", F.array_join(F.array_sort("instruments"), ",").alias("instruments"))
        for policy in ("first", "last")])


@query
def contract_cm_read(spark, folder):
    """A cash contract file whose first line is a number, and one that begins with an entry: only the former loses it."""
    lines = tables.contract_with_conflicts(spark, folder).selectExpr(
        "line_key", "concat_ws(',', 'C', '1', token, case when line_key%3=0 then 'EQUITY' else 'INDEX' end, concat(' ', symbol), '0', '0', series) AS value")
    entry = "7,1,77,EQUITY,FIRST,0,0,EQ"
    return reduce(DataFrame.unionByName, [
        contract_files.read_cm_contract(spark, written_lines(lines, first)).rows.select(F.lit(name).alias("first_line"), "token", "symbol", "series")
        for name, first in (("number", entry), ("entry", "C" + entry))])


def complaint(problem: Exception, pattern: str) -> str:
    return re.search(pattern, str(problem)).group(0)


@query
def contract_checks(spark, folder):
    """What the loader says of a contract with conflicts, with none of the wanted instruments, and with bad numbers."""
    lines = fo_lines(spark, folder)
    bad = tables.contract(spark, folder).agg(F.max("line_key").alias("line_key"))
    cases = {
        "conflict": (lines, "token [0-9]+ maps inconsistently \\([0-9]+ ways\\)"),
        "empty": (lines.filter("instrument = 'EQUITY'"), "no contract lines of the wanted instruments"),
        "token": (bad.selectExpr("line_key", "concat('C,1,x', line_key, ',FUTSTK,A,5') AS value"), "bad token: x[0-9]+"),
        "expiry": (bad.selectExpr("line_key", "concat('C,1,5,OPTIDX,A,', line_key, '.5') AS value"), "bad expiry: [0-9.]+"),
    }
    said = []
    for name, (rows, pattern) in cases.items():
        try:
            contract_files.read_fo_contract(spark, written_lines(rows, "first line"))
        except (ValueError, PySparkException) as problem:
            said.append((name, complaint(problem, pattern)))
    return spark.createDataFrame(said, "case STRING, message STRING")


# --- audit -----------------------------------------------------------------------


@query
def row_ledger(spark, folder):
    return audit.derivative_ledger(fo_attached(spark, folder))


@query
def row_ledger_cash(spark, folder):
    return audit.cash_ledger(cm_attached(spark, folder))


@query
def ledger_scan(spark, folder):
    """Ledger lines written as text with a header, then summed."""
    path = work_folder(spark, "ledger")
    ledger = audit.derivative_ledger(fo_attached(spark, folder))
    ledger.withColumn("shown", F.when(F.col("rows") % 7 == 0, F.lit("n/a")).otherwise(F.col("rows").cast("string"))).select(
        "archive_stem", "expiry", "symbol", "safe_symbol", F.col("shown").alias("rows")).write.option("header", True).csv(path)
    return audit.ledger_total(spark.read.text(path))


@query
def token_digit_check(spark, folder):
    return audit.with_status(audit.token_profile(fo_final(spark, folder), "instrument", "expiry", "symbol"))


@query
def rows_rollup(spark, folder):
    """One name more than the tables hold, to show an instrument without rows."""
    return audit.instrument_totals(fo_final(spark, folder), (*FO_INSTRUMENTS, "FUTCUR"))


@query
def cross_check(spark, folder):
    attached = fo_attached(spark, folder)
    return audit.cross_check(audit.derivative_ledger(attached), ingest.derivative_rows(attached, TRADE_DATE),
                             lookup.drop_counts(attached), lookup.split_gain(attached))


@query
def cross_check_by_key(spark, folder):
    attached = fo_attached(spark, folder)
    return audit.cross_check_by_key(audit.derivative_ledger(attached), ingest.derivative_rows(attached, TRADE_DATE))


# --- expiries and research tapes ---------------------------------------------------


def expiry_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Expiries around the trade date, one row per contract entry."""
    return tables.contract(spark, folder).select(
        "symbol", F.expr("cast(1459348200 - 1209600 + (line_key%6)*604800 as string)").alias("expiry_epoch"))


@query
def expiry_dates(spark, folder):
    return expiry_manifest(spark, folder).select("expiry_epoch").distinct().select(
        "expiry_epoch",
        clock.expiry_date(F.col("expiry_epoch")).cast("string").alias("expiry_date"),
        clock.expiry_date(F.col("expiry_epoch"), "ist").cast("string").alias("expiry_date_ist"),
        clock.expiry_seconds(F.col("expiry_epoch")).alias("expiry_unix"))


@query
def front_expiry(spark, folder):
    picked = research.front_expiry(expiry_manifest(spark, folder), TRADE_DAY, "symbol")
    return picked.withColumn("expiry_date", F.col("expiry_date").cast("string"))


@query
def front_expiry_rows(spark, folder):
    """Manifest rows of the one expiry the export would choose."""
    manifest = expiry_manifest(spark, folder)
    chosen = research.select_expiry(manifest, TRADE_DATE)
    return manifest.filter(F.col("expiry_epoch") == chosen).groupBy("symbol", "expiry_epoch").agg(
        F.count("*").alias("entries"))


def research_rows(spark: SparkSession, folder: str) -> DataFrame:
    return export.prepared(fo_attached(spark, folder), ["symbol"])


@query
def tape_main(spark, folder):
    return research.tape(research_rows(spark, folder), "main")


@query
def tape_aux(spark, folder):
    return research.tape(research_rows(spark, folder), "aux")


@query
def tape_split_counts(spark, folder):
    return research.split_tapes(research_rows(spark, folder)).groupBy("tape", "symbol").agg(
        F.count("*").alias("rows"))


@query
def tape_ranked(spark, folder):
    rows = research.split_tapes(research_rows(spark, folder)).select(
        "symbol", "tape", "capture_ns", "seq_no", "archive_stem", "record_no")
    # Some rows without a time, and many with the same one.
    shaped = rows.withColumn("capture_ns", F.expr(
        "case when record_no%41=0 then null else capture_ns div 60000000000 end"))
    return ordering.number_tape(shaped, "tape", "symbol")


@query
def tape_sorted(spark, folder):
    rows = research.tape(research_rows(spark, folder), "main")
    return ordering.sort_tape(rows, "symbol")


@query
def clean_ids(spark, folder):
    words = F.expr("element_at(array('', ' NaN ', 'null', 'NA', '.0', '0', concat(cast(event_id as string), '.000'), "
                   "concat(' ', cast(event_id as string))), cast(event_id%8 as int)+1)")
    rows = tables.table(spark, folder, "events").select(
        "event_id", words.alias("order_id"),
        F.expr("case when event_id%5=0 then double('NaN') when event_id%5=1 then null "
               "when event_id%5=2 then (cast(event_id as double) - 50) * 1e21 else cast(event_id as double) + 1300000000000000 end").alias("buy_order_id"),
        F.expr("case when event_id%3=0 then null else event_id end").alias("sell_order_id"))
    return research.clean_ids(rows)


@query
def alias_columns(spark, folder):
    rows = tables.sound_messages(spark, folder).selectExpr(
        "capture_ns AS `Capture Time NS`", "exchange_ns AS `exch-ns`", "seq_no AS SeqNo", "msg_type AS Type",
        "side AS `Order Side`", "order_id AS OrderID", "buy_order_id AS `Buy ID`", "sell_order_id AS SellOrderId",
        "price AS `Order.Price`", "quantity AS Qty", "stream_id AS `Feed Id`")
    return research.clean_ids(research.core_columns(research.resolve_columns(rows)))


# --- names and listings --------------------------------------------------------------


def file_names(spark: SparkSession, folder: str) -> DataFrame:
    """File names built from the contract: finals of both segments and shards."""
    return tables.contract(spark, folder).select(
        "line_key", "symbol", "series", "expiry",
        F.expr("array('.cap.tar.xz', '.tar.gz', '.cap', '.tgz', '.tar.bz2', '.cap.gz')[cast(line_key%6 as int)]").alias("suffix"))


@query
def sanitize_symbols(spark, folder):
    names = tables.table(spark, folder, "customer").selectExpr(
        "c_custkey", "concat(c_name, element_at(array(' & Co', '-é9', '.x_', '/1', '+ü!'), cast(c_custkey%5 as int)+1)) AS name")
    return names.select("c_custkey", "name", text.sanitize_symbol(F.col("name")).alias("safe_name"))


@query
def archive_stems(spark, folder):
    paths = file_names(spark, folder).select(
        F.concat(F.lit("/data/efvi_20260327_"), F.col("line_key").cast("string"), F.col("suffix")).alias("path"))
    return paths.select("path", text.archive_stem(F.col("path")).alias("archive_stem"))


@query
def shard_names(spark, folder):
    path = F.expr("concat('/s/', expiry, '/', symbol, '/arc_b', cast(line_key%10 as string), "
                  "case when line_key%3=0 then '_b12' else concat('_b', lpad(cast(line_key%7 as string), 4, '0')) end, '.parquet')")
    return file_names(spark, folder).select("line_key", path.alias("path")).select(
        "line_key", text.shard_archive(F.col("path")).alias("archive_stem"),
        text.shard_batch(F.col("path")).alias("batch"))


@query
def output_names(spark, folder):
    day = F.lit(TRADE_DATE)
    return tables.contract(spark, folder).select(
        "line_key",
        text.derivative_file_name(day, F.col("instrument"), F.col("symbol"), F.col("expiry")).alias("derivative_file"),
        text.cash_file_name(day, F.col("symbol"), F.col("series")).alias("cash_file"),
        text.tape_name(F.col("symbol"), day).alias("tape"))


@query
def manifest_futstk(spark, folder):
    files = file_names(spark, folder).select(F.expr(
        "concat('/final/', case when line_key%2=0 then 'b/' else 'a/' end, case when line_key%9=0 then '20260326' else '20260327' end, "
        "case when line_key%4=0 then '_OPTSTK_' else '_FUTSTK_' end, symbol, '_A_', expiry, '.parquet')").alias("path"))
    parsed = listing.parse_derivative_names(files, TRADE_DATE)
    return listing.first_file_per_symbol(parsed, "symbol", "expiry_epoch")


@query
def manifest_cash(spark, folder):
    files = file_names(spark, folder).select(F.expr(
        "concat('/cm/', case when line_key%9=0 then '20260326' else '20260327' end, '_', symbol, '_X_', series, '.parquet')").alias("path"))
    return listing.parse_cash_names(files, TRADE_DATE).groupBy("symbol", "series").agg(F.count("*").alias("files"))


@query
def manifest_cash_sorted(spark, folder):
    files = file_names(spark, folder).select(F.expr(
        "concat('/cm/20260327_', symbol, '_', series, '.parquet')").alias("path")).distinct()
    return listing.parse_cash_names(files, TRADE_DATE, "ALL").orderBy("symbol", "series", "path")


def capture_listing(spark: SparkSession, folder: str) -> DataFrame:
    """Plain captures of many source folders, several of each kind."""
    return tables.table(spark, folder, "orders").selectExpr(
        "o_custkey AS source",
        "concat('/src/', case o_orderkey%3 when 0 then 'recovery_efvi_' when 1 then 'stitched_efvi_' else 'other_' end, "
        "lpad(cast(o_orderkey as string), 12, '0'), '.cap') AS path",
        "cast(floor(o_totalprice) as bigint) AS length")


@query
def capture_choice(spark, folder):
    return listing.choose_capture(capture_listing(spark, folder), "source")


@query
def capture_list_union(spark, folder):
    """Archive list of all sources with each source's chosen capture added."""
    archives = file_names(spark, folder).select(F.concat(
        F.lit("/src/efvi_"), F.col("line_key").cast("string"), F.lit(".cap.tar.xz")).alias("path")).withColumn(
        "archive_stem", text.archive_stem(F.col("path")))
    chosen = listing.choose_capture(capture_listing(spark, folder), "source")
    return listing.with_chosen_capture(archives, chosen)


# --- resume ------------------------------------------------------------------------------


@query
def resume_remaining(spark, folder):
    archives = tables.table(spark, folder, "orders").select(
        F.concat(F.lit("efvi_"), F.col("o_custkey").cast("string")).alias("archive_stem")).distinct()
    shards = tables.table(spark, folder, "customer").filter("c_custkey % 3 = 0").select(F.concat(
        F.lit("/s/1/A/efvi_"), F.col("c_custkey").cast("string"), F.lit("_b0001.parquet")).alias("path"))
    return resume.remaining_archives(archives, resume.completed_archives(shards))


def tape_targets(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    entries = tables.contract_with_conflicts(spark, folder).select("symbol", "series")
    written = tables.contract_with_conflicts(spark, folder).filter("line_key % 101 = 0").select(
        "symbol", "series", F.expr("case when line_key%2=0 then 'main' else 'aux' end").alias("tape"))
    return entries.distinct(), resume.both_tapes(written, "symbol", "series")


@query
def export_todo(spark, folder):
    return resume.export_work(*tape_targets(spark, folder), "symbol", "series")


@query
def export_existing(spark, folder):
    return resume.export_existing(*tape_targets(spark, folder), "symbol", "series")


# --- files written and read back -----------------------------------------------------------


def written_capture(spark: SparkSession, folder: str, form: str) -> DataFrame:
    path = work_folder(spark, form)
    write_capture(tables.lanes(spark, folder), path, form, torn_bytes=13)
    return listing.list_files(spark, path)


@query
def capture_roundtrip(spark, folder):
    lanes = capture.read_capture(spark, written_capture(spark, folder, "plain"))
    return shown_ids(decode.decode(lanes, "drop")).drop("archive_stem", "record_no")


@query
def archive_roundtrip(spark, folder):
    lanes = capture.read_capture(spark, written_capture(spark, folder, "archive"))
    return shown_ids(decode.decode(lanes, "drop")).drop("archive_stem", "record_no")


@query
def capture_type_counts(spark, folder):
    """Only two lanes leave the file; the type test runs inside the scan."""
    lanes = capture.read_capture(spark, written_capture(spark, folder, "plain"), ["msg_type_code", "seq_no"], types="NTZ")
    return lanes.groupBy("msg_type_code").agg(F.count("*").alias("rows"), F.max("seq_no").alias("last_seq_no"))


@query
def archive_blocks_roundtrip(spark, folder):
    """Archives of many small blocks, cut at block starts."""
    path = work_folder(spark, "blocks")
    write_capture(tables.lanes(spark, folder), path, "blocks", torn_bytes=13, block_bytes=20_000)
    lanes = capture.read_capture(spark, listing.list_files(spark, path), probe_bytes=0, split_bytes=50_000)
    return shown_ids(decode.decode(lanes, "drop")).drop("archive_stem", "record_no")


@query
def bundled_roundtrip(spark, folder):
    """Many small captures, plain and archived, several to a task; each record knows its capture and its place there."""
    path = work_folder(spark, "bundled")
    # A capture for every few hundred events, numbered from 0 in each.
    numbered = tables.lanes(spark, folder).withColumns({
        "archive_stem": F.expr("concat('small', cast(record_no div 300 as string))"), "seq_no": F.expr("cast(record_no % 300 as int)")})
    write_capture(numbered.filter("record_no div 300 % 2 = 0"), path, "plain", torn_bytes=7, named=True)
    write_capture(numbered.filter("record_no div 300 % 2 = 1"), path, "archive", named=True)
    lanes = capture.read_capture(spark, listing.list_files(spark, path), ["archive_stem", "record_no", "seq_no", "msg_type_code"])
    return lanes.groupBy("archive_stem").agg(
        F.count("*").alias("records"), F.max("record_no").alias("last_record_no"), F.count_if(F.col("record_no") == F.col("seq_no")).alias("in_place"),
        F.sum("msg_type_code").alias("codes"))


def named_captures(spark: SparkSession, folder: str, path: str) -> None:
    """The same records in each form, with a torn last record of another size in each."""
    for form, torn in (("plain", 13), ("archive", 5), ("blocks", 7)):
        rows = tables.lanes(spark, folder).withColumn("archive_stem", F.concat("archive_stem", F.lit(f"_{form}")))
        write_capture(rows, path, form, torn_bytes=torn, named=True, block_bytes=20_000)


@query
def torn_records(spark, folder):
    path = work_folder(spark, "torn")
    named_captures(spark, folder, path)
    return capture.torn_records(listing.list_files(spark, path)).select("archive_stem", "form", "records", "torn_bytes", "problem")


@query
def archive_discovery(spark, folder):
    """Each archive found by its pattern, beside captures and archives of another segment; with its records and its torn bytes."""
    path = work_folder(spark, "found")
    named_captures(spark, folder, path)
    other = tables.lanes(spark, folder).withColumn("archive_stem", F.concat("archive_stem", F.lit("_16641")))
    write_capture(other, path, "archive", named=True)
    archives = listing.discover_archives(spark, path, FO_ARCHIVE_GLOB, ingest.FO.exclude)
    sizes_found = capture.torn_records(archives).select("archive_stem", "records", "torn_bytes")
    return archives.join(sizes_found, "archive_stem").select(
        "archive_stem", text.base_name(F.col("path")).alias("file"), "records", "torn_bytes")


def sound_and_broken(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Lanes without a defect, and those with one, in captures of their own."""
    classified = decode.classify(tables.lanes(spark, folder))
    sound = classified.filter("defect IS NULL").drop("msg_type", "msg_class", "defect")
    broken = classified.filter("defect IS NOT NULL").drop("msg_type", "msg_class", "defect")
    return sound, broken.withColumn("archive_stem", F.concat(F.lit("broken"), F.substring("archive_stem", 4, 9)))


def ingest_all(spark: SparkSession, archives: DataFrame, folder: str, work: str, **options) -> str:
    """The derivatives ingest of archives of which some have a defect: what it raises."""
    try:
        ingest.ingest(spark, archives, fo_contract(spark, folder), work, **options)
    except RuntimeError as problem:
        return str(problem)
    return ""


def ingested(spark: SparkSession, folder: str) -> str:
    """A whole derivatives ingest of all records: archives with a defect fail, the others go on."""
    work = work_folder(spark, "ingest")
    for rows in sound_and_broken(spark, folder):
        write_capture(rows, f"{work}/in", "archive")
    archives = listing.discover_archives(spark, f"{work}/in", FO_ARCHIVE_GLOB)
    if not ingest_all(spark, archives, folder, work).startswith("defect "):
        raise AssertionError("the derivatives ingest has to name the first defect")
    return work


@query
def ingest_final_counts(spark, folder):
    finals = ingest.finalize_derivatives(spark, ingested(spark, folder), TRADE_DATE)
    return finals.groupBy("instrument", "symbol", "expiry").agg(
        F.count("*").alias("rows"), F.sum("quantity").alias("quantity"))


@query
def footer_counts(spark, folder):
    """The same rows, counted from the footers of the final files."""
    work = ingested(spark, folder)
    ingest.finalize_derivatives(spark, work, TRADE_DATE)
    files = ingest.final_files(spark, ingest.FO.place(work), TRADE_DATE)
    return footers.footer_counts(files, "instrument", "symbol", "expiry").select(
        "instrument", "symbol", F.col("expiry").cast("bigint").alias("expiry"), "rows")


@query
def ingest_status(spark, folder):
    """Status of every archive, and the defect that the job named."""
    work = work_folder(spark, "status")
    for rows in sound_and_broken(spark, folder):
        write_capture(rows, f"{work}/in", "archive", torn_bytes=9, named=True)
    named = ingest_all(spark, listing.discover_archives(spark, f"{work}/in", FO_ARCHIVE_GLOB), folder, work)
    status = ingest.read_table(spark, f"{ingest.FO.place(work)}/status", ingest.STATUS_DDL)
    return status.withColumn("raised", F.lit(named))


@query
def quarantine(spark, folder):
    """Defective records with rule and place, from the pass that wrote the sound ones; none of them in the shards."""
    work = work_folder(spark, "quarantine")
    write_capture(tables.lanes(spark, folder).withColumn("seq_no", F.col("record_no").cast("int")), f"{work}/in", "archive", named=True)
    ingest_all(spark, listing.discover_archives(spark, f"{work}/in", FO_ARCHIVE_GLOB), folder, work)
    place = ingest.FO.place(work)
    # The records' own numbers stand in their sequence numbers; in an archive they are counted from 0.
    bad = ingest.quarantine(spark, place).select("archive_stem", "record_no", "seq_no", "msg_type", "defect", F.lit(0).cast("bigint").alias("shard_rows"))
    kept = ingest.shards(spark, place, ingest.FO).groupBy("archive_stem").agg(F.count("*").alias("shard_rows"))
    return bad.unionByName(kept, allowMissingColumns=True)


@query
def ingest_profile(spark, folder):
    """What the writing passes saw, summed over the commits of a day."""
    work = work_folder(spark, "profile")
    write_capture(tables.lanes(spark, folder), f"{work}/in", "archive", torn_bytes=11, named=True)
    ingest_all(spark, listing.discover_archives(spark, f"{work}/in", FO_ARCHIVE_GLOB), folder, work, group_bytes=1)
    profile = ingest.read_profile(spark, work, ingest.FO)
    return profile.agg(F.count("*").alias("commits"), *[F.sum(name).alias(name) for name in profile.columns if name != "commit_id"])


def overwritten(spark: SparkSession, path: str, data: bytes) -> None:
    files, inner = filesystem_of(path)
    with files.open_output_stream(inner, compression=None) as out:
        out.write(data)


@query
def ingest_groups(spark, folder):
    """One archive per commit; the third can't be read at first. The status after each run, and which archives a run did."""
    work = work_folder(spark, "groups")
    sound, _ = sound_and_broken(spark, folder)
    write_capture(sound, f"{work}/in", "archive", named=True)
    archives = checkpointed(listing.discover_archives(spark, f"{work}/in", FO_ARCHIVE_GLOB))
    victim = archives.filter("archive_stem = 'arc2'").first().path
    files, inner = filesystem_of(victim)
    with files.open_input_file(inner) as handle:
        whole = handle.read()
    overwritten(spark, victim, b"not an archive" * 1000)
    try:
        ingest.ingest(spark, archives, fo_contract(spark, folder), work, group_bytes=1, unreadable="fail")
        raise AssertionError("an unreadable archive has to end the run")
    except PySparkException:
        pass
    status = f"{ingest.FO.place(work)}/status"
    first = checkpointed(ingest.read_table(spark, status, ingest.STATUS_DDL))
    overwritten(spark, victim, whole)
    redone = checkpointed(ingest.ingest(spark, archives, fo_contract(spark, folder), work, group_bytes=1, unreadable="fail"))
    names = {"after the failure": first, "done again": redone, "at the end": ingest.read_table(spark, status, ingest.STATUS_DDL)}
    return reduce(DataFrame.unionByName, [rows.select(F.lit(name).alias("seen"), "archive_stem", "status", "rows") for name, rows in names.items()])


@query
def ingest_clean_start(spark, folder):
    """A day begun anew with fewer archives: nothing of the former run is left in any table."""
    work = work_folder(spark, "clean")
    sound, _ = sound_and_broken(spark, folder)
    write_capture(sound, f"{work}/in", "archive", named=True)
    archives = listing.discover_archives(spark, f"{work}/in", FO_ARCHIVE_GLOB)
    ingest.ingest(spark, archives, fo_contract(spark, folder), work)
    ingest.ingest(spark, archives.filter("archive_stem <> 'arc1'"), fo_contract(spark, folder), work, clean_start=True)
    place = ingest.FO.place(work)
    found = {"status": ingest.read_table(spark, f"{place}/status", ingest.STATUS_DDL).select("archive_stem", "rows"),
             "ledger": ingest.sound_ledger(spark, work, ingest.FO).groupBy("archive_stem").agg(F.sum("rows").alias("rows")),
             "shards": ingest.shards(spark, place, ingest.FO).groupBy("archive_stem").agg(F.count("*").alias("rows"))}
    return reduce(DataFrame.unionByName, [rows.select(F.lit(name).alias("table_name"), "archive_stem", "rows") for name, rows in found.items()])


@query
def skipped_shards(spark, folder):
    """Two damaged files among the shards: listed, and left out of the scan."""
    work = work_folder(spark, "skipped")
    committed(spark, folder, work, "true")
    place = f"{ingest.FO.place(work)}/rows/kind=shard"
    overwritten(spark, f"{place}/archive_stem=arc1/damaged-1.parquet", b"PAR1 nothing more")
    overwritten(spark, f"{place}/archive_stem=arc3/damaged-2.parquet", b"xyz")
    kept = ingest.sound_shards(spark, work, ingest.FO, skip_unreadable=True).groupBy("archive_stem").agg(F.count("*").alias("rows"))
    bad = ingest.skipped_shards(spark, work, ingest.FO).select("archive_stem", text.base_name(F.col("path")).alias("skipped"), "length")
    return kept.unionByName(bad, allowMissingColumns=True)


@query
def day_swap(spark, folder):
    """A final day before, after a write that fails halfway, and after a good one."""
    path = work_folder(spark, "swap")
    rows = fo_final(spark, folder)
    columns = "instrument STRING, symbol STRING, expiry BIGINT, price INT, trade_date STRING"

    def write(what: DataFrame) -> None:
        days.replace_day(what.select(*[field.split()[0] for field in columns.split(", ")]), path, TRADE_DATE, ingest.DERIVATIVE_KEYS, "zstd")

    def seen(when: str) -> DataFrame:
        day = days.read_day(spark, path, TRADE_DATE, columns)
        return checkpointed(day.groupBy("instrument", "symbol", "expiry").agg(F.count("*").alias("rows"), F.sum("price").alias("price")).withColumn("seen", F.lit(when)))

    write(rows.filter("record_no % 2 = 0"))
    steps = [seen("first")]
    broken = F.when(F.col("record_no") % 5 == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("price"))
    try:
        write(rows.withColumn("price", broken.cast("int")))
        raise AssertionError("the write has to fail")
    except PySparkException:
        pass
    steps.append(seen("after the failure"))
    write(rows)
    steps.append(seen("second"))
    left = len(days.history(path, TRADE_DATE)) - len(days.sweep(spark, path, TRADE_DATE))
    return reduce(DataFrame.unionByName, steps).withColumn("versions", F.lit(left))


@query
def ingest_cash_counts(spark, folder):
    """The cash ingest: archives with a defect fail, the others go on."""
    work = work_folder(spark, "ingest")
    for rows in sound_and_broken(spark, folder):
        write_capture(rows, f"{work}/in", "archive")
    archives = listing.discover_archives(spark, f"{work}/in", "*.cap.tar.xz")
    ingest.ingest(spark, archives, cm_contract(spark, folder), work, ingest.CM)
    return ingest.finalize_cash(spark, work, TRADE_DATE).groupBy("symbol", "series").agg(
        F.count("*").alias("rows"))


@query
def final_table(spark, folder):
    """Final rows written by instrument, symbol and expiry, and read back."""
    path = work_folder(spark, "final")
    sinks.write_derivatives(fo_final(spark, folder), path)
    finals = spark.read.schema(ingest.DERIVATIVE_DDL).parquet(path)
    return finals.select("record_no", "trade_date", "instrument", "symbol", "expiry", "price")


@query
def research_export(spark, folder):
    """Tapes exported per symbol; a second run finds that all exist."""
    out = work_folder(spark, "tapes")
    rows = fo_attached(spark, folder)
    first = export.export_tapes(spark, rows, out, TRADE_DATE, ["symbol"])
    again = export.export_tapes(spark, rows, out, TRADE_DATE, ["symbol"])
    return first.select("symbol", "rows", "status").unionByName(again.select("symbol", "rows", "status"))


@query
def shard_stream_counts(spark, folder):
    """Archives taken up incrementally, in two runs over a growing table."""
    return streamed_counts(spark, folder, "archive_stem < 'arc2'", "archive_stem >= 'arc2'")


@query
def shard_stream_redo(spark, folder):
    """The same, with an archive done again after it was taken up: its rows are replaced."""
    return streamed_counts(spark, folder, "archive_stem <> 'arc3'", "archive_stem >= 'arc2'")


def committed(spark: SparkSession, folder: str, work: str, which: str, rows: str = "true") -> None:
    """Commit the archives ``which`` selects, with those of their rows that ``rows`` selects."""
    attached = fo_attached(spark, folder).withColumn("defect", F.lit(None).cast("string")).filter(which)
    ingest.commit(attached.filter(rows), checkpointed(attached.select("archive_stem").distinct()), ingest.FO.place(work), ingest.FO)


def streamed_counts(spark: SparkSession, folder: str, *runs: str) -> DataFrame:
    work = work_folder(spark, "stream")
    for which in runs:
        committed(spark, folder, work, which)
        shard_stream.run_available(spark, work, f"{work}/final", f"{work}/state", TRADE_DATE)
    finals = spark.read.schema(ingest.DERIVATIVE_DDL).parquet(f"{work}/final")
    return finals.groupBy("instrument", "symbol").agg(F.count("*").alias("rows"))


@query
def ingest_redone_empty(spark, folder):
    """Status after an archive is done again and yields nothing: its former rows are gone from shards and ledger."""
    work = work_folder(spark, "redone")
    committed(spark, folder, work, "true")
    committed(spark, folder, work, "archive_stem = 'arc1'", "false")
    shards = ingest.sound_shards(spark, work, ingest.FO).groupBy("archive_stem").agg(F.count("*").alias("shard_rows"))
    ledger = ingest.sound_ledger(spark, work, ingest.FO).groupBy("archive_stem").agg(F.sum("rows").alias("ledger_rows"))
    status = ingest.read_table(spark, f"{ingest.FO.place(work)}/status", ingest.STATUS_DDL)
    return status.join(shards, "archive_stem", "left").join(ledger, "archive_stem", "left").select(
        "archive_stem", "status", "rows", "shard_rows", "ledger_rows")


@query
def size_report(spark, folder):
    path = work_folder(spark, "sizes")
    sinks.write_derivatives(fo_final(spark, folder), path)
    files = sizes.with_layout(listing.list_files(spark, path, "*.parquet", recursive=True),
                              "instrument", "symbol", "expiry")
    return sizes.instrument_sizes(files)


@query
def compression_report(spark, folder):
    path = work_folder(spark, "sizes")
    write_capture(tables.lanes(spark, folder), f"{path}/in", "archive")
    sinks.write_derivatives(fo_final(spark, folder), f"{path}/out")
    return sizes.compression_report(listing.list_files(spark, f"{path}/in", FO_ARCHIVE_GLOB),
                                    listing.list_files(spark, f"{path}/out", "*.parquet", recursive=True))


@query
def codec_saving(spark, folder):
    path = work_folder(spark, "codec")
    futures = lookup.keep_instruments(fo_final(spark, folder), ("FUTSTK",))
    futures.write.option("compression", "snappy").parquet(f"{path}/old")
    sinks.write_derivatives(futures, f"{path}/new")
    old = listing.with_magic(listing.list_files(spark, f"{path}/old", "*.parquet"))
    return sizes.codec_saving(old, listing.list_files(spark, f"{path}/new", "*.parquet", recursive=True))


@query
def cash_sizes(spark, folder):
    path = work_folder(spark, "cash")
    attached = cm_attached(spark, folder)
    sinks.write_cash(ingest.cash_rows(attached, TRADE_DATE), path)
    files = sizes.with_layout(listing.list_files(spark, path, "*.parquet", recursive=True), "symbol", "series")
    return sizes.cash_sizes(audit.cash_ledger(attached), files)


def derived_files(spark: SparkSession, folder: str) -> DataFrame:
    """A listing of final files, one per contract entry, sizes from the balance."""
    return tables.contract(spark, folder).join(
        tables.table(spark, folder, "customer").select(
            F.col("c_custkey").alias("line_key"), F.expr("cast(floor(abs(c_acctbal)*1000) as bigint)").alias("length")),
        "line_key").withColumn("path", F.expr(
            "concat('/final/trade_date=20260327/instrument=', instrument, '/symbol=', replace(symbol, '&', '%26'), "
            "'/expiry=', expiry, '/part-', line_key, '.parquet')"))


@query
def size_by_instrument(spark, folder):
    files = derived_files(spark, folder).select("path", "length")
    return sizes.instrument_sizes(sizes.with_layout(files, "instrument", "symbol", "expiry"))


@query
def compression_ratio(spark, folder):
    files = derived_files(spark, folder)
    return sizes.compression_report(files, files.filter("instrument <> 'EQUITY'"))


@query
def codec_saving_ratio(spark, folder):
    files = derived_files(spark, folder)
    old = files.filter("instrument = 'FUTSTK'").withColumn("magic_ok", F.col("line_key") % 10 != 0)
    return sizes.codec_saving(old, files.filter("instrument = 'FUTSTK' AND line_key % 3 = 0"))


@query
def cash_size_table(spark, folder):
    files = derived_files(spark, folder).filter("instrument = 'EQUITY'")
    return sizes.cash_sizes(audit.cash_ledger(cm_attached(spark, folder)), files)


@query
def sanity_report(spark, folder):
    path = work_folder(spark, "sanity")
    sinks.write_derivatives(fo_final(spark, folder), path)
    keys = ("instrument", "symbol", "expiry")
    files = listing.with_magic(listing.list_files(spark, path, "*.parquet", recursive=True))
    files = sizes.with_layout(files, *keys).withColumn("expiry", F.col("expiry").cast("bigint"))
    profile = audit.token_profile(spark.read.schema(ingest.DERIVATIVE_DDL).parquet(path), *keys)
    return audit.sanity_report(profile, files, *keys).drop("files")


@query
def report_blocks(spark, folder):
    """The blocks of the report as they were written, and the shared copy, published though bad tokens fail the audit."""
    work = ingested(spark, folder)
    ingest.finalize_derivatives(spark, work, TRADE_DATE)
    ingest.publish(spark, work, TRADE_DATE, f"{work}/shared", publish_on_fail=True)
    block = {name: ingest.read_report(spark, f"{work}/audit/{TRADE_DATE}/{name}") for name in ("files", "totals", "cross_check")}
    shared = days.read_day(spark, f"{work}/shared", TRADE_DATE, ingest.DERIVATIVE_DDL).groupBy("instrument").agg(F.count("*").cast("string").alias("rows"))
    parts = [
        block["files"].select(F.lit("files").alias("block"), F.col("filename").alias("name"), F.concat_ws(" ", "row_count", "token_check", "magic_bytes", "status").alias("value")),
        block["totals"].select(F.lit("totals"), "instrument", "rows"),
        block["cross_check"].select(F.lit("cross_check"), F.lit("expected"), F.concat_ws(" ", "parser_total", "parquet_total", "dropped", "gained", "expected_match")),
        shared.select(F.lit("shared"), "instrument", "rows"),
    ]
    return reduce(DataFrame.union, parts)


def futures_files(spark: SparkSession, folder: str, path: str) -> None:
    """A day's futures as one file for each symbol and expiry, of four kinds: other column names in two, one column less in the last."""
    futures = lookup.keep_instruments(fo_final(spark, folder), ("FUTSTK",))
    name = text.derivative_file_name(F.lit(TRADE_DATE), F.col("instrument"), F.col("symbol"), F.col("expiry"))
    kind = F.substring_index("symbol", "&", -1).cast("int") % 4
    rows = futures.filter("symbol LIKE 'SYM%'").select(*MESSAGE_COLUMNS, "archive_stem", "record_no", kind.alias("kind"), name.alias("file"))
    write_files(rows, path, {1: {"capture_ns": "Capture Time NS", "quantity": "Qty"}, 2: {"price": "order-price", "msg_type": "Type"}, 3: {"price": None}})


@query
def export_mixed_files(spark, folder):
    """Files of differing columns exported as one job; those without a price become error rows. With the place of each tape or file."""
    path = work_folder(spark, "mixed")
    futures_files(spark, folder, f"{path}/in")
    done = export.export_derivative_files(spark, f"{path}/in", f"{path}/out", TRADE_DATE)
    return done.select("symbol", "rows", "status", "trade_date", F.regexp_replace("path", "^.*/(out|in)/", "").alias("path"))


@query
def export_requested_expiry(spark, folder):
    """The export of an expiry that is not the front one, and what it says of one that is not there."""
    path = work_folder(spark, "expiry")
    futures_files(spark, folder, f"{path}/in")
    chosen = str(tables.FIRST_EXPIRY + tables.FOUR_WEEKS)
    done = export.export_derivative_files(spark, f"{path}/in", f"{path}/out", TRADE_DATE, expiry=chosen)
    try:
        export.export_derivative_files(spark, f"{path}/in", f"{path}/none", TRADE_DATE, expiry="7")
    except ValueError as problem:
        message = str(problem)
    return done.select("symbol", "rows", "status").withColumn("unknown", F.lit(message))
