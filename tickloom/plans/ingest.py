"""Capture archives -> shard table -> final tables, for both segments."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import text
from tickloom.operators import audit, decode, lookup, resume, sizes
from tickloom.operators.contract import Contract
from tickloom.operators.sizing import broadcast_if_small
from tickloom.plans import days, sinks
from tickloom.schema import BATCH_RECORDS, CM_ARCHIVE_GLOB, FO_ARCHIVE_GLOB, MESSAGE_COLUMNS, MESSAGE_DDL
from tickloom.session import checkpointed
from tickloom.sources import listing
from tickloom.sources.capture import read_capture, torn_records
from tickloom.sources.files import remove_folders
from tickloom.sources.footers import with_footer


@dataclass(frozen=True)
class Segment:
    """What differs between the derivatives and the cash ingest."""

    name: str
    glob: str
    exclude: str | None
    meta: str
    ledger: str
    members: str
    stop_on_defect: bool

    def place(self, work: str) -> str:
        """The segment's own folder below that of a trading day, so that segments of one day never replace each other's tables."""
        return f"{work}/{self.name}"

    @property
    def shard_schema(self) -> str:
        return f"record_no BIGINT, batch INT, {MESSAGE_DDL}, {self.meta}, archive_stem STRING"

    @property
    def ledger_schema(self) -> str:
        return f"{self.ledger}, rows BIGINT, archive_stem STRING"

    @property
    def meta_columns(self) -> list[str]:
        return [field.split()[0] for field in self.meta.split(", ")]


FO = Segment("fo", FO_ARCHIVE_GLOB, r"_166[^/]*\.cap\.tar\.xz$",
             "symbol STRING, expiry BIGINT, instruments ARRAY<STRING>",
             "expiry BIGINT, symbol STRING, safe_symbol STRING", "one", True)
CM = Segment("cm", CM_ARCHIVE_GLOB, None, "symbol STRING, series STRING",
             "symbol STRING, series STRING, safe_name STRING", "first", False)


QUARANTINE_DDL = f"record_no BIGINT, {MESSAGE_DDL}, defect STRING, archive_stem STRING"
RULES = ("pad0", "pad1", "msg_len", "short_body", "side", "exchange_time", "unreadable")


class Profile:
    """Counts that a commit's writing pass makes on its way, of all records of its archives."""

    def __init__(self) -> None:
        self.lanes, self.lookup = Observation(), Observation()

    def of_lanes(self, classified: DataFrame) -> DataFrame:
        sound, cls = F.col("defect").isNull(), F.col("msg_class")
        real = F.coalesce(F.col("defect") != "unreadable", F.lit(True))
        return classified.observe(
            self.lanes, F.count_if(real).alias("records"), F.count_if(sound & cls.isNull()).alias("unknown_types"),
            F.count_if(sound & (cls == "heartbeat")).alias("heartbeats"),
            *[F.count_if(F.col("defect") == rule).alias(f"defect_{rule}") for rule in RULES])

    def of_lookup(self, attached: DataFrame) -> DataFrame:
        sound, known = F.col("defect").isNull(), F.col("symbol").isNotNull()
        return attached.observe(self.lookup, F.count_if(sound & known).alias("known_tokens"), F.count_if(sound & ~known).alias("unknown_tokens"))

    def counts(self) -> dict[str, int]:
        """Only once the rows were written; a repeated task is counted once, as the write has no shuffle."""
        return {**self.lanes.get, **self.lookup.get}


PROFILE_COUNTS = ("records", "unknown_types", "heartbeats", *(f"defect_{rule}" for rule in RULES), "known_tokens", "unknown_tokens")
PROFILE_DDL = "archives BIGINT, torn_records BIGINT, torn_bytes BIGINT, " + ", ".join(f"{name} BIGINT" for name in PROFILE_COUNTS) + ", commit_id STRING"


def shard_rows(lanes: DataFrame, contract: Contract, profile: Profile | None = None) -> DataFrame:
    """Rows to keep of each archive: known tokens, and any defect."""
    classified = decode.classify(lanes)
    if profile:
        classified = profile.of_lanes(classified)
    rows = decode.to_messages(classified.filter("msg_class IS NOT NULL OR defect IS NOT NULL"), "defect")
    attached = lookup.attach(rows, contract, "left")
    if profile:
        attached = profile.of_lookup(attached)
    return attached.filter("symbol IS NOT NULL OR defect IS NOT NULL")


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """A table this job wrote before, None before its first run."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


STATUS_DDL = "rows BIGINT, defects BIGINT, torn_bytes BIGINT, status STRING, archive_stem STRING"
#: Packed bytes of the archives that are committed together, about: what a lost run has to repeat at most.
GROUP_BYTES = 1 << 40


def commit_groups(todo: list, group_bytes: int) -> list[list]:
    """Archives (archive_stem, path, length) in groups of neighbours by name, of at least so many bytes but for the last."""
    groups, held = [[]], 0
    for row in sorted(todo, key=lambda row: (row.archive_stem, row.path)):
        if held >= group_bytes:
            groups.append([])
            held = 0
        groups[-1].append(row)
        held += row.length
    return groups


def ingest(spark: SparkSession, archives: DataFrame, contract: Contract, work: str, segment: Segment = FO,
           clean_start: bool = False, group_bytes: int = GROUP_BYTES, unreadable: str = "mark") -> DataFrame:
    """Ingest the archives not done yet; returns their status rows.

    ``work`` is the folder of one trading day; each segment has its own below it. Only the names of the archives
    still to do reach the driver, as the scan of their files needs them there.

    Archives are committed in groups of about ``group_bytes``, one after another: data, then the row ledger, then the
    status. An archive counts as done only by its status row, so a run cut short is simply repeated: the groups
    before are done, and what the last one had written is replaced. Defective records go to a table of their own,
    in the same pass. An archive with a defect is marked failed and the others are committed; a segment that stops
    on defects then fails, naming the first one. An archive that can't be read is such a defect (``unreadable="mark"``)
    or ends the run (``"fail"``).
    """
    work = segment.place(work)
    if clean_start:
        for name, schema in (("status", STATUS_DDL), ("ledger", segment.ledger_schema)):
            sinks.clear(spark, f"{work}/{name}", schema, "archive_stem")
        sinks.clear(spark, f"{work}/rows", f"{segment.shard_schema}, kind STRING", "kind", "archive_stem")
        sinks.clear(spark, f"{work}/profile", PROFILE_DDL, "commit_id")
    done = read_table(spark, f"{work}/status", STATUS_DDL)
    todo = archives
    if done is not None:
        todo = resume.remaining_archives(archives, done.filter("status = 'done'"))
    todo = checkpointed(todo.select("archive_stem", "path", "length"))
    if todo.isEmpty():
        return spark.createDataFrame([], STATUS_DDL)
    for group in commit_groups(todo.collect(), group_bytes):
        part, profile = spark.createDataFrame(group, todo.schema), Profile()
        lanes = read_capture(spark, part, members=segment.members, unreadable=unreadable)
        torn = checkpointed(torn_records(part, unreadable))
        commit(shard_rows(lanes, contract, profile), part, work, segment, torn)
        write_profile(profile, torn, f"{work}/profile", len(group))
    fresh = read_table(spark, f"{work}/status", STATUS_DDL).join(broadcast_if_small(todo.select("archive_stem")), "archive_stem", "left_semi")
    if segment.stop_on_defect and not fresh.filter("defects > 0").isEmpty():
        raise RuntimeError(first_defect(spark, fresh, work, segment))
    return fresh


def write_profile(profile: Profile, torn: DataFrame, path: str, archives: int) -> None:
    """One row per commit: a log of what passes saw, kept also when their archives are done again."""
    counts = profile.counts()
    made = torn.agg(F.count_if(F.col("torn_bytes") > 0).alias("torn_records"), F.coalesce(F.sum("torn_bytes"), F.lit(0)).alias("torn_bytes"))
    row = made.select(F.lit(archives).cast("bigint").alias("archives"), "torn_records", "torn_bytes",
                      *[F.lit(counts[name]).cast("bigint").alias(name) for name in PROFILE_COUNTS], F.lit(uuid.uuid4().hex).alias("commit_id"))
    row.write.mode("append").partitionBy("commit_id").parquet(path)


def read_profile(spark: SparkSession, work: str, segment: Segment) -> DataFrame:
    return read_table(spark, f"{segment.place(work)}/profile", PROFILE_DDL)


def drop_archives(todo: DataFrame, path: str) -> None:
    """Remove what a table below ``path`` holds of the archives of ``todo``.

    An archive done again may yield nothing where it had rows before, and an
    overwrite by partition would leave those rows in place.
    """
    held = sizes.with_layout(listing.list_files(todo.sparkSession, path, "*.parquet", recursive=True), "archive_stem")
    stale = held.join(todo.select("archive_stem"), "archive_stem", "left_semi")
    remove_folders(stale.select(F.regexp_replace("path", "/[^/]*$", "").alias("folder")).distinct())


def drop_partitions(todo: DataFrame, *tables: str) -> None:
    """The same for tables whose first directories are the archives: these are removed by name, and nothing is listed."""
    folder = F.concat(F.lit("/archive_stem="), text.directory_value(F.col("archive_stem")))
    place = F.explode(F.array(*[F.lit(table) for table in tables]))
    remove_folders(todo.select("archive_stem").distinct().select(place.alias("place"), folder.alias("folder")).select(F.concat("place", "folder").alias("folder")))


def commit(rows: DataFrame, todo: DataFrame, work: str, segment: Segment, torn: DataFrame | None = None) -> DataFrame:
    """Write the rows of the archives of ``todo``, their ledger and their status; returns the status rows.

    ``work`` is the segment's own folder. The archives' former rows are replaced. Sound rows are the shards,
    defective ones the quarantine; one pass writes both. ``torn`` has the bytes of torn last records by archive.
    """
    spark = rows.sparkSession
    drop_partitions(todo, *(f"{work}/{name}" for name in ("status", "ledger", "rows/kind=shard", "rows/kind=quarantine")))
    kind = F.when(F.col("defect").isNull(), F.lit("shard")).otherwise(F.lit("quarantine")).alias("kind")
    sinks.write_shards(rows.select("record_no", text.batch_no(F.col("record_no"), BATCH_RECORDS).cast("int").alias("batch"), *MESSAGE_COLUMNS,
                                   *segment.meta_columns, "defect", kind, "archive_stem"), f"{work}/rows")
    # The joins are on partition values: only the directories of this run are read.
    names = broadcast_if_small(todo.select("archive_stem"))
    written = shards(spark, work, segment).join(names, "archive_stem", "left_semi")
    ledger = audit.derivative_ledger if segment is FO else audit.cash_ledger
    sinks.write_ledger(ledger(written), f"{work}/ledger")
    # Rows are summed from the ledger just written, so the shards are read once.
    counted = or_empty(read_table(spark, f"{work}/ledger", segment.ledger_schema), segment.ledger_schema, spark) \
        .join(names, "archive_stem", "left_semi").groupBy("archive_stem").agg(F.sum("rows").alias("rows"))
    defects = quarantine(spark, work).join(names, "archive_stem", "left_semi").groupBy("archive_stem").agg(F.count("*").alias("defects"))
    status = todo.select("archive_stem").distinct().join(counted, "archive_stem", "left").join(defects, "archive_stem", "left")
    if torn is None:
        status = status.withColumn("torn_bytes", F.lit(0).cast("bigint"))
    else:
        status = status.join(torn.groupBy("archive_stem").agg(F.sum("torn_bytes").alias("torn_bytes")), "archive_stem", "left")
    status = status.fillna(0).select(
        "rows", "defects", "torn_bytes",
        F.when(F.col("defects") > 0, F.lit("failed")).otherwise(F.lit("done")).alias("status"),
        "archive_stem")
    sinks.write_ledger(status, f"{work}/status")
    return read_table(spark, f"{work}/status", STATUS_DDL).join(names, "archive_stem", "left_semi")


def or_empty(table: DataFrame | None, schema: str, spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], schema) if table is None else table


def shards(spark: SparkSession, place: str, segment: Segment) -> DataFrame:
    """All shard rows below a segment's folder, also of archives not done."""
    return or_empty(read_table(spark, f"{place}/rows/kind=shard", segment.shard_schema), segment.shard_schema, spark)


def quarantine(spark: SparkSession, place: str) -> DataFrame:
    """Defective records with the rule they break and their place, decoded as far as they can be."""
    return or_empty(read_table(spark, f"{place}/rows/kind=quarantine", QUARANTINE_DDL), QUARANTINE_DDL, spark)


def first_defect(spark: SparkSession, fresh: DataFrame, work: str, segment: Segment) -> str:
    """Rule and place of the first defect by archive and record."""
    failed = broadcast_if_small(fresh.filter("defects > 0").select("archive_stem"))
    place = F.min(F.struct("archive_stem", "record_no", "defect")).alias("first")
    first = quarantine(spark, work).join(failed, "archive_stem", "left_semi").agg(place).select("first.*").first()
    return f"defect {first.defect} in {first.archive_stem} record {first.record_no}"


def shard_files(spark: SparkSession, work: str, segment: Segment) -> DataFrame:
    """Files of the shards with their archive, rows, and what is wrong with those that can't be read."""
    files = listing.list_files(spark, f"{segment.place(work)}/rows/kind=shard", "*.parquet", recursive=True)
    return with_footer(sizes.with_layout(files, "archive_stem"))


def skipped_shards(spark: SparkSession, work: str, segment: Segment) -> DataFrame:
    """Shard files of done archives that can't be read, a row each: what ``sound_shards`` leaves out if told to."""
    found = shard_files(spark, work, segment).filter("problem IS NOT NULL")
    return of_done_archives(found, segment.place(work)).select("archive_stem", "path", "length", "problem")


def sound_shards(spark: SparkSession, work: str, segment: Segment, skip_unreadable: bool = False) -> DataFrame:
    """Shard rows of the archives that are done; a damaged shard file fails the query unless it is to be skipped.

    Files to skip are found by their footers, in tasks, and the others are
    read by name; damage behind a sound footer still fails. The files' names reach the driver, as for any scan.
    """
    place = segment.place(work)
    if not skip_unreadable:
        return of_done_archives(shards(spark, place, segment), place)
    paths = [row.path for row in shard_files(spark, work, segment).filter("problem IS NULL").select("path").collect()]
    if not paths:
        return spark.createDataFrame([], segment.shard_schema)
    reader = spark.read.schema(segment.shard_schema).option("basePath", f"{place}/rows/kind=shard")
    return of_done_archives(reader.parquet(*paths), place)


def sound_ledger(spark: SparkSession, work: str, segment: Segment) -> DataFrame:
    work = segment.place(work)
    return of_done_archives(read_table(spark, f"{work}/ledger", segment.ledger_schema), work)


def of_done_archives(rows: DataFrame, work: str) -> DataFrame:
    done = read_table(rows.sparkSession, f"{work}/status", STATUS_DDL).filter("status = 'done'")
    return rows.join(broadcast_if_small(done.select("archive_stem")), "archive_stem", "left_semi")


def derivative_rows(shards: DataFrame, trade_date: str, drop_test: bool = True) -> DataFrame:
    """Final derivative rows: no heartbeats, no TEST symbols, split by instrument."""
    kept = lookup.drop_test_symbols(lookup.drop_heartbeats(shards), drop_test)
    return lookup.split_by_instrument(kept).withColumn("trade_date", F.lit(trade_date))


def cash_rows(shards: DataFrame, trade_date: str) -> DataFrame:
    return shards.withColumn("trade_date", F.lit(trade_date))


DERIVATIVE_DDL = (f"record_no BIGINT, {MESSAGE_DDL}, archive_stem STRING, "
                  "trade_date STRING, instrument STRING, symbol STRING, expiry BIGINT")
CASH_DDL = f"record_no BIGINT, {MESSAGE_DDL}, archive_stem STRING, trade_date STRING, symbol STRING, series STRING"


DERIVATIVE_KEYS, CASH_KEYS = ("instrument", "symbol", "expiry"), ("symbol", "series")


def finalize_derivatives(spark: SparkSession, work: str, trade_date: str, drop_test: bool = True) -> DataFrame:
    rows = derivative_rows(sound_shards(spark, work, FO).drop("batch"), trade_date, drop_test)
    days.replace_day(rows, f"{FO.place(work)}/final", trade_date, DERIVATIVE_KEYS, "zstd")
    return finals(spark, work, trade_date, FO)


def finalize_cash(spark: SparkSession, work: str, trade_date: str) -> DataFrame:
    rows = cash_rows(sound_shards(spark, work, CM).drop("batch"), trade_date)
    days.replace_day(rows, f"{CM.place(work)}/final", trade_date, CASH_KEYS, "snappy")
    return finals(spark, work, trade_date, CM)


def finals(spark: SparkSession, work: str, trade_date: str, segment: Segment) -> DataFrame:
    """A day's final rows, of the version that is current now."""
    return days.read_day(spark, f"{segment.place(work)}/final", trade_date, DERIVATIVE_DDL if segment is FO else CASH_DDL)


def final_files(spark: SparkSession, work: str, trade_date: str, *keys: str) -> DataFrame:
    """Final files of a day with their sizes and the keys of their directories."""
    place = days.current_folder(f"{work}/final", trade_date) or f"{work}/final/_none"
    return sizes.with_layout(listing.list_files(spark, place, "*.parquet", recursive=True), *keys)


def audit_derivatives(spark: SparkSession, work: str, trade_date: str) -> dict[str, DataFrame]:
    """The blocks of the sanity report, and the sizes per instrument."""
    keys = ("instrument", "expiry", "symbol")
    rows = finals(spark, work, trade_date, FO)
    kept = sound_shards(spark, work, FO)
    ledger = sound_ledger(spark, work, FO)
    files = final_files(spark, FO.place(work), trade_date, *keys).withColumn("expiry", F.col("expiry").cast("bigint"))
    report = audit.sanity_report(audit.token_profile(rows, *keys), listing.with_magic(files), *keys)
    name = text.derivative_file_name(F.lit(trade_date), *[F.col(key) for key in ("instrument", "symbol", "expiry")])
    return {
        "files": report.withColumn("filename", name),
        "totals": audit.instrument_totals(rows),
        "cross_check": audit.cross_check(ledger, rows, lookup.drop_counts(kept), lookup.split_gain(kept)),
        "sizes": sizes.instrument_sizes(files),
    }


def audit_cash(spark: SparkSession, work: str, trade_date: str) -> DataFrame:
    """Rows and MiB per cash group, of the archives that are done."""
    return sizes.cash_sizes(sound_ledger(spark, work, CM), final_files(spark, CM.place(work), trade_date, "symbol", "series"))


def publish(spark: SparkSession, work: str, trade_date: str, target: str,
            skip: tuple[str, ...] = sinks.SHARED_SKIP_INSTRUMENTS, publish_on_fail: bool = False) -> bool:
    """Write the shared copy, only after the audit has passed unless told otherwise.

    The shared day is swapped as a whole: readers see the former copy until the new one is complete. Verdicts are
    taken from the reports as written, so each audit block is computed once.
    """
    place = f"{work}/audit/{trade_date}"
    for name, block in audit_derivatives(spark, work, trade_date).items():
        sinks.write_report(block, f"{place}/{name}")
    wrong = read_report(spark, f"{place}/files").filter("status <> 'PASS'")
    passed = wrong.isEmpty() and read_report(spark, f"{place}/cross_check").first().expected_match == "true"
    if passed or publish_on_fail:
        days.replace_day(sinks.publishable(finals(spark, work, trade_date, FO), skip), target, trade_date, DERIVATIVE_KEYS, "zstd")
    return passed


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """A block of a report as it was written: text columns."""
    return spark.read.option("header", True).csv(path)


def publish_cash(spark: SparkSession, work: str, trade_date: str, target: str) -> None:
    """Write the cash report and the shared copy of all cash groups."""
    sinks.write_report(audit_cash(spark, work, trade_date), f"{work}/audit/{trade_date}/cash")
    days.replace_day(finals(spark, work, trade_date, CM), target, trade_date, CASH_KEYS, "snappy")
