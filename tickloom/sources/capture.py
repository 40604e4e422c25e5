"""Spark data source for fixed-width capture files, plain or archived.

A plain capture is cut into byte ranges that hold whole records, one task per
range. A large xz archive of several blocks is cut at block starts; any other
archive is read by one task. Ranges and archives far below a split's size share
tasks. Archives are streamed through the decompressor without touching the local
disk, and a task holds one batch of records at a time. A torn last record is no
row of the scan, however it is cut; ``torn_records`` lists them.
"""

from __future__ import annotations

import dataclasses
import json
import logging
import lzma
import tarfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType
from pyspark.sql.pandas.types import to_arrow_schema

from tickloom.functions.text import archive_stem_of
from tickloom.schema import LANES_DDL, RECORD_BYTES, UNREADABLE
from tickloom.session import ship_package
from tickloom.sources import xz
from tickloom.sources.files import filesystem_of

FORMAT = "tickcapture"
BODY = 35

# Lane -> (little-endian type, byte offset). Lanes of the body overlap.
LANE_LAYOUT = {
    "cap_s": ("<u4", 0),
    "pad0": ("<u4", 4),
    "cap_ns_part": ("<u4", 8),
    "pad1": ("<u4", 12),
    "msg_len": ("<i2", 26),
    "stream_id": ("<i2", 28),
    "seq_no": ("<i4", 30),
    "msg_type_code": ("u1", 34),
    "b0_i64": ("<i8", BODY),
    "b0_i32": ("<i4", BODY),
    "b8_f64": ("<f8", BODY + 8),
    "b16_f64": ("<f8", BODY + 16),
    "b16_i32": ("<i4", BODY + 16),
    "b20_u8": ("u1", BODY + 20),
    "b21_i32": ("<i4", BODY + 21),
    "b24_i32": ("<i4", BODY + 24),
    "b25_i32": ("<i4", BODY + 25),
    "b28_i32": ("<i4", BODY + 28),
    "b32_i32": ("<i4", BODY + 32),
}
RECORD = np.dtype({
    "names": list(LANE_LAYOUT),
    "formats": [kind for kind, _ in LANE_LAYOUT.values()],
    "offsets": [offset for _, offset in LANE_LAYOUT.values()],
    "itemsize": RECORD_BYTES,
})

SPLIT_BYTES = 256 << 20
MAX_SPLITS = 100_000
# What opening a file costs, as bytes read meanwhile.
OPEN_BYTES = 4 << 20
# Tasks that each core has before splits cheaper than an opened file share one.
TASKS_PER_CORE = 4
PROBE_BYTES = 32 << 20
# Captures unpack to roughly this many times their size; it only sets how
# coarse the parts become when there would be too many of them.
UNPACKED_RATIO = 10
UNREADABLE_ERRORS = (OSError, EOFError, ValueError, tarfile.TarError, lzma.LZMAError)
LOG = logging.getLogger(__name__)


@dataclass
class CaptureSplit(InputPartition):
    """Records ``first .. first + count`` of a capture, or a whole archive.

    For a part of an archive, ``packed_start`` and ``packed_end`` bound the xz
    blocks to unpack and ``skip`` the bytes before the first record.
    """

    path: str
    first: int
    count: int | None
    packed_start: int | None = None
    packed_end: int | None = None
    skip: int = 0


@dataclass
class CaptureBundle(InputPartition):
    """Several splits for one task, one after another."""

    splits: list[CaptureSplit]


def bundles(splits: list[tuple[CaptureSplit, int]], split_bytes: int, max_splits: int, parallelism: int) -> list[InputPartition]:
    """Splits, each with its unpacked bytes, gathered into tasks of about ``split_bytes``.

    Every split also costs an opened file. Tasks stay smaller while there would
    be too few of them for all cores, and grow when there would be more than
    ``max_splits``. Where ``split_bytes`` is below the cost of opening a file,
    splits share tasks once every core has several. The largest come first;
    each task takes splits until the next one would make it too large.
    """
    total = sum(size + OPEN_BYTES for _, size in splits)
    limit = max(min(split_bytes, max(OPEN_BYTES, total // max(parallelism, 1))), total // max_splits)
    if split_bytes < OPEN_BYTES:
        limit = max(limit, min(SPLIT_BYTES, total // (TASKS_PER_CORE * max(parallelism, 1))))
    tasks: list[InputPartition] = []
    held, held_bytes = [], 0
    for split, size in sorted(splits, key=lambda item: -item[1]):
        if held and held_bytes + size + OPEN_BYTES > limit:
            tasks.append(held[0] if len(held) == 1 else CaptureBundle(held))
            held, held_bytes = [], 0
        held.append(split)
        held_bytes += size + OPEN_BYTES
    if held:
        tasks.append(held[0] if len(held) == 1 else CaptureBundle(held))
    return tasks


def is_plain(path: str) -> bool:
    return path.endswith(".cap")


def plan_splits(files: Sequence[tuple[str, int]], split_bytes: int, max_splits: int) -> list[CaptureSplit]:
    """Cut captures into record ranges of about ``split_bytes``.

    Ranges grow when there would be more than ``max_splits`` of them, which
    bounds what the driver plans; no record is left out either way. Archives
    come first, the largest ahead, so that none of them is started last.
    """
    files = sorted(files, key=lambda file: (is_plain(file[0]), -file[1], file[0]))
    plain_bytes = sum(size for path, size in files if is_plain(path))
    per_split = max(split_bytes, -(-plain_bytes // max_splits), RECORD_BYTES) // RECORD_BYTES
    splits = []
    for path, size in files:
        if not is_plain(path):
            splits.append(CaptureSplit(path, 0, None))
            continue
        records = size // RECORD_BYTES
        for first in range(0, records, per_split):
            splits.append(CaptureSplit(path, first, min(per_split, records - first)))
    return splits


def capture_members(archive: tarfile.TarFile) -> Iterator[tarfile.TarInfo]:
    for member in archive:
        name = member.name.removeprefix("./")
        if member.isfile() and "/" not in name and name.endswith(".cap"):
            yield member


def check_members(path: str, found: int, members: str) -> None:
    if found == 0:
        raise ValueError(f"{path}: no capture inside")
    if found > 1 and members == "one":
        raise ValueError(f"{path}: expected one capture, found more")


def archive_splits(path: str, length: int, raw, split_bytes: int, members: str) -> list[CaptureSplit]:
    """Parts of an xz archive, each from a block start; a single whole otherwise.

    A part owns the records that begin in its blocks. The last of them may end
    in the next block, which the part then unpacks as far as needed.
    """
    index = xz.read_index(raw, length)
    if index is None or len(index.packed) < 2:
        return [CaptureSplit(path, 0, None)]
    with tarfile.open(fileobj=xz.BlockFile(raw, index), mode="r:") as archive:
        found = list(capture_members(archive))
    check_members(path, len(found), members)
    begin, records = found[0].offset_data, found[0].size // RECORD_BYTES
    splits, from_block = [], 0
    for block in range(1, len(index.packed) + 1):
        last = block == len(index.packed)
        stop = index.size if last else index.unpacked[block]
        start = index.unpacked[from_block]
        if not last and stop - start < split_bytes:
            continue
        first = min(max(0, -(-(start - begin) // RECORD_BYTES)), records)
        after = records if last else min(max(0, -(-(stop - begin) // RECORD_BYTES)), records)
        if after > first:
            splits.append(CaptureSplit(path, first, after - first, index.packed[from_block], index.packed_end,
                                       begin + first * RECORD_BYTES - start))
        from_block = block
    return splits


def read_exactly(stream, wanted: int) -> bytes:
    parts, missing = [], wanted
    while missing > 0:
        part = stream.read(missing)
        if not part:
            break
        parts.append(part)
        missing -= len(part)
    return b"".join(parts) if len(parts) != 1 else parts[0]


def record_batches(stream, name: str, batch_records: int, count: int | None) -> Iterator[np.ndarray]:
    """Whole records of a stream, batch by batch; a torn last record is dropped.

    A stream that ends before a planned ``count`` is an error, not a short result.
    """
    left = count
    while left is None or left > 0:
        take = batch_records if left is None else min(batch_records, left)
        data = read_exactly(stream, take * RECORD_BYTES)
        whole = len(data) // RECORD_BYTES
        if whole:
            yield np.frombuffer(data, dtype=RECORD, count=whole)
        if len(data) < take * RECORD_BYTES:
            if left is not None and whole < left:
                raise EOFError(f"{name}: {left - whole} records fewer than planned")
            return
        if left is not None:
            left -= whole


class CaptureReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.arrow_schema = to_arrow_schema(schema)
        self.files = [(path, int(size)) for path, size in json.loads(options.get("files", "[]"))]
        self.parts = json.loads(options.get("parts", "[]"))
        self.split_bytes = int(options.get("splitbytes", SPLIT_BYTES))
        self.max_splits = int(options.get("maxsplits", MAX_SPLITS))
        self.parallelism = int(options.get("parallelism", 1))
        self.batch_records = int(options.get("batchrecords", 65_536))
        self.planned = False
        self.members = options.get("members", "one")
        self.unreadable = options.get("unreadable", "fail")
        self.types = [ord(kind) for kind in options.get("types", "")]

    def partitions(self) -> Sequence[InputPartition]:
        splits = [CaptureSplit(*part) for part in self.parts]
        splits += plan_splits(self.files, self.split_bytes, self.max_splits)
        packed = dict(self.files)
        sized = [(split, packed[split.path] * UNPACKED_RATIO if split.count is None and split.path in packed
                  else self.split_bytes if split.count is None else split.count * RECORD_BYTES) for split in splits]
        self.planned = True
        return bundles(sized, self.split_bytes, self.max_splits, self.parallelism) or [CaptureSplit("", 0, 0)]

    def __getstate__(self) -> dict:
        """Tasks get their split; the list of all files stays behind."""
        return {**self.__dict__, "files": [], "parts": []} if self.planned else self.__dict__

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        for split in partition.splits if isinstance(partition, CaptureBundle) else [partition]:
            yield from self.read_split(split)

    def read_split(self, partition: CaptureSplit) -> Iterator[pa.RecordBatch]:
        if partition.count == 0:
            return
        stem = archive_stem_of(partition.path)
        try:
            yield from self.split_batches(partition, stem)
        except UNREADABLE_ERRORS as problem:
            if self.unreadable != "mark":
                raise
            LOG.warning("%s: %s", partition.path, problem)
            marker = np.zeros(1, dtype=RECORD)
            yield self.record_batch(marker, np.full(1, UNREADABLE, dtype=np.int64), stem)

    def split_batches(self, partition: CaptureSplit, stem: str) -> Iterator[pa.RecordBatch]:
        files, inner = filesystem_of(partition.path)
        if partition.packed_start is not None:
            with files.open_input_file(inner) as raw:
                stream = xz.BlockStream(raw, partition.packed_start, partition.packed_end)
                stream.skip(partition.skip)
                batches = record_batches(stream, partition.path, self.batch_records, partition.count)
                yield from self.arrow_batches(batches, stem, partition.first)
        elif partition.count is not None:
            with files.open_input_file(inner) as stream:
                stream.seek(partition.first * RECORD_BYTES)
                batches = record_batches(stream, partition.path, self.batch_records, partition.count)
                yield from self.arrow_batches(batches, stem, partition.first)
        else:
            with files.open_input_stream(inner, compression=None) as stream:
                yield from self.archive_batches(stream, partition.path, stem)

    def archive_batches(self, stream, path: str, stem: str) -> Iterator[pa.RecordBatch]:
        found = 0
        with tarfile.open(fileobj=stream, mode="r|*") as archive:
            for member in capture_members(archive):
                found += 1
                if found > 1:
                    break
                batches = record_batches(archive.extractfile(member), path, self.batch_records, None)
                yield from self.arrow_batches(batches, stem, 0)
        check_members(path, found, self.members)

    def arrow_batches(self, batches: Iterator[np.ndarray], stem: str, first: int) -> Iterator[pa.RecordBatch]:
        for records in batches:
            numbers = np.arange(first, first + len(records), dtype=np.int64)
            first += len(records)
            if self.types:
                keep = np.isin(records["msg_type_code"], self.types)
                records, numbers = records[keep], numbers[keep]
            if len(records):
                yield self.record_batch(records, numbers, stem)

    def record_batch(self, records: np.ndarray, numbers: np.ndarray, stem: str) -> pa.RecordBatch:
        columns = [self.column(field, records, numbers, stem) for field in self.arrow_schema]
        return pa.record_batch(columns, schema=self.arrow_schema)

    @staticmethod
    def column(field: pa.Field, records: np.ndarray, numbers: np.ndarray, stem: str) -> pa.Array:
        if field.name == "archive_stem":
            return pa.repeat(pa.scalar(stem, type=field.type), len(records))
        if field.name == "record_no":
            return pa.array(numbers, type=field.type)
        lane = records[field.name].astype(field.type.to_pandas_dtype())
        return pa.array(lane, type=field.type)


class CaptureDataSource(DataSource):
    """``spark.read.format("tickcapture")`` over a list of files with sizes."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return LANES_DDL

    def reader(self, schema: StructType) -> DataSourceReader:
        return CaptureReader(schema, self.options)


def lanes_schema(columns: Sequence[str] | None) -> str:
    fields = LANES_DDL.split(", ")
    if columns is None:
        return LANES_DDL
    by_name = {field.split()[0]: field for field in fields}
    return ", ".join(by_name[name] for name in columns)


def read_capture(spark: SparkSession, listing: DataFrame, columns: Sequence[str] | None = None,
                 **options: object) -> DataFrame:
    """Lanes of every record in the listed files.

    ``listing`` has ``path`` and ``length``; only this file metadata reaches the
    driver, as it does for any file scan. ``columns`` names the lanes to decode,
    so the others never leave the Python worker; the option ``types`` does the
    same for records of unwanted message types. Both are given here and not
    left to filter push-down, which in this version of the Python data source
    API stays with the relation and would also filter its next query.
    """
    ship_package(spark)
    spark.dataSource.register(CaptureDataSource)
    probe_bytes = int(options.pop("probe_bytes", PROBE_BYTES))
    large = F.col("path").endswith(".xz") & (F.col("length") >= probe_bytes)
    found = listing.select("path", "length", F.coalesce(large, F.lit(False)).alias("large")).collect()
    files = [(row.path, row.length) for row in found if not row.large]
    packed = sum(row.length for row in found if row.large)
    parts = []
    if packed:
        split_bytes = max(int(options.get("split_bytes", SPLIT_BYTES)),
                          packed * UNPACKED_RATIO // int(options.get("max_splits", MAX_SPLITS)))
        probed = probe_archives(listing.filter(large), split_bytes, str(options.get("members", "one")),
                                str(options.get("unreadable", "fail")))
        parts = [tuple(row) for row in probed.collect()]
    reader = spark.read.format(FORMAT).schema(lanes_schema(columns))
    reader = reader.option("files", json.dumps(files)).option("parts", json.dumps(parts))
    reader = reader.option("parallelism", spark.sparkContext.defaultParallelism)
    for key, value in options.items():
        reader = reader.option(key.replace("_", ""), str(value))
    return reader.load()


def probe_archives(archives: DataFrame, split_bytes: int, members: str, unreadable: str) -> DataFrame:
    """Parts of large archives, found by tasks that read their block indexes."""
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            splits = []
            for path, length in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist(), strict=True):
                files, inner = filesystem_of(path)
                try:
                    with files.open_input_file(inner) as raw:
                        splits += archive_splits(path, length, raw, split_bytes, members)
                except UNREADABLE_ERRORS:
                    if unreadable != "mark":
                        raise
                    splits.append(CaptureSplit(path, 0, None))
            columns = zip(*[dataclasses.astuple(split) for split in splits], strict=True) if splits else [[]] * 6
            yield pa.record_batch([pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)], names=names)

    names = [field.name for field in dataclasses.fields(CaptureSplit)]
    kinds = [pa.string()] + [pa.int64()] * (len(names) - 1)
    ddl = ", ".join(f"{name} {'STRING' if name == 'path' else 'BIGINT'}" for name in names)
    spread = archives.select("path", "length").repartition(archives.sparkSession.sparkContext.defaultParallelism)
    return spread.mapInArrow(probe, ddl)


TORN_DDL = "archive_stem STRING, path STRING, form STRING, records BIGINT, torn_bytes BIGINT, problem STRING"


def torn_records(listing: DataFrame, unreadable: str = "fail") -> DataFrame:
    """Whole records of each listed file and the bytes of its torn last one: a relation beside the scan, however that is cut.

    (archive_stem, path, form, records, torn_bytes, problem), a row per file;
    ``form`` is plain, whole (an archive that one task streams) or blocks. A
    plain capture is judged by its size, an archive by the size that its first
    capture's header states, of which a task unpacks only the beginning. An
    archive that can't be read that far fails, or has nulls and the problem
    (``unreadable="mark"``); damage further in is found by the scan.
    """
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path, length in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist(), strict=True):
                form, size, problem = "plain", length, None
                if not is_plain(path):
                    try:
                        form, size = archived_size(path, length)
                    except UNREADABLE_ERRORS as wrong:
                        if unreadable != "mark":
                            raise
                        form, size, problem = "whole", None, str(wrong)
                known = size is not None
                rows.append((archive_stem_of(path), path, form, size // RECORD_BYTES if known else None, size % RECORD_BYTES if known else None, problem))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
            yield pa.record_batch([pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)], names=names)

    names = [field.split()[0] for field in TORN_DDL.split(", ")]
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    ship_package(listing.sparkSession)
    spread = listing.select("path", "length").repartition(listing.sparkSession.sparkContext.defaultParallelism)
    return spread.mapInArrow(probe, TORN_DDL)


def archived_size(path: str, length: int) -> tuple[str, int]:
    """Form of an archive and the size of the first capture in it."""
    files, inner = filesystem_of(path)
    with files.open_input_file(inner) as raw:
        index = xz.read_index(raw, length) if path.endswith(".xz") else None
        if index is not None and len(index.packed) > 1:
            with tarfile.open(fileobj=xz.BlockFile(raw, index), mode="r:") as archive:
                member = next(capture_members(archive), None)
            form = "blocks"
        else:
            raw.seek(0)
            with tarfile.open(fileobj=raw, mode="r|*") as archive:
                member = next(capture_members(archive), None)
            form = "whole"
    check_members(path, int(member is not None), "first")
    return form, member.size


def trailing_bytes(listing: DataFrame) -> DataFrame:
    """Size of the torn last record of each plain capture, 0 where whole."""
    plain = listing.filter(F.col("path").endswith(".cap"))
    return plain.withColumn("trailing_bytes", F.col("length") % RECORD_BYTES)
