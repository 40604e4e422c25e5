"""Writes capture files from lanes, so that reading them can be tested.

Each task writes the records it holds to files of its own; they become visible
by a rename when the job commits.
"""

from __future__ import annotations

import io
import itertools
import lzma
import struct
import tarfile
import tempfile
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from tickloom.schema import LANES_DDL
from tickloom.session import ship_package
from tickloom.sources.capture import RECORD
from tickloom.sources.files import filesystem_of

HEADER = ("cap_s", "pad0", "cap_ns_part", "pad1", "msg_len", "stream_id", "seq_no", "msg_type_code")
CLASS_LANES = {
    "NMXGHJ": ("b0_i64", "b8_f64", "b16_i32", "b20_u8", "b21_i32", "b25_i32"),
    "TCK": ("b0_i64", "b8_f64", "b16_f64", "b24_i32", "b28_i32", "b32_i32"),
    "Z": ("b0_i32",),
}


def encode(batch: pa.RecordBatch) -> bytes:
    columns = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in batch.schema.names}
    records = np.zeros(batch.num_rows, dtype=RECORD)
    for name in HEADER:
        records[name] = columns[name]
    for kinds, lanes in CLASS_LANES.items():
        rows = np.isin(columns["msg_type_code"], [ord(kind) for kind in kinds])
        for lane in lanes:
            view = records[lane]
            view[rows] = columns[lane][rows]
    return records.tobytes()


@dataclass
class Written(WriterCommitMessage):
    """Files of a task: (temporary, final)."""

    files: list[tuple[str, str]]


def _varint(value: int) -> bytes:
    out = bytearray()
    while value >= 0x80:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    return bytes(out + bytes([value]))


#: Bytes that are packed at a time.
CHUNK = 1 << 20


def chunks(source: BinaryIO, size: int) -> Iterator[bytes]:
    while data := source.read(size):
        yield data


def packed_xz(pieces: Iterable[bytes]) -> Iterator[bytes]:
    """One xz stream of one block."""
    packer = lzma.LZMACompressor(preset=0)
    for piece in pieces:
        yield packer.compress(piece)
    yield packer.flush()


def blocked_xz(data: bytes, block_bytes: int) -> bytes:
    """One xz stream of many blocks, as a compressor with several threads makes it."""
    return b"".join(blocked_pieces(chunks(io.BytesIO(data), block_bytes)))


def blocked_pieces(pieces: Iterable[bytes]) -> Iterator[bytes]:
    """The same, a block for each piece; only the index is held until the end."""
    head, records, count = b"", bytearray(), 0
    for piece in pieces:
        single = lzma.compress(piece, preset=0)
        index_bytes = (struct.unpack("<I", single[-8:-4])[0] + 1) * 4
        index = single[-12 - index_bytes:-12]
        if not count:
            head = single[:12]
            yield head
        unpadded, shift, place = 0, 0, 2
        while True:
            unpadded |= (index[place] & 0x7F) << shift
            shift += 7
            place += 1
            if index[place - 1] < 0x80:
                break
        yield single[12:-12 - index_bytes]
        records += _varint(unpadded) + _varint(len(piece))
        count += 1
    index = b"\0" + _varint(count) + bytes(records)
    index += b"\0" * (-len(index) % 4)
    index += struct.pack("<I", zlib.crc32(index))
    tail = struct.pack("<I", len(index) // 4 - 1) + head[6:8]
    yield index + struct.pack("<I", zlib.crc32(tail)) + tail + b"YZ"


def by_stem(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Iterator[pa.RecordBatch]]]:
    """The batches of each archive; rows come in order of archives."""
    def cut() -> Iterator[tuple[str, pa.RecordBatch]]:
        for batch in batches:
            stems = batch.column("archive_stem").to_pylist()
            at = 0
            for stem, run in itertools.groupby(stems):
                size = len(list(run))
                yield stem, batch.slice(at, size)
                at += size

    for stem, run in itertools.groupby(cut(), key=lambda item: item[0]):
        yield stem, (batch for _, batch in run)


class CaptureFileWriter(DataSourceArrowWriter):
    """``form`` is plain, archive (xz of one block) or blocks (xz of blocks of ``block_bytes``)."""

    def __init__(self, folder: str, form: str, torn: bytes, named: bool, block_bytes: int):
        self.folder, self.form, self.torn, self.named, self.block_bytes = folder.rstrip("/"), form, torn, named, block_bytes

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        written = []
        for stem, batches in by_stem(iterator) if self.named else [(None, iterator)]:
            pieces = (data for data in map(encode, batches) if data)
            first = next(pieces, None)
            if first is not None:
                written.append(self.write_file(stem or f"feed-{uuid.uuid4().hex}", itertools.chain([first], pieces, [self.torn])))
        return Written(written)

    def write_file(self, name: str, pieces: Iterator[bytes]) -> tuple[str, str]:
        suffix = ".cap" if self.form == "plain" else ".cap.tar.xz"
        if self.form != "plain":
            pieces = self.archived(pieces, f"{name}.cap")
        files, inner = filesystem_of(self.folder)
        files.create_dir(inner, recursive=True)
        temporary = f"{inner}/_{name}-{uuid.uuid4().hex}.part"
        with files.open_output_stream(temporary, compression=None) as out:
            for data in pieces:
                out.write(data)
        return temporary, f"{inner}/{name}{suffix}"

    def archived(self, pieces: Iterator[bytes], name: str) -> Iterator[bytes]:
        """The packed archive, piece by piece.

        The header of its one member states the size, which is known only when
        all records have come: until then they wait in a temporary file of the task.
        """
        with tempfile.TemporaryFile() as held:
            # In this format a header takes as many blocks whatever the size is.
            with tarfile.open(fileobj=held, mode="w", format=tarfile.GNU_FORMAT) as archive:
                member = tarfile.TarInfo(name)
                archive.addfile(member)
                for data in pieces:
                    held.write(data)
                    member.size += len(data)
                held.write(bytes(-member.size % tarfile.BLOCKSIZE))
                archive.offset = held.tell()
            held.seek(0)
            held.write(member.tobuf(archive.format, archive.encoding, archive.errors))
            held.seek(0)
            plain = chunks(held, CHUNK if self.form == "archive" else self.block_bytes)
            yield from packed_xz(plain) if self.form == "archive" else blocked_pieces(plain)

    def commit(self, messages: list) -> None:
        files, _ = filesystem_of(self.folder)
        for message in messages:
            for temporary, final in message.files if message else []:
                files.move(temporary, final)

    def abort(self, messages: list) -> None:
        files, _ = filesystem_of(self.folder)
        for message in messages:
            for temporary, _ in message.files if message else []:
                files.delete_file(temporary)


class CaptureFixture(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tickcapture-fixture"

    def schema(self) -> str:
        return LANES_DDL

    def writer(self, schema: StructType, overwrite: bool) -> CaptureFileWriter:
        options = self.options
        return CaptureFileWriter(options["path"], options.get("form", "plain"), bytes(int(options.get("tornbytes", "0"))),
                                 options.get("named", "false") == "true", int(options.get("blockbytes", "65536")))


def write_capture(lanes: DataFrame, folder: str, form: str = "plain", torn_bytes: int = 0, named: bool = False,
                  block_bytes: int = 1 << 16) -> None:
    """One file per task, or, ``named``, one per ``archive_stem`` under that name, its records in order of ``record_no``."""
    ship_package(lanes.sparkSession)
    lanes.sparkSession.dataSource.register(CaptureFixture)
    if named:
        lanes = lanes.repartition("archive_stem").sortWithinPartitions("archive_stem", "record_no")
    (lanes.write.format("tickcapture-fixture").mode("append").option("path", folder).option("form", form)
     .option("tornBytes", torn_bytes).option("named", str(named).lower()).option("blockBytes", block_bytes).save())
