"""Reading an xz file from the middle.

An xz file made by several threads is a row of independent blocks with an index
at its end. A task can start at any block: the decompressor needs the stream
header, then takes blocks one after another. Files of one block, or of several
streams, have no such places; they are read from the start.
"""

from __future__ import annotations

import bisect
import lzma
import struct
from dataclasses import dataclass

HEADER_BYTES = 12
FOOTER_BYTES = 12
MAGIC = b"\xfd7zXZ\x00"
FOOTER_MAGIC = b"YZ"
# Packed bytes read at a time: few at first, as a part may need no more than a block or two.
FIRST_CHUNK = 64 << 10
CHUNK = 4 << 20


@dataclass(frozen=True)
class BlockIndex:
    """Where each block starts, in the file and in the data it unpacks to."""

    packed: list[int]
    unpacked: list[int]
    packed_end: int
    size: int


def _number(data: bytes, at: int) -> tuple[int, int]:
    """One variable-length integer and the place after it."""
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if byte < 0x80:
            return value, at


def read_index(raw, length: int) -> BlockIndex | None:
    """Block index of a one-stream xz file, None for anything else."""
    if length < HEADER_BYTES + FOOTER_BYTES:
        return None
    raw.seek(0)
    if raw.read(len(MAGIC)) != MAGIC:
        return None
    raw.seek(length - FOOTER_BYTES)
    footer = raw.read(FOOTER_BYTES)
    if footer[10:12] != FOOTER_MAGIC:
        return None
    index_bytes = (struct.unpack_from("<I", footer, 4)[0] + 1) * 4
    index_start = length - FOOTER_BYTES - index_bytes
    if index_start < HEADER_BYTES:
        return None
    raw.seek(index_start)
    data = raw.read(index_bytes)
    count, at = _number(data, 1)
    packed, unpacked, place, size = [], [], HEADER_BYTES, 0
    for _ in range(count):
        packed.append(place)
        unpacked.append(size)
        block, at = _number(data, at)
        bytes_out, at = _number(data, at)
        place += -(-block // 4) * 4
        size += bytes_out
    # A second stream in front would leave a gap between header and index.
    return BlockIndex(packed, unpacked, index_start, size) if place == index_start else None


class BlockStream:
    """Unpacked data from one block start up to the end of the last block."""

    def __init__(self, raw, packed_start: int, packed_end: int):
        self.raw, self.place, self.end, self.chunk = raw, packed_start, packed_end, FIRST_CHUNK
        self.unpacker = lzma.LZMADecompressor(format=lzma.FORMAT_XZ)
        raw.seek(0)
        self.unpacker.decompress(raw.read(HEADER_BYTES))
        raw.seek(packed_start)

    def read(self, wanted: int) -> bytes:
        """Up to ``wanted`` bytes; fewer only at the end."""
        parts, missing = [], wanted
        while missing > 0:
            data = b""
            if self.unpacker.needs_input:
                data = self.raw.read(min(self.chunk, self.end - self.place))
                self.place += len(data)
                self.chunk = min(2 * self.chunk, CHUNK)
            got = self.unpacker.decompress(data, max_length=missing)
            if not got and self.unpacker.needs_input and self.place >= self.end:
                break
            if not got and not data and self.unpacker.needs_input:
                raise EOFError("xz file ends inside a block")
            parts.append(got)
            missing -= len(got)
        return b"".join(parts)

    def skip(self, count: int) -> None:
        while count > 0:
            got = len(self.read(min(CHUNK, count)))
            if not got:
                return
            count -= got


class BlockFile:
    """Just enough of a file for walking the members of an archive."""

    def __init__(self, raw, index: BlockIndex):
        self.raw, self.index, self.place = raw, index, 0

    def seek(self, place: int, whence: int = 0) -> int:
        self.place = place + (0, self.place, self.index.size)[whence]
        return self.place

    def tell(self) -> int:
        return self.place

    def read(self, wanted: int = -1) -> bytes:
        left = self.index.size - self.place
        wanted = left if wanted < 0 else min(wanted, left)
        if wanted <= 0:
            return b""
        block = bisect.bisect_right(self.index.unpacked, self.place) - 1
        stream = BlockStream(self.raw, self.index.packed[block], self.index.packed_end)
        stream.skip(self.place - self.index.unpacked[block])
        data = stream.read(wanted)
        self.place += len(data)
        return data
