"""Cost-balanced packing of documents into token sequences."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import documents, frugal, prepare
from tickloom.llm.wordbpe import TABLE_BYTES, word_bpe


#: Bytes of a batch of pieces, which the task holds and, as it reads it, the JVM; and of a piece besides its ids.
OUT_BYTES, PIECE = 1 << 21, 64

NAMES = ("id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "padded_length")


@dataclass(frozen=True)
class Cost:
    """Estimated work of a sequence: tokens times ``linear``, and the square of each piece's length times ``quadratic``.

    Attention stays within a piece, so squares are summed by piece.
    """

    linear: float = 4096.0
    quadratic: float = 1.0

    def of(self, length: int) -> float:
        return self.linear * length + self.quadratic * length * length


def assign(lengths: list[int], capacity: int, cost: Cost) -> list[tuple[int, int, int, int]]:
    """Places (item, cut, length, sequence) for items shorter than a sequence.

    Items go in descending order, each to the sequence of lowest cost so far
    that has room for all of it. There are as many sequences as the tokens
    need, so what fits nowhere as a whole is cut over the roomiest ones. Ties
    go to the earlier item and the lower sequence number.
    """
    total = sum(lengths)
    n = -(-total // capacity)
    # The last sequence may stay short, so that padding gathers in one place.
    free = np.full(n, capacity, np.int64)
    free[n - 1 :] -= n * capacity - total
    spent = np.zeros(n)
    placed, late = [], []
    for item in sorted(range(len(lengths)), key=lambda item: -lengths[item]):
        length = lengths[item]
        open_to = np.where(free >= length, spent, np.inf)
        best = int(open_to.argmin())
        if open_to[best] == np.inf:
            late.append(item)
            continue
        placed.append((item, 0, length, best))
        free[best] -= length
        spent[best] += cost.of(length)
    room = [(-int(left), sequence) for sequence, left in enumerate(free) if left]
    heapq.heapify(room)
    for item in late:
        start = 0
        while start < lengths[item]:
            left, sequence = heapq.heappop(room)
            length = min(-left, lengths[item] - start)
            placed.append((item, start, length, sequence))
            start += length
            if length < -left:
                heapq.heappush(room, (left + length, sequence))
    return placed


class Packer:
    """Packs a stream of documents, a bounded number of tokens and of documents at a time."""

    def __init__(self, capacity: int, pool_tokens: int, cost: Cost, first: int, pool_documents: int = 1 << 16) -> None:
        self.capacity, self.pool_tokens, self.pool_documents, self.cost, self.sequence = capacity, pool_tokens, pool_documents, cost, first
        self.pool: list[tuple[pa.Scalar, int, int, bytes]] = []
        self.waiting = 0

    def add(self, key: pa.Scalar, ids: bytes) -> Iterator[tuple]:
        """Full sequences of a long document at once; its rest waits for company."""
        tokens = len(ids) // 4
        whole = tokens - tokens % self.capacity
        for start in range(0, whole, self.capacity):
            yield key, start, self.capacity, ids[4 * start : 4 * (start + self.capacity)], tokens, self.sequence, 0, self.capacity
            self.sequence += 1
        if tokens > whole:
            self.pool.append((key, whole, tokens, ids[4 * whole :]))
            self.waiting += tokens - whole
            if self.waiting >= self.pool_tokens or len(self.pool) >= self.pool_documents:
                yield from self.flush()

    def flush(self) -> Iterator[tuple]:
        pool, self.pool, self.waiting = self.pool, [], 0
        placed = assign([len(ids) // 4 for _, _, _, ids in pool], self.capacity, self.cost)
        filled: dict[int, int] = {}
        ends: dict[int, int] = {}
        for _, _, length, sequence in placed:
            ends[sequence] = ends.get(sequence, 0) + length
        for item, cut, length, sequence in placed:
            key, start, tokens, ids = pool[item]
            offset = filled.get(sequence, 0)
            filled[sequence] = offset + length
            padded = ends[sequence] if ends[sequence].bit_count() == 1 else self.capacity
            yield (key, start + cut, length, ids[4 * cut : 4 * (cut + length)], tokens,
                   self.sequence + sequence, offset, padded)
        self.sequence += len(ends)


def pack(docs: DataFrame, definition: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1,
         capacity: int = 2048, pool_tokens: int = 1 << 22, cost: Cost = Cost(), pool_documents: int = 1 << 16, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """Pieces of documents in sequences of at most ``capacity`` tokens, balanced by estimated attention cost.

    ``definition`` is the JSON text of a word-wise tokenizer; it travels with
    the tasks. Each task tokenizes its own rows and packs about
    ``pool_tokens`` tokens, of ``pool_documents`` documents at most, at a time,
    so nothing is shuffled, memory is bounded whatever the input, and at most
    one sequence of each pool is short. Words seen are kept in about ``table_bytes``. Sequence numbers are the task's number, then a count.

    Returns (id, start, length, ids as little-endian unsigned 32-bit binary,
    doc_tokens, sequence_id, offset, padded_length). Null and empty texts are
    a document of ``end_id`` alone; repeated rows are packed each for itself;
    a null id stays null; other columns are ignored; no rows give no pieces.
    Texts of any length are cut at sequence ends.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    kind = rows.schema["id"].dataType
    holder = docs.sparkSession.sparkContext.broadcast(definition)
    tail = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(capacity, pool_tokens, cost, TaskContext.get().partitionId() << 33, pool_documents)

        def pieces() -> Iterator[tuple]:
            rows = documents(batches)
            first = next(rows, None)
            if first:
                encoder = word_bpe(holder.value, table_bytes)
                for key, ids in encoder.each(chain([first], rows)):
                    yield from packer.add(key, ids + tail)
                yield from packer.flush()
                encoder.rest()

        yield from batches_of(pieces())

    schema = T.StructType([T.StructField("id", kind)] + [
        T.StructField(name, T.BinaryType() if name == "ids" else T.LongType()) for name in NAMES[1:]])
    return rows.mapInArrow(frugal(run), schema).withColumnRenamed("id", id_col)


def batches_of(pieces: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Batches of about ``OUT_BYTES``, as the pieces come; none without pieces."""
    held, size = [], 0
    for piece in pieces:
        held.append(piece)
        size += len(piece[3]) + PIECE
        if size >= OUT_BYTES:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def _batch(pieces: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*pieces, strict=True))
    arrays = [pa.array([key.as_py() for key in columns[0]], columns[0][0].type)]
    for name, values in zip(NAMES[1:], columns[1:], strict=True):
        arrays.append(pa.array(values, pa.binary() if name == "ids" else pa.int64()))
    return pa.RecordBatch.from_arrays(arrays, names=list(NAMES))
