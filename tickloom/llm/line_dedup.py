"""Line dedup by a sharded minimal perfect hash over distinct lines, with compact arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import mixed, prepare, stored, text_bytes

#: White space that is stripped: U+0020 and U+0009 to U+000D.
SPACES = b" \t\n\x0b\x0c\r"
#: Bits of a level of the hash for each key that is still without a place.
LOAD = 2
#: Distinct lines of a shard and bytes of a batch of texts, both about.
SHARD_KEYS, BATCH_BYTES = 1 << 20, 16 << 20
#: Bytes of texts that a task of the last step takes, about.
TASK_BYTES = 32 << 20


def line_key(line: bytes, least: int) -> bytes | None:
    """The line without white space at its ends, A-Z in lower case; None if shorter than so many code points."""
    key = line.strip(SPACES).lower()
    if len(key) < least or (len(key) < 4 * least and len(key.decode()) < least):
        return None
    return key


def line_hashes(text: bytes, least: int) -> tuple[list[bytes], list[bytes | None]]:
    """The lines of a text, and the 128-bit hash of each line's key."""
    lines = text.split(b"\n")
    return lines, [key and xxhash.xxh3_128_digest(key) for key in (line_key(line, least) for line in lines)]


def pairs_of(digests) -> np.ndarray:
    """Digests as rows of two 64-bit numbers."""
    return np.frombuffer(b"".join(digests), ">u8").astype(np.uint64).reshape(-1, 2)


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys[:, 0] >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def merged(keys: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, with the least and the greatest id of each."""
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    keys, low, high = keys[order], low[order], high[order]
    starts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
    return keys[starts], np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)


# --- the perfect hash --------------------------------------------------------------


def _level_hash(keys: np.ndarray, level: int) -> np.ndarray:
    return mixed(keys[:, 0] ^ mixed(keys[:, 1] + np.uint64(level * 0x9E3779B97F4A7C15 % (1 << 64))))


class PerfectHash:
    """Numbers 0 to n - 1 for n distinct keys: each level keeps, as a set bit, the keys that no other one meets there.

    A key's number is the rank of its bit over all levels. Keys that were not
    built in get any number, or -1.
    """

    def __init__(self, levels: list[np.ndarray]) -> None:
        #: Of each level its bits, one a byte while used.
        self.levels = levels
        self.ranks, total = [], 0
        for bits in levels:
            self.ranks.append(np.cumsum(bits, dtype=np.int64) - bits + total)
            total += int(bits.sum())
        self.size = total

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        while len(keys):
            size = max(LOAD * len(keys), 64)
            at = (_level_hash(keys, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size)[at] == 1
            bits = np.zeros(size, np.uint8)
            bits[at[alone]] = 1
            levels.append(bits)
            keys = keys[~alone]
        return cls(levels)

    def number(self, keys: np.ndarray) -> np.ndarray:
        found, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks, strict=True)):
            at = (_level_hash(keys[open_], level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at] == 1
            found[open_[hit]] = ranks[at[hit]]
            open_ = open_[~hit]
        return found

    def dump(self) -> tuple[bytes, list[int]]:
        return b"".join(np.packbits(bits).tobytes() for bits in self.levels), [len(bits) for bits in self.levels]

    @classmethod
    def load(cls, data: bytes, sizes: list[int]) -> PerfectHash:
        levels, at = [], 0
        for size in sizes:
            levels.append(np.unpackbits(np.frombuffer(data, np.uint8, -(-size // 8), at), count=size))
            at += -(-size // 8)
        return cls(levels)


class Shard:
    """One shard of the index: the hash, a fingerprint and a count for each line, the first document of repeated ones."""

    def __init__(self, hashed: PerfectHash, fingerprints: np.ndarray, counts: np.ndarray, firsts: np.ndarray) -> None:
        self.hashed, self.fingerprints, self.counts, self.firsts = hashed, fingerprints, counts, firsts
        self.places = np.cumsum(counts > 1) - 1

    def probe(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which keys are lines of several documents, the first document of these)."""
        number = self.hashed.number(keys)
        known = number >= 0
        number[~known] = 0
        if not self.hashed.size:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        several = np.flatnonzero(known & (self.fingerprints[number] == keys[:, 1].astype(np.uint32)) & (self.counts[number] > 1))
        return several, self.firsts[self.places[number[several]]]


# --- documents in batches ------------------------------------------------------------


def _batched(batch_bytes: int):
    """Documents with the number of their batch: neighbours of about so many bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = None, 0
        for batch in batches:
            if number is None and batch.num_rows:
                number = batch.column(0)[0].as_py() << 28
            numbers, sizes = [], pc.fill_null(pc.binary_length(batch.column(2)), 0)
            for size in sizes.to_pylist():
                if held >= batch_bytes:
                    number, held = number + 1, 0
                numbers.append(number)
                held += size + 64
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), batch.column(1), batch.column(2), sizes.cast(pa.int64())], names=["batch", "id", "text", "size"])

    return run


SENT = "batch long, shard int, keys binary, low binary, high binary"


def _lines(shards: int, least: int):
    """The distinct lines of each batch by shard, with the least and the greatest id that holds them."""

    def flush(batch: int, digests: list[bytes], ids: list[int]) -> pa.RecordBatch:
        rows = {name: [] for name in ("batch", "shard", "keys", "low", "high")}
        if digests:
            holders = np.array(ids, np.int64)
            keys, low, high = merged(pairs_of(digests), holders, holders)
            where = shard_of(keys, shards)
            edges = np.searchsorted(where, np.arange(shards + 1))
            for shard in np.flatnonzero(np.diff(edges)):
                part = slice(edges[shard], edges[shard + 1])
                for name, value in (("batch", batch), ("shard", int(shard)), ("keys", keys[part].tobytes()), ("low", low[part].tobytes()), ("high", high[part].tobytes())):
                    rows[name].append(value)
        return pa.RecordBatch.from_arrays([pa.array(rows["batch"], pa.int64()), pa.array(rows["shard"], pa.int32()),
                                           *(pa.array(rows[name], pa.binary()) for name in ("keys", "low", "high"))], names=list(rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digests, ids = None, [], []
        for rows in batches:
            for batch, key, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), rows.column(2), strict=True):
                if batch != now:
                    if digests:
                        yield flush(now, digests, ids)
                    now, digests, ids = batch, [], []
                if key is not None:
                    own = {digest for digest in line_hashes(text_bytes(text), least)[1] if digest}
                    digests.extend(own)
                    ids.extend([key] * len(own))
        if digests:
            yield flush(now, digests, ids)

    return run


def _numbers(data: pa.Scalar, kind=np.int64) -> np.ndarray:
    return np.frombuffer(text_bytes(data), kind)


SHARD = "shard int, size long, levels binary, level_sizes array<long>, fingerprints binary, counts binary, firsts binary"


def _build(rows: pa.Table) -> pa.Table:
    """A shard's index from the lines of all batches."""
    keys = np.concatenate([_numbers(data, np.uint64) for data in rows.column("keys")]).reshape(-1, 2)
    keys, low, high = merged(keys, *(np.concatenate([_numbers(data) for data in rows.column(name)]) for name in ("low", "high")))
    hashed = PerfectHash.build(keys)
    number = hashed.number(keys)
    fingerprints, counts, firsts = np.zeros(len(keys), np.uint32), np.zeros(len(keys), np.uint8), np.zeros(len(keys), np.int64)
    fingerprints[number] = keys[:, 1].astype(np.uint32)
    # One document, or several: more is never asked for.
    counts[number] = np.where(low < high, 2, 1)
    firsts[number] = low
    data, sizes = hashed.dump()
    return pa.table({"shard": pa.array([rows.column("shard")[0].as_py()], pa.int32()), "size": pa.array([len(keys)], pa.int64()), "levels": pa.array([data], pa.binary()),
                     "level_sizes": pa.array([sizes], pa.list_(pa.int64())), "fingerprints": pa.array([fingerprints.tobytes()], pa.binary()),
                     "counts": pa.array([np.packbits(counts > 1).tobytes()], pa.binary()), "firsts": pa.array([firsts[counts > 1].tobytes()], pa.binary())})


def read_shard(row: dict) -> Shard:
    counts = np.unpackbits(np.frombuffer(row["counts"], np.uint8), count=row["size"]) + np.uint8(1)
    return Shard(PerfectHash.load(row["levels"], row["level_sizes"]), np.frombuffer(row["fingerprints"], np.uint32), counts, np.frombuffer(row["firsts"], np.int64))


ANSWER = "batch long, keys binary, firsts binary"
_ANSWER = pa.schema([("batch", pa.int64()), ("keys", pa.binary()), ("firsts", pa.binary())])


def _probe(probes: pa.Table, index: pa.Table) -> pa.Table:
    """For each batch's lines of one shard: those that several documents hold, with the first of these."""
    if not probes.num_rows or not index.num_rows:
        return _ANSWER.empty_table()
    shard, rows = read_shard(index.to_pylist()[0]), []
    for batch, data in zip(probes.column("batch").to_pylist(), probes.column("keys"), strict=True):
        keys = _numbers(data, np.uint64).reshape(-1, 2)
        several, firsts = shard.probe(keys)
        if len(several):
            rows.append({"batch": batch, "keys": keys[several].tobytes(), "firsts": firsts.tobytes()})
    return pa.Table.from_pylist(rows, _ANSWER)


KEPT = "id long, n_lines long, n_dropped long, kept string"
_KEPT = pa.schema([("id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept", pa.string())])


def _drop(least: int):
    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        firsts: dict[bytes, int] = {}
        for keys, ids in zip(answers.column("keys"), answers.column("firsts"), strict=True):
            data = np.frombuffer(text_bytes(keys), np.uint64).astype(">u8").tobytes()
            firsts.update(zip((data[at : at + 16] for at in range(0, len(data), 16)), _numbers(ids).tolist(), strict=True))
        found = {name: [] for name in _KEPT.names}
        for key, text in zip(rows.column("id").to_pylist(), rows.column("text"), strict=True):
            lines, digests = line_hashes(text_bytes(text), least)
            kept = lines if key is None else [line for line, digest in zip(lines, digests, strict=True) if firsts.get(digest, key) == key]
            for name, value in (("id", key), ("n_lines", len(lines)), ("n_dropped", len(lines) - len(kept)), ("kept", b"\n".join(kept).decode())):
                found[name].append(value)
        return pa.table(found, _KEPT)

    return run


def batched(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """(batch, id, text), stored: neighbouring documents in batches of about so many bytes, so that none can outgrow a task."""
    rows = docs.select(F.spark_partition_id().cast("long").alias("part"), F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return stored(rows.mapInArrow(_batched(batch_bytes), "batch long, id long, text binary, size long"), "line-batches")


def sent_lines(rows: DataFrame, shards: int, least: int) -> DataFrame:
    return stored(rows.mapInArrow(_lines(shards, least), SENT), "line-keys")


def shard_count(size: int, shard_keys: int = SHARD_KEYS) -> int:
    """Enough shards for so many lines each, were no line repeated and lines of 20 bytes (keys of 10 code points have 11 at least)."""
    return max(16, size // 20 // shard_keys + 1)


def build_index(sent: DataFrame) -> DataFrame:
    """The index of all lines, a row per shard: perfect hash, fingerprints, counts, and the first documents of repeated lines."""
    return stored(sent.groupBy("shard").applyInArrow(_build, SHARD), "line-index")


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 10,
                        batch_bytes: int = BATCH_BYTES, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """Texts without the lines that an earlier document holds: (id, n_lines, n_dropped, kept), a row per input row.

    Lines end at line feeds. A line's key is the line without white space at
    its ends, A-Z in lower case; keys of under ``least`` code points never go.
    Lines whose key is in documents of several ids stay in those of the
    smallest id only, there all of them.

    1. Documents are cut into batches of bytes. A batch sends each distinct
       line's 128-bit hash once, with the least and greatest id, to the hash's
       shard: a line of a third of all documents is one entry a batch.
    2. Each shard builds a minimal perfect hash over its distinct lines. It
       indexes a fingerprint, a count (one document, or several) and, for
       repeated lines, the first document: about nine bytes a line less.
    3. Each batch's hashes probe the arrays of the shards; what comes back is
       the repeated ones and their first document. Lines are never joined.
    4. Batches meet their answers and drop lines.

    Null texts are empty, and an empty text is one empty line. Rows with a null
    id neither lose lines nor make others lose them. Rows that share an id are
    one document. Lines are told apart by 128 bits. Other columns are ignored;
    no rows give no rows.
    """
    prepare(docs.sparkSession)
    rows = batched(docs, id_col, text_col, batch_bytes)
    size = rows.agg(F.sum("size")).first()[0] or 0
    rows = rows.drop("size")
    sent = sent_lines(rows, shard_count(size, shard_keys), least)
    index = build_index(sent)
    answers = stored(sent.select("batch", "shard", "keys").groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(_probe, ANSWER), "line-answers")
    # A number of its own for this shuffle, so that a task's texts stay the same at any size of the input.
    tasks = size // TASK_BYTES + 1
    kept = rows.repartition(tasks, "batch").groupBy("batch").cogroup(answers.repartition(tasks, "batch").groupBy("batch")).applyInArrow(_drop(least), KEPT)
    return kept.withColumnRenamed("id", id_col)


LINES_SQL = r"""
WITH lines AS (
    SELECT doc_id, place, line, lower_az AS key FROM (
        SELECT doc_id, place, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_az
        FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place FROM documents))
),
repeated AS (SELECT key, min(doc_id) AS first FROM lines WHERE length(key) >= 10 GROUP BY key HAVING min(doc_id) < max(doc_id)),
marked AS (SELECT doc_id, place, line, coalesce(doc_id <> first, false) AS gone FROM lines LEFT JOIN repeated USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
