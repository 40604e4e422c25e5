"""Substring dedup by difference-cover anchors."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import mixed, prepare, slices, stored, text_bytes, word_hashes
from tickloom.session import work_folder

#: Period of the cover, and its residues: any two residues modulo 7 have a common shift into them.
PERIOD, COVER = 7, (0, 1, 3)
RADIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def rolling(hashes: np.ndarray, width: int, radix: np.uint64) -> np.ndarray:
    """Hash of each run of ``width`` values."""
    n = max(len(hashes) - width + 1, 0)
    found = np.zeros(n, np.uint64)
    for k in range(width):
        found = found * radix + hashes[k : k + n]
    return mixed(found)


def ranges_of(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """Which of so many equal ranges of hash values each one is in."""
    return ((hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


class Bucket:
    """Words of neighbouring documents as hashes in one array, with windows that stay within a document."""

    def __init__(self, texts: list[bytes], known: np.ndarray, window: int) -> None:
        """``known``: which texts have an id; the others take no part in comparisons."""
        parts = [word_hashes(part) for part in slices(texts)]
        self.window, self.anchor = window, window - PERIOD + 1
        self.words = np.concatenate([np.zeros(0, np.uint64), *(words for words, _ in parts)])
        self.lengths = np.concatenate([np.zeros(0, np.int64), *(lengths for _, lengths in parts)])
        self.known = known
        self.doc = np.repeat(np.arange(len(self.lengths)), self.lengths)
        ends = np.cumsum(self.lengths)
        self.place = np.arange(len(self.words)) - (ends - self.lengths)[self.doc]
        self.left = self.lengths[self.doc] - self.place

    def anchors(self) -> None:
        """Anchor windows at cover positions: their places, distinct hashes in order, and which are in several documents here."""
        cover = np.isin(self.place % PERIOD, COVER) & (self.left >= self.anchor) & self.known[self.doc]
        self.at = np.flatnonzero(cover)
        hashed = rolling(self.words, self.anchor, RADIX[0])[self.at]
        self.unique, self.which = np.unique(hashed, return_inverse=True)
        low = np.full(len(self.unique), len(self.lengths))
        high = np.full(len(self.unique), -1)
        np.minimum.at(low, self.which, self.doc[self.at])
        np.maximum.at(high, self.which, self.doc[self.at])
        self.shared = low < high

    def candidates(self, repeated: np.ndarray) -> None:
        """Windows around repeated anchors: their starts, and their distinct hashes ordered by range."""
        marks = np.zeros(len(self.words) + 1, np.int64)
        hits = self.at[repeated[self.which]]
        for shift in range(PERIOD):
            own = hits[self.place[hits] >= shift] - shift
            marks[own] = 1
        starts = np.flatnonzero(marks)
        self.starts = starts[self.left[starts] >= self.window] if len(starts) else starts
        self.key = rolling(self.words, self.window, RADIX[0])[self.starts]
        self.spread = rolling(self.words, self.window, RADIX[1])[self.starts]


def _pieces(values: np.ndarray, where: np.ndarray, ranges: int) -> Iterator[tuple[int, np.ndarray]]:
    """Stretches of ``values``, sorted by range, with the range's number."""
    edges = np.searchsorted(where, np.arange(ranges + 1))
    for number in np.flatnonzero(np.diff(edges)):
        yield int(number), values[edges[number] : edges[number + 1]]


def _send(bucket: int, kind: str, pieces: Iterator[tuple[int, np.ndarray]]) -> pa.Table:
    numbers, blobs = [], []
    for number, values in pieces:
        numbers.append(number)
        blobs.append(values.tobytes())
    return pa.table({"bucket": pa.array([bucket] * len(numbers), pa.int32()), "kind": pa.array([kind] * len(numbers), pa.string()),
                     "range": pa.array(numbers, pa.int32()), "data": pa.array(blobs, pa.binary())})


SENT = "bucket int, kind string, range int, data binary"


class Steps:
    """The functions that run on buckets of documents and on ranges of hashes."""

    def __init__(self, window: int, ranges: int) -> None:
        self.window, self.ranges = window, ranges

    def read(self, rows: pa.Table) -> Bucket:
        known = rows.column("id").is_valid().to_numpy()
        bucket = Bucket([text_bytes(text) for text in rows.column("text")], known, self.window)
        bucket.anchors()
        return bucket

    def send_anchors(self, rows: pa.Table) -> pa.Table:
        bucket = self.read(rows)
        sent = bucket.unique.astype(np.uint32)
        return _send(rows.column("bucket")[0].as_py(), "anchor", _pieces(sent, ranges_of(bucket.unique, self.ranges), self.ranges))

    def repeated(self, rows: pa.Table) -> pa.Table:
        """For each bucket's anchors of one range: a bit each, set when another bucket has the anchor."""
        parts = [np.frombuffer(text_bytes(data), np.uint32) for data in rows.column("data")]
        values, counts = np.unique(np.concatenate(parts), return_counts=True)
        bits = [np.packbits(np.isin(part, values[counts > 1])).tobytes() for part in parts]
        return pa.table({"bucket": rows.column("bucket"), "kind": rows.column("kind"), "range": rows.column("range"), "data": pa.array(bits, pa.binary())})

    def earlier(self, rows: pa.Table) -> pa.Table:
        """For each bucket's windows of one range: a bit each, set when a bucket of smaller ids has the window."""
        parts = [np.frombuffer(text_bytes(data), np.uint64) for data in rows.column("data")]
        owner = rows.column("bucket").to_numpy()
        order = np.argsort(owner, kind="stable")
        joined = np.concatenate([parts[i] for i in order])
        owners = np.repeat(owner[order], [len(parts[i]) for i in order])
        # The first occurrence in order of buckets is the smallest bucket.
        _, first, which = np.unique(joined, return_index=True, return_inverse=True)
        late = owners[first][which] < owners
        bits, at = [b""] * len(parts), 0
        for i in order:
            bits[i] = np.packbits(late[at : at + len(parts[i])]).tobytes()
            at += len(parts[i])
        return pa.table({"bucket": rows.column("bucket"), "kind": rows.column("kind"), "range": rows.column("range"), "data": pa.array(bits, pa.binary())})

    def _answered(self, where: np.ndarray, answers: pa.Table, kind: str) -> np.ndarray:
        """The bits that came back for values sent in order of range."""
        given = dict(zip(*(answers.filter(pa.compute.equal(answers.column("kind"), kind)).column(name).to_pylist() for name in ("range", "data")), strict=True))
        found = np.zeros(len(where), bool)
        edges = np.searchsorted(where, np.arange(self.ranges + 1))
        for number in np.flatnonzero(np.diff(edges)):
            low, high = edges[number], edges[number + 1]
            found[low:high] = np.unpackbits(np.frombuffer(given[int(number)], np.uint8), count=high - low).astype(bool)
        return found

    def _windows(self, rows: pa.Table, answers: pa.Table) -> tuple[Bucket, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The bucket with its candidate windows: distinct (range, key) in order, and each start's position there."""
        bucket = self.read(rows)
        repeated = bucket.shared | self._answered(ranges_of(bucket.unique, self.ranges), answers, "anchor")
        bucket.candidates(repeated)
        where = ranges_of(bucket.spread, self.ranges)
        order = np.lexsort((bucket.key, where))
        key, place = bucket.key[order], where[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (place[1:] != place[:-1])
        which = np.empty(len(key), np.int64)
        which[order] = np.cumsum(new) - 1
        return bucket, key[new], place[new], which, new

    def send_windows(self, rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return _send(0, "window", iter(()))
        _, key, place, _, _ = self._windows(rows, answers)
        return _send(rows.column("bucket")[0].as_py(), "window", _pieces(key, place, self.ranges))

    def cut(self, rows: pa.Table, answers: pa.Table) -> pa.Table:
        """Texts without the covered words."""
        names = ["id", "n_words", "n_removed", "kept"]
        bucket, key, place, which, _ = self._windows(rows, answers)
        late = self._answered(place, answers, "window")
        ids = rows.column("id")
        # Ranks of the ids: equal ids are one document; rows with a null id have no windows.
        values = ids.to_pylist()
        rank = {value: number for number, value in enumerate(sorted({value for value in values if value is not None}))}
        ranks = np.array([rank.get(value, -1) for value in values], np.int64)
        own = ranks[bucket.doc[bucket.starts]]
        least = np.full(len(key), len(rank))
        np.minimum.at(least, which, own)
        gone = late[which] | (least[which] < own)
        edge = np.zeros(len(bucket.words) + 1, np.int64)
        np.add.at(edge, bucket.starts[gone], 1)
        np.add.at(edge, bucket.starts[gone] + self.window, -1)
        removed = np.cumsum(edge)[:-1] > 0
        counts, kept, at = [], [], 0
        for row, length in enumerate(bucket.lengths.tolist()):
            words = text_bytes(rows.column("text")[row]).split()
            lost = removed[at : at + length]
            counts.append(int(lost.sum()))
            if counts[-1]:
                words = [word for word, out in zip(words, lost.tolist(), strict=True) if not out]
            kept.append(b" ".join(words))
            at += length
        return pa.table([ids, pa.array(bucket.lengths), pa.array(counts, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], names=names)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13,
                   bucket_bytes: int = 16 << 20) -> DataFrame:
    """Texts without the words that a window covers which also starts in a document of smaller id:
    (id, n_words, n_removed, kept), a row per input row, kept words joined by one space.

    Two equal runs of ``window`` words, wherever they start, share an anchor:
    with a period of 7 and the cover 0, 1, 3 some shift below 7 takes both
    starts to cover positions, and ``window`` - 6 words from there are still
    inside. So anchors alone are hashed and compared across the corpus; around
    repeated anchors the runs are extended to whole windows, and these decide.

    Documents are cut into buckets of neighbouring ids, of about
    ``bucket_bytes``, in a bucketed table in the shared folder, so the texts
    are shuffled once. Hashes cross the cluster as one array for each bucket
    and range of hash values, distinct within the bucket: a passage of a third
    of all documents costs a few bytes a bucket. One bit a hash comes back.
    Nothing is sampled or capped. Anchors are compared by 32 bits within
    their range, where a chance match only adds a candidate; windows by 64
    bits within a range set by a second hash.

    Null text has no words, texts below ``window`` words lose none. Rows of
    equal id are one document: they never remove each other's words. Rows
    with a null id keep all words and remove none. Other columns are ignored;
    no rows give no rows.
    """
    if window < 2 * PERIOD - 1:
        raise ValueError(f"a window has at least {2 * PERIOD - 1} words")
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-total // bucket_bytes))
    name = f"repeated_passages_{uuid.uuid4().hex}"
    rows.repartitionByRange(count, "id").withColumn("bucket", F.spark_partition_id()) \
        .write.bucketBy(count, "bucket").sortBy("bucket").option("path", work_folder(spark, name)).saveAsTable(name)
    parts = spark.table(name)
    # Lambdas, as Spark counts the arguments of a bound method with its object.
    steps = Steps(window, count)
    sent = parts.groupBy("bucket").applyInArrow(lambda own: steps.send_anchors(own), SENT)
    answers = stored(sent.groupBy("range").applyInArrow(lambda own: steps.repeated(own), SENT), "anchor-bits")
    sent = parts.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(lambda own, bits: steps.send_windows(own, bits), SENT)
    answers = answers.unionByName(stored(sent.groupBy("range").applyInArrow(lambda own: steps.earlier(own), SENT), "window-bits"))
    kind = rows.schema["id"].dataType.simpleString()
    return parts.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(
        lambda own, bits: steps.cut(own, bits), f"id {kind}, n_words long, n_removed long, kept string").withColumnRenamed("id", id_col)


REPEATS_SQL = r"""
WITH words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents
),
windows AS (
    SELECT doc_id, unnest(range(1, len(words) - 11)) AS start, words FROM words WHERE len(words) >= 13
),
hashed AS (
    SELECT doc_id, start, md5(array_to_string(words[start:start + 12], ' ')) AS run FROM windows
),
late AS (
    SELECT doc_id, start FROM (SELECT doc_id, start, min(doc_id) OVER (PARTITION BY run) AS first FROM hashed) WHERE first < doc_id
),
covered AS (
    SELECT DISTINCT doc_id, start + k AS place FROM late, range(13) AS t(k)
),
listed AS (
    SELECT doc_id, unnest(range(1, len(words) + 1)) AS place, unnest(words) AS word FROM words
),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS kept, count(*) AS n_kept
    FROM listed ANTI JOIN covered USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n_kept, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""
