"""Helpers that the operators share: stored intermediate tables, word streams, connected components."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.session import ship_package, work_folder

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """A column name that the frame does not hold in any case, made of ``name``."""
    held = {column.lower() for column in df.columns}
    while name.lower() in held:
        name = f"_{name}"
    return name


def prepare(spark: SparkSession) -> None:
    """Makes this package importable in the executors' Python workers."""
    ship_package(spark)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of a frame, written to the shared folder and read again: lost executors neither repeat nor change them."""
    folder = work_folder(df.sparkSession, name)
    df.write.parquet(folder)
    frame = df.sparkSession.read.schema(df.schema).parquet(folder)
    frame.stored_in = folder
    return frame


def forget(*frames: DataFrame) -> None:
    """Remove what ``stored`` wrote for frames that nothing reads any more."""
    for frame in frames:
        path = frame.sparkSession._jvm.org.apache.hadoop.fs.Path(frame.stored_in)
        path.getFileSystem(frame.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


#: Bytes of input after which a task gives back what it has freed.
GIVE_BACK = 1 << 24


def give_back() -> None:
    """Return memory that this process has freed to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def frugal(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same function of batches, which gives freed memory back as it goes and at its end.

    A Python worker outlives its tasks, and its allocators keep what these
    freed: idle workers would hold the memory of their largest task beside
    the stages that come later.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def read() -> Iterator[pa.RecordBatch]:
            taken = 0
            for batch in batches:
                yield batch
                taken += batch.nbytes
                if taken >= GIVE_BACK:
                    taken = 0
                    give_back()

        yield from run(read())
        give_back()

    return whole


def text_bytes(value: pa.Scalar) -> bytes:
    """UTF-8 of a text scalar without building a Python string; null is empty."""
    buffer = value.as_buffer()
    return buffer.to_pybytes() if buffer is not None else b""


def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Scalar, bytes]]:
    """Key and UTF-8 text of every row of two-column batches (key, text as binary)."""
    for batch in batches:
        keys, texts = batch.column(0), batch.column(1)
        for row in range(batch.num_rows):
            yield keys[row], text_bytes(texts[row])


#: Odd base of the polynomial, its inverse modulo 2**64, and a random value for each byte.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
BYTE_VALUES = np.random.default_rng(20).integers(1, 1 << 63, 256, np.uint64)
LOWER_VALUES = BYTE_VALUES.copy()
LOWER_VALUES[ord("A") : ord("Z") + 1] = BYTE_VALUES[ord("a") : ord("z") + 1]
SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


#: Bytes of text that are hashed at a time: each takes some 60 bytes of arrays meanwhile.
STRETCH = 1 << 18


class _Powers:
    """Powers of the base and of its inverse, as many as were asked for so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, factor in (("up", BASE), ("down", INVERSE)):
                row = np.full(max(n, STRETCH), factor, np.uint64)
                row[0] = 1
                setattr(self, name, np.multiply.accumulate(row))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit value over all bits; one to one."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def word_hashes(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts in a row, and each text's number of words.

    Words are what ``bytes.split`` gives, A-Z in lower case if asked. Running
    sums over the bytes give every word's polynomial at once, so no word is
    handled by itself. Call it with a stretch of texts at a time.
    """
    raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    space = SPACE[raw]
    edges = np.flatnonzero(np.diff(np.concatenate(([True], space)))) if len(raw) else np.zeros(0, np.int64)
    starts, ends = edges[0::2], edges[1::2]
    up, down = _POWERS.upto(len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((LOWER_VALUES if lower else BYTE_VALUES)[raw] * down, out=sums[1:])
    found = mixed((sums[ends] - sums[starts]) * up[starts])
    limits = np.cumsum([len(text) + 1 for text in texts]) if texts else np.zeros(0, np.int64)
    return found, np.diff(np.searchsorted(starts, limits), prepend=0)


def slices(texts: list[bytes], size: int = STRETCH) -> Iterator[list[bytes]]:
    """Stretches of texts of about so many bytes; a longer text is a stretch of its own."""
    held, total = [], 0
    for text in texts:
        held.append(text)
        total += len(text)
        if total >= size:
            yield held
            held, total = [], 0
    if held:
        yield held


class Forest:
    """Union-find over the nodes of a stretch of rows; ``links`` are a spanning forest, each node linked to its smallest."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, node: int) -> int:
        parent = self.parent
        while (up := parent.setdefault(node, node)) != node:
            parent[node] = node = parent[up] if up in parent else up
        return node

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def links(self) -> tuple[list[int], list[int]]:
        nodes = [node for node in self.parent if self.root(node) != node]
        return nodes, [self.root(node) for node in nodes]


def _spanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of each few links of a task; (u, v), v the smaller."""
    forest = Forest()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            forest.join(a, b)
        if len(forest.parent) > SPANNED:
            yield _links(forest)
            forest = Forest()
    yield _links(forest)


def _links(forest: Forest) -> pa.RecordBatch:
    nodes, roots = forest.links()
    return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(roots, pa.int64())], names=["u", "v"])


#: Nodes that a task unites at once, and links that one task unites to the end: both bound its memory to some 100 MB.
SPANNED = FEW = 1 << 19


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected links (src, dst as long): (node, component), component the smallest node.

    Alternates large-star and small-star steps, each a join with a minimum
    per node, so that a hub is summed before it is shuffled and no component
    is ever gathered. Ends when a step changes nothing. Nulls link nothing.
    Tasks first reduce their own links to a spanning forest. Where no more than
    FEW links are left in all, one task ends the work, with the same result.
    Links are stored before, so that a task runs no second Python worker beside the one that finds them.
    """
    prepare(edges.sparkSession)
    pairs = edges.where("src <> dst").select(F.col("src").cast("long").alias("u"), F.col("dst").cast("long").alias("v"))
    star = stored(pairs, "edges")
    if star.count() > FEW:
        all_links, star = star, stored(star.mapInArrow(frugal(_spanned), "u long, v long"), "forest")
        forget(all_links)
    if star.count() <= FEW:
        ends = stored(star.coalesce(1).mapInArrow(frugal(_spanned), "u long, v long"), "ends")
        forget(star)
        return ends.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
            ends.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
    mark = None
    while True:
        both = star.union(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # The smaller end may come first here: order each link again.
        before, star = star, stored(
            small.union(least.select("u", F.col("m").alias("v"))).where("u <> v")
            .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "star")
        forget(before)
        seen = star.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if seen == mark:
            return star.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                star.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        mark = seen
