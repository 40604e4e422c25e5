"""Near-duplicate vectors: rounds of sorted projection passes until one joins nothing, then an exact count within each component."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import Forest, components, prepare, stored

CODE_BITS = 62


def projections(passes: int, dimension: int, seed: int) -> np.ndarray:
    """Random directions (dimension, passes * CODE_BITS); the same for every task."""
    return np.random.default_rng([seed, dimension]).standard_normal((dimension, passes * CODE_BITS))


def codes(vectors: np.ndarray, passes: int, seed: int) -> np.ndarray:
    """Per vector and pass, the signs of its projections as the bits of one integer, the first direction highest."""
    signs = (vectors @ projections(passes, vectors.shape[1], seed) > 0).reshape(len(vectors), passes, CODE_BITS)
    return signs @ (1 << np.arange(CODE_BITS - 1, -1, -1, dtype=np.int64))


def unit_rows(column: pa.Array, dimension: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)
    # A power of two changes no cosine, and keeps the squares of huge and tiny components in range.
    flat = np.ldexp(flat, -np.frexp(np.abs(flat).max(axis=1, keepdims=True, initial=0))[1])
    return flat / np.linalg.norm(flat, axis=1, keepdims=True)


def _stretches(*keys: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of rows with equal keys."""
    n = len(keys[0])
    if not n:
        return []
    changes = np.zeros(n, bool)
    changes[0] = True
    for key in keys:
        changes[1:] |= key[1:] != key[:-1]
    starts = np.flatnonzero(changes)
    return list(zip(starts.tolist(), np.append(starts[1:], n).tolist(), strict=True))


def _neighbours(cosine: float, window: int):
    """Links each sorted row with those of the next ``window`` rows that are near; carries the tail from batch to batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if tail is not None:
                rows = pa.concat_tables([tail, rows]).combine_chunks()
            held = 0 if tail is None else tail.num_rows
            part, label, size, node = (rows.column(name).to_numpy() for name in ("pass", "label", "size", "node"))
            forest = Forest()
            for low, high in _stretches(part, label, size):
                vectors = unit_rows(rows.column("vector").slice(low, high - low).combine_chunks(), int(size[low]))
                own = node[low:high]
                for step in range(1, min(window, high - low - 1) + 1):
                    near = np.flatnonzero(np.einsum("ij,ij->i", vectors[:-step], vectors[step:]) >= cosine)
                    # Pairs within the carried tail were compared before.
                    near = near[near + step + low >= held]
                    for a, b in zip(own[near].tolist(), own[near + step].tolist(), strict=True):
                        forest.join(a, b)
            a, b = forest.links()
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["src", "dst"])
            tail = rows.slice(max(rows.num_rows - window, 0))

    return run


def _tile(cosine: float):
    """Weighted count of the near rows between two blocks of one component, for the rows of the first block."""

    def run(rows: pa.Table) -> pa.Table:
        first = rows.filter(pa.compute.equal(rows.column("side"), 0))
        second = rows.filter(pa.compute.equal(rows.column("side"), 1))
        found = np.zeros(first.num_rows, np.int64)
        if first.num_rows and second.num_rows:
            size = len(first.column("vector")[0])
            a, b = (unit_rows(side.column("vector").combine_chunks(), size) for side in (first, second))
            weight = second.column("copies").to_numpy()
            for low in range(0, len(a), 1024):
                for at in range(0, len(b), 4096):
                    found[low : low + 1024] += (a[low : low + 1024] @ b[at : at + 4096].T >= cosine) @ weight[at : at + 4096]
        return pa.table({"node": first.column("node"), "h1": first.column("h1"), "h2": first.column("h2"), "near": pa.array(found)})

    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label",
                    cosine: float = 0.98, passes: int = 12, window: int = 64, block: int = 1024, seed: int = 7) -> DataFrame:
    """Links between vectors of equal label at ``cosine`` or more: (id, n_links, component_id, kept), a row per input row.

    In each pass the vectors are sorted by label and by the signs of random
    projections, and each is compared with the next ``window`` in that order;
    sorting is by range, so a hot label is split over tasks, and a window
    ends with its range. Near pairs of all passes are united to components.
    Rounds of ``passes``, each with other projections and other ranges, are
    repeated until one joins no components in the whole table, so dense
    labels, where windows see little, get more of them than others need.
    Within a component all pairs are then compared, in tiles of about
    ``block`` vectors a side, so that ``n_links`` counts every link there.
    A link is missed only when no pass of any round brings its ends, or a
    chain between them, within a window; as the last round found no such
    link, few can be left, but none left is not certain. None is reported below ``cosine``, in double
    precision.

    Ids are integers (cast to long). Equal vectors are taken as one with a count, so groups of copies cost one
    row. Null labels, and vectors that are null, empty, zero or hold a null
    or non-finite component, link with nothing; so do rows with a null id
    (component null, kept). Vectors of different length are never compared.
    Repeated rows count as others; other columns are ignored; no rows give no
    rows. With ``label_col`` None all vectors are compared.
    """
    spark = vectors.sparkSession
    prepare(spark)
    label = F.col(label_col).cast("string") if label_col else F.lit("")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), label.alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    sound = F.col("label").isNotNull() & F.col("id").isNotNull() & F.coalesce(
        F.exists("vector", lambda x: x != 0) & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    # Minus zero equals zero.
    rows = rows.withColumns({"sound": sound, "vector": F.transform("vector", lambda x: x + F.lit(0.0))})
    rows = rows.withColumns({"h1": F.xxhash64("vector"), "h2": F.xxhash64(F.lit(1), "vector")})
    nodes = stored(
        rows.where("sound").withColumn("label", F.xxhash64("label")).groupBy("label", "h1", "h2").agg(
            F.min("id").alias("node"), F.count("*").alias("copies"), F.first("vector").alias("vector")).withColumn("size", F.size("vector")), "vectors")

    def coded(own_seed: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sizes = batch.column("size").to_numpy()
                for low, high in _stretches(sizes):
                    own = batch.slice(low, high - low)
                    found = codes(unit_rows(own.column("vector"), int(sizes[low])), passes, own_seed)
                    for number in range(passes):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(found), number, np.int32)), *(own.column(name) for name in ("label", "size")),
                             pa.array(found[:, number]), own.column("node"), own.column("vector")],
                            names=["pass", "label", "size", "code", "node", "vector"])

        return run

    order = ["pass", "label", "size", "code", "node"]
    found, joined = None, 0
    for turn in itertools.count():
        placed = nodes.select("label", "size", "node", "vector").mapInArrow(
            coded(seed + turn), "pass int, label long, size int, code long, node long, vector array<double>")
        edges = placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_neighbours(cosine, window), "src long, dst long")
        if found is not None:
            edges = edges.union(found.select(F.col("node").alias("src"), F.col("component").alias("dst")))
        found = stored(components(edges).groupBy("node").agg(F.min("component").alias("component")), "vector-components")
        now = found.where("node <> component").count()
        if now == joined:
            break
        joined = now
    member = nodes.join(found, "node")
    blocks = F.ceil(F.col("members") / block).cast("int")
    sizes = member.groupBy("component", "label", "size").agg(F.count("*").alias("members"))
    tiled = member.join(sizes, ["component", "label", "size"]) \
        .select("component", "label", "size", "node", "h1", "h2", "copies", "vector", blocks.alias("blocks"), F.pmod(F.xxhash64("node", "h1"), blocks).alias("own"))
    across = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    sides = tiled.select("*", across.alias("other")).withColumns({"ti": F.col("own"), "tj": F.col("other").cast("long"), "side": F.lit(0)}).unionByName(
        tiled.select("*", across.alias("other")).withColumns({"ti": F.col("other").cast("long"), "tj": F.col("own"), "side": F.lit(1)}))
    counted = sides.select("component", "label", "size", "ti", "tj", "side", "node", "h1", "h2", "copies", "vector") \
        .groupBy("component", "label", "size", "ti", "tj").applyInArrow(_tile(cosine), "node long, h1 long, h2 long, near long") \
        .groupBy("node", "h1", "h2").agg(F.sum("near").alias("near"))
    known = nodes.select("label", "h1", "h2", "node", "copies").join(counted, ["node", "h1", "h2"], "left") \
        .join(found, "node", "left").select(
            F.col("label").alias("_label"), F.col("h1").alias("_h1"), F.col("h2").alias("_h2"),
            (F.coalesce("near", "copies") - 1).alias("links"), F.coalesce("component", "node").alias("component"))
    result = rows.join(known, F.col("sound") & (F.xxhash64("label") == F.col("_label")) & (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")), "left")
    return result.select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0).cast("long")).alias("n_links"),
                         F.coalesce("component", "id").alias("component_id"),
                         F.coalesce(F.col("id") == F.coalesce("component", "id"), F.lit(True)).alias("kept"))
