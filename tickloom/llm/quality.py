"""Text quality: linear hinge-loss model on n-gram indicators scaled by Naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import frugal, give_back, prepare, text_bytes, unused

LONGEST_GRAM = 4
#: Results in which the features of the sample come to the driver.
PIECES = 64
#: Odd multipliers, one for each n-gram length.
MIX = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F], np.uint32)


def indicators(data: bytes, bits: int) -> np.ndarray:
    """Ascending distinct hash values, ``bits`` wide, of the n-grams of a whole text.

    They are its byte n-grams, one to four bytes long, and its n-grams of up
    to three repeat marks, which say of each word whether it equals the word
    before it: most words are rare, but their repetition is not.
    """
    raw = np.frombuffer(data, np.uint8).astype(np.uint32)
    seen = np.zeros(1 << bits, bool)
    gram = np.zeros(0, np.uint32)
    for size in range(1, LONGEST_GRAM + 1):
        if len(raw) < size:
            break
        gram = raw if size == 1 else (gram[:-1] << np.uint32(8)) | raw[size - 1 :]
        seen[(gram ^ np.uint32(size * 0x1000193)) * MIX[size - 1] >> np.uint32(32 - bits)] = True
    words = data.split()
    marks = np.fromiter(map(eq, words, words[1:]), np.uint32, max(len(words) - 1, 0))
    gram = np.zeros(0, np.uint32)
    for size in range(1, 4):
        if len(marks) < size:
            break
        gram = marks if size == 1 else gram[:-1] * np.uint32(2) + marks[size - 1 :]
        for value in np.flatnonzero(np.bincount(gram, minlength=1 << size)):
            seen[(np.array([0xA5A50000 + (size << 8) + int(value)], np.uint32) * MIX[1]) >> np.uint32(32 - bits)] = True
    return np.flatnonzero(seen)


def held(found: pa.Scalar) -> np.ndarray:
    """Indicators of one row where they came, as 32-bit integers, without a copy."""
    return np.frombuffer(found.as_buffer(), "<u4")


@dataclass(frozen=True)
class Model:
    """Weights per indicator (the ratios are multiplied in), and the logistic curve that turns margins to scores."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float
    bits: int

    def margin(self, found: np.ndarray) -> float:
        # Unit length keeps long texts from scoring higher for their length alone.
        return float(self.weights[found].sum()) / np.sqrt(max(len(found), 1)) + self.bias

    def score(self, data: bytes) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(indicators(data, self.bits)) + self.offset, -60, 60))))


def log_ratios(rows: list[np.ndarray], labels: np.ndarray, bits: int, smoothing: float = 1.0) -> np.ndarray:
    """Log of an indicator's share in class 1 over its share in class 0."""
    shares = []
    for label in (1, 0):
        counts = np.full(1 << bits, smoothing)
        for row, own in zip(rows, labels, strict=True):
            if own == label:
                counts[row] += 1
        shares.append(counts / (np.count_nonzero(labels == label) + 2 * smoothing))
    return np.log(shares[0] / shares[1])


def dual_descent(rows: list[np.ndarray], signs: np.ndarray, ratios: np.ndarray, penalty: float, epochs: int, seed: int) -> tuple[np.ndarray, float]:
    """Linear hinge-loss model by dual coordinate descent: one multiplier per row, clipped to 0 and ``penalty``.

    Classes are weighted to equal sums. Returns weights on the indicators,
    with the ratios multiplied in, and the bias, a feature of constant one.
    """
    counts = np.array([max(len(row), 1) for row in rows])
    scale = 1 / np.sqrt(counts)
    values = ratios ** 2
    norm = np.array([values[row].sum() for row in rows]) / counts + 1
    limit = penalty * len(signs) / (2 * np.where(signs > 0, np.count_nonzero(signs > 0), np.count_nonzero(signs < 0)))
    alpha = np.zeros(len(rows))
    # In terms of u, the weight is ratio times u; a row's value is its ratio times the row's scale.
    u, bias = np.zeros_like(ratios), 0.0
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            row = rows[i].astype(np.int64)
            gradient = signs[i] * ((ratios[row] * u[row]).sum() * scale[i] + bias) - 1
            new = min(max(alpha[i] - gradient / norm[i], 0.0), limit[i])
            step = (new - alpha[i]) * signs[i]
            if step:
                u[row] += step * scale[i] * ratios[row]
                bias += step
                alpha[i] = new
    return ratios * u, bias


def calibrate(margins: np.ndarray, labels: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of the logistic curve that fits the margins, by Newton steps with softened targets."""
    ones, zeros = np.count_nonzero(labels == 1), np.count_nonzero(labels == 0)
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    design = np.stack([margins, np.ones_like(margins)], 1)
    found = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ found, -30, 30)))
        slope = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        found -= np.linalg.solve(slope, design.T @ (p - target) + 1e-3 * (found - [1.0, 0.0]))
    return float(max(found[0], 1e-3)), float(found[1])


def fit(rows: list[np.ndarray], labels: np.ndarray, bits: int, penalty: float = 1.0, epochs: int = 12, folds: int = 3, seed: int = 5) -> Model:
    """The model of all rows; the curve is fitted on margins of rows that a model of the other folds had not seen."""
    signs = np.where(labels == 1, 1.0, -1.0)
    if len(set(labels.tolist())) < 2:
        # One label or none: nothing to tell apart; every text gets that label's share.
        share = (np.count_nonzero(labels == 1) + 1) / (len(labels) + 2)
        return Model(np.zeros(1 << bits), 0.0, 1.0, float(np.log(share / (1 - share))), bits)
    margins = np.zeros(len(rows))
    for fold in range(folds):
        out = np.arange(len(rows)) % folds == fold
        if len(set(labels[~out].tolist())) < 2:
            continue
        kept = [row for row, own in zip(rows, out, strict=True) if not own]
        ratios = log_ratios(kept, labels[~out], bits)
        part = Model(*dual_descent(kept, signs[~out], ratios, penalty, epochs, seed), 1.0, 0.0, bits)
        margins[out] = [part.margin(row) for row, own in zip(rows, out, strict=True) if own]
    slope, offset = calibrate(margins, labels)
    return Model(*dual_descent(rows, signs, log_ratios(rows, labels, bits), penalty, epochs, seed), slope, offset, bits)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          usable: Column | None = None, sample_bound: int = 3000, sample_bytes: int = 1 << 29, bits: int = 18, **options) -> Model:
    """Model of at most ``sample_bound`` labelled documents of each label, chosen by hash of the id.

    Scores are set to the share of the labels among all usable ones. The bound makes the sample a small table, so it may be broadcast to the
    texts and its features gathered on the driver, which take ``sample_bytes`` at most in all. Of rows that share a
    labelled id one takes part, the least by its features' hash. ``usable`` restricts the labels by id. Ids with no label 0 or 1, or with both, are left out.
    """
    prepare(docs.sparkSession)
    known = labels.select(F.col(id_col).alias("key"), F.col(label_col).alias("label")).where("key is not null and label in (0, 1)")
    if usable is not None:
        known = known.where(usable)
    known = known.groupBy("key").agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most")
    parts = [known.where(F.col("label") == label).orderBy(F.xxhash64("key"), "key").limit(sample_bound) for label in (0, 1)]
    sample = parts[0].unionByName(parts[1]).select("key", F.col("label").cast("int").alias("label"))
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("binary").alias("text")).join(F.broadcast(sample), "key")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [indicators(text_bytes(text), bits).astype("<u4").tobytes() for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("label"), pa.array(found, pa.binary())], names=["key", "label", "found"])

    schema = T.StructType([rows.schema["key"], T.StructField("label", T.IntegerType()), T.StructField("found", T.BinaryType())])
    found = rows.select("key", "label", "text").mapInArrow(frugal(features), schema).groupBy("key", "label").agg(
        F.min_by("found", F.struct(F.xxhash64("found"), "found")).alias("found"))
    # At most ``sample_bound`` rows of each label are left here.
    reached = F.sum(F.octet_length("found") + 64).over(Window.partitionBy("label").orderBy(F.xxhash64("key"), "key"))
    # In many pieces: else two tasks would each send the driver half of all features as one result.
    drawn = found.withColumn("reached", reached).where(F.col("reached") <= sample_bytes // 2).drop("reached").repartition(PIECES, "key").toArrow()
    give_back()
    totals = {row.label: row["count"] for row in known.groupBy("label").count().collect()}
    # Each key is there once.
    order = sorted(range(drawn.num_rows), key=lambda row: str(drawn.column("key")[row].as_py()))
    found = [held(drawn.column("found")[row]) for row in order]
    own = np.array([drawn.column("label")[row].as_py() for row in order], np.int64)
    model = fit(found, own, bits, **options)
    drawn_odds = np.count_nonzero(own == 1) + 1, np.count_nonzero(own == 0) + 1
    # What training took would else stay with the driver beside all that comes later.
    del drawn, found
    give_back()
    shift = np.log((totals.get(1, 0) + 1) / (totals.get(0, 0) + 1)) - np.log(drawn_odds[0] / drawn_odds[1])
    return replace(model, offset=float(model.offset + shift))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", output: str = "score") -> DataFrame:
    """All columns of ``docs``, and the score of the whole text (0 to 1, higher is likelier label 1) as ``output``.

    Null text is empty text, which has a score as well. Rows are scored in
    the task that reads them; nothing is shuffled. An existing column named
    like ``output`` is replaced. No rows give no rows.
    """
    prepare(docs.sparkSession)
    holder = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop(output)
    texts = kept.withColumn(unused(docs, "_text"), F.col(text_col).cast("binary"))
    schema = T.StructType([*kept.schema.fields, T.StructField(output, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [holder.value.score(text_bytes(text)) for text in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.float64())], names=[*batch.schema.names[:-1], output])

    return texts.mapInArrow(frugal(run), schema)
