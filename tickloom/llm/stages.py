"""Stages of the corpus pipeline; each takes (spark, docs, sf_dir) and returns a frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import decontaminate, packing, personal_data, shingle_join
from tickloom.llm.common import stored, table, unused
from tickloom.llm.queries import GOOD_FROM, scored, tokenizer_text
from tickloom.operators.sizing import broadcast_if_small

#: Near-duplicate stages take five words and a similarity of 0.8.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80

#: Bytes of the batches that go to Python workers and back: whole documents pass there, several columns of them, in both processes.
ARROW_BYTES = 2 << 20

#: Bytes of the words that a packing worker keeps: less than by default, since memory of earlier stages lies beside them.
TABLE_BYTES = 56 << 20


def small_batches(spark: SparkSession) -> None:
    """Bounds the batches of Python workers by bytes, from now on: a stage's rows are made only when its caller writes them."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject, each row judged by its own whole text.

    A null or empty text has a score like any other. Repeated rows have equal
    scores, so all or none of them stay; ids play no part. A table without
    rows gives none. All columns come back as they were, also one named ``score``.
    """
    small_batches(spark)
    name = unused(docs, "score")
    return scored(spark, docs, sf_dir, name).where(F.col(name) >= GOOD_FROM).select(docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that of the smallest id, null last; rows without a word stay as they are.

    Rows are told apart by a key, the hash of id and text, so those with a
    null or repeated id take part: a row goes only when its own text is a near
    copy of a row that stays. Of rows equal in id and text one stays. Only
    keys are joined back, so the texts meet them once, and only those of
    repeated rows are shuffled. Where two texts share the smallest id, the
    smaller key decides. Other columns play no part and come back as they
    were; a table without rows gives none.
    """
    small_batches(spark)
    key = unused(docs, "_key")
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    rows = keyed.select(F.col(key).alias("_key"), "doc_id", "text")
    groups = shingle_join.similar_documents(rows, id_col="_key", width=SHINGLE_WORDS, percent=SIMILAR_PERCENT)
    groups = groups.where("n_shingles > 0").groupBy("_key").agg(F.min("component_id").alias("component"), F.count("*").alias("copies"))
    members = stored(groups.join(rows.groupBy("_key").agg(F.min("doc_id").alias("id")), "_key"), "members")
    first = F.struct(F.col("id").isNull().alias("without"), "id", "_key")
    leads = members.groupBy("component").agg(F.min(first)["_key"].alias("lead"), F.count("*").alias("keys")).where("keys > 1").drop("keys")
    leads = broadcast_if_small(stored(leads, "leads"))
    marked = members.join(leads, "component", "left").select(F.col("_key").alias(key), "copies", F.coalesce(F.col("_key") == F.col("lead"), F.lit(True)).alias("stays"))
    marked = stored(marked.where("copies > 1 or not stays"), "marked")
    once = keyed.join(marked, key, "left_anti")
    again = keyed.join(broadcast_if_small(marked.where("stays")), key, "left_semi").dropDuplicates([key])
    return once.unionByName(again).select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a passage of the benchmark; each is judged by its own text, also where an id is null or repeated.

    Null and empty texts stay. Equal rows go or stay together. Other columns
    play no part and come back as they were; a table without rows gives none.
    """
    key, mark = unused(docs, "_found"), unused(docs, "_text_hash")
    found = decontaminate.contaminated(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    found = stored(found.withColumnsRenamed({"doc_id": key, "text_hash": mark}), "contaminated")
    return docs.join(found, docs.doc_id.eqNullSafe(found[key]) & (decontaminate.text_hash(docs.text) == found[mark]), "left_anti")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind, and the new number of characters.

    A null text is masked as an empty one. Equal texts are masked alike, and
    every row comes back, repeated or not, with its other columns; a table
    without rows gives none.
    """
    small_batches(spark)
    masked = personal_data.mask(docs, personal_data.train(docs))
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in training sequences, with their ids as little-endian 32-bit integers.

    Null and empty texts are packed as their end mark alone; every row is
    packed, repeated or not. Other columns are left out; a table without rows
    gives none.
    """
    small_batches(spark)
    return packing.pack(docs, tokenizer_text(), table_bytes=TABLE_BYTES)
