"""Registered queries of these operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import attribution, chat_repair, chats, decontaminate, line_dedup, near_vectors, packing, periodic_runs, personal_data, quality, repeated_passages, shingle_join, url_filter
from tickloom.llm.common import table


def tokenizer_text(name: str = "word_bpe_49k.json") -> str:
    """A public tokenizer's definition, read once on the driver."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as source:
        return source.read()


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_text())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "padded_length")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as source:
        ranks = source.read()
    return attribution.count_tokens(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN).drop("name")


def op2_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def held_out(key: str) -> Column:
    """The rows that no label may be learnt from."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


#: Documents with a lower score are taken as bad.
GOOD_FROM = 0.7


def scored(spark: SparkSession, docs: DataFrame, sf_dir: str, output: str = "score") -> DataFrame:
    """All columns of ``docs``, and the quality score of a model that has not seen held-out labels."""
    model = quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), usable=~held_out("key"))
    return quality.score(docs, model, output=output)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scored(spark, docs, sf_dir).select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= GOOD_FROM).cast("int").alias("predicted"))


#: Verdict and host with path.
URL_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op7_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.similar_documents(table(spark, sf_dir, "documents"))


def op8_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_passages.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = personal_data.find(docs, personal_data.train(docs))
    base = F.filter("spans", lambda span: span["base"])

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda span: F.concat_ws(":", span["kind"], span["start"], span["end"])), ",")

    return found.select(
        "doc_id", *(_of_kind(base, kind).alias(f"n_{kind}") for kind in personal_data.BASE_KINDS),
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def _of_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda span: span["kind"] == kind)).cast("long")


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chats.render(table(spark, sf_dir, "conversations"))


def op11_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_repair.digests(*chat_repair.damaged(table(spark, sf_dir, "conversations")))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(periodic_runs.with_periodic_tails(table(spark, sf_dir, "documents")))
    # Arrays of structs compare field by field: the longest run, then the smallest start, then period.
    longest = F.array_max(F.transform("runs", lambda run: F.struct(run["length"], -run["start"], -run["period"])))
    longest = found.withColumn("best", longest)
    listed = F.array_join(F.transform("runs", lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n"))), "")
    length, start, period = F.col("best.length"), -F.col("best.col2"), -F.col("best.col3")
    return longest.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_near_vectors": op2_near_vectors,
    "op3_decontamination": op3_decontamination,
    "op4_quality": op4_quality,
    "op5_url_filter": op5_url_filter,
    "op6_token_counts": op6_token_counts,
    "op7_shingle_join": op7_shingle_join,
    "op8_repeated_passages": op8_repeated_passages,
    "op9_personal_data": op9_personal_data,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_chat_repair": op11_chat_repair,
    "op12_line_dedup": op12_line_dedup,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE: dict[str, str] = {
    "op7_shingle_join": shingle_join.JOIN_SQL,
    "op8_repeated_passages": repeated_passages.REPEATS_SQL,
    "op10_chat_formatting": chats.RENDER_SQL,
    "op11_chat_repair": chat_repair.REPAIR_SQL,
    "op12_line_dedup": line_dedup.LINES_SQL,
}
