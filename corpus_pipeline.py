"""From documents to training sequences: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import stages
from tickloom.plans.sinks import setting
from tickloom.session import work_folder

STAGES = [
    ("quality", stages.keep_good),
    ("near_duplicates", stages.keep_one_of_each),
    ("decontaminate", stages.drop_contaminated),
    ("personal_data", stages.mask_personal_data),
    ("packing", stages.pack_sequences),
]

#: A fitted classifier and a tokenizer take part, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = work_folder(spark, f"pipeline-{name}")
        with setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", stages.ARROW_BYTES):
            stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
