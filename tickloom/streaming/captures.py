"""Incremental ingest of capture archives as they land in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import text
from tickloom.operators.contract import Contract
from tickloom.plans import ingest

LISTING_DDL = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def run_available(spark: SparkSession, folder: str, contract: Contract, work: str, state: str,
                  segment: ingest.Segment = ingest.FO, files_per_batch: int = 1_000) -> None:
    """Ingest every archive that arrived since the last run, then stop.

    Only paths and sizes pass through the stream; contents are read by the
    capture source. A replayed batch finds its archives done, or redoes them.
    """
    def take(batch: DataFrame, _number: int) -> None:
        ingest.ingest(batch.sparkSession, batch, contract, work, segment)

    arriving = (
        spark.readStream.format("binaryFile").schema(LISTING_DDL)
        .option("maxFilesPerTrigger", files_per_batch).load(f"{folder.rstrip('/')}/{segment.glob}")
        .select("path", "length", text.archive_stem(F.col("path")).alias("archive_stem"))
    )
    if segment.exclude:
        arriving = arriving.filter(~F.col("path").rlike(segment.exclude))
    running = arriving.writeStream.foreachBatch(take).option("checkpointLocation", state).trigger(
        availableNow=True).start()
    running.awaitTermination()
