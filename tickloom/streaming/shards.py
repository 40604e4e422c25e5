"""Incremental form: final rows taken from archives as they are done.

The stream follows the status rows, which are written last: an archive is taken
up once its data and its ledger are complete. Final rows lie by archive, so an
archive done again, or a micro-batch replayed, replaces its own rows and
nothing else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.operators.sizing import broadcast_if_small
from tickloom.plans import ingest, sinks
from tickloom.session import checkpointed


def run_available(spark: SparkSession, work: str, target: str, state: str, trade_date: str,
                  files_per_batch: int = 10_000) -> None:
    """Take up every archive done since the last run, then stop; ``work`` is the day's folder, as for ``ingest``."""
    place = ingest.FO.place(work)

    def write(batch: DataFrame, number: int) -> None:
        taken = checkpointed(batch.filter("status = 'done'").select("archive_stem").distinct())
        shards = ingest.shards(spark, place, ingest.FO).drop("batch")
        rows = ingest.derivative_rows(shards.join(broadcast_if_small(taken), "archive_stem", "left_semi"), trade_date)
        ingest.drop_archives(taken, f"{target}/trade_date={trade_date}")
        sinks.write_derivatives(rows, target, "archive_stem")

    arriving = spark.readStream.schema(ingest.STATUS_DDL).option("maxFilesPerTrigger", files_per_batch).parquet(f"{place}/status")
    running = arriving.writeStream.foreachBatch(write).option("checkpointLocation", state).trigger(availableNow=True).start()
    running.awaitTermination()
