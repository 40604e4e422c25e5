"""What Parquet footers say: row counts without data pages, and which files can't be read."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators import sizes
from tickloom.session import ship_package
from tickloom.sources.files import filesystem_of


def with_footer(files: DataFrame) -> DataFrame:
    """Adds ``rows`` and ``problem`` to a listing (path, …): each task reads the footers of its own files, nothing else.

    A file whose footer can't be read has no rows and says why.
    """
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, problems = [], []
            for path in batch.column("path").to_pylist():
                store, inner = filesystem_of(path)
                try:
                    with store.open_input_file(inner) as handle:
                        rows.append(pq.read_metadata(handle).num_rows)
                        problems.append(None)
                except (OSError, pa.ArrowException) as problem:
                    rows.append(None)
                    problems.append(str(problem).partition("\n")[0])
            yield batch.append_column("rows", pa.array(rows, pa.int64())).append_column("problem", pa.array(problems, pa.string()))

    ship_package(files.sparkSession)
    schema = files.schema.simpleString()[len("struct<"):-1]
    return spread(files).mapInArrow(probe, schema + ",rows:bigint,problem:string")


def spread(files: DataFrame) -> DataFrame:
    """A listing dealt over all cores: listings come in few partitions, and opening files is what takes time."""
    return files.repartition(files.sparkSession.sparkContext.defaultParallelism)


def footer_counts(files: DataFrame, *keys: str) -> DataFrame:
    """Rows and files per group of a partitioned table, from its listing; a file that can't be read fails the count."""
    counted = with_footer(sizes.with_layout(files, *keys))
    sound = F.when(F.col("problem").isNull(), F.col("rows")).otherwise(
        F.raise_error(F.concat_ws(": ", "path", "problem")).cast("bigint"))
    return counted.groupBy(*keys).agg(F.sum(sound).alias("rows"), F.count("*").alias("files"))
