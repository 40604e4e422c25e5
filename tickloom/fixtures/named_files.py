"""Writes Parquet files of given names and columns, so that reading mixed ones can be tested."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame

from tickloom.session import ship_package
from tickloom.sources.files import filesystem_of


def write_files(rows: DataFrame, folder: str, renames: dict[int, dict[str, str | None]]) -> None:
    """One file for each value of ``file``, with the columns of its ``kind``: renamed, or left out where the new name is None."""
    def write(table: pa.Table) -> pa.Table:
        name, kind = table.column("file")[0].as_py(), table.column("kind")[0].as_py()
        new = renames.get(kind, {})
        table = table.drop_columns(["file", "kind", *(column for column, to in new.items() if to is None)])
        table = table.rename_columns([new.get(column) or column for column in table.column_names])
        files, inner = filesystem_of(folder)
        files.create_dir(inner, recursive=True)
        with files.open_output_stream(f"{inner}/{name}", compression=None) as out:
            pq.write_table(table, out)
        return pa.table({"file": [name]})

    ship_package(rows.sparkSession)
    rows.groupBy("file").applyInArrow(write, "file STRING").write.format("noop").mode("overwrite").save()
