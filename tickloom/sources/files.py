"""Opening files from inside tasks, on whatever file system the path names."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame

from tickloom.session import ship_package

# Hadoop's names for object stores, and the names pyarrow knows them by.
SCHEME_NAMES = {"s3a": "s3", "s3n": "s3", "gs": "gs", "hdfs": "hdfs", "file": "file"}


def filesystem_of(path: str) -> tuple[fs.FileSystem, str]:
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem(), path
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{SCHEME_NAMES.get(scheme, scheme)}:{quote(rest, safe='/:@')}")


def remove_folders(folders: DataFrame) -> None:
    """Delete the folders a one-column frame names, each in a task; what is gone already is fine, so a task may be repeated."""
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                files, inner = filesystem_of(path)
                try:
                    files.delete_dir(inner)
                except FileNotFoundError:
                    pass
            yield batch

    ship_package(folders.sparkSession)
    folders.mapInArrow(remove, folders.schema).write.format("noop").mode("overwrite").save()
