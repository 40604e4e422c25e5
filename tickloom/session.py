"""Session settings and the shared work folder."""

from __future__ import annotations

import pathlib
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Plans here are built from many small columns; recording the Python call
    # site of each one costs more than the planning itself.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "tickloom", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only a local session may fall back to a folder of this machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tickloom-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def work_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own for one run, below the shared one."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows of a frame, kept in the shared folder so that losing executors
    neither recomputes nor changes them."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers of any executor.

    A cluster submitted with ``--py-files`` has it already; shipping it again
    does no harm, and once per application is enough.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = pathlib.Path(__file__).parent
    bundle = pathlib.Path(tempfile.mkdtemp(prefix="tickloom-py-")) / "tickloom.zip"
    with zipfile.ZipFile(bundle, "w") as target:
        for source in sorted(package.rglob("*.py")):
            target.write(source, source.relative_to(package.parent))
    context.addPyFile(str(bundle))
    _SHIPPED.add(context.applicationId)


_SHIPPED: set[str] = set()
