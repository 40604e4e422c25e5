import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

from tickloom.session import build_session, ship_package, work_folder  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(app="tests", master="local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false"})
    session.sparkContext.setLogLevel("OFF")
    ship_package(session)
    yield session
    session.stop()


@pytest.fixture()
def folder(spark):
    return work_folder(spark, "test").removeprefix("file:")
