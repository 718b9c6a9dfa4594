import datetime as dt
import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

from brightwell.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "2", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
        "spark.sql.streaming.metricsEnabled": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text):
    """A timestamp on the test day."""
    return dt.datetime.fromisoformat(f"2024-03-01T{text}")


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is None, str(v)) for v in r])
