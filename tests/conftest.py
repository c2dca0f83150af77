import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from parceltrail.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[4]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="4",
        spark__sql__warehouse__dir=str(scratch / "warehouse"),
        spark__checkpoint__dir=str(scratch / "checkpoints"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def shuffle_joins(spark):
    """No broadcast: every lookup takes the split join."""
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    yield
    spark.conf.set(setting, before)


@pytest.fixture
def text_table(spark):
    """Function making an all-text table from column names and rows."""

    def make(columns, rows):
        names = columns.split()
        return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in names))

    return make
