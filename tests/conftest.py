import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from entitymart.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": shared,
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def one(spark):
    """Value of a column function on one text."""
    from pyspark.sql import functions as F

    def value(fn, text):
        df = spark.createDataFrame([(text,)], "c string")
        return df.select(fn(F.col("c")).alias("v")).first()["v"]

    return value


@pytest.fixture
def table(spark):
    """A small table; ``_ord`` is the row number where it is not given."""

    def make(columns, rows):
        if "_ord" not in columns:
            columns = "_ord bigint, " + columns
            rows = [(i, *r) for i, r in enumerate(rows)]
        return spark.createDataFrame(rows, columns)

    return make
