import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from deskweave.session import build_session

    session = build_session("tests", 8)
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.stop()
        session = build_session("tests", 8, str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate a column over one row of named text values."""
    from pyspark.sql import functions as F

    def run(column, **values):
        row = spark.range(1).select(
            *[F.lit(v).cast("string").alias(k) for k, v in values.items()]
        )
        return row.select(column.alias("out")).first()["out"]

    return run
