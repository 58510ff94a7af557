import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from martwright.session import build_session

    session = build_session(
        "tests", "local[8]", 8, spark__driver__memory="6g", spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def many_buckets(spark):
    """Keep small sorts spread over all partitions, so that carries between buckets happen."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
