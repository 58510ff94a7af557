"""Every registered query against its SQL, on the smallest of the given scales."""

import pytest
from compare import compare, oracle_connection

import __spark_entry__ as entry
from martwright import oracle, registry

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = registry.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return oracle_connection(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_a_table_may_be_a_folder(spark, tmp_path):
    """The event stream gives the same rows over part files."""
    for name in ("stream_events_sink", "stream_lateness"):
        wanted = sorted(map(tuple, QUERIES[name](spark, FOLDER).collect()), key=repr)
        folder = tmp_path / name
        spark.read.parquet(f"{FOLDER}/events.parquet").repartition(4).write.parquet(str(folder / "events.parquet"))
        assert sorted(map(tuple, QUERIES[name](spark, str(folder)).collect()), key=repr) == wanted


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    assert compare(spark, db, name, QUERIES[name], ORACLES[name], FOLDER) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
