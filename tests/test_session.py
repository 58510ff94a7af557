from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from martwright import session as sessions
from martwright.session import cut, dealt_by_rows, scratch_path, shared_folder


def session(master, setting=None, checkpoint=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: setting if key == "spark.checkpoint.dir" else default),
        sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}", getCheckpointDir=lambda: checkpoint))


def test_the_setting_names_the_folder():
    assert shared_folder(session("yarn", "hdfs:///shared")) == "hdfs:///shared"
    assert shared_folder(session("yarn", None, "hdfs:///set")) == "hdfs:///set"
    assert scratch_path(session("yarn", "hdfs:///shared/"), "x").startswith("hdfs:///shared/x-")


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session("spark://host:7077"))


def test_a_local_session_gets_one_folder_of_its_own():
    assert shared_folder(session("local[2]")) == shared_folder(session("local[2]"))


def test_cut_keeps_rows_and_schema(spark):
    df = spark.range(5).selectExpr("id", "CASE WHEN id > 2 THEN CAST(id AS DECIMAL(18,2)) END AS d", "named_struct('a', id) AS s")
    written = cut(df)
    assert written.schema.simpleString() == df.schema.simpleString()
    assert sorted(written.collect()) == sorted(df.collect())


def test_shuffles_are_dealt_by_rows(spark, monkeypatch):
    monkeypatch.setattr(sessions, "ROWS_A_TASK", 100)
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.files.maxPartitionBytes")
    before = [spark.conf.get(k) for k in keys]
    with dealt_by_rows(spark, 2500) as tasks:
        assert tasks == 25 and spark.conf.get(keys[2]) == "8m"
        assert cut(spark.range(2500).groupBy((F.col("id") * 7).alias("key")).count().withColumn("task", F.spark_partition_id())).select("task").distinct().count() == 25
    with pytest.raises(ZeroDivisionError), dealt_by_rows(spark, 0) as tasks:
        assert tasks == 1
        raise ZeroDivisionError
    assert [spark.conf.get(k) for k in keys] == before
