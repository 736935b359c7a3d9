import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from layerflow import (
    JdbcSplit,
    JdbcTarget,
    Layers,
    append_rows,
    read_jdbc,
    read_table,
    shared_folder,
    stage_table,
    table_exists,
    write_snapshot,
)
from layerflow.sources import jdbc
from layerflow.sources.tables import discard


def test_snapshot_replaces_a_path(spark, tmp_path):
    path = f"{tmp_path}/t"
    write_snapshot(spark.range(5), path)
    write_snapshot(spark.range(2).withColumn("x", F.lit(1)), path)
    assert read_table(spark, path).columns == ["id", "x"]
    assert read_table(spark, path).count() == 2
    with pytest.raises(ValueError):
        write_snapshot(spark.range(1))
    with pytest.raises(ValueError):
        read_table(spark, path, table="t")


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_format_is_a_parameter(spark, tmp_path, fmt):
    write_snapshot(spark.range(5), f"{tmp_path}/t", fmt=fmt)
    assert read_table(spark, f"{tmp_path}/t", fmt=fmt).count() == 5


def test_snapshot_replaces_a_managed_table(spark, tmp_path):
    spark.sql(f"CREATE DATABASE snapshots LOCATION '{tmp_path}/db'")
    assert not table_exists(spark, table="snapshots.t")
    write_snapshot(spark.range(5), table="snapshots.t")
    write_snapshot(spark.range(3), table="snapshots.t")
    assert table_exists(spark, table="snapshots.t")
    assert read_table(spark, table="snapshots.t").count() == 3


def test_table_exists(spark, tmp_path):
    assert not table_exists(spark, f"{tmp_path}/none")
    os.makedirs(f"{tmp_path}/failed/_temporary")
    assert not table_exists(spark, f"{tmp_path}/failed")
    os.makedirs(f"{tmp_path}/delta/_delta_log")
    assert table_exists(spark, f"{tmp_path}/delta")
    spark.range(1).write.parquet(f"{tmp_path}/t")
    assert table_exists(spark, f"file://{tmp_path}/t")
    with pytest.raises(ValueError):
        table_exists(spark)


def test_append(spark, tmp_path):
    path = f"{tmp_path}/q"
    assert not append_rows(spark.range(0), path)
    assert not os.path.exists(path)
    assert append_rows(spark.range(2), path)
    assert append_rows(spark.range(2), path, n_rows=2)
    assert not append_rows(spark.range(2), path, n_rows=0)
    assert read_table(spark, path).count() == 4
    assert append_rows(spark.range(0), path, skip_empty=False)


def test_append_once_per_run(spark, tmp_path):
    path = f"{tmp_path}/q"
    for run_id, n in (("a", 2), ("b", 3), ("b", 1), ("c", 0)):
        append_rows(spark.range(n), path, run_id=run_id)
    counts = dict(tuple(r) for r in read_table(spark, path).groupBy("run_id").count().collect())
    assert counts == {"a": 2, "b": 1}
    append_rows(spark.range(0), path, run_id="a")  # the earlier attempt's rows must go
    assert read_table(spark, path).filter("run_id = 'a'").count() == 0


def test_staged_table_is_in_the_shared_folder(spark):
    path = stage_table(spark.range(4).withColumn("even", F.col("id") % 2 == 0), "x", ["even"])
    assert path.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert spark.read.schema("id bigint, even boolean").parquet(path).filter("even").count() == 2
    discard(spark, path)
    with pytest.raises(AnalysisException):
        spark.read.parquet(path)


def test_a_cluster_must_name_its_shared_folder():
    class Conf(dict):
        pass

    class Session:
        conf = Conf({"spark.master": "yarn"})

        class sparkContext:
            @staticmethod
            def getCheckpointDir():
                return None

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session, "x")
    Session.conf["spark.checkpoint.dir"] = "hdfs:///shared/"
    assert shared_folder(Session, "x").startswith("hdfs:///shared/x-")


def test_layers():
    layers = Layers("s3a://lake/", "sales")
    assert layers.bronze == "s3a://lake/bronze/sales"
    assert (layers.silver, layers.gold) == ("s3a://lake/silver/sales", "s3a://lake/gold/sales")
    assert Layers.from_env(env={}).quarantine == "./storage/quarantine/orders"
    assert Layers.from_env(env={"CLOUD_STORAGE_PATH": "/x"}).gold == "/x/gold/orders"


# --- JDBC: no database may be started here, so the options handed to Spark are checked --


class Reader:
    """Stands in for ``spark.read``: notes options, and answers the bounds query."""

    def __init__(self, bounds=None):
        self.scans, self.bounds = [], bounds

    @property
    def read(self):
        return self

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **options):
        self.scans.append(options)
        return self

    def load(self):
        return self

    def first(self):
        return self.bounds


TARGET = JdbcTarget("jdbc:postgresql://h:1/d", "u", "secret")


def test_jdbc_settings():
    with pytest.raises(KeyError):
        JdbcTarget.from_env({})
    target = JdbcTarget.from_env({"DB_PASSWORD": "p", "DB_HOST": "db"})
    assert target.url == "jdbc:postgresql://db:5432/ecom_source"
    assert target.user == "data_engineer" and target.driver == "org.postgresql.Driver"
    assert "secret" not in repr(TARGET)


def test_jdbc_single_scan():
    spark = Reader()
    read_jdbc(spark, TARGET, "orders")
    assert spark.scans == [{**TARGET.options(), "fetchsize": "10000", "dbtable": "orders"}]


def test_jdbc_split_with_given_bounds():
    spark = Reader()
    read_jdbc(spark, TARGET, "orders", JdbcSplit("order_id", 64, 1, 10**9))
    (scan,) = spark.scans
    assert scan["partitionColumn"] == "order_id" and scan["numPartitions"] == "64"
    assert (scan["lowerBound"], scan["upperBound"]) == ("1", "1000000000")


def test_jdbc_split_looks_up_missing_bounds():
    spark = Reader({"lo": 3, "hi": 99})
    read_jdbc(spark, TARGET, "orders", JdbcSplit("order_id", 4, upper=50))
    bounds, scan = spark.scans
    assert "min(order_id)" in bounds["dbtable"] and "partitionColumn" not in bounds
    assert (scan["lowerBound"], scan["upperBound"], scan["dbtable"]) == ("3", "50", "orders")


def test_jdbc_split_of_an_empty_table():
    spark = Reader({"lo": None, "hi": None})
    read_jdbc(spark, TARGET, "orders", JdbcSplit("order_id", 4))
    assert "partitionColumn" not in spark.scans[-1]


def test_jdbc_needs_no_database_to_fail_clearly(spark):
    assert jdbc.JdbcTarget("jdbc:none:x", "u", "p", "no.such.Driver").options()["url"] == "jdbc:none:x"
    with pytest.raises(Exception, match="no.such.Driver"):
        read_jdbc(spark, JdbcTarget("jdbc:none:x", "u", "p", "no.such.Driver"), "orders")


def test_run_ids_are_text_of_any_look(spark, tmp_path):
    path = str(tmp_path / "runs")
    ids = ["a/b", "a", "01", "1", "2024-01-01", "12:30:00", "x=y %41", "null"]
    for n, run_id in enumerate(ids, 1):
        append_rows(spark.range(n), path, run_id=run_id)
        append_rows(spark.range(n), path, run_id=run_id)  # done again
    stored = read_table(spark, path)
    assert dict(stored.dtypes)["run_id"] == "string"
    counts = {r.run_id: r["count"] for r in stored.groupBy("run_id").count().collect()}
    assert counts == {run_id: n for n, run_id in enumerate(ids, 1)}
    append_rows(spark.range(0), path, run_id="a/b")
    append_rows(spark.range(0), path, run_id="1")
    left = {r.run_id for r in read_table(spark, path).select("run_id").distinct().collect()}
    assert left == set(ids) - {"a/b", "1"}
    numbers = str(tmp_path / "numbers")
    for run_id in ("01", "1"):
        append_rows(spark.range(2), numbers, run_id=run_id)
    assert {r.run_id for r in read_table(spark, numbers).collect()} == {"01", "1"}
    for run_id in ("", 5):
        with pytest.raises(ValueError):
            append_rows(spark.range(1), path, run_id=run_id)
    with pytest.raises(ValueError, match="not for delta"):
        append_rows(spark.range(1), path, run_id="a", fmt="delta")
    with pytest.raises(ValueError, match="already"):
        append_rows(spark.range(1).withColumnRenamed("id", "run_id"), path, run_id="a")
