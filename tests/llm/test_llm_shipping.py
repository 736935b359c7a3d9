"""Executors that cannot import the package get it as an archive."""

import os
import subprocess
import sys

from pyspark.sql import functions as F

from conftest import TESTDATA
from layerflow.llm import training

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})  # the driver's path alone
from pyspark.sql import SparkSession
spark = (
    SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", {shared!r})
    .config("spark.sql.warehouse.dir", {warehouse!r}).getOrCreate()
)
from __spark_entry__ import queries
print("rows", queries()["op12_periodic_runs"](spark, {sf_dir!r}).count())
"""


def test_a_query_from_another_folder(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    names = {
        "repo": repo,
        "shared": str(tmp_path / "shared"),
        "warehouse": str(tmp_path / "warehouse"),
        "sf_dir": f"{TESTDATA}/sf0.001",
    }
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(**names)],
        cwd=tmp_path,
        env=env,
        capture_output=True,
        text=True,
        timeout=300,
    )
    assert "rows 200" in done.stdout, done.stderr[-2000:]


def test_scratch_and_release(spark):
    def there(df):
        where = df.stored_at
        return os.path.exists(where.removeprefix("file:"))

    kept = training.stored(spark.range(3), "test")
    with training.scratch(spark):
        inner = training.stored(kept.withColumn("x", F.lit(1)), "test")
        assert inner.count() == 3
    assert there(kept) and not there(inner)
    training.release(kept, None, spark.range(1))
    assert not there(kept)
