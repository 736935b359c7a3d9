import os
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import layerflow.plans.layers as plans
from layerflow import (
    Layers,
    orders_spec,
    preview,
    read_table,
    run_layers,
    table_exists,
    write_snapshot,
)
from layerflow.plans.orders import SILVER_COLUMNS
from workload.registry import QUERIES

AS_OF = datetime(2026, 7, 2)
SCHEMA = (
    "order_id int, customer_id int, amount decimal(10,2), status string, "
    "created_at timestamp_ntz, updated_at timestamp_ntz"
)


def order(key, customer, amount, status, updated, created=datetime(2026, 7, 1)):
    return key, customer, Decimal(amount) if amount else None, status, created, updated


# fixed values: the three known source rows
SEED = [
    order(1, 101, "250.50", "completed", datetime(2026, 7, 1, 10, 0)),
    order(2, 102, "12.99", "pending", datetime(2026, 7, 1, 11, 30)),
    order(3, 103, "89.00", "completed", datetime(2026, 7, 2, 0, 15)),
]


def run(spark, base, data, run_ts, **options):
    source = spark.createDataFrame(data, SCHEMA)
    layers = Layers(str(base))
    return layers, run_layers(
        spark, source, orders_spec(AS_OF), layers, run_ts, buckets=4, **options
    )


def test_seed_rows_reach_gold(spark, tmp_path):
    layers, result = run(spark, tmp_path, SEED, "2026-07-03 00:00:00")
    assert (result.n_clean, result.n_rejected) == (3, 0)
    assert set(result.seconds) == {"bronze", "silver", "gold"}
    assert not table_exists(spark, layers.quarantine)  # nothing to write, nothing written
    gold = read_table(spark, layers.gold)
    assert gold.columns == list(SILVER_COLUMNS)
    assert [tuple(r)[:5] for r in preview(gold, 10, ["order_id"]).collect()] == [
        (1, 101, datetime(2026, 7, 1), Decimal("250.50"), "COMPLETED"),
        (2, 102, datetime(2026, 7, 1), Decimal("12.99"), "PENDING"),
        (3, 103, datetime(2026, 7, 1), Decimal("89.00"), "COMPLETED"),
    ]
    bronze = read_table(spark, layers.bronze)
    assert bronze.columns[-2:] == ["ingested_at", "source_system"]
    assert bronze.select("source_system").distinct().first()[0] == "postgres_ecom"


def test_second_run(spark, tmp_path):
    run(spark, tmp_path, SEED, "2026-07-03 00:00:00")
    later = [
        order(1, 101, "-1.00", "completed", datetime(2026, 7, 3)),  # turned bad
        order(2, 102, "13.99", None, datetime(2026, 7, 3)),  # changed; 3 is deleted
        order(2, 102, "12.99", "pending", datetime(2026, 7, 1)),  # an older version
        order(4, None, "5.00", "pending", datetime(2026, 7, 3)),
        order(5, 105, "5.00", "pending", datetime(2026, 7, 3), created=datetime(2026, 8, 1)),
        order(6, 106, "0.00", "pending", datetime(2026, 7, 3)),
    ]
    layers, result = run(spark, tmp_path, later, "2026-07-04 00:00:00", run_id="two")
    assert result.counts == {
        "clean": 2,
        "Missing order_id": 0,
        "Missing customer_id": 1,
        "Negative or null total_amount": 1,
        "Invalid or future order_date": 1,
    }
    gold = {r.order_id: r for r in read_table(spark, layers.gold).collect()}
    assert sorted(gold) == [1, 2, 3, 6]
    assert gold[1].total_amount == Decimal("250.50")  # the last good row stays
    assert gold[1].silver_processed_at == datetime(2026, 7, 3)
    assert (gold[2].total_amount, gold[2].order_status) == (Decimal("13.99"), "UNKNOWN")
    assert gold[2].silver_processed_at == datetime(2026, 7, 4)
    rejected = read_table(spark, layers.quarantine)
    assert rejected.count() == 3
    assert rejected.filter("amount IS NULL OR updated_at IS NULL").count() == 0  # whole rows
    again = run(spark, tmp_path, later, "2026-07-04 00:00:00", run_id="two")[1]
    assert again.counts == result.counts
    assert read_table(spark, layers.quarantine).count() == 3


def test_a_failing_step_ends_the_run(spark, tmp_path):
    fail = F.udf(lambda x: 1 // 0, "int")
    source = spark.createDataFrame(SEED, SCHEMA).withColumn("customer_id", fail("order_id"))
    layers = Layers(str(tmp_path))
    with pytest.raises(PySparkException):
        run_layers(spark, source, orders_spec(AS_OF), layers, "2026-07-03 00:00:00")
    assert not table_exists(spark, layers.silver) and not table_exists(spark, layers.gold)


def test_every_run_time_column_is_the_run_time(spark, tmp_path):
    data = [*SEED, order(7, None, "1.00", "x", datetime(2026, 7, 1))]
    layers, _ = run(spark, tmp_path, data, datetime(2026, 7, 3))
    for path, columns in (
        (layers.bronze, ["ingested_at"]),
        (layers.silver, ["silver_processed_at"]),
        (layers.quarantine, ["silver_processed_at", "quarantined_at", "ingested_at"]),
    ):
        for column in columns:
            stamps = read_table(spark, path).select(column).distinct().collect()
            assert [tuple(r) for r in stamps] == [(datetime(2026, 7, 3),)]


def test_cleaning_has_one_exchange(spark):
    plan = QUERIES["silver_orders"](spark, "/root/testdata/sf0.001")
    assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1


def test_nothing_to_do(spark, tmp_path):
    layers, result = run(spark, tmp_path, [], "2026-07-03 00:00:00")
    assert set(result.counts.values()) == {0}
    assert read_table(spark, layers.silver).columns == list(SILVER_COLUMNS)
    assert read_table(spark, layers.silver).isEmpty()
    assert not table_exists(spark, layers.gold)  # the first run with clean rows creates it
    run(spark, tmp_path, SEED, "2026-07-04 00:00:00")
    run(spark, tmp_path, [], "2026-07-05 00:00:00")
    assert read_table(spark, layers.gold).count() == 3


def test_nothing_but_rejects(spark, tmp_path):
    data = [order(1, None, "1.00", "x", datetime(2026, 7, 1))]
    layers, result = run(spark, tmp_path, data, "2026-07-03 00:00:00")
    assert (result.n_clean, result.n_rejected) == (0, 1)
    assert read_table(spark, layers.quarantine).count() == 1
    assert read_table(spark, layers.silver).isEmpty()


def test_staged_rows_are_removed_after_the_run(spark, tmp_path):
    import os

    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared)) if os.path.isdir(shared) else set()
    run(spark, tmp_path, SEED, "2026-07-03 00:00:00")
    assert set(os.listdir(shared)) == before


def test_another_file_format(spark, tmp_path):
    for stamp in ("2026-07-03 00:00:00", "2026-07-04 00:00:00"):
        layers, result = run(spark, tmp_path, SEED, stamp, fmt="orc")
    assert result.n_clean == 3
    gold = read_table(spark, layers.gold, fmt="orc")
    assert [r.silver_processed_at for r in gold.collect()] == [datetime(2026, 7, 4)] * 3


def test_every_bronze_row_is_accounted_for(spark, tmp_path):
    data = [
        *SEED,
        order(1, 101, "1.00", "pending", datetime(2026, 6, 30)),  # an older version
        order(None, 101, "1.00", "pending", datetime(2026, 6, 30)),
        order(None, 102, "2.00", "pending", datetime(2026, 6, 30)),
        order(None, 103, "3.00", "pending", datetime(2026, 6, 30)),
        order(4, 101, "-1.00", "pending", datetime(2026, 6, 30)),
    ]
    _, result = run(spark, tmp_path, data, "2026-07-03 00:00:00")
    assert (result.n_read, result.n_clean, result.n_rejected) == (8, 3, 2)
    assert (result.n_superseded, result.n_collapsed) == (1, 2)
    _, nothing = run(spark, tmp_path / "empty", [], "2026-07-03 00:00:00")
    assert (nothing.n_read, nothing.n_clean, nothing.n_rejected, nothing.n_superseded) == (0, 0, 0, 0)


def test_a_failing_sink_leaves_nothing_behind(spark, tmp_path, monkeypatch):
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")

    def staged():
        if not os.path.isdir(folder):
            return set()
        return {name for name in os.listdir(folder) if name.startswith("layerflow-classified")}

    def fail(df, path, **options):
        if "silver" in path:
            raise OSError("no space")
        return write_snapshot(df, path, **options)

    before = staged()
    monkeypatch.setattr(plans, "write_snapshot", fail)
    with pytest.raises(OSError, match="no space"):
        run(spark, tmp_path, SEED, "2026-07-03 00:00:00")
    assert staged() == before


def test_formats_without_an_upsert_are_refused_at_once(spark, tmp_path):
    with pytest.raises(ValueError, match="no upsert into json"):
        run(spark, tmp_path / "json", SEED, "2026-07-03 00:00:00", fmt="json")
    assert not (tmp_path / "json").exists()
