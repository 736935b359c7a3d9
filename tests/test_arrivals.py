"""The flow over arriving files: cut off and taken up again, late versions, no new files."""

from datetime import datetime

import pytest

import layerflow.streaming.arrivals as arrivals
from layerflow import Clauses, Layers, orders_spec, read_table, run_layers
from layerflow.streaming import run_arrivals
from test_layers import AS_OF, SCHEMA, order

TS = "2026-07-03 00:00:00"


def day(n):
    return datetime(2026, 6, n)


FILES = [
    [order(1, 1, "1.00", "a", day(5)), order(2, 1, "2.00", "a", day(1)), order(3, 1, "-1.00", "a", day(1))],
    [order(1, 1, "9.00", "late", day(2)), order(2, 1, "3.00", "b", day(2))],
    [order(None, 1, "1.00", "a", day(1)), order(4, None, "1.00", "a", day(1)), order(5, 1, "5.00", "a", day(1))],
    [order(3, 1, "3.00", "c", day(3)), order(5, 1, "6.00", "b", day(2))],
]


def put(spark, folder, *numbers):
    for n in numbers:
        spark.createDataFrame(FILES[n], SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))


def take_in(spark, base, **options):
    layers = Layers(f"{base}/layers")
    runs = run_arrivals(
        spark,
        f"{base}/in",
        SCHEMA,
        orders_spec(AS_OF),
        layers,
        TS,
        checkpoint=f"{base}/checkpoint",
        files_per_batch=1,
        buckets=2,
        **options,
    )
    return layers, runs


def gold(spark, layers):
    return sorted(tuple(r) for r in read_table(spark, layers.gold).collect())


def one_shot(spark, base):
    layers = Layers(f"{base}/one-shot")
    rows = [r for rows in FILES for r in rows]
    run_layers(spark, spark.createDataFrame(rows, SCHEMA), orders_spec(AS_OF), layers, TS, buckets=2)
    return gold(spark, layers)


def test_files_in_turn(spark, tmp_path):
    put(spark, f"{tmp_path}/in", 0, 1)
    layers, runs = take_in(spark, tmp_path)
    assert len(runs) == 2
    put(spark, f"{tmp_path}/in", 2, 3)
    _, runs = take_in(spark, tmp_path)
    assert [r.n_read for r in runs] == [3, 4]  # all versions of the batch's keys, no more
    assert gold(spark, layers) == one_shot(spark, tmp_path)
    assert take_in(spark, tmp_path)[1] == []
    reasons = sorted(r.quarantine_reason for r in read_table(spark, layers.quarantine).collect())
    assert reasons == ["Missing customer_id", "Missing order_id", "Negative or null total_amount"]


@pytest.mark.parametrize("step", ["before", "after"])
def test_killed_and_taken_up_again(spark, tmp_path, monkeypatch, step):
    put(spark, f"{tmp_path}/in", 0, 1, 2, 3)
    calls = []

    def failing(*args, **options):
        calls.append(1)
        if step == "after":
            run_layers(*args, **options)
        if len(calls) == 2:
            raise RuntimeError("killed")
        if step == "before":
            return run_layers(*args, **options)

    with monkeypatch.context() as patch:
        patch.setattr(arrivals, "run_layers", failing)
        with pytest.raises(Exception, match="killed"):
            take_in(spark, tmp_path)
    layers, runs = take_in(spark, tmp_path)
    assert len(runs) == 3  # the second batch again, and two more
    assert gold(spark, layers) == one_shot(spark, tmp_path)
    assert read_table(spark, layers.quarantine).count() == 3


def test_orphans_are_refused(spark, tmp_path):
    put(spark, f"{tmp_path}/in", 0)
    with pytest.raises(ValueError):
        take_in(spark, tmp_path, clauses=Clauses(orphans="delete"))
