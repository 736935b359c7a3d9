"""Runs over what has changed, and quarantined rows that go back."""

from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

import layerflow.plans.incremental as incremental
import layerflow.plans.replay as replay_module
from conftest import TESTDATA
from layerflow import (
    Clauses,
    Increment,
    Layers,
    orders_spec,
    read_table,
    replay_quarantine,
    run_increment,
    run_layers,
    table_exists,
)
from layerflow.sources import changed_since, read_mark
from test_layers import AS_OF, SCHEMA, order
from workload.inputs import RUN_TS, SECOND_RUN_TS, changed_orders, raw_orders
from workload.registry import spec as workload_spec

RUNS = ["2026-07-03 00:00:00", "2026-07-04 00:00:00", "2026-07-05 00:00:00"]
DAY = timedelta(days=1)
UPDATED = Increment("updated_at", DAY)


def day(n, hour=0):
    return datetime(2026, 6, n, hour)


def gold(spark, layers):
    return sorted(tuple(r) for r in read_table(spark, layers.gold).collect())


def test_equals_a_full_run_and_reads_a_fraction(spark, tmp_path):
    sf_dir = f"{TESTDATA}/sf0.01"
    first, second = raw_orders(spark, sf_dir), changed_orders(spark, sf_dir)
    options = {"changed_only": True, "buckets": 4}
    full, part = Layers(f"{tmp_path}/full"), Layers(f"{tmp_path}/part")
    run_layers(spark, first, workload_spec(), full, RUN_TS, **options)
    run_layers(spark, second, workload_spec(), full, SECOND_RUN_TS, **options)
    runs = [
        run_increment(spark, rows, workload_spec(), part, ts, UPDATED, run_id=ts, **options)
        for rows, ts in ((first, RUN_TS), (second, SECOND_RUN_TS))
    ]
    assert gold(spark, part) == gold(spark, full)
    assert runs[0].n_read == first.count()
    changed = second.filter("updated_at = timestamp_ntz'2009-01-01'").count()
    assert changed <= runs[1].n_read < 0.2 * second.count()
    # nothing has changed since: only the look-back is read, and no gold is written
    third = run_increment(
        spark, second, workload_spec(), part, RUN_TS, UPDATED, run_id="3", **options
    )
    assert third.n_read <= runs[1].n_read and not third.gold.wrote


def test_all_versions_of_a_changed_key_are_read(spark):
    data = [
        order(1, 1, "1.00", "a", day(1)),
        order(1, 1, "2.00", "b", day(9)),
        order(2, 1, "1.00", "a", day(1)),
        order(3, 1, "1.00", "a", None),  # cannot be told from a changed one
        order(None, 1, "1.00", "a", day(9)),
        order(None, 1, "1.00", "a", day(1)),
    ]
    source = spark.createDataFrame(data, SCHEMA)
    got = changed_since(source, ["order_id"], UPDATED, day(9, 12)).collect()
    assert sorted((r.order_id or 0, str(r.updated_at)[:10]) for r in got) == [
        (0, "2026-06-09"),
        (1, "2026-06-01"),
        (1, "2026-06-09"),
        (3, "None"),
    ]
    late = changed_since(source, ["order_id"], UPDATED, day(10, 12)).collect()
    assert sorted(r.order_id for r in late) == [3]
    assert changed_since(source, ["order_id"], UPDATED, None).count() == 6


@pytest.mark.parametrize(
    "kind,mark,increment",
    [
        ("int", 5, Increment("v", 1)),
        ("date", date(2026, 6, 5), Increment("v", DAY)),
        ("timestamp_ntz", datetime(2026, 6, 5), Increment("v", DAY)),
    ],
)
def test_kinds_of_marks(spark, tmp_path, kind, mark, increment):
    step = 1 if kind == "int" else DAY
    rows = [(i, mark + (i - 5) * step) for i in range(1, 9)]
    source = spark.createDataFrame(rows, f"k int, v {kind}")
    source.write.parquet(f"{tmp_path}/source")
    stored = spark.read.parquet(f"{tmp_path}/source")
    got = changed_since(stored, ["k"], increment, mark)
    assert sorted(r.k for r in got.collect()) == [4, 5, 6, 7, 8]
    plan = got._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(v" in plan  # reaches the scan
    marks = incremental.mark_of(source, increment)
    marks.write.parquet(f"{tmp_path}/marks")
    assert read_mark(spark, f"{tmp_path}/marks") == mark + 3 * step
    assert read_mark(spark, f"{tmp_path}/nowhere") is None


def test_a_run_cut_off_before_its_mark_is_done_again(spark, tmp_path, monkeypatch):
    layers, spec = Layers(str(tmp_path)), orders_spec(AS_OF)
    first = spark.createDataFrame(
        [order(1, 1, "1.00", "a", day(1)), order(2, 1, "-1.00", "a", day(1))], SCHEMA
    )
    with monkeypatch.context() as patch:
        patch.setattr(incremental, "mark_of", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_increment(spark, first, spec, layers, RUNS[0], UPDATED, run_id="1", buckets=2)
    assert not table_exists(spark, layers.marks)
    run_increment(spark, first, spec, layers, RUNS[0], UPDATED, run_id="1", buckets=2)
    assert read_table(spark, layers.quarantine).count() == 1  # replaced, not doubled
    assert [r[0] for r in gold(spark, layers)] == [1]
    assert read_mark(spark, layers.marks) == day(1)


def test_empty_source_and_refused_clauses(spark, tmp_path):
    layers, spec = Layers(str(tmp_path)), orders_spec(AS_OF)
    nothing = spark.createDataFrame([], SCHEMA)
    run = run_increment(spark, nothing, spec, layers, RUNS[0], UPDATED, run_id="1", buckets=2)
    assert run.n_read == 0 and read_mark(spark, layers.marks) is None
    with pytest.raises(ValueError):
        run_increment(
            spark,
            nothing,
            spec,
            layers,
            RUNS[0],
            UPDATED,
            run_id="2",
            clauses=Clauses(orphans="delete"),
        )


# Replays.


def refunds():
    spec = orders_spec(AS_OF)
    return replace(spec, rules=[r for r in spec.rules if "amount" not in r.reason])


def run(spark, layers, data, ts, run_id):
    source = spark.createDataFrame(data, SCHEMA)
    return run_layers(spark, source, orders_spec(AS_OF), layers, ts, run_id=run_id, buckets=2)


def test_rejected_rows_go_back_once(spark, tmp_path):
    layers = Layers(str(tmp_path))
    run(
        spark,
        layers,
        [
            order(1, 1, "5.00", "a", day(1)),
            order(2, 1, "-2.00", "a", day(1)),  # passes later
            order(3, None, "-2.00", "a", day(1)),  # fails still
            order(None, 1, "-2.00", "a", day(1)),  # has no key
            order(4, 1, "-2.00", "a", day(1)),  # a newer version comes
        ],
        RUNS[0],
        "1",
    )
    run(
        spark,
        layers,
        [order(1, 1, "-5.00", "b", day(2)), order(4, 1, "4.00", "b", day(2))],
        RUNS[1],
        "2",
    )
    before = gold(spark, layers)
    got = replay_quarantine(spark, refunds(), layers, RUNS[2], run_id="r1")
    after = gold(spark, layers)
    # key 1 was good and then turned bad: its later version is the one that goes back
    assert got.n_replayed == 2 and got.gold.wrote
    assert [(r[0], str(r[3]), r[4]) for r in after] == [
        (1, "-5.00", "B"),
        (2, "-2.00", "A"),
        (4, "4.00", "B"),
    ]
    assert [r for r in after if r[0] == 4] == [r for r in before if r[0] == 4]
    assert {str(r[5]) for r in after if r[0] != 4} == {RUNS[2]}
    for run_id in ("r2", "r1"):
        again = replay_quarantine(spark, refunds(), layers, "2026-07-09 00:00:00", run_id=run_id)
        assert again.n_replayed == 0 and not again.gold.wrote
        assert gold(spark, layers) == after


def test_a_deleted_row_does_not_come_back(spark, tmp_path):
    """The list of replayed rows holds where gold no longer tells."""
    layers = Layers(str(tmp_path))
    run(spark, layers, [order(1, 1, "5.00", "a", day(1)), order(2, 1, "-2.00", "a", day(1))], RUNS[0], "1")
    assert replay_quarantine(spark, refunds(), layers, RUNS[1], run_id="r1").n_replayed == 1
    source = spark.createDataFrame([order(1, 1, "6.00", "a", day(2))], SCHEMA)
    run_layers(
        spark, source, orders_spec(AS_OF), layers, RUNS[2], clauses=Clauses(orphans="delete")
    )
    assert [r[0] for r in gold(spark, layers)] == [1]
    assert replay_quarantine(spark, refunds(), layers, RUNS[2], run_id="r2").n_replayed == 0


def test_a_replay_cut_off_before_its_list(spark, tmp_path, monkeypatch):
    layers = Layers(str(tmp_path))
    run(spark, layers, [order(2, 1, "-2.00", "a", day(1)), order(1, 1, "1.00", "a", day(1))], RUNS[0], "1")
    with monkeypatch.context() as patch:
        patch.setattr(replay_module, "append_rows", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            replay_quarantine(spark, refunds(), layers, RUNS[1], run_id="r1")
    after = gold(spark, layers)
    assert [r[0] for r in after] == [1, 2]
    replay_quarantine(spark, refunds(), layers, RUNS[1], run_id="r1")
    assert gold(spark, layers) == after


def test_without_quarantine(spark, tmp_path):
    layers = Layers(str(tmp_path))
    assert replay_quarantine(spark, refunds(), layers, RUNS[0], run_id="r").n_replayed == 0
    run(spark, layers, [order(1, 1, "5.00", "a", day(1))], RUNS[0], "1")
    assert replay_quarantine(spark, refunds(), layers, RUNS[0], run_id="r").n_replayed == 0


def test_bucketed_gold(spark, tmp_path):
    layers, table = Layers(str(tmp_path)), "replayed_gold"
    source = spark.createDataFrame(
        [order(1, 1, "5.00", "a", day(1)), order(2, 1, "-2.00", "a", day(1))], SCHEMA
    )
    run_layers(
        spark, source, orders_spec(AS_OF), layers, RUNS[0], run_id="1", buckets=2, gold_table=table
    )
    got = replay_quarantine(spark, refunds(), layers, RUNS[1], run_id="r1", gold_table=table)
    assert got.n_replayed == 1
    assert sorted(r.order_id for r in spark.table(table).collect()) == [1, 2]
    spark.sql(f"DROP TABLE {table}")


def test_digest_table_stays_current(spark, tmp_path):
    """A replay goes by the same digest as the runs, so the next run sees no change."""
    layers, spec = Layers(str(tmp_path)), refunds()
    data = [order(1, 1, "5.00", "a", day(1)), order(2, 1, "-2.00", "a", day(1))]
    source = spark.createDataFrame(data, SCHEMA)
    options = {"buckets": 2, "changed_only": True}
    run_layers(spark, source, orders_spec(AS_OF), layers, RUNS[0], run_id="1", **options)
    replay_quarantine(spark, spec, layers, RUNS[1], run_id="r1")
    again = run_layers(spark, source, spec, layers, RUNS[2], run_id="2", **options)
    assert not again.gold.wrote and again.n_clean == 2
    assert read_table(spark, layers.gold).filter(F.col("order_id") == 2).count() == 1
