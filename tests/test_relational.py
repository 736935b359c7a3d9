"""Rules that need other rows."""

import random

import pytest
from pyspark.sql import functions as F

from layerflow import (
    ExistsIn,
    Layers,
    Rule,
    ShareAtMost,
    UniqueBy,
    classify,
    orders_spec,
    quality_report,
    read_table,
    run_layers,
)
from test_layers import AS_OF, SCHEMA, order
from dataclasses import replace
from datetime import datetime

ROWS = "id int, customer int, day int, status string"


def brute(data, known, percent):
    out = {}
    for i, customer, day, status in data:
        same = [r for r in data if r[1] == customer and r[2] == day]
        group = [r for r in data if r[1] == customer]
        share = 100 * sum(r[3] == "F" for r in group)
        if customer is not None and customer not in known:
            out[i] = "unknown"
        elif status is None:
            out[i] = "no status"
        elif customer is not None and day is not None and len(same) > 1:
            out[i] = "twice"
        elif share > percent * len(group):
            out[i] = "share"
        else:
            out[i] = None
    return out


@pytest.mark.parametrize("seed", range(3))
def test_reasons_in_order(spark, seed):
    random.seed(seed)
    pick = lambda *values: random.choice([None, *values])
    data = [(i, pick(1, 2, 3, 4, 9), pick(*range(20)), pick("F", "O", "P")) for i in range(150)]
    known = spark.createDataFrame([(1,), (2,), (2,), (None,), (3,), (4,)], "c int")
    rules = [
        ExistsIn("unknown", ["customer"], known, ["c"]),
        Rule.not_null("status", "no status"),
        UniqueBy("twice", ["customer", "day"]),
        ShareAtMost("share", ["customer"], F.col("status") == "F", 30),
    ]
    df = spark.createDataFrame(data, ROWS)
    got = classify(df, rules)
    assert got.columns == [*df.columns, "quarantine_reason"]
    assert {r.id: r.quarantine_reason for r in got.collect()} == brute(data, {1, 2, 3, 4}, 30)
    assert sum(r.n_rows for r in quality_report(got).collect()) == 150


def test_repeated_rows_all_fail(spark):
    df = spark.createDataFrame([(1, 1, 1, "F")] * 3 + [(2, 1, 2, "F")], ROWS)
    got = classify(df, [UniqueBy("twice", ["customer", "day"])]).collect()
    assert sorted((r.id, r.quarantine_reason) for r in got if r.id == 1) == [(1, "twice")] * 3
    assert [r.quarantine_reason for r in got if r.id == 2] == [None]


def test_empty_inputs(spark):
    df = spark.createDataFrame([(1, 1, 1, "F")], ROWS)
    nothing = spark.createDataFrame([], "customer int")
    rules = [
        ExistsIn("unknown", ["customer"], nothing),
        UniqueBy("twice", ["customer"]),
        ShareAtMost("share", ["customer"], F.col("status") == "F", 100),
    ]
    assert [r.quarantine_reason for r in classify(df, rules).collect()] == ["unknown"]
    assert classify(df.limit(0), rules).collect() == []


def test_a_hot_key_is_counted_before_its_exchange(spark):
    """The keys that decide are found by partial sums, and no window holds a key's rows."""
    df = spark.range(100_000).select(F.lit(7).alias("customer"), "id")
    rules = [
        UniqueBy("twice", ["customer"]),
        ShareAtMost("share", ["customer"], F.col("id") % 2 == 0, 40),
    ]
    got = classify(df, rules)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("partial_count") >= 2
    assert {r.outcome: r.n_rows for r in quality_report(got).collect()} == {"twice": 100_000}


def test_wrong_reasons_and_references(spark):
    df = spark.createDataFrame([(1, 1, 1, "F")], ROWS)
    for reason in ("", "clean", None):
        with pytest.raises(ValueError):
            classify(df, [UniqueBy(reason, ["customer"])])
    with pytest.raises(ValueError):
        classify(df, [ExistsIn("unknown", ["customer", "day"], df, ["id"])])


def test_in_the_flow(spark, tmp_path):
    data = [
        order(1, 101, "1.00", "new", datetime(2026, 7, 1, 1)),
        order(2, 102, "2.00", "new", datetime(2026, 7, 1, 2)),
        order(2, 101, "3.00", "new", datetime(2026, 7, 1, 1)),  # an older version, of no account
        order(3, 777, "4.00", "new", datetime(2026, 7, 1, 3)),
        order(4, 103, "-1.00", "new", datetime(2026, 7, 1, 3)),
    ]
    known = spark.createDataFrame([(101,), (102,), (103,)], "customer int")
    spec = orders_spec(AS_OF)
    exists = ExistsIn("Unknown customer", ["customer_id"], known, ["customer"])
    spec = replace(spec, rules=[exists, UniqueBy("Twice", ["customer_id"]), *spec.rules])
    layers = Layers(str(tmp_path))
    source = spark.createDataFrame(data, SCHEMA)
    run = run_layers(spark, source, spec, layers, "2026-07-03 00:00:00", buckets=2)
    assert run.counts["Unknown customer"] == 1 and run.counts["Twice"] == 0
    assert (run.n_read, run.n_clean, run.n_rejected, run.n_superseded) == (5, 2, 2, 1)
    assert sorted(r.order_id for r in read_table(spark, layers.gold).collect()) == [1, 2]
    rejected = {r.order_id: r.quarantine_reason for r in read_table(spark, layers.quarantine).collect()}
    assert rejected == {3: "Unknown customer", 4: "Negative or null total_amount"}
