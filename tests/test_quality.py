from datetime import datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from layerflow import (
    Rule,
    classify,
    preview,
    quality_counters,
    quality_report,
    split_by_quality,
)
from layerflow.plans.orders import SILVER_COLUMNS, orders_rules

AS_OF = datetime(2024, 1, 1, 12)
SCHEMA = (
    "order_id int, customer_id int, total_amount decimal(10,2), order_timestamp timestamp_ntz"
)
GOOD = (1, 1, Decimal("1.00"), AS_OF)
QUICK = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def reasons(spark, *data):
    df = classify(spark.createDataFrame(data, SCHEMA), orders_rules(AS_OF))
    return [r.quarantine_reason for r in df.collect()]


def test_boundaries_pass(spark):
    assert reasons(spark, GOOD, (1, 1, Decimal("0.00"), AS_OF)) == [None, None]


def test_each_rule(spark):
    assert reasons(
        spark,
        (None, 1, Decimal(1), AS_OF),
        (1, None, Decimal(1), AS_OF),
        (1, 1, None, AS_OF),
        (1, 1, Decimal("-0.01"), AS_OF),
        (1, 1, Decimal(1), None),
        (1, 1, Decimal(1), datetime(2024, 1, 1, 12, 0, 0, 1)),
    ) == [
        "Missing order_id",
        "Missing customer_id",
        "Negative or null total_amount",
        "Negative or null total_amount",
        "Invalid or future order_date",
        "Invalid or future order_date",
    ]


def test_first_failing_rule_wins(spark):
    assert reasons(spark, (None, None, None, None), (1, None, None, None)) == [
        "Missing order_id",
        "Missing customer_id",
    ]


def test_null_verdict_fails_the_row(spark):
    df = spark.createDataFrame([(None,), (1,), (5,)], "x int")
    out = classify(df, [Rule("too small", F.col("x") > 3), Rule("never", F.lit(None) | True)])
    clean, rejected = split_by_quality(out, ["x"], "2024-01-01 00:00:00")
    assert [tuple(r) for r in clean.collect()] == [(5,)]
    assert rejected.count() == 2
    with pytest.raises(ValueError):
        classify(df, [])


value = st.one_of(st.none(), st.integers(-2, 2))


@QUICK
@given(data=st.lists(st.tuples(value, value, value, value), max_size=20))
def test_split_is_a_partition_and_counts_agree(spark, data):
    df = spark.createDataFrame(data, "a int, b int, c int, d int")
    rules = [
        Rule.not_null("a", "no a"),
        Rule.at_least("b", 0, "b negative"),
        Rule("c above d", F.col("c") <= F.col("d")),
        Rule("c above d", F.col("d") < 2),
    ]
    out = classify(df, rules)
    clean, rejected = split_by_quality(out, df.columns, "2024-01-01 00:00:00")

    def first(row):
        a, b, c, d = row
        if a is None:
            return "no a"
        if b is None or b < 0:
            return "b negative"
        if c is None or d is None or c > d or d >= 2:
            return "c above d"
        return "clean"

    expected = [(row, first(row)) for row in data]
    assert sorted(map(repr, (tuple(r) for r in clean.collect()))) == sorted(
        repr(row) for row, reason in expected if reason == "clean"
    )
    assert sorted(repr((tuple(r)[:4], r.quarantine_reason)) for r in rejected.collect()) == sorted(
        repr(e) for e in expected if e[1] != "clean"
    )
    report = {r.outcome: r.n_rows for r in quality_report(out).collect()}
    observed = out.agg(*(c.alias(n) for n, c in quality_counters(rules).items())).first().asDict()
    assert sum(report.values()) == sum(observed.values()) == len(data)
    assert all(observed[k] == report.get(k, 0) for k in observed)


def test_rejected_rows_are_whole(spark):
    df = classify(spark.createDataFrame([GOOD], SCHEMA), orders_rules("2000-01-01 00:00:00"))
    df = df.withColumns({"order_status": F.lit("X"), "silver_processed_at": F.lit(1)})
    clean, rejected = split_by_quality(df, SILVER_COLUMNS, "2024-01-02 00:00:00")
    assert clean.columns == list(SILVER_COLUMNS)
    assert rejected.columns == [*df.columns, "quarantined_at"]
    assert rejected.first().quarantined_at == datetime(2024, 1, 2)


def test_preview(spark):
    df = spark.range(100).withColumn("x", -F.col("id"))
    assert preview(df, 5).count() == 5
    top = preview(df, 3, ["x"], ["id"])
    assert [r.id for r in top.collect()] == [99, 98, 97]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("reason", ["clean", "", None, 3])
def test_reasons_that_cannot_be_counted_are_refused(reason):
    with pytest.raises(ValueError, match="not a reason"):
        Rule(reason, F.col("a") > 0)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(reasons=st.lists(st.text(min_size=1, max_size=8).filter(lambda r: r != "clean"), min_size=1, max_size=3))
def test_counts_add_up_whatever_the_reasons(spark, reasons):
    rules = [Rule(reason, F.col("id") % (i + 2) != 0) for i, reason in enumerate(reasons)]
    classified = classify(spark.range(30), rules)
    counters = list(quality_counters(rules).values())
    counts = classified.agg(*(c.alias(f"n{i}") for i, c in enumerate(counters))).first()
    assert sum(counts) == 30 and counts[0] == classified.filter("quarantine_reason IS NULL").count()
    assert sum(r.n_rows for r in quality_report(classified).collect()) == 30
