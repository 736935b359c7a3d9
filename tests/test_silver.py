from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from layerflow import Category, FixedDecimal, ParseTime, add_audit_columns, conform, dedupe_latest
from layerflow.functions import timestamp_literal, utc_now

QUICK = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
SCHEMA = "k int, at int, v string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_latest_row_wins_and_null_is_oldest(spark):
    df = spark.createDataFrame(
        [(1, 5, "a"), (1, 7, "b"), (1, None, "c"), (2, None, "d"), (2, None, "e")], SCHEMA
    )
    assert rows(dedupe_latest(df, ["k"], ["at"])) == [(1, 7, "b"), (2, None, "e")]


def test_null_keys_collapse_or_stay(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), (None, 2, "b"), (1, 1, "c")], SCHEMA)
    assert rows(dedupe_latest(df, ["k"], ["at"])) == [(1, 1, "c"), (None, 2, "b")]
    kept = dedupe_latest(df, ["k"], ["at"], null_keys="keep")
    assert rows(kept) == [(1, 1, "c"), (None, 1, "a"), (None, 2, "b"), (None, 2, "b")]
    with pytest.raises(ValueError):
        dedupe_latest(df, ["k"], null_keys="drop")


def test_composite_key_with_one_null_part(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, None, "b"), (1, 1, "c")], SCHEMA)
    assert rows(dedupe_latest(df, ["k", "at"])) == [(1, 1, "c"), (1, None, "b")]
    assert dedupe_latest(df, ["k", "at"], null_keys="keep").count() == 3


def test_table_of_keys_only(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert rows(dedupe_latest(df, ["k"])) == [(1,), (2,)]


def test_columns_without_an_order_are_carried(spark):
    df = spark.createDataFrame(
        [(1, {"a": 1}, 1), (1, {"b": 2}, 2)], "k int, m map<string,int>, at int"
    )
    assert rows(dedupe_latest(df, ["k"], ["at"])) == [(1, {"b": 2}, 2)]
    assert rows(dedupe_latest(df.select("k", "m"), ["k"])) == [(1, {"b": 2})]


def test_column_order_and_types_are_kept(spark):
    df = spark.createDataFrame([("a", 1, Decimal("1.50"))], "v string, k int, d decimal(10,2)")
    assert dedupe_latest(df, ["k"], ["d"]).schema == df.schema


def test_hot_key_leaves_each_map_task_as_one_row(spark):
    df = spark.range(0, 300_000, numPartitions=16).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("at"),
    )
    out = dedupe_latest(df, ["k"], ["at"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_max" in plan
    assert out.filter("k = 7").collect()[0]["at"] == 299_997
    assert out.count() == 200_000


@QUICK
@given(
    data=st.lists(
        st.tuples(
            st.one_of(st.none(), st.integers(0, 3)),
            st.one_of(st.none(), st.integers(0, 2)),
            st.one_of(st.none(), st.sampled_from("abc")),
        ),
        max_size=25,
    ),
    parts=st.integers(1, 7),
)
def test_dedupe_against_brute_force_under_any_partitioning(spark, data, parts):
    def rank(row):
        return tuple((x is not None, x if x is not None else 0) for x in row[1:])

    best = {}
    for row in data:
        if row[0] not in best or rank(row) > rank(best[row[0]]):
            best[row[0]] = row
    df = spark.createDataFrame(data, SCHEMA).repartition(parts)
    assert rows(dedupe_latest(df, ["k"], ["at"])) == sorted(best.values(), key=repr)


def test_parse_time(spark):
    df = spark.createDataFrame(
        [
            ("2024-05-01 10:00:00",),
            ("garbage",),
            ("2024-05-01 10:00:00.123",),
            ("2024-02-30 10:00:00",),
            (None,),
        ],
        "t string",
    )
    got = [r.at for r in conform(df, [ParseTime("at", "t")]).collect()]
    assert got == [datetime(2024, 5, 1, 10), None, None, None, None]


def test_parse_time_keeps_typed_values(spark):
    moment = datetime(2024, 5, 1, 10, 0, 0, 123000)
    df = spark.createDataFrame([(moment, moment, date(2024, 5, 1))], "a timestamp, b timestamp_ntz, c date")
    out = conform(df, [ParseTime("x", "a"), ParseTime("y", "b"), ParseTime("z", "c")])
    assert tuple(out.select("x", "y", "z").first()) == (moment, moment, datetime(2024, 5, 1))
    assert [f.dataType.simpleString() for f in out.schema[3:]] == [
        "timestamp",
        "timestamp_ntz",
        "timestamp",
    ]


def test_fixed_decimal(spark):
    df = spark.createDataFrame(
        [("1.005",), ("-1.005",), ("abc",), ("123456789.00",), ("99999999.99",), ("",), (None,)],
        "a string",
    )
    got = [r.d for r in conform(df, [FixedDecimal("d", "a")]).collect()]
    assert got == [Decimal("1.01"), Decimal("-1.01"), None, None, Decimal("99999999.99"), None, None]


def test_category(spark):
    df = spark.createDataFrame([(None,), ("",), (" x ",), ("paid",)], "s string")
    got = [r.c for r in conform(df, [Category("c", "s")]).collect()]
    assert got == ["UNKNOWN", "", " X ", "PAID"]


def test_run_time_is_one_literal(spark):
    df = spark.range(3)
    naive = conform(df, [], "2024-01-01 00:00:00")
    assert naive.schema["silver_processed_at"].dataType.simpleString() == "timestamp_ntz"
    aware = add_audit_columns(df, "shop", utc_now())
    assert aware.schema["ingested_at"].dataType.simpleString() == "timestamp"
    assert aware.select("ingested_at", "source_system").distinct().count() == 1
    same = df.select(timestamp_literal(datetime(2024, 1, 1, 12, 30)).alias("t")).first().t
    assert same == datetime(2024, 1, 1, 12, 30)


def test_maps_decide_ties_by_their_content(spark):
    """The winner is the same whatever the partitions, though maps have no order."""
    ids = spark.range(40)
    tied = ids.select(
        F.lit(1).alias("k"),
        F.lit(5).alias("t"),
        F.create_map(F.lit("a"), F.col("id")).alias("m"),
    )
    for how in ("aggregate", "window"):
        winners = {
            str(dedupe_latest(tied.repartition(n), ["k"], ["t"], how=how).first())
            for n in (1, 2, 3, 5, 9)
        }
        assert len(winners) == 1


@pytest.mark.parametrize("null_keys", ["collapse", "keep"])
def test_window_form_and_number_of_versions(spark, null_keys):
    data = [(k, i % 4, f"{i % 3}") for i, k in enumerate([1, 2, None, 1, 1, None, 2, 3, None])]
    df = spark.createDataFrame(data, "k int, t int, v string")
    got = {
        how: sorted(map(str, dedupe_latest(df, ["k"], ["t"], null_keys, how=how).collect()))
        for how in ("aggregate", "window")
    }
    assert got["aggregate"] == got["window"]
    for how in ("aggregate", "window"):
        counted = dedupe_latest(df, ["k"], ["t"], null_keys, how=how, n_versions="n")
        assert sorted(map(str, counted.drop("n").collect())) == got["window"]
        assert counted.agg(F.sum("n")).first()[0] == len(data)
    with pytest.raises(ValueError):
        dedupe_latest(df, ["k"], how="other")
