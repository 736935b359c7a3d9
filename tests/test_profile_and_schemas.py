"""Profiles that unite, schemas that grow, and the counted ranking form of the dedupe."""

import re
from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from layerflow import Layers, dedupe_latest, orders_spec, read_table, run_layers
from layerflow import rebucket, upsert_bucketed_table, upsert_table
from layerflow.operators.profile import exact_quantiles, n_distinct, profile, quantile, unite_profiles
from layerflow.sources.tables import SCHEMA_FILE, entry_names
from test_layers import AS_OF, SCHEMA, SEED
from test_merge import rows


# Profiles.


def test_counts_are_exact_and_sketches_near(spark):
    df = spark.range(50_000).select(
        F.col("id"),
        F.when(F.col("id") % 5 != 0, F.col("id") % 700).cast("int").alias("few"),
        (F.col("id") / 7).cast("decimal(12,3)").alias("money"),
        F.concat(F.lit("w"), F.col("id") % 9000).alias("word"),
        F.lit(None).cast("string").alias("none"),
    )
    got = {r.column_name: r for r in profile(df).select("*", n_distinct().alias("d"), quantile(0.25).alias("q")).collect()}
    assert [got[c].n_rows for c in df.columns] == [50_000] * 5
    assert [got[c].n_null for c in df.columns] == [0, 10_000, 0, 0, 50_000]
    for column, exact in (("id", 50_000), ("few", 560), ("money", 50_000), ("word", 9000)):
        assert abs(got[column].d - exact) <= 0.05 * exact
    assert abs(got["id"].q - 12_500) < 0.02 * 50_000 and abs(got["money"].q - 12_500 / 7) < 150
    assert got["word"].q is None and got["none"].d == 0
    assert (got["id"].least, got["id"].greatest) == ("0", "49999")
    assert (got["few"].least, got["few"].greatest) == ("1", "699")
    assert got["none"].least is None


def test_united_profiles_are_those_of_all_rows(spark):
    parts = [spark.range(a, b).select("id", F.col("id").cast("string").alias("s")) for a, b in ((5, 900), (700, 12_000))]
    parts.append(parts[0].limit(0))
    profiles = None
    for part in parts:
        one = profile(part)
        profiles = one if profiles is None else profiles.union(one)
    united = unite_profiles(profiles).select("*", n_distinct().alias("d"), quantile(0.5).alias("q"))
    got = {r.column_name: r for r in united.collect()}
    assert got["id"].n_rows == 895 + 11_300 and (got["id"].least, got["id"].greatest) == ("5", "11999")
    assert abs(got["id"].d - 11_995) < 600 and abs(got["s"].d - 11_995) < 600
    assert abs(got["id"].q - 5902) < 500 and got["s"].q is None
    assert (got["s"].least, got["s"].greatest) == ("10", "9999")


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_exact_quantiles_are_those_of_percentile(spark, n):
    number = F.when(F.col("id") % 7 != 0, F.pmod(F.xxhash64("id"), F.lit(400)) / 8)
    df = spark.range(n).select(number.cast("decimal(12,3)").alias("the value"))
    fractions = [0.0, 0.45, 0.5, 0.55, 0.999, 1.0]
    expected = df.agg(*(F.percentile("`the value`", F.lit(f)) for f in fractions)).first()
    assert exact_quantiles(df, "the value", fractions) == list(expected)


def test_exact_quantiles_are_found_in_ranges(spark, monkeypatch):
    """No task gets all values, and what was written for it is removed."""
    from layerflow.operators import profile as module

    df = spark.range(0, 20_000, 1, 4).select((F.col("id") * 7919 % 20_011).alias("v"))
    seen = []

    def look(spark, path):
        seen.extend(r.n for r in spark.read.parquet(path).groupBy("part").agg(F.count("*").alias("n")).collect())
        real(spark, path)

    real = module.discard
    monkeypatch.setattr(module, "discard", look)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = exact_quantiles(df, "v", [0.25, 0.5])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == list(df.agg(F.percentile("v", F.lit(0.25)), F.percentile("v", F.lit(0.5))).first())
    assert sum(seen) == 20_000 and max(seen) < 10_000


def test_times(spark):
    at = datetime(2026, 7, 1, 12)
    df = spark.createDataFrame(
        [(at, date(2026, 7, 1), at)] * 3, "ntz timestamp_ntz, day date, moment timestamp"
    )
    got = {r.column_name: r.q for r in profile(df).select("column_name", quantile(0.5).alias("q")).collect()}
    noon = at.replace(tzinfo=timezone.utc).timestamp()
    assert got == {"ntz": noon, "day": noon - 12 * 3600, "moment": noon}


def test_profiles_of_runs(spark, tmp_path):
    layers = Layers(str(tmp_path))
    source = spark.createDataFrame(SEED, SCHEMA)
    for run_id in ("1", "2", "2"):  # the second run was done again
        run_layers(
            spark,
            source,
            orders_spec(AS_OF),
            layers,
            "2026-07-03 00:00:00",
            run_id=run_id,
            buckets=2,
            with_profile=True,
        )
    stored = read_table(spark, layers.profiles)
    assert stored.count() == 2 * 6
    got = unite_profiles(stored).filter("column_name = 'total_amount'").first()
    assert (got.n_rows, got.n_null, got.least, got.greatest) == (6, 0, "12.99", "250.50")


# Schemas.


def test_three_versions_leave_other_buckets_alone(spark, tmp_path):
    path = f"{tmp_path}/gold"
    first = spark.range(400).select("id", F.col("id").cast("int").alias("n"), F.lit(Decimal("1.50")).cast("decimal(6,2)").alias("m"))
    upsert_table(spark, path, first, ["id"], buckets=16)
    assert SCHEMA_FILE not in entry_names(spark, path)
    before = spark.read.parquet(path).select(F.input_file_name()).distinct().count()
    new = spark.createDataFrame([(7, 5_000_000_000, Decimal("2.125"), "x")], "id long, n long, m decimal(9,4), note string")
    with pytest.raises(ValueError):
        upsert_table(spark, path, new, ["id"])  # not asked to evolve
    done = upsert_table(spark, path, new, ["id"], evolve=True)
    assert len(done.buckets) == 1
    got = read_table(spark, path)
    assert got.dtypes == [("id", "bigint"), ("n", "bigint"), ("m", "decimal(9,4)"), ("note", "string")]
    expected = [(i, i, Decimal("1.5000"), None) for i in range(400) if i != 7]
    assert rows(got) == sorted([*expected, (7, 5_000_000_000, Decimal("2.1250"), "x")], key=repr)
    assert spark.read.schema(got.schema).parquet(path).select(F.input_file_name()).distinct().count() == before
    # the narrower, older form of a row is taken in by the wider table, with and without evolve
    for options in ({}, {"evolve": True}):
        upsert_table(spark, path, first.limit(3), ["id"], **options)
        assert read_table(spark, path).dtypes == got.dtypes
    flag = first.limit(2).withColumn("flag", F.lit(True))
    upsert_table(spark, path, flag, ["id"], evolve=True)
    assert read_table(spark, path).filter("flag").count() == 2
    rebucket(spark, path, f"{tmp_path}/new", ["id"], 4)
    assert rows(read_table(spark, f"{tmp_path}/new")) == rows(read_table(spark, path))


def test_digest_and_evolution(spark, tmp_path):
    path = f"{tmp_path}/gold"
    first = spark.createDataFrame([(1, 10), (2, 20)], "id long, n int")
    upsert_table(spark, path, first, ["id"], buckets=2, compare_cols=["n"])
    wide = spark.createDataFrame([(1, 10, None), (2, 20, "x")], "id long, n int, note string")
    done = upsert_table(spark, path, wide, ["id"], compare_cols=["n", "note"], evolve=True)
    assert len(done.buckets) == 1  # a null in the new column is no change
    assert not upsert_table(spark, path, wide, ["id"], compare_cols=["n"]).wrote
    assert rows(read_table(spark, path)) == [(1, 10, None), (2, 20, "x")]


@pytest.mark.parametrize("change", ["id int", "n string", "n decimal(5,1)"])
def test_changes_that_are_refused(spark, tmp_path, change):
    path = f"{tmp_path}/gold"
    first = spark.createDataFrame([(1, Decimal("1.25"))], "id long, n decimal(6,2)")
    upsert_table(spark, path, first, ["id"], buckets=2)
    name, kind = change.split(" ", 1)
    given = first.withColumn(name, F.col(name).cast(kind))
    if change == "n decimal(5,1)":  # narrower: nothing to widen
        upsert_table(spark, path, given, ["id"], evolve=True)
        assert read_table(spark, path).dtypes == first.dtypes
        return
    if change == "id int":
        upsert_table(spark, path, given, ["id"], evolve=True)  # a narrower key is read as the wider
        assert read_table(spark, path).count() == 1
        return
    with pytest.raises(ValueError):
        upsert_table(spark, path, given, ["id"], evolve=True)


def test_catalog_form_takes_columns_not_types(spark, tmp_path):
    table, folder = "evolving", f"{tmp_path}/gold"
    first = spark.createDataFrame([(1, 10), (2, 20)], "id long, n int")
    upsert_bucketed_table(spark, table, folder, first, ["id"], buckets=2)
    wide = spark.createDataFrame([(2, 21, "x"), (3, 30, "y")], "id long, n int, note string")
    upsert_bucketed_table(spark, table, folder, wide, ["id"], evolve=True)
    assert rows(spark.table(table)) == [(1, 10, None), (2, 21, "x"), (3, 30, "y")]
    long = wide.withColumn("n", F.col("n").cast("long"))
    with pytest.raises(ValueError):
        upsert_bucketed_table(spark, table, folder, long, ["id"], evolve=True)
    spark.sql(f"DROP TABLE {table}")


def test_many_null_keys_make_no_hot_bucket(spark, tmp_path):
    """Rows without a key are written by the tasks that hold them, and read apart from the join."""
    table, folder = "half_keyless", f"{tmp_path}/gold"
    some = spark.range(0, 40_000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("k"), F.col("id").alias("v")
    )
    upsert_bucketed_table(spark, table, folder, some, ["k"], buckets=4)
    upsert_bucketed_table(spark, table, folder, some.filter("k < 100"), ["k"])
    found = spark.table(table).filter("k IS NULL").select(F.input_file_name().alias("f"), "v")
    sizes = [r["count"] for r in found.groupBy("f").count().collect()]
    assert sum(sizes) == 20_000 and len(sizes) > 1 and max(sizes) < 20_000
    from layerflow.sinks.upsert import merge_bucketed

    merged = merge_bucketed(spark.table(table), some.limit(5), ["k"], None, 4)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"FileScan parquet.*", plan)
    stored = [s for s in scans if "half_keyless" in s]
    assert any("Bucketed: true" in s and "IsNotNull(k)" in s for s in stored)
    assert any("Bucketed: false" in s and "IsNull(k)" in s for s in stored)
    spark.sql(f"DROP TABLE {table}")


# The counted ranking form.


def test_counted_window_form(spark):
    data = [(i % 7 if i % 11 else None, i % 3, i) for i in range(300)]
    df = spark.createDataFrame(data, "k int, a int, b int")
    for keys in (["k"], ["k", "a"]):
        one, other = (
            dedupe_latest(df, keys, ["b"], how=how, n_versions="n") for how in ("aggregate", "window")
        )
        assert rows(one) == rows(other) and one.columns == other.columns
    kept = dedupe_latest(df, ["k"], ["b"], "keep", how="window", n_versions="n")
    assert rows(kept) == rows(dedupe_latest(df, ["k"], ["b"], "keep", n_versions="n"))


def test_a_hot_key_leaves_each_map_task_as_one_row(spark):
    df = spark.range(0, 100_000, 1, 8).select((F.col("id") % 1).alias("k"), "id")
    got = dedupe_latest(df, ["k"], ["id"], how="window", n_versions="n")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "partial_count" in plan
    assert rows(got) == [(0, 99_999, 100_000)]
