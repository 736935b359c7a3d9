"""The queries: each takes the session and a folder of test tables, and returns a frame."""

from __future__ import annotations

import uuid
from dataclasses import replace
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerflow import (
    Category,
    Clauses,
    ExistsIn,
    FixedDecimal,
    Increment,
    Layers,
    Rule,
    ShareAtMost,
    UniqueBy,
    add_audit_columns,
    append_rows,
    classify,
    conform,
    dedupe_latest,
    merge_upsert,
    newer,
    orders_spec,
    preview,
    quality_counters,
    quality_report,
    read_table,
    rebucket,
    replay_quarantine,
    run_increment,
    run_layers,
    shared_folder,
    split_by_quality,
    stage_table,
    upsert_bucketed_table,
    upsert_table,
    write_snapshot,
)
from layerflow.operators.profile import exact_quantiles, n_distinct, quantile, unite_profiles
from layerflow.plans.layers import classified_rows
from layerflow.plans.orders import LATEST_BY, QUARANTINE_PREVIEW, SOURCE_SYSTEM
from layerflow.streaming import run_arrivals
from workload.inputs import (
    AS_OF,
    RUN_TS,
    SECOND_RUN_TS,
    changed_orders,
    dated_target,
    dated_updates,
    later_orders,
    load,
    raw_orders,
    text_orders,
    upsert_target,
    upsert_updates,
)

QUERIES = {}
KEY = ["order_id"]


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def spec():
    return orders_spec(AS_OF)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written and read back, for sinks that look at their input more than once."""
    return df.sparkSession.read.schema(df.schema).parquet(stage_table(df, "layerflow-input"))


# --- bronze ---------------------------------------------------------------------------


@query
def bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_audit_columns(raw_orders(spark, sf_dir), SOURCE_SYSTEM, RUN_TS)


@query
def bronze_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replacing a path table: nothing of the first write is left."""
    path = shared_folder(spark, "layerflow-bronze")
    write_snapshot(raw_orders(spark, sf_dir), path)
    write_snapshot(bronze_orders(spark, sf_dir), path)
    return read_table(spark, path)


@query
def bronze_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Any five rows: certain are their number, their source, and that bronze holds them."""
    bronze = bronze_orders(spark, sf_dir)
    columns = ["customer_id", "amount", "created_at", "updated_at", "source_system"]
    rows = preview(bronze, 5, columns=columns)
    held = bronze.select(*columns).distinct().withColumn("held", F.lit(1))
    same = [rows[c].eqNullSafe(held[c]) for c in columns]
    found = rows.join(held, same, "left")
    return found.groupBy(rows["source_system"]).agg(
        F.count("*").alias("n_rows"), F.count("held").alias("n_in_bronze")
    )


@query
def managed_table_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = f"layerflow_{uuid.uuid4().hex}"
    folder = shared_folder(spark, "layerflow-database")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}'")
    table = f"{database}.bronze_orders"
    write_snapshot(raw_orders(spark, sf_dir), table=table)
    write_snapshot(bronze_orders(spark, sf_dir), table=table)
    return read_table(spark, table=table)


# --- silver and quarantine ------------------------------------------------------------


@query
def dedupe_latest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe_latest(raw_orders(spark, sf_dir), KEY, LATEST_BY)


@query
def dedupe_latest_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same winners by ranking, the form for keys that hardly repeat."""
    return dedupe_latest(raw_orders(spark, sf_dir), KEY, LATEST_BY, how="window")


@query
def dedupe_keep_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe_latest(raw_orders(spark, sf_dir), KEY, LATEST_BY, null_keys="keep")


@query
def dedupe_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last shipment of every part and supplier; ties by all other columns."""
    return dedupe_latest(
        load(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"], ["l_shipdate"]
    )


@query
def conform_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(raw_orders(spark, sf_dir), spec().conform, RUN_TS)


@query
def conform_text_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unreadable or oversized text becomes null; the job goes on."""
    typed = conform(text_orders(spark, sf_dir), spec().conform)
    return typed.withColumn("order_timestamp", F.col("order_timestamp").cast("timestamp_ntz"))


def classified_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classified_rows(raw_orders(spark, sf_dir), spec(), RUN_TS)


def split_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return split_by_quality(classified_orders(spark, sf_dir), spec().silver_columns, RUN_TS)


@query
def silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_orders(spark, sf_dir)[0]


@query
def quarantine_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_orders(spark, sf_dir)[1]


@query
def quarantine_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = quarantine_orders(spark, sf_dir)
    return preview(rejected, 5, [F.col("order_id").asc_nulls_first()], QUARANTINE_PREVIEW)


def quality_report_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(classified_orders(spark, sf_dir))


QUERIES["quality_report"] = quality_report_orders


@query
def quality_totals_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = quality_counters(spec().rules)
    clean = counts.pop("clean")
    return classified_orders(spark, sf_dir).agg(
        clean.alias("n_clean"), sum(counts.values(), F.lit(0)).alias("n_rejected")
    )


@query
def quarantine_append_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends double the rows; an empty one leaves the table as it is."""
    rejected = stored(quarantine_orders(spark, sf_dir))
    path = shared_folder(spark, "layerflow-quarantine")
    append_rows(rejected, path)
    append_rows(rejected, path)
    nothing = read_table(spark, path).filter("quarantine_reason = 'no such reason'")
    wrote = append_rows(nothing, path)
    return read_table(spark, path).withColumn("empty_append_wrote", F.lit(wrote))


@query
def quarantine_append_same_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that is done again replaces its own rows and no others, whatever its id looks like."""
    rejected = stored(quarantine_orders(spark, sf_dir))
    path = shared_folder(spark, "layerflow-quarantine")
    for run_id in ("01", "1", "a", "a/b", "2024-01-01", "12:30:00", "a/b", "01"):
        append_rows(rejected, path, run_id=run_id)
    return read_table(spark, path)


# --- the same operators on other tables -----------------------------------------------


def classified_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        Rule.not_null("event_id", "Missing event_id"),
        Rule("Internal user", F.col("user_id") % 50 != 0),
        Rule.at_least("value", 1, "Value below 1"),
        Rule.not_after("ts", "2024-01-25 00:00:00", "After cut-off"),
    ]
    return classify(load(spark, sf_dir, "events"), rules)


@query
def events_quality_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean, rejected = split_by_quality(
        classified_events(spark, sf_dir),
        ["event_id", "ts", "user_id", "event_type", "value"],
        "2024-02-01 00:00:00",
    )
    return clean.unionByName(rejected.drop("props"), allowMissingColumns=True)


@query
def events_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(classified_events(spark, sf_dir))


@query
def events_latest_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few keys with many rows each: combined before the exchange."""
    return dedupe_latest(load(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"])


@query
def documents_quality_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts through the same split; the result shows their lengths."""
    documents = conform(
        load(spark, sf_dir, "documents"),
        [Category("language", "lang"), FixedDecimal("size", "n_chars", 12, 0)],
    )
    rules = [
        Rule.not_null("text", "Missing text"),
        Rule.at_least("size", 200, "Too short"),
        Rule("Not in English", F.col("language") == "EN"),
    ]
    return classify(documents, rules).select(
        "doc_id", "language", "size", F.length("text").alias("n_text"), "quarantine_reason"
    )


@query
def customer_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(
        load(spark, sf_dir, "customer"),
        [Category("segment", "c_mktsegment"), FixedDecimal("balance", "c_acctbal", 12, 1)],
        RUN_TS,
        stamp="processed_at",
    )


# --- gold -----------------------------------------------------------------------------


@query
def gold_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "layerflow-gold")
    upsert_table(spark, path, stored(silver_orders(spark, sf_dir)), KEY, buckets=8)
    return read_table(spark, path)


@query
def gold_merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_upsert(upsert_target(spark, sf_dir), upsert_updates(spark, sf_dir), KEY)


@query
def gold_merge_unique_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The caller knows that neither side repeats a key."""
    return merge_upsert(
        upsert_target(spark, sf_dir), upsert_updates(spark, sf_dir), KEY, unique_updates=True
    )


@query
def gold_merge_some_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A match changes the amount alone; an insert brings all columns."""
    return merge_upsert(
        upsert_target(spark, sf_dir), upsert_updates(spark, sf_dir), KEY, ["total_amount"]
    )


@query
def gold_merge_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null key matches nothing: such rows stay on the one side, are inserted on the other."""
    no_key = F.when(F.col("order_id") % 7 != 0, F.col("order_id"))
    return merge_upsert(
        upsert_target(spark, sf_dir).withColumn("order_id", no_key),
        upsert_updates(spark, sf_dir).withColumn("order_id", no_key),
        KEY,
    )


@query
def gold_merge_many_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines of an order match its one update; orders without lines are inserted."""
    lines = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_linestatus", "l_shipdate"
    )
    updates = (
        load(spark, sf_dir, "orders")
        .filter(F.col("o_orderkey") % 3 == 0)
        .select(
            F.col("o_orderkey").alias("l_orderkey"),
            F.lower("o_orderstatus").alias("l_linestatus"),
            F.col("o_orderdate").alias("l_shipdate"),
        )
    )
    return merge_upsert(lines, updates, ["l_orderkey"], unique_target=False)


@query
def gold_merge_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    updates = upsert_updates(spark, sf_dir)
    once = merge_upsert(upsert_target(spark, sf_dir), updates, KEY)
    return merge_upsert(once, updates, KEY)


@query
def gold_table_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "layerflow-gold")
    upsert_table(spark, path, upsert_target(spark, sf_dir), KEY, buckets=8)
    upsert_table(spark, path, upsert_updates(spark, sf_dir), KEY)
    return read_table(spark, path)


@query
def gold_bucketed_table_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog form: the stored side of the join is not exchanged."""
    folder = shared_folder(spark, "layerflow-gold")
    table = f"gold_{uuid.uuid4().hex}"
    for rows in (upsert_target(spark, sf_dir), upsert_updates(spark, sf_dir)):
        upsert_bucketed_table(spark, table, folder, rows, KEY, buckets=8)
    return read_table(spark, table=table)


@query
def gold_merge_newer_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A match is updated only by a later version."""
    clauses = Clauses(update_if=newer("updated_at"))
    target, updates = dated_target(spark, sf_dir), dated_updates(spark, sf_dir)
    return merge_upsert(target, updates, KEY, clauses=clauses)


@query
def gold_merge_delete_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored rows without an update go, but for those still pending; some have no key."""
    no_key = F.when(F.col("order_id") % 7 != 0, F.col("order_id"))
    clauses = Clauses(orphans="delete", orphan_if=lambda old: old("order_status") != "P")
    target = upsert_target(spark, sf_dir).withColumn("order_id", no_key)
    return merge_upsert(target, upsert_updates(spark, sf_dir), KEY, clauses=clauses)


@query
def gold_table_mark_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table, merged twice: later versions only, and rows without an update marked."""
    path = shared_folder(spark, "layerflow-gold")
    clauses = Clauses(newer("updated_at"), {"is_current": F.lit(False)})
    updates = dated_updates(spark, sf_dir).withColumn("is_current", F.lit(True))
    target = dated_target(spark, sf_dir).withColumn("is_current", F.lit(True))
    upsert_table(spark, path, target, KEY, buckets=8)
    for _ in range(2):
        upsert_table(spark, path, updates, KEY, clauses=clauses)
    return read_table(spark, path)


@query
def gold_bucketed_delete_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same clauses on the catalog form, where only the updates are exchanged."""
    folder = shared_folder(spark, "layerflow-gold")
    table = f"gold_{uuid.uuid4().hex}"
    clauses = Clauses(newer("updated_at"), "delete")
    upsert_bucketed_table(spark, table, folder, dated_target(spark, sf_dir), KEY, buckets=8)
    updates = dated_updates(spark, sf_dir)
    upsert_bucketed_table(spark, table, folder, updates, KEY, clauses=clauses)
    return read_table(spark, table=table)


@query
def gold_three_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored gold whose source first adds a column and then widens the types of two."""
    path = shared_folder(spark, "layerflow-gold")
    key = F.col("o_orderkey")
    orders = load(spark, sf_dir, "orders")
    first = orders.filter(key % 10 < 7).select(
        key.alias("order_id"),
        (F.col("o_custkey") % 30_000).cast("int").alias("customer_id"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("total_amount"),
    )
    second = orders.filter(key % 10 == 6).select(
        key.alias("order_id"),
        F.col("o_custkey").cast("int").alias("customer_id"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("total_amount"),
        F.col("o_orderstatus").alias("status"),
    )
    third = orders.filter(key % 10 >= 8).select(
        key.alias("order_id"),
        (F.col("o_custkey") + 5_000_000_000).cast("bigint").alias("customer_id"),
        F.col("o_totalprice").cast("decimal(14,4)").alias("total_amount"),
    )
    upsert_table(spark, path, first, KEY, buckets=16)
    for rows in (second, third):
        upsert_table(spark, path, rows, KEY, evolve=True)
    return read_table(spark, path)


@query
def gold_preview_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(gold_bootstrap(spark, sf_dir), 10, ["order_timestamp", "order_id"])


@query
def gold_rebucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that outgrew its buckets, laid out anew, takes further merges."""
    old, new = (shared_folder(spark, "layerflow-gold") for _ in range(2))
    upsert_table(spark, old, upsert_target(spark, sf_dir), KEY, buckets=2)
    rebucket(spark, old, new, KEY, 12)
    upsert_table(spark, new, upsert_updates(spark, sf_dir), KEY)
    return read_table(spark, new)


# --- the whole flow -------------------------------------------------------------------


@query
def layers_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = Layers(shared_folder(spark, "layerflow-layers"))
    run_layers(spark, raw_orders(spark, sf_dir), spec(), layers, RUN_TS, buckets=8)
    return read_table(spark, layers.gold)


@query
def layers_second_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that were deleted or turned bad at the source keep their last good gold row."""
    layers = Layers(shared_folder(spark, "layerflow-layers"))
    run_layers(spark, raw_orders(spark, sf_dir), spec(), layers, RUN_TS, buckets=8)
    run_layers(spark, later_orders(spark, sf_dir), spec(), layers, SECOND_RUN_TS)
    return read_table(spark, layers.gold)


@query
def layers_second_run_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same gold as a catalog table, whose stored rows are not exchanged."""
    layers = Layers(shared_folder(spark, "layerflow-layers"))
    gold = f"gold_{uuid.uuid4().hex}"
    run_layers(
        spark, raw_orders(spark, sf_dir), spec(), layers, RUN_TS, buckets=8, gold_table=gold
    )
    run_layers(spark, later_orders(spark, sf_dir), spec(), layers, SECOND_RUN_TS, gold_table=gold)
    return read_table(spark, table=gold)


@query
def layers_row_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each bronze row of a run went."""
    layers = Layers(shared_folder(spark, "layerflow-layers"))
    run = run_layers(spark, raw_orders(spark, sf_dir), spec(), layers, RUN_TS, buckets=8)
    rows = [(run.n_read, run.n_clean, run.n_rejected, run.n_superseded, run.n_collapsed)]
    names = ["n_read", "n_clean", "n_rejected", "n_superseded", "n_collapsed"]
    return spark.createDataFrame(rows, ", ".join(f"{n} long" for n in names))


@query
def layers_second_run_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quarantine grows run by run."""
    layers = Layers(shared_folder(spark, "layerflow-layers"))
    run_layers(spark, raw_orders(spark, sf_dir), spec(), layers, RUN_TS, buckets=8)
    run_layers(spark, later_orders(spark, sf_dir), spec(), layers, SECOND_RUN_TS)
    return read_table(spark, layers.quarantine)


@query
def layers_changed_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold rows that the second run says nothing new of keep the first one's time."""
    layers = Layers(shared_folder(spark, "layerflow-layers"))
    options = {"changed_only": True, "buckets": 8}
    run_layers(spark, raw_orders(spark, sf_dir), spec(), layers, RUN_TS, **options)
    run_layers(spark, later_orders(spark, sf_dir), spec(), layers, SECOND_RUN_TS, **options)
    return read_table(spark, layers.gold)


@query
def layers_changed_only_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = Layers(shared_folder(spark, "layerflow-layers"))
    options = {"changed_only": True, "buckets": 8, "gold_table": f"gold_{uuid.uuid4().hex}"}
    run_layers(spark, raw_orders(spark, sf_dir), spec(), layers, RUN_TS, **options)
    run_layers(spark, later_orders(spark, sf_dir), spec(), layers, SECOND_RUN_TS, **options)
    return read_table(spark, table=options["gold_table"])


@query
def layers_incremental_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second run reads only keys that changed; its gold is that of a full run."""
    layers = Layers(shared_folder(spark, "layerflow-layers"))
    increment = Increment("updated_at", timedelta(days=1))
    options = {"changed_only": True, "buckets": 8}
    first, second = raw_orders(spark, sf_dir), changed_orders(spark, sf_dir)
    run_increment(spark, first, spec(), layers, RUN_TS, increment, run_id="1", **options)
    run_increment(spark, second, spec(), layers, SECOND_RUN_TS, increment, run_id="2", **options)
    return read_table(spark, layers.gold)


@query
def orders_relational_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules about other rows among rules about the row itself, the first failing one wins."""
    known = load(spark, sf_dir, "customer").filter(F.col("c_custkey") % 10 != 3)
    rules = [
        Rule.not_null("order_id", "Missing order_id"),
        ExistsIn("Unknown customer", ["customer_id"], known, ["c_custkey"]),
        Rule.at_least("total_amount", 0, "Negative or null total_amount"),
        UniqueBy("Same customer and time", ["customer_id", "order_timestamp"]),
        ShareAtMost("Too many finished", ["customer_id"], F.col("order_status") == "F", 60),
    ]
    latest = dedupe_latest(raw_orders(spark, sf_dir), KEY, LATEST_BY)
    rows = stored(conform(latest, spec().conform, RUN_TS))  # such rules read it twice
    return classify(rows, rules).select("order_id", "customer_id", "quarantine_reason")


@query
def quarantine_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected refunds go into gold once the amount rule is dropped, on the first replay alone."""
    layers = Layers(shared_folder(spark, "layerflow-layers"))
    run_layers(spark, raw_orders(spark, sf_dir), spec(), layers, RUN_TS, buckets=8, run_id="1")
    refunds = replace(spec(), rules=[r for r in spec().rules if "amount" not in r.reason])
    replay_quarantine(spark, refunds, layers, SECOND_RUN_TS, run_id="replay 1")
    replay_quarantine(spark, refunds, layers, "2001-01-04 00:00:00", run_id="replay 2")
    return read_table(spark, layers.gold)


@query
def dedupe_window_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranking form, which counts versions apart from the rank; null keys are one key."""
    latest = dedupe_latest(
        raw_orders(spark, sf_dir), KEY, LATEST_BY, how="window", n_versions="n_versions"
    )
    return latest.select("order_id", "amount", "n_versions")


@query
def layers_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs' profiles of silver united: exact counts, sketches held against the rows."""
    layers = Layers(shared_folder(spark, "layerflow-layers"))
    options = {"buckets": 8, "with_profile": True}
    run_layers(spark, raw_orders(spark, sf_dir), spec(), layers, RUN_TS, run_id="1", **options)
    rows = stored(read_table(spark, layers.silver))
    run_layers(
        spark, later_orders(spark, sf_dir), spec(), layers, SECOND_RUN_TS, run_id="2", **options
    )
    both = rows.unionByName(read_table(spark, layers.silver))
    names = ["order_id", "customer_id", "total_amount", "order_status"]
    exact = both.agg(*(F.countDistinct(c).alias(c) for c in names)).unpivot(
        [], names, "column_name", "n_exact"
    )
    ranks = exact_quantiles(both, "total_amount", [0.45, 0.55])
    amount = spark.createDataFrame(
        [("total_amount", *ranks)], "column_name string, low double, high double"
    )
    found = unite_profiles(read_table(spark, layers.profiles)).join(exact, "column_name")
    off = F.abs(n_distinct() - F.col("n_exact"))
    middle = quantile(0.5)
    return found.join(amount, "column_name", "left").select(
        "column_name",
        "n_rows",
        "n_null",
        "n_exact",
        (off <= 0.08 * F.col("n_exact")).alias("distinct_is_near"),
        middle.between(F.col("low"), F.col("high")).alias("median_is_near"),
        F.when(F.col("column_name") != "order_status", F.col("least")).alias("least"),
    )


@query
def layers_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that arrive in four files, dealt out by key and version, taken in one by one."""
    layers = Layers(shared_folder(spark, "layerflow-layers"))
    folder, rows = shared_folder(spark, "layerflow-arriving"), raw_orders(spark, sf_dir)
    for n in range(4):
        part = rows.filter(F.pmod(F.xxhash64("order_id", "updated_at"), F.lit(4)) == n)
        part.coalesce(1).write.mode("append").parquet(folder)
    run_arrivals(
        spark,
        folder,
        rows.schema,
        spec(),
        layers,
        RUN_TS,
        checkpoint=shared_folder(spark, "layerflow-checkpoint"),
        files_per_batch=2,
        buckets=8,
    )
    return read_table(spark, layers.gold)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean orders merged into an older gold of every third order, its first ten by time."""
    silver = stored(silver_orders(spark, sf_dir))  # the merge reads it twice
    older = conform(
        load(spark, sf_dir, "orders")
        .filter(F.col("o_orderkey") % 3 == 0)
        .select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("created_at"),
            F.col("o_totalprice").alias("amount"),
            F.col("o_orderstatus").alias("status"),
        ),
        spec().conform,
        "2000-12-31 00:00:00",
    ).select(*spec().silver_columns)
    gold = merge_upsert(older, silver, KEY, unique_updates=True)
    return preview(gold, 10, ["order_timestamp", "order_id"])


QUERIES["gold_flagship_topk"] = flagship
