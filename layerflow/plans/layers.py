"""Source -> bronze -> silver and quarantine -> gold, in one session."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime
from typing import Literal

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from layerflow.functions import Category, FixedDecimal, ParseTime, any_null
from layerflow.operators import (
    Clauses,
    Rule,
    SetRule,
    add_audit_columns,
    classify,
    conform,
    dedupe_latest,
    quality_counters,
    split_by_quality,
)
from layerflow.operators.merge import PLAIN
from layerflow.operators.profile import profile_counters, profile_rows
from layerflow.operators.quality import CLEAN, REASON, needs_other_rows
from layerflow.sinks import (
    Upserted,
    append_rows,
    stage_table,
    upsert_bucketed_table,
    upsert_table,
    write_snapshot,
)
from layerflow.sinks.upsert import check_mergeable
from layerflow.sources import Layers, read_table, table_exists
from layerflow.sources.tables import discard, shared_folder

STAMP = "silver_processed_at"  # what conform calls the run's time
_VERSIONS = "_n_versions"


@dataclass(frozen=True)
class TableSpec:
    """What the flow has to know about one keyed table."""

    keys: Sequence[str]
    latest_by: Sequence[str]
    conform: Sequence[ParseTime | FixedDecimal | Category]
    rules: Sequence[Rule | SetRule]
    silver_columns: Sequence[str]
    source_system: str
    null_keys: Literal["collapse", "keep"] = "collapse"
    dedupe_by: Literal["aggregate", "window"] = "aggregate"

    @property
    def compared_columns(self) -> list[str]:
        """Silver columns that say something of the row itself, not of the run or its key."""
        return [c for c in self.silver_columns if c not in self.keys and c != STAMP]


@dataclass
class LayerRun:
    """Rows per outcome (``clean`` and each reason), what dedupe left out, and seconds per step.

    ``gold`` tells what the merge has replaced.

    ``n_read`` bronze rows are ``n_clean``, ``n_rejected``, ``n_superseded`` older versions, and
    ``n_collapsed`` rows with a null key that others of that key stand for.
    """

    counts: dict[str, int] = field(default_factory=dict)
    n_read: int = 0
    n_superseded: int = 0
    n_collapsed: int = 0
    gold: Upserted = Upserted()
    seconds: dict[str, float] = field(default_factory=dict)

    @property
    def n_clean(self) -> int:
        return self.counts[CLEAN]

    @property
    def n_rejected(self) -> int:
        return sum(self.counts.values()) - self.n_clean


def latest_rows(
    bronze: DataFrame,
    spec: TableSpec,
    run_ts: str | datetime | Column,
    n_versions: str | None = None,
) -> DataFrame:
    """Bronze rows deduplicated and conformed."""
    latest = dedupe_latest(
        bronze,
        spec.keys,
        spec.latest_by,
        spec.null_keys,
        how=spec.dedupe_by,
        n_versions=n_versions,
    )
    return conform(latest, spec.conform, run_ts, STAMP)


def classified_rows(
    bronze: DataFrame,
    spec: TableSpec,
    run_ts: str | datetime | Column,
    n_versions: str | None = None,
) -> DataFrame:
    """Bronze rows deduplicated, conformed and classified: silver and quarantine in one frame."""
    return classify(latest_rows(bronze, spec, run_ts, n_versions), spec.rules)


def ingest(
    source: DataFrame,
    spec: TableSpec,
    layers: Layers,
    run_ts: str | datetime | Column,
    fmt: str = "parquet",
) -> None:
    """Replace bronze by the source snapshot."""
    write_snapshot(add_audit_columns(source, spec.source_system, run_ts), layers.bronze, fmt=fmt)


def clean(
    spark: SparkSession,
    spec: TableSpec,
    layers: Layers,
    run_ts: str | datetime | Column,
    fmt: str = "parquet",
    run_id: str | None = None,
    with_profile: bool = False,
) -> LayerRun:
    """Replace silver by bronze's clean rows, append the others to quarantine, count all.

    The costly part, reading bronze and its exchange on the key, runs once: its result is
    written to the shared folder, split by outcome, so that each sink reads its own part
    and columns. The counts are observed on that write, past the exchange, so that a task that
    runs again does not count twice; each row brings the number of bronze rows it stands for.
    """
    bronze = read_table(spark, layers.bronze, fmt=fmt)
    versions = F.col(_VERSIONS)
    latest, conformed = latest_rows(bronze, spec, run_ts, _VERSIONS), None
    if needs_other_rows(spec.rules):
        # such rules read the rows more than once
        conformed = stage_table(latest, "layerflow-conformed")
        latest = spark.read.schema(latest.schema).parquet(conformed)
    classified = classify(latest, spec.rules)
    is_clean, no_key = F.col(REASON).isNull(), any_null(spec.keys)
    seen = Observation()
    outcomes = quality_counters(spec.rules)
    # the aggregates go by number: a reason may be any text
    counters = [
        F.count("*"),
        F.coalesce(F.sum(versions), F.lit(0)),
        F.coalesce(F.sum(F.when(no_key, versions)), F.lit(0)),
        F.count_if(no_key),
        *outcomes.values(),
    ]
    observed = {f"n{i}": c for i, c in enumerate(counters)}
    profiled = list(spec.silver_columns) if with_profile else []
    observed |= profile_counters(classified, profiled, is_clean)
    needed = classified.observe(seen, *(c.alias(name) for name, c in observed.items())).select(
        is_clean.alias("_is_clean"),
        # clean rows go on with silver's columns only: nulls cost next to nothing to store
        *(
            F.col(c) if c in spec.silver_columns else F.when(~is_clean, F.col(c)).alias(c)
            for c in classified.columns
            if c != _VERSIONS
        ),
    )
    staged = shared_folder(spark, "layerflow-classified")
    try:
        needed.write.partitionBy("_is_clean").parquet(staged)
        numbers = [seen.get[f"n{i}"] for i in range(len(counters))]
        total, read, read_no_key, kept_no_key = numbers[:4]
        run = LayerRun(dict(zip(outcomes, numbers[4:], strict=True)), n_read=read)
        run.n_collapsed = read_no_key - kept_no_key
        run.n_superseded = read - total - run.n_collapsed
        rows = spark.read.schema(needed.schema).parquet(staged)
        silver, _ = split_by_quality(rows.filter("_is_clean"), spec.silver_columns, run_ts)
        _, rejected = split_by_quality(
            rows.filter("NOT _is_clean").drop("_is_clean"), spec.silver_columns, run_ts
        )
        write_snapshot(silver, layers.silver, fmt=fmt)
        n_rejected = total - run.n_clean
        append_rows(rejected, layers.quarantine, fmt=fmt, n_rows=n_rejected, run_id=run_id)
        if profiled:
            found = profile_rows(spark, profiled, seen.get)
            append_rows(found, layers.profiles, n_rows=len(profiled), run_id=run_id)
    finally:
        discard(spark, staged)
        if conformed is not None:
            discard(spark, conformed)
    return run


def publish(
    spark: SparkSession,
    spec: TableSpec,
    layers: Layers,
    fmt: str = "parquet",
    buckets: int | None = None,
    files_per_bucket: int = 1,
    gold_table: str | None = None,
    changed_only: bool = False,
    clauses: Clauses = PLAIN,
) -> Upserted:
    """Merge silver into gold by key; the first run creates gold and needs ``buckets``."""
    silver = read_table(spark, layers.silver, fmt=fmt)
    compare_cols = spec.compared_columns if changed_only else None
    return merge_into_gold(
        spark, silver, spec, layers, fmt, buckets, files_per_bucket, gold_table, compare_cols, clauses
    )


def merge_into_gold(
    spark: SparkSession,
    rows: DataFrame,
    spec: TableSpec,
    layers: Layers,
    fmt: str,
    buckets: int | None,
    files_per_bucket: int,
    gold_table: str | None,
    compare_cols: Sequence[str] | None,
    clauses: Clauses,
) -> Upserted:
    if gold_table is not None:
        is_first = not table_exists(spark, table=gold_table)
        left = upsert_bucketed_table(
            spark,
            gold_table,
            layers.gold,
            rows,
            spec.keys,
            fmt=fmt,
            buckets=buckets,
            compare_cols=compare_cols,
            clauses=clauses,
        )
        if left is not None:
            discard(spark, left)
        return Upserted(wrote=is_first or left is not None)
    return upsert_table(
        spark,
        layers.gold,
        rows,
        spec.keys,
        fmt=fmt,
        buckets=buckets,
        files_per_bucket=files_per_bucket,
        compare_cols=compare_cols,
        clauses=clauses,
    )


def run_layers(
    spark: SparkSession,
    source: DataFrame,
    spec: TableSpec,
    layers: Layers,
    run_ts: str | datetime | Column,
    *,
    fmt: str = "parquet",
    run_id: str | None = None,
    buckets: int | None = None,
    files_per_bucket: int = 1,
    gold_table: str | None = None,
    changed_only: bool = False,
    clauses: Clauses = PLAIN,
    with_profile: bool = False,
) -> LayerRun:
    """One run of the whole flow; the first step that fails ends it.

    ``run_ts`` is the one time that all layers of the run carry. Every step reads its
    input from storage, so a run can be taken up again at any step. With ``gold_table`` gold is
    that catalog table, bucketed by its key, in folders under the gold path: the merge then
    exchanges silver alone, and the folder of the run before is removed after the switch.
    The first run into a gold needs ``buckets``.

    With ``changed_only`` gold rows that silver says nothing new of stay as they are, with the
    time of the run that brought them; a run without changes writes no gold. ``clauses`` make
    updates conditional, or delete or mark gold rows that silver lacks. ``with_profile`` keeps counts
    and sketches of silver's columns for each run.
    """
    check_mergeable(fmt)
    seconds = {}

    def timed(name, step, *args, **options):
        start = time.monotonic()
        result = step(*args, **options)
        seconds[name] = time.monotonic() - start
        return result

    timed("bronze", ingest, source, spec, layers, run_ts, fmt)
    run = timed("silver", clean, spark, spec, layers, run_ts, fmt, run_id, with_profile)
    options = (fmt, buckets, files_per_bucket, gold_table, changed_only, clauses)
    run.gold = timed("gold", publish, spark, spec, layers, *options)
    run.seconds = seconds
    return run
