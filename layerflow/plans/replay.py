"""Rejected rows that pass the rules of today go back into the flow, once."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerflow.functions import any_null
from layerflow.operators import Clauses, classify, conform, dedupe_latest
from layerflow.operators.quality import REASON
from layerflow.plans.layers import STAMP, TableSpec, merge_into_gold
from layerflow.sinks import Upserted, append_rows, stage_table
from layerflow.sources import Layers, read_table, table_exists
from layerflow.sources.tables import RUN_COLUMN, discard

REJECTED_AT = "quarantined_at"
_ROW = "_row"


@dataclass
class Replay:
    """How many keys went into gold, and what the merge has replaced."""

    n_replayed: int = 0
    gold: Upserted = Upserted(wrote=False)


def replayable(
    quarantine: DataFrame,
    gold: DataFrame,
    spec: TableSpec,
    run_ts: str | datetime | Column,
    done: DataFrame | None = None,
) -> DataFrame:
    """Rows of the quarantine that the rules of ``spec`` let pass now, one per key.

    Of a key's rows, the one rejected last is the candidate, and of equal times the latest by the
    spec's order. It stays behind if it has gone back before (``done`` holds its hash), if it fails
    the rules still, if its key has a null part, or if gold has a row of that key that a later run
    than the rejecting one brought. The columns are silver's, the row's hash and when it was rejected.
    """
    added = {REASON, STAMP, RUN_COLUMN, *(step.target for step in spec.conform)}
    source = [c for c in quarantine.columns if c not in added and c != REJECTED_AT]
    rows = quarantine.filter(~any_null(spec.keys)).select(*source, REJECTED_AT)
    order = [REJECTED_AT, *(c for c in spec.latest_by if c in source)]
    last = dedupe_latest(rows, spec.keys, order)
    values = [part for c in sorted(source) for part in (F.col(c).isNull(), F.col(c))]
    last = last.withColumn(_ROW, F.xxhash64(*values, F.col(REJECTED_AT)))
    if done is not None:
        last = last.join(done.select(*spec.keys, _ROW), [*spec.keys, _ROW], "left_anti")
    passing = classify(conform(last, spec.conform, run_ts, STAMP), spec.rules)
    passing = passing.filter(F.col(REASON).isNull())
    newer = gold.select(*spec.keys, F.col(STAMP).alias("_since"))
    joined = passing.join(newer, list(spec.keys), "left")
    current = joined.filter(F.col("_since").isNull() | (F.col("_since") <= F.col(REJECTED_AT)))
    return current.select(*spec.silver_columns, _ROW, REJECTED_AT)


def replay_quarantine(
    spark: SparkSession,
    spec: TableSpec,
    layers: Layers,
    run_ts: str | datetime | Column,
    *,
    run_id: str,
    fmt: str = "parquet",
    files_per_bucket: int = 1,
    gold_table: str | None = None,
) -> Replay:
    """Merge into gold what ``replayable`` finds, and note each row so that it goes back only once.

    The quarantine stays as it is. Rows that go back are listed at ``layers.replayed`` under
    ``run_id``: a later replay leaves them out, and the same run done again, after it was cut off at
    any point, ends in the same gold. Nothing is written where nothing passes.
    """
    if not table_exists(spark, layers.quarantine):
        return Replay()
    quarantine = read_table(spark, layers.quarantine, fmt=fmt)
    done = None
    if table_exists(spark, layers.replayed):
        done = read_table(spark, layers.replayed).filter(F.col(RUN_COLUMN) != run_id)
    if gold_table is not None:
        gold = read_table(spark, table=gold_table)
    else:
        gold = read_table(spark, layers.gold, fmt=fmt)
    found = replayable(quarantine, gold, spec, run_ts, done)
    staged = stage_table(found, "layerflow-replay")
    try:
        rows = spark.read.schema(found.schema).parquet(staged)
        n = rows.count()
        run = Replay(n)
        if n:
            run.gold = merge_into_gold(
                spark,
                rows.drop(_ROW, REJECTED_AT),
                spec,
                layers,
                fmt,
                None,
                files_per_bucket,
                gold_table,
                None,
                Clauses(),
            )
            listed = rows.select(*spec.keys, _ROW)
            append_rows(listed, layers.replayed, n_rows=n, run_id=run_id)
    finally:
        discard(spark, staged)
    return run
