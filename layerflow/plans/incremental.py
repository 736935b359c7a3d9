"""The layered flow over what has changed since the last run."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession

from layerflow.plans.layers import LayerRun, TableSpec, run_layers
from layerflow.sinks import append_rows
from layerflow.sources import Increment, Layers, changed_since, read_mark, read_table
from layerflow.sources.increment import mark_of


def run_increment(
    spark: SparkSession,
    source: DataFrame,
    spec: TableSpec,
    layers: Layers,
    run_ts: str | datetime | Column,
    increment: Increment,
    *,
    run_id: str,
    **options,
) -> LayerRun:
    """``run_layers`` over the keys that have changed at the source since the last run.

    Bronze and silver then hold this run's rows only, and gold is what a full run makes of it, as
    long as each change, but for deletions, moves ``increment.column``, by no more than the look-back
    late. Rows that vanish from the source are not seen: ``clauses`` that act on orphans are refused.

    The high-water mark is stored last, with the run's id. A run that ends before it is simply done
    again: the merge gives the same, and the quarantine replaces what the same run id has left.
    The first run reads everything. ``options`` are those of ``run_layers``.
    """
    clauses = options.get("clauses")
    if clauses is not None and clauses.touches_orphans:
        raise ValueError("an increment cannot tell which rows the source has lost")
    mark = read_mark(spark, layers.marks)
    rows = changed_since(source, spec.keys, increment, mark)
    run = run_layers(spark, rows, spec, layers, run_ts, run_id=run_id, **options)
    bronze = read_table(spark, layers.bronze, fmt=options.get("fmt", "parquet"))
    append_rows(mark_of(bronze, increment), layers.marks, run_id=run_id)
    return run
