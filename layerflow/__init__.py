"""Layered (bronze / silver / quarantine / gold) flows over keyed tables, on Spark."""

from layerflow.functions import Category, FixedDecimal, ParseTime, timestamp_literal, utc_now
from layerflow.operators import (
    Clauses,
    ExistsIn,
    Rule,
    SetRule,
    ShareAtMost,
    UniqueBy,
    add_audit_columns,
    classify,
    conform,
    dedupe_latest,
    differs,
    merge_upsert,
    newer,
    preview,
    quality_counters,
    quality_report,
    split_by_quality,
)
from layerflow.plans import (
    LayerRun,
    Replay,
    TableSpec,
    orders_spec,
    replay_quarantine,
    run_increment,
    run_layers,
)
from layerflow.sinks import (
    Upserted,
    append_rows,
    rebucket,
    stage_table,
    upsert_bucketed_table,
    upsert_table,
    write_snapshot,
)
from layerflow.sources import (
    Increment,
    JdbcSplit,
    JdbcTarget,
    Layers,
    read_jdbc,
    read_table,
    shared_folder,
    table_exists,
)

__all__ = [
    "Category",
    "Clauses",
    "ExistsIn",
    "FixedDecimal",
    "Increment",
    "JdbcSplit",
    "JdbcTarget",
    "LayerRun",
    "Layers",
    "ParseTime",
    "Replay",
    "Rule",
    "SetRule",
    "ShareAtMost",
    "TableSpec",
    "UniqueBy",
    "Upserted",
    "add_audit_columns",
    "append_rows",
    "classify",
    "conform",
    "dedupe_latest",
    "differs",
    "merge_upsert",
    "newer",
    "orders_spec",
    "preview",
    "quality_counters",
    "quality_report",
    "read_jdbc",
    "read_table",
    "rebucket",
    "replay_quarantine",
    "run_increment",
    "run_layers",
    "shared_folder",
    "split_by_quality",
    "stage_table",
    "table_exists",
    "timestamp_literal",
    "upsert_bucketed_table",
    "upsert_table",
    "utc_now",
    "write_snapshot",
]
