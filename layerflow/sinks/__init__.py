"""Writers: snapshots, appends, run-local tables, keyed upserts."""

from layerflow.sinks.upsert import Upserted, rebucket, upsert_bucketed_table, upsert_table
from layerflow.sinks.writes import append_rows, stage_table, write_snapshot

__all__ = [
    "Upserted",
    "append_rows",
    "rebucket",
    "stage_table",
    "upsert_bucketed_table",
    "upsert_table",
    "write_snapshot",
]
