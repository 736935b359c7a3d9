"""Raw layer: source rows as they are, plus where and when they came from."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerflow.functions import timestamp_literal


def add_audit_columns(
    df: DataFrame, source_system: str, run_ts: str | datetime | Column
) -> DataFrame:
    """Append ``ingested_at`` and ``source_system``."""
    return df.withColumns(
        {"ingested_at": timestamp_literal(run_ts), "source_system": F.lit(source_system)}
    )
