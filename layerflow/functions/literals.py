"""Run times and cut-offs as literals.

``current_timestamp()`` is fixed per query, not per run, so two writes of the same
frame store different values and a row near "now" may pass in one and fail in the
other. Every operator here takes its time as a parameter instead.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def utc_now() -> datetime:
    """The moment to pass as run time when the caller has none; take it once per run."""
    return datetime.now(timezone.utc)


def timestamp_literal(value: str | datetime | Column) -> Column:
    """A timestamp column for ``value``.

    A zone-aware datetime is an instant and becomes ``timestamp``. A naive datetime or
    an ISO string is wall-clock time and becomes ``timestamp_ntz``, which compares with
    either timestamp type without a cast on the data column's side.
    """
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime):
        if value.tzinfo is not None:
            return F.lit(value)
        value = value.isoformat(sep=" ")
    return F.lit(value).cast("timestamp_ntz")
