"""Reading what has changed at a source since the last run, by a stored high-water mark."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerflow.functions import any_null, timestamp_literal
from layerflow.sources.tables import read_table, table_exists

MARK = "mark"


@dataclass(frozen=True)
class Increment:
    """Which column tells when a row changed, and how late a change may become visible.

    ``column`` is a time, a date or a number that grows. Rows may show up with a value up to
    ``look_back`` below one that was seen before: a ``timedelta``, or a number for numbers.
    """

    column: str
    look_back: timedelta | int = timedelta(0)


def read_mark(spark: SparkSession, path: str) -> datetime | date | int | None:
    """The greatest mark stored at ``path``; None before the first run."""
    if not table_exists(spark, path):
        return None
    return read_table(spark, path).agg(F.max(MARK)).first()[0]


def _literal(value: datetime | date | int) -> Column:
    return timestamp_literal(value) if isinstance(value, datetime) else F.lit(value)


def changed_since(
    source: DataFrame, keys: Sequence[str], increment: Increment, mark: datetime | date | int | None
) -> DataFrame:
    """All rows of the keys that have a row changed since ``mark`` less the look-back.

    Such a key is read again with every row it has, so that the latest one is found among all of
    them, as in a full run. The condition is on the bare column, which the source can push down
    to its files or its database. Rows without a value in the column cannot be told apart from
    changed ones and are read each time; so are null keys' rows, by their own value. Without a
    mark all rows are read.
    """
    if mark is None:
        return source
    at = F.col(increment.column)
    if isinstance(mark, (datetime, date)):
        since = mark - increment.look_back if increment.look_back else mark
    else:
        since = mark - (increment.look_back or 0)
    recent = source.filter(at.isNull() | (at >= _literal(since)))
    changed = recent.filter(~any_null(keys)).select(*keys).distinct()
    whole = source.join(changed, list(keys), "left_semi")
    return whole.unionByName(recent.filter(any_null(keys)))


def mark_of(rows: DataFrame, increment: Increment) -> DataFrame:
    """The greatest value of the increment's column, one row; none if there is no value."""
    return rows.agg(F.max(increment.column).alias(MARK)).filter(F.col(MARK).isNotNull())
