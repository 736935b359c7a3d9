"""Conforming expressions: raw column -> typed column.

Each maps bad input to null rather than failing the job, so that the data-quality
rules can send the row to quarantine.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class ParseTime:
    """Text to ``timestamp`` by ``pattern``; a time or date typed input keeps its value."""

    target: str
    source: str
    pattern: str = "yyyy-MM-dd HH:mm:ss"

    def column(self, df: DataFrame) -> Column:
        source = F.col(self.source)
        kind = df.select(source).schema[0].dataType
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            return source
        if isinstance(kind, T.DateType):
            return source.cast("timestamp")
        return F.try_to_timestamp(source, F.lit(self.pattern))


@dataclass(frozen=True)
class FixedDecimal:
    """Number or text to ``decimal(precision, scale)``, half up; overflow gives null."""

    target: str
    source: str
    precision: int = 10
    scale: int = 2

    def column(self, df: DataFrame) -> Column:
        return F.col(self.source).try_cast(T.DecimalType(self.precision, self.scale))


@dataclass(frozen=True)
class Category:
    """Upper-cased label, ``default`` for null; blanks are neither trimmed nor replaced."""

    target: str
    source: str
    default: str = "UNKNOWN"

    def column(self, df: DataFrame) -> Column:
        return F.coalesce(F.upper(F.col(self.source)), F.lit(self.default))
