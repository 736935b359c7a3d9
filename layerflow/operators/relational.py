"""Rules about a row that other rows decide: references, uniqueness, shares of a group."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerflow.functions import any_null


class SetRule:
    """A rule whose verdict needs other rows; takes a place among row rules in ``classify``.

    ``judged`` adds the verdict as a column. Each kind first finds the keys that decide, one row
    per key by aggregates that combine before their exchange, and then joins the rows with these.
    As that side has one row per key, adaptive execution can split a hot key of the rows, and Spark
    broadcasts the keys where they are few. The rows are read twice, but for references.
    """

    reason: str

    def judged(self, df: DataFrame, flag: str) -> DataFrame:
        raise NotImplementedError


def _left_join_on(df: DataFrame, found: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` left joined with ``found`` on equal ``columns``, a null being equal to a null."""
    renamed = found.select(
        *(F.col(c).alias(f"_found_{c}") for c in columns),
        *(F.col(c) for c in found.columns if c not in columns),
    )
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_found_{c}")) for c in columns))
    return df.join(renamed, same, "left").drop(*(f"_found_{c}" for c in columns))


@dataclass(frozen=True)
class ExistsIn(SetRule):
    """The row's ``columns`` are those of some row of ``reference``.

    A key with a null part refers to nothing and passes: add ``Rule.not_null`` where it must not.
    """

    reason: str
    columns: Sequence[str]
    reference: DataFrame
    reference_columns: Sequence[str] | None = None

    def judged(self, df: DataFrame, flag: str) -> DataFrame:
        theirs = self.reference_columns or self.columns
        if len(theirs) != len(self.columns):
            raise ValueError(f"{self.columns} cannot refer to {theirs}")
        names = [f"_key_{i}" for i in range(len(theirs))]
        keys = self.reference.select(*(F.col(c).alias(n) for c, n in zip(theirs, names, strict=True)))
        known = keys.na.drop().distinct().withColumn("_known", F.lit(True))
        same = reduce(and_, (F.col(c) == F.col(n) for c, n in zip(self.columns, names, strict=True)))
        passes = F.col("_known").isNotNull() | any_null(self.columns)
        return df.join(known, same, "left").withColumn(flag, passes).drop(*names, "_known")


@dataclass(frozen=True)
class UniqueBy(SetRule):
    """No other row has the same ``columns``; all rows of a repeated key fail.

    A key with a null part is equal to none and passes.
    """

    reason: str
    columns: Sequence[str]

    def judged(self, df: DataFrame, flag: str) -> DataFrame:
        columns = list(self.columns)
        counted = df.filter(~any_null(columns)).groupBy(*columns).agg(F.count("*").alias("_n"))
        repeated = counted.filter("_n > 1").select(*columns, F.lit(True).alias("_repeated"))
        joined = _left_join_on(df, repeated, columns)
        return joined.withColumn(flag, F.col("_repeated").isNull()).drop("_repeated")


@dataclass(frozen=True)
class ShareAtMost(SetRule):
    """At most ``percent`` of the rows with the same ``group`` meet ``condition``; else all fail.

    Null is a group like any other. A condition that is null is not met.
    """

    reason: str
    group: Sequence[str]
    condition: Column
    percent: float

    def judged(self, df: DataFrame, flag: str) -> DataFrame:
        group = list(self.group)
        shares = df.groupBy(*group).agg(
            F.count_if(self.condition).alias("_met"), F.count("*").alias("_n")
        )
        over = shares.filter(F.col("_met") * 100 > F.col("_n") * F.lit(self.percent))
        over = over.select(*group, F.lit(True).alias("_over"))
        joined = _left_join_on(df, over, group)
        return joined.withColumn(flag, F.col("_over").isNull()).drop("_over")
