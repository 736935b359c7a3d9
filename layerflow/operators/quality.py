"""Data-quality rules: first failing reason, clean/rejected split, counts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerflow.functions import timestamp_literal
from layerflow.operators.relational import SetRule

REASON = "quarantine_reason"
CLEAN = "clean"


def check_reason(reason: object) -> None:
    if not isinstance(reason, str) or not reason or reason == CLEAN:
        raise ValueError(f"not a reason: {reason!r}")


@dataclass(frozen=True)
class Rule:
    """``passes`` must be true for a row to be clean; false and null both fail.

    The reason is any text but an empty one and ``clean``, under which clean rows are counted.
    """

    reason: str
    passes: Column

    def __post_init__(self) -> None:
        check_reason(self.reason)

    @classmethod
    def not_null(cls, column: str, reason: str) -> Rule:
        return cls(reason, F.col(column).isNotNull())

    @classmethod
    def at_least(cls, column: str, minimum: object, reason: str) -> Rule:
        return cls(reason, F.col(column) >= minimum)

    @classmethod
    def not_after(cls, column: str, as_of: str | datetime | Column, reason: str) -> Rule:
        return cls(reason, F.col(column) <= timestamp_literal(as_of))

    @property
    def fails(self) -> Column:
        # a null verdict would drop the row from the clean and the rejected side alike
        return ~F.coalesce(self.passes, F.lit(False))


def first_failure(rules: Sequence[Rule]) -> Column:
    """Reason of the first rule, in order, that the row fails; null for a clean row."""
    return F.coalesce(*(F.when(rule.fails, F.lit(rule.reason)) for rule in rules))


def needs_other_rows(rules: Sequence[Rule | SetRule]) -> bool:
    return any(isinstance(rule, SetRule) for rule in rules)


def classify(
    df: DataFrame, rules: Sequence[Rule | SetRule], reason: str = REASON
) -> DataFrame:
    """Append the first failing reason; null marks a clean row.

    Rules that need other rows look at all rows of ``df``, whatever the other rules say of them;
    with such rules ``df`` is read more than once, so store it where it is costly.
    """
    if not rules:
        raise ValueError("no rules given")
    columns, row_rules = df.columns, []
    for n, rule in enumerate(rules):
        if isinstance(rule, SetRule):
            check_reason(rule.reason)
            df = rule.judged(df, flag := f"_passes_{n}")
            rule = Rule(rule.reason, F.col(flag))
        row_rules.append(rule)
    return df.select(*columns, first_failure(row_rules).alias(reason))


def split_by_quality(
    classified: DataFrame,
    columns: Sequence[str],
    rejected_at: str | datetime | Column,
    reason: str = REASON,
    stamp: str = "quarantined_at",
) -> tuple[DataFrame, DataFrame]:
    """Clean rows cut to ``columns``, and rejected rows whole with reason and time.

    The two sides are exact complements. Both read ``classified``: materialise it first
    when it is costly and both sides are to be written.
    """
    clean = classified.filter(F.col(reason).isNull()).select(*columns)
    rejected = classified.filter(F.col(reason).isNotNull()).withColumn(
        stamp, timestamp_literal(rejected_at)
    )
    return clean, rejected


def quality_report(classified: DataFrame, reason: str = REASON) -> DataFrame:
    """Row count per reason, clean rows under ``clean``."""
    return classified.groupBy(F.coalesce(F.col(reason), F.lit(CLEAN)).alias("outcome")).agg(
        F.count("*").alias("n_rows")
    )


def quality_counters(rules: Sequence[Rule | SetRule], reason: str = REASON) -> dict[str, Column]:
    """The report's counts as aggregates to observe while ``classified`` is being written."""
    outcomes = dict.fromkeys(rule.reason for rule in rules)
    return {CLEAN: F.count_if(F.col(reason).isNull())} | {
        outcome: F.count_if(F.col(reason) == outcome) for outcome in outcomes
    }
