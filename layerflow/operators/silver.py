"""Cleaned layer: one row per key, conformed types."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from typing import Literal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerflow.functions import Category, FixedDecimal, ParseTime, any_null, timestamp_literal


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind)
    return not isinstance(kind, (T.MapType, T.VariantType))


def dedupe_latest(
    df: DataFrame,
    keys: Sequence[str],
    latest_by: Sequence[str] = (),
    null_keys: Literal["collapse", "keep"] = "collapse",
    *,
    how: Literal["aggregate", "window"] = "aggregate",
    n_versions: str | None = None,
) -> DataFrame:
    """One row per key: the greatest by ``latest_by``, then by every other column; null is least.

    The order is total, so the winner depends neither on partitioning nor on task retries;
    columns that have no order of their own, such as maps, come last, by their JSON form.
    Rows whose key has a null part form groups of their own like any other value
    (``"collapse"``) or are all kept (``"keep"``). ``n_versions`` names a column to add: how many
    rows of the input each row stands for.

    Plan: one exchange on the key. ``max`` combines before it, so a hot key leaves each
    map task as one row. ``how="window"`` ranks instead, which is cheaper where nearly every key
    has one row; there too each map task sends no more than one row per key on. ``n_versions`` then
    costs a second exchange, of keys and partial counts, whose result meets the winners where they
    lie; null keys are counted by the other form. Kept null-key rows never enter the exchange.
    """
    if null_keys not in ("collapse", "keep"):
        raise ValueError(f"null_keys: {null_keys!r}")
    if how not in ("aggregate", "window"):
        raise ValueError(f"how: {how!r}")
    if null_keys == "keep":
        keyless = df.filter(any_null(keys))
        if n_versions:
            keyless = keyless.withColumn(n_versions, F.lit(1).cast("long"))
        keyed = df.filter(~any_null(keys))
        return dedupe_latest(
            keyed, keys, latest_by, how=how, n_versions=n_versions
        ).unionByName(keyless)

    counted = [F.count("*").alias(n_versions)] if n_versions else []
    extra = [n_versions] if n_versions else []
    rest = [c for c in df.columns if c not in keys and c not in latest_by]
    carried = [*latest_by, *rest]
    if not carried:
        if counted:
            return df.groupBy(*keys).agg(*counted).select(*df.columns, n_versions)
        return df.select(*keys).distinct()
    kinds = dict(zip(df.columns, (f.dataType for f in df.schema)))
    ranked = [F.col(c) for c in carried if _orderable(kinds[c])]
    loose = [c for c in carried if not _orderable(kinds[c])]
    if loose:
        ranked.append(F.to_json(F.struct(*loose)).alias("_loose"))
    if how == "window":
        by_key = Window.partitionBy(*keys)
        rank = F.row_number().over(by_key.orderBy(*(c.desc_nulls_last() for c in ranked)))
        if not n_versions:
            return df.withColumn("_rank", rank).filter("_rank = 1").select(*df.columns)
        # a count over the window would keep a key's rows together: it would rule out the rank's
        # limit in each map task
        keyed = df.filter(~any_null(keys))
        first = keyed.withColumn("_rank", rank).filter("_rank = 1").select(*df.columns)
        counts = keyed.groupBy(*keys).agg(*counted)
        keyless = dedupe_latest(
            df.filter(any_null(keys)), keys, latest_by, n_versions=n_versions
        )
        counted_first = first.join(counts, list(keys)).select(*df.columns, n_versions)
        return counted_first.unionByName(keyless)
    row = F.struct(*carried)
    winner = F.max_by(row, F.struct(*ranked)) if loose else F.max(row)
    grouped = df.groupBy(*keys).agg(winner.alias("_row"), *counted)
    return grouped.select(*_unpack(df.columns, keys), *extra)


def _unpack(columns: Sequence[str], keys: Sequence[str]) -> list[Column]:
    return [F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in columns]


def conform(
    df: DataFrame,
    spec: Sequence[ParseTime | FixedDecimal | Category],
    run_ts: str | datetime | Column | None = None,
    stamp: str = "silver_processed_at",
) -> DataFrame:
    """Append the conformed columns of ``spec`` and, given ``run_ts``, the processing time."""
    added = {step.target: step.column(df) for step in spec}
    if run_ts is not None:
        added[stamp] = timestamp_literal(run_ts)
    return df.withColumns(added)
