"""A few rows to look at."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def preview(
    df: DataFrame,
    n: int,
    order_by: Sequence[str | Column] = (),
    columns: Sequence[str] = (),
) -> DataFrame:
    """``n`` rows, cut to ``columns``: the first by ``order_by``, or any.

    With an order this is a top-n per task and a merge of those, never a global sort.
    """
    if order_by:
        df = df.orderBy(*order_by)
    df = df.limit(n)
    return df.select(*columns) if columns else df
