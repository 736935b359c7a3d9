"""Whole-table replaces and appends."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerflow.sources.tables import (
    PLAIN_FORMATS,
    RUN_COLUMN,
    discard,
    entry_names,
    shared_folder,
)


def write_snapshot(
    df: DataFrame,
    path: str | None = None,
    *,
    table: str | None = None,
    fmt: str = "parquet",
) -> None:
    """Replace a path table or a managed catalog table by ``df``."""
    if (path is None) == (table is None):
        raise ValueError("give either a path or a table name")
    writer = df.write.format(fmt).mode("overwrite")
    if table:
        writer.saveAsTable(table)
    else:
        writer.save(path)


def append_rows(
    df: DataFrame,
    path: str,
    *,
    fmt: str = "parquet",
    skip_empty: bool = True,
    n_rows: int | None = None,
    run_id: str | None = None,
) -> bool:
    """Append ``df`` to a path table; tell whether anything was written.

    An empty append would still create the table, so by default it is left out; pass
    ``n_rows`` when the count is known already, to save looking. With ``run_id``, any text but
    an empty one, the rows carry it in a column ``run_id``, by which the table is laid out, and
    doing the same run again replaces them instead of doubling them. Use it on every append to
    a table or on none. Formats other than plain files take no ``run_id``.
    """
    if run_id is not None:
        if not isinstance(run_id, str) or not run_id:
            raise ValueError(f"not a run id: {run_id!r}")
        if fmt not in PLAIN_FORMATS:
            raise ValueError(f"run_id is for {', '.join(PLAIN_FORMATS)}, not for {fmt}")
        if RUN_COLUMN in df.columns:
            raise ValueError(f"there is a column {RUN_COLUMN} already")
        # also when empty: an earlier attempt of this run may have left rows behind
        if skip_empty and _is_empty(df, n_rows):
            return _drop_run(df, path, run_id)
        labelled = df.withColumn(RUN_COLUMN, F.lit(run_id))
        writer = labelled.write.format(fmt).partitionBy(RUN_COLUMN).mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").save(path)
        return True
    if skip_empty and _is_empty(df, n_rows):
        return False
    df.write.format(fmt).mode("append").save(path)
    return True


def _drop_run(df: DataFrame, path: str, run_id: str) -> bool:
    """Remove the rows that an earlier attempt of a run has left; tell whether there were any."""
    for name in entry_names(df.sparkSession, path):
        column, _, value = name.partition("=")
        if column == RUN_COLUMN and unquote(value) == run_id:
            discard(df.sparkSession, f"{path.rstrip('/')}/{name}")
            return True
    return False


def _is_empty(df: DataFrame, n_rows: int | None) -> bool:
    return df.isEmpty() if n_rows is None else n_rows == 0


def stage_table(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> str:
    """Write ``df`` to the shared folder and return its path.

    Cuts lineage: what is read back from there is not computed again when several
    actions need it or when executors are lost.
    """
    path = shared_folder(df.sparkSession, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return path
