"""The layered flow over files that arrive, batch by batch."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerflow.functions import any_null
from layerflow.plans.layers import LayerRun, TableSpec, run_layers
from layerflow.sinks import append_rows
from layerflow.sources import Layers, read_table
from layerflow.sources.tables import RUN_COLUMN


def run_arrivals(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    spec: TableSpec,
    layers: Layers,
    run_ts: str | datetime | Column,
    *,
    checkpoint: str,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
    read_options: dict[str, str] | None = None,
    **options,
) -> list[LayerRun]:
    """Take in the files at ``path`` that no earlier call has, then return the runs of its batches.

    Spark's file source deals new files to batches, notes them at ``checkpoint``, and ends when
    there are none left. A batch's rows are appended to the arrivals under the batch's id. The flow
    then runs over all rows so far of the keys that the batch holds, so a version that arrives late
    does not supersede a later one, and the latest of all is found as if all had come at once. With
    the batch's id as run id, a batch that was cut off is done again with the same files and
    replaces what it has left behind. ``fmt`` is that of the files and of the layers; ``options`` are
    those of ``run_layers``. A key whose latest version turns bad keeps the last good one in gold, as
    from run to run; ``clauses`` that act on orphans are refused.
    """
    clauses = options.get("clauses")
    if clauses is not None and clauses.touches_orphans:
        raise ValueError("a batch cannot tell which rows the source has lost")
    runs: list[LayerRun] = []
    arrivals = layers.path("arrivals")

    def take_in(batch: DataFrame, batch_id: int) -> None:
        session, run_id = batch.sparkSession, f"batch-{batch_id:09d}"
        append_rows(batch, arrivals, run_id=run_id)
        # batches that a lost checkpoint has left behind are no part of this stream's past
        so_far = read_table(session, arrivals).filter(F.col(RUN_COLUMN) <= run_id)
        rows = _rows_of_keys(so_far, spec, run_id)
        runs.append(run_layers(session, rows, spec, layers, run_ts, run_id=run_id, **options))

    stream = spark.readStream.schema(schema).format(fmt)
    for name, value in (read_options or {}).items():
        stream = stream.option(name, value)
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    query = (
        stream.load(path)
        .writeStream.foreachBatch(take_in)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return runs


def _rows_of_keys(so_far: DataFrame, spec: TableSpec, run_id: str) -> DataFrame:
    """All rows of the keys in the batch, and its own rows without a key."""
    own = so_far.filter(F.col(RUN_COLUMN) == run_id)
    keys = own.filter(~any_null(spec.keys)).select(*spec.keys).distinct()
    keyed = so_far.join(keys, list(spec.keys), "left_semi").select(*so_far.columns)
    return keyed.unionByName(own.filter(any_null(spec.keys))).drop(RUN_COLUMN)
