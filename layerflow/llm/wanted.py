"""Few rows of a large table, found by a bitmap of fixed size instead of a shuffle of all."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BITS = 1 << 22
_BUCKET = 1 << 15  # bits of one value of bitmap_construct_agg


def bitmap_of(rows: DataFrame, place: Column, bits: int) -> np.ndarray:
    """A bitmap of ``bits`` bits in which the rows' places, from 0, are set; null ones set none."""
    parts = (
        rows.where(place.isNotNull())
        .groupBy(F.bitmap_bucket_number(place + 1).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place + 1)).alias("bits"))
        .collect()  # at most bits / _BUCKET values of 4 kB
    )
    out = np.zeros((bits // _BUCKET, _BUCKET // 8), np.uint8)
    for bucket, value in parts:
        out[bucket - 1] = np.frombuffer(value, np.uint8)
    return out.ravel()


def holds(bitmap: np.ndarray, place: np.ndarray) -> np.ndarray:
    return (bitmap[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def rows_by_key(rows: DataFrame, wanted: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose ``key`` (a long) may be among those of ``wanted``, and those whose is not.

    The keys of ``wanted`` are set in a bitmap of 512 kB, whatever their number, against which
    each task tests its rows. Null keys are among the others.
    """
    place = F.pmod(F.xxhash64(key), F.lit(_BITS))
    bitmap = bitmap_of(wanted.where(F.col(key).isNotNull()), place, _BITS)
    shared = rows.sparkSession.sparkContext.broadcast(bitmap)
    names, last = rows.columns, "__lf_place"

    def passing(inside: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                chosen = holds(shared.value, batch.column(last).to_numpy()) == inside
                passed = batch.filter(pa.array(chosen)).select(names)
                if passed.num_rows:
                    yield passed

        return run

    placed = rows.withColumn(last, place)
    some = placed.where(F.col(key).isNotNull()).mapInArrow(passing(True), rows.schema)
    rest = placed.where(F.col(key).isNotNull()).mapInArrow(passing(False), rows.schema)
    return some, rest.unionByName(rows.where(F.col(key).isNull()))


def rows_wanted(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The rows that join ``wanted`` on ``key``, with the columns of both; only these are shuffled.

    But for the few that share a bit with a key of ``wanted``.
    """
    return rows_by_key(rows, wanted, key)[0].join(wanted, key)
