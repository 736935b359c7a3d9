"""Placement of rows on shards by a lookup table that the shards fill in turns."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLE_SIZE = 65_537  # prime; at least a hundred slots per shard keep shares within some per cent


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _hash(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{salt}:{name}".encode(), digest_size=8).digest(), "big")


def preference(name: str, size: int) -> tuple[int, int]:
    """First slot and stride of a shard's order of preference: a permutation, as ``size`` is prime."""
    return _hash(name, "offset") % size, _hash(name, "skip") % (size - 1) + 1


def lookup_table(shards: Sequence[str], size: int = TABLE_SIZE) -> list[int]:
    """For each slot the index of its shard.

    The shards take turns; each claims the first slot of its order that is still free. So shares
    differ by one slot at most, and a shard that leaves frees its own slots while few others
    change hands. The result depends on the set of names alone, as turns go by sorted name.
    """
    if not _is_prime(size):
        raise ValueError("the table's size must be prime")
    if not shards or len(set(shards)) != len(shards) or len(shards) > size:
        raise ValueError("give distinct shard names, no more than slots")
    order = sorted(range(len(shards)), key=lambda i: shards[i])
    at = {i: preference(shards[i], size) for i in order}
    slots = [-1] * size
    free = size
    cursor = {i: at[i][0] for i in order}
    while True:
        for i in order:
            slot, skip = cursor[i], at[i][1]
            while slots[slot] >= 0:
                slot = (slot + skip) % size
            slots[slot] = i
            cursor[i] = (slot + skip) % size
            free -= 1
            if not free:
                return slots


def table_frame(spark: SparkSession, shards: Sequence[str], size: int = TABLE_SIZE) -> DataFrame:
    rows = [(slot, shards[i]) for slot, i in enumerate(lookup_table(shards, size))]
    return spark.createDataFrame(rows, "slot int, shard string")


def slot_of(docs: DataFrame, key: str, size: int = TABLE_SIZE) -> Column:
    """Slot of each row by a hash of its key; rows without a key spread by their other columns."""
    others = [F.col(f"`{f.name}`") for f in docs.schema if not _has_map(f.dataType)]
    spread = F.when(F.col(key).isNull(), F.xxhash64(F.lit("no key"), *others))
    return F.pmod(spread.otherwise(F.xxhash64(key)), F.lit(size)).cast("int")


def _has_map(kind: T.DataType) -> bool:
    return "map<" in kind.simpleString() or "variant" in kind.simpleString()


def place(
    docs: DataFrame, shards: Sequence[str], *, key: str = "doc_id", size: int = TABLE_SIZE
) -> DataFrame:
    """``docs`` with ``slot`` and ``shard``; no row is shuffled.

    The table has ``size`` rows whatever the data, so it is broadcast. Equal keys go to one
    shard; a null key is no key. Empty input gives no rows.
    """
    if clash := {"slot", "shard"} & set(docs.columns):
        raise ValueError(f"columns {sorted(clash)} are there already")
    table = F.broadcast(table_frame(docs.sparkSession, shards, size))
    placed = docs.withColumn("slot", slot_of(docs, key, size)).join(table, "slot")
    return placed.select(*docs.columns, "slot", "shard")


def write_shards(placed: DataFrame, path: str, files_per_shard: int = 1) -> None:
    """One folder per shard (``shard=<name>``) with about ``files_per_shard`` files each.

    Rows of a shard are dealt to its files by slot, so a large shard is written by many tasks.
    """
    n = placed.select("shard").distinct().count() * files_per_shard
    part = F.pmod(F.xxhash64("slot"), F.lit(files_per_shard))
    placed.repartition(max(1, n), "shard", part).write.partitionBy("shard").parquet(path)
