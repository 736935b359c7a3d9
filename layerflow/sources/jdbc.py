"""Snapshot scans of relational tables."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcTarget:
    """Where a relational database is and who reads it."""

    url: str
    user: str
    password: str = field(repr=False)
    driver: str = "org.postgresql.Driver"

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> JdbcTarget:
        """PostgreSQL settings from ``DB_*`` variables. The password has no default."""
        env = os.environ if env is None else env
        # fixed values: variable names and defaults of the connection contract
        host = env.get("DB_HOST", "localhost")
        port = env.get("DB_PORT", "5432")
        name = env.get("DB_NAME", "ecom_source")
        user = env.get("DB_USER", "data_engineer")
        if "DB_PASSWORD" not in env:
            raise KeyError("DB_PASSWORD is not set")
        return cls(f"jdbc:postgresql://{host}:{port}/{name}", user, env["DB_PASSWORD"])

    def options(self) -> dict[str, str]:
        return {
            "url": self.url,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
        }


@dataclass(frozen=True)
class JdbcSplit:
    """How to cut one table into parallel range scans.

    ``column`` should be the primary key or another near-unique number or time: a range
    scan cannot be cut within one value. With no bounds they are read from the table by
    one aggregate query that the database answers from the key's index. Bounds only
    place the cuts: rows outside them, and null values, are still read.
    """

    column: str
    partitions: int
    lower: object | None = None
    upper: object | None = None


def read_jdbc(
    spark: SparkSession,
    target: JdbcTarget,
    table: str,
    split: JdbcSplit | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """All rows of ``table``; one connection, or ``split.partitions`` of them.

    Filters and column pruning on the result reach the database. The parallel scans are
    separate transactions: read from a replica or a quiet table for one exact snapshot.
    """
    options = {**target.options(), "fetchsize": str(fetch_size)}

    def load(**more: str) -> DataFrame:
        return spark.read.format("jdbc").options(**options, **more).load()

    if split is None:
        return load(dbtable=table)

    lower, upper = split.lower, split.upper
    if lower is None or upper is None:
        key = split.column
        found = load(dbtable=f"(SELECT min({key}) AS lo, max({key}) AS hi FROM {table}) b").first()
        lower = found["lo"] if lower is None else lower
        upper = found["hi"] if upper is None else upper
    if lower is None or upper is None:  # empty table, or nothing but null keys
        return load(dbtable=table)
    return load(
        dbtable=table,
        partitionColumn=split.column,
        lowerBound=str(lower),
        upperBound=str(upper),
        numPartitions=str(split.partitions),
    )
