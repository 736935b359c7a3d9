"""Path and catalog tables, and the shared folder for tables that live only during a run."""

from __future__ import annotations

import json
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Name of the directory column that upsert_table lays file tables out by.
BUCKET_COLUMN = re.compile(r"bucket_of_(\d+)")
# Name of the column in which upsert_table keeps a hash of the columns that tell a change.
DIGEST_COLUMN = "_row_digest"
# Name of the directory column that append_rows lays file tables out by.
RUN_COLUMN = "run_id"
# File in which upsert_table keeps the schema of a file table that has outgrown some of its files.
SCHEMA_FILE = "_schema.json"
# Formats that are plain files.
PLAIN_FORMATS = ("parquet", "orc", "avro", "json", "csv")


def read_table(
    spark: SparkSession,
    path: str | None = None,
    *,
    table: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """The latest rows of a path table or a catalog table, without layout columns."""
    if (path is None) == (table is None):
        raise ValueError("give either a path or a table name")
    df = spark.table(table) if table else load_files(spark, path, fmt)
    if path and RUN_COLUMN in df.columns and df.schema[RUN_COLUMN].dataType != T.StringType():
        # Spark takes directory names that look like numbers or dates for such: 01 and 1 would be one
        if any(name.startswith(f"{RUN_COLUMN}=") for name in entry_names(spark, path)):
            fields = [T.StructField(f.name, f.dataType) for f in df.schema if f.name != RUN_COLUMN]
            schema = T.StructType([*fields, T.StructField(RUN_COLUMN, T.StringType())])
            df = spark.read.format(fmt).schema(schema).load(path)
    hidden = (c for c in df.columns if BUCKET_COLUMN.fullmatch(c) or c == DIGEST_COLUMN)
    return df.drop(*hidden)


def load_files(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The rows at ``path``, by the table's own schema where one is kept with it."""
    kept = stored_schema(spark, path)
    reader = spark.read.format(fmt)
    return (reader if kept is None else reader.schema(kept)).load(path)


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema that is kept with a file table; None where its files tell it."""
    if SCHEMA_FILE not in entry_names(spark, path):
        return None
    where, fs = _hadoop_path(spark, f"{path.rstrip('/')}/{SCHEMA_FILE}")
    lines = fs.open(where)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(lines, "UTF-8")
    finally:
        lines.close()
    return T.StructType.fromJson(json.loads(text))


def store_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Keep ``schema`` with the file table at ``path``."""
    write_bytes(spark, f"{path.rstrip('/')}/{SCHEMA_FILE}", schema.json().encode())


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """A small file at ``path``, on whatever file system that is."""
    where, fs = _hadoop_path(spark, path)
    out = fs.create(where, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def table_exists(
    spark: SparkSession, path: str | None = None, *, table: str | None = None
) -> bool:
    """Is there a table to read? Paths are asked of their own file system.

    A directory that holds nothing but a failed write's leftovers is not a table.
    """
    if (path is None) == (table is None):
        raise ValueError("give either a path or a table name")
    if table:
        return spark.catalog.tableExists(table)
    return any(
        name in ("_delta_log", SCHEMA_FILE) or name[0] not in "_." for name in entry_names(spark, path)
    )


def entry_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and directories directly under ``path``; none if it is absent."""
    where, fs = _hadoop_path(spark, path)
    if not fs.exists(where):
        return []
    return [entry.getPath().getName() for entry in fs.listStatus(where)]


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh path, not yet created, in the folder that all executors share.

    That folder is ``spark.checkpoint.dir``. Only a session on one machine may go
    without it and gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    root = root or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="layerflow-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Remove a run's own table from the shared folder."""
    where, fs = _hadoop_path(spark, path)
    fs.delete(where, True)
