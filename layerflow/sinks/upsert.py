"""Keyed upsert into a stored table."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from layerflow.functions import any_null, key_hash
from layerflow.operators.merge import (
    PLAIN,
    Clauses,
    align_updates,
    differs,
    duplicate_key_error,
    evolved_schema,
    merge_tagged,
    updated_columns,
)
from layerflow.sinks.writes import stage_table, write_snapshot
from layerflow.sources.tables import (
    BUCKET_COLUMN,
    DIGEST_COLUMN,
    discard,
    entry_names,
    load_files,
    read_table,
    store_schema,
    table_exists,
)

# Formats that are plain files, which Spark can replace by directory but not merge into.
FILE_FORMATS = ("parquet", "orc", "avro")
# Formats with tables that the session's catalog can MERGE into.
MERGE_FORMATS = ("delta", "iceberg", "hudi")
# Stores in which moving a directory copies its data, object by object.
COPYING_STORES = re.compile(r"(s3|s3a|s3n|gs|abfss?|wasbs?|oss|cos|cosn|obs)://", re.I)

# Bucket of the rows whose key has a null part: they match nothing and need no placing.
KEYLESS = -1


def check_mergeable(fmt: str) -> None:
    """Refuse a format that can neither be replaced by directory nor merged into."""
    if fmt not in FILE_FORMATS + MERGE_FORMATS:
        known = ", ".join(FILE_FORMATS + MERGE_FORMATS)
        raise ValueError(f"no upsert into {fmt}; there is one into {known}")


@dataclass(frozen=True)
class Upserted:
    """What an upsert has replaced: the buckets (of a path table), and whether anything at all."""

    buckets: tuple[int, ...] = ()
    wrote: bool = True


def row_digest(columns: Sequence[str]) -> Column:
    """64-bit hash of the columns' values, in which a null is unlike any value and place."""
    return F.xxhash64(*(part for c in sorted(columns) for part in (F.col(c).isNull(), F.col(c))))


def digested_columns(df: DataFrame) -> list[str] | None:
    """The columns that the stored digest of a table covers; None if it holds none."""
    for f in df.schema:
        if f.name == DIGEST_COLUMN:
            return f.metadata.get("of")
    return None


def upsert_table(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
    *,
    fmt: str = "parquet",
    buckets: int | None = None,
    files_per_bucket: int = 1,
    compare_cols: Sequence[str] | None = None,
    clauses: Clauses = PLAIN,
    evolve: bool = False,
) -> Upserted:
    """Create the table at ``path`` from ``updates``, or merge them in by key.

    Matched rows take ``update_cols`` (default: all), unmatched updates are inserted,
    other rows stay. A key that occurs twice among the updates or in the table fails the
    write. Formats that can MERGE, such as ``delta``, do so in the session's catalog.

    The updates are read more than once: pass a stored table, or a cheap view of one.

    Plain files are laid out in ``buckets`` directories by key hash. A merge reads and
    replaces only the directories that the updates fall into, in one job with one
    exchange, after which a task writes one file: as many tasks as files in those directories.
    Aim at ``files_per_bucket`` times ``buckets`` files of about 1 GB. The first write needs
    ``buckets``, which its layout keeps; ``rebucket`` makes a table with another number. Stores
    in which a move is a copy are refused: there, take ``upsert_bucketed_table``. Lost
    executors do no harm, but the replacing of directories at the end is not one atomic
    step, as it is with a transactional format, and frames that still read the old files fail.
    A driver lost at that point leaves directories in Spark's staging folder under ``path``;
    while there is one, be it of such a run or of a concurrent one, merges are refused.

    ``compare_cols``: a match is updated only if one of these columns (those that say something
    about the row, not when it was processed) has another value, a null being equal to a null. A
    parquet table that is created with them stores a digest of them in each row. Then,
    and with ``clauses``, a first pass reads no more of the table than keys, digest (or the
    columns compared) and what the conditions name, and leaves just the rows that change
    something. Only the directories that these fall into are replaced; where there are none,
    nothing is written. Updates with a null key match nothing and are always inserted.

    ``evolve``: columns that only the updates have are added, null in the rows before, and a type
    becomes the wider of both (``evolved_schema``). Directories that the updates do not fall into stay
    as they are: the table keeps its schema in a file of its own, by which ``read_table`` reads
    all of them. It is written first, so a merge that fails leaves the old rows under new columns.
    For parquet and ORC. A digest goes on covering the columns it began with.
    """
    keys = list(keys)
    check_mergeable(fmt)
    if fmt in FILE_FORMATS and COPYING_STORES.match(path):
        raise ValueError(f"{path}: replacing directories copies them there; use a bucketed table")
    exists = table_exists(spark, path)
    if fmt not in FILE_FORMATS:
        if exists:
            _merge_into(
                f"{fmt}.`{path}`", updates, keys, update_cols, _compared(clauses, compare_cols)
            )
        else:
            write_snapshot(updates, path, fmt=fmt)
        return Upserted()

    staging = [n for n in entry_names(spark, path) if n.startswith(".spark-staging")]
    if staging:
        raise RuntimeError(
            f"{path} has a write that did not end: move the directories that {path} lacks "
            f"out of {staging}, then remove it"
        )
    if exists:
        target = load_files(spark, path, fmt)
        bucket = next((c for c in target.columns if BUCKET_COLUMN.fullmatch(c)), None)
        if bucket is None:
            raise ValueError(f"{path} was not written by upsert_table")
        buckets = int(BUCKET_COLUMN.fullmatch(bucket)[1])
        digested = digested_columns(target)
        if evolve:
            target = _evolved(spark, path, fmt, target, updates, keys, bucket)
    else:
        if not buckets:
            raise ValueError("a new table needs buckets: its size divided by that of a bucket")
        bucket = f"bucket_of_{buckets}"
        target = updates.limit(0).withColumn(bucket, F.lit(0))
        # other formats do not keep which columns the digest covers
        digested = list(compare_cols) if compare_cols and fmt == "parquet" else None

    rows = target.drop(bucket, DIGEST_COLUMN)
    update_cols = updated_columns(rows, updates, keys, update_cols)
    _check_compared(compare_cols, update_cols)
    clauses.check(rows.columns, keys)
    placed = F.when(any_null(keys), KEYLESS).otherwise(F.pmod(key_hash(keys), F.lit(buckets)))
    updates = align_updates(rows, updates, keys).withColumn(bucket, placed.cast("int"))
    stored = target.drop(DIGEST_COLUMN)
    update_rows = updates.withColumn("_is_update", F.lit(1))
    staged, deals_keyless = None, False
    try:
        if exists and (compare_cols or not clauses.is_plain):
            changes = _changes(target, updates, keys, bucket, digested, compare_cols, clauses)
            staged = stage_table(changes, "layerflow-changes")
            update_rows = spark.read.schema(changes.schema).parquet(staged)
            keyless_rows = stored.filter(F.col(bucket) == KEYLESS)
            deals_keyless = (
                clauses.touches_orphans and not keyless_rows.filter(clauses.is_dealt()).isEmpty()
            )
        # at most buckets + 1 numbers come to the driver
        touched = {row[0] for row in update_rows.select(bucket).distinct().collect()}
        if deals_keyless:
            touched.add(KEYLESS)
        if exists and not touched:
            return Upserted(wrote=False)
        merged = _merged_buckets(
            stored.filter(F.col(bucket).isin(touched)),
            update_rows,
            rows.columns,
            keys,
            update_cols,
            bucket,
            touched,
            files_per_bucket,
            _compared(clauses, compare_cols),
        )
        if digested:
            digest = row_digest(digested).alias(DIGEST_COLUMN, metadata={"of": digested})
            merged = merged.select(*rows.columns, digest, bucket)
        seen = Observation()
        if clauses.deletes:
            merged = merged.observe(seen, F.collect_set(bucket).alias("filled"))
        (
            merged.write.format(fmt)
            .partitionBy(bucket)
            .mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .save(path)
        )
        if clauses.deletes:
            # a bucket that has lost all its rows is not replaced by a write without any
            emptied = touched - set(seen.get["filled"])
            if emptied:
                store_schema(spark, path, target.schema)  # no file may be left to tell it
            for number in emptied:
                discard(spark, f"{path.rstrip('/')}/{bucket}={number}")
    finally:
        if staged is not None:
            discard(spark, staged)
    return Upserted(tuple(sorted(touched)))


def _evolved(
    spark: SparkSession,
    path: str,
    fmt: str,
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    bucket: str,
) -> DataFrame:
    """The table at ``path`` after its schema has taken in that of the updates."""
    if fmt not in ("parquet", "orc"):
        raise ValueError(f"files of {fmt} cannot be read by another schema")
    layout = [f for f in target.schema if f.name in (bucket, DIGEST_COLUMN)]
    rows = target.drop(bucket, DIGEST_COLUMN).schema
    wider = evolved_schema(rows, updates.schema, keys)
    if [(f.name, f.dataType) for f in wider] == [(f.name, f.dataType) for f in rows]:
        return target
    # as in the files: the columns, the digest, and last the one that names directories
    layout.sort(key=lambda f: f.name == bucket)
    store_schema(spark, path, StructType([*wider, *layout]))
    return load_files(spark, path, fmt)


def _check_compared(compare_cols: Sequence[str] | None, update_cols: Sequence[str]) -> None:
    wrong = [c for c in compare_cols or () if c not in update_cols]
    if wrong:
        raise ValueError(f"compared, but not updated: {wrong}")


def _compared(clauses: Clauses, compare_cols: Sequence[str] | None) -> Clauses:
    """The clauses, with updates on the further condition that some compared column differs."""
    if not compare_cols:
        return clauses
    changed, update_if = differs(compare_cols), clauses.update_if

    def both(old, new):
        return changed(old, new) if update_if is None else changed(old, new) & update_if(old, new)

    return Clauses(both, clauses.orphans, clauses.orphan_if)


def _changes(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    bucket: str,
    digested: Sequence[str] | None,
    compare_cols: Sequence[str] | None,
    clauses: Clauses,
) -> DataFrame:
    """The updates that change something (``_is_update`` 1), and keys of orphans to deal with (2).

    One exchange of the updates and of the columns of the stored rows that tell a change.
    """
    by_digest = compare_cols and digested and set(digested) == set(compare_cols)
    read = clauses.old_columns() | set(clauses.marks)
    if compare_cols and not by_digest:
        read |= set(compare_cols)
    seen = [F.col(c) for c in target.columns if c in read and c not in keys]
    if by_digest:
        seen.append(F.col(DIGEST_COLUMN))
    seen = seen or [F.lit(True).alias("_there")]
    sub = target.filter(~any_null(keys)).select(
        *keys, bucket, F.struct(*seen).alias("_stored"), F.lit(0).alias("_is_update")
    )
    rest = [c for c in updates.columns if c not in keys and c != bucket]
    given = updates.select(
        *keys, bucket, F.struct(*rest, F.lit(True).alias("_there")).alias("_new"), F.lit(1).alias("_is_update")
    )
    keyless = given.filter(any_null(keys))
    both = sub.unionByName(given.filter(~any_null(keys)), allowMissingColumns=True)
    pair = Window.partitionBy(bucket, *keys).orderBy("_is_update")
    paired = both.withColumns(
        {
            "_follower": F.lead("_is_update").over(pair),
            "_old": F.lag("_stored").over(pair),
        }
    )

    def from_struct(name: str):
        return lambda c: F.col(c) if c in keys else F.col(name)[c]

    old, new = from_struct("_old"), from_struct("_new")
    wanted = clauses.applies(old, new)
    if by_digest:
        values = (part for c in sorted(digested) for part in (new(c).isNull(), new(c)))
        wanted = wanted & ~F.xxhash64(*values).eqNullSafe(old(DIGEST_COLUMN))
    elif compare_cols:
        wanted = wanted & differs(compare_cols)(old, new)
    tag, follower = F.col("_is_update"), F.col("_follower")
    error = F.when((tag == 1) & (follower == 1), duplicate_key_error(keys, "updates"))
    changed = (tag == 1) & (F.col("_old").isNull() | wanted)
    orphan = (tag == 0) & clauses.is_dealt(from_struct("_stored"))
    kept = paired.filter(error.isNull() & follower.isNull() & (changed | orphan))
    kept = kept.withColumn("_is_update", F.when(tag == 0, 2).otherwise(1))
    columns = [F.col(c) if c in keys else F.col("_new")[c].alias(c) for c in updates.columns if c != bucket]
    picked = [*columns, F.col(bucket), F.col("_is_update")]
    return kept.select(*picked).unionByName(keyless.select(*picked))


def _merged_buckets(
    target: DataFrame,
    update_rows: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str],
    update_cols: Sequence[str],
    bucket: str,
    touched: set[int],
    files_per_bucket: int,
    clauses: Clauses,
) -> DataFrame:
    """The touched buckets after the merge, in one exchange that is also the output's layout."""
    # upper hash bits: the lower ones are the same throughout a bucket
    part = F.pmod(F.shiftrightunsigned(key_hash(keys), 32), F.lit(files_per_bucket))
    placed_in = sorted(touched - {KEYLESS})
    # buckets that are not touched get no tasks; an update outside these slots is a stray
    number = F.array_position(F.array(*map(F.lit, placed_in)).cast("array<int>"), F.col(bucket))
    slot = (F.greatest(number - 1, F.lit(0)) * files_per_bucket + part).cast("int")
    slots = max(1, len(placed_in)) * files_per_bucket
    both = target.withColumn("_is_update", F.lit(0)).unionByName(update_rows)
    keyless = None
    if KEYLESS in touched:
        is_keyless = F.col(bucket) == KEYLESS
        kept = target.filter(is_keyless)
        if clauses.touches_orphans:
            kept = clauses.deal(kept)
        keyless = kept.unionByName(update_rows.filter(is_keyless).drop("_is_update"))
        both = both.filter(F.col(bucket) != KEYLESS)
    both = both.withColumn("_slot", slot).repartitionById(slots, "_slot")
    # a directory that is replaced but was not read would lose its rows
    is_stray = (F.col("_is_update") > 0) & ~F.col(bucket).isin(touched)
    changed = F.raise_error(F.lit("the updates changed between two reads"))
    # bucket first, so that the writer finds its rows in directory order
    merged = merge_tagged(
        both,
        [*columns, bucket],
        keys,
        update_cols,
        [bucket, "_slot"],
        F.when(is_stray, changed),
        clauses,
        orphans_tagged=True,
    )
    return merged if keyless is None else merged.unionByName(keyless)


def rebucket(
    spark: SparkSession,
    path: str,
    to_path: str,
    keys: Sequence[str],
    buckets: int,
    *,
    fmt: str = "parquet",
    files_per_bucket: int = 1,
) -> None:
    """Write the table that ``upsert_table`` keeps at ``path`` to ``to_path``, in other buckets.

    The old table stays as it is: point readers and the next merges to the new one, then
    remove it. ``to_path`` must not hold a table.
    """
    if table_exists(spark, to_path):
        raise ValueError(f"{to_path} holds a table already")
    rows = read_table(spark, path, fmt=fmt)
    upsert_table(
        spark,
        to_path,
        rows,
        keys,
        fmt=fmt,
        buckets=buckets,
        files_per_bucket=files_per_bucket,
        compare_cols=digested_columns(load_files(spark, path, fmt)),
    )


def upsert_bucketed_table(
    spark: SparkSession,
    table: str,
    location: str,
    updates: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
    *,
    fmt: str = "parquet",
    buckets: int | None = None,
    compare_cols: Sequence[str] | None = None,
    clauses: Clauses = PLAIN,
    evolve: bool = False,
) -> str | None:
    """The same upsert for a catalog table of plain files that is bucketed by its key.

    The join reads the table bucket by bucket, so that only the updates are exchanged: the
    better choice where every run touches most of a large table. Each run writes a new
    folder under ``location`` and then points the table to it, in one step. The folder that
    the table leaves is returned; it may be removed once no reader is left on it. A run that finds
    the table pointed elsewhere meanwhile, by a concurrent one, fails and changes nothing.

    ``compare_cols`` and ``clauses`` are as in ``upsert_table``. Rows that change are counted while
    the new folder is written; where there are none the table stays as it is, and None is returned.

    The first write needs ``buckets``, which the catalog keeps; one bucket is one task, so aim at
    about 1 GB each. Rows with a null key count to one bucket, but no task holds them all: they
    are neither exchanged nor joined, each task that reads some writes a file of them, and the join's
    reader of that bucket skips such files by their statistics.

    ``evolve`` adds columns that only the updates have. The catalog cannot change a column's type:
    wider ones are refused.
    """
    keys = list(keys)
    if fmt not in FILE_FORMATS:
        raise ValueError(f"bucketed tables are of {', '.join(FILE_FORMATS)}, not of {fmt}")
    name, left = table, None
    if spark.catalog.tableExists(table):
        facts = _facts(spark, table)
        buckets, left = int(facts["Num Buckets"]), facts["Location"]
        # a name of its own: a concurrent run's table is not ours to drop
        if evolve:
            _add_columns(spark, table, updates, keys)
        target, name = spark.table(table), f"{table}__next_{uuid.uuid4().hex}"
    else:
        if not buckets:
            raise ValueError("a new table needs buckets: its size divided by that of a bucket")
        target = updates.limit(0)
    _check_compared(compare_cols, updated_columns(target, updates, keys, update_cols))
    clauses.check(target.columns, keys)

    merged = merge_bucketed(
        target, updates, keys, update_cols, buckets, _compared(clauses, compare_cols), "_changed"
    )
    seen = Observation()
    if left is not None:
        merged = merged.observe(seen, F.count_if("_changed").alias("n"))
    path = f"{location.rstrip('/')}/{uuid.uuid4().hex}"
    (
        merged.drop("_changed")
        .write.format(fmt)
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("path", path)
        .saveAsTable(name)
    )
    if left is None:
        return None
    spark.sql(f"DROP TABLE {name}")  # it keeps its folder
    # what changed is also what clauses deleted, which no row of the result can tell
    if not seen.get["n"] and not clauses.deletes and (compare_cols or not clauses.is_plain):
        discard(spark, path)
        return None
    spark.catalog.refreshTable(table)
    if _facts(spark, table)["Location"] != left:
        discard(spark, path)
        raise RuntimeError(f"{table} was changed by another run; do this one again")
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)
    return left


def _add_columns(
    spark: SparkSession, table: str, updates: DataFrame, keys: Sequence[str]
) -> None:
    stored = spark.table(table).schema
    wider = evolved_schema(stored, updates.schema, keys)
    changed = [a.name for a, b in zip(stored, wider, strict=False) if a.dataType != b.dataType]
    if changed:
        raise ValueError(f"the catalog cannot widen {changed} of {table}")
    added = [f"`{f.name}` {f.dataType.simpleString()}" for f in wider[len(stored) :]]
    if added:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(added)})")
        spark.catalog.refreshTable(table)


def _facts(spark: SparkSession, table: str) -> dict[str, str]:
    details = spark.sql(f"DESCRIBE EXTENDED {table}")
    return {r.col_name: r.data_type for r in details.collect()}


def merge_bucketed(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None,
    buckets: int,
    clauses: Clauses = PLAIN,
    changed_col: str | None = None,
) -> DataFrame:
    """What ``upsert_bucketed_table`` writes: a full outer join, in which only the updates move.

    Copies of a key among the updates are found by looking one row ahead in the join's order.
    Rows with a null key bypass the join and its exchange. ``changed_col`` names a column to add:
    is this row new, updated or marked?
    """
    update_cols = updated_columns(target, updates, keys, update_cols)
    updates = align_updates(target, updates, keys)
    placed = updates.filter(~any_null(keys)).repartition(buckets, *keys)
    ahead = F.lead(F.lit(1)).over(Window.partitionBy(*keys).orderBy(*keys))
    checked = placed.withColumn("_copy", ahead)
    error = F.when(F.col("_copy") == 1, duplicate_key_error(keys, "updates"))
    checked = checked.filter(error.isNull()).select(
        *(F.col(k).alias(f"_new_{k}") for k in keys),
        F.struct(*(c for c in target.columns if c not in keys), F.lit(1).alias("_there")).alias("_new"),
    )
    same = reduce(and_, (F.col(k) == F.col(f"_new_{k}") for k in keys))
    stored = target.filter(~any_null(keys)).withColumn("_old", F.lit(1))
    joined = stored.join(checked, same, "full")
    is_new, was_there = F.col("_new").isNotNull(), F.col("_old").isNotNull()
    applies = clauses.applies(F.col, lambda c: F.col(c) if c in keys else F.col("_new")[c])
    is_dealt = was_there & ~is_new & clauses.is_dealt()
    if clauses.deletes:
        joined = joined.filter(~is_dealt)

    def column(name: str) -> Column:
        if name in keys:
            return F.coalesce(F.col(name), F.col(f"_new_{name}")).alias(name)
        taken = is_new & (~was_there | applies) if name in update_cols else is_new & ~was_there
        value = F.when(taken, F.col("_new")[name]).otherwise(F.col(name))
        if name in clauses.marks:
            value = F.when(is_dealt, clauses.marks[name]).otherwise(value)
        return value.alias(name)

    def told(changed: Column) -> list[Column]:
        return [changed.alias(changed_col)] if changed_col else []

    keyless = target.filter(any_null(keys))
    marked = clauses.is_dealt()
    dealt = clauses.deal(keyless.select("*", *told(marked))) if clauses.touches_orphans else (
        keyless.select("*", *told(F.lit(False)))
    )
    added = updates.filter(any_null(keys)).select("*", *told(F.lit(True)))
    changed = (is_new & (~was_there | applies)) | is_dealt
    merged = joined.select(*(column(c) for c in target.columns), *told(changed))
    return merged.unionByName(dealt).unionByName(added)


def _merge_into(
    table: str,
    updates: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None,
    clauses: Clauses = PLAIN,
) -> None:
    set_cols = [c for c in updates.columns if c not in keys] if update_cols is None else update_cols

    def old(name: str) -> Column:
        return F.col(f"{table}.`{name}`")

    def new(name: str) -> Column:
        return F.col(f"updates.`{name}`")

    same_key = reduce(and_, (old(k) == new(k) for k in keys))
    merge = updates.alias("updates").mergeInto(table, same_key)
    matched = merge.whenMatched() if clauses.update_if is None else merge.whenMatched(
        clauses.applies(old, new)
    )
    merge = matched.update({c: new(c) for c in set_cols})
    merge = merge.whenNotMatched().insert({c: new(c) for c in updates.columns})
    if clauses.deletes:
        merge = merge.whenNotMatchedBySource(clauses.is_dealt(old)).delete()
    elif clauses.marks:
        merge = merge.whenNotMatchedBySource(clauses.is_dealt(old)).update(clauses.marks)
    merge.merge()
