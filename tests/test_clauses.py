"""Conditional merges and merges that leave unchanged rows alone."""

import os
import re

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from layerflow import (
    Clauses,
    Upserted,
    differs,
    merge_upsert,
    newer,
    read_table,
    rebucket,
    upsert_bucketed_table,
    upsert_table,
)
from layerflow.sinks import upsert as upsert_module
from layerflow.sources.tables import DIGEST_COLUMN, entry_names
from test_merge import QUICK, frame, rows

SCHEMA = "k int, version int, value string, seen int"
LATER = newer("version")


def brute(target, updates, clauses="", compare=(1, 2)):
    """Rows are (k, version, value, seen); clauses is any of "newer", "delete", "mark", "changed"."""
    new = {u[0]: u for u in updates if u[0] is not None}
    known = {t[0] for t in target if t[0] is not None}
    out = []
    for t in target:
        u = new.get(t[0]) if t[0] is not None else None
        if u is None:
            if "delete" in clauses:
                continue
            out.append((*t[:3], -1) if "mark" in clauses else t)
            continue
        applies = True
        if "newer" in clauses:
            applies = u[1] is not None and (t[1] is None or u[1] > t[1])
        if "changed" in clauses and all(t[c] == u[c] for c in compare):
            applies = False
        out.append(u if applies else t)
    return sorted(out + [u for u in updates if u[0] is None or u[0] not in known], key=repr)


def made(clauses):
    orphans = "delete" if "delete" in clauses else "keep"
    if "mark" in clauses:
        orphans = {"seen": F.lit(-1)}
    return Clauses(LATER if "newer" in clauses else None, orphans)


maybe = st.one_of(st.none(), st.integers(0, 3))
row = st.tuples(maybe, maybe, st.sampled_from([None, "a", "b"]), st.integers(0, 1))


def unique(data):
    found, out = set(), []
    for r in data:
        if r[0] is None or r[0] not in found:
            found.add(r[0])
            out.append(r)
    return out


KINDS = ["newer", "delete", "mark", "newer delete", "newer mark"]


@pytest.mark.parametrize("clauses", KINDS)
@QUICK
@given(st.lists(row, max_size=6), st.lists(row, max_size=6))
def test_pure_merge(spark, clauses, target, updates):
    target, updates = unique(target), unique(updates)
    got = merge_upsert(
        frame(spark, target, SCHEMA), frame(spark, updates, SCHEMA), ["k"], clauses=made(clauses)
    )
    assert rows(got) == brute(target, updates, clauses)


TARGET = [(1, 1, "a", 0), (2, 2, "b", 0), (3, None, "c", 0), (4, 4, None, 0), (None, 5, "z", 0)]
UPDATES = [(1, 1, "a", 1), (2, 1, "x", 1), (3, 1, "c", 1), (5, 5, "e", 1), (4, 4, None, 1)]


@pytest.mark.parametrize("clauses", [*KINDS, "changed", "changed newer", "changed mark"])
@pytest.mark.parametrize("updates", [UPDATES, [], [(None, 1, "n", 1)], TARGET[:2]])
@pytest.mark.parametrize("digest", [True, False])
def test_path_table(spark, tmp_path, clauses, updates, digest):
    path, compare = f"{tmp_path}/gold", ["version", "value"]
    options = {"buckets": 3, "compare_cols": compare if digest else None}
    upsert_table(spark, path, frame(spark, TARGET, SCHEMA), ["k"], **options)
    assert (DIGEST_COLUMN in spark.read.parquet(path).columns) == digest
    compare_cols = compare if "changed" in clauses else None
    upsert_table(
        spark,
        path,
        frame(spark, updates, SCHEMA),
        ["k"],
        compare_cols=compare_cols,
        clauses=made(clauses),
    )
    got = read_table(spark, path)
    assert got.columns == ["k", "version", "value", "seen"]
    assert rows(got) == brute(TARGET, updates, clauses)


@pytest.mark.parametrize("clauses", [*KINDS, "changed", "changed newer", "changed mark"])
@pytest.mark.parametrize("updates", [UPDATES, [], [(None, 1, "n", 1)]])
def test_bucketed_table(spark, tmp_path, clauses, updates):
    table = f"t{abs(hash((str(tmp_path), clauses)))}"
    folder = f"{tmp_path}/gold"
    upsert_bucketed_table(spark, table, folder, frame(spark, TARGET, SCHEMA), ["k"], buckets=3)
    upsert_bucketed_table(
        spark,
        table,
        folder,
        frame(spark, updates, SCHEMA),
        ["k"],
        compare_cols=["version", "value"] if "changed" in clauses else None,
        clauses=made(clauses),
    )
    assert rows(spark.table(table)) == brute(TARGET, updates, clauses)
    spark.sql(f"DROP TABLE {table}")


def files(path):
    return sorted(
        os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")
    )


def test_nothing_new_replaces_nothing(spark, tmp_path):
    path = f"{tmp_path}/gold"
    data = [(k, k, f"v{k}", 0) for k in range(200)]
    options = {"buckets": 16, "compare_cols": ["version", "value"]}
    first = upsert_table(spark, path, frame(spark, data, SCHEMA), ["k"], **options)
    assert len(first.buckets) == 16 and first.wrote
    before = files(path)
    again = frame(spark, [(k, v, x, 1) for k, v, x, _ in data], SCHEMA)
    assert upsert_table(spark, path, again, ["k"], **options) == Upserted(wrote=False)
    assert files(path) == before and rows(read_table(spark, path)) == rows(frame(spark, data, SCHEMA))

    one = again.withColumn("value", F.when(F.col("k") == 7, None).otherwise(F.col("value")))
    third = upsert_table(spark, path, one, ["k"], **options)
    assert len(third.buckets) == 1
    assert len(set(before) - set(files(path))) == len(set(files(path)) - set(before)) == 1
    changed = [r for r in read_table(spark, path).collect() if r.seen == 1]
    assert [tuple(r) for r in changed] == [(7, 7, None, 1)]  # null is told from a value


def test_only_keys_and_digest_are_read_first(spark, tmp_path):
    path, compare = f"{tmp_path}/gold", ["version", "value"]
    target = frame(spark, TARGET, SCHEMA)
    upsert_table(spark, path, target, ["k"], buckets=2, compare_cols=compare)
    stored = spark.read.parquet(path)
    bucket = next(c for c in stored.columns if c.startswith("bucket_of"))
    updates = frame(spark, UPDATES, SCHEMA).withColumn(bucket, F.lit(0))
    changes = upsert_module._changes(
        stored, updates, ["k"], bucket, compare, compare, Clauses()
    )
    plan = changes._jdf.queryExecution().toString()
    read = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert read and all(r == f"k:int,{DIGEST_COLUMN}:bigint" for r in read)
    assert len(re.findall("Exchange hashpartitioning", plan)) == 1


def test_clauses_keep_one_exchange(spark):
    clauses = Clauses(LATER, "delete")
    merged = merge_upsert(
        frame(spark, TARGET, SCHEMA), frame(spark, UPDATES, SCHEMA), ["k"], clauses=clauses
    )
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("Exchange hashpartitioning", plan)) == 1
    assert "Join" not in plan


def test_a_digest_survives_rebucket_and_plain_merges(spark, tmp_path):
    old, new, compare = f"{tmp_path}/old", f"{tmp_path}/new", ["version", "value"]
    target = frame(spark, TARGET, SCHEMA)
    upsert_table(spark, old, target, ["k"], buckets=2, compare_cols=compare)
    rebucket(spark, old, new, ["k"], 5)
    assert upsert_module.digested_columns(spark.read.parquet(new)) == compare
    # a merge of one column alone brings the digest up to date
    part = frame(spark, [(1, "other")], "k int, value string")
    upsert_table(spark, new, part, ["k"], ["value"])
    same = frame(spark, [(1, 1, "other", 9), (2, 2, "b", 9)], SCHEMA)
    assert not upsert_table(spark, new, same, ["k"], compare_cols=compare).wrote
    # comparing other columns than those of the digest compares the values
    assert not upsert_table(spark, new, same, ["k"], compare_cols=["value"]).wrote
    assert upsert_table(spark, new, same, ["k"], compare_cols=["seen"]).wrote
    assert rows(read_table(spark, new))[0] == (1, 1, "other", 9)


def test_duplicates_among_unchanged_updates_fail(spark, tmp_path):
    path, compare = f"{tmp_path}/gold", ["version", "value"]
    upsert_table(spark, path, frame(spark, TARGET, SCHEMA), ["k"], buckets=2, compare_cols=compare)
    twice = frame(spark, [TARGET[0], TARGET[0]], SCHEMA)
    with pytest.raises(PySparkException, match="more than one row"):
        upsert_table(spark, path, twice, ["k"], compare_cols=compare)


def test_orphan_condition(spark):
    clauses = Clauses(orphans="delete", orphan_if=lambda old: old("version") > 1)
    got = merge_upsert(
        frame(spark, TARGET, SCHEMA), frame(spark, [], SCHEMA), ["k"], clauses=clauses
    )
    # a null condition spares the row
    assert rows(got) == sorted([TARGET[0], TARGET[2]], key=repr)


def test_wrong_clauses(spark, tmp_path):
    target = frame(spark, TARGET, SCHEMA)
    with pytest.raises(ValueError):
        Clauses(orphans="drop")
    for wrong in ({"k": F.lit(1)}, {"nowhere": F.lit(1)}):
        with pytest.raises(ValueError):
            merge_upsert(target, target, ["k"], clauses=Clauses(orphans=wrong))
    with pytest.raises(ValueError):
        merge_upsert(target, target, ["k"], unique_target=False, clauses=Clauses(LATER))
    with pytest.raises(ValueError):
        upsert_table(
            spark, f"{tmp_path}/t", target, ["k"], ["value"], buckets=1, compare_cols=["seen"]
        )


def test_differs_takes_nulls_for_equal(spark):
    got = merge_upsert(
        frame(spark, [(1, None, "a", 0), (2, None, "a", 0)], SCHEMA),
        frame(spark, [(1, None, "a", 1), (2, 1, "a", 1)], SCHEMA),
        ["k"],
        clauses=Clauses(differs(["version", "value"])),
    )
    assert rows(got) == [(1, None, "a", 0), (2, 1, "a", 1)]


def test_interleaved_bucketed_merges(spark, tmp_path, monkeypatch):
    """The second of two writers finds the table moved, fails, and leaves nothing behind."""
    table, folder = "two_writers", f"{tmp_path}/gold"
    upsert_bucketed_table(spark, table, folder, frame(spark, TARGET, SCHEMA), ["k"], buckets=2)
    merge, calls = upsert_module.merge_bucketed, []

    def slow_merge(*args, **options):
        if not calls:
            calls.append(1)
            other = frame(spark, [(9, 9, "i", 9)], SCHEMA)
            upsert_bucketed_table(spark, table, folder, other, ["k"])
        return merge(*args, **options)

    monkeypatch.setattr(upsert_module, "merge_bucketed", slow_merge)
    with pytest.raises(RuntimeError, match="another run"):
        upsert_bucketed_table(spark, table, folder, frame(spark, UPDATES, SCHEMA), ["k"])
    assert rows(spark.table(table)) == brute(TARGET, [(9, 9, "i", 9)])
    assert len(entry_names(spark, folder)) == 2  # the first folder and the other run's
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("two_w")] == [table]
    spark.sql(f"DROP TABLE {table}")


def test_nothing_new_keeps_the_bucketed_table(spark, tmp_path):
    table, folder = "nothing_new", f"{tmp_path}/gold"
    target = frame(spark, TARGET[:4], SCHEMA)
    upsert_bucketed_table(spark, table, folder, target, ["k"], buckets=2)
    again = target.withColumn("seen", F.lit(1))
    left = upsert_bucketed_table(
        spark, table, folder, again, ["k"], compare_cols=["version", "value"]
    )
    assert left is None and len(entry_names(spark, folder)) == 1
    assert rows(spark.table(table)) == rows(target)
    spark.sql(f"DROP TABLE {table}")
