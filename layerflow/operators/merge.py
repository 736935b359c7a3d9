"""Keyed upsert as a pure function of two frames."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_
from typing import Literal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerflow.functions import any_null


class Side:
    """The columns of one row of a match, by name: ``old("status")``; ``used`` tells which."""

    def __init__(self, column: Callable[[str], Column] = F.col):
        self._column = column
        self.used: set[str] = set()

    def __call__(self, name: str) -> Column:
        self.used.add(name)
        return self._column(name)


@dataclass(frozen=True)
class Clauses:
    """What a merge does besides overwriting matches and inserting the rest.

    ``update_if(old, new)``: a match is updated only where this condition on the stored row and
    its update is true, and stays as it is where it is false or null.

    ``orphans``: stored rows that no update matches are kept, are deleted, or take the given
    values in the named columns, such as ``{"is_deleted": F.lit(True)}``. ``orphan_if(old)`` limits
    that to some of them. A stored row with a null key is always one that nothing matches.
    """

    update_if: Callable[[Side, Side], Column] | None = None
    orphans: Literal["keep", "delete"] | Mapping[str, Column] = "keep"
    orphan_if: Callable[[Side], Column] | None = None

    def __post_init__(self) -> None:
        if isinstance(self.orphans, str) and self.orphans not in ("keep", "delete"):
            raise ValueError(f"orphans: {self.orphans!r}")

    @property
    def deletes(self) -> bool:
        return isinstance(self.orphans, str) and self.orphans == "delete"

    @property
    def marks(self) -> dict[str, Column]:
        return {} if isinstance(self.orphans, str) else dict(self.orphans)

    @property
    def is_plain(self) -> bool:
        return self.update_if is None and not self.touches_orphans

    @property
    def touches_orphans(self) -> bool:
        return self.deletes or bool(self.marks)

    def check(self, columns: Sequence[str], keys: Sequence[str]) -> None:
        wrong = [c for c in self.marks if c in keys or c not in columns]
        if wrong:
            raise ValueError(f"orphans cannot be marked in {wrong}")

    def old_columns(self) -> set[str]:
        """Columns of the stored row that the conditions read."""
        old = Side()
        if self.update_if is not None:
            self.update_if(old, Side())
        if self.orphan_if is not None:
            self.orphan_if(old)
        return old.used

    def applies(self, old: Callable[[str], Column], new: Callable[[str], Column]) -> Column:
        """Is a matched row updated? Never null."""
        if self.update_if is None:
            return F.lit(True)
        return F.coalesce(self.update_if(Side(old), Side(new)), F.lit(False))

    def is_dealt(self, old: Callable[[str], Column] = F.col) -> Column:
        """Is a stored row without a match deleted, or marked as it is not yet? Never null."""
        if not self.touches_orphans:
            return F.lit(False)
        chosen = F.lit(True)
        if self.orphan_if is not None:
            chosen = F.coalesce(self.orphan_if(Side(old)), F.lit(False))
        if self.marks:
            unlike = (~old(c).eqNullSafe(value) for c, value in self.marks.items())
            chosen = chosen & reduce(or_, unlike)
        return chosen

    def deal(self, orphans: DataFrame) -> DataFrame:
        """Rows that no update matches, after the clause."""
        if self.deletes:
            return orphans.filter(~self.is_dealt())
        dealt = self.is_dealt()
        return orphans.select(
            *(
                F.when(dealt, self.marks[c]).otherwise(F.col(c)).alias(c) if c in self.marks else F.col(c)
                for c in orphans.columns
            )
        )


PLAIN = Clauses()


def newer(column: str) -> Callable[[Side, Side], Column]:
    """Condition for ``Clauses``: the update's ``column`` is later; a stored null is earlier than all."""
    return lambda old, new: (new(column) > old(column)) | (
        old(column).isNull() & new(column).isNotNull()
    )


def differs(columns: Sequence[str]) -> Callable[[Side, Side], Column]:
    """Condition for ``Clauses``: some of ``columns`` has another value; nulls are equal."""
    return lambda old, new: reduce(or_, (~old(c).eqNullSafe(new(c)) for c in columns))


# What a stored column's type may become, by the readers of file tables: no value changes.
_WIDER = {
    "tinyint": ("smallint", "int", "bigint", "double"),
    "smallint": ("int", "bigint", "double"),
    "int": ("bigint", "double"),
    "float": ("double",),
    "date": ("timestamp_ntz",),
}


def _is_wider(kind: T.DataType, than: T.DataType) -> bool:
    if isinstance(kind, T.DecimalType) and isinstance(than, T.DecimalType):
        more = kind.scale - than.scale
        return more >= 0 and kind.precision - than.precision >= more
    return kind.simpleString() in _WIDER.get(than.simpleString(), ())


def evolved_schema(
    stored: T.StructType, given: T.StructType, keys: Sequence[str]
) -> T.StructType:
    """``stored`` with the further columns of ``given`` at its end, and the wider type of each.

    Keys keep their type, by whose hash rows are laid out. Types of which neither holds all
    values of the other are refused.
    """
    kinds = {f.name: f.dataType for f in given}
    fields = []
    for f in stored:
        kind = kinds.pop(f.name, f.dataType)
        if kind != f.dataType and not _is_wider(f.dataType, kind):
            if f.name in keys or not _is_wider(kind, f.dataType):
                shown = f"{f.dataType.simpleString()} to {kind.simpleString()}"
                raise ValueError(f"{f.name} cannot go from {shown}")
            fields.append(T.StructField(f.name, kind, True, f.metadata))
        else:
            fields.append(T.StructField(f.name, f.dataType, True, f.metadata))
    return T.StructType(fields + [T.StructField(c, kind) for c, kind in kinds.items()])


def align_updates(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``updates`` in the target's column order and types; columns it lacks become null."""
    missing = [k for k in keys if k not in updates.columns or k not in target.columns]
    unknown = [c for c in updates.columns if c not in target.columns]
    if missing or unknown:
        raise ValueError(f"key columns not on both sides: {missing}; not in target: {unknown}")
    given = {f.name: f.dataType for f in updates.schema}

    def column(name: str, kind) -> Column:
        if name not in given:
            return F.lit(None).cast(kind).alias(name)
        if name in keys and given[name] != kind:
            return _same_value(name, given[name], kind).alias(name)
        return F.col(name) if given[name] == kind else F.col(name).cast(kind).alias(name)

    return updates.select(*(column(f.name, f.dataType) for f in target.schema))


def _same_value(key: str, given, kind) -> Column:
    """A key in the target's type; fails the query where that type cannot hold its value."""
    there = F.col(key).try_cast(kind)
    kept = F.coalesce(there.try_cast(given) == F.col(key), F.lit(False))
    error = F.raise_error(
        F.concat(F.lit(f"{key}: not a {kind.simpleString()}: "), F.col(key).cast("string"))
    )
    return F.when(F.col(key).isNull() | kept, there).otherwise(error.cast(kind))


def updated_columns(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], update_cols: Sequence[str] | None
) -> list[str]:
    """The columns a match overwrites: by default all that ``updates`` has, but the key."""
    if update_cols is None:
        update_cols = [c for c in updates.columns if c not in keys]
    wrong = [c for c in update_cols if c in keys or c not in updates.columns]
    if wrong:
        raise ValueError(f"not updatable: {wrong}")
    return [c for c in target.columns if c in update_cols]


def duplicate_key_error(keys: Sequence[str], side: str) -> Column:
    """Fails the query, naming the key."""
    shown = F.concat_ws(", ", *(F.col(k).cast("string") for k in keys))
    return F.raise_error(F.concat(F.lit(f"{side}: more than one row with key ("), shown, F.lit(")")))


def _overwrite(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], update_cols: Sequence[str]
) -> DataFrame:
    """``target`` with ``update_cols`` taken from the update of the same key, if there is one."""
    new = updates.select(*keys, F.struct(*update_cols).alias("_new"))
    is_matched = F.col("_new").isNotNull()
    return target.join(new, keys, "left").select(
        *(
            F.when(is_matched, F.col("_new")[c]).otherwise(F.col(c)).alias(c)
            if c in update_cols
            else F.col(c)
            for c in target.columns
        )
    )


def merge_tagged(
    both: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str],
    update_cols: Sequence[str],
    laid_out_by: Sequence[str] = (),
    other_error: Column | None = None,
    clauses: Clauses = PLAIN,
    orphans_tagged: bool = False,
) -> DataFrame:
    """One row per key of stored rows (``_is_update`` 0) and updates (1), in one exchange and sort.

    In key order the stored row comes just before its update, so looking one row ahead
    tells that it is superseded, and one row back finds the values that it passes on. A key that
    occurs twice on either side fails the query. ``laid_out_by`` goes before the key, for rows
    that lie by it already; ``columns`` are those of the result.

    The clauses ride on the same sort. A stored row that nothing follows is an orphan; with
    ``orphans_tagged`` it is one only if a row of its key, tagged 2, says so.
    """
    pair = Window.partitionBy(*laid_out_by, *keys).orderBy("_is_update")
    added = {"_follower": F.lead("_is_update").over(pair)}
    placed = [*keys, *laid_out_by]
    passed_on = [c for c in columns if c not in update_cols and c not in placed]
    if clauses.update_if is not None or (orphans_tagged and clauses.marks):
        carried = [c for c in columns if c not in placed]
    else:
        carried = passed_on
    if carried:
        added["_old"] = F.lag(F.struct(*carried)).over(pair)
    paired = both.withColumns(added)

    tag, follower = F.col("_is_update"), F.col("_follower")
    # The error must depend on the window: one on the updates' columns alone would be
    # pushed into the updates, and raised for rows that some filter there drops.
    error = F.when((tag == 1) & (follower == 1), duplicate_key_error(keys, "updates")).when(
        (tag == 0) & (follower == 0), duplicate_key_error(keys, "table")
    )
    if other_error is not None:
        error = error.otherwise(other_error)
    last = paired.filter(error.isNull() & follower.isNull())

    def old(name: str) -> Column:
        return F.col(name) if name in placed else F.col("_old")[name]

    is_orphan = tag == 2 if orphans_tagged else (tag == 0) & clauses.is_dealt()
    if clauses.deletes:
        last = last.filter(~is_orphan)
    has_old = (tag > 0) & F.col("_old").isNotNull() if carried else F.lit(False)
    stays = has_old & ((tag == 2) | ~clauses.applies(old, F.col))

    def column(name: str) -> Column:
        value = F.col(name)
        if name in passed_on:
            value = F.when(has_old, old(name)).otherwise(value)
        elif name in carried:
            value = F.when(stays, old(name)).otherwise(value)
        if name in clauses.marks:
            value = F.when(is_orphan, clauses.marks[name]).otherwise(value)
        return value.alias(name)

    return last.select(*(column(c) for c in columns))


def merge_upsert(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
    *,
    unique_target: bool = True,
    unique_updates: bool = False,
    clauses: Clauses = PLAIN,
) -> DataFrame:
    """``target`` after matched rows take ``update_cols`` from ``updates`` and the rest is inserted.

    Target rows without a match stay. A key with a null part matches nothing, so such
    updates are inserted. Two updates with one key fail the query when it runs. ``clauses`` make
    updates conditional and say what becomes of target rows without a match; they need
    ``unique_target`` and take the default plan.

    Plans:

    - default: the target has one row per key, or the query fails. Both sides are united, pass
      one exchange on the key and one sort, which also prove both sides' keys unique.
    - ``unique_updates``, with all columns overwritten: the caller has made sure of both sides.
      Target anti join update keys, then the updates as they are, which are not shuffled; nor is
      the target, if Spark finds the keys small enough to broadcast.
    - ``unique_target=False``: many target rows may share a key, and each of them is updated.
      Target left join updates, plus updates anti join matched keys. The many side is the left
      one, which adaptive execution can split where a key is hot.

    Rows with null keys bypass every exchange. Both inputs are read twice or more: store
    what is costly to derive and pass the table.
    """
    keys = list(keys)
    update_cols = updated_columns(target, updates, keys, update_cols)
    clauses.check(target.columns, keys)
    if not (clauses.is_plain or unique_target):
        raise ValueError("clauses need one target row per key")
    complete = len(update_cols) + len(keys) == len(target.columns)
    updates = align_updates(target, updates, keys)
    keyed = updates.filter(~any_null(keys))
    present, keyless = target.filter(~any_null(keys)), target.filter(any_null(keys))

    if unique_target and unique_updates and complete and clauses.is_plain:
        merged = present.join(keyed.select(*keys), keys, "left_anti").select(*target.columns)
        return merged.unionByName(updates).unionByName(keyless)
    if clauses.touches_orphans:
        keyless = clauses.deal(keyless)
    loose = keyless.unionByName(updates.filter(any_null(keys)))
    if unique_target:
        both = present.withColumn("_is_update", F.lit(0)).unionByName(
            keyed.withColumn("_is_update", F.lit(1))
        )
        merged = merge_tagged(both, target.columns, keys, update_cols, clauses=clauses)
        return merged.unionByName(loose)

    matched = _overwrite(present, keyed, keys, update_cols) if update_cols else present
    # distinct combines copies of a hot key before its exchange
    known = present.select(*keys).distinct()
    inserted = keyed.join(known, keys, "left_anti").select(*target.columns)
    merged = matched.select(*target.columns).unionByName(inserted).unionByName(loose)
    return merged if unique_updates else merged.unionByName(_guard(keyed, keys))


def _guard(updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """No rows, but an error where two updates have one key.

    A branch of its own: a check below the join would keep adaptive execution from splitting a
    hot key there.
    """
    counted = updates.groupBy(*keys).agg(F.count("*").alias("_n"))
    error = duplicate_key_error(keys, "updates")
    return counted.filter(F.when(F.col("_n") > 1, error).isNotNull()).select(
        *(
            F.col(f.name) if f.name in keys else F.lit(None).cast(f.dataType).alias(f.name)
            for f in updates.schema
        )
    )
