"""Expressions over (possibly composite) row keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_null(keys: Sequence[str]) -> Column:
    """True when the key has a null part, so that it can equal no other key."""
    return reduce(or_, (F.col(k).isNull() for k in keys))


def key_hash(keys: Sequence[str]) -> Column:
    """64-bit hash of the key; the same for equal keys of the same types only."""
    return F.xxhash64(*(F.col(k) for k in keys))
