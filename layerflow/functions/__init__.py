"""Column-level building blocks: literals, conforming expressions, key tests."""

from layerflow.functions.conforming import Category, FixedDecimal, ParseTime
from layerflow.functions.keys import any_null, key_hash
from layerflow.functions.literals import timestamp_literal, utc_now

__all__ = [
    "Category",
    "FixedDecimal",
    "ParseTime",
    "any_null",
    "key_hash",
    "timestamp_literal",
    "utc_now",
]
