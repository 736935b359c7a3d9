"""Lazy ``DataFrame -> DataFrame`` operators of the layered flow."""

from layerflow.operators.bronze import add_audit_columns
from layerflow.operators.merge import Clauses, differs, merge_upsert, newer
from layerflow.operators.preview import preview
from layerflow.operators.quality import (
    Rule,
    classify,
    quality_counters,
    quality_report,
    split_by_quality,
)
from layerflow.operators.relational import ExistsIn, SetRule, ShareAtMost, UniqueBy
from layerflow.operators.silver import conform, dedupe_latest

__all__ = [
    "Clauses",
    "ExistsIn",
    "Rule",
    "SetRule",
    "ShareAtMost",
    "UniqueBy",
    "add_audit_columns",
    "classify",
    "conform",
    "dedupe_latest",
    "differs",
    "merge_upsert",
    "newer",
    "preview",
    "quality_counters",
    "quality_report",
    "split_by_quality",
]
