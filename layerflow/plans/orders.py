"""The layered flow of an ``orders`` table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column

from layerflow.functions import Category, FixedDecimal, ParseTime
from layerflow.operators import Rule
from layerflow.plans.layers import TableSpec

# fixed values: column names, formats and messages of the orders contract
SOURCE_SYSTEM = "postgres_ecom"
SILVER_COLUMNS = (
    "order_id",
    "customer_id",
    "order_timestamp",
    "total_amount",
    "order_status",
    "silver_processed_at",
)
CONFORM = (
    ParseTime("order_timestamp", "created_at", "yyyy-MM-dd HH:mm:ss"),
    FixedDecimal("total_amount", "amount", 10, 2),
    Category("order_status", "status", "UNKNOWN"),
)
LATEST_BY = ("updated_at", "created_at", "amount", "customer_id", "status")
QUARANTINE_PREVIEW = ("order_id", "customer_id", "total_amount", "quarantine_reason")


def orders_rules(as_of: str | datetime | Column) -> list[Rule]:
    return [
        Rule.not_null("order_id", "Missing order_id"),
        Rule.not_null("customer_id", "Missing customer_id"),
        Rule.at_least("total_amount", 0, "Negative or null total_amount"),
        Rule.not_after("order_timestamp", as_of, "Invalid or future order_date"),
    ]


def orders_spec(as_of: str | datetime | Column) -> TableSpec:
    """Keys, types, rules and layer columns of ``orders``; later than ``as_of`` is "future"."""
    return TableSpec(
        keys=("order_id",),
        latest_by=LATEST_BY,
        conform=CONFORM,
        rules=tuple(orders_rules(as_of)),
        silver_columns=SILVER_COLUMNS,
        source_system=SOURCE_SYSTEM,
    )
