"""Readers: JDBC tables, path tables, catalog tables, layer locations."""

from layerflow.sources.increment import Increment, changed_since, read_mark
from layerflow.sources.jdbc import JdbcSplit, JdbcTarget, read_jdbc
from layerflow.sources.layers import Layers
from layerflow.sources.tables import read_table, shared_folder, table_exists

__all__ = [
    "Increment",
    "JdbcSplit",
    "JdbcTarget",
    "Layers",
    "changed_since",
    "read_jdbc",
    "read_mark",
    "read_table",
    "shared_folder",
    "table_exists",
]
