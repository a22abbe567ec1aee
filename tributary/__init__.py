"""Turns paged, nested API extracts into typed tables, on Spark."""

from tributary.errors import ExtractError
from tributary.session import prepare, staging_scope
from tributary.spec import Table, TableSpec

__all__ = ["ExtractError", "Table", "TableSpec", "prepare", "staging_scope"]
