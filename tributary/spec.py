"""Table metadata that travels next to a DataFrame."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The four base types a manifest knows.
BASE_TYPES = ("string", "integer", "numeric", "boolean")

SPARK_TYPE = {"boolean": "boolean", "integer": "bigint", "numeric": "double", "string": "string"}


@dataclass(frozen=True)
class TableSpec:
    """Name, keys and load mode of one output table; ``types`` maps a column to its base type."""

    name: str
    primary_key: tuple[str, ...] = ()
    incremental: bool = False
    types: dict[str, str] = field(default_factory=dict)


class Table(NamedTuple):
    df: DataFrame
    spec: TableSpec


def base_type(data_type: T.DataType) -> str:
    """Base type of a physical column; everything that is not a bool or a number is text."""
    if isinstance(data_type, T.BooleanType):
        return "boolean"
    if isinstance(data_type, T.IntegralType):
        return "integer"
    if isinstance(data_type, (T.FractionalType, T.DecimalType)):
        return "numeric"
    return "string"


def column_base_types(df: DataFrame, spec: TableSpec) -> dict[str, str]:
    """Declared types first, the physical schema for the rest; an unknown declaration is text."""
    declared = {k: v if v in BASE_TYPES else "string" for k, v in spec.types.items()}
    return {f.name: declared.get(f.name, base_type(f.dataType)) for f in df.schema.fields}
