"""CSV tables with a typed manifest."""

from __future__ import annotations

import json
import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.operators.keys import require_key_columns, require_table_name
from tributary.sinks.files import replace_text
from tributary.sinks.tables import zero_row_table
from tributary.spec import Table, TableSpec, column_base_types

log = logging.getLogger(__name__)


def csv_columns(df: DataFrame, compat: bool = False) -> DataFrame:
    """Columns as CSV can hold them: containers as JSON text, everything else as it prints.

    Doubles are written in plain digits from 1e-4 up to 1e16, beyond that as ``1e+16``.

    ``compat`` writes booleans as ``True`` and ``False``.
    """

    def column(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
            return F.to_json(value).alias(field.name)
        if compat and isinstance(field.dataType, T.BooleanType):
            return F.initcap(value.cast("string")).alias(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return _plain_digits(value).alias(field.name)
        return value

    return df.select(*[column(f) for f in df.schema.fields])


def _plain_digits(value: Column) -> Column:
    text, size = value.cast("string"), F.abs(value.cast("double"))
    plain = F.regexp_replace(text.try_cast("decimal(38,21)").cast("string"), r"(\.\d+?)0+$", "$1")
    parts = F.split(text, "E")
    power = F.get(parts, F.lit(1)).cast("int")
    sign = F.when(power < 0, "e-").otherwise("e+")
    short = F.concat(F.regexp_replace(F.get(parts, F.lit(0)), r"\.0$", ""), sign, F.lpad(F.abs(power).cast("string"), F.greatest(F.lit(2), F.length(F.abs(power).cast("string"))), F.lit("0")))
    return F.when(~text.contains("E"), text).when((size >= 1e-4) & (size < 1e16), plain).otherwise(short)


def manifest(df: DataFrame, spec: TableSpec) -> dict:
    """Manifest of a table: load mode, file format, and per column name, base type and key flag."""
    types = column_base_types(df, spec)
    schema = []
    for name in df.columns:
        entry: dict = {"name": name, "data_type": {"base": {"type": types[name].upper()}}, "nullable": True}
        if name in spec.primary_key:
            entry["primary_key"] = True
        schema.append(entry)
    return {
        "incremental": spec.incremental,
        "write_always": False,
        "delimiter": ",",
        "enclosure": '"',
        "manifest_type": "out",
        "has_header": True,
        "schema": schema,
    }


def manifest_rows(df: DataFrame, spec: TableSpec) -> list[tuple[int, str, str, bool, bool]]:
    """The same as rows ``position, name, type, nullable, primary_key``."""
    return [
        (i, c["name"], c["data_type"]["base"]["type"], c["nullable"], c.get("primary_key", False))
        for i, c in enumerate(manifest(df, spec)["schema"])
    ]


def write_csv(table: Table, folder: str, *, compat: bool = False) -> str | None:
    """Write ``<folder>/<name>.csv`` (a folder of part files, each with a header) and its manifest.

    Without columns, the key columns make a header-only table; without those there is nothing to write.
    """
    df, spec = table
    require_table_name(spec.name)
    if not df.columns:
        empty = zero_row_table(df.sparkSession, spec)
        if empty is None:
            log.warning("table '%s' has no rows and no known columns; nothing is written", spec.name)
            return None
        df = empty
    require_key_columns(df.columns, spec.primary_key, spec.name)
    path = f"{folder}/{spec.name}.csv"
    writer = csv_columns(df, compat).write.mode("overwrite")
    writer.options(header=True, sep=",", quote='"', escape='"', nullValue="", emptyValue="", encoding="UTF-8").csv(path)
    replace_text(df.sparkSession, f"{path}.manifest", json.dumps(manifest(df, spec)))
    return path
