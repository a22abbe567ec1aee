"""Whole extractions: landed pages in, tables with their specs out.

Every function returns ``{table name: Table(df, spec)}``; write them with ``sinks``. Data stays in lazy
DataFrames. What reaches the driver is one profile per table (a row per column).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.errors import ExtractError
from tributary.functions.names import child_names, default_table_name
from tributary.operators.infer import collect_profile, profile, to_columns, typed_texts
from tributary.operators.keys import (
    child_primary_key,
    require_arguments,
    require_key_columns,
    require_key_for_incremental,
    require_table_name,
)
from tributary.operators.resolve import resolve_details
from tributary.operators.shape import child_documents, child_rows, flatten, narrow_ordinals, parent_rows, parsed, split_keys, sublist_items
from tributary.plans.sqlmode import run_query
from tributary.session import stage
from tributary.sinks.tables import zero_row_table
from tributary.sources.pages import rows_at_path
from tributary.sources.search_xml import search_rows
from tributary.spec import Table, TableSpec, base_type

BATCH_COLUMNS = ("page_no", "ordinal")


def _guard(name: str, primary_key: Sequence[str], incremental: bool) -> None:
    require_table_name(name)
    require_key_for_incremental(incremental, primary_key)


def _table(df: DataFrame, types: dict[str, str], name: str, primary_key: Sequence[str], incremental: bool) -> Table:
    spellings = Counter(c.lower() for c in df.columns)
    clashes = [c for c in df.columns if spellings[c.lower()] > 1]
    folded = df.sparkSession.conf.get("spark.sql.caseSensitive") != "true"
    if (clashes and folded) or len(set(df.columns)) < len(df.columns):
        raise ExtractError(f"table '{name}' would have columns that are told apart by case only, or not at all: {clashes}")
    spec = TableSpec(name, tuple(primary_key), incremental, types)
    if not [c for c in df.columns if c not in BATCH_COLUMNS]:
        empty = zero_row_table(df.sparkSession, spec)
        return Table(empty if empty is not None else df, spec)
    require_key_columns(df.columns, primary_key, name)
    return Table(df, spec)


def extract_records(
    collection: DataFrame,
    details: DataFrame | None = None,
    *,
    record_type: str,
    fields: Sequence[str] = (),
    primary_key: Sequence[str] = (),
    incremental: bool = False,
    child_tables: bool = False,
    table_name: str = "",
    types: str = "widen",
    keep_order: bool = False,
) -> dict[str, Table]:
    """Record mode: collection rows, their documents, and one flat table or a parent with child tables.

    ``details=None`` takes the collection rows as documents. ``keep_order`` adds ``page_no`` and
    ``ordinal`` to the parent and ``ordinal`` to the child tables, for in-batch de-duplication.
    """
    require_arguments("record", record_type=record_type)
    _guard(table_name, primary_key, incremental)
    name = table_name or default_table_name("record", record_type=record_type)
    resolved = collection if details is None else resolve_details(collection, details)
    # Staged once: the profile and every table read the joined, stripped text from here.
    texts = stage(parsed(resolved.select("page_no", "ordinal", "raw")).drop("doc"), "records")
    documents = texts.withColumn("doc", F.parse_json("raw"))
    found = collect_profile(profile(documents))
    keep = list(BATCH_COLUMNS) if keep_order else []
    if not child_tables:
        df, declared = flatten(documents, found, fields, primary_key, types, keep)
        return {name: _table(df, declared, name, primary_key, incremental)}

    df, declared = parent_rows(documents, found, fields, primary_key, types, keep)
    tables = {name: _table(df, declared, name, primary_key, incremental)}
    sublists = split_keys(found, fields)
    names = child_names(name, sublists)
    if not sublists:
        return tables
    # One parse lands all sublists side by side; each child table then reads its own column only.
    items = stage(sublist_items(documents, sublists), "sublists")
    for position, sublist in enumerate(sublists):
        lines = child_documents(items, position)
        line_profile = collect_profile(profile(narrow_ordinals(items, lines)))
        if not line_profile.n_rows:
            continue
        key = child_primary_key(line_profile, sublist, incremental)
        parent_type = found["id"].type(types) if "id" in found else "string"
        rows, child_types = child_rows(lines, line_profile, types, ["ordinal"] if keep_order else [], parent_type)
        tables[names[sublist]] = _table(rows, child_types, names[sublist], key, incremental)
    return tables


def extract_pages(
    rows: DataFrame,
    *,
    table_name: str,
    primary_key: Sequence[str] = (),
    incremental: bool = False,
    types: str = "widen",
    sample: int | None = None,
    keep_order: bool = False,
    columns: Mapping[str, str] | None = None,
) -> dict[str, Table]:
    """Bronze rows of a SQL result or a custom endpoint as one table; navigation keys stay.

    Pages are read once: rows are staged before their columns are found. With ``columns`` (base type by name, in order)
    nothing is looked for and nothing staged; keys that are not among them are left out.
    ``sample`` bounds the rows the columns are read from, for parity checks; it never drops rows.
    """
    _guard(table_name, primary_key, incremental)
    if columns is not None:
        declared = physical = dict(columns)
    else:
        rows = stage(rows.drop("doc"), "pages").withColumn("doc", F.parse_json("raw"))
        declared = collect_profile(profile(rows, sample=sample)).types(types)
        physical = declared if types == "widen" and sample is None else {}
    df = to_columns(rows, list(declared), physical, BATCH_COLUMNS if keep_order else ())
    return {table_name: _table(df, declared, table_name, primary_key, incremental)}


def extract_endpoint(
    pages: DataFrame, *, script_id: str, deploy_id: str, record_path: str = "", table_name: str = "", page_no: str = "page_no", raw: str = "raw", **options
) -> dict[str, Table]:
    """Pages of a custom endpoint (``page_no, raw``) as one table; see ``extract_pages`` for the options."""
    require_arguments("endpoint", script_id=script_id, deploy_id=deploy_id)
    name = table_name or default_table_name("endpoint", script_id=script_id)
    return extract_pages(rows_at_path(pages, record_path, page_no=page_no, raw=raw), table_name=name, **options)


def extract_search(
    pages: DataFrame,
    *,
    search_id: str,
    search_record_type: str,
    table_name: str = "",
    primary_key: Sequence[str] = (),
    incremental: bool = False,
    keep_order: bool = False,
    types: str = "widen",
) -> dict[str, Table]:
    """Saved-search result pages as one table.

    Columns of whole numbers, numbers or truth values throughout become such; ``types="text"`` leaves all as text.
    """
    require_arguments("saved_search", saved_search_id=search_id, search_record_type=search_record_type)
    _guard(table_name, primary_key, incremental)
    name = table_name or default_table_name("saved_search", search_id=search_id)
    rows = search_rows(pages)
    if types == "widen":
        rows = typed_texts(stage(rows, "search"), BATCH_COLUMNS)
    df = rows if keep_order else rows.drop(*BATCH_COLUMNS)
    types = {f.name: base_type(f.dataType) for f in df.schema.fields if f.name not in BATCH_COLUMNS}
    return {name: _table(df, types, name, primary_key, incremental)}


def extract_sql(
    spark: SparkSession,
    query: str,
    date_from: str = "",
    date_to: str = "now",
    *,
    as_of: datetime | None = None,
    table_name: str = "",
    primary_key: Sequence[str] = (),
    incremental: bool = False,
) -> dict[str, Table]:
    """SQL mode over registered tables."""
    require_arguments("sql", query=query)
    _guard(table_name, primary_key, incremental)
    name = table_name or default_table_name("sql")
    df = run_query(spark, query, date_from, date_to, as_of=as_of)
    types = {f.name: base_type(f.dataType) for f in df.schema.fields}
    return {name: _table(df, types, name, primary_key, incremental)}
