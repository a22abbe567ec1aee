"""Shaping of record documents into one flat table, or into a parent table and its child tables.

Input everywhere: ``ordinal, raw`` rows, one JSON document each. ``parsed`` strips navigation keys and
adds ``doc``; profiles come from ``infer``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.errors import ExtractError
from tributary.functions.jsontext import drop_followed_members, drop_last_members, get, is_array, is_object, is_object_list, is_sublist, path_of
from tributary.operators.infer import ColumnInfo, Profile, to_columns
from tributary.spec import SPARK_TYPE

# Navigation keys, and the column that points from a line to its record.
NAVIGATION_KEYS = ("links",)
PARENT_ID = "_parent_id"

PREVIEW_CHARS = 2000

# An array has fewer elements.
MOST_LINES = 1 << 31


def parsed(documents: DataFrame, strip: Sequence[str] = NAVIGATION_KEYS) -> DataFrame:
    """Documents without their navigation keys, at any depth, with ``doc`` parsed from what is left."""
    texts = documents.drop("doc")
    if strip:
        # Two steps rather than one expression, so that the second reads the first's result as a column.
        texts = texts.withColumn("raw", drop_followed_members("raw", strip)).withColumn("raw", drop_last_members("raw", strip))
    return texts.withColumn("doc", F.parse_json("raw"))


# ---- projection -------------------------------------------------------------------------------------


def projected(profile: Profile, fields: Sequence[str] = (), primary_key: Sequence[str] = (), inline_only: bool = False) -> list[ColumnInfo]:
    """Columns to emit, in order.

    No ``fields``: all columns as first seen. Otherwise the fields, then key columns not among them; a
    column counts from the first row that has it, and inside a row selection order holds.
    ``inline_only`` leaves out columns (and first sightings) that hold nothing but sublists.
    """
    first = (lambda c: c.first_inline) if inline_only else (lambda c: c.first_seen)
    columns = [c for c in profile.columns if first(c) is not None]
    if not fields:
        return sorted(columns, key=lambda c: (first(c), c.name))
    wanted = list(dict.fromkeys([*fields, *primary_key]))
    return sorted((c for c in columns if c.name in wanted), key=lambda c: (first(c)[0], wanted.index(c.name)))


def project(table: DataFrame, fields: Sequence[str] = (), primary_key: Sequence[str] = ()) -> DataFrame:
    """The same selection on a table that already has columns."""
    if not fields:
        return table
    wanted = dict.fromkeys([*fields, *primary_key])
    return table.select(*[c for c in wanted if c in table.columns])


# ---- flatten ----------------------------------------------------------------------------------------


def sublist_text(doc: str, name: str) -> Column:
    """A sublist as the JSON text of its items; any other value as its own text."""
    items = path_of(name, "items")
    wrapped = F.when(is_array(F.col(doc), items), get(doc, items, "string"))
    return F.coalesce(wrapped, get(doc, path_of(name), "string"))


def flatten(
    documents: DataFrame,
    profile: Profile,
    fields: Sequence[str] = (),
    primary_key: Sequence[str] = (),
    types: str = "widen",
    keep: Sequence[str] = (),
) -> tuple[DataFrame, dict[str, str]]:
    """One row per document. Sublists become JSON text, other containers too, scalars keep their type.

    ``types="widen"`` gives typed columns. ``types="first"`` declares the type of the first scalar; since
    later values may not fit it, the columns themselves stay text.
    """
    columns = projected(profile, fields, primary_key)
    declared = {c.name: c.type(types, sublist_text=True) for c in columns}
    selected = []
    for info in columns:
        if info.n_sublists:
            value = sublist_text("doc", info.name)
        else:
            value = get("doc", path_of(info.name), SPARK_TYPE[declared[info.name]] if types == "widen" else "string")
        selected.append(value.alias(info.name))
    return documents.select(*keep, *selected), declared


# ---- child tables -----------------------------------------------------------------------------------


def split_keys(profile: Profile, fields: Sequence[str] = ()) -> list[str]:
    """Keys that hold a sublist in at least one document; with ``fields``, only the selected ones."""
    return [c.name for c in profile.columns if c.n_sublists and (not fields or c.name in fields)]


def parent_rows(
    documents: DataFrame,
    profile: Profile,
    fields: Sequence[str] = (),
    primary_key: Sequence[str] = (),
    types: str = "widen",
    keep: Sequence[str] = (),
) -> tuple[DataFrame, dict[str, str]]:
    """The record without its sublists.

    The decision is made per value: where a key holds a sublist in some records and something else in
    others, the others keep it as a column.
    """
    split = set(split_keys(profile, fields))
    columns = projected(profile, fields, primary_key, inline_only=False)
    columns = [c for c in columns if c.name not in split or c.first_inline is not None]
    if split:
        order = {c.name: i for i, c in enumerate(projected(profile, fields, primary_key, inline_only=True))}
        columns.sort(key=lambda c: order.get(c.name, len(order)))
    declared = {c.name: c.type(types) for c in columns}
    selected = []
    for info in columns:
        value = get("doc", path_of(info.name), SPARK_TYPE[declared[info.name]] if types == "widen" else "string")
        if info.name in split:
            value = F.when(~F.coalesce(is_sublist(get("doc", path_of(info.name))), F.lit(False)), value)
        selected.append(value.alias(info.name))
    return documents.select(*keep, *selected), declared


def sublist_items(documents: DataFrame, sublists: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``ordinal, parent_id, items_0, items_1 ...``: the items of each sublist as ``array<string>`` of JSON texts.

    One text parse serves all sublists. NULL where the value is not a sublist.
    """
    schema = T.StructType([T.StructField(name, T.StringType()) for name in sublists])
    # Values are columns of their own, so that each is looked up once.
    values = [get("doc", path_of(name)).alias(f"value_{i}") for i, name in enumerate(sublists)]
    texts = documents.select(
        *keep, "ordinal", get("doc", "$.id", "string").alias("parent_id"), F.from_json("raw", schema).alias("texts"), *values
    )
    columns = []
    for i, name in enumerate(sublists):
        value, text = F.col(f"value_{i}"), F.col("texts").getField(name)
        wrapped = F.from_json(text, "items array<string>")["items"]
        items = F.when(is_array(value, path_of("items")), wrapped).when(is_object_list(value), F.from_json(text, "array<string>"))
        columns.append(items.alias(f"items_{i}"))
    return texts.select(*keep, "ordinal", "parent_id", *columns)


def narrow_ordinals(items: DataFrame, lines: DataFrame) -> DataFrame:
    """Lines of ``items`` with 64-bit ordinals, in the same order, where all of them fit. Smaller to compare than decimals."""
    if items.schema["ordinal"].dataType != T.LongType():
        return lines
    low, high = items.agg(F.min("ordinal"), F.max("ordinal")).first()
    if low is None or low < -MOST_LINES or high >= MOST_LINES:
        return lines
    return lines.withColumn("ordinal", F.col("ordinal").cast("bigint"))


def child_documents(items: DataFrame, position: int) -> DataFrame:
    """One row per line of the sublist at that position: ``ordinal, line_no, parent_id, raw, doc``.

    ``ordinal`` orders lines over all records (record, then line), as the column union needs it. It is a decimal, wide
    enough for any record's ordinal and any number of lines.
    """
    rows = items.select("ordinal", "parent_id", F.posexplode(f"items_{position}").alias("line_no", "raw"))
    record = F.col("ordinal").cast("decimal(20,0)") * F.lit(MOST_LINES).cast("decimal(10,0)")
    return rows.select(
        (record + F.col("line_no")).cast("decimal(38,0)").alias("ordinal"), "line_no", "parent_id", "raw",
        F.parse_json("raw").alias("doc"),
    )


def child_rows(
    lines: DataFrame, profile: Profile, types: str = "widen", keep: Sequence[str] = (), parent_type: str = "string"
) -> tuple[DataFrame, dict[str, str]]:
    """``_parent_id`` and the columns of the lines. A line's own ``_parent_id`` wins over the record's.

    ``parent_type`` is the base type of the records' ids; lines with ids of another type make the column text.
    """
    declared = {PARENT_ID: parent_type} | {c.name: c.type(types) for c in profile.columns}
    physical = declared if types == "widen" else dict.fromkeys(declared, "string")
    parent_id = F.col("parent_id")
    if PARENT_ID in profile:
        own = get("doc", path_of(PARENT_ID))
        parent_id = F.when(own.isNotNull(), get("doc", path_of(PARENT_ID), "string")).otherwise(parent_id)
        declared[PARENT_ID] = parent_type if profile[PARENT_ID].type(types) == parent_type else "string"
    if types == "widen":
        parent_id = parent_id.cast(SPARK_TYPE[declared[PARENT_ID]])
    message = F.lit("a sublist holds a line that is not an object")
    checked = lines.withColumn("doc", F.when(is_object(F.col("doc")), F.col("doc")).otherwise(F.raise_error(message).cast("variant")))
    names = [c.name for c in profile.columns if c.name != PARENT_ID]
    table = to_columns(checked.withColumn(PARENT_ID, parent_id), names, physical, keep=[*keep, PARENT_ID])
    return table, declared


# ---- preview ----------------------------------------------------------------------------------------


def preview(table: DataFrame, rows: int = 1, order: Sequence[str] = ()) -> DataFrame:
    """The first characters of a few rows as JSON text: any rows, or the first by ``order`` (columns left out of the text)."""
    if rows < 1:
        raise ExtractError("a preview shows at least one row")
    sample = (table.orderBy(*order) if order else table).limit(rows).drop(*order)
    return sample.select(F.substring(F.to_json(F.struct("*")), 1, PREVIEW_CHARS).alias("sample"))
