"""Discovery: record types, fields of a type, and saved searches, from landed catalog documents.

Each scan gives ``value, label`` rows, as a picker would show them, in document order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.errors import ExtractError


def _text(name: str) -> Column:
    return F.nullif(F.col(name), F.lit(""))


def record_types(catalog: DataFrame, raw: str = "raw") -> DataFrame:
    """Type names: ``name``, else the last path segment of the first link that has an address."""
    schema = "items array<struct<name:string, links:array<struct<href:string>>>>"
    items = catalog.select(F.posexplode(F.from_json(F.col(raw), schema)["items"]).alias("position", "item"))
    href = F.get(F.filter("item.links", lambda link: F.coalesce(link["href"], F.lit("")) != ""), F.lit(0))["href"]
    tail = F.substring_index(F.regexp_replace(href, "/+$", ""), "/", -1)
    named = items.select("position", F.coalesce(_text("item.name"), F.nullif(tail, F.lit(""))).alias("value"))
    return named.where(F.col("value").isNotNull()).select("position", "value", F.col("value").alias("label"))


def record_fields(type_schema: DataFrame, raw: str = "raw") -> DataFrame:
    """Field names of a type: the keys of ``properties``, in document order."""
    properties = F.from_json(F.col(raw), "properties string")["properties"]
    keys = type_schema.select(F.posexplode(F.json_object_keys(properties)).alias("position", "value"))
    return keys.select("position", "value", F.col("value").alias("label"))


def saved_searches(searches: DataFrame) -> DataFrame:
    """``scriptId``, else ``internalId``, else ``name`` as value; ``name`` as label where there is one."""
    missing = [n for n in ("scriptId", "internalId", "name") if n not in searches.columns]
    known = searches.withColumns({n: F.lit(None).cast("string") for n in missing}) if missing else searches
    value = F.coalesce(_text("scriptId"), _text("internalId"), _text("name"))
    return known.select(value.alias("value"), F.coalesce(_text("name"), value).alias("label")).where(
        F.col("value").isNotNull()
    )


# A schema of more fields is not that of one record type.
MOST_FIELDS = 20_000


def suggest_columns(mode: str, *, type_schema: DataFrame | None = None, query_columns: list[str] | None = None) -> list[str]:
    """Key columns to offer: fields of the record type, or columns of the query; other modes know none."""
    if mode == "record" and type_schema is not None:
        # One schema document: as many rows as the type has fields.
        fields = record_fields(type_schema).orderBy("position").limit(MOST_FIELDS + 1).collect()
        if len(fields) > MOST_FIELDS:
            raise ExtractError(f"more than {MOST_FIELDS} fields: this is not the schema of one record type")
        return [row["value"] for row in fields]
    if mode == "sql":
        return list(query_columns or [])
    if mode in ("record", "saved_search", "endpoint"):
        return []
    raise ExtractError(f"unknown mode '{mode}'")
