"""Saved-search result pages landed as XML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.errors import ExtractError
from tributary.sources.pages import ROWS_PER_PAGE

# Elements of a search result. Records sit in one list, search rows in another.
RECORD_LISTS = (("recordList", "record"), ("searchRowList", "searchRow"))


def read_search_pages(
    spark: SparkSession, path: str | list[str], *, layout: str = "files", row_tag: str = "searchResult", schema: T.StructType | None = None
) -> DataFrame:
    """One row per search result; namespace prefixes are dropped everywhere.

    ``layout="files"``: whole responses, in which the ``row_tag`` element (named without prefix) is found.
    ``layout="lines"``: one search result element per line. Every value is text. Giving ``schema`` saves the
    pass over the files that infers it.
    """
    if layout not in ("lines", "files"):
        raise ExtractError("layout must be 'lines' or 'files'")
    reader = spark.read.format("xml").options(
        rowTag=row_tag, ignoreNamespace=True, inferSchema=False, attributePrefix="_", multiLine=layout == "files"
    )
    return (reader.schema(schema) if schema else reader).load(path)


def _has(schema: T.StructType, name: str) -> bool:
    return name in schema.names


def search_page_info(pages: DataFrame) -> DataFrame:
    """``search_id, page_index, total_pages, total_records, is_success`` per page."""

    def number(name: str, default: int | None) -> Column:
        value = F.col(name).try_cast("bigint") if _has(pages.schema, name) else F.lit(None).cast("bigint")
        # Absent or zero counts as one page.
        return F.coalesce(F.when(value != 0, value), F.lit(default).cast("bigint"))

    search_id = F.col("searchId") if _has(pages.schema, "searchId") else F.lit(None).cast("string")
    ok = F.col("status._isSuccess") if _has(pages.schema, "status") else F.lit(None).cast("string")
    return pages.select(
        search_id.alias("search_id"),
        number("pageIndex", 1).alias("page_index"),
        number("totalPages", 1).alias("total_pages"),
        number("totalRecords", None).alias("total_records"),
        F.coalesce(ok != "false", F.lit(True)).alias("is_success"),
    )


def search_rows(pages: DataFrame) -> DataFrame:
    """Records and search rows of all pages: ``page_no, ordinal`` and one column per field.

    Attributes lose their marker (``_internalId`` becomes ``internalId``), a record that is plain text
    becomes the column ``value``, and a page whose status says it failed is an error.
    """
    index = F.coalesce(F.col("pageIndex").try_cast("bigint"), F.lit(1)) if _has(pages.schema, "pageIndex") else F.lit(1)
    failed = F.col("status._isSuccess") == "false" if _has(pages.schema, "status") else F.lit(False)
    message = F.lit("the saved search failed: its status says so")
    parts: list[DataFrame] = []
    for list_name, row_name in RECORD_LISTS:
        if not _has(pages.schema, list_name):
            continue
        inner = pages.schema[list_name].dataType
        if not isinstance(inner, T.StructType) or not _has(inner, row_name):
            continue
        rows, listed = F.col(f"{list_name}.{row_name}"), inner[row_name].dataType
        if not isinstance(listed, T.ArrayType):
            # No page holds more than one.
            rows, listed = F.filter(F.array(rows), lambda row: row.isNotNull()), T.ArrayType(listed)
        # Part of the exploded value, so that a failed page without rows is noticed too.
        checked = F.when(failed, F.raise_error(message).cast(listed)).otherwise(rows)
        exploded = pages.select(index.alias("page_no"), F.posexplode(checked).alias("pos", "record"))
        parts.append(to_row(exploded))
    if not parts:
        raise ExtractError("no record list found in the search result pages")
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part, allowMissingColumns=True)
    return result


def to_row(exploded: DataFrame, column: str = "record") -> DataFrame:
    """Spread a record over columns; anything that is not a record becomes the column ``value``."""
    data_type = exploded.schema[column].dataType
    keys = [F.col("page_no").cast("bigint").alias("page_no"), (F.col("page_no") * ROWS_PER_PAGE + F.col("pos")).alias("ordinal")]
    if not isinstance(data_type, T.StructType):
        return exploded.select(*keys, F.col(column).alias("value"))
    fields = [F.col(f"`{column}`.`{n}`").alias("value" if n == "_VALUE" else n.removeprefix("_")) for n in data_type.names]
    return exploded.select(*keys, *fields)
