"""Scans of landed JSON pages and documents.

A page set is what a paged interface returned, landed as text: one page per line (``layout="lines"``)
or one page per file (``layout="files"``). Scans give *bronze* rows::

    page_no BIGINT, ordinal BIGINT, id STRING, raw STRING, doc VARIANT

``ordinal`` is the position in the whole page set. It is computed from the page itself (its offset, or
its number) and the position inside the page, so no scan needs a global sort or a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.errors import ExtractError
from tributary.functions.jsontext import all_objects, dotted_path, framed, get, is_object, parse_whole

# Pages without an offset: ordinal = page number * ROWS_PER_PAGE + position in page.
ROWS_PER_PAGE = 1 << 31  # an array has fewer elements

# Members of a page envelope.
ENVELOPE = T.StructType(
    [
        T.StructField("offset", T.LongType()),
        T.StructField("count", T.LongType()),
        T.StructField("hasMore", T.BooleanType()),
        T.StructField("totalResults", T.LongType()),
        T.StructField("links", T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("rel", "href")]))),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)
_FRAMED = T.StructType([T.StructField("v", ENVELOPE), T.StructField("end of the text", T.BooleanType()), T.StructField("malformed", T.StringType())])


def read_landed(spark: SparkSession, path: str | list[str], layout: str = "lines") -> DataFrame:
    """Landed text as ``raw`` with its ``file``; empty lines are skipped, empty files are kept."""
    if layout not in ("lines", "files"):
        raise ExtractError("layout must be 'lines' or 'files'")
    text = spark.read.text(path, wholetext=layout == "files")
    text = text.select(
        F.col("value").alias("raw"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("landed_at"),
    )
    return text if layout == "files" else text.where(F.trim("raw") != "")


def file_number(file: Column | str = "file") -> Column:
    """Last number in a file name (``page-000012.json`` is 12); NULL without one."""
    name = F.element_at(F.split(file, "/"), -1)
    return F.regexp_extract(name, r"([0-9]+)[^0-9]*$", 1).try_cast("bigint")


def split_malformed(landed: DataFrame, surface: str, *, strict: bool = False, raw: str = "raw") -> tuple[DataFrame, DataFrame]:
    """Parsed rows (with ``doc``) and the quarantine of rows that are not JSON, or more than one JSON value.

    With ``strict`` the first such row fails the job, naming the surface.
    """
    doc = parse_whole(raw)
    if strict:
        message = F.lit(f"{surface} returned a response that is not JSON")
        return landed.withColumn("doc", F.coalesce(doc, F.raise_error(message).cast("variant"))), landed.where(F.lit(False))
    parsed = landed.withColumn("doc", doc)
    return parsed.where(F.col("doc").isNotNull()), parsed.where(F.col("doc").isNull()).drop("doc")


def read_envelopes(spark: SparkSession, path: str | list[str], layout: str = "lines") -> DataFrame:
    """Page envelopes: ``page_offset, page_count, has_more, total, next_href, items, file, malformed``.

    One parse per page; ``items`` keeps every element as its own JSON text, so key order survives.
    """
    return envelopes(read_landed(spark, path, layout))


def envelopes(landed: DataFrame, raw: str = "raw") -> DataFrame:
    found = F.from_json(framed(raw), _FRAMED, {"columnNameOfCorruptRecord": "malformed"})
    whole = F.col("found.malformed").isNull() & F.coalesce("found.`end of the text`", F.lit(False))
    others = [c for c in landed.columns if c != raw]
    framed_pages = landed.select(*others, F.col(raw).alias("raw"), found.alias("found"))
    return framed_pages.select(*others, "raw", F.col("found.v").alias("page"), F.when(~whole, F.col("raw")).alias("malformed")).select(
        *others,
        F.col("page.offset").alias("page_offset"),
        F.col("page.count").alias("page_count"),
        F.coalesce("page.hasMore", F.lit(False)).alias("has_more"),
        F.col("page.totalResults").alias("total"),
        F.get(F.filter("page.links", lambda link: link["rel"] == "next"), F.lit(0))["href"].alias("next_href"),
        F.col("page.items").alias("items"),
        "malformed",
    )


def explode_items(pages: DataFrame, *, strict: bool = True, surface: str = "page set") -> DataFrame:
    """Bronze rows of enveloped pages, in offset order.

    A malformed page fails the job when ``strict``; otherwise it gives no rows (see ``malformed``). A page without an offset
    stands where the number in its file's name says; without that, only a page that says it is the only one may do
    without, for two such pages would have the same ordinals.
    """
    items = F.col("items")
    if strict:
        message = F.lit(f"{surface} returned a response that is not a JSON page")
        items = F.when(F.col("malformed").isNotNull(), F.raise_error(message).cast("array<string>")).otherwise(items)
    number = file_number() * ROWS_PER_PAGE if "file" in pages.columns else F.lit(None).cast("bigint")
    alone = F.when(~F.coalesce("has_more", F.lit(False)) & (F.coalesce("total", F.size("items")) <= F.size("items")), F.lit(0))
    lost = F.raise_error(F.lit(f"{surface} has a page without an offset")).cast("bigint")
    offset = F.coalesce("page_offset", number, alone, F.when(F.size("items") > 0, lost))
    rows = pages.select(offset.alias("page_offset"), F.posexplode(items).alias("pos", "raw"))
    return _bronze(rows, F.col("page_offset"), F.col("page_offset") + F.col("pos"))


def read_collection(spark: SparkSession, path: str | list[str], *, layout: str = "lines", strict: bool = True) -> DataFrame:
    """Rows of a record-collection page set: ``page_no, ordinal, id, raw, doc``."""
    return explode_items(read_envelopes(spark, path, layout), strict=strict, surface="record collection")


def read_sql_result(spark: SparkSession, path: str | list[str], *, layout: str = "lines", strict: bool = True) -> DataFrame:
    """Rows of a SQL-result page set; every member stays, also ``links``."""
    return explode_items(read_envelopes(spark, path, layout), strict=strict, surface="SQL query")


def read_details(spark: SparkSession, path: str | list[str], *, layout: str = "lines") -> DataFrame:
    """One expanded document per record: ``id, raw, landed_at``.

    Only the id is read here; the document is parsed once, after it has met its collection row.
    """
    return details(read_landed(spark, path, layout))


def details(landed: DataFrame, raw: str = "raw") -> DataFrame:
    record_id = F.from_json(F.col(raw), "id string")["id"]
    order = F.col("landed_at") if "landed_at" in landed.columns else F.lit(None).cast("timestamp")
    file = ["file"] if "file" in landed.columns else []
    return landed.select(record_id.alias("id"), F.col(raw).alias("raw"), order.alias("landed_at"), *file)


def rows_at_path(pages: DataFrame, record_path: str = "", *, page_no: str = "page_no", raw: str = "raw") -> DataFrame:
    """Rows found at a dotted path of each page, for interfaces without a fixed envelope.

    Nothing there gives no rows, an object gives one, an array of objects gives its elements. Anything
    else is an error that names the path and what was found.
    """
    node = get("doc", dotted_path(record_path))
    text = _text_at(F.col(raw), record_path)
    array = get(F.col("node"), "$", "array<variant>")
    found = F.schema_of_variant(F.col("node"))
    place = f"path '{record_path}'" if record_path else "the top level of the response"
    problem = F.concat(F.lit(f"{place} holds neither a record nor a list of records (found "), F.lower(found), F.lit(")"))
    rows = (
        F.when(F.col("node").isNull() | (found == "VOID"), F.array().cast("array<string>"))
        .when(is_object(F.col("node")), F.array("text"))
        .when(F.coalesce(all_objects(array), F.lit(False)), F.from_json("text", "array<string>"))
        .otherwise(F.raise_error(problem).cast("array<string>"))
    )
    surface = F.lit("the endpoint returned a response that is not JSON")
    parsed = pages.select(
        F.col(page_no).cast("bigint").alias("page_no"),
        F.col(raw).alias(raw),
        F.coalesce(parse_whole(raw), F.raise_error(surface).cast("variant")).alias("doc"),
    )
    nodes = parsed.select("page_no", node.alias("node"), text.alias("text"))
    return _bronze(
        nodes.select("page_no", F.posexplode(rows).alias("pos", "raw")),
        F.col("page_no"),
        F.col("page_no") * ROWS_PER_PAGE + F.col("pos"),
    )


def value_at(doc: Column | str, path: str, as_type: str = "variant") -> Column:
    """Value at a dotted path of objects; any step that is not an object gives NULL."""
    return get(doc, dotted_path(path), as_type)


def _text_at(raw: Column, path: str) -> Column:
    """JSON text of the node at a dotted path, with its key order."""
    if not path:
        return raw
    keys = path.split(".")
    schema: T.DataType = T.StringType()
    for key in reversed(keys):
        schema = T.StructType([T.StructField(key, schema)])
    text = F.from_json(raw, schema)
    for key in keys:
        text = text.getField(key)
    return text


def _bronze(rows: DataFrame, page_no: Column, ordinal: Column) -> DataFrame:
    doc = F.parse_json("raw")
    return rows.select(page_no.alias("page_no"), ordinal.cast("bigint").alias("ordinal"), "raw", doc.alias("doc")).select(
        "page_no", "ordinal", get("doc", "$.id", "string").alias("id"), "raw", "doc"
    )
