"""Landed page sets and documents, derived from the driver's tables.

The engine starts from landed text. These jobs produce such text at any scale from the Parquet tables, so
that queries exercise the real scans. Each set is written once per session and folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.session import staging_path

PAGE = 1000  # rows per landed page
EVENT_PAGE, EVENT_SET = 100, 5000  # rows per page and per page set of events
CURSOR_PAGE = 100
BLOCK = 200  # ids per block of documents

# Lines of documents that one task puts together and writes as one file.
LINES_PER_TASK = 1_000_000

HOST = "https://api.example.com"

_landed: dict[tuple[str, str, str], str] = {}
_builders: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_compressed: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lands(name: str, compression: str = "none"):
    """Register a set. One with ``compression`` deals its rows out to its own files, for such files are read whole by a task."""

    def add(build: Callable[[SparkSession, str], DataFrame]):
        _builders[name], _compressed[name] = build, compression
        return build

    return add


def land(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Folder of a landed set; built on first use. Columns besides ``value`` become folders."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _landed:
        path = staging_path(spark, f"landed-{name}")
        df = _builders[name](spark, sf_dir)
        folders = [c for c in df.columns if c != "value"]
        dealt = df.repartition(*folders) if folders and _compressed[name] == "none" else df
        written = dealt.write.partitionBy(*folders).option("zlib.compress.level", "BEST_SPEED")
        written.text(path, compression=_compressed[name])
        _landed[key] = path
    return _landed[key]


# ---- helpers ----------------------------------------------------------------------------------------


def link(rel: str, href: Column) -> Column:
    return F.struct(F.lit(rel).alias("rel"), href.alias("href"))


def self_links(kind: str, key: Column) -> Column:
    return F.array(link("self", F.concat(F.lit(f"{HOST}/record/{kind}/"), key.cast("string"))))


def page_groups(df: DataFrame, key: str, size: int, item: Column) -> DataFrame:
    """``page_no, items``: rows grouped into pages by ranges of a dense integer key."""
    rows = df.select(F.floor(F.col(key) / size).alias("page_no"), F.col(key).alias("_key"), item.alias("item"))
    entries = F.array_sort(F.collect_list(F.struct("_key", "item")))
    return rows.groupBy("page_no").agg(F.transform(entries, lambda e: e["item"]).alias("items"))


def enveloped(pages: DataFrame, total: int, last_page: int, size: int, url: str) -> Column:
    """JSON text of a page envelope with its links."""
    offset = F.col("page_no") * size
    more = F.col("page_no") < last_page

    def at(o: Column) -> Column:
        return F.concat(F.lit(f"{url}?limit={size}&offset="), o.cast("string"))

    links = F.array_compact(F.array(F.when(more, link("next", at(offset + size))), link("self", at(offset))))
    return F.to_json(
        F.struct(
            links.alias("links"),
            F.size("items").alias("count"),
            more.alias("hasMore"),
            F.col("items"),
            offset.alias("offset"),
            F.lit(total).alias("totalResults"),
        )
    )


def _tasks(spark: SparkSession, df: DataFrame, rows: int) -> int:
    """Tasks of about ``rows`` rows each, in whole rounds of all cores."""
    cores = spark.sparkContext.defaultParallelism
    return cores * max(1, -(-df.count() // (rows * cores)))


def _extent(df: DataFrame, key: str) -> tuple[int, int]:
    row = df.agg(F.count("*").alias("n"), F.max(key).alias("top")).first()
    return row["n"], row["top"] or 0


# ---- record documents -------------------------------------------------------------------------------


def _orders_with_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    """Orders, each with all its ``lines``, and the number of tasks they are dealt out to.

    Lines are dealt out before they are collected, to as many tasks as their number asks for: what a task sorts is bounded
    in rows, whatever they shrink to in a shuffle.
    """
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    tasks = _tasks(spark, lines, LINES_PER_TASK)
    line = F.struct(F.col("l_linenumber").alias("line"), F.col("l_quantity").alias("qty"), F.col("l_returnflag").alias("flag"))
    sublists = lines.repartition(tasks, "l_orderkey").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(line)).alias("lines"))
    none = F.array().cast(sublists.schema["lines"].dataType)
    orders = table(spark, sf_dir, "orders").repartition(tasks, "o_orderkey")
    joined = orders.join(sublists, orders.o_orderkey == sublists.l_orderkey, "left").drop("l_orderkey")
    return joined.withColumn("lines", F.coalesce("lines", none)), tasks


def _document() -> Column:
    """JSON text of an order with its lines."""
    items = F.transform(
        "lines",
        lambda x: F.struct(self_links("line", x["line"]).alias("links"), x["line"].alias("line"), x["qty"].alias("qty"), x["flag"].alias("flag")),
    )
    key = F.col("o_orderkey")
    return F.to_json(
        F.struct(
            self_links("order", key).alias("links"),
            key.cast("string").alias("id"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_totalprice").alias("total"),
            F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"),
            F.struct(
                self_links("customer", F.col("o_custkey")).alias("links"),
                F.col("o_custkey").alias("id"),
                F.concat(F.lit("customer "), F.col("o_custkey")).alias("refName"),
            ).alias("customer"),
            F.struct(self_links("order", key).alias("links"), items.alias("items"), F.size("lines").alias("totalResults")).alias("item"),
        )
    )


@_lands("documents", compression="gzip")
def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per order with all its lines as a sublist."""
    orders, _ = _orders_with_lines(spark, sf_dir)
    return orders.select(_document().alias("value"))


@_lands("collection")
def order_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id-only collection pages. Low-priority orders come without an id, as whole items."""
    orders = table(spark, sf_dir, "orders")
    total, top = _extent(orders, "o_orderkey")
    low = F.col("o_orderpriority") == "5-LOW"
    item = F.struct(
        F.when(~low, self_links("order", F.col("o_orderkey"))).alias("links"),
        F.when(~low, F.col("o_orderkey").cast("string")).alias("id"),
        F.when(low, F.col("o_orderkey")).alias("number"),
        F.when(low, F.col("o_orderstatus")).alias("status"),
    )
    pages = page_groups(orders, "o_orderkey", PAGE, item)
    return pages.select(enveloped(pages, total, top // PAGE, PAGE, f"{HOST}/record/order").alias("value"))


@_lands("sql_pages")
def sql_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    total, top = _extent(orders, "o_orderkey")
    item = F.struct(
        F.array().cast("array<string>").alias("links"),
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("total"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("trandate"),
    )
    pages = page_groups(orders, "o_orderkey", PAGE, item)
    return pages.select(enveloped(pages, total, top // PAGE, PAGE, f"{HOST}/query").alias("value"))


@_lands("sql_page_files")
def sql_page_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pages, one folder per page, as something a page can be fetched from."""
    pages = spark.read.text(land(spark, sf_dir, "sql_pages"))
    return pages.select("value", F.from_json("value", "offset bigint")["offset"].alias("page_offset"))


@_lands("document_blocks", compression="gzip")
def document_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order documents in blocks of ids, as something a document can be fetched from.

    Orders meet in their block before they are written as text, so no text is shuffled or sorted.
    """
    orders, tasks = _orders_with_lines(spark, sf_dir)
    blocks = orders.withColumn("block", F.floor(F.col("o_orderkey") / BLOCK)).repartition(tasks, "block").sortWithinPartitions("block")
    return blocks.select(_document().alias("value"), "block")


# ---- faulty page sets -------------------------------------------------------------------------------


@_lands("event_pages")
def event_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many page sets of events. In each, page 7 is missing and page 3 landed twice."""
    events = table(spark, sf_dir, "events").select(
        "event_id", F.floor(F.col("event_id") / EVENT_SET).alias("set_no"), (F.col("event_id") % EVENT_SET).alias("at")
    )
    totals = events.groupBy("set_no").agg(F.count("*").alias("total"), F.max("at").alias("top"))
    rows = events.withColumn("page_no", F.floor(F.col("at") / EVENT_PAGE))
    grouped = rows.groupBy("set_no", "page_no").agg(
        F.transform(F.array_sort(F.collect_list("event_id")), lambda e: F.struct(e.alias("id"))).alias("items")
    )
    pages = grouped.join(totals, "set_no")
    offset = F.col("page_no") * EVENT_PAGE
    more = F.col("page_no") < F.floor(F.col("top") / EVENT_PAGE)

    def at(o: Column) -> Column:
        return F.concat(F.lit(f"{HOST}/events?limit={EVENT_PAGE}&offset="), o.cast("string"))

    body = F.to_json(
        F.struct(
            F.array_compact(F.array(F.when(more, link("next", at(offset + EVENT_PAGE))), link("self", at(offset)))).alias("links"),
            more.alias("hasMore"), F.col("items"), offset.alias("offset"), F.col("total").alias("totalResults"),
        )
    )
    copies = F.when(F.col("page_no") == 7, F.array().cast("array<int>")).when(F.col("page_no") == 3, F.array(F.lit(1), F.lit(2)))
    landed = pages.withColumn("copy", F.explode(F.coalesce(copies, F.array(F.lit(1)))))
    return landed.select(
        F.to_json(F.struct(F.concat(F.lit("events-"), F.col("set_no")).alias("page_set"), body.alias("body"))).alias("value")
    )


@_lands("cursor_pages")
def cursor_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Endpoint pages of parts chained by cursors. Every page with number 5 mod 7 hands out a cursor again."""
    parts = table(spark, sf_dir, "part")
    _, top = _extent(parts, "p_partkey")
    item = F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    pages = page_groups(parts, "p_partkey", CURSOR_PAGE, item)
    page = F.col("page_no")
    following = F.when(page % 7 == 5, page).otherwise(page + 1)
    cursor = F.when(page < top // CURSOR_PAGE, F.concat(F.lit("c"), following)).otherwise(F.lit(""))
    body = F.struct(F.col("items").alias("rows"), F.struct(cursor.alias("next")).alias("meta"))
    sent = F.when(page > 0, F.concat(F.lit("c"), page))
    return pages.select(F.to_json(F.struct(page.alias("page_no"), sent.alias("cursor_in"), F.to_json(body).alias("body"))).alias("value"))


@_lands("wrapped_pages")
def wrapped_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Endpoint pages with rows two levels down: lists, single records for debtors, and empty pages."""
    customer = table(spark, sf_dir, "customer")
    item = F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    debtor = F.col("c_acctbal") < 0
    pages = page_groups(customer.where(~debtor), "c_custkey", 50, item)
    lists = pages.select(F.to_json(F.struct(F.struct(F.col("items").alias("results")).alias("data"))).alias("body"), "page_no")
    single = customer.where(debtor).select(
        F.to_json(F.struct(F.struct(item.alias("results")).alias("data"))).alias("body"), F.col("c_custkey").alias("page_no")
    )
    empty = customer.where(debtor).select(F.lit('{"data":{"results":null}}').alias("body"), F.col("c_custkey").alias("page_no"))
    return lists.unionByName(single).unionByName(empty).select(F.to_json(F.struct("page_no", "body")).alias("value"))


# ---- XML and catalogs -------------------------------------------------------------------------------


def xml_text(value: Column) -> Column:
    return F.replace(F.replace(value, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


@_lands("search_xml")
def search_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search result pages of customers: records on even pages, search rows on odd ones."""
    customer = table(spark, sf_dir, "customer")
    total, top = _extent(customer, "c_custkey")
    fields = F.concat(
        F.lit("<l:entityId>"), F.col("c_custkey"), F.lit("</l:entityId><l:companyName>"), xml_text(F.col("c_name")),
        F.lit("</l:companyName>"),
    )
    odd = F.floor(F.col("c_custkey") / 100) % 2 == 1
    key = F.col("c_custkey").cast("string")
    record = F.concat(F.lit('<c:record xsi:type="l:Customer" internalId="'), key, F.lit('">'), fields, F.lit("</c:record>"))
    row = F.concat(F.lit('<c:searchRow internalId="'), key, F.lit('">'), fields, F.lit("</c:searchRow>"))
    pages = page_groups(customer, "c_custkey", 100, F.when(odd, row).otherwise(record))
    joined = F.array_join("items", "")
    even_page = F.col("page_no") % 2 == 0
    body = F.when(even_page, F.concat(F.lit("<c:recordList>"), joined, F.lit("</c:recordList>"))).otherwise(
        F.concat(F.lit("<c:searchRowList>"), joined, F.lit("</c:searchRowList>"))
    )
    head = F.concat(
        F.lit('<m:searchResult xmlns:m="urn:m" xmlns:c="urn:c" xmlns:l="urn:l" xmlns:xsi="urn:xsi"><c:status isSuccess="true"/>'),
        F.lit(f"<c:totalRecords>{total}</c:totalRecords><c:totalPages>{top // 100 + 1}</c:totalPages><c:pageIndex>"),
        F.col("page_no") + 1, F.lit("</c:pageIndex><c:searchId>S1</c:searchId>"),
    )
    return pages.select(F.concat(head, body, F.lit("</m:searchResult>")).alias("value"))


@_lands("type_catalog")
def type_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog pages of types named after parts; small parts have no name, only links."""
    type_name = F.concat_ws("_", F.col("p_brand"), F.col("p_type"), F.col("p_partkey").cast("string"))
    named = F.col("p_size") > 25
    hrefs = F.array(F.struct(F.lit("").alias("href")), F.struct(F.concat(F.lit(f"{HOST}/catalog/"), type_name, F.lit("/")).alias("href")))
    item = F.struct(F.when(named, type_name).alias("name"), hrefs.alias("links"))
    pages = page_groups(table(spark, sf_dir, "part"), "p_partkey", 500, item)
    return pages.select(F.to_json(F.struct("items")).alias("value"))


@_lands("type_schemas")
def type_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One schema document per part, with three properties whose order is not alphabetical."""
    part = table(spark, sf_dir, "part")
    members = F.concat(
        F.lit('{"type":"object","properties":{"z_'), F.col("p_type"), F.lit('":{"type":"string"},"'), F.col("p_brand"),
        F.lit('":{"type":"object","properties":{"inner":{}}},"a_'), F.col("p_size"), F.lit('":{"type":"integer"}}}'),
    )
    return part.select(members.alias("value"))
