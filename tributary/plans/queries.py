"""The registered queries, each with the SQL that must give the same rows on the plain tables."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import date, datetime
from functools import lru_cache, reduce

from pyarrow import fs
from pyspark.errors import SparkRuntimeException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tributary.functions import redact
from tributary.functions.jsontext import get
from tributary.operators import infer, keys, merge, pagesets, predicates, resolve, shape
from tributary.plans import extract, landing, sqlmode
from tributary.plans.landing import EVENT_PAGE, EVENT_SET, PAGE, land, table
from tributary.session import prepare, staging_path
from tributary.sinks import csvfiles, tables
from tributary.sinks.files import delete
from tributary.sources import catalog, pages, remote, search_xml
from tributary.spec import Table, TableSpec
from tributary.streaming.incremental import landed_stream, stream_documents, stream_upsert

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

AS_OF = date(2000, 5, 17)
LONG_DOCUMENT = 60_000  # lines of a long record in one document


def query(oracle: str | None = None, name: str = ""):
    def add(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(prepare(spark), sf_dir.rstrip("/"))

        key = name or function.__name__
        QUERIES[key] = run
        if oracle:
            ORACLES[key] = oracle
        return function

    return add


def views(spark: SparkSession, sf_dir: str, *names: str) -> None:
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def landed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed order documents as ``ordinal, raw``, ordered by order number."""
    texts = spark.read.text(land(spark, sf_dir, "documents"))
    return texts.select(F.from_json("value", "id string")["id"].cast("bigint").alias("ordinal"), F.col("value").alias("raw"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same without navigation keys, parsed: ``ordinal, raw, doc``."""
    return shape.parsed(landed_documents(spark, sf_dir))


# ---- SQL mode ---------------------------------------------------------------------------------------


@query("""
    SELECT o.o_orderkey, c.c_name, o.o_totalprice, o.o_orderdate
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
    WHERE o.o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1997-06-30'
""")
def sql_date_range_join(spark, d):
    views(spark, d, "orders", "customer")
    text = """
        SELECT o.o_orderkey, c.c_name, o.o_totalprice, o.o_orderdate
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
        WHERE o.o_orderdate BETWEEN :date_from AND :date_to
    """
    return sqlmode.run_query(spark, text, "1996-01-01", "1997-06-30")


@query("SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey BETWEEN 20 AND 900")
def sql_filter_between(spark, d):
    found = predicates.search_filter(table(spark, d, "customer"), "c_custkey", "BETWEEN", [20, 900])
    return found.select("c_custkey", "c_name", "c_acctbal")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100 OFFSET 50")
def sql_order_limit(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return sqlmode.page_of(orders, [F.desc("o_totalprice"), "o_orderkey"], 100, 50)


@query("""
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_totalprice > 100000 OR (o_totalprice = 100000 AND o_orderkey > 500) ORDER BY o_totalprice, o_orderkey LIMIT 50
""")
def sql_page_after(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return sqlmode.page_after(orders, ["o_totalprice", "o_orderkey"], [100000.0, 500], 50)


@query("""
    SELECT l_extendedprice, l_orderkey, l_linenumber FROM (
        SELECT l_extendedprice, l_orderkey, l_linenumber, COUNT(*) OVER () AS n, ROW_NUMBER() OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS place FROM lineitem)
    WHERE place > n * 3 // 4 AND place <= n * 3 // 4 + 500
""")
def sql_page_at(spark, d):
    """A page three quarters into all lines, by price."""
    lines = table(spark, d, "lineitem").select("l_extendedprice", "l_orderkey", "l_linenumber")
    found = sqlmode.SortedPages(lines, [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber"])
    return found.page(500, found.n_rows * 3 // 4)


@query("""
    SELECT l_returnflag, l_linestatus, CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty,
           CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price, COUNT(*) AS n_lines
    FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def sql_group_agg(spark, d):
    views(spark, d, "lineitem")
    return sqlmode.run_query(
        spark,
        """
        SELECT l_returnflag, l_linestatus, CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty,
               CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price, COUNT(*) AS n_lines
        FROM lineitem GROUP BY l_returnflag, l_linestatus
        """,
    )


@query("""
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE o_orderdate BETWEEN TIMESTAMP '1999-07-31 12:00:00' AND TIMESTAMP '2000-01-30 12:00:00'
""")
def sql_relative_dates(spark, d):
    views(spark, d, "orders")
    text = "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate BETWEEN :date_from AND :date_to"
    return sqlmode.run_query(spark, text, "6 months ago", "yesterday", as_of=datetime(2000, 1, 31, 12))


@query("""
    WITH q AS (SELECT o_orderkey AS order_id, nullif(o_orderpriority, '5-LOW') AS priority, o_totalprice * 2 AS twice FROM orders)
    SELECT 0 AS position, 'order_id' AS column_name, COUNT(order_id) AS n_values FROM q
    UNION ALL SELECT 1, 'priority', COUNT(priority) FROM q UNION ALL SELECT 2, 'twice', COUNT(twice) FROM q
""")
def sql_probe_columns(spark, d):
    """Columns of a query from analysis alone, then how many rows of the query fill each."""
    views(spark, d, "orders")
    text = """
        SELECT o_orderkey AS order_id, nullif(o_orderpriority, '5-LOW') AS priority, o_totalprice * 2 AS twice
        FROM orders WHERE o_orderdate BETWEEN :date_from AND :date_to
    """
    sqlmode.validate_query(spark, text)
    names = catalog.suggest_columns("sql", query_columns=sqlmode.probe_columns(spark, text))
    filled = sqlmode.run_query(spark, text, "1900-01-01", "2100-01-01").agg(*[F.count(n).alias(n) for n in names])
    entries = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(n).alias("column_name"), F.col(n).alias("n_values")) for i, n in enumerate(names)])
    return filled.select(F.inline(entries))


@query("""
    SELECT o_orderkey AS page_row, CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status, o_totalprice AS total,
           strftime(o_orderdate, '%d/%m/%Y') AS trandate, '[]' AS links
    FROM orders
""")
def sql_result_pages(spark, d):
    rows = pages.read_sql_result(spark, land(spark, d, "sql_pages"))
    typed = extract.extract_pages(rows, table_name="orders", primary_key=["id"], keep_order=True)["orders"].df
    return typed.select(F.col("ordinal").alias("page_row"), "id", "status", "total", "trandate", "links")


# ---- record mode ------------------------------------------------------------------------------------


@query("""
    SELECT o_orderkey AS ordinal, CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderkey AS VARCHAR) END AS id,
           o_orderstatus AS status, CASE WHEN o_orderpriority <> '5-LOW' THEN COUNT(l_orderkey) END AS n_lines,
           CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(COALESCE(SUM(CAST(l_quantity AS BIGINT)), 0) AS BIGINT) END AS qty
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_orderpriority, o_orderstatus
""")
def resolve_details(spark, d):
    collection = pages.read_collection(spark, land(spark, d, "collection"))
    full = pages.read_details(spark, land(spark, d, "documents"))
    found = resolve.resolve_details(collection, full).withColumn("doc", F.parse_json("raw"))
    lines = get("doc", "$.item.items", "array<struct<line:bigint, qty:double>>")
    qty = F.aggregate(lines, F.lit(0).cast("bigint"), lambda a, x: a + x["qty"].cast("bigint"))
    return found.select("ordinal", "id", get("doc", "$.status", "string").alias("status"), F.when(lines.isNotNull(), F.size(lines)).cast("bigint").alias("n_lines"), qty.alias("qty"))


def orders_extracted(spark, d, **options) -> dict[str, Table]:
    landed = landed_documents(spark, d).withColumn("page_no", F.lit(0))
    return extract.extract_records(landed, record_type="order", **options)


@query("""
    SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status, o_totalprice AS total,
           nullif(o_orderpriority, '5-LOW') AS priority, o_custkey AS customer_id, COUNT(l_orderkey) AS n_items,
           CAST(COALESCE(SUM(CAST(l_quantity AS BIGINT)), 0) AS BIGINT) AS qty
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
    GROUP BY o_orderkey, o_orderstatus, o_totalprice, o_orderpriority, o_custkey
""")
def record_flatten(spark, d):
    flat = orders_extracted(spark, d, primary_key=["id"])["order"].df
    customer, parsed = F.get_json_object("customer", "$.id").cast("bigint"), F.from_json("item", "array<struct<line:bigint, qty:double>>")
    lines = F.col("lines")  # a column of its own, so that the text is parsed once
    return flat.select("id", "status", "total", "priority", customer.alias("customer_id"), parsed.alias("lines")).select(
        "id", "status", "total", "priority", "customer_id",
        F.size(lines).cast("bigint").alias("n_items"),
        F.aggregate(lines, F.lit(0).cast("bigint"), lambda a, x: a + x["qty"].cast("bigint")).alias("qty"),
    )


@query("SELECT o_orderstatus AS status, CAST(o_orderkey AS VARCHAR) AS id FROM orders")
def record_project(spark, d):
    return orders_extracted(spark, d, fields=["status"], primary_key=["id"])["order"].df


@query("""
    SELECT CAST(l_orderkey AS VARCHAR) AS _parent_id, CAST(l_linenumber AS BIGINT) AS line, l_quantity AS qty, l_returnflag AS flag
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def record_child_rows(spark, d):
    return orders_extracted(spark, d, child_tables=True)["order_item"].df


@query("""
    SELECT 'complete' AS lines, 'line' AS line_key
    UNION ALL SELECT 'some without a number', CASE WHEN COUNT(*) FILTER (l_returnflag = 'N') > 0 THEN 'sequence' ELSE 'line' END FROM lineitem
""")
def record_child_key(spark, d):
    """The line key of all lines, and of the same lines where some have no number."""
    base = table(spark, d, "lineitem")
    number, position = F.col("l_linenumber"), F.col("l_orderkey")

    def lines(line: Column) -> DataFrame:
        raw = F.to_json(F.struct(line.alias("line"), F.col("l_partkey").alias("sequence")), {"ignoreNullFields": "false"})
        return base.select(position.alias("ordinal"), raw.alias("raw")).withColumn("doc", F.parse_json("raw"))

    whole = keys.line_key_frame(infer.profile(lines(number)))
    gaps = keys.line_key_frame(infer.profile(lines(F.when(F.col("l_returnflag") != "N", number))))
    return whole.select(F.lit("complete").alias("lines"), "line_key").unionByName(
        gaps.select(F.lit("some without a number").alias("lines"), "line_key")
    )


@query("SELECT o_orderkey, 0 AS remaining_links, o_orderstatus AS status FROM orders")
def strip_links(spark, d):
    left = F.size(F.regexp_extract_all("raw", F.lit(r'"links"\s*:'), 0))
    return documents(spark, d).select(F.col("ordinal").alias("o_orderkey"), left.alias("remaining_links"), get("doc", "$.status", "string").alias("status"))


@query("""
    WITH first_row AS (SELECT MIN(o_orderkey) AS r FROM orders),
    late AS (SELECT o_orderpriority = '5-LOW' AS is_late FROM orders, first_row WHERE o_orderkey = r)
    SELECT unnest(CASE WHEN is_late THEN ['id','status','total','customer','item','priority']
                       ELSE ['id','status','total','priority','customer','item'] END) AS column,
           unnest(range(6))::INTEGER AS position FROM late
""")
def column_union(spark, d):
    return infer.column_union(infer.profile(documents(spark, d)))


COLUMN_TYPES = """
    SELECT 'id' AS column, CASE WHEN COUNT(o_orderkey) > 0 THEN 'string' END AS type FROM orders
    UNION ALL SELECT 'status', 'string' UNION ALL SELECT 'total', 'numeric' UNION ALL SELECT 'priority', 'string'
    UNION ALL SELECT 'customer', 'string' UNION ALL SELECT 'item', 'string'
"""


@query(COLUMN_TYPES)
def column_types_first(spark, d):
    return infer.column_types(infer.profile(documents(spark, d)), "first")


@query(COLUMN_TYPES)
def column_types_widen(spark, d):
    return infer.column_types(infer.profile(documents(spark, d)), "widen")


@query("""
    SELECT 'quantity' AS column, 'integer' AS first_type, 'numeric' AS widened FROM (SELECT COUNT(*) FROM lineitem)
    UNION ALL SELECT 'flag', 'string', 'string' UNION ALL SELECT 'mixed', 'boolean', 'string'
""")
def column_types_mixed(spark, d):
    """Columns whose values differ in type: whole and fractional numbers, booleans and text."""
    base = table(spark, d, "lineitem")
    even = F.col("l_orderkey") % 2 == 0
    whole = F.concat(F.lit('{"quantity":'), F.col("l_quantity").cast("bigint"), F.lit(',"flag":"'), F.col("l_returnflag"), F.lit('","mixed":true}'))
    broken = F.concat(F.lit('{"quantity":'), F.col("l_quantity") + F.lit(0.5), F.lit(',"flag":null,"mixed":"yes"}'))
    docs = base.select(
        # Documents with whole numbers come first.
        F.when(even, F.col("l_orderkey")).otherwise(F.col("l_orderkey") + F.lit(1 << 40)).alias("ordinal"),
        F.when(even, whole).otherwise(broken).alias("raw"),
    ).withColumn("doc", F.parse_json("raw"))
    profiled = infer.profile(docs)
    first = infer.column_types(profiled, "first").withColumnRenamed("type", "first_type")
    return first.join(infer.column_types(profiled, "widen").withColumnRenamed("type", "widened"), "column")


@query("""
    SELECT 'id' AS column, 'string' AS type, COUNT(*) AS n_values, COUNT(*) AS n_filled FROM orders
    UNION ALL SELECT 'status', 'string', COUNT(*), COUNT(*) FROM orders UNION ALL SELECT 'total', 'numeric', COUNT(*), COUNT(*) FROM orders
    UNION ALL SELECT 'customer', 'string', COUNT(*), COUNT(*) FROM orders UNION ALL SELECT 'item', 'string', COUNT(*), COUNT(*) FROM orders
    UNION ALL SELECT 'priority', 'string', COUNT(nullif(o_orderpriority, '5-LOW')), COUNT(nullif(o_orderpriority, '5-LOW')) FROM orders
""")
def profile_merged(spark, d):
    """Documents loaded in micro-batches: the profile the table carries in the end, beside the values in its columns."""

    def documents(batch: DataFrame) -> DataFrame:
        rows = batch.select(F.lit(0).cast("bigint").alias("page_no"), F.from_json("raw", "id string")["id"].cast("bigint").alias("ordinal"), "raw")
        return shape.parsed(rows)

    path, spec = staging_path(spark, "profiled"), TableSpec("orders", ("id",), True)
    landed = landed_stream(spark, land(spark, d, "documents"), files_per_batch=4)
    stream_documents(landed, documents, path, spec, staging_path(spark, "profiled-stream"), parts=4).awaitTermination()
    found, loaded = tables.table_profile(spark, path), tables.read_table(spark, path)
    filled = loaded.select(*[F.count(F.col(f"`{n}`")).alias(n) for n in loaded.columns]).unpivot([], loaded.columns, "column", "n_filled")
    return infer.column_types(found, "widen").join(found.select("column", "n_values"), "column").join(filled, "column")


@query("""
    WITH head AS (SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 100),
    sampled AS (SELECT COUNT(*) FILTER (o_orderpriority <> '5-LOW') AS n FROM orders JOIN head USING (o_orderkey))
    SELECT o_orderkey AS record, o_orderstatus AS status, n > 0 AS has_priority FROM orders, sampled
""")
def sampled_columns(spark, d):
    """Columns from the first hundred documents only; all rows come out."""
    rows = landed_documents(spark, d).withColumn("page_no", F.lit(0).cast("bigint"))
    found = extract.extract_pages(rows, table_name="sampled", sample=100)["sampled"].df
    return found.select(F.col("id").cast("bigint").alias("record"), "status", F.lit("priority" in found.columns).alias("has_priority"))


@query("SELECT event_id, 'integer' AS type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def props_types(spark, d):
    events = table(spark, d, "events").select("event_id", F.parse_json("props").alias("doc"))
    return events.select("event_id", infer.value_type(pages.value_at("doc", "k")).alias("type"), pages.value_at("doc", "k", "bigint").alias("k"))


@query("""
    SELECT CAST(o_orderkey AS VARCHAR) AS id, COUNT(l_orderkey) AS items_seen,
           CASE WHEN o_orderkey % 7 = 0 THEN 5 ELSE COUNT(l_orderkey) END AS items_expected, o_orderkey % 5 = 0 AS has_more,
           o_orderkey % 5 <> 0 AND (o_orderkey % 7 <> 0 OR COUNT(l_orderkey) = 5) AS complete
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey
""")
def sublist_completeness(spark, d):
    """Some sublists say that more lines follow, some that there are five."""
    key, total = F.col("ordinal"), r'"totalResults":\d+'
    claims = F.when(key % 7 == 0, F.regexp_replace("raw", total, '"totalResults":5')).otherwise(F.col("raw"))
    claims = F.when(key % 5 == 0, F.regexp_replace(claims, f"({total})", '$1,"hasMore":true')).otherwise(claims)
    docs = documents(spark, d).withColumn("raw", claims).withColumn("doc", F.parse_json("raw"))
    return pagesets.sublist_completeness(docs, "item")


@query("""
    SELECT '{"id":"' || o_orderkey || '","status":"' || o_orderstatus || '"}' AS sample FROM orders ORDER BY o_orderkey LIMIT 5
""")
def preview_sample(spark, d):
    flat = documents(spark, d).select("ordinal", get("doc", "$.id", "string").alias("id"), get("doc", "$.status", "string").alias("status"))
    return shape.preview(flat, 5, order=["ordinal"])


# ---- endpoint pages ---------------------------------------------------------------------------------


@query("SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer")
def dotted_path_rows(spark, d):
    landed = spark.read.schema("page_no bigint, body string").json(land(spark, d, "wrapped_pages"))
    found = extract.extract_endpoint(landed, script_id="12", deploy_id="1", record_path="data.results", raw="body", primary_key=["id"])
    return found["endpoint_12"].df


def event_envelopes(spark, d) -> DataFrame:
    landed = spark.read.schema("page_set string, body string").json(land(spark, d, "event_pages"))
    return pages.envelopes(landed, "body")


EVENT_GAPS = f"""
    WITH p AS (
        SELECT event_id // {EVENT_SET} AS s, (event_id % {EVENT_SET}) // {EVENT_PAGE} AS p, COUNT(*) AS n FROM events GROUP BY 1, 2
    ), top AS (SELECT s, MAX(p) AS last FROM p GROUP BY s),
    faults AS (
        SELECT s, 6 AS p, 'missing_next' AS problem FROM top WHERE last >= 7
        UNION ALL SELECT s, 8, 'unreferenced' FROM top WHERE last >= 8
        UNION ALL SELECT s, 3, 'repeated' FROM top WHERE last >= 3
    )
    SELECT 'events-' || s AS page_set, CAST(p * {EVENT_PAGE} AS BIGINT) AS page_offset,
           CASE WHEN p < last THEN CAST((p + 1) * {EVENT_PAGE} AS BIGINT) END AS next_offset, problem
    FROM faults JOIN top USING (s)
"""


@query(EVENT_GAPS)
def page_gaps(spark, d):
    return pagesets.link_gaps(event_envelopes(spark, d))


@query(EVENT_GAPS)
def page_gaps_by_offset(spark, d):
    return pagesets.offset_gaps(event_envelopes(spark, d), EVENT_PAGE)


@query(f"""
    WITH p AS (
        SELECT event_id // {EVENT_SET} AS s, (event_id % {EVENT_SET}) // {EVENT_PAGE} AS p, COUNT(*) AS n FROM events GROUP BY 1, 2
    )
    SELECT 'events-' || s AS page_set, CAST(SUM(n) AS BIGINT) AS rows_expected,
           CAST(SUM(n) FILTER (p <> 7) AS BIGINT) AS rows_seen, COUNT(*) FILTER (p <> 7) AS pages_seen,
           COUNT(*) FILTER (p = 3) AS pages_repeated,
           CAST(COALESCE(SUM(n) FILTER (p = 7), 0) AS BIGINT) AS rows_missing,
           CAST(CEIL(SUM(n) / {EVENT_PAGE}) AS BIGINT) AS pages_expected
    FROM p GROUP BY s
""")
def page_completeness(spark, d):
    return pagesets.page_completeness(event_envelopes(spark, d), EVENT_PAGE)


@query(f"""
    WITH p AS (SELECT DISTINCT p_partkey // {landing.CURSOR_PAGE} AS page_no FROM part), top AS (SELECT MAX(page_no) AS last FROM p)
    SELECT page_no, CASE WHEN page_no < last THEN 'c' || (CASE WHEN page_no % 7 = 5 THEN page_no ELSE page_no + 1 END) END AS cursor_out,
           CASE WHEN page_no < last THEN CASE WHEN page_no % 7 = 5 THEN page_no ELSE page_no + 1 END END AS next_page,
           CASE WHEN page_no >= last THEN 'last' WHEN page_no % 7 = 5 THEN 'repeat' ELSE 'followed' END AS status
    FROM p, top
""")
def cursor_chain(spark, d):
    landed = spark.read.schema("page_no bigint, cursor_in string, body string").json(land(spark, d, "cursor_pages"))
    parsed = landed.withColumn("doc", F.parse_json("body"))
    return pagesets.cursor_chain(pagesets.with_cursor(parsed, "meta.next"))


RINGS_OF_PAGES = 100_000  # offsets beyond any page's


@query(f"""
    WITH p AS (SELECT event_id // {EVENT_SET} AS s, (event_id % {EVENT_SET}) // {EVENT_PAGE} AS p FROM events GROUP BY 1, 2)
    SELECT 'events-' || s AS page_set, CAST(p * {EVENT_PAGE} AS BIGINT) AS page_offset, 'loose' AS problem, CAST(8 * {EVENT_PAGE} AS BIGINT) AS first_offset
    FROM p WHERE p >= 8
    UNION ALL
    SELECT DISTINCT 'events-' || s, CAST({RINGS_OF_PAGES} + k AS BIGINT), CASE WHEN k < 3 THEN 'ring' ELSE 'behind_ring' END, CAST({RINGS_OF_PAGES} AS BIGINT)
    FROM p, range(5) AS ring(k)
""")
def page_reach(spark, d):
    """Page sets without their eighth page, each with three pages that lead round and two that follow them."""
    landed = event_envelopes(spark, d).select("page_set", "page_offset", "next_href")
    hops = F.inline(F.array(*[F.struct(F.lit(RINGS_OF_PAGES + a).cast("bigint").alias("page_offset"), F.lit(f"?offset={RINGS_OF_PAGES + b}").alias("next_href")) for a, b in ((0, 1), (1, 2), (2, 0), (3, 4), (4, 999))]))
    astray = landed.select("page_set").distinct().select("page_set", hops)
    # a page of the ring is also linked from nowhere else; the fourth page hangs on the third through a second copy of it
    again = landed.select("page_set").distinct().select("page_set", F.lit(RINGS_OF_PAGES + 2).cast("bigint").alias("page_offset"), F.lit(f"?offset={RINGS_OF_PAGES + 3}").alias("next_href"))
    return pagesets.unreached_pages(landed.unionByName(astray).unionByName(again))


ORDER_PAGE, ORDER_BLOCK = 10, 1000  # orders a page, and pages with one ring and one loose segment


@query(f"""
    WITH p AS (SELECT DISTINCT o_orderkey // {ORDER_PAGE} AS i FROM orders), top AS (SELECT MAX(i) AS last FROM p),
    q AS (SELECT i, i // {ORDER_BLOCK} AS b, i % {ORDER_BLOCK} AS j, (i * 2654435761) % 4294967296 AS page_no FROM p)
    SELECT page_no, CASE WHEN j < 900 THEN 0
                         WHEN j < 950 THEN MIN(page_no) OVER (PARTITION BY b, j // 50)
                         ELSE ((b * {ORDER_BLOCK} + 950) * 2654435761) % 4294967296 END AS first_page,
           CASE WHEN j < 900 THEN b * 900 + j WHEN j >= 950 THEN j - 950 END AS place,
           CASE WHEN j < 900 THEN 'chain' WHEN j < 950 THEN 'ring' ELSE 'loose' END AS segment
    FROM q
""")
def cursor_order(spark, d):
    """A page for every ten orders, numbered in no order: one long chain, and rings and loose segments beside it."""
    i = F.floor(F.col("o_orderkey") / ORDER_PAGE)
    listed = table(spark, d, "orders").select(i.alias("i")).distinct()
    last = listed.agg(F.max("i")).first()[0]
    at = F.col("i") % ORDER_BLOCK
    after = (
        F.when((at >= 900) & (at < 950), F.when((at == 949) | (F.col("i") == last), F.col("i") - at + 900).otherwise(F.col("i") + 1))
        .when(at == 899, F.col("i") - at + ORDER_BLOCK)
        .when(at < 950, F.col("i") + 1)
        .when(at < ORDER_BLOCK - 1, F.col("i") + 1)
    )
    cursor = lambda number: F.concat(F.lit("c"), number.cast("string"))
    sent = F.when(at == 950, F.concat(F.lit("lost "), F.col("i").cast("string"))).when(F.col("i") > 0, cursor(F.col("i")))
    return pagesets.cursor_order(listed.select(((F.col("i") * 2654435761) % 4294967296).alias("page_no"), sent.alias("cursor_in"), cursor(after).alias("cursor_out")))


@query("""
    SELECT event_id, event_id % 50 = 0 AS quarantined, CASE WHEN event_id % 50 = 0 THEN left(props, 4) ELSE props END AS raw FROM events
""")
def malformed_quarantine(spark, d):
    cut = F.when(F.col("event_id") % 50 == 0, F.substring("props", 1, 4)).otherwise(F.col("props"))
    landed = table(spark, d, "events").select("event_id", cut.alias("raw"))
    good, bad = pages.split_malformed(landed, "event page")
    return good.select("event_id", F.lit(False).alias("quarantined"), "raw").unionByName(
        bad.select("event_id", F.lit(True).alias("quarantined"), "raw")
    )


# ---- keys and loads ---------------------------------------------------------------------------------


def order_batch(spark, d) -> tuple[DataFrame, DataFrame]:
    """All orders, and a batch of changed orders, new orders, and stale copies that must lose."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    changed = orders.where(F.col("o_orderkey") % 5 == 0)
    new = orders.where(F.col("o_orderkey") % 7 == 0).withColumn("o_orderkey", F.col("o_orderkey") + 1_000_000_000)

    def landed(rows: DataFrame, price: Column, page: int) -> DataFrame:
        return rows.withColumns({"o_totalprice": price, "page_no": F.lit(page).cast("bigint"), "ordinal": F.col("o_orderkey")})

    price = F.col("o_totalprice")
    batch = landed(changed, F.lit(-1.0), 1).unionByName(landed(changed, price + 1, 2)).unionByName(landed(new, price, 3))
    return orders, batch


UPSERTED = """
    SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders
    UNION ALL SELECT o_orderkey + 1000000000, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 7 = 0
"""


@query(UPSERTED)
def upsert_pk(spark, d):
    base, batch = order_batch(spark, d)
    return merge.upsert(base, batch, ["o_orderkey"])


@query(UPSERTED)
def upsert_table(spark, d):
    """The same through a written table: a full load as it comes, then incremental ones."""
    base, batch = order_batch(spark, d)
    folder = staging_path(spark, "upsert-table")
    tables.write_tables({"orders": Table(base, TableSpec("orders", ("o_orderkey",)))}, folder)
    few, rest = F.col("o_orderkey") % 10 == 0, F.col("o_orderkey") % 10 != 0
    for some in (batch.where(few), batch.where(rest)):
        tables.write_tables({"orders": Table(some, TableSpec("orders", ("o_orderkey",), True))}, folder)
    return tables.read_table(spark, f"{folder}/orders")


@query("SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1")
def key_duplicates(spark, d):
    return keys.duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT CAST(o_orderkey AS VARCHAR) AS id FROM orders WHERE o_totalprice < -1")
def zero_row_schema(spark, d):
    """An extraction that finds nothing still has its key columns."""
    none = documents(spark, d).where(get("doc", "$.total", "double") < -1)
    return extract.extract_records(none.withColumn("page_no", F.lit(0)), record_type="order", primary_key=["id"])["order"].df


@query("""
    SELECT position, name, type, TRUE AS nullable, name = 'id' AS primary_key, (SELECT COUNT(*) FROM orders) AS n_rows
    FROM (VALUES (0, 'id', 'STRING'), (1, 'status', 'STRING'), (2, 'total', 'NUMERIC'), (3, 'trandate', 'STRING')) AS t(position, name, type)
""")
def manifest_schema(spark, d):
    """Manifest of the order table, its columns and types taken from all landed pages."""
    rows = pages.read_sql_result(spark, land(spark, d, "sql_pages"))
    df, spec = extract.extract_pages(rows, table_name="orders", primary_key=["id"])["orders"]
    df = df.drop("links")
    entries = spark.createDataFrame(csvfiles.manifest_rows(df, spec), "position int, name string, type string, nullable boolean, primary_key boolean")
    return entries.withColumn("n_rows", F.lit(df.count()).cast("bigint"))


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def full_load_roundtrip(spark, d):
    path = staging_path(spark, "full-load")
    spec = TableSpec("orders", ("o_orderkey",))
    tables.write_full(table(spark, d, "orders").withColumn("o_totalprice", F.lit(0.0)), path, spec, parts=4)
    tables.write_full(table(spark, d, "orders"), path, spec, parts=4)
    return tables.read_table(spark, path)


@query("""
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CASE WHEN c_acctbal > 0 THEN 'True' ELSE 'False' END AS solvent,
           c_mktsegment || ', "' || c_nationkey || '"' AS quoted, (c_custkey + 10000000) || '.5' AS large,
           '{"name":"' || c_name || '"}' AS held, CASE WHEN c_custkey % 3 > 0 THEN c_name END AS some
    FROM customer
""")
def csv_roundtrip(spark, d):
    source = table(spark, d, "customer").select(
        "c_custkey", "c_name", (F.col("c_acctbal") > 0).alias("solvent"),
        F.concat("c_mktsegment", F.lit(', "'), "c_nationkey", F.lit('"')).alias("quoted"),
        (F.col("c_custkey") + F.lit(10000000.5)).alias("large"), F.struct(F.col("c_name").alias("name")).alias("held"),
        F.when(F.col("c_custkey") % 3 > 0, F.col("c_name")).alias("some"),
    )
    path = csvfiles.write_csv(Table(source, TableSpec("customer", ("c_custkey",))), staging_path(spark, "csv"), compat=True)
    names = ", ".join(f"{c} string" for c in source.columns)
    return spark.read.options(header=True, quote='"', escape='"').schema(names).csv(path)


@query("""
    SELECT 'order' AS name, CAST(o_orderkey AS VARCHAR) AS record, CAST(NULL AS BIGINT) AS line, o_totalprice AS amount FROM orders
    UNION ALL SELECT 'order_item', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS BIGINT), l_quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def multi_table_write(spark, d):
    found = orders_extracted(spark, d, primary_key=["id"], child_tables=True)
    folder = staging_path(spark, "tables")
    tables.write_tables(found, folder)
    parent = tables.read_table(spark, f"{folder}/order").select(
        F.lit("order").alias("name"), F.col("id").alias("record"), F.lit(None).cast("bigint").alias("line"), F.col("total").alias("amount")
    )
    child = tables.read_table(spark, f"{folder}/order_item").select(
        F.lit("order_item").alias("name"), F.col("_parent_id").alias("record"), "line", F.col("qty").alias("amount")
    )
    return parent.unionByName(child)


@query("""
    WITH loaded AS (
        SELECT 'order' AS name, o_orderkey AS record, o_totalprice AS amount FROM orders UNION ALL SELECT 'order_line', l_orderkey, l_quantity FROM lineitem)
    SELECT 'died' AS after, name, record, amount FROM loaded UNION ALL SELECT 'done', name, record, amount + 1 FROM loaded
""")
def multi_table_commit(spark, d):
    """Tables loaded together: a load that dies at the second one shows nothing, the next one shows all."""
    folder = staging_path(spark, "together")
    sources = {
        "order": table(spark, d, "orders").select(F.col("o_orderkey").alias("record"), F.col("o_totalprice").alias("amount")),
        "order_line": table(spark, d, "lineitem").select(F.col("l_orderkey").alias("record"), F.col("l_quantity").alias("amount")),
    }

    def load(change: Callable[[str], Column]) -> None:
        tables.write_tables({n: Table(df.withColumn("amount", change(n)), TableSpec(n)) for n, df in sources.items()}, folder)

    def seen(after: str) -> DataFrame:
        return reduce(DataFrame.unionByName, [df.select(F.lit(after).alias("after"), F.lit(n).alias("name"), "record", "amount") for n, df in tables.read_tables(spark, folder).items()])

    load(lambda name: F.col("amount"))
    died = F.raise_error(F.lit("this load dies here")).cast("double")
    try:
        load(lambda name: F.col("amount") + 1 if name == "order" else died)
    except SparkRuntimeException as error:
        if "this load dies here" not in str(error):
            raise
    before = seen("died")
    load(lambda name: F.col("amount") + 1)
    return before.unionByName(seen("done"))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'B' ELSE 'A' END AS writer, o_totalprice AS total FROM orders")
def stream_two_writers(spark, d):
    """Two streams load one table. A batch of the first is run again after the second one's: it adds nothing."""
    path, spec = staging_path(spark, "two-writers"), TableSpec("orders", ("id",), True)
    folders = {w: staging_path(spark, f"landed-{w}") for w in "AB"}
    checkpoints = {w: staging_path(spark, f"checkpoint-{w}") for w in "AB"}
    orders = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_totalprice").alias("total"), F.col("o_orderkey").alias("ordinal"))
    orders.select(F.to_json(F.struct("*")).alias("value")).write.text(folders["A"])
    orders.where("ordinal % 3 = 0").select(F.to_json(F.struct("*")).alias("value")).write.text(folders["B"])

    def run(writer: str) -> None:
        def rows(batch: DataFrame) -> DataFrame:
            row = F.from_json("raw", "id string, total double, ordinal bigint").alias("row")
            return batch.select(row).select("row.*", F.lit(writer).alias("writer"), F.lit(0).cast("bigint").alias("page_no"))

        stream_upsert(landed_stream(spark, folders[writer]), rows, path, spec, checkpoints[writer], parts=4).awaitTermination()

    run("A")
    run("B")
    delete(spark, f"{checkpoints['A']}/commits/0")  # as if the first stream had died before it could note its batch
    run("A")
    return tables.read_table(spark, path).select("id", "writer", "total")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status, o_totalprice AS total FROM orders", name="stream_upsert")
def stream_upsert_pages(spark, d):
    """Landed pages loaded in micro-batches; two of the loads bring the same rows."""
    landed = landed_stream(spark, land(spark, d, "sql_pages"), files_per_batch=2)

    def rows(batch: DataFrame) -> DataFrame:
        items = pages.explode_items(pages.envelopes(batch))
        return infer.to_columns(items, ["id", "status", "total"], {"total": "numeric"}, ["page_no", "ordinal"])

    path = staging_path(spark, "stream-table")
    spec = TableSpec("orders", ("id",), True)
    for run in ("first", "again"):
        stream_upsert(landed, rows, path, spec, staging_path(spark, f"stream-{run}"), parts=4).awaitTermination()
    return tables.read_table(spark, path)


# ---- filters ----------------------------------------------------------------------------------------


@query("""
    SELECT p_partkey, p_name, 'contains' AS op FROM part WHERE lower(p_name) LIKE '%ring%'
    UNION ALL SELECT p_partkey, p_name, 'doesNotContain' FROM part WHERE lower(p_name) NOT LIKE '%ring%'
    UNION ALL SELECT p_partkey, p_name, 'startsWith' FROM part WHERE lower(p_name) LIKE 'small%'
    UNION ALL SELECT p_partkey, p_name, 'doesNotStartWith' FROM part WHERE lower(p_name) NOT LIKE 'small%'
    UNION ALL SELECT p_partkey, p_name, 'is' FROM part WHERE lower(p_name) = 'red widget'
    UNION ALL SELECT p_partkey, p_name, 'isNot' FROM part WHERE lower(p_name) <> 'red widget'
    UNION ALL SELECT p_partkey, p_name, 'hasKeywords' FROM part WHERE lower(p_name) LIKE '%ring%' AND lower(p_name) LIKE '%small%'
    UNION ALL SELECT p_partkey, p_name, 'notEmpty' FROM part WHERE p_name <> ''
    UNION ALL SELECT p_partkey, p_name, 'empty' FROM part WHERE p_name = '' OR p_name IS NULL
""")
def filter_string(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_name")
    values = {
        "contains": "Ring", "doesNotContain": "ring", "startsWith": "SMALL", "doesNotStartWith": "small", "is": "Red Widget",
        "isNot": "red widget", "hasKeywords": "ring small", "notEmpty": None, "empty": None,
    }
    return _tagged(part, "p_name", values)


def _tagged(df: DataFrame, field: str, values: dict, **options) -> DataFrame:
    """One scan for many operators: each row once per operator it matches."""
    tags = []
    for op, value in values.items():
        first, second = value if isinstance(value, tuple) else (value, None)
        tags.append(F.when(predicates.condition(df, field, op, first, second, **options), F.lit(op)))
    return df.withColumn("op", F.explode(F.array_compact(F.array(*tags))))


NUMBER_VALUES = {
    "equalTo": 7, "notEqualTo": 7, "lessThan": 7, "greaterThan": 40, "lessThanOrEqualTo": 7, "greaterThanOrEqualTo": 40,
    "between": (10, 12), "notBetween": (3, 48), "notLessThan": 48, "notGreaterThan": 3, "notLessThanOrEqualTo": 48,
    "notGreaterThanOrEqualTo": 3, "notEmpty": None, "empty": None,
}


def number_oracle(source: str, key: str, value: str) -> str:
    cases = {
        "equalTo": "v = 7", "notEqualTo": "v <> 7", "lessThan": "v < 7", "greaterThan": "v > 40", "lessThanOrEqualTo": "v <= 7",
        "greaterThanOrEqualTo": "v >= 40", "between": "v BETWEEN 10 AND 12", "notBetween": "v NOT BETWEEN 3 AND 48",
        "notLessThan": "v >= 48", "notGreaterThan": "v <= 3", "notLessThanOrEqualTo": "v > 48", "notGreaterThanOrEqualTo": "v < 3",
        "notEmpty": "v IS NOT NULL", "empty": "v IS NULL",
    }
    union = " UNION ALL ".join(f"SELECT k, '{op}' AS op FROM t WHERE {test}" for op, test in cases.items())
    return f"WITH t AS (SELECT {key} AS k, {value} AS v FROM {source}) SELECT op, COUNT(*) AS n, CAST(SUM(k) AS BIGINT) AS keys FROM ({union}) GROUP BY op"


def _counted(df: DataFrame, field: str, values: dict, **options) -> DataFrame:
    """Matches per operator and the sum of their keys ``k``, all in one aggregation over one scan."""
    entries = []
    for op, value in values.items():
        first, second = value if isinstance(value, tuple) else (value, None)
        match = predicates.condition(df, field, op, first, second, **options)
        entries.append(F.struct(F.lit(op).alias("op"), F.count_if(match).alias("n"), F.sum(F.when(match, F.col("k"))).alias("keys")))
    return df.agg(F.array(*entries).alias("all")).select(F.inline("all")).where(F.col("n") > 0)


@query(number_oracle("part", "p_partkey", "p_size"))
def filter_number(spark, d):
    part = table(spark, d, "part").select(F.col("p_partkey").alias("k"), F.col("p_size").alias("v"))
    return _counted(part, "v", NUMBER_VALUES)


@query(number_oracle("lineitem", "l_orderkey", "l_quantity"))
def filter_double(spark, d):
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_quantity").alias("v"))
    return _counted(lines, "v", NUMBER_VALUES)


@query(number_oracle("part", "p_partkey", "CASE WHEN p_size <> 20 THEN p_size END"))
def filter_text_number(spark, d):
    """Numbers kept as text; blank ones match nothing but ``empty``."""
    text = F.when(F.col("p_size") != 20, F.col("p_size").cast("string"))
    part = table(spark, d, "part").select(F.col("p_partkey").alias("k"), text.alias("v"))
    return _counted(part, "v", NUMBER_VALUES, kind="text_number")


@query("""
    WITH t AS (SELECT l_orderkey AS k, l_shipdate AS v FROM lineitem), u AS (
        SELECT k, 'on' AS op FROM t WHERE CAST(v AS DATE) = DATE '1998-03-05'
        UNION ALL SELECT k, 'notOn' FROM t WHERE CAST(v AS DATE) <> DATE '1998-03-05'
        UNION ALL SELECT k, 'before' FROM t WHERE CAST(v AS DATE) < DATE '1998-03-05'
        UNION ALL SELECT k, 'notBefore' FROM t WHERE CAST(v AS DATE) >= DATE '1998-03-05'
        UNION ALL SELECT k, 'after' FROM t WHERE CAST(v AS DATE) > DATE '1998-03-05'
        UNION ALL SELECT k, 'notAfter' FROM t WHERE CAST(v AS DATE) <= DATE '1998-03-05'
        UNION ALL SELECT k, 'onOrBefore' FROM t WHERE CAST(v AS DATE) <= DATE '1998-03-05'
        UNION ALL SELECT k, 'notOnOrBefore' FROM t WHERE CAST(v AS DATE) > DATE '1998-03-05'
        UNION ALL SELECT k, 'ON_OR_AFTER' FROM t WHERE CAST(v AS DATE) >= DATE '1998-03-05'
        UNION ALL SELECT k, 'notOnOrAfter' FROM t WHERE CAST(v AS DATE) < DATE '1998-03-05'
        UNION ALL SELECT k, 'within' FROM t WHERE CAST(v AS DATE) BETWEEN DATE '1998-03-05' AND DATE '1998-04-01'
        UNION ALL SELECT k, 'notWithin' FROM t WHERE CAST(v AS DATE) NOT BETWEEN DATE '1998-03-05' AND DATE '1998-04-01'
        UNION ALL SELECT k, 'notEmpty' FROM t WHERE v IS NOT NULL)
    SELECT op, COUNT(*) AS n, CAST(SUM(k) AS BIGINT) AS keys FROM u GROUP BY op
""")
def filter_date(spark, d):
    day = date(1998, 3, 5)
    values = dict.fromkeys(
        ["on", "notOn", "before", "notBefore", "after", "notAfter", "onOrBefore", "notOnOrBefore", "ON_OR_AFTER", "notOnOrAfter"], day
    ) | {"within": (day, "1998-04-01"), "notWithin": (day, "1998-04-01"), "notEmpty": None}
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_shipdate").alias("v"))
    return _counted(lines, "v", values)


@query("""
    SELECT o_orderkey, 'anyOf' AS op FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
    UNION ALL SELECT o_orderkey, 'noneOf' FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')
""")
def filter_anyof(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    wanted = ["1-urgent", "2-High"]
    return _tagged(orders, "o_orderpriority", {"anyOf": wanted, "noneOf": wanted}).drop("o_orderpriority")


@query("""
    SELECT 'greaterThan' AS op, l_orderkey, l_linenumber FROM lineitem WHERE CAST(l_extendedprice AS DECIMAL(12, 2)) > 20000.016
    UNION ALL SELECT 'between', l_orderkey, l_linenumber FROM lineitem WHERE CAST(l_extendedprice AS DECIMAL(12, 2)) BETWEEN 1000.005 AND 1999.994
    UNION ALL SELECT 'lessThan', l_orderkey, l_linenumber FROM lineitem WHERE l_linenumber < 3
    UNION ALL SELECT 'notGreaterThan', l_orderkey, l_linenumber FROM lineitem
""")
def filter_decimal(spark, d):
    """Values between two steps of a decimal column, and beyond the range of a whole-number one."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("decimal(12,2)").alias("price"), F.col("l_linenumber").cast("int").alias("no"))
    found = [
        predicates.search_filter(lines, "price", "greaterThan", 20000.016).withColumn("op", F.lit("greaterThan")),
        predicates.search_filter(lines, "price", "between", 1000.005, 1999.994).withColumn("op", F.lit("between")),
        predicates.search_filter(lines, "no", "lessThan", 2.5).withColumn("op", F.lit("lessThan")),
        predicates.search_filter(lines, "no", "notGreaterThan", 3_000_000_000).withColumn("op", F.lit("notGreaterThan")),
    ]
    return reduce(DataFrame.unionByName, found).select("op", "l_orderkey", "l_linenumber")


@query("SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS written FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-02'")
def filter_text_date(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "dd/MM/yyyy").alias("written"))
    return predicates.search_filter(orders, "written", "onOrAfter", "1998-01-02", kind="date", date_format="dd/MM/yyyy")


DEEP = "[" * 40 + "1" + "]" * 40


@query("""SELECT o_orderkey, '{"token_secret":"REDACTED","a":{"tok\\u0065n_id":"REDACTED","keep":"' || o_orderstatus || '"}}' AS raw FROM orders""")
def redact_keys_deep(spark, d):
    """Secrets 40 brackets deep, and under a name spelled with an escape."""
    raw = F.concat(F.lit('{"token_secret":' + DEEP + ',"a":{"tok\\u0065n_id":"x","keep":"'), "o_orderstatus", F.lit('"}}'))
    return table(spark, d, "orders").select("o_orderkey", redact.redact_keys(raw).alias("raw"))


@query("""SELECT o_orderkey AS ordinal, '{"status":"' || o_orderstatus || '","a":{"b":1}}' AS raw FROM orders""")
def strip_links_deep(spark, d):
    raw = F.concat(F.lit('{"links":' + DEEP + ',"status":"'), "o_orderstatus", F.lit('","a":{"b":1,"l\\u0069nks":' + DEEP + '}}'))
    return shape.parsed(table(spark, d, "orders").select(F.col("o_orderkey").alias("ordinal"), raw.alias("raw"))).select("ordinal", "raw")


@query("""
    WITH n AS (SELECT l_orderkey, l_linenumber, l_quantity, l_partkey % 50 AS record,
                      row_number() OVER (PARTITION BY l_partkey % 50 ORDER BY l_orderkey, l_linenumber) - 1 AS place FROM lineitem)
    SELECT CAST(record AS VARCHAR) AS _parent_id, CAST(place % 6000 AS BIGINT) AS line, CAST(MAX(place) AS BIGINT) AS seen
    FROM n GROUP BY record, place % 6000
""")
def child_upsert_long(spark, d):
    """Records of many lines that repeat their keys: the last line of each key is kept.

    A record comes in documents of so many lines, as later documents of a record replace what earlier ones brought: a row
    stays of one size, however many lines there are.
    """
    at = F.row_number().over(Window.partitionBy("record").orderBy("l_orderkey", "l_linenumber")) - 1
    lines = table(spark, d, "lineitem").withColumn("record", F.col("l_partkey") % 50).withColumn("at", at)
    line = F.struct("at", (F.col("at") % 6000).alias("line"), F.col("at").alias("seen"))
    items = F.transform(F.array_sort(F.collect_list(line)), lambda x: F.struct(x["line"].alias("line"), x["seen"].alias("seen")))
    docs = lines.groupBy("record", F.floor(F.col("at") / LONG_DOCUMENT).alias("document")).agg(items.alias("items"))
    raw = F.to_json(F.struct(F.col("record").cast("string").alias("id"), F.struct("items").alias("item")))
    landed = docs.select((F.col("document") * 50 + F.col("record")).alias("ordinal"), F.lit(0).alias("page_no"), raw.alias("raw"))
    found = extract.extract_records(landed, record_type="long", primary_key=["id"], child_tables=True, incremental=True, keep_order=True)
    folder = staging_path(spark, "long")
    tables.write_tables(found, folder)
    return tables.read_table(spark, f"{folder}/long_item").select("_parent_id", "line", "seen")


@query("SELECT doc_id, toxic = 1 AS flagged FROM labels WHERE toxic = 1")
def filter_bool(spark, d):
    labels = table(spark, d, "labels").select("doc_id", (F.col("toxic") == 1).alias("flagged"))
    return predicates.search_filter(labels, "flagged", "is", True)


RANGES = (
    "yesterday", "lastWeek", "thisWeekToDate", "lastMonth", "thisMonthToDate", "nextMonth", "thisYear", "lastFiscalQuarter",
    "thisFiscalYear", "lastFiscalYear", "tenDaysAgo", "thirtyDaysFromNow", "monthBeforeLast",
)


@query("""
    WITH n AS (SELECT DATE '2000-05-17' AS t), r AS (
        SELECT 'yesterday' AS name, t - 1 AS s, t AS e FROM n
        UNION ALL SELECT 'lastWeek', date_trunc('week', t) - INTERVAL 7 DAY, date_trunc('week', t) FROM n
        UNION ALL SELECT 'thisWeekToDate', date_trunc('week', t), t + 1 FROM n
        UNION ALL SELECT 'lastMonth', date_trunc('month', t) - INTERVAL 1 MONTH, date_trunc('month', t) FROM n
        UNION ALL SELECT 'thisMonthToDate', date_trunc('month', t), t + 1 FROM n
        UNION ALL SELECT 'nextMonth', date_trunc('month', t) + INTERVAL 1 MONTH, date_trunc('month', t) + INTERVAL 2 MONTH FROM n
        UNION ALL SELECT 'thisYear', date_trunc('year', t), date_trunc('year', t) + INTERVAL 1 YEAR FROM n
        UNION ALL SELECT 'lastFiscalQuarter', DATE '2000-01-01', DATE '2000-04-01' FROM n
        UNION ALL SELECT 'thisFiscalYear', DATE '1999-07-01', DATE '2000-07-01' FROM n
        UNION ALL SELECT 'lastFiscalYear', DATE '1998-07-01', DATE '1999-07-01' FROM n
        UNION ALL SELECT 'tenDaysAgo', t - 10, t - 9 FROM n
        UNION ALL SELECT 'thirtyDaysFromNow', t + 30, t + 31 FROM n
        UNION ALL SELECT 'monthBeforeLast', date_trunc('month', t) - INTERVAL 2 MONTH, date_trunc('month', t) - INTERVAL 1 MONTH FROM n)
    SELECT name, COUNT(*) AS n_orders, CAST(SUM(o_orderkey) AS BIGINT) AS keys
    FROM orders JOIN r ON o_orderdate >= s AND o_orderdate < e GROUP BY name
""")
def relative_ranges(spark, d):
    """Orders per named period, seen from one day, with a fiscal year that starts in July."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    entries = []
    for name in RANGES:
        match = predicates.condition(orders, "o_orderdate", "within", name, as_of=AS_OF, fiscal_start_month=7)
        entries.append(
            F.struct(F.lit(name).alias("name"), F.count_if(match).alias("n_orders"), F.sum(F.when(match, F.col("o_orderkey"))).alias("keys"))
        )
    return orders.agg(F.array(*entries).alias("all")).select(F.inline("all")).where(F.col("n_orders") > 0)


# ---- discovery --------------------------------------------------------------------------------------


@query("""
    SELECT CAST(p_partkey % 500 AS INTEGER) AS position, p_brand || '_' || p_type || '_' || p_partkey AS value,
           p_brand || '_' || p_type || '_' || p_partkey AS label FROM part
""")
def catalog_types(spark, d):
    return catalog.record_types(spark.read.text(land(spark, d, "type_catalog")), "value")


@query("""
    SELECT position, value, COUNT(*) AS n_types FROM (
        SELECT 0 AS position, 'z_' || p_type AS value FROM part
        UNION ALL SELECT 1, p_brand FROM part UNION ALL SELECT 2, 'a_' || p_size FROM part)
    GROUP BY position, value
""")
def catalog_fields(spark, d):
    fields = catalog.record_fields(spark.read.text(land(spark, d, "type_schemas")), "value")
    return fields.groupBy("position", "value").agg(F.count("*").alias("n_types"))


@query("""
    SELECT CASE WHEN s_acctbal > 5000 THEN 'search' || s_suppkey WHEN s_nationkey < 20 THEN CAST(s_suppkey AS VARCHAR) ELSE s_name END AS value,
           CASE WHEN s_nationkey >= 10 THEN s_name WHEN s_acctbal > 5000 THEN 'search' || s_suppkey ELSE CAST(s_suppkey AS VARCHAR) END AS label
    FROM supplier
""")
def catalog_searches(spark, d):
    key, nation = F.col("s_suppkey").cast("string"), F.col("s_nationkey")
    searches = table(spark, d, "supplier").select(
        F.when(F.col("s_acctbal") > 5000, F.concat(F.lit("search"), key)).otherwise("").alias("scriptId"),
        F.when(nation < 20, key).alias("internalId"),
        F.when(nation >= 10, F.col("s_name")).alias("name"),
    )
    return catalog.saved_searches(searches)


@query("""
    SELECT CAST(c_custkey AS VARCHAR) AS "internalId", CAST(c_custkey AS VARCHAR) AS "entityId", c_name AS "companyName" FROM customer
""")
def search_xml_rows(spark, d):
    found = search_xml.read_search_pages(spark, land(spark, d, "search_xml"), layout="lines")
    return search_xml.search_rows(found).select("internalId", "entityId", "companyName")


@query('SELECT c_custkey AS "internalId", c_custkey AS "entityId", c_name AS "companyName" FROM customer')
def search_xml_types(spark, d):
    """The same with the types of the values."""
    found = search_xml.read_search_pages(spark, land(spark, d, "search_xml"), layout="lines")
    rows = extract.extract_search(found, search_id="s1", search_record_type="customer", primary_key=["internalId"])["s1"].df
    return rows.select("internalId", "entityId", "companyName")


@query("""
    SELECT 'S1' AS search_id, MAX(c_custkey) // 100 + 1 AS pages_expected, COUNT(DISTINCT c_custkey // 100) AS pages_seen,
           MAX(c_custkey) // 100 + 1 - COUNT(DISTINCT c_custkey // 100) AS pages_missing FROM customer
""")
def search_page_count(spark, d):
    found = search_xml.read_search_pages(spark, land(spark, d, "search_xml"), layout="lines")
    return pagesets.search_completeness(search_xml.search_page_info(found))


# ---- parallel reads through a supplied function -----------------------------------------------------


def _read_folder(uri: str) -> str:
    source, path = fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")
    files = [f for f in source.get_file_info(fs.FileSelector(path)) if f.base_name.startswith("part-")]
    texts = []
    for file in files:
        with source.open_input_stream(file.path) as stream:
            texts.append(stream.read().decode())
    return "".join(texts)


@lru_cache(maxsize=32)
def _document_block(folder: str, number: int) -> dict[str, str]:
    lines = _read_folder(f"{folder}/block={number}").splitlines()
    return {json.loads(line)["id"]: line for line in lines}


@query("""
    SELECT o_orderkey AS ordinal, CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status FROM orders
""")
def paged_source(spark, d):
    folder = land(spark, d, "sql_page_files")

    def fetch(offset: int, limit: int) -> str:
        return _read_folder(f"{folder}/page_offset={offset}").strip()

    total = remote.page_total(fetch(0, PAGE))
    landed = remote.paged_source(spark, fetch, total, PAGE, pages_per_task=4)
    rows = pages.explode_items(pages.envelopes(landed.select("raw")))
    return rows.select("ordinal", "id", get("doc", "$.status", "string").alias("status"))


@query("""
    SELECT o_orderkey AS ordinal, CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderkey AS VARCHAR) END AS id, o_orderstatus AS status FROM orders
""")
def distributed_details(spark, d):
    folder = land(spark, d, "document_blocks")

    def fetch(record_id: str) -> str:
        return _document_block(folder, int(record_id) // 200)[record_id]

    collection = pages.read_collection(spark, land(spark, d, "collection"))
    found = remote.fetch_details(collection, fetch, tasks=spark.sparkContext.defaultParallelism)
    return found.select("ordinal", "id", get("doc", "$.status", "string").alias("status"))


# ---- redaction --------------------------------------------------------------------------------------


@query(f"""
    SELECT doc_id, regexp_replace(text, '{redact.EMAIL_PATTERN}', '{redact.EMAIL_REPLACEMENT}', 'g') AS text FROM documents
""")
def redact_email(spark, d):
    return table(spark, d, "documents").select("doc_id", redact.redact_email("text").alias("text"))


@query(r"""
    SELECT page_id, regexp_replace(url, '//[A-Za-z0-9-]+\.(ththth|tionsh)\.example\.net', '//account.\1.example.net', 'g') AS url,
           regexp_replace(html, '//[A-Za-z0-9-]+\.(ththth|tionsh)\.example\.net', '//account.\1.example.net', 'g') AS html FROM pages
""")
def redact_host(spark, d):
    services = ("ththth", "tionsh")
    found = table(spark, d, "pages")
    return found.select("page_id", *[redact.redact_host(c, services, "example.net").alias(c) for c in ("url", "html")])


@query("""
    SELECT c_custkey, '<p:passport>\n<c:account x="1">REDACTED</c:account><name>' || c_name || '</name><token>REDACTED</token></p:passport>' AS body FROM customer
""")
def redact_xml(spark, d):
    body = F.concat(
        F.lit('<p:passport>\n<c:account x="1">'), F.col("c_nationkey"), F.lit("\n"), F.col("c_acctbal"), F.lit("</c:account><name>"),
        F.col("c_name"), F.lit("</name><token>"), F.col("c_mktsegment"), F.lit("</token></p:passport>"),
    )
    return table(spark, d, "customer").select("c_custkey", redact.redact_xml(body).alias("body"))


@query("""
    SELECT c_custkey, '{"id":' || c_custkey || ',"token_id":"REDACTED","in":{"nonce":"REDACTED","name":"' || c_name || ' \\"nonce\\": 1"},"list":[{"signature":"REDACTED"}]}' AS body
    FROM customer
""")
def redact_keys(spark, d):
    body = F.concat(
        F.lit('{"id":'), F.col("c_custkey"), F.lit(',"token_id":"'), F.col("c_mktsegment"), F.lit('","in":{"nonce":{"a":[1,'),
        F.col("c_nationkey"), F.lit(']},"name":"'), F.col("c_name"), F.lit(' \\"nonce\\": 1"},"list":[{"signature":'), F.col("c_acctbal"), F.lit("}]}"),
    )
    return table(spark, d, "customer").select("c_custkey", redact.redact_keys(body).alias("body"))
