"""Checks over landed page sets: is every row of every page there, once?

Pages are compared by aggregations on ``(page_set, offset)``, which is near unique. There is no window over
a page set, so one very long page set is spread like any other data. Every check works on rows of
``page_set, page_offset, page_count, has_more, total, next_href`` (and ``items`` for completeness).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.jsontext import get, is_falsy, path_of
from tributary.operators.ranking import places
from tributary.session import stage
from tributary.sources.pages import value_at
from tributary.sources.remote import MAX_PAGE_SIZE


def next_link_offset(href: Column | str = "next_href") -> Column:
    """Offset a next link points to."""
    return F.regexp_extract(href, r"[?&]offset=(\d+)", 1).try_cast("bigint")


def expected_pages(total: Column | str, limit: int) -> Column:
    """Pages needed for ``total`` rows; no page holds more than the largest page size."""
    size = F.least(F.lit(limit), F.lit(MAX_PAGE_SIZE))
    return F.ceil(F.col(total) / size if isinstance(total, str) else total / size).cast("bigint")


def _gaps(pages: DataFrame, next_offset: Column) -> DataFrame:
    """Faults of a chain, from one aggregation.

    Every page is present at its own offset and wants the page at its next offset. Counting both per
    offset, before the shuffle, shows what is wanted but not present, present but not wanted, and
    present more than once.
    """
    at, wanted_by, following = (F.lit(None).cast("bigint").alias(n) for n in ("at", "wanted_by", "following"))
    chained = pages.select("page_set", "page_offset", next_offset.alias("next_offset"))
    present = F.struct(F.col("page_offset").alias("at"), wanted_by, F.col("next_offset").alias("following"), F.lit(1).alias("here"))
    wants = F.struct(F.col("next_offset").alias("at"), F.col("page_offset").alias("wanted_by"), following, F.lit(0).alias("here"))
    sightings = chained.select("page_set", F.inline(F.filter(F.array(present, wants), lambda x: x["at"].isNotNull())))
    offsets = sightings.groupBy("page_set", "at").agg(
        F.sum("here").alias("copies"), F.min("wanted_by").alias("wanted_by"), F.max("following").alias("following")
    )
    missing, loose = F.col("copies") == 0, (F.col("copies") > 0) & F.col("wanted_by").isNull() & (F.col("at") > 0)
    problems = F.array(F.when(missing, "missing_next"), F.when(loose, "unreferenced"), F.when(F.col("copies") > 1, "repeated"))
    return offsets.select(
        "page_set",
        F.when(missing, F.col("wanted_by")).otherwise(F.col("at")).alias("page_offset"),
        F.when(missing, F.col("at")).otherwise(F.col("following")).alias("next_offset"),
        F.explode(F.array_compact(problems)).alias("problem"),
    )


def link_gaps(pages: DataFrame) -> DataFrame:
    """Faults in a chain of next links: ``page_set, page_offset, next_offset, problem``.

    ``missing_next``: the page linked to is not there (one row per missing page, with the first page that
    links to it). ``unreferenced``: no page links here, and it is not the first. ``repeated``: landed more
    than once.
    """
    return _gaps(pages, next_link_offset())


def unreached_pages(pages: DataFrame) -> DataFrame:
    """Pages the first page of their set never leads to: ``page_set, page_offset, problem, first_offset``.

    ``loose``: the page follows one that no page links to, at ``first_offset``. ``ring``: it leads back to itself.
    ``behind_ring``: it follows a ring. A ring is named by its least offset. A page that landed more than once is one
    page; where several link to a page, the one with the least offset counts. Pages without an offset can't be
    reached or followed and are left out.
    """
    page = F.struct("page_set", "page_offset")
    present = pages.where(F.col("page_offset").isNotNull())
    # One aggregation for both: a page is present at its own offset, and stands before the page it links to.
    uses = F.array(
        F.struct(page.alias("node"), F.lit(None).cast(pages.schema["page_offset"].dataType).alias("before"), F.lit(1).alias("here")),
        F.struct(F.struct("page_set", F.col("next_offset").alias("page_offset")).alias("node"), F.col("page_offset").alias("before"), F.lit(0).alias("here")),
    )
    linked = present.select("page_set", "page_offset", next_link_offset().cast(pages.schema["page_offset"].dataType).alias("next_offset"))
    seen = linked.select(F.inline(F.filter(uses, lambda u: u["node"]["page_offset"].isNotNull()))).groupBy("node").agg(F.min("before").alias("before"), F.sum("here").alias("here")).where("here > 0")
    # The page at offset 0 is the first one, whatever links to it.
    before = F.when(F.col("before").isNotNull() & (F.col("node.page_offset") != 0), F.struct(F.col("node.page_set").alias("page_set"), F.col("before").alias("page_offset")))
    found = places(seen.select("node", before.alias("before")))
    problem = F.when(F.col("kind") == "ring", "ring").when(F.col("kind") == "behind", "behind_ring").when(F.col("first.page_offset") > 0, "loose")
    rows = found.select(F.col("node.page_set").alias("page_set"), F.col("node.page_offset").alias("page_offset"), problem.alias("problem"), F.col("first.page_offset").alias("first_offset"))
    return rows.where(F.col("problem").isNotNull())


def offset_gaps(pages: DataFrame, limit: int) -> DataFrame:
    """The same for pages that only say ``hasMore``: the next page starts one page size further."""
    size = min(limit, MAX_PAGE_SIZE)
    return _gaps(pages, F.when(F.col("has_more"), F.col("page_offset") + size))


def page_completeness(pages: DataFrame, limit: int | None = None) -> DataFrame:
    """Per page set: rows and pages expected and seen, repeated pages, and rows missing.

    Rows of a page that landed twice count once.
    """
    once = pages.groupBy("page_set", "page_offset").agg(
        F.count("*").alias("copies"), F.max(F.size("items")).alias("rows"), F.max("total").alias("total")
    )
    report = once.groupBy("page_set").agg(
        F.max("total").alias("rows_expected"),
        F.sum("rows").cast("bigint").alias("rows_seen"),
        F.count("*").alias("pages_seen"),
        F.sum(F.col("copies") - 1).cast("bigint").alias("pages_repeated"),
    )
    report = report.withColumn("rows_missing", F.col("rows_expected") - F.col("rows_seen"))
    return report if limit is None else report.withColumn("pages_expected", expected_pages("rows_expected", limit))


def search_completeness(info: DataFrame) -> DataFrame:
    """Per saved search: pages expected and seen. Without a search id there is only the first page."""
    once = info.groupBy("search_id", "page_index").agg(F.max("total_pages").alias("total_pages"))
    expected = F.when(F.col("search_id").isNull(), F.lit(1)).otherwise(F.max("total_pages"))
    seen = F.count_if(F.col("page_index").between(1, F.col("total_pages")))
    return once.groupBy("search_id").agg(expected.cast("bigint").alias("pages_expected"), seen.alias("pages_seen")).withColumn(
        "pages_missing", F.greatest(F.col("pages_expected") - F.col("pages_seen"), F.lit(0)).cast("bigint")
    )


def sublist_completeness(documents: DataFrame, sublist: str) -> DataFrame:
    """Per document: items present in a sublist against its own ``totalResults`` and ``hasMore``."""
    items = F.size(get("doc", path_of(sublist, "items"), "array<variant>"))
    total = get("doc", path_of(sublist, "totalResults"), "bigint")
    more = F.coalesce(get("doc", path_of(sublist, "hasMore"), "boolean"), F.lit(False))
    checked = documents.select(
        get("doc", "$.id", "string").alias("id"),
        F.coalesce(items, F.lit(0)).cast("bigint").alias("items_seen"),
        total.alias("items_expected"),
        more.alias("has_more"),
    )
    complete = ~F.col("has_more") & (F.coalesce("items_expected", "items_seen") == F.col("items_seen"))
    return checked.withColumn("complete", complete)


def with_cursor(pages: DataFrame, cursor_field: str) -> DataFrame:
    """``page_no, cursor_in, cursor_out``: the cursor sent for a page and the one it hands out.

    A cursor that is absent, null, false, zero or empty ends the chain.
    """
    value = value_at("doc", cursor_field)
    return pages.select("page_no", "cursor_in", F.when(~is_falsy(value), get(value, "$", "string")).alias("cursor_out"))


def cursor_chain(cursors: DataFrame) -> DataFrame:
    """``page_no, cursor_out, next_page, status`` per page.

    ``last``: no cursor. ``followed``: a page was fetched with this cursor. ``missing``: none was.
    ``repeat``: an earlier page already handed out this cursor, so following it would never end.
    """
    nobody = F.lit(None).cast("bigint")
    uses = F.array(
        F.struct(F.col("cursor_out").alias("cursor"), F.col("page_no").alias("given_by"), nobody.alias("fetched")),
        F.struct(F.col("cursor_in").alias("cursor"), nobody.alias("given_by"), F.col("page_no").alias("fetched")),
    )
    # One row per cursor, whatever the number of pages that share it.
    known = (
        cursors.select(F.inline(F.filter(uses, lambda use: use["cursor"].isNotNull())))
        .groupBy("cursor")
        .agg(F.min("given_by").alias("first_given"), F.min("fetched").alias("next_page"))
    )
    # Pages without a cursor get a key that matches nothing and differs per page, so they stay spread.
    key = F.coalesce("cursor_out", F.concat(F.lit("\u0000page "), F.col("page_no").cast("string")))
    status = (
        F.when(F.col("cursor_out").isNull(), "last")
        .when(F.col("page_no") > F.col("first_given"), "repeat")
        .when(F.col("next_page").isNull(), "missing")
        .otherwise("followed")
    )
    joined = cursors.withColumn("key", key).join(known, F.col("key") == F.col("cursor"), "left")
    return joined.select("page_no", "cursor_out", "next_page", status.alias("status"))


def cursor_order(cursors: DataFrame) -> DataFrame:
    """``page_no, first_page, place, segment`` per page: where it stands, by the cursors alone and not by its number.

    ``chain``: it follows the page that was fetched without a cursor, ``place`` pages later. ``loose``: it follows
    ``first_page``, whose cursor no page hands out. ``ring``: its cursors lead back to it (``first_page`` is the least page
    number of the ring), and following them would never end. ``behind_ring``: it follows a ring. Where several pages
    hand out a cursor, the one with the least number counts; a page that landed twice is one page.
    """
    nobody = F.lit(None).cast(cursors.schema["page_no"].dataType)
    once = cursors.where(F.col("page_no").isNotNull()).groupBy("page_no").agg(F.min("cursor_in").alias("cursor_in"), F.min("cursor_out").alias("cursor_out"))
    given = once.where(F.col("cursor_out").isNotNull()).groupBy(F.col("cursor_out").alias("cursor")).agg(F.min("page_no").alias("before"))
    # Pages fetched without a cursor have nothing to look up, so they stay out of the join.
    sent = once.where(F.col("cursor_in").isNotNull()).join(given, F.col("cursor_in") == F.col("cursor"), "left").select("page_no", "before", F.col("before").isNull().alias("lost"))
    nodes = stage(sent.unionByName(once.where(F.col("cursor_in").isNull()).select("page_no", nobody.alias("before"), F.lit(False).alias("lost"))), "cursors")
    found = places(nodes.select(F.col("page_no").alias("node"), "before"))
    lost = nodes.where("lost").select(F.col("page_no").alias("lost_page"))
    segment = F.when(F.col("kind") == "behind", "behind_ring").when(F.col("lost_page").isNotNull(), "loose").otherwise(F.col("kind"))
    return found.join(lost, F.col("first") == F.col("lost_page"), "left").select(F.col("node").alias("page_no"), F.col("first").alias("first_page"), "place", segment.alias("segment"))
