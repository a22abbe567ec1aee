"""SQL over registered tables, with a date range bound as typed parameters.

``:date_from`` and ``:date_to`` are named parameter markers, so they never reach into string literals and
keep their type; the filter they take part in is pushed to the scan like one on literals.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.errors import ExtractError
from tributary.functions.dates import resolve_range
from tributary.session import staging_path
from tributary.sinks.files import delete

_RANGE = "_range"
MARKERS = ("date_from", "date_to")

# String literals, quoted names and comments, in which a marker is just text.
_QUOTED = re.compile(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|--[^\n]*|/\*.*?\*/", re.DOTALL)


def markers_in(query: str) -> set[str]:
    text = _QUOTED.sub(" ", query)
    return {m for m in MARKERS if re.search(rf":{m}\b", text)}


def check_range(query: str, date_from: str = "") -> None:
    """A range without markers would do nothing, and markers without a start cannot be bound."""
    if not query:
        raise ExtractError("sql mode needs a query")
    used = markers_in(query)
    if date_from and not used:
        raise ExtractError("a start date is given, but the query has no :date_from or :date_to marker")
    if used and not date_from:
        raise ExtractError("the query has :date_from or :date_to markers, but no start date is given")


def _timestamp(instant: datetime) -> Column:
    return F.expr(f"TIMESTAMP_NTZ'{instant:%Y-%m-%d %H:%M:%S}'")


def run_query(
    spark: SparkSession,
    query: str,
    date_from: str = "",
    date_to: str = "now",
    *,
    as_of: datetime | None = None,
    args: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Run a query as written; dates may be absolute or relative to ``as_of``, in UTC."""
    check_range(query, date_from)
    bound = dict(args or {})
    used = markers_in(query)
    if used:
        start, end = resolve_range(date_from, date_to, as_of)
        values = {"date_from": _timestamp(start), "date_to": _timestamp(end)}
        bound |= {m: values[m] for m in used}
    return spark.sql(query, args=bound) if bound else spark.sql(query)


def _probe(spark: SparkSession, query: str, args: Mapping[str, Any] | None = None) -> DataFrame:
    if not query:
        raise ExtractError("enter a query first")
    epoch = _timestamp(datetime(1970, 1, 1))
    bound = dict(args or {}) | dict.fromkeys(markers_in(query), epoch)
    return spark.sql(query, args=bound) if bound else spark.sql(query)


def probe_columns(spark: SparkSession, query: str, args: Mapping[str, Any] | None = None) -> list[str]:
    """Columns a query returns. Analysis only: no job runs, and a query without rows has columns too."""
    return _probe(spark, query, args).columns


def validate_query(spark: SparkSession, query: str, args: Mapping[str, Any] | None = None) -> None:
    """Raise Spark's parse or analysis error for a wrong query; nothing is read."""
    _probe(spark, query, args).schema  # noqa: B018 - analysis is the check


def page_after(df: DataFrame, order_by: Sequence[str], last: Sequence[object], limit: int) -> DataFrame:
    """The page that follows the row with the values ``last`` of the order columns (which are not NULL).

    However deep the page is, tasks sort and keep ``limit`` rows only.
    """
    if len(last) != len(order_by):
        raise ExtractError("a page goes on after one value for each order column")
    past = F.lit(False)
    for k in range(len(order_by)):
        step = F.col(order_by[k]) > F.lit(last[k])
        for name, value in zip(order_by[:k], last[:k], strict=True):
            step = step & (F.col(name) == F.lit(value))
        past = past | step
    return df.where(past).orderBy(*order_by).limit(limit)


def page_of(df: DataFrame, order_by: Sequence[str | Column], limit: int, offset: int = 0) -> DataFrame:
    """One page of a result. The order should be total, else pages may overlap. Deep pages: see ``page_after`` and ``SortedPages``."""
    ordered = df.orderBy(*order_by)
    return (ordered.offset(offset) if offset else ordered).limit(limit)


class SortedPages:
    """A result in order, of which any page can be taken without sorting or counting what comes before it again.

    Rows are dealt to ranges of the order and written sorted, one folder a range; the number of rows in each range gives
    where it begins. A page reads the ranges it meets, usually one. ``order`` must be total, or rows that are equal in it
    be equal. Only the counts, one a range, come to the driver.
    """

    def __init__(self, df: DataFrame, order: Sequence[Column | str], ranges: int | None = None):
        self.order, self.columns = list(order), df.columns
        dealt = df.repartitionByRange(*([ranges] if ranges else []), *self.order).sortWithinPartitions(*self.order)
        self.path = staging_path(df.sparkSession, "sorted")
        self.spark, kept = df.sparkSession, dealt.withColumn(_RANGE, F.spark_partition_id())
        kept.write.partitionBy(_RANGE).parquet(self.path)
        self.schema = kept.schema
        self.counts = [(r[_RANGE], r["count"]) for r in self._read().groupBy(_RANGE).count().orderBy(_RANGE).collect()]

    def _read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    @property
    def n_rows(self) -> int:
        return sum(n for _, n in self.counts)

    def page(self, limit: int, offset: int) -> DataFrame:
        """Rows ``offset`` to ``offset + limit`` of the result, in order."""
        if limit < 0 or offset < 0:
            raise ExtractError("limit and offset can't be negative")
        met, skipped, begin = [], 0, 0
        for number, n in self.counts:
            if begin + n <= offset:
                skipped = begin + n
            elif begin < offset + limit:
                met.append(number)
            begin += n
        return self._read().where(F.col(_RANGE).isin(met)).orderBy(*self.order).offset(offset - skipped if met else 0).limit(limit if met else 0).select(*[f"`{c}`" for c in self.columns])

    def drop(self) -> None:
        delete(self.spark, self.path)
