"""Remote page sets and documents read in parallel through a function the caller supplies.

Only the reading pattern lives here: which page or id is read by which task. A task that is lost is
simply run again, so the functions passed in must be safe to repeat.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tributary.session import ship_package

# Fixed value: the largest page the record and SQL surfaces return.
MAX_PAGE_SIZE = 1000

FetchPage = Callable[[int, int], str]
FetchRecord = Callable[[str], str]


def page_size(limit: int) -> int:
    return min(limit, MAX_PAGE_SIZE)


class PageRange(InputPartition):
    def __init__(self, first: int, last: int):
        self.first = first
        self.last = last


class PagedReader(DataSourceReader):
    """One partition per run of pages; a task holds one page at a time."""

    def __init__(self, fetch: FetchPage, total: int, limit: int, pages_per_task: int):
        self.fetch = fetch
        self.size = page_size(limit)
        self.pages = -(-total // self.size)
        self.pages_per_task = pages_per_task

    def partitions(self) -> list[InputPartition]:
        starts = range(0, self.pages, self.pages_per_task)
        return [PageRange(s, min(s + self.pages_per_task, self.pages)) for s in starts] or [PageRange(0, 0)]

    def read(self, partition: PageRange) -> Iterator[pa.RecordBatch]:
        for page in range(partition.first, partition.last):
            offset = page * self.size
            yield pa.RecordBatch.from_pydict(
                {"page_offset": pa.array([offset], pa.int64()), "raw": pa.array([self.fetch(offset, self.size)], pa.string())}
            )


def paged_source(
    spark: SparkSession, fetch: FetchPage, total: int, limit: int = MAX_PAGE_SIZE, pages_per_task: int = 10
) -> DataFrame:
    """Landed pages ``page_offset, raw`` of an offset-addressed page set of ``total`` rows.

    The reader never waits for one page to learn the next: offsets follow from ``total`` and the page
    size, so page runs are read side by side.
    """

    ship_package(spark)

    class Pages(DataSource):
        @classmethod
        def name(cls) -> str:
            return "tributary_pages"

        def schema(self) -> str:
            return "page_offset bigint, raw string"

        def reader(self, schema) -> DataSourceReader:
            return PagedReader(fetch, total, limit, pages_per_task)

    spark.dataSource.register(Pages)
    return spark.read.format("tributary_pages").load()


def fetch_details(collection: DataFrame, fetch: FetchRecord, tasks: int) -> DataFrame:
    """The document of every collection row that has an id: ``page_no, ordinal, id, raw, doc``.

    Rows without an id keep their own document. Only ids travel to the fetching tasks, and they are dealt
    out evenly; ``ordinal`` keeps the collection order.
    """
    ship_package(collection.sparkSession)
    without_id = collection.where(F.col("id").isNull()).select("page_no", "ordinal", "id", "raw")
    ids = collection.where(F.col("id").isNotNull()).select("page_no", "ordinal", "id")

    def fetch_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            # Small slices: a task never holds more than this many documents.
            for start in range(0, len(batch), 200):
                part = batch.iloc[start : start + 200]
                yield part.assign(raw=[fetch(record_id) for record_id in part["id"]])

    # Ranges of the collection order: even shares, and neighbours stay together for a fetch that caches.
    shares = ids.repartitionByRange(tasks, "ordinal")
    fetched = shares.mapInPandas(fetch_all, "page_no bigint, ordinal bigint, id string, raw string")
    return fetched.unionByName(without_id).withColumn("doc", F.parse_json("raw"))


def page_total(page: str) -> int:
    """``totalResults`` of a page, usually the first one fetched to plan the rest."""
    return int(json.loads(page).get("totalResults") or 0)
