"""Collection rows meet their full documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_details(details: DataFrame) -> DataFrame:
    """One document per id, the most recently landed one.

    An aggregate rather than a window: copies of one id are reduced before they are shuffled. Of documents landed at
    the same time, that of the greater file name counts; the text decides inside one file only.
    """
    order = F.struct(*[c for c in ("landed_at", "file", "raw") if c in details.columns])
    return details.where(F.col("id").isNotNull()).groupBy("id").agg(F.max_by("raw", order).alias("raw"))


def resolve_details(collection: DataFrame, details: DataFrame, *, strict: bool = True, copies: bool = True) -> DataFrame:
    """``page_no, ordinal, id, raw, error``: the document of each collection row, in collection order.

    A row without an id keeps its own document. A row whose document is missing is an error: the job
    fails when ``strict``, else the row keeps a NULL document and says so in ``error``. ``copies=False``
    promises that no document landed twice, and saves sorting the documents before their shuffle.
    """
    # Rows without an id can never match. A key of their own spreads them over all partitions, where
    # NULL keys would all meet in one.
    key = F.coalesce("id", F.concat(F.lit("\u0000row "), F.col("ordinal").cast("string")))
    left = collection.select("page_no", "ordinal", "id", F.col("raw").alias("own"), key.alias("key"))
    found = latest_details(details) if copies else details.where(F.col("id").isNotNull())
    right = found.select(F.col("id").alias("key"), F.col("raw").alias("found"))
    raw = F.when(F.col("id").isNull(), F.col("own")).otherwise(F.col("found"))
    message = F.concat(F.lit("no document for record "), F.col("id"))
    if strict:
        raw = F.coalesce(raw, F.raise_error(message).cast("string"))
    joined = left.join(right, "key", "left").select("page_no", "ordinal", "id", raw.alias("raw"))
    return joined.withColumn("error", F.when(F.col("raw").isNull(), message))
