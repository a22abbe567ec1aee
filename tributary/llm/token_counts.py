"""Token counts: the exact histogram of encoded lengths, and what its suffix sums answer for every context limit.

Documents are counted by their length in tokens; from there on work and memory follow the number of different lengths.
Suffix sums are taken in two steps, inside ranges of lengths and over the totals of the ranges, so that no task holds
the whole histogram. With them the tokens left when every document is cut at a limit, the documents that fit, and any
quantile are looked up, not recomputed.

Nulls and empty texts have length 0 and are counted. Repeated rows count each time. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.bpe import load

RANGE = 64


def lengths(docs: DataFrame, path: str, text_column: str = "text") -> DataFrame:
    """``n_tokens, n_docs`` by task: partial counts of the encoded lengths."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        seen: dict[int, int] = {}
        for b in batches:
            for text in b.column(0):
                n = len(bpe.encode(text.as_py())) // 4 if text.is_valid else 0
                seen[n] = seen.get(n, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.int64()), pa.array(seen.values(), pa.int64())], names=["n_tokens", "n_docs"])

    return docs.select(F.col(text_column).cast("string").alias("text")).mapInArrow(counted, "n_tokens long, n_docs long")


def histogram(counts: DataFrame) -> DataFrame:
    """``n_tokens, n_docs`` with one row for each length."""
    return counts.groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))


def suffix_sums(lengths: DataFrame) -> DataFrame:
    """``n_tokens, n_docs, n_longer, tokens_longer``: documents, and their tokens, of greater length."""
    ranged = lengths.withColumn("span", F.floor(F.col("n_tokens") / RANGE)).withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    totals = ranged.groupBy("span").agg(F.sum("n_docs").alias("span_docs"), F.sum("tokens").alias("span_tokens"))
    after = Window.orderBy(F.desc("span")).rowsBetween(Window.unboundedPreceding, -1)
    beyond = totals.select("span", F.coalesce(F.sum("span_docs").over(after), F.lit(0)).alias("far_docs"), F.coalesce(F.sum("span_tokens").over(after), F.lit(0)).alias("far_tokens"))
    within = Window.partitionBy("span").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    return ranged.join(beyond, "span").select(
        "n_tokens",
        "n_docs",
        (F.col("far_docs") + F.coalesce(F.sum("n_docs").over(within), F.lit(0))).alias("n_longer"),
        (F.col("far_tokens") + F.coalesce(F.sum("tokens").over(within), F.lit(0))).alias("tokens_longer"),
    )


def by_limit(sums: DataFrame) -> DataFrame:
    """For each length as context limit: documents in all and whole, tokens in all and left when all are cut there."""
    totals = sums.agg(F.sum("n_docs").alias("total_docs"), F.sum(F.col("n_tokens") * F.col("n_docs")).alias("total_tokens"))
    return sums.crossJoin(F.broadcast(totals)).select(  # one row
        F.col("n_tokens").alias("context_limit"),
        "n_docs",
        "n_longer",
        "tokens_longer",
        "total_docs",
        "total_tokens",
        (F.col("total_tokens") - F.col("tokens_longer") + F.col("n_tokens") * F.col("n_longer")).alias("truncated_tokens"),
        ((F.col("total_docs") - F.col("n_longer")) / F.col("total_docs")).alias("share_whole"),
    )


def quantiles(limits: DataFrame, shares: list[float]) -> DataFrame:
    """``share, n_tokens``: the least length that at least so great a share of the documents does not pass."""
    found = [F.min(F.when(F.col("share_whole") >= s, F.col("context_limit"))).alias(str(k)) for k, s in enumerate(shares)]
    pairs = F.array(*[F.struct(F.lit(float(s)).alias("share"), F.col(f"`{k}`").alias("n_tokens")) for k, s in enumerate(shares)])
    return limits.agg(*found).select(F.inline(pairs))


def truncated_total(limits: DataFrame, limit: int) -> int:
    """Tokens left when every document is cut at ``limit``, a length of the table or not."""
    row = limits.where(F.col("context_limit") <= limit).agg(F.max(F.struct("context_limit", "n_longer", "tokens_longer", "total_tokens"))).first()[0]
    if row is None:
        return limit * int(limits.agg(F.coalesce(F.max("total_docs"), F.lit(0))).first()[0])
    return row.total_tokens - row.tokens_longer + limit * row.n_longer
