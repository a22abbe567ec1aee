"""Quality rules: a hashed n-gram log-likelihood ratio between trusted text and the whole corpus, beside base counts.

One- and two-word n-grams are hashed into a fixed number of buckets. Two multinomials over the buckets, with one added
to every count, are estimated from all documents: of the trusted ones and of the whole corpus. A document's score is
the mean over its n-grams of log(trusted / corpus), so that length has no part in it; a fixed threshold decides on
every document. Counts are whole numbers and each document is summed in its own order, so scores do not depend on how
rows are dealt to tasks. What is gathered has a fixed size: one row for each bucket.

Null and empty texts have no words and fail the base rules. Repeated rows are scored alike, each counts in the corpus.
An id of the trusted table that occurs twice counts once; null ids are never trusted. An empty table gives no rows.
Without a trusted document both multinomials differ by the smoothing only, which is then the only guide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tributary.llm.common import BLANKS, Rolling, as_bytes, batch, give_up, mix, pieces, rows_of, windows, word_spans

BUCKETS = 1 << 14
MIN_SCORE = -0.05
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True  # fixed value: the symbol characters

_SCORES = pa.schema(
    [("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("n_grams", pa.int64()), ("score", pa.float64())]
)
_COUNTS = pa.schema([("bucket", pa.int32()), ("corpus", pa.int64()), ("trusted", pa.int64())])


def _grams(data: np.ndarray, at: np.ndarray, rolling: Rolling, buckets: int):
    """Words of a piece, and the bucket of every one- and two-word n-gram with each row's first."""
    starts, ends, first = word_spans(data, at)
    words = rolling.of(starts, ends)
    pairs, pair_first = windows(words, first, 2)
    both = [(words % np.uint64(buckets)).astype(np.int64), (pairs % np.uint64(buckets)).astype(np.int64)]
    return starts, ends, first, words, both, pair_first


def gram_counts(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, corpus, trusted``: n-grams of all documents, and of those whose ``doc_id`` is in ``trusted``."""
    marks = trusted.select("doc_id").where("doc_id IS NOT NULL").distinct().withColumn("is_trusted", F.lit(True))
    marked = docs.select("doc_id", "text").where("length(text) > 0").join(marks.hint("merge"), "doc_id", "left").select("text", F.coalesce("is_trusted", F.lit(False)).alias("is_trusted"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_up()
        total = np.zeros((2, buckets), np.int64)
        for b in batches:
            trusts = b.column("is_trusted").to_numpy(zero_copy_only=False).astype(bool)
            for row, end, data, at in pieces(*as_bytes(b.column("text"))):
                _, _, first, _, both, pair_first = _grams(data, at, Rolling(data), buckets)
                own = trusts[row:end]
                for grams, begins in zip(both, (first, pair_first), strict=True):
                    total[0] += np.bincount(grams, minlength=buckets)
                    total[1] += np.bincount(grams[own[rows_of(begins)]], minlength=buckets)
        seen = np.flatnonzero(total[0])
        yield batch(_COUNTS, seen.astype(np.int32), total[0, seen], total[1, seen])

    return marked.mapInArrow(count, "bucket int, corpus long, trusted long").groupBy("bucket").agg(F.sum("corpus").alias("corpus"), F.sum("trusted").alias("trusted"))


def fit(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """log(trusted / corpus) of every bucket. At most ``buckets`` rows reach the driver."""
    counts = np.zeros((2, buckets))
    for r in gram_counts(docs, trusted, buckets).toLocalIterator():
        counts[:, r.bucket] = r.corpus, r.trusted
    counts += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def _distinct_keys(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Hashes told apart by row."""
    return mix(hashes + mix(rows.astype(np.uint64) + np.uint64(1)))


def _repeat_words(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per row, words inside 3-word windows that occur more than once in it."""
    triples, begins = windows(words, first, 3)
    row = rows_of(begins)
    _, inverse, n = np.unique(_distinct_keys(triples, row), return_inverse=True, return_counts=True)
    again = np.flatnonzero(n[inverse] > 1)
    start = first[row[again]] + again - begins[row[again]]
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, start, 1)
    np.add.at(edges, start + 3, -1)
    covered = np.concatenate(([0], np.cumsum(np.cumsum(edges[:-1]) > 0)))
    return covered[first[1:]] - covered[first[:-1]]


def _dup_lines(data: np.ndarray, at: np.ndarray, rolling: Rolling, word_sums: np.ndarray) -> np.ndarray:
    """Per row, lines with a word that equal an earlier line of the row."""
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate((breaks + 1, at[:-1])))
    ends = np.sort(np.concatenate((breaks, at[1:])))
    row = np.searchsorted(at[1:], ends, "left")
    keep = word_sums[ends] > word_sums[starts]
    starts, ends, row = starts[keep], ends[keep], row[keep]
    _, index = np.unique(_distinct_keys(rolling.of(starts, ends), row), return_index=True)
    n = len(at) - 1
    return np.bincount(row, minlength=n) - np.bincount(row[index], minlength=n)


def score(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """``docs`` without their text and with the base counts, ``n_grams`` and ``score`` (0 without n-grams) of each row.

    Columns of ``docs`` with these names are replaced.
    """
    return _scored(docs.drop(*_SCORES.names), ratio)


def kept(docs: DataFrame, ratio: np.ndarray, **limits) -> DataFrame:
    """Rows of ``docs``, as they are, that the rules keep. ``limits`` are those of ``verdicts``."""
    names = docs.columns
    hidden = docs.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"), F.col("text").alias("text"))
    return verdicts(_scored(hidden, ratio), **limits).where("kept").select(*[F.col("row").getField(n).alias(n) for n in names])


def _scored(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    buckets = len(ratio)
    names = [n for n in docs.columns if n != "text"]
    kinds = StructType([*docs.select(*names).schema.fields, *StructType.fromDDL("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_grams long, score double").fields])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_up()
        for b in batches:
            for row, end, data, at in pieces(*as_bytes(b.column("text"))):
                rolling = Rolling(data)
                _, _, first, words, both, pair_first = _grams(data, at, rolling, buckets)
                in_word = ~BLANKS[data]
                word_sums = np.concatenate(([0], np.cumsum(in_word)))
                char_sums = np.concatenate(([0], np.cumsum(in_word & ((data & 0xC0) != 0x80))))
                symbol_sums = np.concatenate(([0], np.cumsum(SYMBOLS[data])))
                total = np.zeros(end - row)
                for grams, begins in zip(both, (first, pair_first), strict=True):
                    total += np.bincount(rows_of(begins), weights=ratio[grams], minlength=end - row)
                n_words = np.diff(first)
                n = n_words + np.diff(pair_first)
                found = batch(
                    _SCORES, n_words, np.diff(char_sums[at]), np.diff(symbol_sums[at]),
                    _dup_lines(data, at, rolling, word_sums), _repeat_words(words, first), n, total / np.maximum(n, 1),
                )
                yield pa.RecordBatch.from_arrays([*(b.column(c).slice(row, end - row) for c in names), *found.columns], names=[*names, *_SCORES.names])

    return docs.withColumn("text", F.col("text").cast("string")).mapInArrow(scored, kinds)


def verdicts(scores: DataFrame, min_score: float = MIN_SCORE, min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT) -> DataFrame:
    """``base_failed`` and ``kept``: the base rules, and then the ratio against its threshold."""
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    return scores.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= min_score))
