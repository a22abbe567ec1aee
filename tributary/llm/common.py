"""What the operators share: text batches as arrays of bytes, words and their hashes, staged tables.

Inside tasks a batch of texts is one byte array with offsets, and words are positions in it, so that the work on a
word is array arithmetic and not a Python object. A batch is cut into pieces of about one megabyte (a longer text is a
piece of its own), which bounds the memory of a task.
"""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.session import prepare, ship_package, staging_path
from tributary.sinks.files import delete

PIECE_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_STEP = np.uint64(0xD6E8FEB86659FD93)

BLANKS = np.zeros(256, bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = True  # fixed value: the separators [\x20\x09-\x0D]
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


# ---- tables ---------------------------------------------------------------------------------------------


def start(spark: SparkSession) -> SparkSession:
    """Session options and the package on the workers."""
    ship_package(spark)
    return prepare(spark)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_staged: list[tuple[SparkSession, str]] = []


@atexit.register
def _clean() -> None:
    for spark, path in _staged:
        try:
            delete(spark, path)
        except Exception:  # noqa: BLE001 - the session may have ended
            return


def keep(spark: SparkSession, path: str) -> None:
    """Note a folder that goes at exit."""
    _staged.append((spark, path))


class Staged:
    """A table written to the shared folder: ``df`` reads it, ``drop()`` frees it. The rest goes at exit."""

    def __init__(self, df: DataFrame, label: str, partition_by: str | None = None):
        self.spark, self.path = df.sparkSession, staging_path(df.sparkSession, label)
        keep(self.spark, self.path)
        writer = df.write.option("compression", "zstd")
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(self.path)
        self.schema = df.schema

    @property
    def df(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def drop(self) -> None:
        delete(self.spark, self.path)


def parts(spark: SparkSession, size: float, each: float) -> int:
    """Number of partitions so that each holds about ``each`` of ``size``, and no less than the session asks for."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(size // each) + 1)


def crc_of(column: str) -> F.Column:
    """crc32 of the decimal text of an id; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def packed(docs: DataFrame) -> DataFrame:
    """``doc_id, text, n_chars`` (if there is one) and the others as one struct ``row``, so that none clashes with what is added."""
    beside = [n for n in ("doc_id", "text", "n_chars") if n in docs.columns]
    return docs.select(*beside, F.struct(*(docs[f"`{n}`"].alias(n) for n in docs.columns if n not in ("text", "n_chars"))).alias("row"))


def unpacked(texts: DataFrame, names: list[str]) -> DataFrame:
    """The columns of ``names``, as they were before ``packed``."""
    return texts.select(*(F.col(n) if n in ("text", "n_chars") else F.col("row").getField(n).alias(n) for n in names))


# ---- memory of workers -----------------------------------------------------------------------------------

_held: list[Callable[[], None]] = []


def holds(release: Callable[[], None]) -> None:
    """Note that a worker holds tables between tasks, and how it gives them up."""
    if release not in _held:
        _held.append(release)


def give_up() -> None:
    """Give up what tasks of other operators left in this worker, and what the allocators keep of it.

    Workers are used again by the next operator's tasks, which would run beside tables that nobody asks for any more.
    """
    if _held:
        while _held:
            _held.pop()()
        gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every system's library can give memory back
        ctypes.CDLL(None).malloc_trim(0)


# ---- texts as bytes ---------------------------------------------------------------------------------------


def as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column, and the offset of each row in them. A null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "" if not pa.types.is_binary(column.type) else b"")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def pieces(data: np.ndarray, at: np.ndarray, most: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut into ``first row, end row, bytes, offsets`` of at most ``most`` bytes, or one row."""
    row, n = 0, len(at) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(at, at[row] + most, "right")) - 1)
        end = min(end, n)
        yield row, end, data[at[row] : at[end]], at[row : end + 1] - at[row]
        row = end


_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        _powers = np.full(n, _BASE, np.uint64)
        _inverses = np.full(n, _INVERSE, np.uint64)
        _powers[0] = _inverses[0] = 1
        np.multiply.accumulate(_powers, out=_powers)
        np.multiply.accumulate(_inverses, out=_inverses)
    return _powers, _inverses


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all their bits (a bijection)."""
    h = h ^ (h >> np.uint64(32))
    h *= _STEP
    h ^= h >> np.uint64(29)
    h *= _BASE
    h ^= h >> np.uint64(32)
    return h


class Rolling:
    """Hash of any stretch of a byte array from prefix sums: equal bytes, equal hash."""

    def __init__(self, data: np.ndarray):
        powers, self._inv = _power_tables(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self._inv[start])


def word_spans(data: np.ndarray, at: np.ndarray, separators: np.ndarray = BLANKS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every maximal run without separators that stays in its row, and each row's first word."""
    inside = ~separators[data]
    before = np.empty_like(inside)
    if len(data):
        before[0] = False
        before[1:] = inside[:-1]
        before[at[:-1][at[:-1] < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    if len(data):
        after = np.empty_like(inside)
        after[-1] = False
        after[:-1] = inside[1:]
        ends_at = at[1:][at[1:] > 0] - 1
        after[ends_at] = False
        ends = np.flatnonzero(inside & ~after) + 1
    else:
        ends = starts
    return starts, ends, np.searchsorted(starts, at)


def windows(words: np.ndarray, first: np.ndarray, size: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``size`` word hashes of a row, and each row's first run.

    With ``short``, a row of fewer words, but not none, is one run of all of them.
    """
    n = np.diff(first)
    count = np.maximum(n - size + 1, 0)
    if short:
        count = np.where((n > 0) & (n < size), 1, count)
    at = np.concatenate(([0], np.cumsum(count)))
    begin = np.repeat(first[:-1] - at[:-1], count) + np.arange(at[-1])
    length = np.repeat(np.minimum(n, size), count)
    h = length.astype(np.uint64)
    for k in range(size):
        own = length > k
        if own.all():
            h = h * _BASE + words[begin + k]
        else:
            h[own] = h[own] * _BASE + words[begin[own] + k]
        h ^= h >> np.uint64(31)
    return mix(h), at


def distinct(values: np.ndarray) -> np.ndarray:
    """Distinct numbers, ascending. ``values`` are sorted in place: numpy's own goes by a hash table, which takes many times as long."""
    values.sort()
    if not len(values):
        return values
    first = np.empty(len(values), bool)
    first[0] = True
    np.not_equal(values[1:], values[:-1], out=first[1:])
    return values[first]


def rows_of(first: np.ndarray) -> np.ndarray:
    """Row of each item, from each row's first item."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t.type) for c, t in zip(columns, schema, strict=True)], schema=schema)
