"""Vector code compression: whole vectors as one short code a part, by codebooks learnt in exact integers.

Components become ``floor(256 * x)``. A vector is cut into ``PARTS`` equal parts, each with a codebook of ``ENTRIES``. Vectors
are stored once as chunks: in a chunk the points of each part are sorted along a Hilbert curve and cut into flat blocks,
and a block keeps the box around its points (minimum and maximum of every component) and their sum. A round works on
boxes first: an entry further from the whole box than another is from its furthest corner can't be nearest to any point
of the block. What remains is the block's shortlist. Where that is one entry, the block's sum is all a round needs; the
other blocks are compared with their shortlist by integer kernels, blocks of like shortlists at a time. Ties go to the
lower index, as shortlists are ascending.

Tasks return sums and counts by entry only, which Spark adds up; codebooks (``PARTS * ENTRIES`` entries, whatever the
table) go to the tasks with each round. Chunks are written to the shared folder and never shuffled.

A vector that is null, or has a null, NaN or infinite component, has no row. Ids may be null or repeat: the codebook starts
from the least ids, equal ones ordered by their vectors, null ids last; with fewer vectors than entries it is shorter.
All kept vectors must have one length that ``PARTS`` divides, and components whose squared distances fit 62 bits; else
there is an error that says so. An empty table gives no rows. Other columns are not read; null labels are one label.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import Staged

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
BLOCK = 32  # points
CHUNK_VALUES = 1 << 19  # components
BROADCAST_LABELS = 100_000
_CURVE_BITS = 62


def whole(vectors: DataFrame, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """``vec_id, label, vector`` of the vectors without gaps."""
    usable = F.forall(F.col(vector_column), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.coalesce(usable, F.lit(False))).select(F.col(id_column).cast("long").alias("vec_id"), F.col(label_column).alias("label"), F.col(vector_column).cast("array<double>").alias("vector"))


def integers(values: np.ndarray, length: int) -> np.ndarray:
    """``floor(256 * x)``, where squared distances of vectors so long fit 62 bits."""
    scaled = np.floor(values * SCALE)
    if len(scaled) and float(np.abs(scaled).max()) ** 2 * 4 * length >= 2.0**62:
        raise ValueError("components are too large for exact codes")
    return scaled.astype(np.int64)


# ---- points along a Hilbert curve, in blocks --------------------------------------------------------------------


def curve_places(points: np.ndarray) -> np.ndarray:
    """Place of each row of ``points`` on a Hilbert curve through their box, as coarse as fits a number."""
    low = points - points.min(axis=0)
    axes = min(low.shape[1], _CURVE_BITS)
    wide = int(low.max()).bit_length() if low.size else 0
    bits = max(1, min(wide, _CURVE_BITS // max(axes, 1)))
    x = [(low[:, k] >> max(0, wide - bits)).astype(np.int64) for k in range(axes)]
    for level in range(bits - 1, 0, -1):  # undo the turns of the smaller cubes, the largest cube first
        bit, below = 1 << level, (1 << level) - 1
        for k in range(axes):
            turned = (x[k] & bit) != 0
            swap = np.where(turned, 0, (x[0] ^ x[k]) & below)
            x[0] = np.where(turned, x[0] ^ below, x[0] ^ swap)
            if k:
                x[k] = x[k] ^ swap
    for k in range(1, axes):  # order of the cubes along the curve
        x[k] = x[k] ^ x[k - 1]
    odd = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        odd = np.where(x[-1] & (1 << level), odd ^ ((1 << level) - 1), odd)
    place = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for k in range(axes):
            place = place << 1 | (x[k] ^ odd) >> level & 1
    return place


class Part:
    """Points of one part of a chunk: sorted, in blocks of ``BLOCK`` (the last is filled up with its last point)."""

    def __init__(self, points: np.ndarray):
        self.order = np.argsort(curve_places(points), kind="stable")
        self.points = points[self.order]
        self._blocks()

    def _blocks(self) -> None:
        n, length = self.points.shape
        filled = np.concatenate((self.points, np.repeat(self.points[-1:], -n % BLOCK, axis=0)))
        self.blocks = filled.reshape(-1, BLOCK, length)
        self.low, self.high = self.blocks.min(axis=1), self.blocks.max(axis=1)
        self.sums = np.add.reduceat(self.points, np.arange(0, n, BLOCK))
        self.counts = np.minimum(BLOCK, n - np.arange(0, n, BLOCK))

    def assigned(self, entries: np.ndarray, shortlists: list | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
        """Blocks, entry and squared distance of their points; of blocks with one entry left, that entry alone (distance is None)."""
        under = np.maximum(np.maximum(self.low[:, None] - entries, entries - self.high[:, None]), 0)
        over = np.maximum(np.abs(self.low[:, None] - entries), np.abs(self.high[:, None] - entries))
        nearest, furthest = (under**2).sum(axis=2), (over**2).sum(axis=2)
        listed = nearest <= furthest.min(axis=1, keepdims=True)
        size = listed.sum(axis=1)
        if shortlists is not None:
            shortlists.extend(size.tolist())
        one = np.flatnonzero(size == 1)
        if len(one):
            yield one, listed[one].argmax(axis=1), None
        order = np.argsort(~listed, axis=1, kind="stable")  # the shortlist first, ascending
        width = 2
        while width < 2 * len(entries):
            some = np.flatnonzero((size > width // 2) & (size <= width) & (size > 1))
            if len(some):
                n = min(width, len(entries))
                place = np.minimum(np.arange(n), size[some, None] - 1)
                mine = np.take_along_axis(order[some], place, axis=1)
                yield some, *_nearest(self.blocks[some], entries[mine], mine)
            width *= 2


def _nearest(blocks: np.ndarray, entries: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each point of each block, and the squared distance. Entries of a block are ascending."""
    most = max(int(np.abs(blocks).max()), int(np.abs(entries).max()), 1)
    kind = np.int32 if 4 * most * most * blocks.shape[2] < 1 << 31 else np.int64
    blocks, entries = blocks.astype(kind), entries.astype(kind)
    total = np.zeros((*blocks.shape[:2], entries.shape[1]), kind)
    for k in range(blocks.shape[2]):
        apart = blocks[:, :, None, k] - entries[:, None, :, k]
        apart *= apart
        total += apart
    best = total.argmin(axis=2)
    return np.take_along_axis(number, best, axis=1), np.take_along_axis(total, best[:, :, None], axis=2)[:, :, 0].astype(np.int64)


def _chunks(length: int, parts: int, label_type: pa.DataType):
    """Rows of a batch as chunks: ids, labels, and for each part the order of its points and the points."""
    kind = pa.schema([("ids", pa.list_(pa.int64())), ("labels", pa.list_(label_type)), ("orders", pa.binary()), ("points", pa.binary())])
    rows = max(BLOCK, CHUNK_VALUES // length)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, rows):
                some = b.slice(k, rows)
                vectors = some.column("vector")
                if not (np.diff(vectors.offsets.to_numpy()) == length).all():
                    raise ValueError(f"all vectors must have the {length} components of the first one")
                points = integers(vectors.flatten().to_numpy(zero_copy_only=False), length).reshape(some.num_rows, length)
                held = [Part(points[:, a : a + length // parts]) for a in range(0, length, length // parts)]
                orders, sorted_points = (b"".join(x.astype(t).tobytes() for x in v) for v, t in (([p.order for p in held], np.int32), ([p.points for p in held], np.int64)))
                lists = [pa.ListArray.from_arrays(pa.array([0, some.num_rows], pa.int32()), some.column(c)) for c in ("vec_id", "label")]
                yield pa.RecordBatch.from_arrays([*(x.cast(f.type) for x, f in zip(lists, kind, strict=False)), pa.array([orders], pa.binary()), pa.array([sorted_points], pa.binary())], schema=kind)

    return emit


def _parts_of(orders: bytes | None, points: bytes, length: int, parts: int) -> Iterator[Part]:
    """Parts of a chunk as they were stored."""
    own = np.frombuffer(points, np.int64).reshape(parts, -1, length // parts)
    order = np.frombuffer(orders, np.int32).reshape(parts, -1) if orders is not None else [None] * parts
    for k in range(parts):
        part = Part.__new__(Part)
        part.order, part.points = order[k], own[k]
        part._blocks()
        yield part


# ---- codebooks and codes ------------------------------------------------------------------------------------------


class Codes:
    """Chunks of a table of vectors and the codebooks learnt from them; ``books`` is parts x entries x components."""

    def __init__(self, vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS):
        kept = whole(vectors, id_column, vector_column, label_column)
        self.label_type = kept.schema["label"].dataType.simpleString()
        first = kept.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).collect()  # as many as entries
        self.parts, self.length = parts, len(first[0].vector) if first else 0
        if self.length % parts or first and not self.length:
            raise ValueError(f"vectors of {self.length} components can't be cut into {parts} equal parts")
        self.spark, self.chunks = kept.sparkSession, None
        if not first:
            self.books = np.zeros((parts, 0, 0), np.int64)
            return
        if any(len(r.vector) != self.length for r in first):
            raise ValueError(f"all vectors must have the {self.length} components of the first one")
        start = integers(np.array([r.vector for r in first], np.float64).ravel(), self.length).reshape(len(first), parts, -1)
        self.books = np.ascontiguousarray(start.transpose(1, 0, 2))
        arrow_label = self._arrow_label(kept)
        kinds = f"ids array<bigint>, labels array<{self.label_type}>, orders binary, points binary"
        self.chunks = Staged(kept.mapInArrow(_chunks(self.length, parts, arrow_label), kinds), "vector-chunks")
        for _ in range(rounds):
            self.books = self._moved()

    @staticmethod
    def _arrow_label(kept: DataFrame) -> pa.DataType:
        from pyspark.sql.pandas.types import to_arrow_type

        return to_arrow_type(kept.schema["label"].dataType)

    def _moved(self) -> np.ndarray:
        """Each entry as the mean of its points, rounded down; an entry without points as it is."""
        books, length, parts = self.books, self.length, self.parts
        kind = pa.schema([("entry", pa.int32()), ("place", pa.int32()), ("total", pa.int64())])

        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((parts, books.shape[1], length // parts + 1), np.int64)
            for b in batches:
                for points in b.column("points"):
                    for k, part in enumerate(_parts_of(None, points.as_buffer(), length, parts)):
                        for blocks, entry, apart in part.assigned(books[k]):
                            if apart is None:
                                np.add.at(sums[k], (entry, slice(0, -1)), part.sums[blocks])
                                np.add.at(sums[k, :, -1], entry, part.counts[blocks])
                                continue
                            real = np.arange(BLOCK) < part.counts[blocks, None]
                            mine, own = entry[real], part.blocks[blocks][real]
                            for c in range(own.shape[1]):
                                sums[k, :, c] += _exact_counts(mine, own[:, c], books.shape[1])
                            sums[k, :, -1] += np.bincount(mine, minlength=books.shape[1])
            entry, place = np.divmod(np.flatnonzero(sums), sums.shape[2])
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip((entry, place, sums[sums != 0]), kind, strict=True)], schema=kind)

        found = self.chunks.df.select("points").mapInArrow(summed, "entry int, place int, total long").groupBy("entry", "place").agg(F.sum("total").alias("total")).collect()  # at most one row an entry and component
        totals = np.zeros((parts * books.shape[1], length // parts + 1), np.int64)
        for r in found:
            totals[r.entry, r.place] = r.total
        totals = totals.reshape(parts, books.shape[1], -1)
        used = totals[:, :, -1:] > 0
        return np.where(used, totals[:, :, :-1] // np.maximum(totals[:, :, -1:], 1), books)

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()

    def encoded(self) -> DataFrame:
        """``vec_id, label, code, error`` of every whole vector: two hex digits a part, and the squared distance to what the code says."""
        kinds = f"vec_id long, label {self.label_type}, code string, error long"
        if self.chunks is None:
            return self.spark.createDataFrame([], kinds)
        books, length, parts = self.books, self.length, self.parts

        def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for row in range(b.num_rows):
                    ids, labels = (b.column(c)[row].values for c in ("ids", "labels"))
                    codes, errors = np.zeros((len(ids), parts), np.uint8), np.zeros(len(ids), np.int64)
                    for k, part in enumerate(_parts_of(b.column("orders")[row].as_buffer(), b.column("points")[row].as_buffer(), length, parts)):
                        entry, apart = np.zeros((2, len(part.blocks), BLOCK), np.int64)
                        for blocks, mine, distance in part.assigned(books[k]):
                            if distance is None:
                                distance = ((part.blocks[blocks] - books[k][mine][:, None]) ** 2).sum(axis=2)
                                mine = mine[:, None]
                            entry[blocks], apart[blocks] = mine, distance
                        codes[part.order, k] = entry.ravel()[: len(ids)]
                        errors[part.order] += apart.ravel()[: len(ids)]
                    digits = codes.tobytes().hex()
                    text = pa.array([digits[a : a + 2 * parts] for a in range(0, len(digits), 2 * parts)], pa.string())
                    yield pa.RecordBatch.from_arrays([ids, labels, text, pa.array(errors)], names=["vec_id", "label", "code", "error"])

        return self.chunks.df.mapInArrow(coded, kinds)

    def decoded(self, codes: DataFrame) -> DataFrame:
        """``vec_id, vector``: what each code stands for, in the units of the vectors."""
        books, parts = self.books, self.parts

        def meant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                entry = np.frombuffer(bytes.fromhex("".join(b.column("code").to_pylist())), np.uint8).reshape(-1, parts)
                vectors = books[np.arange(parts), entry].reshape(len(entry), -1) / SCALE
                ends = pa.array(np.arange(len(entry) + 1) * vectors.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.ListArray.from_arrays(ends, pa.array(vectors.ravel()))], names=["vec_id", "vector"])

        return codes.select("vec_id", "code").mapInArrow(meant, "vec_id long, vector array<double>")


def _exact_counts(entry: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of whole values by entry; in doubles where these hold every sum exactly."""
    if len(values) and int(np.abs(values).max()) * len(values) < 1 << 53:
        return np.bincount(entry, weights=values, minlength=n).astype(np.int64)
    out = np.zeros(n, np.int64)
    np.add.at(out, entry, values)
    return out


def report(codes: Codes) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256``: with the error summed over each label."""
    encoded = Staged(codes.encoded(), "vector-codes").df
    sums = Staged(encoded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors").df.withColumnRenamed("label", "of")
    if sums.count() <= BROADCAST_LABELS:  # else a shuffled join, whose hot labels AQE splits
        sums = F.broadcast(sums)
    met = encoded.join(sums, encoded["label"].eqNullSafe(sums["of"]))
    return met.select("vec_id", "code", "error", "label_error", F.lit(codes.digest()).alias("codebooks_sha256"))
