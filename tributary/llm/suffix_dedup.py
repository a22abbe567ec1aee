"""Suffix-array dedup: bytes covered by strings of ``LENGTH`` bytes that start more than once in the collection.

Long texts can't be inserted column by column as they are: their length would be the number of rounds. They are parsed
into contexts of bounded length first. Of the ``LENGTH - ANCHOR + 1`` stretches of ``ANCHOR`` bytes inside a string, the one
of least hash (the leftmost, if tied) is its anchor, wherever the string stands; an anchor's context reaches as far as the
strings that contain it. Equal strings have equal anchors at equal places in them, so every repeat shows between contexts of one anchor,
aligned, and no other contexts need to meet.

* Anchors with a hash of their whole context go to their tasks in packed blocks. Of equal contexts in a batch only one goes. An
  anchor that is alone is done, and so is a context that occurs twice: all its strings repeat.
* The rest, contexts of one anchor that differ (near copies, and passages in different surroundings), are built
  into the collection's suffix order column by column, from the last column to the first: a round inserts one symbol of every
  context, the permuted column is the round's part of the Burrows-Wheeler transform, and the order and the common prefixes of
  neighbours follow from those of the round before, by a stable sort on the new symbol and range minima between equal
  symbols. A string repeats if a neighbour's common prefix has ``LENGTH`` symbols. Contexts come from Spark's sorted
  shuffle files in order of their anchor, in batches of whole groups; a batch is held column by column.

Contexts are compared as bytes where they differ; where they are equal as a whole, by two 64-bit hashes together.
Contexts of one anchor that differ meet in one task.

Null and empty texts, and texts under ``LENGTH`` bytes, lose nothing. Repeated rows are copies of each other. Rows are known by
id and a hash of their text, so ids may repeat or be null. Columns of ``docs`` are kept; ``doc_key, n_bytes, removed, kept`` are added
(and replace columns of these names).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tributary.llm.common import Rolling, Staged, as_bytes, give_up, mix, packed, parts, pieces, unpacked

LENGTH = 200
ANCHOR = 64
BEFORE = LENGTH - ANCHOR  # of a context, in front of its anchor
WIDTH = BEFORE + LENGTH
OUTSIDE = 256  # symbol of columns beyond the text
BATCH = 1 << 15  # contexts
_CHUNK = 1 << 22
_PLACE = np.uint64((1 << 24) - 1)
_DOC = "doc_id long, doc_key long"
_PACKED = pa.schema([("shard", pa.int32()), *[(n, pa.binary()) for n in ("anchor", "context", "flag", "ref", "pos", "ids", "keys", "sizes")]])
_FOUND = pa.schema([("doc_id", pa.int64()), ("doc_key", pa.int64()), ("pos", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("wanted", pa.bool_()), ("anchor", pa.int64())])
_CONTEXT = pa.schema([("anchor", pa.int64()), ("doc_id", pa.int64()), ("doc_key", pa.int64()), ("pos", pa.int64()), ("ahead", pa.int32()), ("settled", pa.bool_()), ("bytes", pa.binary())])
_STARTS = pa.schema([("doc_id", pa.int64()), ("doc_key", pa.int64()), ("first", pa.int64()), ("last", pa.int64())])
_ALONE, _TWICE, _DONE = 0, 1, 2  # of an anchor: one such context in its batch; first of several; settled already


def keyed(docs: DataFrame) -> DataFrame:
    """Documents with ``doc_key``; together with the id it stands for a row and its equals."""
    return docs.withColumn("doc_key", F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))


def anchors(rolling: Rolling, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors of a piece, ascending, and their hashes."""
    n = int(at[-1])
    if n < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    row_end = np.repeat(at[1:], np.diff(at))
    found = []
    for low in range(0, n - LENGTH + 1, _CHUNK):
        high = min(n, low + _CHUNK + LENGTH - 1)
        place = np.arange(low, high - ANCHOR + 1)
        keys = (rolling.of(place, place + ANCHOR) & ~_PLACE) | (place - low).astype(np.uint64)
        reach, width = keys, 1
        while width * 2 <= BEFORE + 1:
            reach = np.minimum(reach[:-width], reach[width:])
            width *= 2
        rest = BEFORE + 1 - width
        least = np.minimum(reach[: len(reach) - rest], reach[rest:]) if rest else reach
        string = np.arange(low, low + len(least))
        least = least[string + LENGTH <= row_end[string]]
        if len(least):
            fresh = np.concatenate(([True], least[1:] != least[:-1]))
            found.append((least[fresh] & _PLACE).astype(np.int64) + low)
    where = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return where, rolling.of(where, where + ANCHOR)


def _pack(out: dict[str, np.ndarray], n_shards: int) -> Iterator[pa.RecordBatch]:
    """Blocks of a batch's anchors, one for each shard."""
    shard = (np.where(out["flag"] == _DONE, mix(out["ref"].astype(np.uint64)), out["anchor"]) % np.uint64(n_shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    cuts = np.flatnonzero(np.diff(shard[order], prepend=-1))
    rows: dict[str, list] = {name: [] for name in _PACKED.names}
    for a, z in zip(cuts, [*cuts[1:], len(order)], strict=True):
        own = order[a:z]
        docs, ref = np.unique(out["ref"][own], return_inverse=True)
        rows["shard"].append(int(shard[own[0]]))
        for name, values in (("anchor", out["anchor"][own]), ("context", out["context"][own]), ("flag", out["flag"][own].astype(np.uint8)), ("ref", ref.astype(np.uint32)), ("pos", out["pos"][own]), ("ids", docs), ("keys", out["keys"][docs]), ("sizes", out["sizes"][docs])):
            rows[name].append(values.tobytes())
    if rows["shard"]:
        yield pa.RecordBatch.from_arrays([pa.array(rows[f.name], f.type) for f in _PACKED], schema=_PACKED)


def _emit(n_shards: int):
    """Anchors of each batch of documents, packed by the shard of their hash."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_up()
        for b in batches:
            ids, keys = b.column("doc_id"), b.column("doc_key").to_numpy()
            parts_ = []
            for row, _, data, at in pieces(*as_bytes(b.column("text"))):
                rolling = Rolling(data)
                where, hashes = anchors(rolling, at)
                own = np.searchsorted(at, where, "right") - 1
                begin = np.maximum(where - BEFORE, at[own])
                end = np.minimum(where + LENGTH, at[own + 1])
                context = mix(rolling.of(begin, end) + (where - begin).astype(np.uint64) * np.uint64(1 << 32) + (end - where).astype(np.uint64))
                parts_.append((hashes, context, own + row, where - at[own], np.diff(at)[own]))
            if not parts_:
                continue
            hashes, context, ref, pos, _ = (np.concatenate(x) for x in zip(*parts_, strict=True))
            _, first, inverse, n = np.unique(mix(hashes) + context, return_index=True, return_inverse=True, return_counts=True)
            flag = np.where(n[inverse] > 1, _DONE, _ALONE)
            flag[first[n > 1]] = _TWICE
            sizes = np.diff(as_bytes(b.column("text"))[1])
            for block in _pack({"anchor": hashes, "context": context, "flag": flag, "ref": ref, "pos": pos, "keys": keys, "sizes": sizes}, n_shards):
                columns = {n: block.column(n) for n in _PACKED.names}
                columns["ids"] = pa.array([_take_ids(ids, v) for v in columns["ids"].to_pylist()], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return emit


def _take_ids(ids: pa.Array, rows: bytes) -> list:
    return ids.take(pa.array(np.frombuffer(rows, np.int64))).to_pylist()


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors that aren't alone: settled ones with all their strings' starts, and contexts whose bytes are wanted."""
    give_up()
    columns: dict[str, list[np.ndarray]] = {n: [] for n in ("anchor", "context", "flag", "pos", "size", "key", "id")}
    kinds = {"anchor": np.uint64, "context": np.uint64, "flag": np.uint8, "pos": np.int64}
    for b in batches:
        rows = {n: b.column(n).to_pylist() for n in ("anchor", "context", "flag", "pos", "ref", "keys", "sizes")}
        for k in range(b.num_rows):
            ref = np.frombuffer(rows["ref"][k], np.uint32)
            for n, kind in kinds.items():
                columns[n].append(np.frombuffer(rows[n][k], kind))
            columns["size"].append(np.frombuffer(rows["sizes"][k], np.int64)[ref])
            columns["key"].append(np.frombuffer(rows["keys"][k], np.int64)[ref])
            columns["id"].append(np.array(b.column("ids")[k].as_py(), object)[ref] if b.column("ids")[k].values.null_count else b.column("ids")[k].values.to_numpy()[ref])
    if not columns["anchor"]:
        return
    c = {n: np.concatenate(v) for n, v in columns.items()}
    done = np.flatnonzero(c["flag"] == _DONE)
    yield from _give(c, done, np.ones(len(done), bool), np.zeros(len(done), bool))
    order = np.flatnonzero(c["flag"] != _DONE)
    if not len(order):
        return
    order = order[np.lexsort((c["context"][order], c["anchor"][order]))]
    c = {n: v[order] for n, v in c.items()}
    new_anchor = np.concatenate(([True], c["anchor"][1:] != c["anchor"][:-1]))
    new_context = new_anchor | np.concatenate(([True], c["context"][1:] != c["context"][:-1]))
    group, context = np.cumsum(new_anchor) - 1, np.cumsum(new_context) - 1
    twice = np.bincount(context, weights=np.where(c["flag"] == _ALONE, 1, 2)) > 1
    differ = np.bincount(group, weights=new_context) > 1
    settled = twice[context]
    wanted = differ[group] & new_context
    give = np.flatnonzero(settled | wanted)
    yield from _give({n: v[give] for n, v in c.items()}, np.arange(len(give)), settled[give], wanted[give])


def _give(c: dict[str, np.ndarray], rows: np.ndarray, settled: np.ndarray, wanted: np.ndarray) -> Iterator[pa.RecordBatch]:
    first = np.where(settled, np.maximum(c["pos"][rows] - BEFORE, 0), 0)
    last = np.where(settled, np.minimum(c["pos"][rows], c["size"][rows] - LENGTH), -1)
    for k in range(0, len(rows), 1 << 16):
        own, part = rows[k : k + (1 << 16)], slice(k, k + (1 << 16))
        columns = (c["id"][own], c["key"][own], c["pos"][own], first[part], last[part], wanted[part], c["anchor"][own].view(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(v, t.type) for v, t in zip(columns, _FOUND, strict=True)], schema=_FOUND)


def _cut_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes around the wanted anchors of each document."""
    for b in batches:
        data, at = as_bytes(b.column("text"))
        rows = []
        for k, places in enumerate(b.column("places").to_pylist()):
            text = data[at[k] : at[k + 1]]
            doc_id, doc_key = b.column("doc_id")[k].as_py(), b.column("doc_key")[k].as_py()
            for p in places:
                begin = max(0, p["pos"] - BEFORE)
                rows.append((p["anchor"], doc_id, doc_key, p["pos"], p["pos"] - begin, p["settled"], text[begin : p["pos"] + LENGTH].tobytes()))
            if len(rows) > 1 << 14:
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows, strict=True), _CONTEXT, strict=True)], schema=_CONTEXT)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows, strict=True), _CONTEXT, strict=True)], schema=_CONTEXT)


def columns_of(contexts: pa.Array, ahead: np.ndarray) -> np.ndarray:
    """Symbols of the contexts by column, anchors under each other."""
    data, at = as_bytes(contexts)
    out = np.full((WIDTH, len(contexts)), OUTSIDE, np.uint16)
    size = np.diff(at)
    row = np.repeat(np.arange(len(contexts)), size)
    out[np.arange(len(data)) - at[row] + (BEFORE - ahead)[row], row] = data
    return out


def repeated_starts(columns: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For each context and column, whether the string from there is that of another context too.

    Rounds go from the last column to the first. ``order`` sorts the contexts by what has been inserted, ``common`` has the
    common prefix of each and the one before it.
    """
    width, n = columns.shape
    repeated = np.zeros((width - length + 1, n), bool)
    order = np.arange(n)
    common = np.zeros(n + 1, np.int32)
    common[1:n] = 0
    for column in range(width - 1, -1, -1):
        symbols = columns[column][order]
        to = np.argsort(symbols, kind="stable")
        sorted_ = symbols[to]
        equal = (sorted_[1:] == sorted_[:-1]) & (sorted_[1:] != OUTSIDE)
        low, high = to[:-1][equal], to[1:][equal]
        fresh = np.zeros(n + 1, np.int32)
        if len(low):
            near = high == low + 1
            least = common[high]
            far = np.flatnonzero(~near)
            if len(far):
                bounds = np.empty(2 * len(far), np.int64)
                bounds[::2], bounds[1::2] = low[far] + 1, high[far] + 1
                least[far] = np.minimum.reduceat(common, bounds)[::2]
            fresh[1:n][equal] = least + 1
        order, common = order[to], fresh
        if column <= width - length:
            long = common >= length
            repeated[column, order] = long[:-1] | long[1:]
    return repeated


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Starts of repeated strings in contexts that are not settled. Rows come in order of their anchor."""
    waiting: list[pa.RecordBatch] = []
    for b in batches:
        waiting.append(b)
        if sum(w.num_rows for w in waiting) < BATCH:
            continue
        table = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
        anchor = table.column("anchor").to_numpy()
        end = int(np.searchsorted(anchor, anchor[-1], "left"))  # the last group may go on
        if end:
            yield from _starts(table.slice(0, end))
        waiting = [table.slice(end)]
    if waiting:
        yield from _starts(pa.Table.from_batches(waiting).combine_chunks().to_batches()[0])


def _starts(table: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    if not table.num_rows:
        return
    repeated = repeated_starts(columns_of(table.column("bytes"), table.column("ahead").to_numpy()))
    repeated[:, table.column("settled").to_numpy(zero_copy_only=False)] = False
    edges = np.diff(np.pad(repeated.T.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, first = np.nonzero(edges == 1)
    _, end = np.nonzero(edges == -1)
    base = table.column("pos").to_numpy()[row] - BEFORE
    some = pa.array(row)
    yield pa.RecordBatch.from_arrays([table.column("doc_id").take(some), table.column("doc_key").take(some), pa.array(base + first), pa.array(base + end - 1)], schema=_STARTS)


def starts(docs: DataFrame) -> DataFrame:
    """``doc_id, doc_key, first, last``: ranges of places where repeated strings start. A document may have several rows."""
    spark = docs.sparkSession
    texts = keyed(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "doc_key", F.col("text").cast("string").alias("text")).where(F.octet_length("text") >= LENGTH)
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n_shards = parts(spark, size, 1 << 25)
    packed = texts.mapInArrow(_emit(n_shards), "shard int, anchor binary, context binary, flag binary, ref binary, pos binary, ids array<long>, keys binary, sizes binary")
    met = Staged(packed.repartition(n_shards, "shard").mapInArrow(_meet, f"{_DOC}, pos long, first long, last long, wanted boolean, anchor long"), "anchors").df
    wanted = met.where("wanted").groupBy("doc_id", "doc_key").agg(F.collect_list(F.struct("pos", "anchor", (F.col("last") >= F.col("first")).alias("settled"))).alias("places"))
    same = F.col("w.doc_id").eqNullSafe(F.col("t.doc_id")) & (F.col("w.doc_key") == F.col("t.doc_key"))
    once = texts.alias("t").join(wanted.alias("w").hint("merge"), same).select("t.doc_id", "t.doc_key", "text", "places")
    contexts = once.mapInArrow(_cut_contexts, f"anchor long, {_DOC}, pos long, ahead int, settled boolean, bytes binary")
    compared = contexts.repartition(n_shards, "anchor").sortWithinPartitions("anchor").mapInArrow(_compare, f"{_DOC}, first long, last long")
    settled = met.where("last >= first").select("doc_id", "doc_key", "first", "last")
    return Staged(settled.unionByName(compared), "starts").df


def removed(docs: DataFrame, whole_characters: bool = False) -> DataFrame:
    """``docs`` with ``doc_key, n_bytes``, ``removed`` (spans of bytes, end excluded) and ``kept`` (the other bytes).

    With ``whole_characters``, a character that a span covers in part is kept whole.
    """
    found = starts(docs).groupBy("doc_id", "doc_key").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))
    own = keyed(docs).drop("n_bytes", "removed", "kept", "ranges")
    same = F.col("f.doc_id").eqNullSafe(F.col("d.doc_id").cast("long")) & (F.col("f.doc_key") == F.col("d.doc_key"))
    joined = own.alias("d").join(found.alias("f").hint("merge"), same, "left").select("d.*", "f.ranges")
    names = own.columns
    added = "n_bytes long, removed array<struct<start: long, end: long>>, kept binary"
    kinds = StructType([*own.schema.fields, *StructType.fromDDL(added).fields])
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, at = as_bytes(b.column("text"))
            spans, kept = [], []
            for k, ranges in enumerate(b.column("ranges").to_pylist()):
                text = data[at[k] : at[k + 1]]
                own_spans = joined_spans([(r["first"], r["last"] + LENGTH) for r in ranges or ()])
                spans.append([{"start": a, "end": z} for a, z in own_spans])
                kept.append(without(text, own_spans, whole_characters))
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(np.diff(at)), pa.array(spans, span), pa.array(kept, pa.binary())], names=[*names, "n_bytes", "removed", "kept"])

    return joined.mapInArrow(cut, kinds)


def clean(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated passages cut from their texts; documents of which nothing but blanks is left go.

    Null and blank texts stay as they were. A column ``n_chars`` follows a text that changed.
    """
    found = removed(packed(docs), whole_characters=True)
    cut = F.size("removed") > 0
    left = F.col("kept").cast("string")
    texts = found.where(~cut | (F.length(F.trim(F.regexp_replace(left, "[\\x09-\\x0D]", " "))) > 0)).withColumn("text", F.when(cut, left).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        texts = texts.withColumn("n_chars", F.when(cut, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return unpacked(texts, docs.columns)


def joined_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


def without(text: np.ndarray, spans: list[tuple[int, int]], whole_characters: bool = False) -> bytes:
    """Bytes outside the spans; with ``whole_characters``, spans draw back from characters they cover in part."""
    keep = np.ones(len(text) + 1, bool)
    for a, z in spans:
        if whole_characters:
            while a < z and text[a] & 0xC0 == 0x80:
                a += 1
            while z > a and z < len(text) and text[z] & 0xC0 == 0x80:
                z -= 1
        keep[a:z] = False
    return text[keep[:-1]].tobytes()


def report(found: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "n_bytes",
        F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
