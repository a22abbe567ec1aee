"""Minimax contiguous partition: documents into shards of nearly equal bytes, equal texts always together.

A document weighs the UTF-8 bytes of its text and ``OVERHEAD``. Documents of equal text are one atomic group; groups are
ordered by the SHA-256 of the text, so that shards are mixed and the order needs no join. A shard is a stretch of that
order. The smallest capacity with which ``n`` stretches hold everything is found by binary search, each capacity checked
greedily (fill a shard as long as the next group fits), and the cuts are the greedy ones of that capacity. A group above
an equal share of what is left can't share its shard with profit: it gets one of its own, the largest first, and the
capacity is searched for the rest.

In Spark: narrow rows are sorted once by ranges of (group, document), which also splits a hot group over tasks. A block is
a part of that order; only sums of blocks reach the driver, one row a block. A step of the greedy check asks for the
last start of a group at or before a byte; blocks bound the answer from both sides, which brackets the capacity, and
just the blocks that the cuts of the bracket touch are asked for finer sums, until one capacity is left. All of it is
DataFrame functions; texts are read once and never shuffled.

Null and empty texts weigh ``OVERHEAD`` and are one group. Ids may be null or repeat; in a group documents stand by id,
null first. Repeated rows are rows of their own. An empty table gives no rows, and with fewer groups than shards the last
shards stay empty. Very long texts are weighed like any other. Only ``doc_id`` and ``text`` are read, so other columns and
their names don't matter.
"""

from __future__ import annotations

import json
from bisect import bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import Staged, parts

SHARDS = 24
OVERHEAD = 8
BLOCK_ROWS = 1 << 20
FINER = 1 << 16  # sums asked for at a time
_IN_BLOCK = (1 << 33) - 1  # fixed value: the bits of a row's number in its partition


def weighed(docs: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32, key`` of every document, and ``row``, which tells rows apart."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("key"),
        F.monotonically_increasing_id().alias("row"),
    )


def _large(groups: list, total: int, n: int) -> list[tuple[bytes, int]]:
    """Key and rows of the groups that get a shard of their own, from the ``n`` largest: above an equal share of what is left."""
    own = []
    for g in groups:
        if len(own) == n - 1 or g.bytes * (n - len(own)) <= total:
            break
        own.append((bytes(g.key), g.rows))
        total -= g.bytes
    return own


class Starts:
    """Where groups start, in bytes, as far as they are known: ranges ``low..high`` that hold at least both ends."""

    def __init__(self, total: int):
        self.total = total
        self.low: list[int] = []
        self.high: list[int] = []

    def set(self, ranges: list[tuple[int, int]]) -> None:
        ranges = sorted({*ranges, (self.total, self.total)})
        self.low, self.high = [a for a, _ in ranges], [b for _, b in ranges]

    def before(self, byte: int, most: bool) -> int:
        """The last start at or before ``byte``: the most it can be, or the least."""
        k = bisect_right(self.low, byte) - 1
        if byte >= self.high[k]:
            return self.high[k]
        return byte if most else self.low[k]

    def cuts(self, capacity: int, n: int, most: bool) -> list[int]:
        """Ends of ``n`` shards filled greedily."""
        out, at = [], 0
        for _ in range(n):
            at = self.before(at + capacity, most)
            out.append(at)
        return out

    def bracket(self, n: int) -> tuple[int, int]:
        """A capacity that is surely too small and one that surely does; the smallest that does lies between."""

        def least(does) -> int:
            low, high = 0, self.total
            while high - low > 1:
                middle = (low + high) // 2
                low, high = (low, middle) if does(middle) else (middle, high)
            return high

        does = least(lambda c: self.cuts(c, n, most=False)[-1] == self.total)
        may = least(lambda c: self.cuts(c, n, most=True)[-1] == self.total)
        return may - 1, does

    def unknown(self, too_small: int, does: int, n: int) -> list[tuple[int, int]]:
        """Ranges that the greedy cuts of the capacities between can ask about."""
        asked = [(a + too_small + 1, b + does) for a, b in zip([0, *self.cuts(too_small + 1, n, most=False)], [0, *self.cuts(does, n, most=True)], strict=True)]
        return [(a, b) for a, b in zip(self.low, self.high, strict=True) if a < b and any(x < b and a <= y for x, y in asked)]


def _numbers(values: list[int]) -> F.Column:
    """An array of constants, as one literal."""
    return F.from_json(F.lit(json.dumps(values)), "array<bigint>")


def _in_blocks(groups: DataFrame, blocks: list, at: list[int], rows: list[int]) -> DataFrame:
    """``block, key, start, first``: bytes and rows before each group of some blocks."""
    earlier = Window.partitionBy("block").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda name: F.coalesce(F.sum(name).over(earlier), F.lit(0))
    place = F.array_position(_numbers(blocks), F.col("block")).cast("int")
    return groups.where(F.col("block").isin(blocks)).select(
        "block", "key", (before("bytes") + F.element_at(_numbers(at), place)).alias("start"), (before("rows") + F.element_at(_numbers(rows), place)).alias("first")
    )


def assign(docs: DataFrame, n: int = SHARDS, block_rows: int = BLOCK_ROWS, finer: int = FINER) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every document.

    ``slot`` is the place in the shard; ``law`` is ``bytes``, and ``grown_shard`` is null, as another number of shards
    moves every cut.
    """
    spark = docs.sparkSession
    rows = Staged(weighed(docs), "shard-rows")
    total = rows.df.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.count("*").alias("rows")).first()
    sums = rows.df.groupBy("key").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    large = _large(sums.orderBy(F.desc("bytes"), "key").limit(n).collect(), total.bytes, n)
    rank = F.lit(len(large))
    for k, (key, _) in enumerate(large):
        rank = F.when(F.col("key") == F.lit(key), k).otherwise(rank)
    order = ("rank", "key", "doc_id", "row")
    ranged = rows.df.withColumn("rank", rank).repartitionByRange(parts(spark, total.rows, block_rows), *order).sortWithinPartitions(*order)
    placed = Staged(ranged.select("doc_id", "size", "text_crc32", "rank", "key", F.monotonically_increasing_id().alias("place")), "shard-order").df
    rows.drop()
    block = F.shiftright("place", 33)
    rest = F.when(F.col("rank") == len(large), F.col("size")).otherwise(0)
    groups = Staged(placed.groupBy(block.alias("block"), "rank", "key").agg(F.sum(rest).alias("bytes"), F.count("*").alias("rows")), "shard-groups")
    others = F.col("rank") == len(large)
    found = (
        groups.df.groupBy("block")
        .agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"), F.sum(F.when(others, F.col("rows")).otherwise(0)).alias("others"),
             F.min(F.when(others, F.struct("key", "bytes"))).alias("first"), F.max(F.when(others, F.struct("key", "bytes"))).alias("last"))
        .orderBy("block").collect()
    )

    # where blocks begin, in bytes and rows of the groups to be cut, and in rows of all
    at_byte, at_row, ranges, inside = [], [], [], {}
    at_any = [0] * (max((b.block for b in found), default=0) + 1)
    bytes_before = rows_before = any_before = 0
    last_key = None
    for b in found:
        at_byte.append(bytes_before)
        at_row.append(rows_before)
        at_any[b.block] = any_before
        if b.first is not None:
            if b.first.key != last_key:
                ranges.append((bytes_before, bytes_before))
            if b.first.key != b.last.key:
                known = (bytes_before + b.first.bytes, bytes_before + b.bytes - b.last.bytes)
                ranges.append(known)
                inside[known] = b.block
            last_key = b.last.key
        bytes_before, rows_before, any_before = bytes_before + b.bytes, rows_before + b.others, any_before + b.rows
    number = {b.block: k for k, b in enumerate(found)}

    def in_blocks(wanted: set[int]) -> DataFrame:
        blocks = sorted(wanted)
        return _in_blocks(groups.df.where(others), blocks, [at_byte[number[b]] for b in blocks], [at_row[number[b]] for b in blocks])

    starts, left = Starts(bytes_before), n - len(large)
    starts.set(ranges)
    cuts: list = []
    while bytes_before:
        too_small, does = starts.bracket(left)
        asked = starts.unknown(too_small, does, left)
        if asked:
            part, each = F, max(2, finer // len(asked))
            for k, (a, b) in enumerate(asked):
                here = (F.col("block") == inside[a, b]) & F.col("start").between(a, b)
                part = part.when(here, F.struct(F.lit(k).alias("range"), F.expr(f"(start - {a}) div {(b - a) // each + 1}").alias("sum")))
            finest = in_blocks({inside[r] for r in asked}).withColumn("part", part).where("part IS NOT NULL").groupBy("part").agg(F.min("start").alias("low"), F.max("start").alias("high")).collect()
            known = {(f.low, f.high): inside[asked[f.part.range]] for f in finest}
            ranges = [*set(ranges).difference(asked), *known]
            inside.update(known)
            starts.set(ranges)
            continue
        ends = starts.cuts(does, left, most=False)
        firsts = sorted({e for e in ends[:-1] if e < bytes_before})
        if firsts:
            homes = {found[bisect_right(at_byte, e) - 1].block for e in firsts}
            cuts = in_blocks(homes).where(F.col("start").isin(firsts)).orderBy("start").collect()
        break
    groups.drop()

    shard = F.col("rank")
    for cut in cuts:
        shard = shard + F.when(others & (F.col("key") >= F.lit(bytes(cut.key))), 1).otherwise(0)
    begins, before = [], 0
    for _, held in large:
        begins.append(before)
        before += held
    begins += [before, *(before + cut.first for cut in cuts)]
    dealt = placed.withColumn("shard", shard.cast("int"))
    slot = F.element_at(_numbers(at_any), (block + 1).cast("int")) + F.col("place").bitwiseAND(F.lit(_IN_BLOCK)) - F.element_at(_numbers(begins), F.col("shard") + 1)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", slot.alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
