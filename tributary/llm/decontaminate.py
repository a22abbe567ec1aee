"""Benchmark decontamination with a generalised suffix automaton of the test items.

Items are normalised to words and put, one after another, into one suffix automaton; every state knows which items its
strings occur in, and which items end in it whole. A document's words are streamed through it: after each word the
state stands for the longest match that ends there. A match of ``window`` words, or of a whole item shorter than that,
marks its words as hit; hit words next to one another are a span. Words that no item has can't be part of a match, so
only stretches of known words of sufficient length are streamed, each from the initial state.

Items are taken in blocks of a bounded number of words, by the hash of their id. Each block's automaton (its size is at
most twice its words) is sent to the workers and all documents are streamed through it; what the blocks find is
put together by document. So memory stays bounded however many items there are, and a benchmark of one block is one pass.

Null and empty texts, and texts without words, have no words and no hits; such items match nothing. Repeated documents
are matched alike, row by row; items with equal words are each reported, and an item id that occurs twice is
reported once. A null item id is kept out of the list of ids, but its text still marks words. An empty benchmark leaves
every document as it is. Columns beside id and text are carried by ``clean`` and not read by the matching.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tributary.llm.common import packed, unpacked, word_spans

WINDOW = 10
MAX_COVERAGE = 0.5
BLOCK_WORDS = 200_000
_SEPARATORS = np.ones(256, bool)  # fixed value: words are [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z to a-z
for _span in (range(0x30, 0x3A), range(0x61, 0x7B), range(0x80, 0x100)):
    _SEPARATORS[list(_span)] = False
_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[ord("A") : ord("Z") + 1] += 32
_FOLD = bytes(0x20 if _SEPARATORS[c] else c for c in _FOLDED.tolist())


def words_of(text: bytes) -> list[bytes]:
    """Normalised words of a text."""
    return text.translate(_FOLD).split()


class Automaton:
    """Generalised suffix automaton over word numbers."""

    def __init__(self, items: list[tuple[int, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        own: list[set[int]] = [set()]
        self.whole: dict[int, int] = {}
        self.whole_items: dict[int, list[int]] = {}
        self.shortest = window
        for number, (_, words) in enumerate(items):
            last = 0
            for word in words:
                last = self._add(last, self.vocabulary.setdefault(word, len(self.vocabulary)), own)
                own[last].add(number)
            if 0 < len(words) < window:
                self.shortest = min(self.shortest, len(words))
        for number, (_, words) in enumerate(items):  # states move while items are added
            if 0 < len(words) < window:
                state = 0
                for word in words:
                    state = self.next[state][self.vocabulary[word]]
                self.whole[state] = len(words)
                self.whole_items.setdefault(state, []).append(number)
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            own[self.link[state]] |= own[state]
        self.items = [np.fromiter(sorted(s), np.int64, len(s)) for s in own]
        self.ids = [i for i, _ in items]
        self._next_whole()

    def _new(self, length: int, link: int, moves: dict[int, int], own: list[set[int]]) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        own.append(set())
        return len(self.length) - 1

    def _split(self, state: int, symbol: int, target: int, own: list[set[int]]) -> int:
        """A copy of ``target`` for its strings that are short enough to follow ``state``."""
        copy = self._new(self.length[state] + 1, self.link[target], dict(self.next[target]), own)
        while state != -1 and self.next[state].get(symbol) == target:
            self.next[state][symbol] = copy
            state = self.link[state]
        self.link[target] = copy
        return copy

    def _add(self, last: int, symbol: int, own: list[set[int]]) -> int:
        if (target := self.next[last].get(symbol)) is not None:
            return target if self.length[target] == self.length[last] + 1 else self._split(last, symbol, target, own)
        added = self._new(self.length[last] + 1, 0, {}, own)
        state = last
        while state != -1 and symbol not in self.next[state]:
            self.next[state][symbol] = added
            state = self.link[state]
        if state != -1:
            target = self.next[state][symbol]
            self.link[added] = target if self.length[target] == self.length[state] + 1 else self._split(state, symbol, target, own)
        return added

    def _next_whole(self) -> None:
        """For each state, the nearest state on its way up that is a short item whole."""
        self.up = [0] * len(self.length)
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__):
            self.up[state] = state if state in self.whole else self.up[self.link[state]]

    def match(self, symbols: list[int], spans: list[tuple[int, int]], found: set[int], offset: int = 0) -> None:
        """Stream known words; append the hit stretches and add the numbers of the items that occur."""
        moves, link, length, window, up, whole = self.next, self.link, self.length, self.window, self.up, self.whole
        state = n = 0
        for at, symbol in enumerate(symbols, offset + 1):
            while symbol not in moves[state]:
                state = link[state]
                n = length[state]
            state = moves[state][symbol]
            n += 1
            if n >= window:
                while length[link[state]] >= window:
                    state = link[state]
                n = min(n, length[state])
                spans.append((at - window, at))
                found.update(self.items[state].tolist())
            short = up[state]
            while short and whole[short] > n:
                short = up[link[short]]
            while short:
                spans.append((at - whole[short], at))
                found.update(self.whole_items[short])
                short = up[link[short]]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that overlap or touch, joined."""
    out: list[tuple[int, int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


def _blocks(items: DataFrame, block_words: int) -> tuple[int, Iterator[list[tuple[int, list[bytes]]]]]:
    """Number of blocks, and the items in blocks of about ``block_words`` words; one block is held at a time."""
    sized = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    total = sized.agg(F.coalesce(F.sum(F.size(F.split("text", "[^0-9A-Za-z\\x80-\\uffff]+"))), F.lit(0))).first()[0]
    n = int(total // block_words) + 1

    def block(k: int) -> list[tuple[int, list[bytes]]]:
        rows = sized.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).toLocalIterator()
        found = [(r.item_id, words_of(r.text.encode())) for r in rows]
        return sorted(((i, w) for i, w in found if w), key=lambda x: (x[0] is None, x[0] or 0, x[1]))

    return n, map(block, range(n))


_MATCHES = pa.schema([("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))), ("items", pa.list_(pa.int64()))])


def _matcher(automaton):
    """Words, hit spans (first word, end) and item ids of each text of a batch."""

    def match(column: pa.Array) -> pa.RecordBatch:
        a = automaton.value
        numbers = a.vocabulary
        counts, spans, items = [], [], []
        for text in column.cast(pa.binary()).to_pylist():
            words = words_of(text) if text else []
            counts.append(len(words))
            hit: list[tuple[int, int]] = []
            found: set[int] = set()
            if numbers and len(words) >= a.shortest:
                symbols = [numbers.get(w, -1) for w in words]
                edges = np.flatnonzero(np.diff(np.concatenate(([False], np.array(symbols) >= 0, [False])).astype(np.int8)))
                starts, ends = edges[::2], edges[1::2]
                long = ends - starts >= a.shortest
                for s, e in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
                    a.match(symbols[s:e], hit, found, s)
            spans.append([{"first": x, "end": z} for x, z in merged(hit)])
            items.append(sorted({a.ids[k] for k in found if a.ids[k] is not None}))
        return pa.RecordBatch.from_arrays([pa.array(v, t.type) for v, t in zip((counts, spans, items), _MATCHES, strict=True)], schema=_MATCHES)

    return match


def matches(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``n_words, spans`` (of words, end excluded) and ``items`` (ids, ascending) for every row.

    With more than one block, ``docs`` passes through one automaton after another and the columns grow on the way.
    """
    spark = docs.sparkSession
    out = docs.drop("n_words", "spans", "items")
    n, blocks = _blocks(items, block_words)
    for number, block in enumerate(blocks):
        shared = spark.sparkContext.broadcast(Automaton(block, window))
        out = _matched(out, _matcher(shared), number == 0, keep_text or number < n - 1)
    return out


def _matched(docs: DataFrame, match, first: bool, keep_text: bool) -> DataFrame:
    names = [c for c in docs.columns if c not in ("n_words", "spans", "items") and (keep_text or c != "text")]
    kinds = StructType.fromDDL("n_words long, spans array<struct<first: long, end: long>>, items array<long>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 1024):
                some = b.slice(k, 1024)
                found = match(some.column("text"))
                columns = [some.column(n) for n in names]
                spans, listed = found.column("spans"), found.column("items")
                if not first:
                    spans = pa.array([[{"first": x, "end": z} for x, z in merged([(s["first"], s["end"]) for s in p + q])] for p, q in zip(some.column("spans").to_pylist(), spans.to_pylist(), strict=True)], _MATCHES.field("spans").type)
                    listed = pa.array([sorted({*p, *q}) for p, q in zip(some.column("items").to_pylist(), listed.to_pylist(), strict=True)], _MATCHES.field("items").type)
                yield pa.RecordBatch.from_arrays([*columns, found.column("n_words"), spans, listed], names=[*names, "n_words", "spans", "items"])



    return docs.mapInArrow(run, StructType([*docs.select(*names).schema.fields, *kinds.fields]))


def report(matched: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of matched documents."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])
    return matched.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def clean(matched: DataFrame, max_coverage: float = MAX_COVERAGE) -> DataFrame:
    """Documents without their hit spans, and without those of which more than ``max_coverage`` of the words are hit.

    A span is cut from its first word's first byte to its last word's last; a text without hits stays as it is.
    ``n_words, spans, items`` go, a column ``n_chars`` follows the new text.
    """
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])
    kept = matched.where(n_hit <= max_coverage * F.col("n_words"))
    names = [n for n in kept.columns if n not in ("n_words", "spans", "items")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans = b.column("spans").to_pylist()
            columns = {n: b.column(n) for n in names}
            if any(spans):
                columns["text"] = pa.array([_without(t, s) if s else t for t, s in zip(b.column("text").to_pylist(), spans, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([*(columns[n] for n in names), b.column("spans")], names=[*names, "spans"])

    out = kept.mapInArrow(cut, kept.select(*names, "spans").schema)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(F.size("spans") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(kept.schema["n_chars"].dataType))
    return out.select(*names)


def without_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs``, with all their columns, cleaned of ``items``."""
    return unpacked(clean(matches(packed(docs), items)), docs.columns)


def _without(text: str, spans: list[dict]) -> str:
    data = np.frombuffer(text.encode(), np.uint8)
    starts, ends, _ = word_spans(_FOLDED[data], np.array([0, len(data)]), _SEPARATORS)
    keep = np.ones(len(data), bool)
    for s in spans:
        keep[starts[s["first"]] : ends[s["end"] - 1]] = False
    return data[keep].tobytes().decode("utf-8", "replace")
