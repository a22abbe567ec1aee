"""N-gram Jaccard join: documents whose sets of word shingles overlap by ``PERCENT`` of their union, by prefix trees.

Equal sets are one node from the start. Two filters that lose no pair keep the work near what is alike: a partner of a set
holds at least ``PERCENT`` of its shingles, so

1. only nodes of which that share of the shingles occurs in another node can have a partner. Shingles are counted where
   they meet, in packed blocks by hash, with the places of their nodes in a batch; of one that several nodes of a batch
   have, only one travels. Counts may be too high (copies in other batches, hashes of 32 bits within a shard), never too low.
2. The nodes left are put into clusters by strong ties (they share much of a fixed sample of their shingles with the
   least node of a shingle). Each cluster is joined exactly. Then shingles are counted again, now those that occur in
   another cluster: only nodes with that share of them can have a partner outside, and these are joined exactly among
   themselves, clustered by the shingles that sets must meet in (a prefix of each, in an order common to all).

The join of a cluster stores the sets, in one order of their shingles (most frequent first, then by hash), in a trie
with compressed paths. A set is carried through it: the overlap with a path is counted once for all sets below; a subtree
is left when its sizes, or the overlap so far and the shingles that remain on either side, can't reach the share, or when
all its sets are linked to the set already. So a group yields a spanning forest of links, not all its pairs. Clusters
over ``BLOCK`` sets are joined block by block, each pair of blocks in a task, which holds two blocks at most.

Shingles are 64-bit hashes of their words and sets 64-bit hashes of their shingles. Null and empty texts have no
shingles and are linked with nothing; a text of fewer words is one shingle. Rows that repeat are one node. Ids may
repeat or be null: a component is named by its least id that isn't null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import LOWER, Rolling, Staged, as_bytes, give_up, mix, parts, pieces, windows, word_spans
from tributary.llm.components import components

SHINGLE = 5
PERCENT = 75
BLOCK = 4096
TIE = 0.3
SAMPLED = 8
_SHARD_TOKENS = 1 << 20
_ROWS = 2048
_BATCH_TOKENS = 1 << 20
_NODES = pa.schema([("doc_id", pa.int64()), ("doc_key", pa.int64()), ("n", pa.int64()), ("node", pa.int64())])
_SETS = pa.schema([("node", pa.int64()), ("n", pa.int64()), ("shingles", pa.binary())])
_PACKED = pa.schema([("shard", pa.int32()), ("batch", pa.int64()), *[(n, pa.binary()) for n in ("shingle", "used", "counts", "nodes", "sizes")]])
_PACKED_KIND = "shard int, batch long, shingle binary, used binary, counts binary, nodes binary, sizes binary"
_COUNTS = pa.schema([("shard", pa.int32()), ("batch", pa.int64()), *[(n, pa.binary()) for n in ("used", "counts", "nodes", "sizes")]])
_CHOSEN = pa.schema([("node", pa.int64()), ("n", pa.int64())])
_NOBODY = np.uint16(0xFFFF)


def sets_of(data: np.ndarray, at: np.ndarray, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """Distinct shingle hashes of every row of a piece, ascending."""
    folded = LOWER[data]
    starts, ends, first = word_spans(folded, at)
    hashes, begins = windows(Rolling(folded).of(starts, ends), first, size, short=True)
    for a, z in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True):
        yield np.unique(hashes[a:z])


def node_of(shingles: np.ndarray) -> int:
    """A hash of the set."""
    return int(mix(np.array([mix(shingles).sum(dtype=np.uint64) + np.uint64(len(shingles))], np.uint64)).view(np.int64)[0])


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("doc_key"), text.alias("text"))


def nodes(texts: DataFrame) -> DataFrame:
    """``doc_id, doc_key, n, node`` of every document; no node without shingles."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(len(s), node_of(s) if len(s) else None) for _, _, data, at in pieces(*as_bytes(b.column("text"))) for s in sets_of(data, at)]
            n, node = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("doc_key"), pa.array(n, pa.int64()), pa.array(node, pa.int64())], schema=_NODES)

    return texts.mapInArrow(emit, "doc_id long, doc_key long, n long, node long")


def sets(texts: DataFrame) -> DataFrame:
    """``node, n, shingles`` of documents that have any."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, _, data, at in pieces(*as_bytes(b.column("text"))):
                rows = [(node_of(s), len(s), s.tobytes()) for s in sets_of(data, at) if len(s)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows, strict=True), _SETS, strict=True)], schema=_SETS)

    return texts.mapInArrow(emit, "node long, n long, shingles binary")


# ---- shingles that others have, too ---------------------------------------------------------------------------


def _pack(own: dict[int, tuple[int, np.ndarray]], n_shards: int) -> Iterator[pa.RecordBatch]:
    """A batch's blocks by shard: shingles, and whose they are by place in the batch. Its table of nodes goes to its home.

    Shingles that several labels of the batch have are counted here already. ``own``: ``label, shingles`` by node. A
    batch is named by what it holds, so that a task that runs again gives the same names.
    """
    node, label = np.array(list(own), np.int64), np.array([label for label, _ in own.values()], np.int64)
    held = [s for _, s in own.values()]
    size = np.array([len(s) for s in held], np.int64)
    name = int(mix(np.bitwise_xor.accumulate(mix(node.view(np.uint64) + np.arange(len(node), dtype=np.uint64)))[-1:]).view(np.int64)[0])
    tokens, ref = np.concatenate(held), np.repeat(np.arange(len(own), dtype=np.uint16), size)
    order = np.argsort(tokens, kind="stable")
    tokens, ref = tokens[order], ref[order]
    first = np.concatenate(([True], tokens[1:] != tokens[:-1]))
    begin = np.flatnonzero(first)
    counted = np.logical_or.reduceat(label[ref] != label[ref[begin]][np.cumsum(first) - 1], begin)[np.cumsum(first) - 1]
    counts = np.bincount(ref[counted], minlength=len(own))
    travels = ~counted | first
    tokens, ref = tokens[travels], np.where(counted, _NOBODY, ref)[travels]
    shard = ((tokens & np.uint64(0xFFFFFFFF)) % np.uint64(n_shards)).astype(np.int64)
    order = np.lexsort((ref, shard))  # shingles of nobody come last
    cuts = np.flatnonzero(np.diff(shard[order], prepend=-1))
    labelled = bool((label != node).any())
    rows: list[tuple] = [(name % n_shards, name, b"", b"", counts.astype(np.uint32).tobytes(), node.tobytes(), size.astype(np.uint32).tobytes())]
    for a, z in zip(cuts, [*cuts[1:], len(order)], strict=True):
        part = order[a:z]
        used, runs = np.unique(ref[part], return_counts=True)
        real = used != _NOBODY
        used, runs = used[real], runs[real]
        rows.append((int(shard[part[0]]), name, (tokens[part] >> np.uint64(32)).astype(np.uint32).tobytes(), used.tobytes(), _narrow(runs), label[used].tobytes() if labelled else b"", b""))
    yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows, strict=True), _PACKED, strict=True)], schema=_PACKED)


def _narrow(counts: np.ndarray) -> bytes:
    """Counts in one byte each where all fit, else in four."""
    return counts.astype(np.uint8 if counts.max(initial=0) < 256 else np.uint32).tobytes()


def _wide(counts: bytes, n: int) -> np.ndarray:
    return np.frombuffer(counts, np.uint8 if len(counts) == n else np.uint32).astype(np.int64)


def _count(n_shards: int):
    """How many of the shingles in a shard of each place of a batch others have, too; for the batch's home."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, refs, labels, blocks = [], [], [], []
        base = 0
        for b in batches:
            for shard, name, shingle, used, runs, label, size in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if size:  # the table of a batch: on to where its counts come together
                    yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((shard, name, b"", runs, label, size), _COUNTS, strict=True)], schema=_COUNTS)
                    continue
                used, shingle = np.frombuffer(used, np.uint16), np.frombuffer(shingle, np.uint32)
                runs = _wide(runs, len(used))
                tokens.append(shingle)
                refs.append(np.repeat(np.append(np.arange(base, base + len(used)), -1), np.append(runs, len(shingle) - runs.sum())))
                labels.append(np.frombuffer(label, np.int64) if label else np.zeros(len(used), np.int64))
                blocks.append((name, used, bool(label)))
                base += len(used)
        if not base:
            return
        token, ref, label = np.concatenate(tokens), np.concatenate(refs), np.concatenate([*labels, [0]])
        plain = np.append(np.repeat([not named for _, _, named in blocks], [len(used) for _, used, _ in blocks]), True)  # each its own label
        order = np.argsort(token, kind="stable")
        token, ref = token[order], ref[order]
        first = np.concatenate(([True], token[1:] != token[:-1]))
        begin, group = np.flatnonzero(first), np.cumsum(first) - 1
        several = np.diff(np.append(begin, len(token)))[group] > 1
        unlike = np.logical_or.reduceat((ref < 0) | plain[ref] | (label[ref] != label[ref[begin]][group]), begin)[group]
        found = np.bincount(ref[several & unlike & (ref >= 0)], minlength=base)
        at = 0
        for name, used, _ in blocks:
            own = found[at : at + len(used)]
            at += len(used)
            if own.any():
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((name % n_shards, name, used[own > 0].tobytes(), _narrow(own[own > 0]), b"", b""), _COUNTS, strict=True)], schema=_COUNTS)

    return counted


def _enough(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of which enough shingles are shared, from all shards' counts of each batch."""
    tables: dict[int, list[np.ndarray]] = {}
    waiting: dict[int, list[tuple[bytes, bytes]]] = {}
    for b in batches:
        for name, used, counts, nodes_, sizes in zip(*(b.column(k).to_pylist() for k in range(1, 6)), strict=True):
            if sizes:
                tables[name] = [np.frombuffer(nodes_, np.int64), np.frombuffer(sizes, np.uint32), np.frombuffer(counts, np.uint32).astype(np.int64)]
            else:
                waiting.setdefault(name, []).append((used, counts))
    for name, (node, size, shared) in tables.items():
        for used, counts in waiting.get(name, ()):
            at = np.frombuffer(used, np.uint16)
            shared[at] += _wide(counts, len(at))
        keep = 100 * shared >= PERCENT * size.astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(node[keep]), pa.array(size[keep].astype(np.int64))], schema=_CHOSEN)


def _sharing(packed: DataFrame, n_shards: int) -> DataFrame:
    """``node, n`` of nodes that share enough of their shingles with other labels to have a partner there.

    Never too few: shingles that only look alike are counted, and so are those of the node's own copy in another batch.
    """
    counted = packed.repartition(n_shards, "shard").mapInArrow(_count(n_shards), "shard int, batch long, used binary, counts binary, nodes binary, sizes binary")
    return counted.repartition(n_shards, "shard").mapInArrow(_enough, "node long, n long")


def _batched(sets_: Iterator[tuple[int, int, np.ndarray]], n_shards: int) -> Iterator[pa.RecordBatch]:
    """``node, label, shingles`` in batches of a bounded number of shingles (or one set), copies once a batch."""
    own: dict[int, tuple[int, np.ndarray]] = {}
    held = 0
    for node, label, s in sets_:
        if len(s) and node not in own:
            if own and (held + len(s) > _BATCH_TOKENS or len(own) == _ROWS):
                yield from _pack(own, n_shards)
                own, held = {}, 0
            own[node] = (label, s)
            held += len(s)
    if own:
        yield from _pack(own, n_shards)


def _pack_texts(n_shards: int):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray]]:
        give_up()
        for b in batches:
            for _, _, data, at in pieces(*as_bytes(b.column("text"))):
                for s in sets_of(data, at):
                    node = node_of(s)
                    yield node, node, s

    return lambda batches: _batched(found(batches), n_shards)


def _pack_sets(n_shards: int):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray]]:
        give_up()
        for b in batches:
            for k in range(0, b.num_rows, _ROWS):
                for node, label, s in zip(*(b.column(c).slice(k, _ROWS).to_pylist() for c in ("node", "label", "shingles")), strict=True):
                    yield node, label, np.frombuffer(s, np.uint64)

    return lambda batches: _batched(found(batches), n_shards)


# ---- clusters -----------------------------------------------------------------------------------------------


def _sampled(rate: int):
    """``shingle, node, of``: of large sets one shingle in ``rate``; ``of`` is how many of the set's there are.

    At rate 1, those by which sets must meet: two sets that reach the share have one of their least
    ``n - ceil(n * PERCENT / 100) + 1`` in common, whatever the order that all sets agree on (here, of the hashes).
    """
    kind = pa.schema([("shingle", pa.int64()), ("node", pa.int64()), ("of", pa.int64())])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tokens, node, of = [], [], []
            for own, s in zip(b.column("node").to_pylist(), b.column("shingles").to_pylist(), strict=True):
                some = np.frombuffer(s, np.uint64)
                if rate == 1:
                    some = some[: len(some) + 1 + -PERCENT * len(some) // 100]
                elif len(some) >= 8 * rate:
                    some = some[some % np.uint64(rate) == 0]
                tokens.append(some.view(np.int64))
                node.append(np.full(len(some), own))
                of.append(np.full(len(some), len(some)))
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v), pa.int64()) for v in (tokens, node, of)], schema=kind)

    return emit


def _tied(found: DataFrame, rate: int, share: float) -> DataFrame:
    """Ties ``a, b`` of nodes to the least node of a shingle, where that holds for ``share`` of their sampled ones."""
    rows = Staged(found.mapInArrow(_sampled(rate), "shingle long, node long, of long"), "sampled")
    hubs = Staged(rows.df.groupBy("shingle").agg(F.min("node").alias("hub"), F.max("node").alias("most")).where("hub < most").select("shingle", "hub"), "hubs")
    met = rows.df.join(hubs.df, "shingle").where("node <> hub").groupBy("node", "hub").agg(F.count("*").alias("ties"), F.first("of").alias("of"))
    ties = Staged(met.where(F.col("ties") >= share * F.col("of")).select(F.col("node").alias("a"), F.col("hub").alias("b")), "ties").df
    rows.drop()
    hubs.drop()
    return ties


# ---- the exact join of a cluster --------------------------------------------------------------------------------


class _Subtree:
    __slots__ = ("segment", "last", "low", "high", "least", "most", "deepest", "below")

    def __init__(self, segment: np.ndarray, last: int, low: int, high: int):
        self.segment, self.last, self.low, self.high = segment, last, low, high
        self.below: list[_Subtree] = []


class Trie:
    """Sets of shingle numbers, ascending, as paths; sets of a subtree are next to each other."""

    def __init__(self, ordered: list[np.ndarray], sizes: np.ndarray):
        """``ordered``: sets in the order of their sequences. ``sizes``: also counts shingles that no other set has."""
        self.sets, self.sizes = ordered, sizes
        common = [0] * (len(ordered) + 1)
        for k in range(1, len(ordered)):
            a, b = ordered[k - 1], ordered[k]
            n = min(len(a), len(b))
            unlike = np.flatnonzero(a[:n] != b[:n])
            common[k] = int(unlike[0]) if len(unlike) else n
        self.common = common
        self.roots = self._children(0, len(ordered), 0)

    def _children(self, low: int, high: int, depth: int) -> list[_Subtree]:
        """Subtrees of the sets from ``low`` to ``high``, which agree in their first ``depth`` numbers."""
        out, todo = [], [(low, high, depth, None)]
        while todo:
            low, high, depth, parent = todo.pop()
            start = low
            while start < high:
                end = start + 1
                while end < high and self.common[end] > depth:
                    end += 1
                to = min([len(self.sets[start]), *self.common[start + 1 : end]]) if end > start + 1 else len(self.sets[start])
                to = max(to, depth)
                own = _Subtree(self.sets[start][depth:to], int(self.sets[start][to - 1]) if to else -1, start, end)
                own.least, own.most = int(self.sizes[start:end].min()), int(self.sizes[start:end].max())
                own.deepest = max(len(s) for s in self.sets[start:end]) - to
                (out if parent is None else parent.below).append(own)
                inner = start
                while inner < end and len(self.sets[inner]) == to:
                    inner += 1
                if inner < end:
                    todo.append((inner, end, to, own))
                start = end
        return out

    def links(self) -> list[tuple[int, int]]:
        """Links that join the sets which reach the share, one less than sets for each component."""
        found: list[tuple[int, int]] = []
        root = np.arange(len(self.sets))
        n_numbers = max((int(s[-1]) + 1 for s in self.sets if len(s)), default=0)
        mine = np.zeros(n_numbers, bool)
        for q in range(1, len(self.sets)):
            own, size = self.sets[q], int(self.sizes[q])
            mine[own] = True
            todo = [(t, 0) for t in self.roots]
            while todo:
                t, overlap = todo.pop()
                if t.low >= q or 100 * t.most < PERCENT * size or 100 * size < PERCENT * t.least:
                    continue
                if (root[t.low : min(t.high, q)] == root[q]).all():
                    continue
                overlap += int(np.count_nonzero(mine[t.segment]))
                rest = min(len(own) - int(np.searchsorted(own, t.last, "right")), t.deepest)
                if (100 + PERCENT) * (overlap + rest) < PERCENT * (size + t.least):
                    continue
                at = t.low
                while at < min(t.high, q) and len(self.sets[at]) == len(self.sets[t.low]) and (not t.below or at < t.below[0].low):
                    if root[at] != root[q] and (100 + PERCENT) * overlap >= PERCENT * (size + int(self.sizes[at])):
                        found.append((at, q))
                        root[root == root[q]] = root[at]
                    at += 1
                todo.extend((below, overlap) for below in t.below)
            mine[own] = False
        return found


def cluster_links(nodes_: list[int], shingles: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links between the sets of a cluster, by node."""
    tokens, inverse, n = np.unique(np.concatenate(shingles), return_inverse=True, return_counts=True)
    order = np.lexsort((tokens, -n))
    number = np.empty(len(tokens), np.int64)
    number[order] = np.arange(len(tokens))
    ends = np.cumsum([len(s) for s in shingles])
    numbered = [np.sort(own[own < np.count_nonzero(n > 1)]) for own in np.split(number[inverse], ends[:-1])]
    by_path = sorted(range(len(numbered)), key=lambda k: (numbered[k].astype(">u4").tobytes(), nodes_[k]))
    trie = Trie([numbered[k] for k in by_path], np.array([len(shingles[k]) for k in by_path]))
    return [(nodes_[by_path[a]], nodes_[by_path[b]]) for a, b in trie.links()]


def _join_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of every ``label, one, two`` of a partition that is sorted by them."""
    kind = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    held, now = {}, None

    def joined() -> Iterator[pa.RecordBatch]:
        if len(held) > 1:
            found = cluster_links(list(held), list(held.values()))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*found, strict=True)], schema=kind)

    for b in batches:
        for key, node, s in zip(zip(*(b.column(c).to_pylist() for c in ("label", "one", "two")), strict=True), b.column("node").to_pylist(), b.column("shingles").to_pylist(), strict=True):
            if key != now:
                yield from joined()
                held, now = {}, key
            held[node] = np.frombuffer(s, np.uint64)
    yield from joined()


def _joined(found: DataFrame, ties: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """Links inside the components of ``ties``, and the sets with their component's ``label`` (their own if alone)."""
    labels = components(ties)
    marked = found.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    sizes = labels.groupBy("label").agg(F.count("*").alias("size")).withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = (
        found.join(labels, "node").join(sizes.select("label", "blocks"), "label").withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("label", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "node", "shingles")
    )
    groups = dealt.repartition(n, "label", "one", "two").sortWithinPartitions("label", "one", "two")
    return groups.mapInArrow(_join_groups, "a long, b long"), marked


def classes(docs: DataFrame) -> DataFrame:
    """``doc_id, doc_key, n_shingles, component, component_id`` of every document: a component's key, and its least id."""
    spark = docs.sparkSession
    texts = _texts(docs)
    all_nodes = Staged(nodes(texts), "nodes").df
    total = all_nodes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    n = parts(spark, total, _SHARD_TOKENS)
    alike = Staged(_sharing(texts.mapInArrow(_pack_texts(n), _PACKED_KIND), n), "alike")
    chosen = all_nodes.join(alike.df.select("node"), "node").groupBy("node").agg(F.min(F.struct("doc_id", "doc_key")).alias("one")).select("one.*")
    same = F.col("t.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("t.doc_key") == F.col("c.doc_key"))
    found = Staged(sets(texts.alias("t").join(chosen.alias("c").hint("merge"), same).select("t.text")), "sets")
    alike.drop()
    inner, marked = _joined(found.df, _tied(found.df, SAMPLED, TIE), n)
    inner, marked = Staged(inner, "inner-links"), Staged(marked, "marked")
    found.drop()
    outside = Staged(_sharing(marked.df.mapInArrow(_pack_sets(n), _PACKED_KIND), n), "outside")
    rest = Staged(marked.df.drop("label").join(outside.df.select("node"), "node", "left_semi"), "rest")
    marked.drop()
    outside.drop()
    across, _ = _joined(rest.df, _tied(rest.df, 1, 0.0), n)
    labels = components(inner.df.unionByName(across))
    inner.drop()
    rest.drop()
    named = all_nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = named.where("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    out = named.join(least, "label", "left")
    return out.select("doc_id", "doc_key", F.col("n").alias("n_shingles"), F.col("label").alias("component"), F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """Rows of ``docs``, as they are: of each component the one of least id (null last), and all without shingles."""
    found = Staged(classes(docs), "classes").df
    best = found.where("component IS NOT NULL").groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "doc_key")).alias("one"))
    stay = best.select("one.doc_id", "one.doc_key").withColumn("alone", F.lit(False)).unionByName(found.where("component IS NULL").select("doc_id", "doc_key").distinct().withColumn("alone", F.lit(True)))
    own = docs.select(F.struct(*[F.col(f"`{n}`") for n in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("doc_key"))
    same = F.col("s.doc_id").eqNullSafe(F.col("o.doc_id")) & (F.col("s.doc_key") == F.col("o.doc_key"))
    met = own.alias("o").join(stay.alias("s").hint("merge"), same).select("o.*", "alone")
    number = F.row_number().over(Window.partitionBy("doc_id", "doc_key").orderBy("alone"))
    once = met.withColumn("number", number).where("alone OR number = 1")
    return once.select(*[F.col("row").getField(n).alias(n) for n in docs.columns])
