"""Cross-tokenizer alignment: where the tokens of two tokenizers end together, and which ids meet how often.

Both tokenizers read a space and the text. Tokens lie on the same bytes, so bytes where a token of each ends cut them into
groups, and every stretch between two neighbouring ends is one link: just the one pair of tokens covers it.

A range of bytes gives a fragment: what comes up to the first common end (the open prefix, whose group may have begun
earlier), the closed groups, and what follows the last common end (the open suffix). A range without a common end is all
open. Two fragments make one: a suffix and the next prefix are a group, counted then. This is associative, so ranges of a
text may be put together in any tree. Texts up to ``LONG`` bytes are one range. A longer one is cut before blanks, where
both tokenizers always cut (checked for the second one's pieces when it is loaded); its chunks go to different tasks,
each is aligned by ranges of ``RANGE`` bytes, and the fragments meet ``FAN`` at a time, round by round.

How many documents hold a pair of ids is counted in tasks first and then by pair. A pair that makes up at least one part in
``HEAD`` of all such holdings is in a table that goes to every task, and there can't be more than ``HEAD`` of these. The
others, none of which many documents hold, meet their documents in a join.

Null and empty texts, and texts whose tokens don't spell them (those with U+2581, for instance), have zeros and an empty
digest. Repeated rows and ids are documents of their own; ids may be null. An empty table gives no rows. Very long texts
follow the way above; one stretch without blanks stays in one task. Columns beside id and text are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field, fields
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.bpe import WHITE, byte_alphabet
from tributary.llm.common import Staged, parts

LONG = 1 << 16
RANGE = 1 << 13
FAN = 8
HEAD = 1 << 18
_BATCH = 1 << 18  # characters tokenised at a time
_COUNTED = 1 << 21  # pairs of a task that wait to be counted
_SPACE = "▁"  # fixed value: the second tokenizer's sign for a space
_CUT = re.compile(r"\S (?=[\s\S])")  # something must follow the blank
_UNIT = re.compile(rf"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")  # the first tokenizer always cuts before white space
KEPT_UNITS = 1 << 18
KEPT_SIZE = 24
_NONE = np.zeros(0, np.int64)


# ---- tokens --------------------------------------------------------------------------------------------------------


class _Table:
    """Bytes of all ids of a vocabulary."""

    def __init__(self, spelt: list[bytes]):
        self.sizes = np.array([len(b) for b in spelt], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(spelt), np.uint8)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        n = self.sizes[ids]
        return self.bytes[np.repeat(self.begins[ids] - np.cumsum(n) + n, n) + np.arange(n.sum())]


class Tokenizers:
    """The two tokenizers, and what their ids spell."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = SentencePieceProcessor(model_file=path_b)
        to_byte = {c: bytes([k]) for k, c in enumerate(byte_alphabet())}
        vocabulary = self.a.get_vocab()
        spelt = [b""] * (max(vocabulary.values()) + 1)
        for token, k in vocabulary.items():
            spelt[k] = b"".join(to_byte.get(c, c.encode()) for c in token)
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        if any(_SPACE in p.lstrip(_SPACE) for p in pieces):
            raise ValueError("pieces that hold a space behind another character can't be cut at blanks")
        self.spelt_a = _Table(spelt)
        self.spelt_b = _Table([bytes([int(p[1:-1], 16)]) if self.b.is_byte(k) else p.replace(_SPACE, " ").encode() for k, p in enumerate(pieces)])
        self.most_b = len(pieces)
        # A space and ASCII letters are one piece of the first tokenizer's pattern, which its model may be asked for at once
        # if no added token is part of such.
        self.direct = not any(t.content.strip().isalpha() for t in self.a.get_added_tokens_decoder().values())
        self.kept: dict[str, bytes] = {}

    def _ids_a(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of the first tokenizer. It is asked for each unit once in a while; short ones are kept, at most ``KEPT_UNITS`` and a batch."""
        cut = [_UNIT.findall(t) for t in texts]
        own = set().union(*cut)
        known = {u: self.kept[u] for u in own & self.kept.keys()}
        new = list(own.difference(known))
        words = [u for u in new if self.direct and u[1:].isalpha() and u.isascii() and u[0] == " "]
        tokenize = self.a.model.tokenize
        known.update((u, array("q", [t.id for t in tokenize("\u0120" + u[1:])]).tobytes()) for u in words)
        others = list(set(new).difference(words))
        known.update((u, array("q", e.ids).tobytes()) for u, e in zip(others, self.a.encode_batch_fast(others, add_special_tokens=False), strict=True))
        if len(self.kept) > KEPT_UNITS:
            self.kept = {}
        self.kept.update((u, ids) for u, ids in known.items() if len(u) <= KEPT_SIZE)
        return [np.frombuffer(b"".join([known[u] for u in units]), np.int64) for units in cut]

    def tokens(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of both for each text (which stands behind a space); None where they don't spell it."""
        spaced = [" " + t for t in texts]
        out = []
        for text, a, b in zip(spaced, self._ids_a(spaced), self.b.encode(texts, num_threads=1), strict=True):
            b, wanted = np.array(b, np.int64), text.encode()
            same = all(table.sizes[ids].sum() == len(wanted) and table.spell(ids).tobytes() == wanted for table, ids in ((self.spelt_a, a), (self.spelt_b, b)))
            out.append((a, b) if same else None)
        return out


@lru_cache(maxsize=1)
def load(path_a: str, path_b: str) -> Tokenizers:
    """One pair of tokenizers for each worker: tables of fixed size."""
    return Tokenizers(path_a, path_b)


# ---- groups and links ----------------------------------------------------------------------------------------------


@lru_cache(maxsize=1)
def _digits() -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of the numbers under 100,000, from the left, and how many there are."""
    number = np.arange(100_000)
    n = np.searchsorted(10 ** np.arange(1, 5), number, "right") + 1
    place = n[:, None] - 1 - np.arange(5)
    return (number[:, None] // 10 ** np.maximum(place, 0) % 10 + ord("0")).astype(np.uint8), n


@dataclass
class Closed:
    """Whole groups: how many, their text, and their pairs of ids with the number of links."""

    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    n_links: int = 0
    text: bytes = b""
    pairs: np.ndarray = field(default_factory=lambda: _NONE)
    links: np.ndarray = field(default_factory=lambda: _NONE)

    def then(self, other: Closed) -> Closed:
        if not self.n_groups or not other.n_groups:
            return self if self.n_groups else other
        pairs, at = np.unique(np.concatenate((self.pairs, other.pairs)), return_inverse=True)
        links = np.zeros(len(pairs), np.int64)
        np.add.at(links, at, np.concatenate((self.links, other.links)))
        return Closed(self.n_a + other.n_a, self.n_b + other.n_b, self.n_groups + other.n_groups, self.n_links + other.n_links, self.text + b";" + other.text, pairs, links)


def closed(ids_a: np.ndarray, ends_a: np.ndarray, ids_b: np.ndarray, ends_b: np.ndarray, low: np.ndarray, high: np.ndarray, most_b: int) -> list[Closed]:
    """The groups inside each range ``low..high`` of bytes; ranges are apart, ascending, and begin and end at common ends."""
    n = len(low)
    home_a, home_b = np.searchsorted(high, ends_a), np.searchsorted(high, ends_b)
    bottom = np.append(low, np.iinfo(np.int64).max)
    in_a, in_b = ends_a > bottom[home_a], ends_b > bottom[home_b]
    ids_a, ends_a, home_a = ids_a[in_a], ends_a[in_a], home_a[in_a]
    ids_b, ends_b, home_b = ids_b[in_b], ends_b[in_b], home_b[in_b]
    ends = np.sort(np.concatenate((ends_a, ends_b)), kind="stable")  # merges two runs
    ends = ends[np.append(np.diff(ends) > 0, True)[: len(ends)]]
    at_a, at_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
    home = np.searchsorted(high, ends)
    common = (ends_a[at_a] == ends) & (ends_b[at_b] == ends)
    whole, n_links = np.unique(home * (most_b << 17) + ids_a[at_a] * most_b + ids_b[at_b], return_counts=True)
    first_pair = np.searchsorted(whole, np.arange(n + 1) * (most_b << 17))
    pairs = whole % (most_b << 17)

    groups = ends[common]
    group_a, group_b = np.searchsorted(groups, ends_a), np.searchsorted(groups, ends_b)
    in_group_a, in_group_b = np.bincount(group_a, minlength=len(groups)), np.bincount(group_b, minlength=len(groups))
    begins = np.cumsum(in_group_a + in_group_b) - in_group_a - in_group_b
    place_a = begins[group_a] + np.arange(len(ids_a)) - (np.cumsum(in_group_a) - in_group_a)[group_a]
    place_b = (begins + in_group_a)[group_b] + np.arange(len(ids_b)) - (np.cumsum(in_group_b) - in_group_b)[group_b]
    ids = np.empty(len(ids_a) + len(ids_b), np.int64)
    ids[place_a], ids[place_b] = ids_a, ids_b
    digits, size = _digits()
    rows = np.empty((len(ids), 6), np.uint8)
    rows[:, :5], rows[:, 5] = digits[ids], ord(",")
    rows[begins + in_group_a - 1, 5] = ord("|")
    rows[begins + in_group_a + in_group_b - 1, 5] = ord(";")
    last = np.searchsorted(groups, high)  # the group that ends a range has nothing behind it
    shown = np.arange(6) < size[ids][:, None]
    shown[:, 5] = True
    ended = begins[last] + in_group_a[last] + in_group_b[last] if n else _NONE
    shown[ended - 1, 5] = False
    text = rows[shown].tobytes()
    text_ends = np.cumsum(shown.sum(axis=1))[ended - 1].tolist() if n else []

    totals = [np.bincount(x, minlength=n).tolist() for x in (home_a, home_b, home[common], home)]
    return [Closed(*(t[k] for t in totals), text[a:z], pairs[x:y], n_links[x:y]) for k, (a, z, x, y) in enumerate(zip([0, *text_ends], text_ends, first_pair, first_pair[1:], strict=False))]


# ---- fragments -----------------------------------------------------------------------------------------------------


@dataclass
class Open:
    """Tokens of a group that isn't whole yet: ids and byte sizes of both kinds."""

    ids_a: np.ndarray = field(default_factory=lambda: _NONE)
    sizes_a: np.ndarray = field(default_factory=lambda: _NONE)
    ids_b: np.ndarray = field(default_factory=lambda: _NONE)
    sizes_b: np.ndarray = field(default_factory=lambda: _NONE)

    def then(self, other: Open) -> Open:
        return Open(*(np.concatenate((getattr(self, f.name), getattr(other, f.name))) for f in fields(Open)))

    def close(self, most_b: int) -> Closed:
        ends_a, ends_b = np.cumsum(self.sizes_a), np.cumsum(self.sizes_b)
        if not len(ends_a) and not len(ends_b):
            return Closed()
        return closed(self.ids_a, ends_a, self.ids_b, ends_b, np.zeros(1, np.int64), ends_a[-1:], most_b)[0]


@dataclass
class Fragment:
    """A range of bytes; ``cut`` says whether a common end (or the start of the text) is in it. Else all is in ``before``."""

    cut: bool
    before: Open
    groups: Closed
    after: Open

    def then(self, other: Fragment, most_b: int) -> Fragment:
        if not self.cut:
            return Fragment(other.cut, self.before.then(other.before), other.groups, other.after)
        if not other.cut:
            return Fragment(True, self.before, self.groups, self.after.then(other.before))
        between = self.after.then(other.before).close(most_b)
        return Fragment(True, self.before, self.groups.then(between).then(other.groups), other.after)


def start() -> Fragment:
    """What a text begins with: a common end, and nothing else."""
    return Fragment(True, Open(), Closed(), Open())


def fragments(ids_a: np.ndarray, sizes_a: np.ndarray, ids_b: np.ndarray, sizes_b: np.ndarray, width: int, most_b: int) -> list[Fragment]:
    """Fragments of the ranges of ``width`` bytes of a chunk. A token belongs to the range it ends in."""
    ends_a, ends_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
    common = np.intersect1d(ends_a, ends_b)
    edges = np.append(np.arange(width, ends_a[-1], width), ends_a[-1])
    first, behind = np.searchsorted(common, np.append(0, edges[:-1]), "right"), np.searchsorted(common, edges, "right")
    cut = np.flatnonzero(behind > first)
    low, high = common[first[cut]], common[behind[cut] - 1]
    some = np.flatnonzero(high > low)
    groups = dict(zip(cut[some].tolist(), closed(ids_a, ends_a, ids_b, ends_b, low[some], high[some], most_b), strict=True))

    def between(a: int, z: int) -> Open:
        x, y = np.searchsorted(ends_a, (a, z), "right")
        v, w = np.searchsorted(ends_b, (a, z), "right")
        return Open(ids_a[x:y], sizes_a[x:y], ids_b[v:w], sizes_b[v:w])

    out, at = [], 0
    bounds = dict(zip(cut.tolist(), zip(low.tolist(), high.tolist(), strict=True), strict=True))
    for k, edge in enumerate(edges.tolist()):
        if k in bounds:
            out.append(Fragment(True, between(at, bounds[k][0]), groups.get(k, Closed()), between(bounds[k][1], edge)))
        else:
            out.append(Fragment(False, between(at, edge), Closed(), Open()))
        at = edge
    return out


# ---- documents -----------------------------------------------------------------------------------------------------

_DONE = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("chunk", pa.int32()), ("body", pa.string()), *[(n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")], ("groups_sha256", pa.string()), ("pairs", pa.binary()), ("links", pa.binary())])
_DONE_KIND = "key long, doc_id long, chunk int, body string, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, links binary"
_SIDES = [f"{side}_{f.name}" for side in ("before", "after") for f in fields(Open)]
_PART = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("chunk", pa.int32()), ("spelt", pa.bool_()), ("cut", pa.bool_()), *[(n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")], *[(n, pa.binary()) for n in ("text", "pairs", "links", *_SIDES)]])
_PART_KIND = "key long, doc_id long, chunk int, spelt boolean, cut boolean, n_a long, n_b long, n_groups long, n_links long, " + ", ".join(f"{n} binary" for n in ("text", "pairs", "links", *_SIDES))


def _done(key: int, doc_id: int | None, groups: Closed) -> tuple:
    digest = hashlib.sha256(groups.text).hexdigest() if groups.n_groups else ""
    return key, doc_id, None, None, groups.n_a, groups.n_b, groups.n_groups, groups.n_links, digest, groups.pairs.tobytes(), groups.links.tobytes()


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def bodies(text: str, size: int) -> Iterator[str]:
    """A text in chunks of ``size`` characters or a little more, cut before blanks; each stands behind a space that isn't in it."""
    at = 0
    while True:
        met = _CUT.search(text, at + size)
        if met is None:
            yield text[at:]
            return
        yield text[at : met.start() + 1]
        at = met.start() + 2


def _short(batch: list[tuple[int, int | None, str]], both: Tokenizers) -> list[tuple]:
    """Rows of texts that are one range each, aligned at once."""
    tokens = both.tokens([t for _, _, t in batch])
    good = [k for k, t in enumerate(tokens) if t is not None]
    found: dict[int, Closed] = {}
    if good:
        ids_a, ids_b = (np.concatenate([tokens[k][side] for k in good]) for side in (0, 1))
        ends_a, ends_b = np.cumsum(both.spelt_a.sizes[ids_a]), np.cumsum(both.spelt_b.sizes[ids_b])
        high = ends_a[np.cumsum([len(tokens[k][0]) for k in good]) - 1]
        found = dict(zip(good, closed(ids_a, ends_a, ids_b, ends_b, np.append(0, high[:-1]), high, both.most_b), strict=True))
    return [_done(key, doc_id, found.get(k, Closed())) for k, (key, doc_id, _) in enumerate(batch)]


def _aligned(paths: tuple[str, str], long: int):
    """Rows of the texts that are one range, and the chunks of the others."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = load(*paths)
        for b in batches:
            rows, waiting, n = [], [], 0
            for key, doc_id, text in zip(*(b.column(c).to_pylist() for c in ("key", "doc_id", "text")), strict=True):
                if not text:
                    rows.append(_done(key, doc_id, Closed()))
                elif len(text) > long:
                    rows += [(key, doc_id, k, body, None, None, None, None, None, None, None) for k, body in enumerate(bodies(text, long))]
                else:
                    waiting.append((key, doc_id, text))
                    n += len(text)
                if n >= _BATCH or len(rows) >= 1024:
                    if waiting:
                        rows += _short(waiting, both)
                    yield _rows(rows, _DONE)
                    rows, waiting, n = [], [], 0
            if waiting:
                rows += _short(waiting, both)
            if rows:
                yield _rows(rows, _DONE)

    return emit


def _packed(key: int, doc_id: int | None, chunk: int, spelt: bool, f: Fragment) -> tuple:
    g = f.groups
    sides = [getattr(side, x.name).tobytes() for side in (f.before, f.after) for x in fields(Open)]
    return key, doc_id, chunk, spelt, f.cut, g.n_a, g.n_b, g.n_groups, g.n_links, g.text, g.pairs.tobytes(), g.links.tobytes(), *sides


def _unpacked(row: dict) -> Fragment:
    side = [Open(*(np.frombuffer(row[f"{s}_{f.name}"], np.int64) for f in fields(Open))) for s in ("before", "after")]
    groups = Closed(*(row[n] for n in ("n_a", "n_b", "n_groups", "n_links", "text")), *(np.frombuffer(row[n], np.int64) for n in ("pairs", "links")))
    return Fragment(row["cut"], side[0], groups, side[1])


def _chunk_fragments(paths: tuple[str, str], width: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = load(*paths)
        for b in batches:
            for key, doc_id, chunk, body in zip(*(b.column(c).to_pylist() for c in ("key", "doc_id", "chunk", "body")), strict=True):
                tokens, whole = both.tokens([body])[0], start() if chunk == 0 else Fragment(False, Open(), Closed(), Open())
                if tokens is not None:
                    a, n = tokens
                    whole = reduce(lambda x, y: x.then(y, both.most_b), fragments(a, both.spelt_a.sizes[a], n, both.spelt_b.sizes[n], width, both.most_b), whole)
                yield _rows([_packed(key, doc_id, chunk, tokens is not None, whole)], _PART)

    return emit


def _met(most_b: int):
    """Fragments of neighbouring chunks as one."""

    def emit(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
        whole, spelt = reduce(lambda x, y: x.then(y, most_b), map(_unpacked, rows)), all(r["spelt"] for r in rows)
        return pa.Table.from_batches([_rows([_packed(rows[0]["key"], rows[0]["doc_id"], rows[0]["chunk"] // FAN, spelt, whole)], _PART)])

    return emit


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for row in b.to_pylist():
            yield _rows([_done(row["key"], row["doc_id"], _unpacked(row).groups if row["spelt"] else Closed())], _DONE)


def align(docs: DataFrame, path_a: str, path_b: str, long: int = LONG, width: int = RANGE) -> DataFrame:
    """``key, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, links`` of every document, staged.

    ``pairs`` are the distinct linked ids (as ``a * size of B + b``) and ``links`` how many links each has, as 64-bit numbers.
    """
    paths, spark = (path_a, path_b), docs.sparkSession
    most_b = load(*paths).most_b
    texts = docs.select(F.monotonically_increasing_id().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    first = Staged(texts.mapInArrow(_aligned(paths, long), _DONE_KIND), "aligned")
    chunks = first.df.where("chunk IS NOT NULL")
    n_chunks, last = chunks.agg(F.count("*"), F.max("chunk")).first()
    found = first.df.where("chunk IS NULL")
    if n_chunks:
        each = chunks.select("key", "doc_id", "chunk", "body").repartition(parts(spark, n_chunks, 16), "key", "chunk").mapInArrow(_chunk_fragments(paths, width), _PART_KIND)
        while True:
            each = each.groupBy("key", F.floor(F.col("chunk") / FAN)).applyInArrow(_met(most_b), _PART_KIND)
            last //= FAN
            if not last:
                break
        found = found.unionByName(Staged(each.mapInArrow(_finished, _DONE_KIND), "aligned-long").df)
    return found.drop("chunk", "body")


# ---- how many documents hold a pair ----------------------------------------------------------------------------------


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``pair, n`` of a task's documents."""
    kind = pa.schema([("pair", pa.int64()), ("n", pa.int64())])
    pairs, n, waiting, waits = _NONE, _NONE, [], 0

    def added() -> tuple[np.ndarray, np.ndarray]:
        own, at = np.unique(np.concatenate([pairs, *waiting]), return_inverse=True)
        total = np.zeros(len(own), np.int64)
        np.add.at(total, at, np.concatenate([n, np.ones(waits, np.int64)]))
        return own, total

    for b in batches:
        for held in b.column("pairs"):
            waiting.append(np.frombuffer(held.as_buffer(), np.int64))
            waits += len(waiting[-1])
            if waits >= _COUNTED:
                (pairs, n), waiting, waits = added(), [], 0
                if len(pairs) >= _COUNTED:
                    yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)], schema=kind)
                    pairs, n = _NONE, _NONE
    pairs, n = added()
    yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)], schema=kind)


def pair_counts(aligned: DataFrame, most_b: int) -> DataFrame:
    """``pair, n, best``: documents that hold a pair, and whether no pair of its first id is in more of them."""
    counts = aligned.select("pairs").mapInArrow(_counted, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    of_a = Window.partitionBy(F.expr(f"pair div {most_b}"))  # at most as many rows as the second vocabulary has ids
    return counts.select("pair", "n", (F.col("n") == F.max("n").over(of_a)).cast("int").alias("best"))


def with_counts(aligned: DataFrame, counts: DataFrame, head: int = HEAD) -> DataFrame:
    """``n_best`` and ``count_sum`` in place of ``pairs`` and ``links``."""
    spark = aligned.sparkSession
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    common = F.col("n").cast("decimal(38,0)") * head >= F.lit(total).cast("decimal(38,0)")
    table = counts.where(common).toArrow().sort_by("pair")  # at most ``head`` rows
    shared = spark.sparkContext.broadcast(tuple(table.column(c).to_numpy() for c in ("pair", "n", "best")))

    def looked_up(b: pa.RecordBatch) -> tuple:
        pairs, links = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.int64) for c in ("pairs", "links"))
        row = np.concatenate(([0], np.cumsum([len(x) // 8 for x in b.column("pairs").to_pylist()]))).astype(np.int64)
        known, n, best = shared.value
        at = np.searchsorted(known, pairs)
        at[at == len(known)] = 0
        there = known[at] == pairs if len(known) else np.zeros(len(pairs), bool)
        return pairs, links, row, n, best, at, there

    kept = ["key", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, links, row, n, best, at, there = looked_up(b)
            sums = [np.concatenate(([0], np.cumsum(np.where(there, links * (v[at] if len(v) else 0), 0))))[row] for v in (best, n)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), *(pa.array(np.diff(s)) for s in sums)], names=[*kept, "n_best", "count_sum"])

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pairs, links, row, _, _, _, there = looked_up(b)
            key = np.repeat(b.column("key").to_numpy(), np.diff(row))
            yield pa.RecordBatch.from_arrays([pa.array(x[~there]) for x in (key, pairs, links)], names=["key", "pair", "links"])

    docs = aligned.mapInArrow(summed, "key long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long")
    rare = aligned.select("key", "pairs", "links").mapInArrow(others, "key long, pair long, links long").join(counts.where(~common), "pair")
    more = rare.groupBy("key").agg(F.sum(F.col("links") * F.col("best")).alias("rare_best"), F.sum(F.col("links") * F.col("n")).alias("rare_sum"))
    met = docs.join(more, "key", "left")
    sums = ((F.col(a) + F.coalesce(F.col(b), F.lit(0))).alias(a) for a, b in (("n_best", "rare_best"), ("count_sum", "rare_sum")))
    return met.select("doc_id", "n_a", "n_b", "n_groups", "n_links", *sums, "groups_sha256")


def report(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every document."""
    aligned = align(docs, path_a, path_b)
    return with_counts(aligned, Staged(pair_counts(aligned, load(path_a, path_b).most_b), "pair-counts").df)
