"""Byte-level BPE as a streaming transducer with bounded lookahead, and a byte-to-text state machine to decode.

A merge list fixes how far to the right a token can depend on text: ``lookahead`` follows, through the merges in their
order, the furthest that a difference at the end of a text can travel to the left. A merge (a, b) carries it over a,
when b can stand where an earlier merge left it: its leftmost parts hold that merge's left side. The longest such way,
in bytes, is enough: a token that ends further from the end of what has been read never changes again. So a stretch of
any length is encoded in windows of a fixed size: tokens before the last ``lookahead`` bytes leave, the rest waits.

Text is cut where the pattern of the tokenizer always cuts (a space before a word), and pieces met before are kept in a
table of bounded size. Decoding looks up each id's bytes and turns them into text by an incremental UTF-8 decoder, fed
in blocks; a character may span several tokens, invalid bytes become U+FFFD.

Nulls and empty texts have no ids and decode to the empty text; null lists decode likewise. Ids unknown to the vocabulary
raise. Rows that repeat give the same ids. Columns beside id and text are not touched.
"""

from __future__ import annotations

import codecs
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import holds

# White space of Unicode, the pattern that splits text before merging, and the bits of an id in a pair.
WHITE = r"\t-\r \x85\xa0  -     　"
SPLIT = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
_UNITS = re.compile(rf"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
_ODD_SPACE = re.compile(rf" [{WHITE}]|[{WHITE}] |\A[{WHITE}]|[{WHITE}]\Z")
_WHITE = re.compile(rf"[{WHITE}]")
_ID_BITS = 20
_NEVER = 1 << 60
KEPT_UNITS = 1 << 17


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if printable, else one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # fixed value: bytes that stand for themselves
    spare = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(spare)) for b in range(256)]


def lookahead(merges: list[tuple[int, int, int]], sizes: dict[int, int]) -> int:
    """Bytes after which a token is settled. ``merges``: left, right and result in order; ``sizes``: bytes of an id."""
    left_of = {result: left for left, _, result in merges}
    furthest: dict[int, int] = {}
    most = 0
    for left, right, _ in merges:
        reach, part = 0, right
        while part is not None:
            reach = max(reach, furthest.get(part, 0))
            part = left_of.get(part)
        reach += sizes[left]
        furthest[left] = max(furthest.get(left, 0), reach)
        most = max(most, reach)
    return most


class Bpe:
    """Vocabulary and merges of a byte-level ``tokenizer.json``."""

    def __init__(self, path: str):
        spec = json.loads(Path(path).read_text(encoding="utf-8"))
        vocab, alphabet = spec["model"]["vocab"], byte_alphabet()
        to_byte = {c: b for b, c in enumerate(alphabet)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: bytes(to_byte[c] for c in t) for t, i in vocab.items()} | {i: t.encode() for t, i in self.special.items()}
        self.of_byte = [vocab[c] for c in alphabet]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
        self.rank = {a << _ID_BITS | b: k for k, (a, b, _) in enumerate(merges)}
        self.result = [c for _, _, c in merges]
        self.lookahead = lookahead(merges, {i: len(t) for i, t in self.bytes_of.items()})
        self._parts = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._parts_kept: dict[str, bytes] = {}

    def merge(self, data: bytes) -> list[int]:
        """Ids of a stretch that the pattern doesn't cut, held whole."""
        of_byte, get, result = self.of_byte, self.rank.get, self.result
        ids = [of_byte[b] for b in data]
        ranks = [get(a << _ID_BITS | b, _NEVER) for a, b in pairwise(ids)]
        while ranks:
            least = min(ranks)
            if least == _NEVER:
                break
            i = ranks.index(least)
            ids[i] = own = result[least]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get(ids[i - 1] << _ID_BITS | own, _NEVER)
            if i < len(ranks):
                ranks[i] = get(own << _ID_BITS | ids[i + 1], _NEVER)
        return ids

    def stream(self, blocks: Iterator[bytes]) -> Iterator[int]:
        """Ids of one stretch that comes in blocks: each leaves once it is settled, at most a window waits."""
        window, waiting = 2 * self.lookahead + 256, b""
        for block in blocks:
            for k in range(0, len(block), window):
                waiting += block[k : k + window]
                if len(waiting) < window:
                    continue
                settled, end = len(waiting) - self.lookahead, 0
                for i in self.merge(waiting):
                    if end + len(self.bytes_of[i]) > settled:
                        break
                    end += len(self.bytes_of[i])
                    yield i
                waiting = waiting[end:]
        yield from self.merge(waiting)

    def _ids(self, unit: str) -> bytes:
        """Ids of text between two cuts, as 32-bit numbers."""
        return b"".join([self._parts_kept.get(p) or self._part(p) for p in SPLIT.findall(unit)])

    def _part(self, part: str) -> bytes:
        """Ids of a stretch that the pattern doesn't cut, kept for when it comes again."""
        data = part.encode()
        found = array("i", self.merge(data) if len(data) <= 2 * self.lookahead + 256 else self.stream(iter((data,)))).tobytes()
        if len(part) <= 64:
            if len(self._parts_kept) >= KEPT_UNITS:
                self._parts_kept = {}
            self._parts_kept[part] = found
        return found

    def _unit(self, key: str) -> bytes:
        """Ids of a unit, kept for when it comes again. A key that doesn't begin with white space stands after a space."""
        found = self._old.get(key) or self._ids(key if _WHITE.match(key) else " " + key)
        if len(key) <= 64:
            if len(self._young) >= KEPT_UNITS:
                self._old, self._young = self._young, {}
            self._young[key] = found
        return found

    def encode(self, text: str) -> bytes:
        """Ids of a text as 32-bit numbers. Strings of special tokens become their ids."""
        if any(s in text for s in self.special):
            return b"".join(array("i", [self.special[p]]).tobytes() if p in self.special else self.encode(p) for p in self._parts.split(text) if p)
        get, unit = self._young.get, self._unit
        if _ODD_SPACE.search(text):
            first, *rest = _UNITS.findall(text)
            if _WHITE.match(first):
                rest.insert(0, first)
                first = ""
        else:
            first, *rest = text.split(" ")
        return self._ids(first) + b"".join([get(u) or unit(u) for u in rest])

    @property
    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids, one after another, and where each id's begin."""
        most = max(self.bytes_of) + 1
        sizes = np.array([len(self.bytes_of.get(i, b"")) for i in range(most)])
        return np.frombuffer(b"".join(self.bytes_of.get(i, b"") for i in range(most)), np.uint8), np.concatenate(([0], np.cumsum(sizes)))


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    """One encoder for each worker and file."""
    return Bpe(path)


def text_of(blocks: Iterator[bytes]) -> str:
    """Text of bytes that come in blocks cut anywhere."""
    machine = codecs.getincrementaldecoder("utf-8")("replace")
    return "".join([machine.decode(b) for b in blocks] + [machine.decode(b"", True)])


def _lists(values: list[bytes]) -> pa.ListArray:
    ends = np.concatenate(([0], np.cumsum([len(v) // 4 for v in values]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(values), "<i4")))


ROWS = 1024  # of a batch, so that what waits in a task stays small


def encode(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, ids`` of every document."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        holds(load.cache_clear)
        for b in batches:
            for k in range(0, b.num_rows, ROWS):
                part = b.slice(k, ROWS)
                ids = _lists([bpe.encode(t) if t else b"" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), ids], names=["doc_id", "ids"])

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")).mapInArrow(encoded, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, text`` from ``doc_id, ids``."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, begins = load(path).table
        holds(load.cache_clear)
        sizes = np.diff(begins)
        for b in batches:
            for k in range(0, b.num_rows, ROWS):
                part = b.slice(k, ROWS)
                lists = part.column(1)
                texts = []
                for row in range(part.num_rows):
                    ids = lists[row].values
                    ids = ids.to_numpy(zero_copy_only=False) if ids is not None else np.zeros(0, np.int64)
                    if len(ids) and (ids.min() < 0 or ids.max() >= len(sizes)):
                        raise ValueError(f"document {part.column(0)[row]} has ids outside the vocabulary")
                    texts.append(text_of(_blocks(ids, table, begins, sizes)))
                yield pa.RecordBatch.from_arrays([part.column(0), lists, pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decoded, "doc_id long, ids array<int>, text string")


def _blocks(ids: np.ndarray, table: np.ndarray, begins: np.ndarray, sizes: np.ndarray, most: int = 1 << 14) -> Iterator[bytes]:
    for k in range(0, len(ids), most):
        some = ids[k : k + most]
        n = sizes[some]
        ends = np.cumsum(n)
        yield table[np.repeat(begins[some] - ends + n, n) + np.arange(ends[-1])].tobytes()


def digests(decoded: DataFrame, *more: F.Column) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of ``doc_id, ids, text``, and ``more`` of its columns."""
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
        *more,
    )
