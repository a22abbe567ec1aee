"""Token ids in Parquet files: list columns, chosen encodings, row groups of a size asked for, and page indexes.

Documents are dealt to tasks by ranges of their id and sorted inside, each task writes files of consecutive documents,
and a small table of the files (in order, with their token totals) gives every file the number of ids before it by one
running sum. Names of files are new in each attempt and only attempts that ended are in the table, so a task that is
run again leaves no duplicate. Inside a file ``doc_id``, ``start`` and ``n_tokens`` are delta encoded and ids are
dictionary or delta encoded; statistics, page indexes and the row-group bounds let readers fetch a few documents, or
the metadata alone, without reading ids.

Null and empty texts have only the end id. Documents with equal ids stand together, ordered by their text; null ids come
first. An empty table gives no files and no rows. Columns beside id and text are not read. Ids are those of the
tokenizers library: its normaliser and pattern never join what a plain space parts, so it is asked once for each piece
between spaces, and its answers are kept in a table of bounded size. Texts are cut in chunks: Arrow names the distinct
pieces of a chunk, only these are looked up, and array arithmetic puts the texts' ids together.
"""

from __future__ import annotations

import os
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.bpe import byte_alphabet
from tributary.llm.common import Staged, as_bytes, batch, pieces
from tributary.session import staging_path

KEPT_STEMS = 1 << 17
FILE_TOKENS = 1 << 26
GROUP_TOKENS = 1 << 21
ROWS = 512
CHUNK_BYTES = 4 << 20  # of text that is cut at once, or one row
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"  # fixed value: ASCII's marks
_ALPHABET = byte_alphabet()
FILES = pa.schema([("part", pa.int32()), ("number", pa.int32()), ("path", pa.string()), ("first_id", pa.int64()), ("last_id", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])
ROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int32()), ("ids", pa.list_(pa.int32()))])


class Pieces:
    """Ids of the pieces between spaces and line ends, as the library gives them.

    A word with ASCII's marks behind it is asked for without them, and ASCII in lower case, as the library's
    normaliser and pattern would have it, so that fewer pieces are new.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.kept: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _asked(self, stems: list[str]) -> dict[str, bytes]:
        """Ids of stems. A word of Latin letters is its normal form in lower case and isn't cut, so the model gets it at once."""
        tokenize, found, others = self.tokenizer.model.tokenize, {}, []
        for stem in stems:
            if stem.isalpha() and (stem.isascii() or max(stem) < "\u0100"):
                word = stem.lower()
                found[stem] = array("i", [t.id for t in tokenize(word if word.isascii() else "".join([_ALPHABET[c] for c in word.encode()]))]).tobytes()
            else:
                others.append(stem)
        for stem, answer in zip(others, self.tokenizer.encode_batch_fast(others, add_special_tokens=False), strict=True):
            found[stem] = array("i", answer.ids).tobytes()
        return found

    def _ids(self, stems: list[str]) -> list[bytes]:
        """Ids of distinct stems."""
        if len(self.kept) > KEPT_STEMS:
            self.old, self.kept = self.kept, {}
        kept, old = self.kept, self.old
        new = [s for s in stems if s not in kept]
        kept.update((s, old[s]) for s in new if s in old)
        kept.update(self._asked([s for s in new if s not in old]))
        return [kept[s] for s in stems]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and how many each has."""
        cut = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        named = cut.flatten().dictionary_encode()
        stems = pa.concat_arrays(_stems_and_tails(named.dictionary)).dictionary_encode()
        ids = self._ids(_strings(stems.dictionary))
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        first = np.cumsum(size) - size
        both = stems.indices.to_numpy().reshape(2, -1).T[named.indices.to_numpy()].ravel()
        n = size[both]
        ends = np.cumsum(n)
        found = np.frombuffer(b"".join(ids), "<i4")[np.repeat(first[both] - (ends - n), n) + np.arange(ends[-1])]
        bounds = cut.offsets.to_numpy()
        return found, np.diff(np.concatenate(([0], ends))[2 * (bounds - bounds[0])])


def _strings(pieces_: pa.Array) -> list[str]:
    """Python's strings of pieces, which have no space: faster at once than one by one."""
    if not len(pieces_):
        return []
    whole = pa.LargeListArray.from_arrays(pa.array([0, len(pieces_)], pa.int64()), pieces_)
    return pc.binary_join(whole, pa.scalar(" ", pieces_.type))[0].as_py().split(" ")


def _stems_and_tails(whole: pa.Array) -> list[pa.Array]:
    """Words without ASCII's marks behind them, ASCII in lower case, and these marks. Other pieces are stems as they are."""
    stem = pc.utf8_rtrim(whole, characters=_MARKS)
    plain, is_word = pc.string_is_ascii(stem), pc.utf8_is_alpha(stem).to_numpy(zero_copy_only=False)
    others = np.flatnonzero(is_word & ~plain.to_numpy(zero_copy_only=False))  # letters that only a newer Unicode has are none to the library
    is_word[others] = [w.isalpha() for w in _strings(stem.take(pa.array(others)))]
    data, at = as_bytes(whole)
    size = np.where(is_word, np.diff(at) - pc.binary_length(stem).to_numpy(), 0)
    ends = np.cumsum(size)
    marks = data[np.repeat(at[1:] - ends, size) + np.arange(ends[-1])]
    tail = pa.LargeStringArray.from_buffers(len(whole), pa.py_buffer(np.concatenate(([0], ends))), pa.py_buffer(marks)).cast(whole.type)
    return [pc.if_else(pa.array(is_word), pc.if_else(plain, pc.ascii_lower(stem), stem), whole), tail]


@lru_cache(maxsize=2)
def pieces_of(path: str) -> Pieces:
    return Pieces(path)


class _Writer:
    """Files of one task, one after another."""

    def __init__(self, folder: str, encoding: str):
        self.store, self.folder = fs.FileSystem.from_uri(folder)
        self.store.create_dir(self.folder, recursive=True)
        self.scheme = folder[: len(folder) - len(self.folder)]
        packed = {c: "DELTA_BINARY_PACKED" for c in ("doc_id", "start", "n_tokens")}
        self.options = {
            "compression": "zstd", "write_page_index": True, "write_statistics": True, "data_page_size": 1 << 16,
            "use_dictionary": ["ids.list.element"] if encoding == "dictionary" else False,
            "column_encoding": packed if encoding == "dictionary" else packed | {"ids.list.element": "DELTA_BINARY_PACKED"},
        }
        self.files: list[tuple] = []
        self.part = TaskContext.get().partitionId()
        self.writer = None

    def write(self, ids: pa.Array, tokens: np.ndarray, sizes: np.ndarray) -> None:
        if self.writer is None:
            self.path = f"{self.folder}/{uuid.uuid4().hex}.parquet"
            self.writer = pq.ParquetWriter(self.path, ROW, filesystem=self.store, **self.options)
            self.first, self.total, self.docs, self.waiting, self.waits = ids[0].as_py(), 0, 0, [], 0
        starts = self.total + np.cumsum(sizes) - sizes
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(tokens, pa.int32()))
        self.waiting.append(batch(ROW, ids, starts, sizes.astype(np.int32), lists))
        self.total, self.docs, self.last = self.total + int(sizes.sum()), self.docs + len(ids), ids[-1].as_py()
        self.waits += int(sizes.sum())
        if self.waits >= GROUP_TOKENS:
            self._group()
        if self.total >= FILE_TOKENS:
            self.close()

    def _group(self) -> None:
        if self.waiting:
            table = pa.Table.from_batches(self.waiting)
            self.writer.write_table(table, row_group_size=table.num_rows)
        self.waiting, self.waits = [], 0

    def close(self) -> None:
        if self.writer is not None:
            self._group()
            self.writer.close()
            self.files.append((self.part, len(self.files), self.scheme + self.path, self.first, self.last, self.docs, self.total))
            self.writer = None


def write(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str, encoding: str = "dictionary") -> DataFrame:
    """Write the files; their table: ``part, number, path, first_id, last_id, n_docs, n_tokens, before``."""
    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer = pieces_of(tokenizer_path), _Writer(folder, encoding)
        for b in batches:
            for row, end, *_ in pieces(*as_bytes(b.column(1)), most=CHUNK_BYTES):
                tokens, sizes = encoder.encode(b.column(1).slice(row, end - row))
                writer.write(b.column(0).slice(row, end - row), np.insert(tokens, np.cumsum(sizes), end_id), sizes + 1)
        writer.close()
        yield pa.RecordBatch.from_pylist([dict(zip(FILES.names, f, strict=True)) for f in writer.files], schema=FILES)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = texts.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    files = Staged(ordered.mapInArrow(written, "part int, number int, path string, first_id long, last_id long, n_docs long, n_tokens long"), "token-files").df
    earlier = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    return files.withColumn("before", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)))


def new_folder(spark) -> str:
    return staging_path(spark, "tokens")


def read(files: DataFrame, columns: tuple[str, ...] = ("doc_id", "start", "n_tokens", "ids"), first_id: int | None = None, last_id: int | None = None) -> DataFrame:
    """Documents of the files, ``start`` counted from the first file on.

    Only the columns asked for are read, and only files and row groups whose ids meet ``first_id..last_id``.
    """
    if first_id is not None:
        files = files.where(F.col("last_id") >= first_id)
    if last_id is not None:
        files = files.where(F.col("first_id").isNull() | (F.col("first_id") <= last_id))  # null ids come first
    kinds = {"doc_id": "long", "start": "long", "n_tokens": "int", "ids": "array<int>"}
    filters = [(op, bound) for op, bound in ((">=", first_id), ("<=", last_id)) if bound is not None]

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, before in zip(b.column("path").to_pylist(), b.column("before").to_pylist(), strict=True):
                store, name = fs.FileSystem.from_uri(path)
                with store.open_input_file(name) as source:
                    file = pq.ParquetFile(source)
                    for group in range(file.num_row_groups):
                        bounds = file.metadata.row_group(group).column(0).statistics
                        if filters and bounds is not None and bounds.has_min_max and (first_id is not None and bounds.max < first_id or last_id is not None and bounds.min > last_id):
                            continue
                        for some in file.iter_batches(ROWS, row_groups=[group], columns=sorted({*columns, *(["doc_id"] if filters else [])})):
                            table = pa.Table.from_batches([some])
                            for op, bound in filters:
                                ids = table.column("doc_id").to_numpy(zero_copy_only=False)
                                table = table.filter(pa.array(ids >= bound if op == ">=" else ids <= bound))
                            if "start" in columns:
                                at = table.column_names.index("start")
                                table = table.set_column(at, "start", pa.array(table.column("start").to_numpy() + before))
                            yield from table.select(list(columns)).combine_chunks().to_batches()

    dealt = files.select("path", "before").repartition(max(1, files.count()), "path")
    return dealt.mapInArrow(opened, ", ".join(f"{c} {kinds[c]}" for c in columns))


def with_crc32(tokens: DataFrame) -> DataFrame:
    """``ids_crc32`` of each document's ids as little-endian 32-bit numbers, in place of the ids."""
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("ids")
            ends, values = lists.offsets.to_numpy(), lists.values.to_numpy().astype("<u4", copy=False)
            crc = [zlib.crc32(values[a:z].tobytes()) for a, z in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("start"), b.column("n_tokens"), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.select("doc_id", "start", F.col("n_tokens").cast("long").alias("n_tokens"), "ids").mapInArrow(summed, "doc_id long, start long, n_tokens long, ids_crc32 long")
