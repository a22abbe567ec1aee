"""WARC archives: written with one gzip member per record, read back one record after another.

Of pages with equal payloads, the one with the smallest id is written as a response and the others as revisits that
refer to it; a revisit has the head of the response, which names the payload's length, but no body. Which page comes first
is settled on digests and ids alone, before any payload moves. Each task writes files of its pages; names are new in every
attempt and only attempts that ended are listed, so a task that is run again leaves nothing that is read twice.

The reader gets a stream and holds one block of it and one record: it inflates member by member, reads the header up to
its blank line, then exactly Content-Length bytes, checks that the record ends in two line ends with its member, and
compares the digests of block and payload. What doesn't fit raises ``WarcError`` with file and offset.

A null payload is an empty one, a null url an empty URI. Pages with the same id and payload are all responses or all
revisits. A null id sorts before the others and is written as an empty name. Pages without any row give no file. Columns beside
id, url and html are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import Staged

FILE_BYTES = 1 << 28  # of payload, before a new file is begun
BLOCK = 1 << 16
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the format
FILES = pa.schema([("part", pa.int32()), ("path", pa.string()), ("n_records", pa.int64())])
RECORDS = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("offset", pa.int64()), ("payload", pa.binary())])


class WarcError(ValueError):
    pass


class Record(NamedTuple):
    offset: int
    headers: dict[str, str]
    block: bytes


def digest(data: bytes) -> str:
    """Bare upper-case base32 of SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def name_of(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def id_of(name: str | None) -> int | None:
    if name is None or not name.startswith("<urn:page:"):
        return None
    number = name[len("<urn:page:") : -1]
    return int(number) if number else None


def record(page_id: int | None, url: str | None, payload: bytes, is_revisit: bool, refers_to: int | None) -> bytes:
    """A record as one gzip member."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if not is_revisit:
        block += payload
    address = " ".join((url or "").split())
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if is_revisit else 'response'}", f"WARC-Record-ID: {name_of(page_id)}", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {address}", f"WARC-Payload-Digest: sha1:{digest(payload)}", f"WARC-Block-Digest: sha1:{digest(block)}",
        "Content-Type: application/http; msgtype=response", *([f"WARC-Refers-To: {name_of(refers_to)}", f"WARC-Profile: {PROFILE}"] if is_revisit else []),
        f"Content-Length: {len(block)}", "", "",
    ]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode()) + packer.compress(block + b"\r\n\r\n") + packer.flush()


class _Member:
    """The inflated bytes of one gzip member, as they are asked for."""

    def __init__(self, source: BinaryIO, rest: bytes):
        self.source, self.rest, self.have = source, rest, bytearray()
        self.inflater = zlib.decompressobj(31)
        self.packed = 0

    def more(self) -> bool:
        if self.inflater.eof:
            return False
        data = self.inflater.unconsumed_tail or self.rest or self.source.read(BLOCK)
        if data is self.rest:
            self.rest = b""
        if not data:
            raise WarcError("the file ends inside a record")
        before = len(data)
        self.have += self.inflater.decompress(data, BLOCK)
        self.packed += before - len(self.inflater.unconsumed_tail) - len(self.inflater.unused_data)
        if self.inflater.eof:
            self.rest = self.inflater.unused_data + self.rest
        return True

    def take(self, n: int) -> bytes:
        while len(self.have) < n and self.more():
            pass
        if len(self.have) < n:
            raise WarcError("the record is shorter than its length says")
        out = bytes(self.have[:n])
        del self.have[:n]
        return out

    def until(self, mark: bytes) -> bytes:
        seen = 0
        while (at := self.have.find(mark, seen)) < 0:
            seen = max(0, len(self.have) - len(mark) + 1)
            if not self.more():
                raise WarcError("the header has no end")
        return self.take(at + len(mark))[:-len(mark)]


def records(source: BinaryIO) -> Iterator[Record]:
    """Records of a stream, in order."""
    rest, offset = b"", 0
    while rest or (rest := source.read(BLOCK)):
        member = _Member(source, rest)
        try:
            version, *lines = member.until(b"\r\n\r\n").decode("utf-8").split("\r\n")
            if not version.startswith("WARC/"):
                raise WarcError("no record begins here")
            headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
            block = member.take(int(headers["content-length"]))
            if member.take(4) != b"\r\n\r\n":
                raise WarcError("the record is longer than its length says")
            while member.more():
                pass
            if member.have:
                raise WarcError("a member holds more than one record")
            wanted = headers.get("warc-block-digest")
            if wanted is not None and wanted != f"sha1:{digest(block)}":
                raise WarcError("the block doesn't have its digest")
        except (WarcError, KeyError, ValueError, zlib.error) as wrong:
            raise WarcError(f"at {offset}: {wrong}") from wrong
        yield Record(offset, headers, block)
        offset += member.packed
        rest = member.rest


def payload_of(found: Record) -> tuple[bytes | None, int]:
    """Payload (none of a revisit) and its full length; a response's payload must have its digest."""
    head, _, body = found.block.partition(b"\r\n\r\n")
    length = next((int(line.split(b":")[1]) for line in head.split(b"\r\n") if line.lower().startswith(b"content-length:")), len(body))
    if found.headers.get("warc-type") == "revisit":
        return None, length
    if length != len(body) or found.headers.get("warc-payload-digest", "") not in ("", f"sha1:{digest(body)}"):
        raise WarcError(f"at {found.offset}: the payload doesn't have its length or digest")
    return body, length


def with_first(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, first_id, alone``: the smallest id among pages of equal payload, where there are several."""
    texts = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    keyed = texts.select("page_id", F.sha1(F.col("html").cast("binary")).alias("payload_key"), F.octet_length("html").alias("size"))
    found = Staged(
        keyed.groupBy("payload_key", "size").agg(F.min(F.struct(F.col("page_id").isNotNull(), "page_id"))["page_id"].alias("first_id"), F.count("*").alias("n")).where("n > 1").select("payload_key", "size", "first_id"), "payloads"
    ).df
    hashed = texts.withColumn("payload_key", F.sha1(F.col("html").cast("binary"))).withColumn("size", F.octet_length("html"))
    return hashed.join(found.withColumn("shared", F.lit(True)).hint("merge"), ["payload_key", "size"], "left").select("page_id", "url", "html", "first_id", F.coalesce("shared", F.lit(False)).alias("shared"))


def write(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the archives; ``part, path, n_records`` of each file."""

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = fs.FileSystem.from_uri(folder)
        store.create_dir(place, recursive=True)
        scheme = folder[: len(folder) - len(place)]
        files, out, size, count, part = [], None, 0, 0, TaskContext.get().partitionId()
        for b in batches:
            for page_id, url, html, first_id, shared in zip(*(b.column(k) for k in range(5)), strict=True):
                if out is None:
                    path = f"{place}/{uuid.uuid4().hex}.warc.gz"
                    out, size, count = store.open_output_stream(path, compression=None), 0, 0
                own, first = page_id.as_py(), first_id.as_py()
                payload = html.as_py().encode()
                is_revisit = shared.as_py() and own != first
                out.write(record(own, url.as_py(), payload, is_revisit, first))
                size, count = size + len(payload), count + 1
                if size >= file_bytes:
                    out.close()
                    files.append({"part": part, "path": scheme + path, "n_records": count})
                    out = None
        if out is not None:
            out.close()
            files.append({"part": part, "path": scheme + path, "n_records": count})
        yield pa.RecordBatch.from_pylist(files, schema=FILES)

    return Staged(with_first(pages).mapInArrow(written, "part int, path string, n_records long"), "warc-files").df


def read(files: DataFrame, payloads: bool = True) -> DataFrame:
    """Records of the archives, with ``payload`` (none of revisits) if asked for. A file is one task's, read in order."""

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, n_records in zip(b.column("path").to_pylist(), b.column("n_records").to_pylist(), strict=True):
                store, name = fs.FileSystem.from_uri(path)
                rows, held, seen = [], 0, 0
                with store.open_input_stream(name, compression=None) as source:
                    try:
                        for found in records(source):
                            payload, length = payload_of(found)
                            h = found.headers
                            rows.append({
                                "page_id": id_of(h.get("warc-record-id")), "record_type": h.get("warc-type"), "refers_to": id_of(h.get("warc-refers-to")), "url": h.get("warc-target-uri"),
                                "payload_bytes": length, "payload_digest": h.get("warc-payload-digest", "").removeprefix("sha1:"), "offset": found.offset, "payload": payload if payloads else None,
                            })
                            held, seen = held + len(found.block), seen + 1
                            if held > 1 << 22:
                                yield pa.RecordBatch.from_pylist(rows, schema=RECORDS)
                                rows, held = [], 0
                    except WarcError as wrong:
                        raise WarcError(f"{path}: {wrong}") from wrong
                if seen != n_records:
                    raise WarcError(f"{path}: {seen} records, {n_records} were written")
                yield pa.RecordBatch.from_pylist(rows, schema=RECORDS)

    kinds = "page_id long, record_type string, refers_to long, url string, payload_bytes long, payload_digest string, offset long, payload binary"
    return files.select("path", "n_records").repartition(max(1, files.count()), "path").mapInArrow(opened, kinds)
