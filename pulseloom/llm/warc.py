"""WARC archives in Zstandard: one frame per record, the dictionary in a leading skippable frame.

Writing: of records with equal payloads the one with the largest ``page_id`` is a response, the
others revisit it and hold headers only. Every task writes an archive of its own, with a
dictionary trained on its first records, under a name that no other attempt has. The manifest
it returns lists the archives that count, so a task that ran twice or died leaves none behind.

Reading: archives are streamed, whatever their size. The dictionary is loaded from the skippable
frame (plain or compressed), each frame must hold one record, and headers, lengths and payload
digests are checked. What fails is named in ``problem``; a broken frame ends its archive.

Archives lie in a folder that all tasks reach: a mounted path, or a store that Arrow opens
(``s3a`` and ``s3n`` are read as ``s3``). An unknown scheme raises.

Defined results
---------------
* A NULL payload is an empty one, and empty payloads are equal payloads like any others.
* A NULL ``page_id`` is smaller than all others. Rows that repeat the largest id of their payload
  are all responses.
* A NULL or odd ``url`` is written percent-encoded, NULL as an empty one.
* An empty table makes no archive, or archives without records.
"""

from __future__ import annotations

import base64
import hashlib
import os
import struct
from collections.abc import Iterator
from contextlib import contextmanager
from typing import IO
from urllib.parse import quote, urlsplit

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseloom.session import materialise

# Fixed values of the two formats.
SKIPPABLE_MAGIC = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
NEEDED = ["warc-type", "warc-record-id", "warc-date", "content-length"]
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_URN = "urn:page:"

#: The dictionary is trained on as many bytes of the first records at most.
SAMPLE_BYTES, DICTIONARY_BYTES = 256 * 1024, 16 * 1024
DATE = "2000-01-01T00:00:00Z"
_CHUNK = 1 << 20


@contextmanager
def _opened(path: str, mode: str) -> Iterator[IO[bytes]]:
    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        place = parts.path if parts.scheme else path
        if "w" in mode:
            os.makedirs(os.path.dirname(place), exist_ok=True)
        with open(place, mode) as file:
            yield file
        return
    from pyarrow import fs

    scheme = "s3" if parts.scheme in ("s3a", "s3n") else parts.scheme
    store, inner = fs.FileSystem.from_uri(path.replace(parts.scheme, scheme, 1))
    if "w" in mode:
        store.create_dir(inner.rpartition("/")[0])
    with store.open_input_stream(inner) if "r" in mode else store.open_output_stream(inner) as file:
        yield file


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, is_revisit: bool) -> bytes:
    """One response, or one revisit that holds the HTTP headers only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if is_revisit else head + payload
    lines = [
        ("WARC-Type", "revisit" if is_revisit else "response"),
        ("WARC-Record-ID", f"<{PAGE_URN}{'' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", quote(url or "", safe=":/?#[]@!$&'()*+,;=%")),
        ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if is_revisit:
        lines[4:4] = [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{PAGE_URN}{refers_to}>")]
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n" + block + b"\r\n\r\n"


def _trained(samples: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples)
    except zstandard.ZstdError:  # too few records to learn from
        return None


def write_records(file: IO[bytes], records: Iterator[bytes]) -> tuple[int, int]:
    """Write one archive; gives its records and bytes."""
    first: list[bytes] = []
    held = 0
    for one in records:
        first.append(one)
        held += len(one)
        if held >= SAMPLE_BYTES:
            break
    learnt = _trained(first)
    written = 0
    if learnt is not None:
        data = learnt.as_bytes()
        written += file.write(struct.pack("<II", SKIPPABLE_MAGIC, len(data)) + data)
    packer = zstandard.ZstdCompressor(level=3, dict_data=learnt, write_checksum=True, write_content_size=True)
    count = 0

    def every() -> Iterator[bytes]:
        yield from first
        first.clear()
        yield from records

    for one in every():
        written += file.write(packer.compress(one))
        count += 1
    return count, written


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write pages (page_id, url, html) as archives in ``folder``; the manifest: file, records, bytes."""
    source = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    newest = source.groupBy("digest").agg(F.max("page_id").alias("newest"))
    roles = source.join(newest, "digest").select(
        "page_id", "url", "payload", "newest", (~F.col("page_id").eqNullSafe(F.col("newest"))).alias("is_revisit")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        path = f"{folder}/part-{task.partitionId():05d}-{task.taskAttemptId()}.warc.zst"

        def records() -> Iterator[bytes]:
            for batch in batches:
                for row in batch.to_pylist():
                    yield record(row["page_id"], row["url"], row["payload"], row["newest"], row["is_revisit"])

        with _opened(path, "wb") as file:
            count, written = write_records(file, records())
        columns = [pa.array([path]), pa.array([count], pa.int64()), pa.array([written], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["file", "records", "bytes"])

    return materialise(roles.mapInArrow(write, "file string, records long, bytes long"), "manifest")


def frames(file: IO[bytes]) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of each frame of an archive; raises ValueError where it is broken."""
    data = file.read(_CHUNK)
    at, learnt = 0, None
    if len(data) >= 8 and struct.unpack("<I", data[:4])[0] == SKIPPABLE_MAGIC:
        size = struct.unpack("<I", data[4:8])[0]
        while len(data) < 8 + size and (more := file.read(_CHUNK)):
            data += more
        raw = data[8 : 8 + size]
        if len(raw) < size:
            raise ValueError("dictionary cut short")
        if raw[:4] == ZSTD_MAGIC:
            raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
        learnt = zstandard.ZstdCompressionDict(raw)
        data, at = data[8 + size :], 8 + size
    unpacker = zstandard.ZstdDecompressor(dict_data=learnt)
    while True:
        data = data or file.read(_CHUNK)
        if not data:
            return
        one, parts, start = unpacker.decompressobj(), [], at
        while True:
            try:
                parts.append(one.decompress(data))
            except zstandard.ZstdError as error:
                raise ValueError(f"frame at {start}: {error}") from error
            if one.eof:
                rest = one.unused_data
                at += len(data) - len(rest)
                data = rest
                break
            at += len(data)
            data = file.read(_CHUNK)
            if not data:
                raise ValueError(f"frame at {start} cut short")
        yield start, b"".join(parts)


def _headers(block: bytes) -> dict[str, str] | None:
    found = {}
    for line in block.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name or set(name) & set(b" \t"):
            return None
        found[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    return found


def parse(content: bytes) -> dict:
    """A record's fields; ``problem`` names the first check that fails."""
    out: dict = dict.fromkeys(("record_type", "record_id", "url", "refers_to", "payload_bytes", "payload_digest", "payload", "problem"))

    def failed(problem: str) -> dict:
        return out | {"problem": problem}

    head, gap, rest = content.partition(b"\r\n\r\n")
    if not head.startswith(VERSION + b"\r\n"):
        return failed("no version line")
    headers = _headers(head)
    if not gap or headers is None:
        return failed("broken headers")
    if missing := [n for n in NEEDED if n not in headers]:
        return failed(f"no {missing[0]}")
    out |= {"record_type": headers["warc-type"], "record_id": headers["warc-record-id"], "url": headers.get("warc-target-uri")}
    out["refers_to"] = headers.get("warc-refers-to")
    if not headers["content-length"].isdecimal():
        return failed("odd content-length")
    block, end = rest[: int(headers["content-length"])], rest[int(headers["content-length"]) :]
    if len(block) < int(headers["content-length"]):
        return failed("block cut short")
    if end != b"\r\n\r\n":
        return failed("not one record in its frame")
    http, gap, payload = block.partition(b"\r\n\r\n")
    sent = (_headers(http) or {}).get("content-length", "")
    if not gap or not sent.isdecimal():
        return failed("broken http headers")
    named = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    is_revisit = headers["warc-type"] == "revisit"
    out |= {"payload_bytes": int(sent), "payload_digest": named, "payload": None if is_revisit else payload}
    if is_revisit:
        return failed("revisit of nothing") if not out["refers_to"] else failed("revisit with a payload") if payload else out
    if len(payload) != int(sent):
        return failed("payload length differs")
    return out if payload_digest(payload) == named else failed("payload digest differs")


RECORD = (
    "file string, offset long, record_type string, record_id string, url string, refers_to string, "
    "payload_bytes long, payload_digest string, payload binary, problem string"
)


def read_archives(files: DataFrame, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives named in ``file``; see RECORD for the columns."""
    kinds = {"offset": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}
    names = [c.split()[0] for c in RECORD.split(", ")]

    def rows_of(path: str) -> Iterator[dict]:
        with _opened(path, "rb") as file:
            try:
                for offset, content in frames(file):
                    row = parse(content)
                    yield row | {"file": path, "offset": offset} | ({} if with_payload else {"payload": None})
            except ValueError as error:
                yield {"file": path, "problem": str(error)}

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], kinds.get(n, pa.string())) for n in names], names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("file").to_pylist():
                rows, held = [], 0
                for row in rows_of(path):
                    rows.append(row)
                    held += len(row.get("payload") or b"")
                    if len(rows) >= 1000 or held >= 1 << 24:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    # A number of tasks that is named is kept; otherwise the adaptive plan puts these short rows into one task.
    spark = files.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return files.select("file").repartition(tasks + tasks // 2, "file").mapInArrow(read, RECORD)


def page_of(column: str) -> Column:
    """The page_id in a record id."""
    text = F.regexp_extract(column, f"^<{PAGE_URN}(-?[0-9]+)>$", 1)
    return F.when(F.length(text) > 0, text.cast("long"))
