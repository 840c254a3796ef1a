"""WARC archives with dictionary-compressed records.

A task writes one archive: a leading skippable frame with a Zstandard dictionary built from the
task's first records, then every record as a frame of its own. Archives lie in the shared
folder under names no other attempt uses, and only those that finished tasks report are read
back, so a lost executor leaves nothing half-written behind in the result.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlode.sources import materialize, shared_path

LEAST = 1000  # payloads of fewer bytes are always written out
LEVEL = 3
#: Fixed values of the formats.
SKIPPABLE = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SAMPLE = 2 << 20  # bytes of records a dictionary is built from
_DICTIONARY = 64 << 10
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _urn(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}') if page_id is not None else uuid.uuid4()}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One WARC record; a revisit has HTTP headers but no payload."""
    revisit = refers_to is not None
    block = _HTTP + b"Content-Length: %d\r\n\r\n" % len(payload) + (b"" if revisit else payload)
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {' '.join(url.split())}")
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}", f"X-Refers-To-Page: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on the samples or, where they are too few for that, their last bytes as they are."""
    total = sum(map(len, samples))
    try:
        return zstandard.train_dictionary(min(_DICTIONARY, max(total // 10, 1024)), samples)
    except zstandard.ZstdError:
        raw = b"".join(samples)[-_DICTIONARY:]
        return zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class Writer:
    """Holds back the first records until there are enough of them for a dictionary."""

    def __init__(self, out: BinaryIO):
        self.out, self.waiting, self.size, self.count = out, [], 0, 0
        self.compressor: zstandard.ZstdCompressor | None = None

    def add(self, data: bytes) -> None:
        self.count += 1
        if self.compressor:
            self.out.write(self.compressor.compress(data))
            return
        self.waiting.append(data)
        self.size += len(data)
        if self.size >= _SAMPLE:
            self.start()

    def start(self) -> None:
        found = dictionary(self.waiting)
        raw = found.as_bytes()
        self.out.write(struct.pack("<II", SKIPPABLE, len(raw)) + raw)
        self.compressor = zstandard.ZstdCompressor(LEVEL, dict_data=found, write_checksum=True)
        for data in self.waiting:
            self.out.write(self.compressor.compress(data))
        self.waiting = []

    def close(self) -> None:
        if self.waiting:
            self.start()


def _dictionary_of(raw: bytes) -> zstandard.ZstdCompressionDict:
    full = raw[:4] == b"\x37\xa4\x30\xec"  # the magic number of trained dictionaries
    kind = zstandard.DICT_TYPE_FULLDICT if full else zstandard.DICT_TYPE_RAWCONTENT
    return zstandard.ZstdCompressionDict(raw, dict_type=kind)


def read_archive(source: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record."""
    magic, size = struct.unpack("<II", source.read(8))
    if magic != SKIPPABLE:
        raise ValueError("no dictionary frame")
    unpacked = zstandard.ZstdDecompressor(dict_data=_dictionary_of(source.read(size)))
    with unpacked.stream_reader(source, read_across_frames=True, closefd=False) as raw:
        lines = io.BufferedReader(raw, 1 << 16)
        while line := lines.readline():
            if line.strip() != b"WARC/1.1":
                raise ValueError("a record must start here")
            head = {}
            while (line := lines.readline()).strip():
                name, _, value = line.decode().partition(":")
                head[name.strip().lower()] = value.strip()
            block = lines.read(int(head["content-length"]))
            lines.read(4)
            yield head, block


def _row(head: dict[str, str], block: bytes) -> tuple:
    digest = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex()
    size, kind = int(head["x-payload-length"]), head["warc-type"]
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if hashlib.sha1(payload).hexdigest() != digest or len(payload) != size:
            raise ValueError(f"record of page {head.get('x-page-id')} is damaged")
    page, other = head.get("x-page-id"), head.get("x-refers-to-page")
    return (int(page) if page else None, size, digest, kind, int(other) if other else None)


def planned(pages: DataFrame, least: int = LEAST, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, payload, refers_to: revisits name the page that holds their payload.

    Of equal payloads of ``least`` bytes or more the largest id holds it. The groups' largest
    ids are found by a partial aggregation and joined back, so a payload that a third of the
    pages have is split like any skewed key.
    """
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload")
    ).withColumn("digest", F.sha1("payload"))
    known = (
        rows.where(F.octet_length("payload") >= least)
        .groupBy(F.col("digest").alias("_digest"))
        .agg(F.max("page_id").alias("holder"), F.count("*").alias("n"))
        .where("n > 1 and holder is not null")
        .drop("n")
    )
    known = materialize(known, "payload-holders")
    other = F.when(~F.col("page_id").eqNullSafe(F.col("holder")), F.col("holder"))
    return rows.join(known, F.col("digest") == F.col("_digest"), "left").select(
        "page_id", "url", "payload", other.alias("refers_to")
    )


def write_archives(plan: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """file, records, bytes of the archives written below ``folder``, one per non-empty task."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = writer = None
        for batch in batches:
            if batch.num_rows and writer is None:
                disk, path = fs.FileSystem.from_uri(folder)
                disk.create_dir(path, recursive=True)
                name = f"{uuid.uuid4().hex}.warc.zst"
                out = disk.open_output_stream(f"{path}/{name}")
                writer = Writer(out)
            for i in range(batch.num_rows):
                page, url, payload, other = (batch.column(c)[i].as_py() for c in ("page_id", "url", "payload", "refers_to"))
                writer.add(record(page, url, payload, other, date))
        if writer is not None:
            writer.close()
            size = out.tell()
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "records": [writer.count], "bytes": [size]})

    return plan.mapInArrow(write, "file string, records long, bytes long")


def read_archives(files: DataFrame, folder: str) -> DataFrame:
    """The records of the listed archives, digests checked; the columns of ``RECORDS``."""
    names = [field.split()[0] for field in RECORDS.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        for batch in batches:
            for name in batch.column("file").to_pylist():
                disk, path = fs.FileSystem.from_uri(folder)
                with disk.open_input_stream(f"{path}/{name}") as source:
                    rows: list[tuple] = []
                    for head, block in read_archive(source):
                        rows.append(_row(head, block))
                        if len(rows) == 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    return files.select("file").mapInArrow(read, RECORDS)


def archive(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Write all pages to archives in the shared folder and read the archives back.

    One row per row of ``pages``. Null html is an empty payload; null ids are written without
    an id and never hold a payload for others; rows that repeat the largest id of a group are
    all responses. A very long page is one record like any other, compressed and read as a whole.
    An empty table writes nothing. Other columns are not read.
    """
    spark = pages.sparkSession
    folder = shared_path(spark, "warc")
    files = materialize(write_archives(planned(pages, least), folder), "warc-files")
    return read_archives(files.repartition(max(files.count(), 1), "file"), folder)
