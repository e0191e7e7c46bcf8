"""WARC archives: writing pages with revisits, and reading archives in byte ranges.

Writing: one gzip member per record. Of records with equal payloads of at least `min_bytes`, those of the
smallest page id are responses, the others revisits that refer to it and carry no payload. A task writes
a file under a name of its own and returns it; the list of files is a table, so that files of lost or
repeated attempts are in no list and never read.

Reading: a file's byte ranges are shared out among tasks. A task looks for the gzip magic in its range,
and takes a place for the start of a record if what it unpacks begins with a WARC version and a header
block that ends, however long. It owns the records that start in its range and reads the last one beyond it. Places
inside a member that look like a start are passed over, since a member once read tells where the next
begins; one that a range begins with would have to unpack to a WARC header.

Files are opened by Arrow's file systems (local, S3, GCS, HDFS), named by their URI.

Defined results: a missing html is an empty payload; a missing url has no target; a missing page id writes
a record without id, which is a response unless it shares a payload with a page that has one; rows that
repeat an id and a payload are responses both, under one record id, as either serves a revisit; other columns are ignored; an empty table gives no archive.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.runtime import cut_lineage, scratch_dir

MAGIC = b"\x1f\x8b\x08"
SPLIT_BYTES = 32 << 20
READ_BYTES = 1 << 20
FILE_BYTES = 256 << 20
URN = "urn:page:"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def header_block(first: str, fields: list[tuple[str, str | None]]) -> bytes:
    lines = [first] + [f"{name}: {value}" for name, value in fields if value is not None]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def record_id(page_id: int, payload_digest: str) -> str:
    """Id of the response that holds a page's payload, known to the revisits of other pages too."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{URN}{page_id}:{payload_digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """The bytes of one record, not yet packed."""
    http = header_block("HTTP/1.1 200 OK", [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))])
    revisit, sha1 = refers_to is not None, digest(payload)
    named = page_id is not None and not revisit
    block = http if revisit else http + payload
    head = header_block(
        "WARC/1.1",
        [
            ("WARC-Type", "revisit" if revisit else "response"),
            ("WARC-Record-ID", record_id(page_id, sha1) if named else f"<urn:uuid:{uuid.uuid4()}>"),
            ("WARC-Date", date),
            ("WARC-Target-URI", None if url is None else quote(url, safe="!#$%&'()*+,/:;=?@[]~")),
            ("WARC-Page-ID", None if page_id is None else str(page_id)),
            ("WARC-Payload-Digest", f"sha1:{sha1}"),
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None),
            ("WARC-Refers-To", record_id(refers_to, sha1) if revisit else None),
            ("WARC-Refers-To-Page-ID", str(refers_to) if revisit else None),
            ("Content-Type", "application/http; msgtype=response"),
            ("Content-Length", str(len(block))),
        ],
    )
    return head + block + b"\r\n\r\n"


def packed(data: bytes) -> bytes:
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def with_referred(pages: DataFrame, min_bytes: int) -> DataFrame:
    """page_id, url, payload and refers_to."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        F.coalesce("html", F.lit("")).cast("binary").alias("payload"),
    ).withColumn("same", F.sha2("payload", 256))
    long_enough = F.octet_length("payload") >= min_bytes
    # aggregated from the ids alone, then written: the join's sides are plain tables, so that a payload
    # which a third of the pages share can be split
    first = cut_lineage(rows.where(long_enough).groupBy("same").agg(F.min("page_id").alias("first_id")))
    refers = F.when(long_enough & ~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    return rows.join(first, "same", "left").select("page_id", "url", "payload", refers.alias("refers_to"))


def write_archives(
    pages: DataFrame, folder: str, date: datetime, min_bytes: int = 0, file_bytes: int = FILE_BYTES
) -> DataFrame:
    """Write pages (page_id, url, html) below folder; (path, records) of the files that count.

    A file is closed and a new one begun when it has grown to `file_bytes`.
    """
    stamp = date.strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = opened(folder)
        system.create_dir(root, recursive=True)
        out, name, size, n = None, "", 0, 0

        def done() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "records": [n]})

        for batch in batches:
            for i in range(batch.num_rows):
                page_id, url, payload, refers_to = (batch.column(j)[i].as_py() for j in range(4))
                if out is None:
                    name, size, n = f"pages-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(f"{root}/{name}", compression=None)
                data = packed(record(page_id, url, payload, refers_to, stamp))
                out.write(data)
                size, n = size + len(data), n + 1
                if size >= file_bytes:
                    yield done()
                    out = None
        if out is not None:
            yield done()

    return cut_lineage(with_referred(pages, min_bytes).mapInArrow(write, "path string, records long"))


class Source:
    """A file read forward in pieces from any place."""

    def __init__(self, path: str):
        system, name = opened(path)
        self.file = system.open_input_file(name)
        self.size = self.file.size()

    def at(self, place: int, n: int = READ_BYTES) -> bytes:
        self.file.seek(place)
        return self.file.read(n)


def unpack(source: Source, place: int) -> tuple[bytes, int] | None:
    """The member at a place and where it ends, or None if there is no whole WARC record."""
    unzip, out, at = zlib.decompressobj(31), bytearray(), place
    while True:
        data = source.at(at)
        if not data:
            return None
        try:
            out += unzip.decompress(data)
        except zlib.error:
            return None
        if len(out) >= 5 and not out.startswith(b"WARC/"):
            return None
        at += len(data)
        if unzip.eof:
            return (bytes(out), at - len(unzip.unused_data)) if out.startswith(b"WARC/") and b"\r\n\r\n" in out else None


def records_in(source: Source, begin: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(place, record) of the records that start in [begin, end)."""
    place = begin
    while place < end:
        data = source.at(place, min(READ_BYTES, end - place) + len(MAGIC) - 1)
        found = data.find(MAGIC)
        if found < 0:
            if len(data) < len(MAGIC):
                return
            place += len(data) - len(MAGIC) + 1
            continue
        place += found
        if place >= end:
            return
        member = unpack(source, place)
        if member is None:
            place += 1
        else:
            yield place, member[0]
            place = member[1]


_FIELD = re.compile(rb"^([^:\r\n]+):[ \t]*(.*?)[ \t]*\r?$", re.M)


def fields_of(block: bytes) -> dict[str, str]:
    return {k.decode().lower(): v.decode() for k, v in _FIELD.findall(block)}


def parse(data: bytes) -> dict:
    """The fields of a record; the payload of a response is measured, of a revisit its headers tell."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = fields_of(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(fields_of(http).get("content-length", len(payload)))
    revisit = fields["warc-type"] == "revisit"
    page, refers = fields.get("warc-page-id"), fields.get("warc-refers-to-page-id")
    return {
        "record_type": fields["warc-type"],
        "page_id": None if page is None else int(page),
        "url": fields.get("warc-target-uri"),
        "payload_bytes": length if revisit else len(payload),
        "payload_digest": fields["warc-payload-digest"].removeprefix("sha1:") if revisit else digest(payload),
        "refers_to": None if refers is None else int(refers),
        "payload": None if revisit else payload,
    }


COLUMNS = {
    "path": "string",
    "offset": "long",
    "record_type": "string",
    "page_id": "long",
    "url": "string",
    "payload_bytes": "long",
    "payload_digest": "string",
    "refers_to": "long",
    "payload": "binary",
}


def read_archives(
    files: DataFrame, with_payload: bool = True, split_bytes: int = SPLIT_BYTES, batch_bytes: int = 8 << 20
) -> DataFrame:
    """The records of the files (column path): where they start, their fields and, if wanted, payloads."""
    spark = files.sparkSession

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_pydict({"path": paths, "size": [Source(p).size for p in paths]})

    begins = F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(split_bytes).cast("long")))
    sized = files.select("path").mapInArrow(lengths, "path string, size long").where("size > 0")
    ranges = cut_lineage(sized.select("path", begins.alias("begin")))
    tasks = max(1, min(ranges.count(), 10 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    columns = {k: v for k, v in COLUMNS.items() if with_payload or k != "payload"}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(rows: list[dict]) -> pa.RecordBatch:
            kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
            return pa.RecordBatch.from_pydict(
                {k: pa.array([r[k] for r in rows], kinds[v]) for k, v in columns.items()}
            )

        for batch in batches:
            for path, begin in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                source, rows, held = Source(path), [], 0
                for offset, data in records_in(source, begin, min(begin + split_bytes, source.size)):
                    rows.append(parse(data) | {"path": path, "offset": offset})
                    held += len(data)
                    if held > batch_bytes:
                        yield table(rows)
                        rows, held = [], 0
                yield table(rows)

    dealt = ranges.repartition(tasks, "path", "begin")
    return dealt.mapInArrow(read, ", ".join(f"{k} {v}" for k, v in columns.items()))


def all_read(records: DataFrame, files: DataFrame) -> DataFrame:
    """The records, after a check that each file (path, records) gave as many as were written to it."""
    records = cut_lineage(records)
    counts = records.groupBy("path").agg(F.count("*").alias("read"))
    both = files.join(counts, "path", "left").select("path", "records", F.coalesce("read", F.lit(0)).alias("read"))
    wrong = both.where("records <> read").take(5)
    if wrong:
        raise ValueError(f"records written and read differ: {[tuple(r) for r in wrong]}")
    return records


def round_trip(pages: DataFrame, date: datetime, min_bytes: int = 0) -> DataFrame:
    """Write the pages to a new shared folder and read the records back, without payloads."""
    spark: SparkSession = pages.sparkSession
    files = write_archives(pages, scratch_dir(spark, "warc"), date, min_bytes)
    return all_read(read_archives(files, with_payload=False), files)
