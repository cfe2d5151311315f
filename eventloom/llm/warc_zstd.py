"""WARC archives in Zstandard: one frame per record, the dictionary in a leading skippable frame.

Each task writes archives of its own and hands back one row per archive; that manifest is a table which Spark
commits once, so archives of attempts that were lost are never read. The reader takes the manifest, opens each
archive as a stream, loads the dictionary from the first frame, decodes frame by frame and checks each record:
frame size and checksum, version line, the headers it needs, block length, block and payload digests, and the end
of the record. Files are opened through the file system that the folder's address names.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs as filesystems
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import shuffle_partitions, table, whole
from eventloom.session import materialize, work_dir

# Fixed values of the formats.
DICTIONARY_FRAME, SKIPPABLE, FRAME_MAGIC = 0x184D2A5D, 0x184D2A50, b"\x28\xb5\x2f\xfd"
VERSION, END = b"WARC/1.1", b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2026-01-01T00:00:00Z"
#: Payloads below this many bytes are never written as revisits.
LEAST_REVISIT = 1000
ARCHIVE_BYTES, DICTIONARY_BYTES, DICTIONARY_RECORDS, LEVEL, READ = 1 << 26, 1 << 14, 256, 3, 1 << 20


def _open(address: str) -> tuple[filesystems.FileSystem, str]:
    if address.startswith("file:"):
        return filesystems.LocalFileSystem(), "/" + address[5:].lstrip("/")
    if "://" in address:
        return filesystems.FileSystem.from_uri(address)
    return filesystems.LocalFileSystem(), address


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page(name: str) -> int | None:
    number = name.removeprefix("<urn:page:").removesuffix(">")
    return None if number == "none" else int(number)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record. A revisit keeps the HTTP headers, which tell the payload's length, and leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _name(page_id)), ("WARC-Date", DATE),
        ("WARC-Target-URI", quote(url or "", safe="/:?#[]@!$&'()*+,;=%~-._")), ("WARC-Payload-Digest", _sha1(payload)), ("WARC-Block-Digest", _sha1(block)),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block))),
    ]
    if revisit:
        headers[2:2] = [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _name(refers_to))]
    return b"\r\n".join([VERSION, *[f"{k}: {v}".encode() for k, v in headers], b"", block]) + END


def _headers(lines: list[bytes], where: str) -> dict[str, str]:
    found = {}
    for line in lines:
        key, colon, value = line.decode().partition(":")
        if not colon:
            raise ValueError(f"{where}: header without a colon: {line[:80]!r}")
        found[key.strip().lower()] = value.strip()
    return found


def parse(data: bytes, where: str) -> dict:
    """The record's fields, or ValueError where it breaks a rule."""
    head, cut, rest = data.partition(END)
    lines = head.split(b"\r\n")
    if not cut or lines[0] != VERSION:
        raise ValueError(f"{where}: no WARC record")
    headers = _headers(lines[1:], where)
    for key in ("warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest", "warc-block-digest"):
        if key not in headers:
            raise ValueError(f"{where}: {key} is missing")
    length = int(headers["content-length"])
    block = rest[:length]
    if len(block) != length or rest[length:] != END:
        raise ValueError(f"{where}: the block has not {length} bytes")
    if _sha1(block) != headers["warc-block-digest"]:
        raise ValueError(f"{where}: block digest")
    http, cut, payload = block.partition(END)
    if not cut:
        raise ValueError(f"{where}: no HTTP headers")
    told = int(_headers(http.split(b"\r\n")[1:], where)["content-length"])
    revisit = headers["warc-type"] == "revisit"
    if revisit and (payload or "warc-refers-to" not in headers or headers.get("warc-profile") != REVISIT_PROFILE):
        raise ValueError(f"{where}: revisit with a payload or without its headers")
    if not revisit and (len(payload) != told or _sha1(payload) != headers["warc-payload-digest"]):
        raise ValueError(f"{where}: payload length or digest")
    return {
        "page_id": _page(headers["warc-record-id"]), "url": headers.get("warc-target-uri", ""), "record_type": headers["warc-type"], "payload_bytes": told,
        "payload_digest": base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:")).hex(),
        "refers_to": _page(headers["warc-refers-to"]) if revisit else None, "payload": None if revisit else payload,
    }


def make_dictionary(samples: list[bytes]) -> bytes | None:
    """A trained dictionary, the samples themselves where they are too few to train on, or none without any."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES] or None


class Writer:
    """One archive."""

    def __init__(self, folder: str, dictionary: bytes | None):
        files, path = _open(f"{folder}/{uuid.uuid4().hex}.warc.zst")
        files.create_dir(path.rpartition("/")[0], recursive=True)
        self.path, self.records, self.bytes = f"{folder}/{path.rpartition('/')[2]}", 0, 0
        self.sink = files.open_output_stream(path, compression=None)
        data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.packer = zstandard.ZstdCompressor(LEVEL, dict_data=data, write_checksum=True, write_content_size=True)
        if dictionary:
            body = zstandard.ZstdCompressor(LEVEL).compress(dictionary)
            self._put(struct.pack("<II", DICTIONARY_FRAME, len(body)) + body)

    def _put(self, data: bytes) -> None:
        self.sink.write(data)
        self.bytes += len(data)

    def add(self, data: bytes) -> None:
        self._put(self.packer.compress(data))
        self.records += 1


def _frames(source: BinaryIO, where: str) -> Iterator[tuple[int, bytes]]:
    """Offset and content of each data frame; the dictionary frame, if there is one, must come first."""
    held, at, dictionary = b"", 0, None

    def fill(size: int) -> bytes:
        nonlocal held
        while len(held) < size and (more := source.read(READ)):
            held += more
        return held[:size]

    while magic := fill(4):
        number = int.from_bytes(magic, "little")
        if number & 0xFFFFFFF0 == SKIPPABLE:
            size = int.from_bytes(fill(8)[4:], "little")
            body = fill(8 + size)[8:]
            if len(body) != size:
                raise ValueError(f"{where}: skippable frame cut off")
            if number == DICTIONARY_FRAME:
                if at:
                    raise ValueError(f"{where}: dictionary frame at {at}")
                plain = zstandard.ZstdDecompressor().decompress(body) if body[:4] == FRAME_MAGIC else body
                dictionary = zstandard.ZstdCompressionDict(plain)
            held, at = held[8 + size :], at + 8 + size
            continue
        if magic != FRAME_MAGIC:
            raise ValueError(f"{where}: no frame at {at}")
        told = zstandard.get_frame_parameters(fill(18)).content_size
        frame, parts, start = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj(), [], at
        while not frame.eof:
            if not fill(1):
                raise ValueError(f"{where}: frame at {start} cut off")
            parts.append(frame.decompress(held))
            at, held = at + len(held) - len(frame.unused_data), frame.unused_data
        content = b"".join(parts)
        if len(content) != told:
            raise ValueError(f"{where}: frame at {start} has {len(content)} bytes, not {told}")
        yield start, content


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes page_id, url, html, refers_to, revisit as records and returns the committed manifest: path, records, bytes.

    A task's dictionary is trained on its first rows (256 at most); all else streams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, dictionary, known, closed = None, None, False, []
        for batch in batches:
            rows = batch.to_pydict()
            payloads = [(x or "").encode("utf-8", "surrogatepass") for x in rows["html"]]
            if not known and batch.num_rows:
                known, dictionary = True, make_dictionary([x for x in payloads[:DICTIONARY_RECORDS] if x])
            for page_id, url, payload, refers_to, revisit in zip(rows["page_id"], rows["url"], payloads, rows["refers_to"], rows["revisit"]):
                if archive is None:
                    archive = Writer(folder, dictionary)
                archive.add(record(page_id, url, payload, refers_to, revisit))
                if archive.bytes >= archive_bytes:
                    archive.sink.close()
                    closed.append(archive)
                    archive = None
        if archive:
            archive.sink.close()
            closed.append(archive)
        yield pa.RecordBatch.from_pydict({"path": [x.path for x in closed], "records": pa.array([x.records for x in closed], pa.int64()), "bytes": pa.array([x.bytes for x in closed], pa.int64())})

    return materialize(pages.select("page_id", "url", "html", "refers_to", "revisit").mapInArrow(run, "path string, records long, bytes long"))


RECORDS = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def read_archives(manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """All records of the archives in ``manifest`` (path, records); ``payload`` stays null unless asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
        for batch in batches:
            for path, told in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                files, place = _open(path)
                rows, held, seen = [], 0, 0
                with files.open_input_stream(place, compression=None) as source:
                    for at, content in _frames(source, path):
                        row = parse(content, f"{path} at {at}")
                        row["payload"] = row["payload"] if payloads else None
                        rows.append(row)
                        seen, held = seen + 1, held + len(row["payload"] or b"")
                        if len(rows) >= 2000 or held > 1 << 24:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                if seen != told:
                    raise ValueError(f"{path}: {seen} records, not {told}")
                yield pa.RecordBatch.from_pylist(rows, schema)

    count = min(max(1, manifest.count()), shuffle_partitions(manifest.sparkSession))
    return manifest.select("path", "records").repartition(count, "path").mapInArrow(run, RECORDS)


def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """page_id, url, html, refers_to, revisit: of equal payloads of at least ``least`` bytes, that of the largest id is the response.

    Only payloads that occur twice or more enter the join's small side."""
    html = whole(F.col(html_col))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), html.alias("html"), F.sha1(html.cast("binary")).alias("digest"), F.octet_length(html).alias("size"))
    twice = rows.filter(F.col("size") >= least).groupBy("digest", "size").agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("n")).filter("n > 1 AND kept IS NOT NULL")
    marked = rows.join(materialize(twice.drop("n")), ["digest", "size"], "left")
    revisit = F.col("kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept"))
    return marked.select("page_id", "url", "html", F.when(revisit, F.col("kept")).alias("refers_to"), revisit.alias("revisit"))


def archive_pages(pages: DataFrame, folder: str, **columns: str) -> DataFrame:
    """Archives all rows and returns the manifest. Null html is an empty payload, null url an empty address; rows with a
    null id are written as such. Repeated ids with equal payloads are all responses. Other columns are not written."""
    return write_archives(with_revisits(pages, **columns), folder)


def op5_warc_zstd(spark, sf_dir: str) -> DataFrame:
    manifest = archive_pages(table(spark, sf_dir, "pages"), work_dir(spark, "warc"))
    return read_archives(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN strlen(html) >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN strlen(html) >= 1000 AND page_id <> last THEN last END AS refers_to
FROM (SELECT page_id, html, max(page_id) OVER (PARTITION BY html) AS last FROM (SELECT page_id, coalesce(html, '') AS html FROM pages))
"""
