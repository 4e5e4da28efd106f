"""Web archives packed as ZIP files and read in place.

Each archive is a ZIP of two stored members: ``archive/data.warc.gz``, WARC records that are
gzip members of their own, and ``indexes/index.cdxj``, a line per record with its offset and
length in the first. The reader parses the end record, the ZIP64 records and the central
directory, finds where a stored member begins, and reads single records by their byte range;
nothing is extracted and no archive is read whole.

Files go through pyarrow's file systems, so a folder may be local, HDFS or an object store.
A task writes under names of its own and reports them; only reported archives are read, so
what a lost executor leaves behind is never seen.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import column, prepare, stored
from orderlake.session import new_scratch_dir

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
# An archive is closed after this many bytes of records.
ARCHIVE_BYTES = 32 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def file_system(uri: str):
    """The file system and path of a folder."""
    import pyarrow.fs

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return pyarrow.fs.FileSystem.from_uri(uri)


# ---- WARC ---------------------------------------------------------------------
def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(urn: str | None) -> int | None:
    tail = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return None if tail in ("", "none") else int(tail)


def warc_record(page_id, url, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """A response with its payload, or a revisit with the HTTP head alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        # A line break or control character would end the header.
        head.append("WARC-Target-URI: " + "".join(c if c > " " else f"%{ord(c):02X}" for c in url))
    if revisit:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "surrogatepass").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def parse_record(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    warc = headers(head)
    block = rest[: int(warc["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return warc, headers(http), payload


# ---- ZIP ----------------------------------------------------------------------
class Forward:
    """A stream that can only be written onwards, as stores' streams can."""

    def __init__(self, stream):
        self.stream = stream

    def write(self, data) -> int:
        self.stream.write(data)
        return len(data)

    def flush(self) -> None:
        self.stream.flush()


class Archive:
    """One archive being written: records first, their index after them."""

    def __init__(self, fs, path: str):
        self.path, self.size, self.lines = path, 0, []
        self.stream = fs.open_output_stream(path)
        self.zip = zipfile.ZipFile(Forward(self.stream), "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)

    def add(self, record: bytes, page_id: int | None) -> None:
        packed = gzip.compress(record, 6, mtime=0)
        self.member.write(packed)
        self.lines.append(json.dumps({"page_id": page_id, "offset": self.size, "length": len(packed)}))
        self.size += len(packed)

    def close(self) -> None:
        self.member.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "\n".join(self.lines).encode())
        self.zip.close()
        self.stream.close()


def read_at(file, offset: int, length: int) -> bytes:
    file.seek(offset)
    return file.read(length)


def end_of_directory(file, size: int) -> tuple[int, int, int]:
    """(entries, directory size, directory offset), from the ZIP64 records if there are any."""
    tail_at = max(0, size - 65_557)
    tail = read_at(file, tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("not a ZIP file")
    entries, length, offset = struct.unpack("<HII", tail[end + 10 : end + 20])
    if tail[end - 20 : end - 16] == b"PK\x06\x07" and end >= 20:
        (at,) = struct.unpack("<Q", tail[end - 12 : end - 4])
        record = read_at(file, at, 56)
        if record[:4] != b"PK\x06\x06":
            raise ValueError("broken ZIP64 end record")
        entries, length, offset = struct.unpack("<QQQ", record[32:56])
    return entries, length, offset


def members(file, size: int) -> dict[str, tuple[int, int, int]]:
    """(method, size, header offset) of each member by name, from the central directory."""
    entries, length, at = end_of_directory(file, size)
    raw, pos, out = read_at(file, at, length), 0, {}
    for _ in range(entries):
        if raw[pos : pos + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        (method,) = struct.unpack("<H", raw[pos + 10 : pos + 12])
        packed, full = struct.unpack("<II", raw[pos + 20 : pos + 28])
        names, extras, comments = struct.unpack("<HHH", raw[pos + 28 : pos + 34])
        (header,) = struct.unpack("<I", raw[pos + 42 : pos + 46])
        name = raw[pos + 46 : pos + 46 + names].decode("utf-8")
        extra = raw[pos + 46 + names : pos + 46 + names + extras]
        while len(extra) >= 4:
            kind, n = struct.unpack("<HH", extra[:4])
            if kind == 1:
                # 64-bit values stand here only for fields that are all ones, in this order.
                wide = list(struct.unpack(f"<{n // 8}Q", extra[4 : 4 + n // 8 * 8]))
                full = wide.pop(0) if full == 0xFFFFFFFF else full
                packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                header = wide.pop(0) if header == 0xFFFFFFFF else header
            extra = extra[4 + n :]
        out[name] = (method, packed, header)
        pos += 46 + names + extras + comments
    return out


def stored_member(file, found: dict[str, tuple[int, int, int]], name: str) -> tuple[int, int]:
    """Where a stored member's bytes are: offset in the archive, and size."""
    method, size, header = found[name]
    if method != zipfile.ZIP_STORED:
        raise ValueError(f"{name} is compressed: it has no byte ranges")
    local = read_at(file, header, 30)
    if local[:4] != b"PK\x03\x04":
        raise ValueError("broken local header")
    names, extras = struct.unpack("<HH", local[26:30])
    return header + 30 + names + extras, size


# ---- Spark --------------------------------------------------------------------
def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def write_archives(
    pages: DataFrame,
    folder: str,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_bytes: int = 0,
) -> DataFrame:
    """Write a record for each page; the archives' table (path, records), stored.

    Of pages with equal payloads of at least ``least_bytes`` bytes the one with the largest
    id is the response and the others revisit it; rows that share that id are all responses,
    and so are pages whose group has no id. A null html is an empty payload, a null id or
    URL is left out of the record's headers. No pages: no archives.
    """
    prepare(pages.sparkSession)
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).alias("url"),
        payload.alias("payload"),
        F.sha1(payload).alias("_sha1"),
    )
    # One row for each different payload; the side with the pages can be split where hot.
    responses = rows.groupBy("_sha1").agg(F.max("page_id").alias("response_id"))
    joined = rows.join(responses, "_sha1").select("page_id", "url", "payload", "response_id")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(folder)
        fs.create_dir(root, recursive=True)
        archive, count = None, 0

        def report() -> pa.RecordBatch:
            archive.close()
            return pa.RecordBatch.from_arrays(
                [pa.array([archive.path], pa.string()), pa.array([count], pa.int64())], ["path", "records"]
            )

        for batch in batches:
            for page, url, raw, response in zip(
                *(column(batch, c) for c in ("page_id", "url", "payload", "response_id"))
            ):
                if archive is None:
                    archive, count = Archive(fs, f"{root}/{uuid.uuid4().hex}.wacz"), 0
                again = len(raw) >= least_bytes and response is not None and page != response
                archive.add(warc_record(page, url, raw, base32_sha1(raw), response, again), page)
                count += 1
                if archive.size >= ARCHIVE_BYTES:
                    yield report()
                    archive = None
        if archive is not None:
            yield report()

    return stored(joined.mapInArrow(write, "path string, records long"), "archives")


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """(page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload) of every
    record; a revisit's payload is null, its length and digest are those it declares.

    Indexes are read first; the records' byte ranges are then dealt out evenly and read one
    by one. A response whose payload differs from its digest is an error.
    """

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = file_system(folder)
        for batch in batches:
            for path in column(batch, "path"):
                with fs.open_input_file(path) as file:
                    found = members(file, file.size())
                    base, _ = stored_member(file, found, DATA)
                    lines = read_at(file, *stored_member(file, found, INDEX)).decode().split("\n")
                spans = [json.loads(x) for x in lines]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([path] * len(spans), pa.string()),
                        pa.array([base + s["offset"] for s in spans], pa.int64()),
                        pa.array([s["length"] for s in spans], pa.int64()),
                    ],
                    ["path", "offset", "length"],
                )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = file_system(folder)
        name, file = None, None
        for batch in batches:
            rows = []
            for path, offset, length in zip(*(column(batch, c) for c in ("path", "offset", "length"))):
                if path != name:
                    if file is not None:
                        file.close()
                    name, file = path, fs.open_input_file(path)
                warc, http, payload = parse_record(gzip.decompress(read_at(file, offset, length)))
                revisit = warc["warc-type"] == "revisit"
                digest = warc["warc-payload-digest"].removeprefix("sha1:")
                if not revisit and base32_sha1(payload) != digest:
                    raise ValueError(f"a payload of {path} differs from its digest")
                rows.append(
                    (
                        page_of(warc["warc-record-id"]),
                        warc.get("warc-target-uri"),
                        warc["warc-type"],
                        page_of(warc.get("warc-refers-to")) if revisit else None,
                        int(http["content-length"]),
                        digest,
                        None if revisit else payload,
                    )
                )
            cols = list(zip(*rows)) or [()] * 7
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], RECORD_NAMES)
        if file is not None:
            file.close()

    spark = archives.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = archives.select("path").mapInArrow(locate, "path string, offset long, length long")
    return ranges.repartition(partitions).sortWithinPartitions("path", "offset").mapInArrow(read, RECORDS)


RECORD_NAMES = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
RECORDS = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
    "payload_digest string, payload binary"
)


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write all pages to archives in the shared scratch folder and read them back."""
    folder = new_scratch_dir(pages.sparkSession, "wacz")
    return read_archives(write_archives(pages, folder, **options), folder)
