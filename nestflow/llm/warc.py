"""WARC archives in seekable Zstandard bundles.

Records are grouped into independent Zstandard frames, so that one record is
read by decompressing its frame alone.  After the data frames come a
skippable frame with the record index (record id, frame, offset in the
decompressed frame, length; compressed) and the seek table of the public
seekable format: compressed and decompressed size of every frame, the number
of frames, a descriptor and the magic number 0x8F92EAB1.  Any Zstandard
decoder reads a bundle as one stream of WARC records.

Of records with equal payloads of at least ``revisit_bytes`` bytes the one
with the largest page id is a ``response``, the others are ``revisit``
records that name it; smaller payloads are all responses.  Equality is that
of SHA-256 digests.

Null html is an empty payload; a null url leaves the target URI out; a null
page id has the record id ``null``, is never referred to and revisits a
group's response if there is one.  Repeated rows are records each: copies of
a group's winning row are responses.  Extra columns are not read.  An empty
table gives no bundle.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestflow.llm.binary_files import read_files, write_files
from nestflow.llm.common import batches, in_arrow

#: Fixed values of the seekable format.
TRAILER = struct.pack("<I", 0x8F92EAB1)
SEEK_TABLE, INDEX_FRAME = 0x184D2A5E, 0x184D2A50

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 16 << 20
REVISIT_BYTES = 1000
LEVEL = 6

#: Copies of the dealt key: a payload that a third of all pages share spreads over so many tasks.
SALT = 16

ID = "urn:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, payload_bytes: int,
           refers_to: int | None, date: str = DATE) -> bytes:
    """One WARC/1.1 record; ``payload`` is left out of a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    sha1 = base64.b32encode(bytes.fromhex(digest)).decode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <{ID}{'null' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        target = re.sub(r"[\x00-\x20\x7f<>]", lambda m: f"%{ord(m[0]):02X}", url)
        head.append(f"WARC-Target-URI: {target}")
    head.append(f"WARC-Payload-Digest: sha1:{sha1}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{ID}{refers_to}>"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Headers, HTTP head and payload of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *others = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(x.split(": ", 1) for x in others)
    block = rest[:int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return headers, http, payload


def _numbered(uri: str) -> int | None:
    name = uri.removeprefix(f"<{ID}").removesuffix(">")
    return None if name == "null" else int(name)


class BundleWriter:
    """Collects records; ``close`` gives the bundle without its trailing magic."""

    def __init__(self, frame_bytes: int = FRAME_BYTES, level: int = LEVEL) -> None:
        self.frame_bytes, self.coder = frame_bytes, zstandard.ZstdCompressor(level=level)
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.index: list[tuple[str, int, int, int]] = []
        self.open: list[bytes] = []
        self.filled = self.size = 0

    def add(self, name: str, data: bytes) -> None:
        if self.filled and self.filled + len(data) > self.frame_bytes:
            self._end_frame()
        self.index.append((name, len(self.frames), self.filled, len(data)))
        self.open.append(data)
        self.filled += len(data)

    def _end_frame(self) -> None:
        if self.open:
            frame = self.coder.compress(b"".join(self.open))
            self.frames.append(frame)
            self.sizes.append((len(frame), self.filled))
            self.size += len(frame)
            self.open, self.filled = [], 0

    def close(self) -> bytes:
        self._end_frame()
        names = "\n".join(x[0] for x in self.index).encode()
        numbers = np.array([x[1:] for x in self.index], dtype="<u4").reshape(-1, 3)
        body = self.coder.compress(struct.pack("<QQ", len(self.index), len(names)) + names + numbers.tobytes())
        index = struct.pack("<II", INDEX_FRAME, len(body)) + body
        sizes = [*self.sizes, (len(index), 0)]
        table = b"".join(struct.pack("<II", *x) for x in sizes) + struct.pack("<IB", len(sizes), 0)
        return b"".join([*self.frames, index, struct.pack("<II", SEEK_TABLE, len(table) + 4), table])


class Bundle:
    """Reads a bundle: all records, or one by its id."""

    def __init__(self, data: bytes) -> None:
        if data[-4:] != TRAILER:
            raise ValueError("not a seekable bundle, or a cut one")
        count, descriptor = struct.unpack("<IB", data[-9:-4])
        if descriptor:
            raise ValueError("seek tables with checksums are not written here")
        begin = len(data) - 9 - 8 * count
        sizes = np.frombuffer(data, "<u4", 2 * count, begin).reshape(-1, 2).astype(np.int64)
        ends = np.cumsum(sizes[:, 0])
        self.data, self.begins, self.ends = data, (ends - sizes[:, 0]).tolist(), ends.tolist()
        self.coder = zstandard.ZstdDecompressor()
        raw = self.coder.decompress(data[self.begins[-1] + 8:self.ends[-1]])
        records, length = struct.unpack_from("<QQ", raw)
        self.names = raw[16:16 + length].decode().split("\n") if records else []
        self.places = np.frombuffer(raw, "<u4", 3 * records, 16 + length).reshape(-1, 3).tolist()
        self._by_name: dict[str, int] | None = None

    def frame(self, k: int) -> bytes:
        return self.coder.decompress(self.data[self.begins[k]:self.ends[k]])

    def read(self, name: str) -> bytes:
        """The (first) record of that id; only its frame is decompressed."""
        if self._by_name is None:
            self._by_name = {n: k for k, n in reversed([*enumerate(self.names)])}
        frame, offset, length = self.places[self._by_name[name]]
        return self.frame(frame)[offset:offset + length]

    def records(self) -> Iterator[bytes]:
        current, data = -1, b""
        for frame, offset, length in self.places:
            if frame != current:
                current, data = frame, self.frame(frame)
            yield data[offset:offset + length]


def with_revisits(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, refers_to (null: a response)."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload")).withColumns({
        "payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha1("payload"),
        "same": F.unhex(F.sha2("payload", 256))})
    large = F.col("payload_bytes") >= revisit_bytes
    groups = (rows.where(large).groupBy("same").agg(F.max("page_id").alias("keep"), F.count(F.lit(1)).alias("n"))
              .where("n > 1 AND keep IS NOT NULL").select("same", "keep")
              .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))))
    salted = rows.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALT)).cast("int"))
    refers = F.when(large & ~F.col("page_id").eqNullSafe(F.col("keep")), F.col("keep"))
    return salted.join(groups, ["same", "salt"], "left").select(
        "page_id", "url", F.when(refers.isNull(), F.col("payload")).alias("payload"), "payload_bytes", "payload_digest",
        refers.alias("refers_to"))


def write_bundles(pages: DataFrame, path: str, revisit_bytes: int = REVISIT_BYTES, bundle_bytes: int = BUNDLE_BYTES,
                  frame_bytes: int = FRAME_BYTES) -> None:
    """Write a WARC record for every row of ``pages`` (page_id, url, html) to bundles at ``path``."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def bundles():
            writer = BundleWriter(frame_bytes)
            for batch in found:
                for at in range(0, batch.num_rows, 200):
                    for x in batch.slice(at, 200).to_pylist():
                        name = "null" if x["page_id"] is None else str(x["page_id"])
                        writer.add(name, record(x["page_id"], x["url"], x["payload"] or b"", x["payload_digest"],
                                                x["payload_bytes"], x["refers_to"]))
                        if writer.size >= bundle_bytes:
                            yield (writer.close(),)
                            writer = BundleWriter(frame_bytes)
            if writer.index:
                yield (writer.close(),)

        yield from batches(bundles(), pa.schema([("data", pa.binary())]), max_rows=1)

    write_files(in_arrow(with_revisits(pages, revisit_bytes), run, "data binary"), "data", TRAILER, path)


_READ = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                   ("record_type", pa.string()), ("refers_to", pa.int64())])


def read_bundles(spark: SparkSession, path: str) -> DataFrame:
    """Of every record at ``path``: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A response's digest and length are those of the payload read, and must
    agree with its headers; a revisit has those of the full payload in its own.
    """

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in found:
                for content in batch.column(0):
                    for data in Bundle(content.as_buffer().to_pybytes()).records():
                        headers, http, payload = parse(data)
                        digest = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
                        kind, refers = headers["WARC-Type"], headers.get("WARC-Refers-To")
                        if kind == "response" and (hashlib.sha1(payload).hexdigest(), len(payload)) != (digest, size):
                            raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
                        yield _numbered(headers["WARC-Record-ID"]), size, digest, kind, refers and _numbered(refers)

        yield from batches(rows(), _READ, max_rows=10_000)

    return in_arrow(read_files(spark, path).select("content"), run,
                    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
