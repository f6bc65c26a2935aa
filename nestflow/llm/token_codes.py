"""Directly addressable codes: token files with random access to any id.

An id is cut into chunks of ``CHUNK_BITS`` bits, lowest first.  Level 0
holds the first chunk of every id; level k holds the k-th chunk of the ids
that need it.  A continuation bitmap beside each level but the last says
which of its entries go on, and a rank directory (ones before every block of
512 bits) gives an entry's place in the next level.  So id ``i`` takes one
lookup a level; no block is decoded.

A file (little-endian)::

    magic, version u32, levels u32, documents u64, ids u64, part u64, number u64
    documents: doc_id i64 each, then "is null" u8 each, then first id u64 (documents + 1)
    each level: entries u64, chunks u8 each; but for the last level: bitmap
        u64 words (512-bit blocks), rank directory u64 each block
    trailing magic

``part`` and ``number`` order the files; the ids of one file are those of
consecutive documents in ascending doc_id order (null first, ties by text).

Null texts are empty; such a document is its end id alone.  Repeated rows
are kept, each as a document of its own.  An empty table gives no file.
Columns beside ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nestflow.llm.binary_files import read_files, write_files
from nestflow.llm.common import batches, in_arrow, partitions, saved, text_or_empty
from nestflow.llm.tokens import encoder

MAGIC, TRAILER = b"NFDAC001", b"\xacNFDAC\x0d\x0a"
CHUNK_BITS, BLOCK = 8, 512
HEADER = struct.Struct("<8sIIQQQQ")

#: Ids in a file, at which it is closed; a document is never cut.
FILE_IDS = 2_000_000


def encode_file(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, part: int, number: int) -> bytes:
    """The file's bytes without the trailing magic."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest >> CHUNK_BITS
        goes_on = more > 0
        levels.append(((rest & 0xFF).astype(np.uint8), goes_on))
        if not goes_on.any():
            break
        rest = more[goes_on]
    starts = np.concatenate([[0], np.cumsum(np.array(lengths, dtype=np.uint64))]).astype("<u8")
    out = [HEADER.pack(MAGIC, 1, len(levels), len(doc_ids), len(ids), part, number),
           np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes(),
           np.array([d is None for d in doc_ids], dtype=np.uint8).tobytes(), starts.tobytes()]
    for k, (chunks, goes_on) in enumerate(levels):
        out += [struct.pack("<Q", len(chunks)), chunks.tobytes()]
        if k < len(levels) - 1:
            padded = np.zeros(-(-len(chunks) // BLOCK) * BLOCK, dtype=bool)
            padded[:len(chunks)] = goes_on
            ones = padded.reshape(-1, BLOCK).sum(axis=1, dtype=np.uint64)
            out += [np.packbits(padded, bitorder="little").tobytes(),
                    (np.cumsum(ones) - ones).astype("<u8").tobytes()]
    return b"".join(out)


class TokenFile:
    """Random access into one file."""

    def __init__(self, data: bytes) -> None:
        if data[:8] != MAGIC or data[-len(TRAILER):] != TRAILER:
            raise ValueError("not a token file, or a cut one")
        _, version, levels, docs, self.n_ids, self.part, self.number = HEADER.unpack_from(data)
        if version != 1:
            raise ValueError(f"unknown version {version}")
        self._at, self._data = HEADER.size, data
        values, nulls = self._take("<i8", docs), self._take("u1", docs)
        self.doc_ids = [None if n else v for v, n in zip(values.tolist(), nulls.tolist())]
        self.starts = self._take("<u8", docs + 1).astype(np.int64)
        self.levels = []
        for k in range(levels):
            entries = int(self._take("<u8", 1)[0])
            chunks = self._take("u1", entries)
            if k < levels - 1:
                blocks = -(-entries // BLOCK)
                self.levels.append((chunks, self._take("<u8", blocks * (BLOCK // 64)), self._take("<u8", blocks)))
            else:
                self.levels.append((chunks, None, None))

    def _take(self, kind: str, count: int) -> np.ndarray:
        found = np.frombuffer(self._data, dtype=kind, count=count, offset=self._at)
        self._at += found.nbytes
        return found

    def get(self, index) -> np.ndarray:
        """The ids at ``index`` (an int or an array, any order)."""
        place = np.atleast_1d(np.asarray(index, dtype=np.int64))
        if len(place) and (place.min() < 0 or place.max() >= self.n_ids):
            raise IndexError("no such id")
        out, who = np.zeros(len(place), dtype=np.uint32), np.arange(len(place))
        for k, (chunks, words, ranks) in enumerate(self.levels):
            out[who] |= chunks[place].astype(np.uint32) << np.uint32(CHUNK_BITS * k)
            if words is None:
                break
            goes_on = (words[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1
            who, place = who[goes_on], _rank(words, ranks, place[goes_on])
        return out

    def between(self, start: int, stop: int) -> np.ndarray:
        """The ids from ``start`` up to ``stop``: one rank a level, for the first."""
        out, first, last = np.zeros(stop - start, dtype=np.uint32), start, stop
        who = None
        for k, (chunks, words, ranks) in enumerate(self.levels):
            part = chunks[first:last].astype(np.uint32) << np.uint32(CHUNK_BITS * k)
            if who is None:
                out |= part
            else:
                out[who] |= part
            if words is None or first == last:
                break
            byte = first >> 3
            bits = np.unpackbits(words.view(np.uint8)[byte:(last + 7) >> 3], bitorder="little")
            goes_on = np.flatnonzero(bits[first - 8 * byte:last - 8 * byte])
            who = goes_on if who is None else who[goes_on]
            first = int(_rank(words, ranks, np.array([first]))[0]) if len(goes_on) else 0
            last = first + len(goes_on)
        return out

    def document(self, k: int) -> np.ndarray:
        return self.between(int(self.starts[k]), int(self.starts[k + 1]))


def _rank(words: np.ndarray, ranks: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Ones before each place."""
    if not len(place):
        return place
    word = place >> 6
    per = BLOCK // 64
    block = word // per
    out = ranks[np.minimum(block, len(ranks) - 1)].astype(np.int64)
    beyond = block >= len(ranks)
    if beyond.any():  # one past the last entry of a full block
        out[beyond] += np.bitwise_count(words[-per:]).sum()
        block, word = np.where(beyond, 0, block), np.where(beyond, 0, word)
    for k in range(per):
        inner = block * per + k
        out += np.where(~beyond & (inner < word), np.bitwise_count(words[inner]), 0)
    low = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
    return out + np.where(beyond, 0, np.bitwise_count(words[word] & low))


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, file_ids: int = FILE_IDS) -> None:
    """Encode every text of ``docs`` (doc_id, text) and write token files to ``path``.

    Rows are dealt out by ranges of (doc_id, text hash, place in the scan),
    so equal doc_ids, also a third of all rows, spread over tasks.
    """
    spark = docs.sparkSession

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, coder, end = TaskContext.get().partitionId(), encoder(tokenizer), np.array([end_id], "<u4").tobytes()

        def files():
            ids, coded, size, number = [], [], 0, 0
            for batch in found:
                names, texts = batch.column(0).to_pylist(), batch.column(1)
                for name, own in zip(names, coder.encode_batches(texts)):
                    ids.append(name)
                    coded.append(own + end)
                    size += len(coded[-1]) // 4
                    if size >= file_ids:
                        yield (pack(ids, coded, number),)
                        ids, coded, size, number = [], [], 0, number + 1
            if ids:
                yield (pack(ids, coded, number),)

        def pack(ids, coded, number):
            return encode_file(ids, [len(c) // 4 for c in coded], np.frombuffer(b"".join(coded), "<u4"), part, number)

        yield from batches(files(), pa.schema([("data", pa.binary())]), max_rows=1)

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text")).select(
        "doc_id", "text", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("place"))
    dealt = keyed.repartitionByRange(partitions(spark), "doc_id", "h", "place").sortWithinPartitions("doc_id", "h", "place")
    write_files(in_arrow(dealt.select("doc_id", "text"), run, "data binary"), "data", TRAILER, path)


_READ = pa.schema([("part", pa.int64()), ("number", pa.int64()), ("place", pa.int64()), ("doc_id", pa.int64()),
                   ("first", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Of every document in the files at ``path``: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it.  Only one row a
    file (its ids' number) is put in order in one task.
    """

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in found:
                for content in batch.column(0):
                    file = TokenFile(content.as_buffer().to_pybytes())
                    ids = file.between(0, file.n_ids).astype("<u4", copy=False).data
                    starts = file.starts.tolist()
                    for k, doc_id in enumerate(file.doc_ids):
                        first, stop = starts[k], starts[k + 1]
                        yield file.part, file.number, k, doc_id, first, stop - first, zlib.crc32(ids[first:stop])

        yield from batches(rows(), _READ, max_rows=10_000)

    files = read_files(spark, path).select("content")
    rows = saved(in_arrow(files, run, "part long, number long, place long, doc_id long, first long, n_tokens long, ids_crc32 long"),
                 "token-documents")
    totals = rows.groupBy("part", "number").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    begins = totals.select("part", "number", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    return rows.join(begins, ["part", "number"]).select(
        "doc_id", (F.col("begin") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")
