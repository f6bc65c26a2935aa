"""Lexical retrieval packing.

Documents become token ids; the ids are the terms of a BM25 inverted index.
Term statistics (documents with a term, mean length) are counted over the
whole corpus; there are at most as many as the tokenizer's vocabulary, which
bounds what the driver gathers and sends.  Documents are dealt out by topic,
so likely neighbours share a shard of the index: ``SHARD_TOKENS`` ids of one
task, as many as its memory holds (about 60 bytes an id).  A topic is the
nearest of ``TOPICS`` centroids of the documents' BM25 vectors, projected to
``DIMS`` numbers; the centroids come from a bounded sample, topics like each
other follow each other.  Inside a topic ``SKETCHES`` lexical sketches give
the order.  A sketch is one of the document's terms, drawn by a hash with the
square of its inverse document frequency as weight, so two documents have it
alike as often as their rare terms overlap; a term of one document only is
never drawn.  What all sketches leave alike is in random order.

A shard's first unused document is the seed of a window.  The shard's index
returns its unused documents by descending BM25 score for the seed's terms (ties
in shard order; documents that share no term come last), which fill the
window greedily; the last one is cut and its rest seeds the next window.  An
unfinished window goes on in the task's next shard.  What is left at a task's
end is cut into powers of two, so no sequence needs padding.

Every id lies in one piece.  A null or empty text is its end id alone.
Repeated rows are packed each; an empty table gives no rows.  Columns beside
doc_id and text are not read.
"""

from __future__ import annotations

from bisect import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestflow.llm.common import batches, in_arrow, partitions, saved
from nestflow.llm.tokens import encoder, forget_encoders

LENGTH = 2048
SHARD_TOKENS = 4_000_000
SKETCHES = 4
#: The sample that the topics come from decides which documents share a shard and nothing else.
TOPICS, DIMS, SAMPLE_DOCS = 128, 128, 2048

#: Terms of one in ``DENSE`` documents of a shard are kept as rows; neighbours that are put in order at once.
DENSE, BEST = 8, 128
#: Sampled sketches for each task, which the tasks' bounds come from.
BOUND_ROWS = 100
#: Documents' distinct terms that are counted at once.
_TERMS_AT_ONCE = 1_000_000

#: BM25's usual parameters.
K1, B = 1.2, 0.75

_CODED = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("size", pa.int64()), ("ids", pa.binary())])
_CODED_SQL = "kind int, doc_id long, size long, ids binary"
_PIECE = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
                    ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])
_PIECE_SQL = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"

def encode_documents(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Of every document (kind 0) its ids; of every task (kind 1) the documents with each term."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        size = max(coder.vocabulary, end_id + 1)
        # Two bytes an id where the vocabulary allows it; the reader is told by ``size``.
        kind, end = _width(size), np.array([end_id], "<u4").tobytes()
        often = np.zeros(size, dtype=np.int64)
        total = 0

        def rows():
            nonlocal often, total
            terms, many = [], 0
            for batch in found:
                names, texts = batch.column(0).to_pylist(), batch.column(1)
                for name, own in zip(names, coder.encode_batches(texts)):
                    ids = np.frombuffer(own + end, "<u4").astype(kind)
                    terms.append(_counted(ids)[0])
                    many += len(terms[-1])
                    if many > _TERMS_AT_ONCE:
                        often += np.bincount(np.concatenate(terms), minlength=size)
                        terms, many = [], 0
                    total += len(ids)
                    yield 0, name, 0, ids.tobytes()
            if many:
                often += np.bincount(np.concatenate(terms), minlength=size)
            if total:
                yield 1, total, size, often.astype("<i8").tobytes()

        yield from batches(rows(), _CODED)

    return saved(in_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, _CODED_SQL), "coded-documents")


def _width(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


def corpus_statistics(coded: DataFrame) -> tuple[np.ndarray, int, int]:
    """Documents with each term, number of documents, number of ids; summed by Spark.

    The driver gets one row a term of the vocabulary at most.
    """

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("term", pa.int64()), ("n", pa.int64())])
        sums: np.ndarray | None = None
        for batch in found:
            for ids in batch.column(0):
                own = np.frombuffer(ids.as_buffer(), "<i8")
                sums = own.copy() if sums is None else sums + own
        if sums is not None:
            terms = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.int64()), pa.array(sums[terms], pa.int64())], schema=schema)

    sizes = coded.where("kind = 1").agg(F.max("size"), F.sum("doc_id")).first()
    often = np.zeros(sizes[0] or 1, dtype=np.int64)
    for row in in_arrow(coded.where("kind = 1").select("ids"), run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        often[row["term"]] = row["n"]
    return often, coded.where("kind = 0").count(), int(sizes[1] or 0)


def sketch_ranks(often: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Of every sketch each term's rank; a document's sketch is the smallest rank of its terms."""
    weights = np.where(often > 1, idf.astype(np.float64) ** 2, 0)
    ranks = np.empty((SKETCHES, len(often)), dtype=np.int32)
    for k in range(SKETCHES):
        drawn = np.random.default_rng(100 + k).exponential(size=len(often))
        ranks[k, np.argsort(np.divide(drawn, weights, out=np.full(len(often), np.inf), where=weights > 0), kind="stable")] = np.arange(len(often))
    return ranks


class Topics:
    """Centroids of the BM25 vectors (projected at random) of a sample, in the order of their first component."""

    def __init__(self, sample: list[np.ndarray], idf: np.ndarray, mean_length: float) -> None:
        random = np.random.default_rng(7)
        self.idf, self.mean_length = idf, mean_length
        self.plane = random.standard_normal((len(idf), DIMS), dtype=np.float32)
        self.middle = np.zeros(DIMS, dtype=np.float32)
        vectors = self.vectors(sample)
        self.middle = vectors.mean(axis=0)
        vectors = _unit(vectors - self.middle)
        centroids = vectors[random.permutation(len(vectors))[:TOPICS]]
        for _ in range(8):
            nearest = (vectors @ centroids.T).argmax(axis=1)
            centroids = _unit(np.stack([vectors[nearest == k].sum(axis=0) if (nearest == k).any() else c for k, c in enumerate(centroids)]))
        first = np.linalg.svd(centroids, full_matrices=False)[2][0]
        self.centroids = centroids[np.argsort(centroids @ first, kind="stable")]

    def vectors(self, docs: list[np.ndarray], found: list[tuple] | None = None) -> np.ndarray:
        out = np.zeros((len(docs), DIMS), dtype=np.float32)
        for k, (ids, (terms, counts)) in enumerate(zip(docs, found or distinct(docs))):
            weights = self.idf[terms] * counts * (K1 + 1) / (counts + K1 * (1 - B + B * len(ids) / self.mean_length))
            out[k] = weights.astype(np.float32) @ self.plane[terms]
        return _unit(out) - self.middle

    def of(self, docs: list[np.ndarray], found: list[tuple] | None = None) -> np.ndarray:
        return (self.vectors(docs, found) @ self.centroids.T).argmax(axis=1)


def distinct(docs: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each document its distinct terms and their counts."""
    return [_counted(ids) for ids in docs]


def _counted(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``np.unique`` with counts; ids of two bytes are sorted by radix."""
    ids = np.sort(ids, kind="stable")
    new = np.ones(len(ids) + 1, dtype=bool)
    np.not_equal(ids[1:], ids[:-1], out=new[1:-1])
    bounds = new.nonzero()[0] if len(ids) else np.zeros(1, dtype=np.int64)
    return ids[bounds[:-1]], bounds[1:] - bounds[:-1]


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, length, out=np.zeros_like(rows), where=length > 1e-9)


class Shard:
    """BM25 inverted index of some documents."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean_length: float) -> None:
        lengths = np.array([len(d) for d in docs], dtype=np.int64)
        owner = np.repeat(np.arange(len(docs), dtype=np.int64), lengths)
        # Postings by term, then document: (term, document) pairs and their counts.
        pairs, counts = np.unique(np.concatenate(docs).astype(np.int64) * len(docs) + owner, return_counts=True)
        terms, self.doc = pairs // len(docs), pairs % len(docs)
        self.size = len(docs)
        norm = K1 * (1 - B + B * lengths[self.doc] / mean_length)
        self.weight = idf[terms] * counts * (K1 + 1) / (counts + norm)
        self.terms, first, number, many = np.unique(terms, return_index=True, return_inverse=True, return_counts=True)
        self.first = np.append(first, len(terms))
        # Terms of an eighth of the documents or more have a row of all documents' weights: 32 bytes a posting at most.
        often = DENSE * many >= len(docs)
        self.row = np.where(often, np.cumsum(often) - 1, -1)
        self.rows = np.zeros((int(often.sum()), len(docs)), dtype=np.float32)
        own = often[number]
        self.rows[self.row[number[own]], self.doc[own]] = self.weight[own]
        self.of_doc = np.split(terms[np.argsort(self.doc, kind="stable")], np.cumsum(np.bincount(self.doc, minlength=len(docs)))[:-1])

    def without(self, used: np.ndarray) -> None:
        """The index of the unused documents alone; their order, weights and so scores stay."""
        free = np.flatnonzero(~used)
        own = ~used[self.doc]
        left = np.concatenate([[0], np.cumsum(own)])[self.first]
        self.doc, self.weight = (np.cumsum(~used) - 1)[self.doc[own]], self.weight[own]
        self.rows, self.of_doc, self.size = np.ascontiguousarray(self.rows[:, free]), [self.of_doc[k] for k in free.tolist()], len(free)
        self.first = left

    def neighbours(self, terms: np.ndarray, used: np.ndarray, most: int | None = None) -> np.ndarray:
        """Unused documents by descending score for the query's distinct terms; of that order ``most`` at least, if given."""
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        at = at[self.terms[at] == terms]
        scores = self.rows[self.row[at][self.row[at] >= 0]].sum(axis=0)
        rare = at[self.row[at] < 0]
        if len(rare):
            ranges = list(zip(self.first[rare].tolist(), self.first[rare + 1].tolist()))
            scores = scores + np.bincount(np.concatenate([self.doc[a:b] for a, b in ranges]), np.concatenate([self.weight[a:b] for a, b in ranges]),
                                          minlength=self.size)
        free = np.flatnonzero(~used)
        scores = scores[free]
        if most is not None and len(free) > 2 * most:
            best = np.flatnonzero(scores >= np.partition(scores, len(free) - most)[len(free) - most])
            free, scores = free[best], scores[best]
        return free[np.argsort(-scores, kind="stable")]


def pack(rows: Iterator[tuple[int | None, np.ndarray]], idf: np.ndarray, mean_length: float, first_sequence: int = 0,
         length: int = LENGTH, shard_tokens: int = SHARD_TOKENS) -> Iterator[tuple]:
    """Pieces (doc_id, start, length, doc_tokens, sequence_id, offset, ids) of one task's documents."""
    sequence, window, filled = first_sequence, [], 0
    query: np.ndarray | None = None

    def pieces(window: list, sequence: int) -> Iterator[tuple]:
        offset = 0
        for name, ids, a, b in window:
            yield name, a, b - a, len(ids), sequence, offset, ids[a:b].astype("<u4").tobytes()
            offset += b - a

    for shard in _shards(rows, shard_tokens):
        index = Shard([ids for _, ids in shard], idf, mean_length)
        used = np.zeros(len(shard), dtype=bool)
        seed = 0
        while True:
            if len(shard) > 64 and 3 * np.count_nonzero(used) > len(shard):
                shard = [shard[k] for k in np.flatnonzero(~used).tolist()]
                if not shard:
                    break
                index.without(used)
                used, seed = np.zeros(len(shard), dtype=bool), 0
            if query is not None:
                # If they do not fill the window, the next ones are asked for.
                order = index.neighbours(query, used, BEST)
            else:
                while seed < len(shard) and used[seed]:
                    seed += 1
                order = np.array([seed] if seed < len(shard) else [], dtype=np.int64)
            if not len(order):
                break
            for k in order.tolist():
                used[k] = True
                name, ids = shard[k]
                at = 0
                while at < len(ids):
                    take = min(length - filled, len(ids) - at)
                    window.append((name, ids, at, at + take))
                    at += take
                    filled += take
                    if filled == length:
                        yield from pieces(window, sequence)
                        sequence, window, filled = sequence + 1, [], 0
                if query is None or len(window) <= 1:
                    # A new window: the document that opens it is its query.
                    query = index.of_doc[k] if window else None
                    break
    # The rest: powers of two, largest first.
    while filled:
        size = 1 << (filled.bit_length() - 1)
        head, rest, got = [], [], 0
        for name, ids, a, b in window:
            cut = min(b, a + max(size - got, 0))
            if cut > a:
                head.append((name, ids, a, cut))
                got += cut - a
            if cut < b:
                rest.append((name, ids, cut, b))
        yield from pieces(head, sequence)
        sequence, window, filled = sequence + 1, rest, filled - size


def _shards(rows: Iterator[tuple[int | None, np.ndarray]], most_tokens: int) -> Iterator[list]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[1])
        if size >= most_tokens:
            yield held
            held, size = [], 0
    if held:
        yield held


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, length: int = LENGTH) -> DataFrame:
    """Pieces of all documents (doc_id, text) with their ids (little-endian unsigned 32-bit).

    doc_id, start (the document's ids before the piece), length, doc_tokens
    (with the end id), sequence_id, offset (in the sequence), ids.
    """
    coded = encode_documents(docs, tokenizer, end_id)
    often, n_docs, n_ids = corpus_statistics(coded)
    idf = np.log1p((n_docs - often + 0.5) / (often + 0.5)).astype(np.float32)
    mean, kind = max(n_ids / max(n_docs, 1), 1.0), _width(len(often))

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        forget_encoders()
        rows = ((name.as_py(), np.frombuffer(ids.as_buffer(), kind).copy())
                for batch in found for name, ids in zip(batch.column(0), batch.column(1)))
        yield from batches(pack(rows, idf, mean, TaskContext.get().partitionId() << 36, length), _PIECE)

    spark = docs.sparkSession
    whole = coded.where("kind = 0").select("doc_id", "ids")
    width = np.dtype(kind).itemsize
    # Bounded: 2 * SAMPLE_DOCS documents, 4096 ids each.
    chosen = (whole.where(F.pmod(F.xxhash64("ids", F.monotonically_increasing_id()), F.lit(max(n_docs // SAMPLE_DOCS, 1))) == 0)
              .select(F.substring("ids", 1, 4096 * width).alias("ids")).limit(2 * SAMPLE_DOCS).collect())
    topics = Topics([np.frombuffer(row["ids"], kind) for row in chosen], idf, mean) if chosen else None
    # Bounded: ``SKETCHES`` + ``DIMS`` numbers a term of the vocabulary.
    model = spark.sparkContext.broadcast((sketch_ranks(often, idf), topics))

    def sketched(found: Iterator[pa.RecordBatch], bounds: list[tuple]) -> Iterator[pa.RecordBatch]:
        forget_encoders()
        ranks, topics = model.value
        for batch in found:
            own = [np.frombuffer(ids.as_buffer(), kind) for ids in batch.column(1)]
            if own:
                terms = distinct(own)
                drawn = np.stack([ranks[:, ids].min(axis=1) for ids, _ in terms], axis=1)
                topic = topics.of(own, terms) if topics else np.zeros(len(own))
                drawn = [topic.astype(np.int32), *drawn]
                task = [bisect(bounds, key) for key in zip(*(k.tolist() for k in drawn), batch.column(2).to_pylist())]
                yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(k, pa.int32()) for k in drawn), pa.array(task, pa.int32())],
                                                 names=["doc_id", "ids", "h", *keys, "task"])

    keys = ["topic", *(f"k{k}" for k in range(SKETCHES))]
    schema = "doc_id long, ids binary, h long, " + ", ".join(f"{k} int" for k in [*keys, "task"])
    # The row's number sets repeated rows apart.
    whole = whole.withColumn("h", F.xxhash64("ids", F.monotonically_increasing_id()))
    # The order's bounds come from a sample, bounded by BOUND_ROWS rows a task on average, so that all documents are sketched once only.
    tasks = partitions(spark)
    sampled = whole.where(F.pmod(F.xxhash64("h"), F.lit(max(n_docs // (BOUND_ROWS * tasks), 1))) == 0)
    found = sorted(tuple(row) for row in in_arrow(sampled, lambda rows: sketched(rows, []), schema).select(*keys, "h").collect())
    bounds = [found[len(found) * k // tasks] for k in range(1, tasks)] if found else []
    dealt = (in_arrow(whole, lambda rows: sketched(rows, bounds), schema)
             .repartitionById(tasks, "task").sortWithinPartitions(*keys, "h"))
    return in_arrow(dealt.select("doc_id", "ids"), run, _PIECE_SQL)
