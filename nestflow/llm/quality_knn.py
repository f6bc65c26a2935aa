"""Quality by nearest-neighbour voting in a latent-semantic space.

A text's terms are its lower-cased words and their ends, hashed into
``WORD_DIMS`` bins, and marks of its form (punctuation, capital words,
figures, repeated lines), hashed into ``FORM_DIMS`` bins.  Weights are
(1 + ln count) times the inverse document frequency, counted over all
documents; each of the two halves has length one.  A truncated singular
value decomposition of labelled texts gives the latent space.

The fit uses at most ``FIT_ROWS`` labelled documents of each class (those with
the smallest hash of their doc_id, so the choice does not depend on
partitions).  A label's vote and its share in the mean count as many times as
there are labelled documents of its class for each one in the fit, so a score
means the same whatever the table's size.  That bound also bounds what is sent to the executors: the
projection and the labelled vectors, a few MB whatever the corpus.

Every document's cosine with every labelled vector is computed exactly, in
blocks; the ``NEIGHBOURS`` nearest vote for their labels with their
similarity, to the power ``SHARPNESS``, as weight.

A text without terms, or without a similar neighbour, gets the mean of all
labels that may be used.
Null texts are empty.  Repeated rows are scored each.  Labels with a null
doc_id or label, or without a document, are not used; of a doc_id's several labels the largest is.
With no usable labels every score is 0.5.  Only doc_id and text are read of
the documents, and doc_id takes no part in a score.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestflow.llm.common import in_arrow, saved

WORD_DIMS, FORM_DIMS = 8192, 512
DIMS = WORD_DIMS + FORM_DIMS
RANK = 48
FIT_ROWS = 2048
NEIGHBOURS, SHARPNESS = 25, 4
BLOCK = 512

_TERM = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
_SPARSE = "y int, bins array<int>, weights array<float>"


def _bin(term: str, form: bool) -> int:
    code = zlib.crc32(term.encode("utf-8", "surrogatepass"))
    return WORD_DIMS + code % FORM_DIMS if form else code % WORD_DIMS


class Terms:
    """Bins of a text's terms; a process keeps the bins of terms it has met, up to a bound."""

    MOST = 200_000

    def __init__(self) -> None:
        self.known: dict[str, tuple[int, ...]] = {}

    def _bins(self, term: str) -> tuple[int, ...]:
        first = term[0]
        if first.isalpha():
            out = [_bin(term.lower(), False)]
            if len(term) > 1 and term.isupper():
                out.append(_bin("<capitals>", True))
            return tuple(out)
        if first.isdigit():
            return (_bin(f"<figures {min(len(term), 8)}>", True),)
        return tuple(_bin(c, True) for c in term[:8]) + (_bin(f"<run {min(len(term), 8)}>", True),)

    def counts(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Bins in the text and how often they occur."""
        if not text:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        known = self.known
        if len(known) > self.MOST:
            known.clear()
        bins: list[int] = []
        for term in _TERM.findall(text):
            own = known.get(term)
            if own is None:
                own = known[term] = self._bins(term)
            bins += own
        lines = [x for x in text.split("\n") if x.strip()]
        bins += [_bin("<repeated line>", True)] * (len(lines) - len(set(lines)))
        return np.unique(np.array(bins, dtype=np.int64), return_counts=True)


def _weighted(bins: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weights = (1 + np.log(counts)) * idf[bins]
    form = bins >= WORD_DIMS
    for half in (form, ~form):
        length = np.sqrt((weights[half] ** 2).sum())
        if length > 0:
            weights[half] /= length
    return weights.astype(np.float32)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents with each bin, and all documents; summed by Spark, ``DIMS`` rows to the driver."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, often = Terms(), np.zeros(DIMS + 1, dtype=np.int64)
        for batch in found:
            for text in batch.column(0):
                often[terms.counts(text.as_py())[0]] += 1
                often[DIMS] += 1
        there = np.flatnonzero(often)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int64()), pa.array(often[there], pa.int64())], names=["bin", "n"])

    often = np.zeros(DIMS + 1, dtype=np.int64)
    for row in in_arrow(docs.select("text"), run, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect():
        often[row["bin"]] = row["n"]
    return often[:DIMS], int(often[DIMS])


def _labelled(docs: DataFrame, labels: DataFrame, idf: np.ndarray, fit_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weighted terms (rows), labels and weights of the texts chosen for the fit."""
    usable = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y"))
              .where("doc_id IS NOT NULL AND y IN (0, 1)").groupBy("doc_id").agg(F.max("y").alias("y"))
              .where(~held_out("doc_id")))
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL")
    # A doc_id's repeated rows are documents each.
    usable = saved(usable.join(known.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")), "doc_id"), "usable-labels")
    totals = {row["y"]: row["n"] for row in usable.groupBy("y").agg(F.sum("rows").alias("n")).collect()}
    chosen = None
    for y in (0, 1):
        own = usable.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
        chosen = own if chosen is None else chosen.unionByName(own)
    # At most 2 * fit_rows label rows: a proven bound for the broadcast.
    texts = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen.select("doc_id", "y")), "doc_id")
             .select("doc_id", "y", "text"))

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for batch in found:
            rows = []
            for doc_id, y, text in zip(*(batch.column(k) for k in range(3))):
                bins, counts = terms.counts(text.as_py())
                rows.append((doc_id.as_py(), y.as_py(), bins.tolist(), _weighted(bins, counts, idf).tolist()))
            if rows:
                a, b, c, d = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int32()), pa.array(c, pa.list_(pa.int32())),
                                                  pa.array(d, pa.list_(pa.float32()))], names=["doc_id", "y", "bins", "weights"])

    coded = in_arrow(texts, run, "doc_id long, " + _SPARSE)
    matrix, ys = [], []
    for y in (0, 1):
        rows = coded.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("bins")).limit(fit_rows)
        for row in rows.toLocalIterator():
            dense = np.zeros(DIMS, dtype=np.float32)
            dense[row["bins"]] = row["weights"]
            matrix.append(dense)
            ys.append(y)
    labels_in = np.array(ys, dtype=np.float32)
    weights = np.array([totals[y] for y in ys]) / np.array([ys.count(y) for y in ys])
    return np.array(matrix, dtype=np.float32).reshape(-1, DIMS), labels_in, weights


def latent_space(matrix: np.ndarray, rank: int = RANK) -> np.ndarray:
    """Right singular vectors (DIMS x rank) by a randomised decomposition with a fixed seed."""
    rank = min(rank, *matrix.shape)
    basis = matrix.T @ np.random.default_rng(7).standard_normal((len(matrix), rank + 8), dtype=np.float32)
    for _ in range(4):
        basis, _ = np.linalg.qr(matrix.T @ (matrix @ basis))
    _, _, right = np.linalg.svd(matrix @ basis, full_matrices=False)
    return (basis @ right.T)[:, :rank].astype(np.float32)


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, length, out=np.zeros_like(rows), where=length > 1e-9)


def vote(vectors: np.ndarray, labelled: np.ndarray, ys: np.ndarray, counts: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Similarity-weighted mean label of each vector's nearest labelled vectors (both of length one).

    ``counts``: how many labelled documents each labelled vector stands for.
    """
    prior = float(np.average(ys, weights=counts)) if len(ys) else 0.5
    out = np.full(len(vectors), prior)
    if not len(ys):
        return out
    k = min(neighbours, len(ys))
    for at in range(0, len(vectors), BLOCK):
        cosines = vectors[at:at + BLOCK] @ labelled.T
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        weights = np.maximum(np.take_along_axis(cosines, near, axis=1), 0).astype(np.float64) ** SHARPNESS * counts[near]
        total = weights.sum(axis=1)
        mean = (weights * ys[near]).sum(axis=1) / np.where(total > 1e-12, total, 1)
        out[at:at + BLOCK] = np.where(total > 1e-12, mean, prior)
    return np.clip(out, 0, 1)


def held_out(doc_id: str):
    """Whether a row's label is kept from the fit."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def score(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, rank: int = RANK) -> DataFrame:
    """Of every document: doc_id, held_out, score."""
    often, n = document_frequencies(docs)
    idf = np.log((n + 1) / (often + 1)) + 1
    matrix, ys, counts = _labelled(docs, labels, idf, fit_rows)
    if len(ys):
        space = latent_space(matrix, rank)
        labelled = _unit(matrix @ space)
    else:
        space = labelled = np.zeros((DIMS, 1), dtype=np.float32)
    del matrix
    # Bounded: DIMS x RANK, 2 * FIT_ROWS x (RANK + 2) and DIMS numbers.
    model = docs.sparkSession.sparkContext.broadcast((idf, space, labelled, ys, counts))

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, space, labelled, ys, counts = model.value
        terms = Terms()
        for batch in found:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                vectors = np.zeros((part.num_rows, space.shape[1]), dtype=np.float32)
                for k, text in enumerate(part.column(1)):
                    bins, often = terms.counts(text.as_py())
                    if len(bins):
                        vectors[k] = _weighted(bins, often, idf) @ space[bins]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.round(vote(_unit(vectors), labelled, ys, counts), 6), pa.float64())],
                                                 names=["doc_id", "score"])

    scored = in_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, score double")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score")
