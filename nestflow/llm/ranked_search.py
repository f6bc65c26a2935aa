"""Ranked lexical search by pair-bound MaxScore.

Terms are runs of characters other than U+0000-002F, 003A-0040, 005B-0060,
007B-007F, with A-Z lower-cased.  With N documents that hold a term, L terms
in all of them, n in one document, df documents with the term and tf
occurrences of it in the document:

    w = floor(1000 ln((2 N + 2) / (2 df + 1))),  m = 50 + 50 n N div L,
    impact = w (1000000000 tf div (1000 tf + 20 m)),

and a document's score is the sum of the impacts of the query's terms, each
once.

1. Count: one scan of the texts gives of every document its number of terms
   and the occurrences of the queries' terms; N, L and every df are summed
   over all documents.
2. Index: a segment holds some ten thousand documents of one scan task, as
   postings (document, tf) of every term, and of every term a list of the
   blocks of ``BLOCK`` documents it occurs in with its largest impact there.
   For every two of the ``PAIR_TERMS`` most frequent terms an intersection list
   holds the blocks where documents have both, with the largest sum of the two
   impacts: the joint maximum.
3. Search: a query's terms are taken by falling maximum.  What the terms from
   the i-th on can add to a document of a block is bounded by the sum of
   their maxima there; two terms that have an intersection list are bounded
   together by the largest of their joint maximum and the two single ones,
   which is less than the sum of these if no document has both at their
   best.  As soon as that bound is under the k-th best score so far (a lower bound of the
   result's last score), the remaining postings can bring up no new document;
   they are looked up for the documents only that may still reach it, ever
   fewer.  Equal scores are kept, so ties are decided by doc_id alone.
   One segment in ``SEEDS`` is searched first; its k-th best scores, one number
   a query, are the others' first thresholds.  That saves work and changes no result.
4. Merge: the best k of every segment, then of groups of segments, then of all.

Queries are taken in blocks of at most ``BLOCK_TERMS`` terms, each searched
over all documents; only a block's terms are indexed, as no other can be
looked up, and nothing sent to the executors grows.

Null, empty and term-less texts have no terms: they are no document of N and
never a result.  Repeated rows are documents each; equal scores come by
ascending doc_id, null last, then place in the scan.  Items that repeat an id
are ranked each by itself; an item without terms gets no rows.  Columns
beside doc_id, text (item_id, text) are not read.  No documents or no items
give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nestflow.llm.common import batches, in_arrow, saved
from nestflow.llm.decontaminate import words_of as terms_of

LIMIT = 50
BLOCK_TERMS = 200_000
SEGMENT_DOCS, SEGMENT_POSTINGS = 32_768, 2_000_000
BLOCK = 1024
PAIR_TERMS = 32
SEEDS = 16
#: Groups of segments of the first merge.
_GROUPS = 32


def counted(docs: DataFrame, codes: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms), terms (ascending codes), tfs (both 32-bit integers as bytes) of every document with a term; saved."""
    shared = docs.sparkSession.sparkContext.broadcast(codes)
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.binary()), ("tfs", pa.binary())])

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = shared.value.get

        def rows():
            for batch in found:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    words = terms_of(text.as_py())
                    if words:
                        own = np.array([x for x in map(look, words) if x is not None], dtype="<i4")
                        there, often = np.unique(own, return_counts=True)
                        yield doc_id, len(words), there.tobytes(), often.astype("<i4").tobytes()

        yield from batches(rows(), schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return saved(in_arrow(rows, run, "doc_id long, n long, terms binary, tfs binary"), "term-counts")


@dataclass
class Statistics:
    """N, L and the documents of every term, over all documents."""

    documents: int
    occurrences: int
    frequencies: np.ndarray

    def weights(self) -> np.ndarray:
        up = 2 * self.documents + 2
        return np.array([math.floor(1000 * math.log(up / (2 * df + 1))) for df in self.frequencies.tolist()], dtype=np.int64)

    def lengths(self, n: np.ndarray) -> np.ndarray:
        """m of documents of n terms."""
        if not len(n) or 50 * int(n.max()) * self.documents < 1 << 63:
            return 50 + 50 * n * self.documents // self.occurrences
        return np.array([50 + 50 * x * self.documents // self.occurrences for x in n.tolist()], dtype=np.int64)


def statistics(counts: DataFrame, n_terms: int) -> Statistics:
    """``n_terms`` rows to the driver at most."""
    sums = counts.agg(F.count(F.lit(1)), F.sum("n")).first()

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = np.zeros(n_terms, dtype=np.int64)
        for batch in found:
            flat = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i4")
            often += np.bincount(flat, minlength=n_terms)
        there = np.flatnonzero(often)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(often[there])], names=["term", "n"])

    frequencies = np.zeros(n_terms, dtype=np.int64)
    for term, n in in_arrow(counts.select("terms"), run, "term long, n long").groupBy("term").agg(F.sum("n")).collect():
        frequencies[term] = n
    return Statistics(sums[0], sums[1] or 0, frequencies)


_SEGMENT = [("segment", "long"), ("doc_ids", "array<long>"), ("lengths", "binary"), ("terms", "binary"), ("ends", "binary"), ("docs", "binary"), ("tfs", "binary"),
            ("run_ends", "binary"), ("run_blocks", "binary"), ("run_maxima", "binary"), ("pairs", "binary"), ("pair_ends", "binary"),
            ("pair_blocks", "binary"), ("pair_maxima", "binary")]
_SEGMENT_SQL = ", ".join(f"{name} {kind}" for name, kind in _SEGMENT)


def _impacts(weight: int, tfs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    tf = tfs.astype(np.int64)
    return weight * (1_000_000_000 * tf // (1000 * tf + 20 * lengths))


def _block_maxima(docs: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The blocks of ascending documents, and the largest value in each."""
    blocks = docs // BLOCK
    begins = np.flatnonzero(np.diff(blocks, prepend=-1))
    return blocks[begins], np.maximum.reduceat(values, begins)


def segment_row(number: int, doc_ids: list, n: list[int], terms: list[bytes], tfs: list[bytes], stats: Statistics,
                weights: np.ndarray, paired: list[int]) -> dict:
    """The segment of some documents, as a row."""
    lengths = stats.lengths(np.array(n, dtype=np.int64))
    flat = np.frombuffer(b"".join(terms), "<i4")
    owner = np.repeat(np.arange(len(terms)), [len(t) // 4 for t in terms])
    order = np.argsort(flat, kind="stable")
    docs, often, flat = owner[order], np.frombuffer(b"".join(tfs), "<i4")[order], flat[order]
    begins = np.flatnonzero(np.diff(flat, prepend=-1))
    ends = np.append(begins[1:], len(flat)).astype(np.int64) if len(flat) else np.empty(0, np.int64)
    there = flat[begins]
    runs, impacts = [], {}
    for term, x, y in zip(there.tolist(), begins.tolist(), ends.tolist()):
        own = _impacts(int(weights[term]), often[x:y], lengths[docs[x:y]])
        runs.append(_block_maxima(docs[x:y], own))
        if term in paired:
            impacts[term] = docs[x:y], own
    dense = {}
    for term, (own, values) in impacts.items():
        dense[term] = np.zeros(len(terms), dtype=np.int64)
        dense[term][own] = values
    pairs, lists = [], []
    for a, b in combinations(sorted(impacts), 2):
        own, values = min(impacts[a], impacts[b], key=lambda x: len(x[0]))
        other = dense[b if own is impacts[a][0] else a][own]
        both = other > 0
        if both.any():
            lists.append(_block_maxima(own[both], values[both] + other[both]))
        else:
            lists.append((np.empty(0, np.int64), np.empty(0, np.int64)))
        pairs += [a, b]

    def joined(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[bytes, bytes, bytes]:
        sizes = np.cumsum([len(p[0]) for p in parts], dtype=np.int64)
        return (sizes.astype("<i8").tobytes(), b"".join(p[0].astype("<i4").tobytes() for p in parts), b"".join(p[1].astype("<i8").tobytes() for p in parts))

    run_ends, run_blocks, run_maxima = joined(runs)
    pair_ends, pair_blocks, pair_maxima = joined(lists)
    return {"segment": number, "doc_ids": doc_ids, "lengths": lengths.astype("<i8").tobytes(), "terms": there.astype("<i4").tobytes(), "ends": ends.astype("<i8").tobytes(),
            "docs": docs.astype("<u4").tobytes(), "tfs": often.astype("<i4").tobytes(), "run_ends": run_ends, "run_blocks": run_blocks, "run_maxima": run_maxima,
            "pairs": np.array(pairs, dtype="<i4").tobytes(), "pair_ends": pair_ends, "pair_blocks": pair_blocks, "pair_maxima": pair_maxima}


def build_index(counts: DataFrame, stats: Statistics) -> DataFrame:
    """Segments of ``counts``: a table in the shared folder."""
    weights = stats.weights()
    useful = np.flatnonzero((weights > 0) & (stats.frequencies > 0))
    paired = useful[np.argsort(-stats.frequencies[useful], kind="stable")][:PAIR_TERMS].tolist()
    shared = counts.sparkSession.sparkContext.broadcast((stats, weights, paired))

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: tuple[list, list, list, list] = ([], [], [], [])
        size = 0

        def ended() -> pa.RecordBatch:
            row = segment_row(number, *held, *shared.value)
            kinds = {"long": pa.int64(), "array<long>": pa.list_(pa.int64()), "binary": pa.binary()}
            return pa.RecordBatch.from_arrays([pa.array([row[name]], kinds[kind]) for name, kind in _SEGMENT], names=[name for name, _ in _SEGMENT])

        for batch in found:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                for values, x in zip(held, row):
                    values.append(x)
                size += len(row[2]) // 4
                if len(held[0]) >= SEGMENT_DOCS or size >= SEGMENT_POSTINGS:
                    yield ended()
                    held, size, number = ([], [], [], []), 0, number + 1
        if held[0]:
            yield ended()

    return saved(in_arrow(counts.select("doc_id", "n", "terms", "tfs"), run, _SEGMENT_SQL), "ranked-index")


class Segment:
    """A segment that is searched."""

    def __init__(self, row: dict, weights: np.ndarray, pairs: bool = True) -> None:
        def longs(name: str, kind: str = "<i8") -> np.ndarray:
            return np.frombuffer(row[name], kind).astype(np.int64)

        self.doc_ids = row["doc_ids"]
        self.lengths, self.weights = longs("lengths"), weights
        self.n_blocks = -(-len(self.lengths) // BLOCK)
        self._docs, self._tfs = np.frombuffer(row["docs"], "<u4"), np.frombuffer(row["tfs"], "<i4")
        ends = longs("ends")
        self._spans = dict(zip(longs("terms", "<i4").tolist(), zip(np.append(0, ends[:-1]).tolist(), ends.tolist())))
        self._maxima = self._dense(list(self._spans), longs("run_ends"), longs("run_blocks", "<i4"), longs("run_maxima"))
        self._joint: dict[tuple[int, int], np.ndarray] = {}
        if pairs:
            both = longs("pairs", "<i4").reshape(-1, 2).tolist()
            self._joint = self._dense(list(map(tuple, both)), longs("pair_ends"), longs("pair_blocks", "<i4"), longs("pair_maxima"))
        self._known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        #: Postings that were read or looked up.
        self.touched = 0

    def _dense(self, names: list, ends: np.ndarray, blocks: np.ndarray, maxima: np.ndarray) -> dict:
        out = {}
        for name, x, y in zip(names, [0, *ends.tolist()], ends.tolist()):
            out[name] = np.zeros(self.n_blocks, dtype=np.int64)
            out[name][blocks[x:y]] = maxima[x:y]
        return out

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents of the term and its impacts there."""
        if term not in self._known:
            x, y = self._spans[term]
            docs = self._docs[x:y].astype(np.int64)
            self._known[term] = docs, _impacts(int(self.weights[term]), self._tfs[x:y], self.lengths[docs])
        return self._known[term]

    def bounds(self, terms: list[int]) -> np.ndarray:
        """Row i: what the terms from the i-th on can add to a document, by block."""
        out = np.zeros((len(terms) + 1, self.n_blocks), dtype=np.int64)
        alone: list[int] = []  # terms so far that are in no pair yet
        for i in range(len(terms) - 1, -1, -1):
            own = self._maxima[terms[i]]
            best, partner = 0, None
            out[i] = out[i + 1] + own
            for j in alone:
                joint = self._joint.get((min(terms[i], j), max(terms[i], j)))
                if joint is not None:
                    other = self._maxima[j]
                    less = own + other - np.maximum(np.maximum(own, other), joint)
                    if (saving := int(less.sum())) > best:
                        best, partner, fewer = saving, j, less
            if partner is None:
                alone.append(terms[i])
            else:
                alone.remove(partner)
                out[i] -= fewer
        return out

    def best(self, terms: list[int], limit: int, floor: int = 0) -> list[tuple[int, int]]:
        """(document, score) of the ``limit`` best documents, those that score under ``floor`` left out."""
        terms = [t for t in terms if t in self._spans and self.weights[t] > 0]
        terms.sort(key=lambda t: (-int(self._maxima[t].max()), t))
        bounds = self.bounds(terms)
        floor = max(floor, 1)
        if int(bounds[0].max(initial=0)) < floor:
            return []
        scores = np.zeros(len(self.lengths), dtype=np.int64)
        block = np.arange(len(scores)) // BLOCK
        new = True  # whether documents without a score so far may still be results
        for i, term in enumerate(terms):
            if new and int(bounds[i].max()) < floor:
                new = False
                those = np.flatnonzero(scores)
            if not new:
                those = those[scores[those] + bounds[i][block[those]] >= floor]
                if not len(those):
                    return []
            docs, impacts = self.postings(term)
            if new or len(those) * 8 > len(docs):
                scores[docs] += impacts
                self.touched += len(docs)
            else:
                at = np.minimum(np.searchsorted(docs, those), len(docs) - 1)
                hit = docs[at] == those
                scores[those[hit]] += impacts[at[hit]]
                self.touched += len(those)
            # So far the k-th best score is at least this.
            top = scores if new else scores[those]
            if len(top) > limit and int(top.max()) > max(floor, int(bounds[i + 1].max())):
                floor = max(floor, int(np.partition(top, len(top) - limit)[len(top) - limit]))
        those = np.flatnonzero(scores >= floor) if new else those[scores[those] >= floor]
        ids = np.array([math.inf if self.doc_ids[k] is None else 0 for k in those.tolist()])
        plain = np.array([self.doc_ids[k] or 0 for k in those.tolist()], dtype=np.int64)
        order = np.lexsort((those, plain, ids, -scores[those]))[:limit]
        return list(zip(those[order].tolist(), scores[those[order]].tolist()))


_FOUND = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64()), ("segment", pa.int64()), ("place", pa.int64())])


def _searched(index: DataFrame, weights: np.ndarray, queries: list[tuple[int, list[int]]], floors: dict[int, int], limit: int, pairs: bool) -> DataFrame:
    shared = index.sparkSession.sparkContext.broadcast((weights, queries, floors))

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, queries, floors = shared.value

        def rows():
            for batch in found:
                for row in batch.to_pylist():
                    segment = Segment(row, weights, pairs)
                    for item, terms in queries:
                        for doc, score in segment.best(list(terms), limit, floors.get(item, 0)):
                            yield item, segment.doc_ids[doc], score, row["segment"], doc

        yield from batches(rows(), _FOUND)

    return in_arrow(index, run, "item long, doc_id long, score long, segment long, place long")


def _first(found: DataFrame, limit: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "segment", "place")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)


def _block(docs: DataFrame, items: list[tuple[int, int | None, list[bytes]]], limit: int, pairs: bool) -> DataFrame:
    """Ranks of some items (number, id, terms)."""
    codes = {term: k for k, term in enumerate(dict.fromkeys(t for _, _, terms in items for t in terms))}
    counts = counted(docs, codes)
    stats = statistics(counts, len(codes))
    index, weights = build_index(counts, stats), stats.weights()
    queries = [(number, [codes[t] for t in terms]) for number, _, terms in items]
    group = F.pmod(F.xxhash64("segment"), F.lit(_GROUPS)).alias("group")
    seeds = F.pmod(F.xxhash64("segment"), F.lit(SEEDS)) == 0
    seeded = saved(_first(_searched(index.where(seeds), weights, queries, {}, limit, pairs), limit, "item").drop("rank"), "ranked-seeds")
    # One number an item of the block.
    floors = {item: score for item, score in seeded.groupBy("item").agg(F.min("score"), F.count(F.lit(1)).alias("n")).where(F.col("n") == limit).drop("n").collect()}
    rest = _searched(index.where(~seeds), weights, queries, floors, limit, pairs)
    first = _first(seeded.unionByName(rest).withColumn("group", group), limit, "item", "group").drop("rank", "group")
    ranked = saved(_first(first, limit, "item"), "ranked")
    names = docs.sparkSession.createDataFrame([(number, item_id) for number, item_id, _ in items], "item long, item_id long")
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def rank(docs: DataFrame, items: DataFrame, limit: int = LIMIT, block_terms: int = BLOCK_TERMS, pairs: bool = True) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: of every item (item_id, text) the ``limit`` best of ``docs`` (doc_id, text).

    ``pairs``: whether pair bounds are used; the result is the same without.
    """
    blocks, held, size = [], [], 0
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text").toLocalIterator()
    for number, (item_id, text) in enumerate(rows):
        terms = list(dict.fromkeys(terms_of(text)))
        if terms:
            held.append((number, item_id, terms))
            size += len(terms)
        if size >= block_terms:
            blocks.append(_block(docs, held, limit, pairs))
            held, size = [], 0
    if held:
        blocks.append(_block(docs, held, limit, pairs))
    if not blocks:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, blocks)
