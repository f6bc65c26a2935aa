"""Benchmark decontamination by a distributed positional inverted index.

Training texts are cut into words and indexed in segments: a segment holds
some thousand consecutive documents of one scan task, and of every term its
postings, the ascending places of the term in the segment (documents are a
place apart, so no phrase crosses them).  Only terms of the test items are
stored, as no other can be looked up.  A segment is one row of a table in
the shared folder and complete in itself.

A search takes phrases of test terms.  Terms are ranked by their number in
the whole corpus; a phrase's list of places starts from its rarest term,
shifted by the term's offset, and is intersected with the shifted postings
of the next rarest until it is empty or all terms agree.  With ``slop`` the
phrase's distinct terms need only occur, in any order, within the phrase's
length plus ``slop`` words (proximity).

Items are split into blocks of at most ``block_terms`` words; every block is
searched over all segments, so nothing sent to the executors grows.

A word is a run of characters other than U+0000-002F, 003A-0060, 007B-007F
after A-Z are lower-cased.  Null and empty texts have no words.  An item of
no words is never found; an item with a null id hits words but counts as no
item; items that repeat an id count once.  Repeated documents are judged
each by itself.  Columns beside doc_id, text (item_id, text) are not read.
An empty document table gives no rows; with no items nothing is hit.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestflow.llm.common import in_arrow, saved, unused

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

WINDOW = 10
SEGMENT_WORDS = 1_000_000
BLOCK_TERMS = 1_000_000


def words_of(text: str | None) -> list[bytes]:
    return _WORD.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []


def windows_of(items: list[tuple[int | None, str | None]], width: int = WINDOW) -> dict[tuple[bytes, ...], set]:
    """Phrases of ``width`` consecutive words (a shorter item: all its words) with their items."""
    out: dict[tuple[bytes, ...], set] = {}
    for item, text in items:
        w = words_of(text)
        for k in range(max(len(w) - width + 1, min(len(w), 1))):
            out.setdefault(tuple(w[k:k + width]), set()).add(item)
    return out


_SEGMENT = pa.schema([
    ("segment", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_words", pa.list_(pa.int64())), ("terms", pa.list_(pa.int32())),
    ("counts", pa.list_(pa.int64())), ("postings", pa.binary())])
_SEGMENT_SQL = "segment long, doc_ids array<long>, n_words array<long>, terms array<int>, counts array<long>, postings binary"


def build_index(docs: DataFrame, terms: dict[bytes, int], segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """Segments of ``docs`` (doc_id, text): a table in the shared folder.

    ``postings`` has the places (unsigned 64-bit differences would save
    little: the table is compressed) of each term in ``terms``, in its order.
    """

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        look = terms.get
        number = TaskContext.get().partitionId() << 32
        names, counts, coded, size = [], [], [], 0

        def segment() -> pa.RecordBatch:
            # A place that holds no word follows every document.
            flat = np.concatenate(coded)
            places = np.flatnonzero(flat >= 0)
            own = flat[places]
            order = np.argsort(own, kind="stable")
            there, often = np.unique(own, return_counts=True)
            return pa.RecordBatch.from_arrays([
                pa.array([number], pa.int64()),
                pa.array([names], _SEGMENT.field(1).type), pa.array([counts], _SEGMENT.field(2).type),
                pa.array([there.astype(np.int32)], _SEGMENT.field(3).type), pa.array([often.astype(np.int64)], _SEGMENT.field(4).type),
                pa.array([places[order].astype("<u8" if len(flat) >= 1 << 32 else "<u4").tobytes()], pa.binary())], schema=_SEGMENT)

        for batch in found:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                w = words_of(text.as_py())
                names.append(doc_id)
                counts.append(len(w))
                coded.append(np.array([look(x, -1) for x in w] + [-1], dtype=np.int32))
                size += len(w) + 1
                if size >= segment_words:
                    yield segment()
                    names, counts, coded, size, number = [], [], [], 0, number + 1
        if names:
            yield segment()

    return saved(in_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, _SEGMENT_SQL), "word-index")


class Postings:
    """The postings of one segment."""

    def __init__(self, terms: list[int], counts: list[int], postings: bytes, words: int) -> None:
        places = np.frombuffer(postings, "<u8" if words >= 1 << 32 else "<u4").astype(np.int64)
        ends = np.cumsum(np.array(counts, dtype=np.int64))
        self.of = {t: places[e - c:e] for t, c, e in zip(terms, counts, ends.tolist())}

    def phrase(self, terms: tuple[int, ...], order: list[int]) -> np.ndarray:
        """Places where the phrase begins; ``order`` has its offsets, rarest term first."""
        if any(t not in self.of for t in terms):
            return np.empty(0, dtype=np.int64)
        begins = self.of[terms[order[0]]] - order[0]
        for k in order[1:]:
            if not len(begins):
                break
            own, sought = self.of[terms[k]], begins + k
            at = np.minimum(np.searchsorted(own, sought), len(own) - 1)
            begins = begins[own[at] == sought]
        return begins

    def near(self, terms: tuple[int, ...], order: list[int], slop: int) -> np.ndarray:
        """First and last places (rows) of spans of at most len(terms) + slop words that hold all the distinct terms."""
        if any(t not in self.of for t in terms):
            return np.empty((0, 2), dtype=np.int64)
        width, distinct = len(terms) + slop, list(dict.fromkeys(terms[k] for k in order))
        around = self.of[distinct[0]]
        for t in distinct[1:]:  # rarest first: few places are left for the long lists
            own = self.of[t]
            after = np.searchsorted(own, around - width + 1)
            near = (after < len(own)) & (own[np.minimum(after, len(own) - 1)] < around + width)
            around = around[near]
        found = set()
        for p in around.tolist():
            lists = [self.of[t][np.searchsorted(self.of[t], p - width + 1):np.searchsorted(self.of[t], p + width)] for t in distinct[1:]]
            for begin in sorted({p, *(x for own in lists for x in own.tolist() if x <= p)}):
                firsts = [own[np.searchsorted(own, begin):] for own in lists]
                if p - begin < width and all(len(f) and f[0] < begin + width for f in firsts):
                    found.add((begin, max([p, *(int(f[0]) for f in firsts)])))
        return np.array(sorted(found), dtype=np.int64).reshape(-1, 2)


_HITS = "segment long, place long, doc_id long, n_words long, spans array<struct<start:long,stop:long>>, items array<long>"


def _search(index: DataFrame, terms: dict[bytes, int], phrases: dict[tuple[bytes, ...], set], slop: int | None) -> DataFrame:
    """Of every document: merged spans of hit words (places in the document) and found items."""
    # How often each test term occurs in the whole corpus; as many rows as test terms.
    counted = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("x")).groupBy("x.terms").agg(F.sum("x.counts").alias("n"))
    often = {int(r["terms"]): int(r["n"]) for r in counted.collect()}
    plans = []
    for phrase, items in phrases.items():
        own = tuple(terms[w] for w in phrase)
        if all(t in often for t in own):
            plans.append((own, sorted(range(len(own)), key=lambda k: (often[own[k]], k)), sorted(i for i in items if i is not None)))

    fields = [("segment", pa.int64()), ("place", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()),
              ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), ("items", pa.list_(pa.int64()))]
    schema = pa.schema(fields)

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for k in range(batch.num_rows):
                segment, names, counts, there, numbers, postings = (batch.column(c)[k].as_py() for c in range(6))
                lengths = np.array(counts, dtype=np.int64) + 1
                begins = np.cumsum(lengths) - lengths
                words = int(lengths.sum())
                held = Postings(there, numbers, postings, words)
                edges = np.zeros(words + 1, dtype=np.int64)
                items: dict[int, set] = {}
                for own, order, names_found in plans:
                    if slop is None:
                        first = held.phrase(own, order)
                        stop = first + len(own)
                    else:
                        both = held.near(own, order, slop)
                        first, stop = both[:, 0], both[:, 1] + 1
                    if not len(first):
                        continue
                    doc = np.searchsorted(begins, first, side="right") - 1
                    one = stop <= begins[doc] + lengths[doc] - 1
                    first, stop, doc = first[one], stop[one], doc[one]
                    np.add.at(edges, first, 1)
                    np.add.at(edges, stop, -1)
                    for d in np.unique(doc).tolist():
                        items.setdefault(d, set()).update(names_found)
                covered = np.diff(np.concatenate([[0], (np.cumsum(edges) > 0).astype(np.int8), [0]]))
                starts, stops = np.flatnonzero(covered == 1), np.flatnonzero(covered == -1)
                owner = np.searchsorted(begins, starts, side="right") - 1
                spans: dict[int, list] = {}
                for a, b, d in zip(starts.tolist(), stops.tolist(), owner.tolist()):
                    base = int(begins[d])
                    spans.setdefault(d, []).append({"start": a - base, "stop": b - base})
                n = len(names)
                yield pa.RecordBatch.from_arrays([
                    pa.array([segment] * n, pa.int64()), pa.array(range(n), pa.int64()), pa.array(names, pa.int64()),
                    pa.array(counts, pa.int64()), pa.array([spans.get(d, []) for d in range(n)], fields[4][1]),
                    pa.array([sorted(items.get(d, ())) for d in range(n)], pa.list_(pa.int64()))], schema=schema)

    return in_arrow(index, run, _HITS)


def find_items(docs: DataFrame, items: DataFrame, width: int = WINDOW, slop: int | None = None,
               block_terms: int = BLOCK_TERMS, segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """Of every row of ``docs`` (doc_id, text): doc_id, n_words, n_hit, spans, items.

    ``spans`` are the hit words' places (start, stop) in the document,
    ``items`` the ids of ``items`` (item_id, text) with a phrase in it.
    ``slop`` None: exact phrases; else proximity.
    """
    questions = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    length = F.length(F.coalesce("text", F.lit("")))
    total = questions.agg(F.coalesce(F.sum(length), F.lit(0))).first()[0]
    blocks = max(1, -(-total // (block_terms * 5)))
    per_document = []
    for block in range(blocks):
        chosen = questions if blocks == 1 else questions.where(
            F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        phrases = windows_of([(r["item_id"], r["text"]) for r in chosen.toLocalIterator()], width)
        terms = {w: k for k, w in enumerate(sorted({w for p in phrases for w in p}))}
        per_document.append(_search(build_index(docs, terms, segment_words), terms, phrases, slop))
    if blocks == 1:
        hits = per_document[0]
    else:  # the blocks' segments are cut alike, as they come from the same scan
        every = per_document[0]
        for other in per_document[1:]:
            every = every.unionByName(other)
        hits = every.groupBy("segment", "place", "doc_id", "n_words").agg(
            F.flatten(F.collect_list("spans")).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        hits = hits.withColumn("spans", _merged("spans"))
    covered = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return hits.select("doc_id", "n_words", covered.alias("n_hit"), "spans", "items")


def clean_only(docs: DataFrame, items: DataFrame, width: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` with no hit word, with the columns they came with.

    ``docs`` is read twice and must give the same rows in the same partitions
    each time, as the scan of a table does.
    """
    row = unused("__row", docs.columns)
    placed = docs.withColumn(row, F.monotonically_increasing_id())
    found = find_items(placed.select(F.col(row).alias("doc_id"), "text"), items, width)
    hit = found.where("n_hit > 0").select(F.col("doc_id").alias(row))
    return placed.join(hit, row, "left_anti").select(docs.columns)


def _merged(spans: str):
    """Overlapping and touching spans joined."""
    kind = "array<struct<start:long,stop:long>>"
    return F.aggregate(F.array_sort(spans), F.array().cast(kind), lambda done, s: F.when(
        (F.size(done) > 0) & (F.get(done, F.size(done) - 1)["stop"] >= s["start"]),
        F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
            F.get(done, F.size(done) - 1)["start"].alias("start"),
            F.greatest(F.get(done, F.size(done) - 1)["stop"], s["stop"]).alias("stop"))))).otherwise(
                F.concat(done, F.array(s))))
