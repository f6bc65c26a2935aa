"""Near-duplicates by ProbMinHash on weighted word shingles.

A text's features are its runs of ``SHINGLE`` words (a shorter text: all its
words as one), weighted by how often they occur.  Two texts are linked if
their probability Jaccard similarity is at least ``SIMILARITY``; for texts
that repeat no shingle that is the plain Jaccard similarity.

1. Texts with equal words are one class; its smallest row stands for it.
2. ProbMinHash: each feature is a Poisson process whose rate is its weight,
   seeded by its hash; an arrival falls on one of ``REGISTERS`` registers,
   and a register keeps the feature that arrives first.  A feature is
   dropped when its next arrival is later than every register's (early
   termination).  Two texts agree in a register with the probability of
   their similarity.
3. Banding: ``BANDS`` bands of registers; texts that agree in a band are
   candidates.  In a band's bucket each member is compared with the smallest
   one, and classes are formed.  Members that are then still of another class
   than their representative are compared with the bucket's members of other
   classes, so no two classes stay apart because of a bad representative, and
   a bucket of n copies takes n comparisons, not n * n.
   The latter happens in tiles of bounded size inside the bucket: pairs that
   agree in fewer registers than a pair at the threshold does but once in ten
   million times (four bits a register tell) are passed over, the others are
   verified where they meet, and only links leave the task.
4. Verification: the exact similarity of the candidates' shingles.
5. Classes: connected components of the links; the class id is the smallest
   doc_id (ties: the smallest row) in it.

At 25 bands of 5 registers a pair of similarity 0.8 is missed with
probability 5e-5, one of 0.85 with 1e-6.

Words are as in ``decontaminate``.  Null, empty and wordless texts have no
features and are classes of their own each.  Rows are told apart by their
place in the input, so repeated rows and null or repeated doc_ids are
members like any others.  Columns beside doc_id and text are not read.  An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestflow.llm.common import batches, in_arrow, partitions, saved, unused
from nestflow.llm.components import components
from nestflow.llm.counters import POSITIONS, Counts, positions
from nestflow.llm.decontaminate import words_of

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 25, 5
REGISTERS = BANDS * ROWS

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix (the public splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    """64-bit hashes of words, made at first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = own = xxhash.xxh3_64_intdigest(word)
        return own


class Shingles:
    """Hashed shingles of texts; a process keeps the hashes of words it has met, up to a bound."""

    MOST = 300_000

    def __init__(self, width: int = SHINGLE) -> None:
        self.width, self.known = width, _Words()

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray, tuple[int, int] | None]:
        """Distinct shingle hashes (ascending), their counts, and a 128-bit digest of the words."""
        words = words_of(text)
        if not words:
            return np.empty(0, np.uint64), np.empty(0, np.int64), None
        known = self.known
        if len(known) > self.MOST:
            known.clear()
        coded = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        place = np.arange(1, len(words) + 1, dtype=np.uint64)
        digest = tuple(int(np.bitwise_xor.reduce(_mixed(coded + place * _GOLD + np.uint64(salt))) >> np.uint64(1)) for salt in (1, 2))
        width = min(self.width, len(words))
        mixed = np.zeros(len(words) - width + 1, dtype=np.uint64)
        for k in range(width):
            mixed = _mixed(mixed * np.uint64(31) + coded[k:len(words) - width + 1 + k])
        distinct, counts = np.unique(mixed, return_counts=True)
        return distinct, counts, digest


def signatures(features: list[tuple[np.ndarray, np.ndarray]], registers: int = REGISTERS) -> np.ndarray:
    """ProbMinHash signatures (one row a set) of several weighted sets at once; each set has a feature."""
    sets = len(features)
    who = np.repeat(np.arange(sets), [len(f) for f, _ in features])
    hashes = np.concatenate([f for f, _ in features])
    rates = np.concatenate([c for _, c in features]).astype(np.float64)
    first = np.full(sets * registers, np.inf)
    winner = np.zeros(sets * registers, dtype=np.uint64)
    clock = np.zeros(len(hashes))
    active = np.arange(len(hashes))
    step = 0
    while len(active):
        step += 1
        drawn = _mixed(hashes[active] + np.uint64(step * int(_GOLD) % 2 ** 64))
        # 53 random bits for the waiting time, others for the register.
        uniform = ((drawn >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0 ** 53
        clock[active] += -np.log(uniform) / rates[active]
        register = (_mixed(drawn ^ _GOLD) % np.uint64(registers)).astype(np.int64)
        cell = who[active] * registers + register
        # Earliest arrival of each cell so far; those of this step that are it, ties by hash.
        before = first.copy()
        np.minimum.at(first, cell, clock[active])
        lead = np.flatnonzero((clock[active] == first[cell]) & (clock[active] < before[cell]))
        lead = lead[np.argsort(hashes[active[lead]])[::-1]]
        winner[cell[lead]] = hashes[active[lead]]
        latest = first.reshape(sets, registers).max(axis=1)
        active = active[clock[active] < latest[who[active]]]
    return winner.reshape(sets, registers)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard similarity of two weighted sets (ascending hashes, weights).

    The sum over common i of 1 / sum over j of max(a_j / a_i, b_j / b_i).
    """
    common, at_a, at_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    x, y = a[1][at_a].astype(np.float64), b[1][at_b].astype(np.float64)
    only_a, only_b = float(a[1].sum()) - x.sum(), float(b[1].sum()) - y.sum()
    if (x == y).all():  # then every term is x_i over one and the same sum
        return float(x.sum() / (x.sum() + only_a + only_b))
    order = np.argsort(-(x / y), kind="stable")
    x, y = x[order], y[order]
    # With j sorted by falling a_j / b_j: up to i (and equal ratios) the first term is the larger.
    sums = (np.cumsum(x) + only_a) / x + (y.sum() - np.cumsum(y) + only_b) / y
    return float((1 / sums).sum())


def similarities(a: tuple[np.ndarray, np.ndarray], hashes: np.ndarray, counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``similarity`` of one set with each of several sets, which lie one after the other."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    at = np.minimum(np.searchsorted(a[0], hashes), len(a[0]) - 1)
    hit = a[0][at] == hashes
    own, x, y = owner[hit], a[1][at[hit]].astype(np.float64), counts[hit].astype(np.float64)
    sum_x, sum_y = (np.bincount(own, v, len(sizes)) for v in (x, y))
    only_a, only_b = a[1].sum() - sum_x, np.bincount(owner, counts, len(sizes)) - sum_y
    if (x == y).all():
        return sum_x / (sum_x + only_a + only_b)
    order = np.lexsort((-(x / y), own))
    own, x, y = own[order], x[order], y[order]
    begins = np.searchsorted(own, np.arange(len(sizes)))
    upto_x, upto_y = ((c := np.concatenate([[0.0], np.cumsum(v)]))[1:] - c[begins][own] for v in (x, y))
    sums = (upto_x + only_a[own]) / x + (sum_y[own] - upto_y + only_b[own]) / y
    return np.bincount(own, 1 / sums, len(sizes))


#: Texts whose signatures a task keeps for copies of them.
KEPT = 20_000
_SIGNED = "row long, doc_id long, d1 long, d2 long, bands array<long>, marks array<long>"
#: Registers are kept as marks of four bits, sixteen a word, for ``agreeing``.
_WORDS = -(-REGISTERS // 16)
_LOWEST = np.uint64(0x1111111111111111)


def marks(winners: np.ndarray) -> np.ndarray:
    """The lowest four bits of every register; one row of words a signature."""
    padded = np.zeros((len(winners), _WORDS * 16), dtype=np.uint64)
    padded[:, :REGISTERS] = winners & np.uint64(15)
    return (padded.reshape(len(winners), _WORDS, 16) << (4 * np.arange(16, dtype=np.uint64))).sum(axis=2, dtype=np.uint64).view(np.int64)


def agreeing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In how many registers rows of marks agree, by chance ones included."""
    unlike = (a ^ b).view(np.uint64)
    for shift in (1, 2):  # any of a mark's four bits reaches its lowest one
        unlike = unlike | unlike >> np.uint64(shift)
    return REGISTERS - np.bitwise_count(unlike & _LOWEST).sum(axis=-1, dtype=np.int64)


def least_agreeing(threshold: float) -> int:
    """Registers in which two texts of similarity ``threshold`` agree but for one pair in ten million."""
    missed = 0.0
    for k in range(REGISTERS + 1):
        missed += comb(REGISTERS, k) * threshold ** k * (1 - threshold) ** (REGISTERS - k)
        if missed > 1e-7:
            return k
    return REGISTERS


def _signed(rows: DataFrame, width: int) -> DataFrame:
    """Of every row its class digest, its bands' hashes and its registers' marks."""
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()),
                        ("bands", pa.list_(pa.int64())), ("marks", pa.list_(pa.int64()))])
    kept = KEPT

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(width)
        known: dict[tuple[int, int], tuple[list[int], list[int]]] = {}

        def ended(held: list) -> Iterator[pa.RecordBatch]:
            if len(known) > kept:  # before it is told which are new, as all of ``held`` are looked up
                known.clear()
            new = {digest: (f, c) for _, _, f, c, digest in held if digest and digest not in known}
            if new:
                drawn = signatures(list(new.values()))
                winners = drawn.reshape(len(new), BANDS, ROWS)
                folded = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64) * _GOLD, (len(new), 1))
                for k in range(ROWS):
                    folded = _mixed(folded * np.uint64(31) + winners[:, :, k])
                known.update(zip(new, zip(folded.view(np.int64).tolist(), marks(drawn).tolist())))
            out = [(row, doc_id, *(digest or (None, None)), *(known[digest] if digest else (None, None))) for row, doc_id, _, _, digest in held]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

        for batch in found:
            held, size = [], 0
            for row, doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                held.append((row, doc_id, *shingles.of(text.as_py())))
                size += len(held[-1][2])
                if size >= 200_000:
                    yield from ended(held)
                    held, size = [], 0
            if held:
                yield from ended(held)

    return in_arrow(rows, run, _SIGNED)


def _sets(wanted: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """Shingles of the texts of the ``wanted`` rows; no other text is shuffled."""
    def shingle(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(width)
        schema = pa.schema([("row", pa.int64()), ("hashes", pa.binary()), ("counts", pa.binary())])

        def rows():
            for batch in found:
                for row, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    hashes, counts, _ = shingles.of(text.as_py())
                    # Mostly no shingle repeats: an empty list of counts says so.
                    yield row, hashes.tobytes(), b"" if (counts == 1).all() else counts.astype("<i8").tobytes()

        yield from batches(rows(), schema)

    wanted = saved(wanted, "wanted")

    def marked(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from positions((_mixed(batch.column(0).to_numpy().view(np.uint64)) for batch in found if batch.num_rows), WANTED)

    # Rows that are surely not wanted stay where they are; the join tells the others apart.
    bits = texts.sparkSession.sparkContext.broadcast(Counts(in_arrow(wanted, marked, POSITIONS), WANTED, 1))

    def likely(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            yield batch.filter(pa.array(bits.value.of(_mixed(batch.column(0).to_numpy().view(np.uint64))) > 0))

    near = in_arrow(texts.select("row", "text"), likely, "row long, text string")
    sets = in_arrow(near.join(wanted, "row", "left_semi").select("row", "text"), shingle, "row long, hashes binary, counts binary")
    return saved(sets, "shingles")


def _weighted(hashes: pa.Scalar, counts: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    h, c = np.frombuffer(hashes.as_buffer(), np.uint64), np.frombuffer(counts.as_buffer(), "<i8")
    return h, c if len(c) else np.ones(len(h), dtype=np.int64)


def _verified(pairs: DataFrame, texts: DataFrame, width: int, threshold: float) -> DataFrame:
    """``pairs`` (a, b) with ``same``: whether the texts of the two rows are similar enough."""
    sets = _sets(pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct(), texts, width)

    def side(name: str) -> DataFrame:
        return sets.select(F.col("row").alias(name), F.col("hashes").alias(f"h{name}"), F.col("counts").alias(f"c{name}"))

    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ha", "ca", "hb", "cb")

    def compare(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            same = [similarity(_weighted(ha, ca), _weighted(hb, cb)) >= threshold - 1e-12
                    for ha, ca, hb, cb in zip(*(batch.column(k) for k in range(2, 6)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(same, pa.bool_())], names=["a", "b", "same"])

    return in_arrow(both, compare, "a long, b long, same boolean")


#: Bits that tell which rows' texts are wanted.
WANTED = 1 << 26
#: Shingles of one part of a bucket; a task holds two parts at a time.
PART = 150_000


def _between_classes(crowd: DataFrame, heads: DataFrame, texts: DataFrame, width: int, threshold: float) -> DataFrame:
    """Links (a, b) between members of one bucket that are of different classes.

    ``crowd``: bucket, band, head, rep, of_head, of_rep; the representative is
    no row of its own, it has met them all.  A bucket's members are split into
    parts of bounded size; two parts meet in one tile, whichever task that is in.
    Inside a tile every stranger is compared with all others at once, so no
    pairs but the links are made.
    """
    crowd = saved(crowd, "crowd")
    sets = _sets(crowd.select(F.col("head").alias("row")).distinct(), texts, width)
    sized = crowd.join(sets.select(F.col("row").alias("head"), (F.octet_length("hashes") / 8).alias("size")), "head")
    parts = sized.groupBy("bucket").agg(F.ceil(F.sum("size") / PART).cast("int").alias("parts"))
    placed = crowd.join(parts, "bucket").withColumn("part", F.pmod(F.xxhash64("head"), F.col("parts")).cast("int"))
    tiled = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    tiled = tiled.select("bucket", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "band", "head", "of_head",
                         (F.col("of_head") != F.col("of_rep")).alias("stranger"))
    full = tiled.join(sets.withColumnRenamed("row", "head"), "head").join(heads.select("head", "bands", "marks"), "head")
    dealt = full.select("bucket", "i", "j", "part", "band", "head", "of_head", "stranger", "hashes", "counts", "bands", "marks")
    dealt = dealt.repartition(partitions(crowd.sparkSession), "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    least = least_agreeing(threshold)

    def met(rows: pa.Table) -> tuple[list[np.ndarray], list[np.ndarray]]:
        i, j, band = (rows.column(k)[0].as_py() for k in ("i", "j", "band"))
        part, head, kind = (rows.column(k).to_numpy() for k in ("part", "head", "of_head"))
        stranger = np.array(rows.column("stranger").to_pylist(), dtype=bool)
        bands, drawn = (rows.column(k).combine_chunks().flatten().to_numpy().reshape(len(head), -1) for k in ("bands", "marks"))
        sets = [_weighted(h, c) for h, c in zip(rows.column("hashes"), rows.column("counts"))]
        sizes = np.array([len(h) for h, _ in sets])
        flat, counts = np.concatenate([h for h, _ in sets]), np.concatenate([c for _, c in sets])
        begins = np.cumsum(sizes) - sizes
        place = np.arange(len(head))
        found: tuple[list, list] = ([], [])
        for x in np.flatnonzero(stranger).tolist():
            # Two strangers meet once; a pair that an earlier band has too meets there.
            turn = ~stranger | (place > x if i == j else part[x] == i)
            with_x = np.flatnonzero(turn & (kind != kind[x]) & ((i == j) | (part != part[x])))
            with_x = with_x[~(bands[with_x, :band] == bands[x, :band]).any(axis=1)]
            with_x = with_x[agreeing(drawn[with_x], drawn[x]) >= least]
            if not len(with_x):
                continue
            many = sizes[with_x]
            at = np.repeat(begins[with_x] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
            near = with_x[similarities(sets[x], flat[at], counts[at], many) >= threshold - 1e-12]
            found[0].append(np.minimum(head[near], head[x]))
            found[1].append(np.maximum(head[near], head[x]))
        return found

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def ended() -> Iterator[pa.RecordBatch]:
            a, b = met(pa.Table.from_batches(held))
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

        last = None
        for batch in found:
            if not batch.num_rows:
                continue
            keys = [batch.column(k).to_numpy() for k in range(3)]
            cuts = np.flatnonzero(np.any([np.diff(k) != 0 for k in keys], axis=0)) + 1
            for x, y in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                key = tuple(int(k[x]) for k in keys)
                if held and key != last:
                    yield from ended()
                    held = []
                held.append(batch.slice(x, y - x))
                last = key
        if held:
            yield from ended()

    return in_arrow(dealt, run, "a long, b long")


def classes(docs: DataFrame, width: int = SHINGLE, threshold: float = SIMILARITY) -> DataFrame:
    """Of every row of ``docs`` (doc_id, text): row, doc_id, class_row, class_id.

    ``row`` is the row's place in the scan; ``class_id`` the doc_id of the
    class's first row (smallest doc_id, null last, then smallest place).
    ``docs`` is read several times and must give the same rows in the same
    partitions each time, as the scan of a table does.
    """
    placed = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = saved(_signed(placed, width), "signed")
    # One row stands for all texts of the same words; counted before anything is shuffled.
    heads = saved(signed.where("d1 IS NOT NULL").groupBy("d1", "d2").agg(F.min("row").alias("head"), F.first("bands").alias("bands"), F.first("marks").alias("marks")), "heads")
    # A bucket's hash has its band's number mixed in.
    members = heads.select("head", F.posexplode("bands").alias("band", "bucket"))
    buckets = members.groupBy("bucket").agg(F.min("head").alias("rep"), F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket", "rep")
    starred = saved(members.join(buckets, "bucket").where("head <> rep"), "starred")
    first = saved(_verified(starred.select(F.col("rep").alias("a"), F.col("head").alias("b")).distinct(), placed, width, threshold), "verified")
    links = first.where("same").select("a", "b")
    roots = components(links)
    # Members that are still of another class than their bucket's representative meet the bucket's other classes.
    def rooted(df: DataFrame, node: str, root: str) -> DataFrame:
        return (df.join(roots.select(F.col("node").alias(node), F.col("root").alias("__root")), node, "left")
                .withColumn(root, F.coalesce("__root", node)).drop("__root"))

    classed = saved(rooted(rooted(starred, "head", "of_head"), "rep", "of_rep"), "classed")
    strange = classed.where("of_head <> of_rep").select("bucket").distinct()
    more = saved(_between_classes(classed.join(strange, "bucket", "left_semi"), heads, placed, width, threshold), "between")
    if more.limit(1).count():
        roots = components(links.unionByName(more))
    joined = (signed.select("row", "doc_id", "d1", "d2").join(heads.select("d1", "d2", "head"), ["d1", "d2"], "left")
              .select("row", "doc_id", F.coalesce("head", "row").alias("head"))
              .join(roots.select(F.col("node").alias("head"), "root"), "head", "left")
              .select("row", "doc_id", F.coalesce("root", "head").alias("group")))
    joined = saved(joined, "grouped")
    least = joined.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("m"))
    return joined.join(least, "group").select("row", "doc_id", F.col("m.row").alias("class_row"), F.col("m.doc_id").alias("class_id"))


def one_of_each(docs: DataFrame, width: int = SHINGLE, threshold: float = SIMILARITY) -> DataFrame:
    """``docs`` with only the first row of each class (all columns, as they were)."""
    found = classes(docs, width, threshold)
    row = unused("__row", docs.columns)
    kept = found.where("row = class_row").select(F.col("row").alias(row))
    return docs.withColumn(row, F.monotonically_increasing_id()).join(kept, row, "left_semi").select(docs.columns)
