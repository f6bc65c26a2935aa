"""Near-duplicates by SimHash with anchor-point covering.

A text's words are its runs of characters other than U+0020, U+0009-000D
after A-Z are lower-cased; its features are all runs of ``SHINGLE`` words,
repeats included (a shorter text: all its words as one).  Bit k of its
fingerprint is 1 if more than half of the features' XXH64 (seed 42) have it.
Two fingerprints are linked if they differ in at most ``BITS`` = 2 bits.

1. Equal fingerprints are one, counted before anything is compared.
2. Anchors.  Of two linked fingerprints, one half (of 32 bits) differs in at
   most one bit.  In each half the anchors are the code words of the binary
   Hamming code of length 31 (the half's highest bit takes no part): a
   covering code, every word is at distance 1 or less from exactly one of
   them.  A fingerprint is sent to every anchor within the covering radius
   plus the half's threshold, 1 + 1 = 2: to the nearest one, its home, and,
   unless it is a code word itself, to 15 more.  Where x is at home, every y
   whose half differs from x's in one bit is at distance 2 or less, so they
   meet.
3. Per anchor, those at home are compared with all that were sent there, by
   the number of differing bits of the whole fingerprints.  Only a spanning
   forest of the links found leaves a task, at most one link a row.
   An anchor that gets more than ``CROWD`` rows (estimated on a part of the
   fingerprints, which decides the work and not the result) is split into
   tiles: its rows are dealt into parts, and every two parts meet in a task
   of their own.
4. Classes are the connected components of the links.

Null, empty and wordless texts have fingerprint zero, and are linked like any
other.  Rows that repeat are members each.  A null doc_id is a member but no
component id, unless the component has no other.  Columns beside doc_id and
text are not read.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestflow.llm.common import in_arrow, partitions, saved
from nestflow.llm.components import components

SHINGLE = 3
SEED = 42
BITS = 2
#: Rows of an anchor that are compared in one task; fingerprints are sampled one in ``SAMPLED`` to find larger ones.
CROWD, SAMPLED = 8192, 16
#: Cells of one numpy comparison.
_CELLS = 4_000_000


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """The text's 64-bit fingerprint."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    if len(words) <= width:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    begins = np.concatenate([[0], ends[:-width]]).tolist()
    digest = xxhash.xxh64_digest
    hashed = b"".join([digest(joined[x:y], SEED) for x, y in zip(begins, (ends[width - 1:] - 1).tolist())])
    features = np.frombuffer(hashed, np.uint8).reshape(-1, 8)
    often = np.zeros(64, dtype=np.int64)
    for k in range(0, len(features), 1 << 16):  # most significant byte and bit first
        often += np.unpackbits(features[k:k + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * often > len(features)).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """doc_id, print (long, the fingerprint's bits) of every row."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            prints = np.array([fingerprint(t.as_py(), width) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "print"])

    return in_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, print long")


#: For every syndrome the words that, added to a word with it, give a code word at distance 2 or less; the first gives the nearest.
def _corrections() -> np.ndarray:
    single = [0] + [1 << (p - 1) for p in range(1, 32)]
    table = np.zeros((32, 16), dtype=np.uint64)
    for s in range(1, 32):
        table[s] = [single[s]] + [single[i] | single[i ^ s] for i in range(1, 32) if i < i ^ s]
    return table


_CORRECTIONS = _corrections()
#: The code's parity checks: those positions 1 to 31 whose number has bit k.
_CHECKS = [np.uint64(sum(1 << (p - 1) for p in range(1, 32) if p >> k & 1)) for k in range(5)]


def anchors(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of fingerprints: place, anchor, whether it is the home; one entry for every anchor they are sent to."""
    places, keys, homes = [], [], []
    for half in (0, 1):
        word = (prints >> np.uint64(32 * half)) & np.uint64(0x7FFFFFFF)
        syndrome = np.zeros(len(word), dtype=np.int64)
        for k, check in enumerate(_CHECKS):
            syndrome |= (np.bitwise_count(word & check).astype(np.int64) & 1) << k
        near = word[:, None] ^ _CORRECTIONS[syndrome] | np.uint64(half << 31)
        wanted = np.broadcast_to(syndrome[:, None] > 0, near.shape).copy()
        wanted[:, 0] = True  # a code word has no other within distance 2
        at, column = np.nonzero(wanted)
        places.append(at)
        keys.append(near[at, column])
        homes.append(column == 0)
    return np.concatenate(places), np.concatenate(keys).view(np.int64), np.concatenate(homes)


def _sent(prints: DataFrame) -> DataFrame:
    """anchor, print, home: every fingerprint at every anchor it is sent to."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            own = batch.column(0).to_numpy()
            at, keys, homes = anchors(own.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(own[at]), pa.array(homes)], names=["anchor", "print", "home"])

    return in_arrow(prints, run, "anchor long, print long, home boolean")


def _forest(prints: np.ndarray, homes: np.ndarray, sides: np.ndarray | None, bits: int) -> tuple[list[int], list[int]]:
    """Links that join all of one anchor's fingerprints which links join; ``sides``: only those of unlike sides are compared."""
    order = np.argsort(~homes, kind="stable")  # those at home first
    own, home = prints[order].view(np.uint64), int(homes.sum())
    side = None if sides is None else sides[order]
    label = np.arange(len(own))
    a, b = [], []
    step = max(1, _CELLS // max(len(own), 1))
    for x in range(0, home, step):
        y = min(x + step, home)
        near = np.bitwise_count(own[x:y, None] ^ own[None, :]) <= bits
        if side is not None:
            near &= side[x:y, None] != side[None, :]
        for k in range(x, y):
            there = np.flatnonzero(near[k - x])
            new, first = np.unique(label[there], return_index=True)
            for old, z in zip(new.tolist(), there[first].tolist()):
                if old != label[k]:
                    label[label == old] = label[k]
                    a.append(k)
                    b.append(z)
    own = own.view(np.int64)
    return own[a].tolist(), own[b].tolist()


def _small(keys: np.ndarray, prints: np.ndarray, homes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside many anchors of few rows, whose rows lie together: each row with the k-th after it, for all k."""
    a, b = [], []
    active = np.arange(len(keys))
    step = 0
    while len(active):
        step += 1
        active = active[active + step < len(keys)]
        active = active[keys[active] == keys[active + step]]
        other = active + step
        near = (homes[active] | homes[other]) & (np.bitwise_count(prints[active].view(np.uint64) ^ prints[other].view(np.uint64)) <= bits)
        a.append(prints[active[near]])
        b.append(prints[other[near]])
    return (np.concatenate(a), np.concatenate(b)) if a else (np.empty(0, np.int64),) * 2


def _met(rows: DataFrame, bits: int) -> DataFrame:
    """Links (a, b) between the rows (anchor, print, home, i, j, part) that lie together."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def joined(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
            return [np.concatenate(c) for c in zip(*parts)]

        def links(columns: list[np.ndarray], begins: np.ndarray, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
            keys, prints, homes, i, j, part = columns
            large = np.flatnonzero(ends - begins > 64)
            few = np.ones(len(keys), dtype=bool)
            a, b = [], []
            for x, y in zip(begins[large].tolist(), ends[large].tolist()):
                few[x:y] = False
                sides = part[x:y] if i[x] != j[x] else None
                u, v = _forest(prints[x:y], homes[x:y], sides, bits)
                a.append(np.array(u, dtype=np.int64))
                b.append(np.array(v, dtype=np.int64))
            # A small tile's rows of one part may meet here too; that finds a link twice, never a wrong one.
            tile = np.repeat(np.arange(len(begins)), ends - begins)
            u, v = _small(tile[few], prints[few], homes[few], bits)
            a, b = np.concatenate([*a, u]), np.concatenate([*b, v])
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        held: list[list[np.ndarray]] = []
        for batch in found:
            if not batch.num_rows:
                continue
            held.append([batch.column(k).to_numpy(zero_copy_only=False) for k in range(6)])
            last = [held[-1][k][-1] for k in (0, 3, 4)]
            if all(held[0][k][0] == x for k, x in zip((0, 3, 4), last)):
                continue  # one tile so far
            columns = joined(held)
            changes = np.flatnonzero(np.any([np.diff(columns[k]) != 0 for k in (0, 3, 4)], axis=0)) + 1
            bounds = np.concatenate([[0], changes])
            yield from links([c[:bounds[-1]] for c in columns], bounds[:-1], bounds[1:])
            held = [[c[bounds[-1]:] for c in columns]]
        if held:
            columns = joined(held)
            yield from links(columns, np.array([0]), np.array([len(columns[0])]))

    return in_arrow(rows, run, "a long, b long")


def link_prints(prints: DataFrame, bits: int = BITS, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) that join all fingerprints (``print``, all different) which differ in ``bits`` bits or less, 2 at most."""
    if not 0 <= bits <= 2:
        raise ValueError("a half that differs in one bit or less is sure for 2 bits at most")
    spark = prints.sparkSession
    part = prints.where(F.pmod(F.xxhash64("print"), F.lit(SAMPLED)) == 0)
    crowds = (_sent(part).groupBy("anchor").count().where(F.col("count") * SAMPLED > crowd)
              .select("anchor", F.ceil(F.col("count") * 2 * SAMPLED / crowd).cast("int").alias("parts")))
    crowds = saved(crowds, "anchor-crowds")
    rows = _sent(prints).join(crowds, "anchor", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("print", F.lit(1)), "parts").cast("int"))
    tiled = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    tiled = tiled.select("anchor", "print", "home", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part")
    dealt = tiled.repartition(partitions(spark), "anchor", "i", "j").sortWithinPartitions("anchor", "i", "j")
    return _met(dealt, bits)


def classes(docs: DataFrame, width: int = SHINGLE, bits: int = BITS, crowd: int = CROWD) -> DataFrame:
    """doc_id, print, component_id (the smallest doc_id of the component) of every row of ``docs`` (doc_id, text)."""
    signed = saved(fingerprints(docs, width), "prints")
    heads = saved(signed.groupBy("print").agg(F.min("doc_id").alias("least")), "print-heads")
    roots = components(saved(link_prints(heads.select("print"), bits, crowd), "print-links"))
    grouped = heads.join(roots.withColumnRenamed("node", "print"), "print", "left").select(
        "print", "least", F.coalesce("root", "print").alias("root"))
    grouped = saved(grouped, "print-roots")
    least = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    named = saved(grouped.join(least, "root").select("print", "component_id"), "print-components")
    return signed.join(named, "print").select("doc_id", "print", "component_id")
