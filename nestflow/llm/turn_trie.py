"""Prefix tries of conversations, as double arrays.

A conversation is its turns in order; two turns are the same if role and text
are (128-bit digests stand for them).  Every distinct sequence of a
conversation's first turns is a node, from the root of none on.

1. Conversations of the same turns are one, with their number and smallest
   id, so a conversation that many repeat is one row from there on.
2. Shards.  A conversation is cut at the smallest depth 1, 2, 4, ... at which
   at most ``SHARD`` distinct conversations share its beginning; all that
   share this beginning are in one shard.  So one first turn that a third of
   all conversations have makes many shards, not one.  A node at its cut or
   deeper lies in one shard; the nodes above are shared by shards.
3. Per shard (or several small ones together) the distinct turns get dense
   ids, in the order in which the trie meets them, and the trie is packed in
   two arrays: the child of the node in slot s by turn id t is in slot
   BASE[s] + t, if CHECK of that slot is s.  The shard's conversations are
   walked through these arrays and counted in the nodes they pass; the
   nodes' subtrees are summed from the deepest up.
4. The shared nodes' counts are added up over all shards, by digest of the
   beginning; their subtrees are summed by pointer doubling (each knows its
   ancestors at distance 1, 2, 4, ...), one join a round.

A null role or text is an empty one.  Turns are ordered by turn, null first,
then role and digest; rows that repeat are turns each.  Rows without a
conv_id belong to no conversation and are left out.  Other columns are not
read.  No conversations give no nodes.  A task holds of one conversation 24
bytes a turn, never the texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestflow.llm.common import batches, in_arrow, partitions, saved, text_or_empty

#: Distinct conversations of one shard; a trie holds several small shards, up to this many conversations and turns.
SHARD, TURNS = 20_000, 500_000
#: Free slots that are tried for a node's children before the arrays are made longer.
_TRIES = 32
#: Copies of the shared nodes in the join that tells others their parent.
_SALTS = 8
_ROOT = xxhash.xxh3_128_digest(b"")
_EMPTY = hashlib.sha256(b"").hexdigest()
_WIDTH = 16


def turn_lists(conversations: DataFrame) -> DataFrame:
    """conv_id, turns: of every conversation its turns in order, as digests (d1, d2) and number of words."""
    role, text = text_or_empty("role"), text_or_empty("text")
    said = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").alias("turn"), role.alias("role"), F.xxhash64(role, text).alias("d1"),
                 F.xxhash64(F.lit(1), role, text).alias("d2"),
                 F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words")).alias("t"))
    listed = said.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return listed.select("conv_id", F.transform("t", lambda t: F.struct(t["d1"].alias("d1"), t["d2"].alias("d2"), t["words"].alias("words"))).alias("turns"))


def shared_heads(lists: DataFrame, every: int, most: int, taken: Column) -> DataFrame:
    """Every conversation c with its first ``taken`` turns (at most ``most``) put in the place of those of conversation c - c % ``every``."""
    own = lists.withColumn("base", F.col("conv_id") - F.col("conv_id") % every)
    heads = lists.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("head"))
    joined = own.join(heads, "base", "left").withColumn("h", taken.cast("int"))
    head = F.when(F.col("head").isNull() | (F.col("h") == 0), F.slice("turns", 1, 0)).otherwise(F.slice("head", 1, F.greatest("h", F.lit(1))))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return joined.select("conv_id", F.concat(head, rest).alias("turns"))


def _longs(digest: bytes) -> tuple[int, int]:
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def _chain(codes: bytes, depth: int) -> Iterator[bytes]:
    """Digests of the first 1, 2, ... ``depth`` turns."""
    digest = _ROOT
    for k in range(0, _WIDTH * depth, _WIDTH):
        digest = xxhash.xxh3_128_digest(digest + codes[k:k + _WIDTH])
        yield digest


def _packed(lists: DataFrame) -> DataFrame:
    """conv_id, f1, f2 (digest of all turns), codes, words (arrays as bytes)."""
    schema = pa.schema([("conv_id", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("codes", pa.binary()), ("words", pa.binary())])

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in found:
                turns = batch.column(1)
                flat, ends = turns.flatten(), np.concatenate([[0], np.cumsum(turns.value_lengths().to_numpy())]).tolist()
                pairs = np.stack([flat.field(0).to_numpy(), flat.field(1).to_numpy()], axis=1).tobytes()
                words = flat.field(2).to_numpy().astype("<i8").tobytes()
                for conv_id, x, y in zip(batch.column(0).to_pylist(), ends, ends[1:]):
                    codes, digest = pairs[_WIDTH * x:_WIDTH * y], _ROOT
                    for digest in _chain(codes, y - x):
                        pass
                    yield conv_id, *_longs(digest), codes, words[8 * x:8 * y]

        yield from batches(rows(), schema)

    return in_arrow(lists.select("conv_id", "turns"), run, "conv_id long, f1 long, f2 long, codes binary, words binary")


def _beginnings(distinct: DataFrame) -> DataFrame:
    """f1, f2, depth, k1, k2: of every conversation the digests of its first 1, 2, 4, ... turns."""
    schema = pa.schema([(n, pa.int64()) for n in ("f1", "f2", "depth", "k1", "k2")])

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in found:
                for f1, f2, codes in zip(*(batch.column(k).to_pylist() for k in range(3))):
                    length = len(codes) // _WIDTH
                    for depth, digest in enumerate(_chain(codes, 1 << length.bit_length() >> 1), 1):
                        if not depth & (depth - 1):
                            yield f1, f2, depth, *_longs(digest)

        yield from batches(rows(), schema)

    return in_arrow(distinct.select("f1", "f2", "codes"), run, "f1 long, f2 long, depth long, k1 long, k2 long")


class DoubleArray:
    """A trie of sequences of positive ids in two arrays.

    Slot 0 is the root; the child of slot s by id t is slot base[s] + t if
    check[base[s] + t] is s.  Free slots have check -1.
    """

    def __init__(self) -> None:
        self.base, self.check = [0], [0]
        self._free = 1  # no free slot lies before

    def child(self, slot: int, code: int) -> int:
        """The slot of the child, or -1."""
        at = self.base[slot] + code
        return at if 0 < at < len(self.check) and self.check[at] == slot else -1

    def place(self, slot: int, codes: list[int]) -> list[int]:
        """Give the node its children, by ascending ids; their slots."""
        check, lowest, spread = self.check, codes[0], codes[-1] - codes[0]
        while self._free < len(check) and check[self._free] >= 0:
            self._free += 1
        at, tried = self._free, 0
        while at < len(check) and tried < _TRIES:
            if check[at] < 0:
                if all(at + c - lowest >= len(check) or check[at + c - lowest] < 0 for c in codes):
                    break
                tried += 1
            at += 1
        else:
            at = len(check)
        more = at + spread + 1 - len(check)
        if more > 0:
            check += [-1] * more
            self.base += [0] * more
        self.base[slot] = at - lowest
        slots = [at + c - lowest for c in codes]
        for x in slots:
            check[x] = slot
        return slots


class Trie:
    """The trie of distinct conversations (turn digests of ``_WIDTH`` bytes each, one after the other)."""

    def __init__(self, codes: list[bytes]) -> None:
        self.ids: dict[bytes, int] = {}
        self.arrays = DoubleArray()
        #: Of every node, in breadth-first order: slot, parent's number, depth, the first conversation that passes it.
        self.slots, self.parents, self.depths, self.firsts = [0], [-1], [0], [0]
        order = sorted(range(len(codes)), key=codes.__getitem__)
        spans = [(0, len(order))]
        for node, (x, y) in enumerate(spans):  # grows as children are found
            at = _WIDTH * self.depths[node]
            if x < y and len(codes[order[x]]) == at:
                x += 1  # it ends here
            found: list[tuple[int, int, int]] = []
            begin = x
            for k in range(x + 1, y + 1):
                turn = codes[order[begin]][at:at + _WIDTH]
                if k == y or codes[order[k]][at:at + _WIDTH] != turn:
                    found.append((self.ids.setdefault(turn, len(self.ids) + 1), begin, k))
                    begin = k
            if not found:
                continue
            found.sort()
            for slot, (_, begin, end) in zip(self.arrays.place(self.slots[node], [f[0] for f in found]), found):
                self.slots.append(slot)
                self.parents.append(node)
                self.depths.append(self.depths[node] + 1)
                self.firsts.append(order[begin])
                spans.append((begin, end))
        self.node_of = dict(zip(self.slots, range(len(self.slots))))

    def walk(self, codes: bytes) -> Iterator[int]:
        """The nodes that the conversation passes, the root first."""
        slot = 0
        yield 0
        for k in range(0, len(codes), _WIDTH):
            slot = self.arrays.child(slot, self.ids.get(codes[k:k + _WIDTH], 0))
            if slot < 0:
                return
            yield self.node_of[slot]


_NODES = pa.schema([(n, pa.int64()) for n in ("n1", "n2", "q1", "q2", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "words")]
                   + [("shared", pa.bool_()), ("jumps", pa.list_(pa.int64()))])
_NODES_SQL = ("n1 long, n2 long, q1 long, q2 long, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, "
              "n_leaves long, saved_tokens long, words long, shared boolean, jumps array<long>")


def _nodes(rows: list[tuple]) -> Iterator[tuple]:
    """Of the shard's conversations (codes, words, n, smallest id, cut) its nodes, as rows of ``_NODES``.

    A shared node's children are those that are not shared, its leaves and tokens theirs.
    """
    trie = Trie([r[0] for r in rows])
    size = len(trie.slots)
    n_convs, smallest = [0] * size, [None] * size
    for codes, _, n, least, _ in rows:
        for node in trie.walk(codes):
            n_convs[node] += n
            smallest[node] = least if smallest[node] is None else min(least, smallest[node])
    digests, words, shared = [_ROOT], [0], [True]
    for node in range(1, size):
        codes, counts, _, _, cut = rows[trie.firsts[node]]
        depth = trie.depths[node]
        digests.append(xxhash.xxh3_128_digest(digests[trie.parents[node]] + codes[_WIDTH * (depth - 1):_WIDTH * depth]))
        words.append(int.from_bytes(counts[8 * (depth - 1):8 * depth], "little"))
        shared.append(depth < cut)
    children, leaves, tokens = [0] * size, [0] * size, [0] * size
    for node in range(size - 1, -1, -1):
        if not shared[node]:
            leaves[node] += not children[node]
            tokens[node] += (n_convs[node] - 1) * words[node]
            up = trie.parents[node]
            children[up] += 1
            leaves[up] += leaves[node]
            tokens[up] += tokens[node]
    jumps: dict[int, list[int]] = {0: []}  # shared nodes' ancestors at distance 1, 2, 4, ...
    for node in range(size):
        up = trie.parents[node]
        if node and shared[node]:
            jumps[node] = [up]
            while len(jumps[jumps[node][-1]]) >= len(jumps[node]):
                jumps[node].append(jumps[jumps[node][-1]][len(jumps[node]) - 1])
        yield (*_longs(digests[node]), *(_longs(digests[up]) if node else (None, None)), trie.depths[node], smallest[node],
               smallest[up] if node and not shared[up] else None, n_convs[node], children[node], leaves[node], tokens[node], words[node],
               shared[node], [x for k in jumps[node] for x in _longs(digests[k])] if shared[node] else None)


def _tries(dealt: DataFrame) -> DataFrame:
    """Nodes of the conversations (k1, k2, codes, words, n, least, cut), whose shards lie together."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            held, size, last = [], 0, None
            for batch in found:
                for k1, k2, *row in zip(*(c.to_pylist() for c in batch.columns)):
                    if (k1, k2) != last and (len(held) >= SHARD or size >= TURNS):
                        yield from _nodes(held)
                        held, size = [], 0
                    held.append(row)
                    size += len(row[0]) // _WIDTH
                    last = k1, k2
            if held:
                yield from _nodes(held)

        for x in _chunks(rows()):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*x), _NODES)], schema=_NODES)

    return in_arrow(dealt, run, _NODES_SQL)


def _chunks(rows: Iterator[tuple], most: int = 5000) -> Iterator[list[tuple]]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield held
            held = []
    if held:
        yield held


#: Ids that one row of ``_ends`` holds at most: 2 to this power.
_IDS = 12


def _ends(packed: DataFrame) -> DataFrame:
    """n1, n2, ends_sha256 of the nodes where conversations end; their ids go through SHA-256 in order, a bounded piece at a time."""
    pieces = (packed.groupBy("f1", "f2", F.shiftright("conv_id", _IDS).alias("piece"))
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids")))
    dealt = pieces.repartition(partitions(packed.sparkSession), "f1", "f2").sortWithinPartitions("f1", "f2", "piece")
    schema = pa.schema([("n1", pa.int64()), ("n2", pa.int64()), ("ends_sha256", pa.string())])

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            last, digest = None, None
            for batch in found:
                for f1, f2, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist()):
                    if (f1, f2) != last:
                        if last:
                            yield *last, digest.hexdigest()
                        last, digest = (f1, f2), hashlib.sha256(ids.encode())
                    else:
                        digest.update(b"," + ids.encode())
            if last:
                yield *last, digest.hexdigest()

        yield from batches(rows(), schema)

    return in_arrow(dealt, run, "n1 long, n2 long, ends_sha256 string")


def _shared_nodes(nodes: DataFrame) -> DataFrame:
    """The shared nodes, each once, with the sums of their whole subtrees in place of those of their children that are not shared."""
    plain = [F.first(c).alias(c) for c in ("q1", "q2", "depth", "words", "jumps")]
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    top = saved(nodes.where("shared").groupBy("n1", "n2").agg(*plain, *sums, F.min("conv_id").alias("conv_id")), "shared-nodes")
    kids = top.where("q1 IS NOT NULL").groupBy(F.col("q1").alias("n1"), F.col("q2").alias("n2")).agg(F.count(F.lit(1)).alias("kids"))
    top = top.join(kids, ["n1", "n2"], "left").withColumn("n_children", F.col("n_children") + F.coalesce("kids", F.lit(0))).drop("kids")
    top = top.withColumns({"n_leaves": F.col("n_leaves") + (F.col("n_children") == 0).cast("long"),
                           "saved_tokens": F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words")})
    top = saved(top, "shared-nodes")
    deepest = top.agg(F.max("depth")).first()[0] or 0
    for k in range(deepest.bit_length()):
        below = top.where(F.size("jumps") > 2 * k).groupBy(F.col("jumps")[2 * k].alias("n1"), F.col("jumps")[2 * k + 1].alias("n2"))
        below = below.agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_tokens"))
        top = top.join(below, ["n1", "n2"], "left").withColumns({
            "n_leaves": F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0)),
            "saved_tokens": F.col("saved_tokens") + F.coalesce("more_tokens", F.lit(0))}).drop("more_leaves", "more_tokens")
        top = saved(top, "shared-nodes")
    return top


def prefix_nodes(lists: DataFrame, shard: int = SHARD) -> DataFrame:
    """The nodes of the trie of conversations (conv_id, each once; turns as of ``turn_lists``).

    conv_id (smallest member), depth, parent_conv_id (null: root), n_convs, n_children,
    n_leaves, saved_tokens (of the subtree: words of a node's last turn, once for each
    member but one), ends_sha256 (of the ids of the conversations that end there).
    """
    packed = saved(_packed(lists), "conversations")
    distinct = saved(packed.groupBy("f1", "f2").agg(F.first("codes").alias("codes"), F.first("words").alias("words"),
                                                    F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least")), "distinct-conversations")
    starts = saved(_beginnings(distinct), "beginnings")
    crowded = saved(starts.groupBy("k1", "k2").count().where(F.col("count") > shard).select("k1", "k2"), "crowded-beginnings")
    cuts = starts.join(crowded, ["k1", "k2"], "left_anti").groupBy("f1", "f2").agg(F.min(F.struct("depth", "k1", "k2")).alias("cut"))
    placed = distinct.join(cuts, ["f1", "f2"], "left").select(
        F.coalesce("cut.k1", "f1").alias("k1"), F.coalesce("cut.k2", "f2").alias("k2"), "codes", "words", "n", "least",
        F.coalesce("cut.depth", F.octet_length("codes") / _WIDTH + 1).cast("long").alias("cut"))
    dealt = placed.repartition(partitions(lists.sparkSession), "k1", "k2").sortWithinPartitions("k1", "k2")
    nodes = saved(_tries(dealt), "trie-nodes")
    top = _shared_nodes(nodes)
    columns = ["n1", "n2", "q1", "q2", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    inner = nodes.where("NOT shared AND parent_conv_id IS NOT NULL").select(*columns, "parent_conv_id")
    # The others' parents are shared nodes; one may have a large part of all nodes as children.
    salt = F.pmod(F.xxhash64("n1", "n2"), F.lit(_SALTS)).cast("long").alias("salt")
    outer = nodes.where("NOT shared AND parent_conv_id IS NULL").select(*columns, salt).unionByName(top.select(*columns, salt))
    names = top.select(F.col("n1").alias("q1"), F.col("n2").alias("q2"), F.col("conv_id").alias("parent_conv_id"),
                       F.explode(F.sequence(F.lit(0).cast("long"), F.lit(_SALTS - 1).cast("long"))).alias("salt"))
    below = outer.where("q1 IS NOT NULL").join(names, ["q1", "q2", "salt"]).select(*columns, "parent_conv_id")
    root = outer.where("q1 IS NULL").select(*columns, F.lit(None).cast("long").alias("parent_conv_id"))
    every = reduce(DataFrame.unionByName, [inner, below, root])
    return every.join(_ends(packed), ["n1", "n2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"))
