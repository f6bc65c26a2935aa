"""Ranked search, SimHash and conversation tries against brute force, with nulls, empty texts, ties, repeated rows, empty tables and extra columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from nestflow.llm import ranked_search, simhash, turn_trie

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def some_docs():
    r = random.Random(5)
    words = ["the", "in", "Of"] + [f"w{k}" for k in range(40)]

    def text(n):
        return " ".join(r.choice(words[:3]) if r.random() < .5 else r.choice(words) for _ in range(n))

    docs = [(k if k % 37 else None, r.choice([None, "", "!!", text(r.randint(1, 60)), text(5)])) for k in range(600)]
    items = [(1, text(8)), (1, text(8)), (None, "w1 W2 the"), (3, None), (4, "zzz"), (5, text(80)), (6, "é the_in x")]
    return docs + [(7, "the the in")] * 5 + [(9, "É the " * 40_000)], items


def brute_ranks(docs, items, limit):
    found = [(d, Counter(w), len(w)) for d, t in docs if (w := TERM.findall((t or "").translate(LOWER)))]
    many, total = len(found), sum(f[2] for f in found)
    df = Counter(x for f in found for x in f[1])
    out = []
    for item_id, text in items:
        scores = []
        for place, (d, tf, n) in enumerate(found):
            m = 100 - 50 + (50 * n * many) // total
            score = sum(math.floor(1000 * math.log((2 * many + 2) / (2 * df[t] + 1))) * ((1000000000 * tf[t]) // (1000 * tf[t] + 20 * m))
                        for t in set(TERM.findall((text or "").translate(LOWER))) if tf[t])
            if score > 0:
                scores.append((-score, d is None, d or 0, place))
        out += [(item_id, rank, None if x[1] else x[2], -x[0]) for rank, x in enumerate(sorted(scores)[:limit], 1)]
    return out


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, x or 0) for x in r))


@pytest.mark.parametrize("limit,block_terms", [(50, 200_000), (3, 10)])
def test_ranked_search(spark, limit, block_terms):
    docs, items = some_docs()
    frame = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, item_id int, score string")
    asked = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, doc_id int")
    got = ranked_search.rank(frame, asked, limit, block_terms).collect()
    assert in_order(got) == in_order(brute_ranks(docs, items, limit))
    if limit == 3:
        assert ranked_search.rank(frame.limit(0), asked).count() == ranked_search.rank(frame, asked.limit(0)).count() == 0


def test_pair_bounds(monkeypatch):
    """Bounds hold for every document, pairs tighten them, and the best documents are those of the plain sums."""
    monkeypatch.setattr(ranked_search, "BLOCK", 16)
    r = np.random.default_rng(1)
    many, n_terms = 400, 12
    tf = np.where(r.random((many, n_terms)) < np.linspace(.7, .05, n_terms), r.integers(1, 5, (many, n_terms)), 0)
    tf[:, 1] *= tf[:, 0] == 0  # the first two terms never meet
    stats = ranked_search.Statistics(many, int(tf.sum()), (tf > 0).sum(axis=0))
    n = np.maximum(tf.sum(axis=1), 1).tolist()
    terms = [np.flatnonzero(row).astype("<i4").tobytes() for row in tf]
    often = [row[row > 0].astype("<i4").tobytes() for row in tf]
    row = ranked_search.segment_row(0, list(range(many)), n, terms, often, stats, stats.weights(), list(range(8)))
    lengths = stats.lengths(np.array(n))
    impacts = np.stack([ranked_search._impacts(int(w), tf[:, k], lengths) for k, w in enumerate(stats.weights())], axis=1)
    paired, plain = (ranked_search.Segment(row, stats.weights(), pairs) for pairs in (True, False))
    order = list(range(n_terms))
    left = paired.bounds(order)
    assert left[0].sum() < plain.bounds(order)[0].sum()
    for i in order:
        assert (impacts[:, i:].sum(axis=1) <= left[i][np.arange(many) // 16]).all()
    for query in ([0, 1, 11], order, [5], [2, 3, 4, 5, 6, 7, 10]):
        scores = impacts[:, query].sum(axis=1)
        want = sorted((-s, d) for d, s in enumerate(scores.tolist()) if s > 0)[:10]
        for segment in (paired, plain):
            assert segment.best(list(query), 10) == [(d, -s) for s, d in want]
            assert segment.best(list(query), 10, -want[4][0]) == [(d, -s) for s, d in want if s <= want[4][0]]
    assert paired.touched <= plain.touched


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k:k + 3]).encode(), 42) for k in range(max(len(words) - 2, min(len(words), 1)))]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def roots_of(links, nodes):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def test_fingerprints():
    for text in ("", None, " \n", "A", "a B", "a b c", "A b c d é È\x0bk\x85m n", " ".join(map(str, range(300))), "x y " * 70_000):
        assert simhash.fingerprint(text) == plain_print(text)


def test_covering_code():
    """Every word is at distance 1 or less from its home, and is sent to exactly the code words at distance 2 or less."""
    r = np.random.default_rng(2)
    words = np.concatenate([r.integers(0, 1 << 63, 200, dtype=np.uint64) * np.uint64(2), np.zeros(1, np.uint64)])
    places, keys, homes = simhash.anchors(words)
    for half in (0, 1):
        own = (keys.view(np.uint64) >> np.uint64(31)) == half
        code = keys[own].view(np.uint64) & np.uint64(0x7FFFFFFF)
        apart = np.bitwise_count(code ^ ((words[places[own]] >> np.uint64(32 * half)) & np.uint64(0x7FFFFFFF)))
        assert (apart[homes[own]] <= 1).all() and (apart <= 2).all() and homes[own].sum() == len(words)
        assert set(np.bincount(places[own]).tolist()) <= {1, 16}
        assert len(set(zip(places[own].tolist(), code.tolist()))) == int(own.sum())


def test_links_of_planted_prints(spark):
    r = random.Random(1)
    prints = set()
    for _ in range(150):
        x = r.getrandbits(64)
        prints.add(x)
        for _ in range(r.randint(0, 12)):
            for _ in range(r.randint(1, 3)):
                x ^= 1 << r.randrange(64)
            prints.add(x)
    center = r.getrandbits(64)  # a crowd about one anchor
    prints |= {center ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(8)}
    found = np.array(sorted(prints), dtype=np.uint64)
    links = [(signed(int(x)), signed(int(y))) for k, x in enumerate(found) for y in found[k + 1:][np.bitwise_count(x ^ found[k + 1:]) <= 2]]
    nodes = [signed(int(x)) for x in found]
    frame = spark.createDataFrame([(x,) for x in nodes], "print long")
    for crowd in (8192, 64):
        got = [tuple(x) for x in simhash.link_prints(frame, 2, crowd).collect()]
        assert {tuple(sorted(x)) for x in got} <= {tuple(sorted(x)) for x in links}
        assert roots_of(got, nodes) == roots_of(links, nodes)
    with pytest.raises(ValueError):
        simhash.link_prints(frame, 3)


def test_simhash_classes(spark):
    r = random.Random(4)
    base = [" ".join(f"v{r.randrange(4000)}" for _ in range(200)) for _ in range(30)]
    texts = [*base, *(t.replace(" ", "\t", 3).upper() for t in base[:10]), *(" ".join(t.split()[:-1]) for t in base), None, "", "\n", "one", "one two"]
    docs = [(k if k % 11 else None, t) for k, t in enumerate(texts)] + [(3, base[3]), (2, None)]
    frame = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, print int, root string")
    prints = [plain_print(t) for _, t in docs]
    links = [(i, j) for i in range(len(docs)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    members = defaultdict(list)
    for k, root in roots_of(links, range(len(docs))).items():
        members[root].append(k)
    want = [(docs[k][0], signed(prints[k]), min((docs[i][0] for i in group if docs[i][0] is not None), default=None)) for group in members.values() for k in group]
    assert in_order(simhash.classes(frame).collect()) == in_order(want)
    assert simhash.classes(frame.limit(0)).count() == 0


def brute_nodes(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    built = {c: turns.get(c - c % 20, [])[:(h := zlib.crc32(str(c).encode()) % 4)] + v[h:] for c, v in turns.items()}
    members, kids, leaves, saved = defaultdict(list), Counter(), Counter(), Counter()
    for c, v in built.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    for key in members:
        if key:
            kids[key[:-1]] += 1
    for key, convs in members.items():
        for d in range(len(key) + 1):
            leaves[key[:d]] += not kids[key]
            saved[key[:d]] += (len(convs) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", key[-1][1])) if key else 0
    return [(min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k],
             hashlib.sha256(",".join(str(c) for c in sorted(m) if len(built[c]) == len(k)).encode()).hexdigest()) for k, m in members.items()]


def test_prefix_nodes(spark):
    r = random.Random(3)
    rows = []
    for conv in [*range(90), 107, 108, 109, 5003, *range(8180, 8230)]:
        for turn in range(r.choice([0, 1, 1, 2, 3, 4, 9])):
            rows.append((conv, turn if r.random() < .95 else None, r.choice(["user", "assistant", None]), r.choice(["a b", "x", None, "a  b c"]) if turn else "sys p"))
    rows += rows[:3] + [(400, 0, "user", "long " * 50_000), (441, 5, None, None)]
    frame = spark.createDataFrame([(*x, 1, "k") for x in [*rows, (None, 1, "user", "lost")]], "conv_id long, turn long, role string, text string, depth int, turns string")
    lists = turn_trie.shared_heads(turn_trie.turn_lists(frame), 20, 3, F.crc32(F.col("conv_id").cast("string")) % 4)
    want = in_order(brute_nodes(rows))
    for shard in (turn_trie.SHARD, 4, 1):
        assert in_order(turn_trie.prefix_nodes(lists, shard).collect()) == want
    assert turn_trie.prefix_nodes(turn_trie.turn_lists(frame.limit(0))).count() == 0


def test_double_array():
    r = random.Random(6)
    sequences = {tuple(r.randrange(12) for _ in range(r.randrange(7))) for _ in range(400)}
    codes = [b"".join(x.to_bytes(16, "big") for x in s) for s in sequences]
    trie = turn_trie.Trie(codes)
    nodes = {s[:d] for s in sequences for d in range(len(s) + 1)}
    assert len(trie.slots) == len(set(trie.slots)) == len(nodes)
    for s, code in zip(sequences, codes):
        path = list(trie.walk(code))
        assert [trie.depths[x] for x in path] == list(range(len(s) + 1))
        assert [trie.parents[x] for x in path] == [-1, *path[:-1]]
    used = sum(x >= 0 for x in trie.arrays.check)
    assert used == len(nodes) and len(trie.arrays.check) < 1.5 * len(nodes)
    assert len(list(trie.walk(b"\xff" * 16))) == 1


def test_stages_keep_clashing_columns(spark):
    from nestflow.llm import decontaminate, line_dedup, near_dup

    text = " ".join(f"w{k}" for k in range(30))
    docs = spark.createDataFrame([(k, f"{text} {k}", 7, "r", "x", 2) for k in range(3)], "doc_id long, text string, __row int, row string, __removed string, __w int")
    items = spark.createDataFrame([(1, "nothing of this")], "item_id long, text string")
    for out in (line_dedup.without_duplicates(docs), near_dup.one_of_each(docs), decontaminate.clean_only(docs, items)):
        assert out.columns == docs.columns
        assert {(r["__row"], r.row, r["__removed"], r["__w"]) for r in out.collect()} == {(7, "r", "x", 2)}


def test_counters(spark):
    from nestflow.llm import counters
    from nestflow.llm.common import in_arrow

    keys = spark.range(4000).selectExpr("id % 1500 AS k")

    def run(found):
        yield from counters.positions((b.column(0).to_numpy().view(np.uint64) for b in found if b.num_rows), 1 << 21)

    rows = in_arrow(keys.repartition(7), run, counters.POSITIONS)
    for bits, most in ((1, 1), (2, 3)):
        counts = counters.Counts(rows, 1 << 21, bits).of(np.arange(3000, dtype=np.uint64))
        assert (counts[1500:] == 0).all() and (counts[:1500] >= min(most, 2)).all() and (counts <= most).all()
