"""The operators against brute force, with nulls, empty texts, ties, repeated rows, empty tables and extra columns."""

import hashlib
import random
import zlib
from itertools import combinations

import numpy as np
import pytest

from nestflow.llm import (chat, decontaminate, html_extract, line_dedup, near_dup, packing, quality_knn, quality_rules,
                          warc)
from nestflow.llm.components import components
from nestflow.sources.sinks import scratch_path

DOCS = "doc_id long, text string, lang string, row long, class_id string"


def frame(spark, texts, extra=()):
    """Documents with clashing extra columns; ``texts`` are (doc_id, text)."""
    return spark.createDataFrame([(d, t, "x", 5, "c") for d, t in texts], DOCS)


def prose(seed, words=60):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(words))


def test_html_blocks():
    page = ('<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><header>Site</header>'
            '<nav><ul><li>a</li></ul></nav><div class="ad">Buy</div><article><h1>Head &amp; Line</h1><p>One\n two<p><b>Three<br>four</p>'
            '<p>S.</p></article><div id="comments"><p>Long reader comment, longer than the article itself by far, yes.</p></div>'
            '<aside>x</aside><form>f</form><footer>&copy; me</footer></body></html>')
    assert html_extract.extract(page) == "Head & Line\nOne two\nThree four\nS."
    assert html_extract.extract(None) == html_extract.extract("") == html_extract.extract("<p") == ""
    body = "".join(f"<p>{prose(k, 30)}</p>" for k in range(4))
    plain = f'<body><div><a href="/">Home</a> <a href="/x">X</a></div><div>{body}<p>End.</p></div><div class="sidebar">{prose(9, 40)}</div></body>'
    assert html_extract.extract(plain) == "\n".join([*(prose(k, 30) for k in range(4)), "End."])
    assert html_extract.between_surge_and_dive([0, 5, 5, 0, 0, 0, 0, 2, 0], 3) == [(1, 3)]


def test_html_frame(spark):
    pages = spark.createDataFrame([(1, None, None, "t"), (1, None, None, "t"), (None, "u", "<article>a</article>", "t")],
                                  "page_id long, url string, html string, text string")
    got = html_extract.extract_text(pages).select("page_id", "url", "text", "n_chars").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, None, "", 0), (1, None, "", 0), (None, "u", "a", 1)], key=str)
    assert html_extract.extract_text(pages.limit(0)).count() == 0


def test_packing(spark):
    import public_tokenizers

    texts = [(1, prose(1, 400)), (2, None), (2, ""), (None, "x"), (5, prose(5, 9000)), (6, prose(1, 400)), (6, prose(1, 400))]
    rows = packing.pack_documents(frame(spark, texts), public_tokenizers.path("word_bpe_49k.json"), 1, length=256).collect()
    sequences, documents = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        documents.setdefault(r.doc_id, []).append(r)
    for pieces in sequences.values():
        pieces.sort()
        assert [o for o, _ in pieces] == np.cumsum([0, *(n for _, n in pieces)])[:-1].tolist()
        size = sum(n for _, n in pieces)
        assert size <= 256 and size & (size - 1) == 0
    assert set(documents) == {1, 2, None, 5, 6}
    for doc_id in (1, 5, None):
        pieces = sorted(documents[doc_id], key=lambda r: r.start)
        assert sum(r.length for r in pieces) == pieces[0].doc_tokens
        assert all(a.start + a.length == b.start for a, b in zip(pieces, pieces[1:]))
        assert pieces[-1].ids[-4:] == b"\1\0\0\0"
    assert packing.pack_documents(frame(spark, texts).limit(0), public_tokenizers.path("word_bpe_49k.json"), 1).count() == 0


def test_bm25_order():
    docs = [np.array(x, dtype=np.uint32) for x in ([1, 2, 3], [1, 2, 3, 4], [7, 8], [3, 9, 9, 9])]
    idf = np.ones(10, dtype=np.float32)
    shard = packing.Shard(docs, idf, 3.0)
    order = shard.neighbours(np.array([1, 2, 3]), np.array([True, False, False, False]))
    assert order.tolist() == [1, 3, 2]
    assert shard.neighbours(np.array([0, 5]), np.zeros(4, bool)).tolist() == [0, 1, 2, 3]


def test_warc(spark):
    big, small = "é" * 600, "tiny"
    rows = [(1, "http://a/ b", big, 0), (7, None, big, 0), (3, "u", big, 0), (7, None, big, 0), (None, "n", big, 0), (4, "s", small, 0),
            (5, "s", small, 0), (6, "e", None, 0), (8, "e", "", 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, salt int")
    path = scratch_path(spark, "t")
    warc.write_bundles(pages, path, frame_bytes=1500)
    got = sorted(map(tuple, warc.read_bundles(spark, path).collect()), key=str)
    want = []
    for p, _, h, _ in rows:
        data = (h or "").encode()
        revisit = h == big and p != 7
        want.append((p, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", 7 if revisit else None))
    assert got == sorted(want, key=str)
    path = scratch_path(spark, "t")
    warc.write_bundles(pages.limit(0), path)
    assert warc.read_bundles(spark, path).count() == 0


def test_bundle_frames():
    import zstandard

    writer = warc.BundleWriter(frame_bytes=100)
    records = {str(k): (b"%d" % k) * (k * 7 + 1) for k in range(30)}
    for name, data in records.items():
        writer.add(name, data)
    data = writer.close() + warc.TRAILER
    bundle = warc.Bundle(data)
    assert len(bundle.begins) > 5 and all(bundle.read(n) == d for n, d in records.items())
    assert list(bundle.records()) == list(records.values())
    stream = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert stream == b"".join(records.values())
    with pytest.raises(ValueError):
        warc.Bundle(data[:-1])


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute_lines(texts, tau, least):
    first, copies = {}, {}
    order = sorted(range(len(texts)), key=lambda k: (texts[k][0] is None, texts[k][0] or 0, k))
    for k in order:
        for n, line in enumerate((texts[k][1] or "").split("\n")):
            line = line.strip(line_dedup.SPACE)
            if line:
                first.setdefault(line, (texts[k][0], n))
                copies[line] = copies.get(line, 0) + 1
    place = {line: i for i, line in enumerate(first)}
    links = [(a, b) for a, b in combinations(first, 2) if min(len(a), len(b)) >= least
             and plain_distance(list(a), list(b)) <= tau]
    root = {x: x for x in first}
    for _ in first:
        for a, b in links:
            x = min(root[a], root[b], key=place.get)
            root[a] = root[b] = x
    degree = {x: sum(x in p for p in links) for x in first}
    return sorted([(*first[x], copies[x], degree[x], *first[root[x]]) for x in first], key=str)


def line_texts():
    r = random.Random(3)
    base = [prose(k, 8)[:44].ljust(44, "z") for k in range(4)]
    lines = list(base)
    for b in base:
        for _ in range(14):
            x = list(b)
            for _ in range(r.randint(1, 3)):
                at = r.randrange(len(x))
                x[at:at + r.randint(0, 1)] = r.choice(["", "q", "w"])
            lines.append("".join(x))
    return [(k % 9 if k % 9 else None, "\n".join([lines[k], " ", "short", lines[k // 2]])) for k in range(len(lines))]


@pytest.mark.parametrize("crowd", [line_dedup.CROWD, 6])
def test_lines_brute_force(spark, crowd):
    texts = [*line_texts(), (3, None), (3, "")]
    docs = frame(spark, texts).coalesce(1)
    lines = line_dedup.lines_of(docs)
    near = {tuple(sorted(((r.a1, r.a2), (r.b1, r.b2)))) for r in line_dedup.links(lines, 2, 40, crowd).collect()}
    named = {(r.h1, r.h2): r.line for r in lines.select("h1", "h2", "line").distinct().collect()}
    got = {tuple(sorted((named[a], named[b]))) for a, b in near}
    want = {tuple(sorted(p)) for p in combinations(named.values(), 2) if min(map(len, p)) >= 40
            and plain_distance(list(p[0]), list(p[1])) <= 2}
    assert got == want and len(want) > 20
    if crowd == line_dedup.CROWD:
        rows = line_dedup.duplicate_lines(docs).collect()
        assert sorted(map(tuple, rows), key=str) == brute_lines(texts, 2, 40)


def test_lines_removed(spark):
    long = "a line that is long enough to be near another line"
    texts = [(2, f"{long}\nown two two two two\n}}"), (1, f"{long}.\n\n}}\nown one one one one"), (3, long), (4, None), (5, ""), (None, long), (6, "}")]
    got = {r.doc_id: r.text for r in line_dedup.without_duplicates(frame(spark, texts)).collect()}
    assert got == {1: f"{long}.\n\n}}\nown one one one one", 2: "own two two two two\n}", 4: None, 5: "", 6: "}"}
    assert line_dedup.without_duplicates(frame(spark, texts)).columns == ["doc_id", "text", "lang", "row", "class_id"]
    assert line_dedup.without_duplicates(frame(spark, texts).limit(0)).count() == 0
    assert line_dedup.duplicate_lines(frame(spark, texts).limit(0)).count() == 0


def test_decontamination(spark):
    item = prose(1, 25)
    words = item.split()
    docs = [(1, f"x {' '.join(words[3:16]).upper()} y"), (1, f"x {' '.join(words[3:12])} y"), (2, None), (3, ""), (None, item), (4, "so Short Phrase here short phrase")]
    items = [(10, item), (9, item), (9, item), (8, "short phrase"), (7, None), (6, ""), (None, "here")]
    questions = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    want = [(1, 15, 13, [9, 10]), (1, 11, 0, []), (2, 0, 0, []), (3, 0, 0, []), (None, 25, 25, [9, 10]), (4, 6, 5, [8])]
    for options in ({}, {"block_terms": 4}, {"segment_words": 20}):
        got = decontaminate.find_items(frame(spark, docs), questions, **options).select("doc_id", "n_words", "n_hit", "items").collect()
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    kept = decontaminate.clean_only(frame(spark, docs), questions)
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == [(1, docs[1][1]), (2, ""), (3, "")]
    assert kept.columns == frame(spark, docs).columns
    near = decontaminate.find_items(frame(spark, [(1, "phrase of a short kind"), (2, "phrase one two three four five short")]), questions.where("item_id = 8"), slop=2)
    assert {r.doc_id: [(s.start, s.stop) for s in r.spans] for r in near.collect()} == {1: [(0, 4)], 2: []}
    assert decontaminate.find_items(frame(spark, docs).limit(0), questions).count() == 0
    assert decontaminate.find_items(frame(spark, docs), questions.limit(0)).where("n_hit > 0").count() == 0


def test_quality_rules(spark):
    text = prose(1, 60)
    rows = [(1, text), (2, None), (3, ""), (4, "word " * 40), (5, text.replace(" ", "*** ")), (6, text.replace(" ", "!! ")), (7, text), (7, text),
            (8, "\n".join([text, *["the same line"] * 8]))]
    got = {r.doc_id: r for r in quality_rules.judge(frame(spark, rows)).collect()}
    assert {k: r.kept for k, r in got.items()} == {1: True, 2: False, 3: False, 4: False, 5: False, 6: False, 7: True, 8: False}
    assert (got[4].n_words, got[4].n_repeat_words, got[4].word_chars, got[8].n_dup_lines) == (40, 40, 160, 7)
    assert sorted(r.doc_id for r in quality_rules.kept_only(frame(spark, rows)).collect()) == [1, 7, 7]
    assert quality_rules.judge(frame(spark, rows).limit(0)).count() == 0
    orders = [rule for rule, _, _ in quality_rules.rule_order(frame(spark, rows))]
    assert set(orders) == set(quality_rules.RULES)


def test_neighbours(spark):
    good = [(k, prose(k, 80)) for k in range(60)]
    bad = [(100 + k, prose(100 + k, 80).replace(" ", "!! ").upper()) for k in range(60)]
    docs = frame(spark, [*good, *bad, (500, None), (501, ""), (None, "x"), (1, good[1][1])])
    labels = spark.createDataFrame([*((d, 1, 0) for d, _ in good), *((d, 0, 1) for d, _ in bad), (None, 1, 0), (3, None, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = quality_knn.score(docs, labels).collect()
    assert len(rows) == 124 and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id is not None and r.doc_id < 200]
    assert held and all((r.score >= 0.3) == (r.doc_id < 100) for r in held)
    assert {r.held_out for r in rows if r.doc_id == 5} == {zlib.crc32(b"5") % 5 == 0}
    assert {r.score for r in quality_knn.score(docs, labels.limit(0)).collect()} == {0.5}
    assert quality_knn.score(docs.limit(0), labels).count() == 0


def test_chat(spark):
    rows = [(1, 0, "user", "a<|end|>\\x", 1), (1, 1, "user", None, 1), (1, 2, "assistant", "<s>é\n[INST]", 1), (1, 2, "assistant", "tie", 1),
            (1, None, "system", "first", 1), (None, 0, None, "n", 1), (2, 0, "assistant", "", 1), (3, 0, "as<|text|>", "<", 1)]
    rows += [(4, k, "assistant" if k % 3 else "user", f"t{k}\\" * (k % 5), 1) for k in range(1300)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, runs int")
    formatted = chat.format_chats(turns)
    out = {r.conv_id: r for r in formatted.collect()}
    for r in out.values():
        assert "<s>" not in r.formatted and "[INST]" not in r.formatted
    for r in chat.read_back(formatted).collect():
        own = sorted((x for x in rows if x[0] == r.conv_id), key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))
        assert [tuple(t) for t in r.turns] == [(x[2] or "", x[3] or "") for x in own]
        assert r.loss_texts == [x[3] or "" for x in own if x[2] == "assistant"]
        spans = out[r.conv_id].loss_spans
        assert all(s.start + s.length <= len(r.formatted) for s in spans)
    assert chat.read_back(chat.format_chats(turns.limit(0))).count() == 0


def test_signatures_estimate():
    r = np.random.default_rng(1)
    base = np.sort(r.choice(2**62, 300, replace=False)).astype(np.uint64)
    a, b = (base[:250], r.integers(1, 4, 250)), (base[50:], r.integers(1, 4, 250))
    exact = near_dup.similarity(a, b)
    want = 0.0
    x, y = dict(zip(a[0].tolist(), a[1].tolist())), dict(zip(b[0].tolist(), b[1].tolist()))
    for i in x.keys() & y.keys():
        want += 1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in x.keys() | y.keys())
    assert exact == pytest.approx(want)
    drawn = near_dup.signatures([a, b], 4000)
    assert (drawn[0] == drawn[1]).mean() == pytest.approx(exact, abs=0.03)


def test_near_duplicates(spark):
    base = prose(1, 120).split()
    near = [" ".join([*base[:k * 9], f"other{k}", *base[k * 9 + 1:]]) for k in range(1, 12)]
    texts = [(5, " ".join(base)), *((20 + k, t) for k, t in enumerate(near)), (3, prose(2, 50)), (3, prose(2, 50).upper()), (None, prose(2, 50)),
             (8, None), (8, None), (9, ""), (11, "a b"), (12, "A b.")]
    got = sorted(((r.doc_id, r.class_id) for r in near_dup.classes(frame(spark, texts)).collect()), key=str)
    want = sorted([(5, 5), *((20 + k, 5) for k in range(11)), (3, 3), (3, 3), (None, 3), (8, 8), (8, 8), (9, 9), (11, 11), (12, 11)], key=str)
    assert got == want
    kept = near_dup.one_of_each(frame(spark, texts))
    assert sorted(r.doc_id for r in kept.collect()) == [3, 5, 8, 8, 9, 11] and kept.columns == frame(spark, texts).columns
    assert near_dup.classes(frame(spark, texts).limit(0)).count() == 0


def test_near_duplicate_strangers(spark, monkeypatch):
    """Members of one bucket in many classes, in tiles of a few rows, against brute force."""
    monkeypatch.setattr(near_dup, "PART", 1500)
    r = random.Random(5)
    base = prose(7, 150).split() + ["again"] * 30
    texts = []
    for k in range(60):
        words = list(base)
        for at in r.sample(range(len(words)), r.randint(1, 4)):
            words[at] = f"w{k}x{at}"
        texts.append((k, " ".join(words)))
    found = {x.doc_id: x.class_id for x in near_dup.classes(frame(spark, texts)).collect()}
    sets = [near_dup.Shingles().of(t)[:2] for _, t in texts]
    want = list(range(60))
    for a in range(60):
        flat, counts = (np.concatenate([s[i] for s in sets]) for i in (0, 1))
        many = near_dup.similarities(sets[a], flat, counts, np.array([len(h) for h, _ in sets]))
        assert many == pytest.approx([near_dup.similarity(sets[a], b) for b in sets])
        for b in np.flatnonzero(many >= near_dup.SIMILARITY).tolist():
            low, high = sorted((want[a], want[b]))
            want = [low if w == high else w for w in want]
    assert found == dict(enumerate(want)) and 1 < len(set(want)) < 60


def test_register_marks():
    r = np.random.default_rng(3)
    a = r.integers(0, 2 ** 63, (4, near_dup.REGISTERS)).astype(np.uint64)
    b = a.copy()
    b[:, :50] ^= np.uint64(5)
    assert near_dup.agreeing(near_dup.marks(a), near_dup.marks(b)).tolist() == [near_dup.REGISTERS - 50] * 4
    assert near_dup.least_agreeing(0.8) == 75 and near_dup.least_agreeing(1.0) == near_dup.REGISTERS


def test_components(spark):
    links = [(k, k + 1) for k in range(1, 40)] + [(100, 90), (90, 95), (100, 90), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 1 for k in range(2, 41)}, 95: 90, 100: 90}


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.limit(0), "/root/testdata/sf0.001")
        assert out.columns == docs.columns and out.count() == 0, name


@pytest.mark.parametrize("crowd", [line_dedup.CROWD, 6])
def test_lines_share_of_length(spark, crowd):
    """Edits grow with the line's length."""
    _, want = check_share(spark, crowd, [], (45, 60, 119, 121, 233, 300, 660))
    assert sum(min(map(len, p)) > 200 for p in want) > 10


def check_share(spark, crowd, lines, lengths):
    r = random.Random(11)
    for n in lengths:
        for k in range(2):
            base = prose(1000 * k + n, n)[:n].replace(" ", "_", 1)
            lines.append(base)
            for many in (1, 2, 3, n // 20, n // 20 + 1, n // 20 + 2):
                x = list(base)
                for at in r.sample(range(1, n - 1), min(many, n - 2)):
                    x[at] = r.choice(["", "Q", "W" + x[at]])
                lines.append("".join(x))
    lines = [line.strip() for line in lines]
    texts = list(enumerate(lines))
    docs = frame(spark, texts).coalesce(1)
    found = line_dedup.lines_of(docs)
    named = {(x.h1, x.h2): x.line for x in found.select("h1", "h2", "line").distinct().collect()}

    def allowed(n):
        return max(2, n // 20) if n >= 16 else 1 if n >= 8 else 0

    def linked(a, b):
        most = allowed(min(len(a), len(b)))
        if abs(len(a) - len(b)) > most or len(set(a) ^ set(b)) > 2 * most:
            return False
        return 0 < plain_distance(list(a), list(b)) <= most

    got = {tuple(sorted((named[x.a1, x.a2], named[x.b1, x.b2]))) for x in line_dedup.links(found, crowd=crowd).collect()}
    want = {tuple(sorted(p)) for p in combinations(named.values(), 2) if linked(*p)}
    assert got == want
    if crowd == line_dedup.CROWD:
        degree = {named_line: sum(named_line in p for p in want) for named_line in named.values()}
        rows = {x.doc_id: x.n_links for x in line_dedup.duplicate_lines(docs).collect()}
        assert all(rows[lines.index(line)] == n for line, n in degree.items())
    return lines, want


@pytest.mark.parametrize("crowd", [line_dedup.CROWD, 6])
def test_lines_short(spark, crowd):
    """Lines under 40 characters are linked too."""
    given = ["Der, eingeä erer.", "Der eingeä erer.", "menu", "menus", "Seite zwei", "Seite zwey", "Seite drey"]
    _, want = check_share(spark, crowd, given, (9, 12, 16, 17, 19, 24, 30, 38, 41))
    assert ("Der eingeä erer.", "Der, eingeä erer.") in want and ("menu", "menus") not in want
    assert sum(max(map(len, p)) < 40 for p in want) > 5


def test_line_keys():
    """Index keys are the marked ones of all keys; a key is its substring's polynomial, mixed with its number and size."""
    r = np.random.default_rng(5)
    texts = [r.integers(32, 90, n).astype(np.uint32) for n in (8, 15, 16, 40, 41, 60, 99, 100, 361, 361, 1300, 4000, 4100)]
    every = {(who, start, key) for k, (w, keys, s, index) in enumerate(line_dedup.line_keys(texts, None, 1))
             for who, start, key, own in zip(w.tolist(), s.tolist(), keys.tolist(), index.tolist()) if own}
    index = {(who, start, key) for w, keys, s in line_dedup.index_keys(texts, None, 1) for who, start, key in zip(w.tolist(), s.tolist(), keys.tolist())}
    assert every == index and len(index) == sum(line_dedup.edits(len(t)) + 1 for t in texts)
    for size in (1, 2, 3, 5, 8, 13, 19):
        rows = np.stack(texts[8:10]).astype(np.uint64)
        got = line_dedup._windows(rows, size)
        for at in (0, 7, 361 - size):
            want = 0
            for x in texts[9][at:at + size].tolist():
                want = (want * line_dedup._BASE + x) % 2**64
            assert int(got[1, at]) == want


def test_wide_bands():
    r = random.Random(4)
    pairs = []
    for _ in range(60):
        a = [r.randint(0, 4) for _ in range(r.randint(90, 130))]
        b = list(a)
        for _ in range(r.randint(0, 60)):
            at = r.randrange(len(b))
            b[at:at + r.randint(0, 1)] = [r.randint(0, 4)] * r.randint(0, 1)
        pairs.append((np.array(a, dtype=np.uint32), np.array(b, dtype=np.uint32)))
    for tau in (3, 16, 31, 32, 44):
        got = line_dedup.distances_within([a for a, _ in pairs], [b for _, b in pairs], tau)
        assert got.tolist() == [min(plain_distance(a.tolist(), b.tolist()), tau + 1) for a, b in pairs]


def test_packing_shards_hold_neighbours():
    """A seed meets its family, whatever number of documents lies between; dealing follows rare terms."""
    r = np.random.default_rng(2)
    docs = []
    for k in range(900):  # family k % 300: three rare terms among common ones
        docs.append((k, np.concatenate([r.integers(0, 50, 57), 1000 + 3 * (k % 300) + np.arange(3)]).astype(np.uint32)))
    often = np.bincount(np.concatenate([np.unique(ids) for _, ids in docs]), minlength=2000)
    idf = np.log1p((900 - often + 0.5) / (often + 0.5)).astype(np.float32)
    pieces = list(packing.pack(iter(docs), idf, 60.0, length=180))
    windows = {}
    for name, start, length, total, sequence, offset, ids in pieces:
        windows.setdefault(sequence, []).append(name)
    assert sum(p[2] for p in pieces) == 900 * 60
    assert sum(len({n % 300 for n in names}) == 1 for names in windows.values()) > 290
    ranks = packing.sketch_ranks(often, idf)
    keys = [tuple(ranks[:, ids].min(axis=1).tolist()) for _, ids in docs]
    alike = np.mean([keys[k][0] == keys[k + 300][0] for k in range(600)])
    largest = max(keys.count(x) for x in set(keys))
    assert alike > 0.35 and largest <= 30
    spread = [np.concatenate([r.integers(0, 50, 20), 100 + 400 * (k % 4) + r.integers(0, 400, 40)]).astype(np.uint32) for k in range(400)]
    often = np.bincount(np.concatenate([np.unique(ids) for ids in spread]), minlength=2000)
    idf = np.log1p((400 - often + 0.5) / (often + 0.5)).astype(np.float32)
    found = packing.Topics(spread, idf, 60.0).of(spread)
    together = [(a % 4 == b % 4) for a, b in combinations(range(400), 2) if found[a] == found[b]]
    assert len(together) > 100 and np.mean(together) > 0.75


def test_neighbours_class_ratio(spark):
    """The classes' ratio behind a score is the labels', whatever the bound on the fit."""
    good = [(k, prose(k, 80)) for k in range(200)]
    bad = [(1000 + k, prose(1000 + k, 80)) for k in range(40)]
    docs = frame(spark, [*good, *bad, (5000, "")])
    labels = spark.createDataFrame([*((d, 1) for d, _ in good), *((d, 0) for d, _ in bad), *((d, 0) for d in range(20000, 20400))],
                                   "doc_id long, quality int")
    used = {y: sum(zlib.crc32(str(d).encode()) % 5 != 0 for d, _ in own) for y, own in ((1, good), (0, bad))}
    mean = used[1] / (used[0] + used[1])
    for fit_rows in (1000, 20):
        scores = {r.doc_id: r.score for r in quality_knn.score(docs, labels, fit_rows=fit_rows).collect()}
        assert scores[5000] == pytest.approx(mean, abs=1e-6)
        assert np.mean([scores[d] for d, _ in good]) > 0.6


def test_html_part_names():
    """Names that hold a part word are parts only as whole tokens, and never around the article."""
    texts = [prose(k, 30) for k in range(4)]
    body = "".join(f"<p>{t}</p>" for t in texts)
    want = "\n".join(texts)
    for opened, closed in (("<div class='layout has-sidebar'><article>", "</article></div>"), ("<div id='content-with-sidebar'>", "</div>"),
                           ("<div class='no-header'><article>", "</article></div>"), ("<article class='post comments-open'>", "</article>"),
                           ("<div class='sidebar'><article>", "</article></div>"), ("<div class='banner'>", "</div>"),
                           ("<article><section id='related-work'>", "</section></article>"), ("<article><div id='search-methods'>", "</div></article>")):
        page = f"<body><nav>Menu</nav>{opened}{body}{closed}<div class='sidebar'>{prose(8, 9)}</div><footer>f</footer></body>"
        assert html_extract.extract(page) == want, opened
        page = f"<body><div class='site-header'>Site</div>{opened}{body}<div class='social-share'>Share it</div>{closed}</body>"
        assert html_extract.extract(page) == want, opened
    comments = f"<div id='comments'><article><p>{prose(9, 300)}</p></article></div>"
    assert html_extract.extract(f"<body><article>{body}{comments}</article></body>") == want
    assert html_extract.extract(f"<body><article>{body}</article>{comments}</body>") == want
    assert html_extract.extract(f"<body><article><div class='post-header'><h1>Title</h1></div>{body}</article></body>") == "Title\n" + want


def test_html_many_areas():
    """Sibling areas, a short article beside a long text, and sections near a huge paragraph stay."""
    a, b, c = (f"<p>{prose(k, 40)}</p><p>{prose(k + 50, 40)}</p>" for k in (1, 2, 3))
    plain = ["\n".join(prose(k + j, 40) for j in (0, 50)) for k in (1, 2, 3)]
    for opened, closed in (("<div class='content'>", "</div>"), ("<article>", "</article>")):
        page = f"<body><nav>n</nav>{opened}{a}{closed}<div class='ad'>Buy</div>{opened}{b}{closed}<div class='sidebar'>{c}</div></body>"
        assert html_extract.extract(page) == "\n".join(plain[:2]), opened
    page = f"<body><main><article><p>Short one.</p></article><div>{a}</div><div>{b}</div></main><footer>f</footer></body>"
    assert html_extract.extract(page) == "\n".join(["Short one.", *plain[:2]])
    page = f"<body><main><article>{a}{b}</article><div><p>Read <a href='/'>more of this here</a></p></div></main></body>"
    assert html_extract.extract(page) == "\n".join(plain[:2])
    links = "".join(f"<p><a href='/{k}'>link {k}</a></p>" for k in range(5))
    huge = prose(9, 2000)
    page = (f"<body><div>{links}</div><div><div><p>{huge}</p></div>{links}<div>{a}</div>{links}<ul><li>{prose(5, 40)}</li><li>{prose(6, 40)}</li></ul>"
            f"{links}<blockquote>{b}</blockquote></div></body>")
    assert html_extract.extract(page) == "\n".join([huge, plain[0], prose(5, 40), prose(6, 40), plain[1]])


def test_pipeline_run(spark, tmp_path):
    """Every row of ``run`` on planted texts, against plain Python versions of the stages."""
    from collections import Counter

    import corpus_pipeline
    import public_tokenizers
    import pyarrow as pa
    import pyarrow.parquet as pq
    from nestflow.llm.tokens import encoder

    def laid(words, width):
        return "\n".join(" ".join(words[k:k + width]) for k in range(0, len(words), width))

    base, item = prose(1, 120).split(), prose(2, 14)
    shared = prose(3, 12)
    copy = [*base[:60], "other", *base[61:]]
    texts = [(7, laid(base, 12)), (8, laid(copy, 17)), (1, "too short"), (2, None), (3, "# * $ " * 30), (4, prose(4, 60) + "\n" + shared),
             (5, shared + "\n" + prose(5, 60)), (6, shared[:-1] + "\n" + prose(6, 60)), (9, prose(7, 30) + " " + item + " " + prose(8, 30)),
             (10, prose(9, 50)), (None, prose(10, 50)), (11, prose(9, 50) + " x"), (12, "word " * 40)]
    pq.write_table(pa.table({"doc_id": pa.array([d for d, _ in texts], pa.int64()), "text": [t for _, t in texts], "lang": ["x"] * len(texts),
                             "source": ["s"] * len(texts), "n_chars": pa.array([len(t or "") for _, t in texts], pa.int64())}),
                   tmp_path / "documents.parquet")
    pq.write_table(pa.table({"item_id": pa.array([1], pa.int64()), "text": [item]}), tmp_path / "benchmark.parquet")

    def rejected(text):
        words = (text or "").split()
        grams = Counter(tuple(words[k:k + 8]) for k in range(len(words) - 7))
        repeated = {j for k in range(len(words) - 7) if grams[tuple(words[k:k + 8])] > 1 for j in range(k, k + 8)}
        return len(words) < 20 or 100 * len(repeated) > 30 * len(words) or 5 * sum(c in "#*$%&|<>" for c in text) > len(words)

    docs = [(d, t) for d, t in texts if not rejected(t)]
    docs.sort(key=lambda x: (x[0] is None, x[0] or 0))
    lines = list(dict.fromkeys(x for _, t in docs for x in t.split("\n")))
    root = {x: x for x in lines}
    for a, b in combinations(lines, 2):
        most = max(2, min(len(a), len(b)) // 20)
        if abs(len(a) - len(b)) <= most and plain_distance(list(a), list(b)) <= most:
            low, high = sorted((root[a], root[b]), key=lines.index)
            root = {x: low if y == high else y for x, y in root.items()}
    seen, after = set(), []
    for d, t in docs:
        held = []
        for x in t.split("\n"):
            if len(x) < line_dedup.MIN_REMOVED or root[x] not in seen:
                held.append(x)
            seen.add(root[x])
        if held:
            after.append((d, "\n".join(held)))

    def shingles(text):
        w = text.split()
        return {tuple(w[k:k + 5]) for k in range(len(w) - 4)}

    alone = []
    for d, t in after:
        if all(len(shingles(t) & shingles(u)) < 0.8 * len(shingles(t) | shingles(u)) for _, u in alone):
            alone.append((d, t))
    passages = {tuple(item.split()[k:k + 10]) for k in range(5)}
    clean = [(d, t) for d, t in alone if not any(tuple(t.split()[k:k + 10]) in passages for k in range(len(t.split()) - 9))]
    assert [d for d, _ in clean] == [4, 5, 6, 7, 10, None]  # each stage takes some away
    codes = encoder(public_tokenizers.path("word_bpe_49k.json")).encode([t for _, t in clean])
    want = {d: np.append(np.frombuffer(c, "<u4"), 1).astype("<u4") for (d, _), c in zip(clean, codes)}
    found = {}
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        found.setdefault(r.doc_id, []).append(r)
    assert set(found) == set(want)
    for d, ids in want.items():
        at = 0
        for r in sorted(found[d], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids[at:at + r.length].tobytes()))
            at += r.length
        assert at == len(ids)
