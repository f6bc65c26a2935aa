"""Ids by pieces equal the library's ids of whole texts; token files give any id."""

import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from tokenizers import Tokenizer

from nestflow.llm import token_codes, tokens
from nestflow.sources.sinks import scratch_path

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
PLAIN = {f: Tokenizer.from_file(public_tokenizers.path(f)) for f in FILES}
for t in PLAIN.values():
    t.encode_special_tokens = True


def whole(name, text):
    return np.array(PLAIN[name].encode(text or "", add_special_tokens=False).ids, dtype="<u4").tobytes()


ALPHABET = st.sampled_from(list("abzAZ09 '\n\t\r.,!?-_|éÉßœŒª²½µ×÷¿  ​́ΣИ中😀İ<|>") + ["'s", "'ll", "  ", "<|endoftext|>"])


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.lists(ALPHABET, max_size=40).map("".join), max_size=4))
def test_pieces_equal_whole(name, texts):
    assert tokens.encoder(public_tokenizers.path(name)).encode(texts) == [whole(name, t) for t in texts]


@pytest.mark.parametrize("name", FILES)
def test_real_texts_and_small_table(name, spark, monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_PIECES", 50)
    monkeypatch.setattr(tokens, "KEPT_WORDS", 50)
    texts = [r[0] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").limit(60).collect()]
    coder = tokens.Encoder(public_tokenizers.path(name))
    assert coder.split is not None
    got = [x for t in [None, "", *texts] for x in coder.encode([t])]
    assert got == [whole(name, t) for t in [None, "", *texts]]


@given(ids=st.lists(st.one_of(st.integers(0, 255), st.integers(0, 2**32 - 1)), max_size=1500), data=st.data())
@settings(max_examples=60, deadline=None)
def test_random_access(ids, data):
    ids = np.array(ids, dtype=np.uint32)
    cut = len(ids) // 2
    file = token_codes.TokenFile(token_codes.encode_file([7, None], [cut, len(ids) - cut], ids, 3, 4) + token_codes.TRAILER)
    assert (file.part, file.number, file.doc_ids) == (3, 4, [7, None])
    assert file.between(0, len(ids)).tolist() == ids.tolist()
    assert file.document(0).tolist() == ids[:cut].tolist() and file.document(1).tolist() == ids[cut:].tolist()
    if len(ids):
        places = data.draw(st.lists(st.integers(0, len(ids) - 1), max_size=20))
        assert file.get(places).tolist() == ids[places].tolist()
        a = data.draw(st.integers(0, len(ids)))
        b = data.draw(st.integers(a, len(ids)))
        assert file.between(a, b).tolist() == ids[a:b].tolist()
    with pytest.raises(IndexError):
        file.get([len(ids)])


def test_full_blocks():
    for n in (511, 512, 513, 1024, 1025):
        ids = np.full(n, 70_000, dtype=np.uint32)
        file = token_codes.TokenFile(token_codes.encode_file([1], [n], ids, 0, 0) + token_codes.TRAILER)
        assert file.get(range(n)).tolist() == ids.tolist() and file.between(n - 1, n).tolist() == [70_000]


def test_files_round_trip(spark):
    rows = [Row(doc_id=d, text=t, ids=1, part="x") for d, t in
            [(5, "five"), (2, None), (2, ""), (None, "no id"), (9, "same"), (9, "same"), (1, "long " * 5000), (9, "other")]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int, part string").repartition(3)
    path = scratch_path(spark, "t")
    name = "byte_bpe_50k.json"
    token_codes.write_token_files(docs, path, public_tokenizers.path(name), 2, file_ids=100)
    got = sorted((r.asDict() for r in token_codes.read_documents(spark, path).collect()), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, 1, 2, 2, 5, 9, 9, 9]
    assert [r["start"] for r in got] == np.cumsum([0, *(r["n_tokens"] for r in got)])[:-1].tolist()
    end = np.array([2], "<u4").tobytes()
    want = sorted(zlib.crc32(whole(name, r.text) + end) for r in rows)
    assert sorted(r["ids_crc32"] for r in got) == want


def test_empty_table(spark):
    path = scratch_path(spark, "t")
    token_codes.write_token_files(spark.createDataFrame([], "doc_id long, text string"), path, public_tokenizers.path(FILES[0]), 2)
    assert token_codes.read_documents(spark, path).count() == 0


@pytest.mark.parametrize("name", FILES)
def test_a_word_is_looked_up_once_for_all_its_places(name, monkeypatch):
    # Before, every place of a word was a lookup of its own.
    coder, asked = tokens.Encoder(public_tokenizers.path(name)), []
    known = coder._number
    monkeypatch.setattr(coder, "_number", lambda key: asked.append(key) or known(key))
    monkeypatch.setattr(tokens, "AT_ONCE", 1000)
    texts = ["one two, two\nThree's 12 three " * 40 + "end", None, "two  spaces ", "", "\ttab", "two", "漢字 two", "x" * 3000]
    assert list(coder.encode_batches(pa.array(texts))) == [whole(name, t) for t in texts]
    assert len(asked) < 60


@pytest.mark.parametrize("name", FILES)
def test_sure_characters_beside_each_other(name):
    sure = [c for c in map(chr, range(0x2100)) if not re.match(tokens._UNSURE, c)]
    texts = [f"a{c}{d}b {c} {d}{c}1" for c in sure for d in "a1'. \n"] + [f"{c}" for c in sure]
    assert tokens.encoder(public_tokenizers.path(name)).encode(texts) == [whole(name, t) for t in texts]
