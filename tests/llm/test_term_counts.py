"""Distinct terms of documents, as packing counts them."""

import numpy as np
import public_tokenizers

from nestflow.llm import packing


def test_counted_terms():
    random = np.random.default_rng(1)
    for kind in ("<u2", "<u4"):
        for n in (0, 1, 2, 700):
            ids = random.integers(0, 60, n).astype(kind)
            (terms, counts), (want, many) = packing._counted(ids), np.unique(ids, return_counts=True)
            assert terms.dtype == ids.dtype and terms.tolist() == want.tolist() and counts.tolist() == many.tolist()


def test_documents_of_terms(spark, monkeypatch):
    monkeypatch.setattr(packing, "_TERMS_AT_ONCE", 3)
    texts = ["alpha beta beta", "beta", None, "", "gamma alpha beta delta alpha"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    coded = packing.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"), 1)
    often, n_docs, n_ids = packing.corpus_statistics(coded)
    own = [np.frombuffer(row["ids"], packing._width(len(often))) for row in coded.where("kind = 0").collect()]
    want = np.bincount(np.concatenate([np.unique(ids) for ids in own]), minlength=len(often))
    assert n_docs == 5 and n_ids == sum(map(len, own)) and often.tolist() == want.tolist()
