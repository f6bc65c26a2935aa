"""Extraction, packing and voting against plain second implementations, and pages of great depth."""

import random
import time

import numpy as np
import pytest

from nestflow.llm import html_extract, packing, quality_knn


def plain_ranges(weights, threshold, window):
    """Surge and dive points by their definition, one line at a time."""
    high = [sum(weights[k:k + window]) > threshold for k in range(len(weights))]
    out, k = [], 0
    while k < len(weights):
        if high[k]:
            end = k
            while end < len(weights) and high[end]:
                end += 1
            # The dive is the first line after the surge whose window is low; its window's first lines are still inside.
            stop = end + window - 1 if end < len(weights) else len(weights) + window - 1
            heavy = [j for j in range(k, min(stop, len(weights))) if weights[j] > 0]
            out += [(heavy[0], heavy[-1] + 1)] if heavy else []
            k = end
        k += 1
    return out


def test_surge_and_dive_plain():
    r = random.Random(3)
    for _ in range(3000):
        weights = [r.choice([0, 0, 1, 5, 40]) for _ in range(r.randint(0, 30))]
        threshold, window = r.choice([0, 3, 20, 60]), r.randint(1, 4)
        assert html_extract.between_surge_and_dive(weights, threshold, window) == plain_ranges(weights, threshold, window)


@pytest.mark.parametrize("page", ["<div>x" * 100_000, "<div>" * 100_000 + "</x>" * 100_000, "<b>" * 100_000 + "<div></div>" * 100_000,
                                  "<div>" * 100_000 + "</b>" * 100_000, "<article>x" * 100_000, "<div class=ad>x" * 100_000,
                                  "<div>" * 100_000 + "<li>y" * 100_000, "<span itemprop=articleBody>x" * 100_000])
def test_deep_pages(page):
    began = time.process_time()
    html_extract.extract(page)
    assert time.process_time() - began < 20  # about 2 s; with the square of the depth it would be minutes


def test_bm25_plain():
    r = np.random.default_rng(4)
    docs = [np.concatenate([r.integers(0, 12, r.integers(1, 60)), r.integers(12, 400, r.integers(0, 40))]).astype(np.uint16) for _ in range(300)]
    docs += docs[:5]  # ties
    often = np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=400)
    idf = np.log1p((len(docs) - often + 0.5) / (often + 0.5)).astype(np.float32)
    mean = float(np.mean([len(d) for d in docs]))
    index = packing.Shard(docs, idf, mean)
    assert len(index.rows) and (index.row < 0).any()  # terms of both kinds
    used = r.random(len(docs)) < 0.3
    for k in range(0, 300, 7):
        terms = np.unique(docs[k])
        scores = []
        for d in docs:
            score = 0.0
            for t in terms.tolist():
                tf = int((d == t).sum())
                score += float(idf[t]) * tf * (packing.K1 + 1) / (tf + packing.K1 * (1 - packing.B + packing.B * len(d) / mean)) if tf else 0
            scores.append(score)
        order = index.neighbours(terms, used)
        assert sorted(order.tolist()) == np.flatnonzero(~used).tolist()
        own = np.array(scores)[order]
        assert (own[:-1] >= own[1:] - 1e-4).all()
        assert all(a < b for a, b in zip(order, order[1:]) if np.array_equal(docs[a], docs[b]))
        for most in (1, 10, 40):
            best = index.neighbours(terms, used, most)
            assert len(best) >= most and best.tolist() == order[:len(best)].tolist()


def test_vote_plain():
    r = np.random.default_rng(5)
    rows = r.standard_normal((260, 9)).astype(np.float32)
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    vectors, labelled = np.concatenate([rows[:120], np.zeros((1, 9), np.float32)]), rows[120:]
    ys, counts = r.integers(0, 2, len(labelled)).astype(np.float32), r.integers(1, 5, len(labelled)).astype(float)
    for neighbours in (1, 5, 15, 500):
        want = []
        for v in vectors:
            near = sorted(((float(np.dot(v, x)), float(y), c) for x, y, c in zip(labelled, ys, counts)), key=lambda z: -z[0])[:neighbours]
            weights = [max(s, 0) ** quality_knn.SHARPNESS * c for s, _, c in near]
            total = sum(weights)
            want.append(sum(w * y for w, (_, y, _) in zip(weights, near)) / total if total > 1e-12 else float((ys * counts).sum() / counts.sum()))
        assert np.allclose(quality_knn.vote(vectors, labelled, ys, counts, neighbours), want, atol=1e-4)
