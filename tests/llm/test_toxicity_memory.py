"""Toxicity (1): what a task holds follows CHUNK and RUN, not the batch or the longest text; results as computed at once."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from credlake.llm import toxicity
from credlake.llm.common import flat

from .conftest import prose


def peak_mb(work) -> float:
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_one_long_text_is_hashed_by_runs_of_words():
    rng = random.Random(1)
    text = prose(rng, 20_000)
    buf, offs = flat(pa.array([text * 30]))  # some 3 MB
    assert peak_mb(lambda: toxicity.word_hashes(buf, offs)) < 20 * len(buf) / 1e6  # at once: over 40 bytes each


def test_words_hash_alike_however_they_are_cut(monkeypatch):
    rng = random.Random(2)
    texts = [prose(rng, k) for k in (0, 1, 7, 300)] + [None, "x" * 500, "  kan " + "é" * 90 + " KAN, kan!", "...", prose(rng, 40)]
    whole = toxicity.word_hashes(*flat(pa.array(texts)))
    for run in (1, 16, 100, 1000):
        monkeypatch.setattr(toxicity, "RUN", run)
        cut = toxicity.word_hashes(*flat(pa.array(texts)))
        assert cut[0].tolist() == whole[0].tolist() and cut[1].tolist() == whole[1].tolist()
    alone = [h for t in texts if t for h in toxicity.word_hashes(*flat(pa.array([t])))[0].tolist()]
    assert whole[0].tolist() == alone


def test_scoring_holds_a_part_of_the_batch():
    rng = random.Random(3)
    texts = [prose(rng, 400) for _ in range(2500)]
    batch = pa.record_batch({"doc_id": pa.array(range(len(texts))), "text": pa.array(texts)})  # some 5 MB
    slots = np.sort(np.random.default_rng(3).choice(1 << toxicity.BITS, 5000, replace=False))
    w = np.linspace(-1, 1, len(slots))
    got = []

    def work():
        for rows, score in toxicity.scored(iter([batch]), (slots, w, 0.25)):
            got.append((rows.column("doc_id").to_pylist(), score))

    assert peak_mb(work) < 50
    assert [i for ids, _ in got for i in ids] == list(range(len(texts)))
    slot, doc = toxicity.distinct_features(*flat(batch.column("text")))
    dense = np.zeros(1 << toxicity.BITS)
    dense[slots] = w
    want = 1 / (1 + np.exp(-np.clip(np.bincount(doc, dense[slot], len(texts)) + 0.25, -35, 35)))
    assert np.allclose(np.concatenate([s for _, s in got]), want, rtol=1e-12)


def test_model_may_name_slots_in_any_order():
    batch = pa.record_batch({"doc_id": pa.array([1, 2]), "text": pa.array(["kan lord must", None])})
    slot = np.unique(toxicity.features(*flat(batch.column("text")))[0])
    w = np.arange(1.0, len(slot) + 1)
    (_, a), = toxicity.scored(iter([batch]), (slot, w, 0.0))
    (_, b), = toxicity.scored(iter([batch]), (slot[::-1], w[::-1], 0.0))
    assert a.tolist() == b.tolist() and a[1] == 0.5 < a[0]


def test_learning_does_not_copy_the_features():
    rng = np.random.default_rng(4)
    n, each = 2000, 3000
    rows = [np.sort(rng.choice(1 << 16, each, replace=False)).astype(np.int32) for _ in range(n)]
    y = (np.arange(n) % 2).astype(np.int32)
    ids = [*range(n - 2), 7, 7]  # rows that share an id are taken in the order of their features
    cut = [0, 900, 1800, n]
    batches = [pa.record_batch({"doc_id": pa.array(ids[a:b]), "y": pa.array(y[a:b]), "x": pa.array([r.tobytes() for r in rows[a:b]], pa.binary())})
               for a, b in zip(cut, cut[1:])]
    out = []
    assert peak_mb(lambda: out.extend(toxicity.learned(iter(batches), 16))) < 0.5 * n * each * 4 / 1e6
    order = sorted(range(n), key=lambda i: (hash((ids[i], 11)), ids[i], rows[i].tobytes()))
    w, bias = toxicity.ftrl([rows[i] for i in order], y[order].astype(float), 16)
    at = np.flatnonzero(w)
    assert out[0].column("slot").to_pylist() == [*at.tolist(), -1] and out[0].column("w").to_pylist() == [*w[at].tolist(), bias]
