"""Toxicity (1): the learner and its features against plain loops."""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from credlake.llm import toxicity
from credlake.llm.common import flat

from .conftest import WORDS


def plain_ftrl(rows, y, epochs, alpha, beta, l1, l2):
    """One coordinate at a time; "bias" is in every row and has no L1."""
    z, n = {}, {}

    def weight(i):
        zi, pen = z.get(i, 0.0), 0.0 if i == "bias" else l1
        if abs(zi) <= pen:
            return 0.0
        return -(zi - math.copysign(pen, zi)) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(epochs):
        for slots, label in zip(rows, y):
            w = {i: weight(i) for i in [*slots, "bias"]}
            g = 1 / (1 + math.exp(-max(-35.0, min(35.0, sum(w.values()))))) - label
            for i, wi in w.items():
                before = n.get(i, 0.0)
                n[i] = before + g * g
                z[i] = z.get(i, 0.0) + g - (math.sqrt(n[i]) - math.sqrt(before)) / alpha * wi
    return {i: weight(i) for i in z}


@pytest.mark.parametrize("settings", [dict(epochs=1, alpha=1.0, beta=1.0, l1=0.0, l2=0.0), dict(epochs=4, alpha=1.0, beta=1.0, l1=1.0, l2=0.01),
                                      dict(epochs=6, alpha=0.3, beta=2.0, l1=0.4, l2=1.0), dict(epochs=4, alpha=1.0, beta=1.0, l1=8.0, l2=0.01)])
def test_weights_are_those_of_the_plain_loop(settings):
    rng = np.random.default_rng(3)
    y = (rng.random(50) < 0.4).astype(float)
    rows = [np.unique(np.concatenate([rng.integers(0, 60, rng.integers(0, 15)), [60] if label else [61]])).astype(np.int32) for label in y]
    w, bias = toxicity.ftrl(rows, y, bits=6, **settings)
    want = plain_ftrl([r.tolist() for r in rows], y, **settings)
    assert bias == pytest.approx(want["bias"], rel=1e-9, abs=1e-12)
    assert w.tolist() == pytest.approx([want.get(i, 0.0) for i in range(64)], rel=1e-9, abs=1e-12)
    if 0 < settings["l1"] < 8:  # sparse, but the words that decide remain
        assert w[60] > 0 > w[61] and (w == 0).sum() > 2


def test_features_are_words_pairs_and_skip_pairs():
    rng = random.Random(8)
    texts = [" ".join(rng.choice(WORDS[:9]) for _ in range(k)) for k in (0, 1, 2, 3, 12, 40)] + [None, "KAN, kan!", "  kan  "]
    slot, doc = toxicity.features(*flat(pa.array(texts)), bits=60)
    found, want = {}, {}
    for s, d in zip(slot.tolist(), doc.tolist()):
        found.setdefault(d, []).append(s)
    for d, text in enumerate(texts):
        words = (text or "").lower().replace(",", " ").replace("!", " ").split()
        grams = words + [("pair", *p) for p in zip(words, words[1:])] + [("skip", *p) for p in zip(words, words[2:])]
        if grams:
            want[d] = grams
    assert found.keys() == want.keys()

    def spread(by):  # where each feature occurs and how often, whatever it is called
        return sorted([(d, by[d].count(f)) for d in by if f in by[d]] for f in {f for x in by.values() for f in x})
    assert spread(found) == spread(want)
