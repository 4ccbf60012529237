"""Ranked lexical search (12) against a brute-force version."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from credlake.llm import lexical_search, words

from .conftest import prose

ITEMS = "item_id long, text string, score string"


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top):
    """Rows (item row, rank, doc_id, score); docs and items are (id, text)."""
    held = [(i, Counter(terms(t))) for i, t in docs]
    N, L = sum(bool(c) for _, c in held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in held:
            n, s = sum(c.values()), 0
            for t in set(terms(text)) & set(c):
                w = math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1)))
                s += w * ((1000000000 * c[t]) // (1000 * c[t] + 20 * (50 + (50 * n * N) // L)))
            if s > 0:
                found.append((-s, i is None, i))
        out += [(item, k, i, -s) for k, (s, _, i) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:top], 1)]
    return Counter(out)


def got(docs, items, **kw):
    return Counter((r.item_id, r.rank, r.doc_id, r.score) for r in lexical_search.ranked_search(docs, items, **kw).collect())


@pytest.fixture(scope="module")
def corpus(odd_texts):
    rng = random.Random(12)
    texts = [*odd_texts, *(prose(rng, rng.randint(0, 80)) for _ in range(120)), "Straße ÉTÉ été 123 a-b_c", "\x00a\x7fb"]
    texts += [" ".join(f"w{min(int(rng.paretovariate(.7)), 3000)}" for _ in range(rng.randint(1, 60))) for _ in range(150)]
    items = [(1, prose(rng, 20)), (2, " ".join(f"w{k}" for k in (1, 2, 3, 5, 8, 40, 70))), (3, None), (4, "... !"), (5, "été 日本語 のテキスト"),
             (6, "zzz"), (7, "W1 w1 w1"), (7, "W1 w1 w1"), (None, "a b"), (8, texts[-1] + texts[-2])]
    return texts, items


@pytest.mark.parametrize("short", [1, 40, 100_000])
def test_ranked_search(spark, make_docs, corpus, short):
    texts, items = corpus
    ids = [None if i % 40 == 3 else (i * 7) % 211 for i in range(len(texts))]
    docs, q = make_docs(texts, ids, extra=True).repartition(3), spark.createDataFrame([(*x, "s") for x in items], ITEMS)
    for top in (1, 7, 1000):
        assert got(docs, q, top=top, short=short) == brute(list(zip(ids, texts)), items, top)


def test_ranked_search_in_blocks(spark, make_docs, corpus):
    texts, items = corpus
    q = spark.createDataFrame([(*x, "s") for x in items], ITEMS)
    assert got(make_docs(texts), q, top=5, block_bytes=300) == brute(list(enumerate(texts)), items, 5)


def test_ranked_search_empty(spark, make_docs):
    q, none = spark.createDataFrame([(1, "a", "s")], ITEMS), spark.createDataFrame([], ITEMS)
    assert not got(make_docs([]), q) and not got(make_docs([None, "", " ."]), q) and not got(make_docs(["a"]), none)


def test_windows_skip_nothing(monkeypatch):
    """Random lists, windows of 16 documents: the best are those of whole sums, ties included."""
    monkeypatch.setattr(lexical_search, "WINDOW", 16)
    rng = np.random.default_rng(3)
    for trial in range(60):
        n, k = int(rng.integers(1, 300)), int(rng.integers(1, 9))
        whole, lists = np.zeros(n, np.int64), []
        for _ in range(k):
            doc = np.flatnonzero(rng.random(n) < rng.choice([.02, .3, .9]))
            if len(doc):
                score = rng.integers(0, 9, len(doc))
                lists.append(lexical_search.List(doc, score))
                whole[doc] += score
        ids, nil, best = np.arange(n) * 3, np.zeros(n, bool), lexical_search.Best(5)
        lexical_search.search(lists, n, best, ids, nil, short=int(rng.choice([0, 30, 10_000])))
        want = sorted((-s, i * 3) for i, s in enumerate(whole.tolist()) if s > 0)[:5]
        assert list(zip((-best.score).tolist(), best.id.tolist())) == want


def test_words_that_share_a_hash_differ(monkeypatch):
    monkeypatch.setattr(lexical_search, "span_hashes", lambda buf, start, end: np.zeros(len(start), np.uint64))
    v = lexical_search.Vocabulary([b"ab", b"abc", b"x" * 200, "é".encode()])
    buf = np.frombuffer(b"abc ab " + b"x" * 200 + b" " + b"x" * 199 + "y é e".encode(), np.uint8)
    start, end, _ = words.spans(buf, np.array([0, len(buf)]), lexical_search.IN_TERM)
    names = [v.terms[i] if i >= 0 else None for i in v.find(buf, start, end)]
    assert names == [b"abc", b"ab", b"x" * 200, None, "é".encode(), None]
