"""Phrase collocation mining (11) against a brute-force version."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from credlake.llm import collocations as co

from .conftest import DOCS

COLS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute_counts(rows):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            f[lang].update(tuple(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    return f, n


def brute(rows, least=10, inside=50, top=2000):
    counts, n = brute_counts(rows)
    out = []
    for lang, f in counts.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in cand.items():
            if len(p) == 2 and any(len(q) == 3 and p in (q[:2], q[1:]) and 100 * b >= inside * a for q, b in cand.items()):
                continue
            score, _, left, right = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i, p.decode(), -a, left, r, n[lang], -s) for i, (s, a, p, left, r) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def texts(rng, n=260):
    words = ["a", "B", "cé", "日本", "d", "e", "\x00", "x'y", "A"]
    out = []
    for _ in range(n):
        t = "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", " ", ". ", ",", "\n", "\x0b"]) for _ in range(rng.randint(0, 30)))
        out.append(t + rng.choice(["", " red green blue", " red green. blue", " green blue"]))
    return out


@pytest.fixture(scope="module")
def rows(odd_texts):
    rng = random.Random(11)
    langs = [None, "", "en", "en", "en", "zz"]
    return [(rng.choice(langs), t) for t in [*odd_texts, *texts(rng)]] + [("en", "one two " * 4000), ("rare", "x y z")]


def frame(spark, rows):
    df = spark.createDataFrame([(i, t, lang, "s", 1) for i, (lang, t) in enumerate(rows)], DOCS)
    for c in ("w1", "f", "part", "payload", "a", "n", "score", "rank"):
        df = df.selectExpr("*", f"'x' AS {c}")
    return df.repartition(3)


@pytest.mark.parametrize("least, inside, top, limit, burst", [(10, 50, 2000, 1_200_000, 1 << 14), (2, 80, 7, 200, 16), (1, 50, 100_000, 5000, 64)])
def test_collocations(spark, rows, least, inside, top, limit, burst):
    got = co.collocations(frame(spark, rows), least, inside, top, limit=limit, burst=burst)
    assert got.columns == COLS and sorted(map(tuple, got.collect())) == brute(rows, least, inside, top)


def test_collocations_empty(spark, make_docs):
    assert co.collocations(make_docs([])).count() == 0
    assert co.collocations(make_docs([None, "", " .", "a b"])).count() == 0


def test_large_counts_are_exact(spark):
    a, left, r = 3 * 10**12 + 7, 10**13 + 9, 10**13 + 11
    row = spark.createDataFrame([(a, left, r), (a, a, a)], "a long, l long, r long").select(co._score("a", "l", "r").alias("s")).collect()
    assert [x.s for x in row] == [1000000 * a * a // (left * r), 1000000]


def test_trie_counts_whatever_bursts_and_spills():
    rng = np.random.default_rng(1)
    trie, want, spilled = co.HatTrie(burst=20), Counter(), Counter()
    for _ in range(80):
        ids = np.minimum(rng.geometric(.15, 60), 40)
        keys = co.ngram_keys(ids, np.cumsum(rng.random(60) < .1), 60)
        want.update(keys.tolist())
        trie.add(keys)
        assert trie.size == sum(map(len, trie.boxes)) and trie.edges == sorted(set(trie.edges))
        if trie.size > 400:
            k, c = trie.spill(.5)
            assert (np.diff(k.astype(np.int64)) > 0).all()
            left = {x >> 2 * co.BITS for b in trie.boxes for x in b}
            assert not left & {x >> 2 * co.BITS for x in k.tolist()}  # whole subtrees
            spilled.update(dict(zip(k.tolist(), c.tolist())))
    k, c = trie.spill(1)
    spilled.update(dict(zip(k.tolist(), c.tolist())))
    assert spilled == want and trie.size == 0


def test_words_that_share_a_hash(monkeypatch):
    monkeypatch.setattr(co, "span_hashes", lambda buf, start, end: (end - start).astype(np.uint64))
    buf = np.frombuffer(b"ab cd ab e f cd e", np.uint8)
    start, end = np.array([0, 3, 6, 9, 11, 13, 16]), np.array([2, 5, 8, 10, 12, 15, 17])
    ids = co.Ids()
    got = ids.take(buf, start, end)
    assert [ids.words[i] for i in got.tolist()] == [b"ab", b"cd", b"ab", b"e", b"f", b"cd", b"e"]


def test_merge_of_many_words(monkeypatch):
    """Words beyond what a key holds are merged through pairs."""
    ids, trie = co.Ids(), co.HatTrie()
    text = np.frombuffer(" ".join(f"w{i % 50}" for i in range(300)).encode(), np.uint8)
    start, end, _ = co.spans(text, np.array([0, len(text)]), co.IN_WORD)
    trie.add(co.ngram_keys(ids.take(text, start, end), np.zeros(len(start)), len(start)))
    made = list(co.runs(ids, *trie.spill(1), 1))
    table = pa.table({"lang": ["en"] * 2, "part": [0] * 2, "payload": [made[0][1]] * 2})
    one = sorted(map(str, co._merge(3)(table).to_pylist()))
    monkeypatch.setattr(co, "IDS", 3)
    assert sorted(map(str, co._merge(3)(table).to_pylist())) == one and len(one) == 151
