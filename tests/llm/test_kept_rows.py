"""Stages that keep one row of a class: ids that repeat, rows alike, nulls, clashing columns."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from credlake.llm import exact_dedup, simhash_dedup, suffix_dedup

from .conftest import prose


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("ids, texts, want", [
    ([5, 5, 7], ["a", "b", "a"], {(5, "b"), (7, "a")}),
    ([5, 5], ["a", "a"], {(5, "a")}),
    ([None, 3, None], ["x", "X", "y"], {(3, "X"), (None, "y")}),
    ([None, None], [None, ""], None)])
def test_one_row_of_each_class(make_docs, ids, texts, want):
    got = exact_dedup.drop_copies(make_docs(texts, ids, extra=True), keep="largest").select("doc_id", "text").collect()
    if want is None:
        assert len(got) == 1 and got[0].doc_id is None
    else:
        assert sorted(map(str, got)) == sorted(map(str, make_docs(*zip(*[(t, i) for i, t in want])).select("doc_id", "text").collect()))


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_drop_copies_of_many(make_docs, keep):
    rng = random.Random(5)
    texts = [rng.choice(["a", "A", "b", "c d", None, ""]) for _ in range(200)]
    ids = [rng.choice([None, *range(12)]) for _ in texts]
    docs = make_docs(texts, ids)
    got = exact_dedup.drop_copies(docs, keep=keep)
    kept = got.select("doc_id", "text").collect()
    classes = {}
    for i, t in zip(ids, texts):
        classes.setdefault((t or "").lower(), []).append(i)
    pick = {c: (max if keep == "largest" else min)([i for i in x if i is not None], default=None) for c, x in classes.items()}
    assert {(r.text or "").lower(): r.doc_id for r in kept} == pick and len(kept) == len(classes)
    assert rows_of(got) <= rows_of(docs)


def test_one_row_of_each_component(make_docs):
    rng = random.Random(6)
    a, b = prose(rng, 200), prose(rng, 200)
    texts = [a, a, a + " x", b, b, b, None, "", " ", "only"]
    ids = [4, 4, 9, 4, 4, 2, None, 1, None, None]
    docs = make_docs(texts, ids, extra=True)
    got = simhash_dedup.drop_near_copies(docs)
    assert rows_of(got.select("doc_id")) == Counter([(4,), (2,), (1,), (None,)]) and got.columns == docs.columns
    assert rows_of(got) <= rows_of(docs)


def test_stages_take_any_columns(make_docs, odd_texts):
    docs = make_docs(odd_texts, extra=True)
    assert suffix_dedup.strip_repeats(docs).count() == len(odd_texts)
    assert exact_dedup.drop_copies(make_docs([])).count() == 0 and simhash_dedup.drop_near_copies(make_docs([])).count() == 0


def test_null_ids_do_not_share_a_task(make_docs):
    docs = make_docs([f"text {i}" for i in range(400)], [None] * 400)
    plan = suffix_dedup._apply(docs, 50, None, docs.schema)._jdf.queryExecution().toString()
    assert "xxhash64(text" in plan


def test_stretches_that_share_a_hash_only():
    """With one hash for all, a task drops a stretch only if it has its bytes from a smaller document."""
    rng = np.random.default_rng(2)
    memory, before = suffix_dedup.Memory(), []
    for _ in range(6):
        words = [bytes(rng.integers(97, 99, rng.integers(1, 4), dtype=np.uint8)) for _ in range(40)]
        doc = rng.integers(0, 30, 40)
        buf = np.frombuffer(b"".join(words), np.uint8)
        size = np.array([len(w) for w in words])
        first = np.cumsum(size) - size
        for h in (np.zeros(40, np.uint64), np.array([hash(w) & 7 for w in words], np.uint64)):
            own = memory.smaller(h, doc, buf, first, size)
            now = before + list(zip(words, doc.tolist()))
            for w, d, gone in zip(words, doc.tolist(), own.tolist()):
                assert not gone or any(x == w and i < d for x, i in now)
        before = now


def test_memory_finds_what_came_before():
    memory = suffix_dedup.Memory()
    buf = np.frombuffer(b"abcabcxyz", np.uint8)
    first, size, h = np.array([0, 3, 6]), np.array([3, 3, 3]), np.array([1, 1, 2], np.uint64)
    assert memory.smaller(h, np.array([5, 7, 7]), buf, first, size).tolist() == [False, True, False]
    assert memory.smaller(h, np.array([6, 4, 9]), buf, first, size).tolist() == [True, False, False]
    assert memory.smaller(h[:1], np.array([5]), buf, first[:1], size[:1]).tolist() == [True]
