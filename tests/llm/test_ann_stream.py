"""Nearest neighbours (6): queries streamed past buckets, lengths apart, recall at the registered settings."""

from __future__ import annotations

import numpy as np
import pytest

from credlake.llm import ann

SHAPE = "vec_id long, embedding array<double>"


def brute(ids, x, queries, top=5):
    norm = np.sqrt((x * x).sum(axis=1))
    out = {}
    for i in np.flatnonzero(np.isin(ids, queries)):
        score = (x * x[i]).sum(axis=1) / (norm * norm[i])
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[i]][:top]
        out[int(ids[i])] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def found(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


@pytest.mark.parametrize("held, batch", [(7, 3), (40, 10_000), (100_000, 5)])
def test_buckets_of_any_size_and_batches_cut_anywhere(spark, monkeypatch, held, batch):
    monkeypatch.setattr(ann, "HELD", held)
    rng = np.random.default_rng(held)
    x = np.round(rng.normal(size=(260, 6)), 1)
    x[30:120] = x[7]  # a crowd in one cell, ties by id
    ids = np.arange(260)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], SHAPE)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = found(ann.search(df, df.where("vec_id % 9 = 0"), k=4, visit=1.0).collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == brute(ids, x, ids[::9])


def test_each_length_is_an_index_of_its_own(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, [2.0]), (4, [-1.0]), (5, [3.0]), (6, [1.0, 2.0, 3.0]), (7, [0.0, 1.0]), (8, [])]
    df = spark.createDataFrame(rows, SHAPE)
    got = found(ann.search(df, df, visit=1.0).collect())
    assert {q: [v for v, _ in best] for q, best in got.items()} == {1: [2, 7], 2: [1, 7], 7: [2, 1], 3: [5, 4], 4: [3, 5], 5: [3, 4]}
    assert got[3] == [(5, 1.0), (4, -1.0)]


def test_recall_at_the_registered_settings(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 32))  # no structure at all: the hardest case
    ids = np.arange(3000)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], SHAPE)
    got, want = found(ann.search(df, df.where("vec_id % 50 = 0")).collect()), brute(ids, x, ids[::50])
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    score = {q: dict(v) for q, v in want.items()}
    assert all(s == score[q][i] for q, v in got.items() for i, s in v if i in score[q])
    hit = sum(len({i for i, _ in got[q]} & score[q].keys()) for q in want)
    assert hit / (5 * len(want)) >= 0.9


def test_the_index_is_shuffled_once(spark):
    df = spark.createDataFrame([(i, [float(i + 1), 1.0]) for i in range(200)], SHAPE)
    plan = ann._found(ann.usable(df), df, 2, 5, 4, 0.5, 100)._jdf.queryExecution().toString()
    assert "explode" not in plan.lower() and "CoGroup" not in plan and plan.count("RepartitionByExpression") >= 1
