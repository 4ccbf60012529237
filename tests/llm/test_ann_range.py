"""Nearest neighbours (6): vectors at the ends of the doubles' range."""

from __future__ import annotations

import math

import pytest

from credlake.llm import ann


@pytest.mark.parametrize("tiny", [1e-200, 5e-324, 1e-308])
def test_cosines_of_extreme_vectors(spark, tiny):
    rows = [(0, [1.0, 2.0]), (1, [tiny, 2 * tiny]), (2, [1e300, -1e300]), (3, [3.0, 1.0]), (4, [0.0, 1e-150]), (5, [0.0, 0.0]), (6, [1.7e308, 1e308])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: r.score for r in ann.search(df, df.where("vec_id = 0"), visit=1.0).collect()}
    assert got == pytest.approx({1: 1.0, 2: -1 / math.sqrt(10), 3: 5 / math.sqrt(50), 4: 2 / math.sqrt(5), 6: 3.7 / math.hypot(1.7, 1) / math.sqrt(5)})


def test_common_vectors_stay_as_they_are(spark):
    df = spark.createDataFrame([(0, [0.1, -0.30000001]), (1, [1e-99, 1e99])], "vec_id long, embedding array<double>")
    assert {tuple(r.v) for r in ann.usable(df).collect()} == {(0.1, -0.30000001), (1e-99, 1e99)}
