"""Property tests: upsert and latest-record against plain-Python models."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from credlake.operators.latest import latest_per_key
from credlake.operators.upsert import upsert

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

keys = st.integers(min_value=-200_000, max_value=200_000)
rows = st.dictionaries(keys, st.text(alphabet="abc", max_size=3), max_size=12)


@SETTINGS
@given(target=rows, source=rows, update=st.booleans())
def test_upsert_matches_model(spark, target, source, update):
    tgt_rows = [(i + 1, k, v) for i, (k, v) in enumerate(sorted(target.items()))]
    tgt = spark.createDataFrame(tgt_rows, "sk int, k int, v string")
    src = spark.createDataFrame(sorted(source.items()), "k int, v string")
    out = upsert(tgt, src, ["k"], update_cols=None if update else [], sk_col="sk").collect()
    got = {r["k"]: (r["sk"], r["v"]) for r in out}
    assert len(got) == len(out)                                   # one row per key
    expected_v = dict(target)
    for k, v in source.items():
        if k not in target or update:
            expected_v[k] = v
    assert {k: v for k, (_, v) in got.items()} == expected_v
    for k in target:                                              # existing keys keep their surrogate key
        assert got[k][0] == dict((kk, s) for s, kk, _ in tgt_rows)[k]
    new = sorted(k for k in source if k not in target)            # new keys continue densely, in key order
    assert [got[k][0] for k in new] == list(range(len(target) + 1, len(target) + 1 + len(new)))


events = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]),
                            st.one_of(st.none(), st.integers(min_value=0, max_value=5)),
                            st.integers(min_value=0, max_value=10**6)),
                  min_size=1, max_size=15, unique_by=lambda t: t[2])


@SETTINGS
@given(evs=events)
def test_latest_matches_model(spark, evs):
    base = dt.datetime(2024, 1, 1)
    data = [(k, None if d is None else base + dt.timedelta(days=d), seq) for k, d, seq in evs]
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, seq long")
    expected = {}
    for k, ts, seq in data:   # DESC NULLS FIRST on ts, then DESC on seq
        rank = (ts is None, ts or base, seq)
        if k not in expected or rank > expected[k][0]:
            expected[k] = (rank, seq)
    for method in ("window", "aggregate"):
        got = {r["k"]: r["seq"] for r in latest_per_key(df, ["k"], "ts", "seq", method=method).collect()}
        assert got == {k: v[1] for k, v in expected.items()}
