"""The driver contract in __spark_entry__.py."""

import importlib.util
import os

from credlake import schemas as S

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_every_query_has_an_oracle():
    mod = _entry_module()
    from credlake.queries import queries as core

    assert set(mod.oracle_sql()) <= set(mod.queries())
    assert set(core()) <= set(mod.oracle_sql())  # the training-data queries have SQL only where it expresses them
    assert len(mod.queries()) >= 25


def test_entry_runs_with_stable_schema(spark):
    df = _entry_module().entry(spark)
    assert df.columns == [name for _, name in S.VIEW_COLUMNS]
    assert df.count() > 0
