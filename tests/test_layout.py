"""Folders of stored tables stay few, however far the ids span."""

import datetime as dt
import os

from pyspark.sql import functions as F

from credlake.plans.run import load_silver, run_load
from credlake.sources.store import BRONZE_TABLE, RANGE_FOLDERS, TableStore, key_range
from test_incremental import CLIENT, DAY, FACT, SILVER, bronze

SPAN = 65536 * RANGE_FOLDERS


def folders(path):
    return sorted(d for d, _, names in os.walk(path.removeprefix("file:")) if any(n.endswith(".parquet") for n in names))


def test_folders_do_not_grow_with_the_span_of_the_ids(spark, tmp_root):
    store = TableStore(spark, root=f"{tmp_root}/wh")
    ids = [65536 * r + 5 for r in range(0, 3 * RANGE_FOLDERS, 2)]
    store.append_bronze(bronze(spark, ids))
    load_silver(store, run_id="r1")
    assert len(folders(store.table_dir(BRONZE_TABLE))) == len(folders(store.table_dir(SILVER))) == RANGE_FOLDERS // 2
    files = [n for d in folders(store.table_dir(SILVER)) for n in os.listdir(d) if n.endswith(".parquet")]
    assert len(files) == RANGE_FOLDERS // 2  # the ranges of a folder are written together
    assert sorted(r["bk_id_solicitud"] for r in store.read(SILVER).collect()) == ids


def test_ranges_of_one_folder_are_loaded_apart(spark, tmp_root):
    store = TableStore(spark, root=f"{tmp_root}/wh")
    ids = [1, SPAN + 1, 2 * SPAN + 1, 65537]
    kw = {"incremental": True, "view_name": "v_carpetas"}
    run_load(spark, store, "r1", bronze_rows=bronze(spark, ids), as_of=DAY, **kw)
    run_load(spark, store, "r2", bronze_rows=bronze(spark, [SPAN + 1, SPAN + 2], seq=10, income=50.0), as_of=dt.date(2024, 1, 9), **kw)
    fact = {r["dd_id_solicitud"]: (r["amt_income_total"], r["via_airflow_run_id"], r["sk_fact"]) for r in store.read(FACT).collect()}
    assert fact == {1: (500, "r1", 1), 65537: (500, "r1", 2), SPAN + 1: (50, "r2", 3), 2 * SPAN + 1: (500, "r1", 4), SPAN + 2: (50, "r2", 5)}
    assert store.read(CLIENT).count() == store.read(SILVER).count() == spark.table("v_carpetas").count() == 5
    assert sorted(r["bk_id_solicitud"] for r in store.read(SILVER, [1]).collect()) == [65537]


def test_tables_with_a_folder_per_range_are_still_read(spark, tmp_root, monkeypatch):
    import credlake.sources.store as store_module
    store = TableStore(spark, root=f"{tmp_root}/wh")
    kw = {"incremental": True, "view_name": "v_antes"}
    monkeypatch.setattr(store_module, "range_folder", lambda r: r.cast("long"))  # as it was
    run_load(spark, store, "r1", bronze_rows=bronze(spark, [1, SPAN + 1, SPAN + 3, 65537]), as_of=DAY, **kw)
    assert f"rango_clave={RANGE_FOLDERS}" in [r for _, held in store._layout(SILVER) for r in held]
    monkeypatch.undo()
    run_load(spark, store, "r2", bronze_rows=bronze(spark, [SPAN + 1], seq=10, income=50.0, documents=True), as_of=DAY, **kw)
    fact = {r["dd_id_solicitud"]: (r["amt_credit"], r["amt_income_total"]) for r in store.read(FACT).collect()}
    assert fact == {1: (1000, 500), 65537: (1000, 500), SPAN + 1: (1000, 50), SPAN + 3: (1000, 500)}
    assert store.read(SILVER).count() == spark.table("v_antes").count() == 4


def test_folder_numbers_of_odd_ids(spark):
    ids = spark.createDataFrame([("-1",), ("0",), ("2147483647",), ("x",), (None,)], "k string")
    got = [r[0] for r in ids.select(key_range(F.col("k"))).collect()]
    assert got == [RANGE_FOLDERS - 1, 0, 32767 % RANGE_FOLDERS, None, None]


def test_loads_parse_only_the_latest_records(spark, tmp_root, monkeypatch):
    import credlake.plans.run as run_module
    store, used, build = TableStore(spark, root=f"{tmp_root}/wh"), [], run_module.build_silver
    odd = bronze(spark, [1, 2, 3]).withColumn("datos_origen_raw", F.when(F.col("id_secuencial") == 1, "{").otherwise(F.col("datos_origen_raw")))
    store.append_bronze(odd.unionByName(bronze(spark, [1, 3], seq=10, income=7.0)))
    monkeypatch.setattr(run_module, "build_silver", lambda rows, method: used.append((rows, method)) or build(rows, method))
    load_silver(store, run_id="r1")
    [(rows, method)] = used
    assert method == "fused" and sorted(build(rows, "fused").collect()) == sorted(build(rows, "narrow").collect())
    assert {r["bk_id_solicitud"]: r["amt_income_total"] for r in store.read(SILVER).collect()} == {1: 7, 2: 500, 3: 7}
