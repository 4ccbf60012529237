"""Silver/gold plans, sources, the file stream and the whole load."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from credlake import schemas as S
from credlake.operators.quality import QualityGateError
from credlake.plans import gold
from credlake.plans.bronze import documents_to_bronze
from credlake.plans.run import current_view, ingest_batch, init_warehouse, run_load
from credlake.plans.silver import build_silver
from credlake.sources import fixtures as fx
from credlake.sources.files import read_application_csv, read_documents, read_images
from credlake.sources.store import TableStore
from credlake.streaming.file_ingest import start_bronze_stream

from conftest import SAMPLE_DOCUMENT, SF_SMALL


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_fused_and_window_plans_agree(spark):
    b = fx.bronze_all(spark, SF_SMALL)
    cols = S.SILVER_COLUMNS
    assert _rows(build_silver(b, "fused"), cols) == _rows(build_silver(b, "window"), cols) == _rows(build_silver(b, "narrow"), cols)


def _bronze(spark, rows):
    """rows: (seq, key, payload dict, ts, is_doc)"""
    data = [(seq, key, json.dumps(p), "run", "f", ts, doc) for seq, key, p, ts, doc in rows]
    return spark.createDataFrame(data, S.BRONZE)


BASE = {"TARGET": "1", "NAME_CONTRACT_TYPE": "Cash", "CODE_GENDER": "F", "AMT_CREDIT": 1000.0,
        "AMT_INCOME_TOTAL": 500.0, "AMT_ANNUITY": 100.0, "DAYS_EMPLOYED": -730, "DAYS_BIRTH": -10000,
        "ORGANIZATION_TYPE": "o" * 60, "DAYS_REGISTRATION": -365.25}


def test_document_income_wins_even_zero(spark):
    t = dt.datetime(2024, 1, 1)
    b = _bronze(spark, [
        (1, "7", BASE, t, False),
        (2, "7", {"AMT_INCOME_TOTAL": 0.0, "IDP_METADATA": {"document_type": "d", "confidence_score": 30.0}}, t, True),
        (3, "8", BASE, t, False),
        (4, "9", {"AMT_INCOME_TOTAL": 5.0, "IDP_METADATA": {"document_type": "d", "confidence_score": 85.5}}, t, True),
    ])
    for method in ("fused", "narrow", "window"):
        out = {r["bk_id_solicitud"]: r for r in build_silver(b, method, keep_document_columns=True).collect()}
        assert set(out) == {7, 8}                           # document without base is dropped
        assert out[7]["amt_income_total"] == 0 and out[7]["credit_to_income_ratio"] is None
        assert out[8]["credit_to_income_ratio"] == 2 and out[8]["tipo_documento"] == S.LEGACY_DOC_TYPE
        assert len(out[8]["sector_economico"]) == 50 and out[8]["anios_residencia"] == 1
        assert out[8]["antiguedad_laboral_anios"] == 2 and out[8]["edad_anios"] == 27


@pytest.mark.parametrize("method", ["fused", "narrow", "window"])
def test_two_spellings_of_one_key_fail(spark, method):
    t = dt.datetime(2024, 1, 1)
    b = _bronze(spark, [(1, "7", BASE, t, False), (2, "007", BASE, t, False)])
    with pytest.raises(Exception, match="two"):
        build_silver(b, method).collect()


def test_fact_drops_null_product_and_missing_date(spark):
    silver = build_silver(fx.bronze_all(spark, SF_SMALL))
    dc = gold.build_dim_cliente(silver, gold.empty(spark, S.DIM_CLIENTE), "r")
    dp = gold.build_dim_producto(silver, gold.empty(spark, S.DIM_PRODUCTO), "r")
    dt_ = gold.build_dim_tiempo(gold.today(spark, "2024-01-07"), gold.empty(spark, S.DIM_TIEMPO))
    f = gold.build_fact(silver, dc, dp, dt_, gold.empty(spark, S.FACT), "2024-01-07", "r")
    assert f.count() == silver.filter(F.col("name_contract_type").isNotNull()).count()
    assert dt_.first()["dia_semana"] == 0
    f_missing = gold.build_fact(silver, dc, dp, dt_, gold.empty(spark, S.FACT), "2024-01-08", "r")
    assert f_missing.count() == 0                        # no time row -> zero fact rows


def test_proxy_default_one_column_upsert(spark):
    first = gold.build_dim_proxy(spark, gold.empty(spark, S.DIM_PROXY), "r1").collect()
    assert [(r["sk_proxy_documental"], r["via_airflow_run_id"]) for r in first] == [(1, "r1")]
    tgt = spark.createDataFrame([(1, "old", None, False, "r0", None)], S.DIM_PROXY)
    again = gold.build_dim_proxy(spark, tgt, "r2").first()
    assert (again["tipo_documento_origen"], again["via_airflow_run_id"], again["flag_verificacion_manual"]) == \
        (S.LEGACY_DOC_TYPE, "r0", False)


def test_csv_source_failfast_and_absent(spark, tmp_root):
    assert read_application_csv(spark, f"{tmp_root}/absent.csv") is None
    p = f"{tmp_root}/application_train.csv"
    with open(p, "w") as f:
        f.write("SK_ID_CURR,TARGET,NAME_CONTRACT_TYPE\n100002,1,Cash loans\n100003,NA,XNA\n")
    rows = read_application_csv(spark, p).collect()
    assert [tuple(r) for r in rows] == [("100002", "1", "Cash loans"), ("100003", None, "XNA")]
    bad = f"{tmp_root}/bad.csv"
    with open(bad, "w") as f:
        f.write("SK_ID_CURR,TARGET\n1,2,3\n")
    with pytest.raises(Exception):
        read_application_csv(spark, bad).collect()


def _write_docs(folder):
    os.makedirs(folder, exist_ok=True)
    sample = SAMPLE_DOCUMENT
    with open(f"{folder}/idp_boleta_20260615_020456.json", "w") as f:
        f.write(sample)
    with open(f"{folder}/idp_boleta_20260615_020457.json", "w") as f:
        f.write("{not json")
    with open(f"{folder}/other.json", "w") as f:
        f.write('{"SK_ID_CURR": "1"}')


def test_document_batch_quarantine(spark, tmp_root):
    _write_docs(f"{tmp_root}/raw")
    docs = read_documents(spark, f"{tmp_root}/raw")
    good, bad = documents_to_bronze(docs, "r")
    g = good.collect()
    assert [(r["bk_id_solicitud"], r["es_documento"], r["nombre_archivo_fuente"]) for r in g] == \
        [("999999", True, "idp_boleta_20260615_020456.json")]
    assert [r["motivo"] for r in bad.collect()] == ["json_invalido"]
    assert read_images(spark, f"{tmp_root}/nothing").count() == 0


def test_stream_ingests_once_and_archives(spark, tmp_root):
    raw = f"{tmp_root}/raw"
    _write_docs(raw)
    store = TableStore(spark, root=f"{tmp_root}/wh")
    args = dict(spark=spark, store=store, source_dir=raw, checkpoint_dir=f"{tmp_root}/ck",
                quarantine_dir=f"{tmp_root}/q", run_id="r", archive_dir=f"{tmp_root}/archive")
    start_bronze_stream(**args).awaitTermination()
    assert store.read("bronze.raw_application").count() == 1
    assert spark.read.parquet(f"{tmp_root}/q").count() == 1
    start_bronze_stream(**args).awaitTermination()       # same files: not loaded again
    assert store.read("bronze.raw_application").count() == 1


def test_whole_load_twice_is_idempotent(spark, tmp_root):
    store = TableStore(spark, root=f"{tmp_root}/wh")
    init_warehouse(store)
    bronze = fx.bronze_all(spark, SF_SMALL)
    as_of = dt.date(2024, 1, 7)
    run_load(spark, store, "r1", bronze_rows=bronze, as_of=as_of)
    v1 = _rows(current_view(store), [n for _, n in S.VIEW_COLUMNS])
    keys1 = _rows(store.read("gold.dim_cliente"), ["bk_id_solicitud", "sk_cliente"])
    run_load(spark, store, "r2", bronze_rows=bronze, as_of=as_of)   # replayed bronze: duplicates absorbed
    v2 = _rows(current_view(store), [n for _, n in S.VIEW_COLUMNS])
    keys2 = _rows(store.read("gold.dim_cliente"), ["bk_id_solicitud", "sk_cliente"])
    assert v1 == v2 and keys1 == keys2
    silver = store.read("silver.cleaned_application")
    assert store.read("gold.fact_creditos").count() == silver.filter(F.col("name_contract_type").isNotNull()).count()
    log = store.read("audit.etl_log").collect()
    assert sorted(r["log_id"] for r in log) == [1, 2, 3, 4]
    from credlake.operators.quality import star_integrity
    report = star_integrity(silver, *[store.read(t) for t in ("gold.dim_cliente", "gold.dim_producto",
                                                              "gold.dim_proxy_documental", "gold.dim_tiempo",
                                                              "gold.fact_creditos")]).first().asDict()
    assert set(report.values()) == {0}                            # no orphans, duplicates or NULL keys
    assert store.read("bronze.raw_application").count() == 2 * bronze.count()


def test_gate_stops_gold(spark, tmp_root):
    store = TableStore(spark, root=f"{tmp_root}/wh")
    t = dt.datetime(2024, 1, 1)
    bad = dict(BASE, AMT_CREDIT=-5.0)                   # negative ratio fails the gate
    rows = _bronze(spark, [(1, "1", bad, t, False)])
    with pytest.raises(QualityGateError):
        run_load(spark, store, "r", bronze_rows=rows, as_of=dt.date(2024, 1, 7))
    assert store.read("gold.fact_creditos").count() == 0


def test_batch_ingest_counters_and_payload_sink(spark, tmp_root):
    from credlake.operators.receipts import extract_receipts
    from credlake.plans.bronze import write_payloads
    from credlake.plans.run import ingest_batch
    csv = f"{tmp_root}/application_train.csv"
    with open(csv, "w") as f:
        f.write("SK_ID_CURR,TARGET,AMT_CREDIT\n1,0,10.0\n2,1,NA\n")
    rec = spark.createDataFrame([("1_a.jpg", "NETO A PAGAR S/ 1,000.00"), ("x_b.jpg", "NETO A PAGAR S/ 5.00")],
                                "nombre_archivo string, texto string")
    write_payloads(extract_receipts(rec), f"{tmp_root}/drop")
    store = TableStore(spark, root=f"{tmp_root}/wh")
    c = ingest_batch(spark, store, "r", csv_path=csv, docs_dir=f"{tmp_root}/drop",
                     quarantine_dir=f"{tmp_root}/q", docs_pattern="*.txt", docs_whole_file=False)
    assert c == {"csv_filas": 2, "documentos_filas": 1, "documentos_cuarentena": 0}
    b = store.read("bronze.raw_application").orderBy("id_secuencial").collect()
    assert [(r["bk_id_solicitud"], r["es_documento"]) for r in b] == [("1", False), ("2", False), ("1", True)]
    assert len({r["id_secuencial"] for r in b}) == 3
    silver = build_silver(store.read("bronze.raw_application").filter("bk_id_solicitud = '1'")).first()
    assert silver["amt_income_total"] == 1000 and silver["amt_credit"] == 10
    # the same landing files again: nothing is loaded twice
    again = ingest_batch(spark, store, "r2", csv_path=csv, docs_dir=f"{tmp_root}/drop",
                         quarantine_dir=f"{tmp_root}/q", docs_pattern="*.txt", docs_whole_file=False)
    assert again == {"csv_omitido": "application_train.csv", "documentos_filas": 0, "documentos_cuarentena": 0}
    assert store.read("bronze.raw_application").count() == 3


def test_store_ignores_and_skips_partial_versions(spark, tmp_root):
    store = TableStore(spark, root=f"{tmp_root}/wh")
    t = "gold.dim_producto"
    store.overwrite(t, spark.createDataFrame([(1, "a", "r", None)], S.DIM_PRODUCTO))
    os.makedirs(f"{store.table_dir(t)}/v=2")          # a load that died before its commit
    with open(f"{store.table_dir(t)}/v=2/part-0.parquet", "w") as f:
        f.write("garbage")
    assert [r["nombre_producto"] for r in store.read(t).collect()] == ["a"]
    p = store.overwrite(t, spark.createDataFrame([(2, "b", "r", None)], S.DIM_PRODUCTO))
    assert p.endswith("v=3") and [r["nombre_producto"] for r in store.read(t).collect()] == ["b"]


def test_image_manifest_to_receipt_ids(spark, tmp_root):
    from credlake.functions.text import id_prefix, is_numeric_id, upload_name
    land = f"{tmp_root}/landing"
    os.makedirs(land)
    for name in ["100002_boleta.jpg", "x_boleta.jpg", "notes.txt"]:
        with open(f"{land}/{name}", "wb") as f:
            f.write(b"\xff\xd8\xff")
    m = read_images(spark, land)
    rows = sorted((r["nombre_archivo"], r["tamano"]) for r in m.collect())
    assert rows == [("100002_boleta.jpg", 3), ("x_boleta.jpg", 3)]          # *.jpg only, bytes not loaded
    ids = {r["n"]: r["ok"] for r in m.select(F.col("nombre_archivo").alias("n"),
                                               is_numeric_id(id_prefix(F.col("nombre_archivo"))).alias("ok")).collect()}
    assert ids == {"100002_boleta.jpg": True, "x_boleta.jpg": False}
    up = spark.createDataFrame([("100002", "boleta.jpg")], "i string, n string")
    assert up.select(upload_name(F.col("i"), F.col("n")).alias("u")).first()["u"] == "100002_boleta.jpg"


def test_stream_archives_consumed_files(spark, tmp_root):
    raw, arch = f"{tmp_root}/raw", f"{tmp_root}/archive"
    _write_docs(raw)
    store = TableStore(spark, root=f"{tmp_root}/wh")
    args = dict(spark=spark, store=store, source_dir=raw, checkpoint_dir=f"{tmp_root}/ck",
                quarantine_dir=f"{tmp_root}/q", run_id="r", archive_dir=arch)
    start_bronze_stream(**args).awaitTermination()
    with open(f"{raw}/idp_boleta_20260615_020458.json", "w") as f:       # a later drop
        f.write(SAMPLE_DOCUMENT.replace("999999", "777"))
    start_bronze_stream(**args).awaitTermination()
    keys = sorted(r["bk_id_solicitud"] for r in store.read("bronze.raw_application").collect())
    assert keys == ["777", "999999"]
    archived = [f for _, _, fs in os.walk(arch) for f in fs]
    assert "idp_boleta_20260615_020456.json" in archived                # moved a batch later
    assert not os.path.exists(f"{raw}/idp_boleta_20260615_020456.json")


def test_incremental_silver_equals_full_rebuild(spark, tmp_root):
    from credlake.plans.run import load_silver
    prev, cur = fx.bronze_split(spark, SF_SMALL)
    full, inc = TableStore(spark, root=f"{tmp_root}/full"), TableStore(spark, root=f"{tmp_root}/inc")
    for store, incremental in ((full, False), (inc, True)):
        for i, rows in enumerate((prev, cur)):
            store.append_bronze(rows)
            load_silver(store, incremental=incremental, run_id=f"r{i}")
    cols = S.SILVER_COLUMNS
    a, b = _rows(full.read("silver.cleaned_application"), cols), _rows(inc.read("silver.cleaned_application"), cols)
    assert a == b and len(a) > 0
    assert inc.read("audit.silver_ledger").count() > 0
    # nothing new: an incremental load rebuilds no key and changes nothing
    load_silver(inc, incremental=True, run_id="r2")
    assert _rows(inc.read("silver.cleaned_application"), cols) == a


def test_view_sql_equals_dataframe_view(spark, tmp_root):
    from credlake.plans.view import publish_view_sql, risk_view
    store = TableStore(spark, root=f"{tmp_root}/wh")
    run_load(spark, store, "r", bronze_rows=fx.bronze_all(spark, SF_SMALL), as_of=dt.date(2024, 1, 7))
    tables = [store.read(t) for t in ("gold.fact_creditos", "gold.dim_cliente", "gold.dim_producto",
                                      "gold.dim_proxy_documental", "gold.dim_tiempo")]
    cols = [n for _, n in S.VIEW_COLUMNS]
    via_sql = publish_view_sql(spark, *tables)
    assert via_sql.columns == cols
    assert _rows(via_sql, cols) == _rows(risk_view(*tables), cols)


def test_run_load_from_landing_files_twice(spark, tmp_root):
    land = f"{tmp_root}/landing"
    rows = fx.application_rows(spark, SF_SMALL)
    rows.select(*[c for c in rows.columns if not c.startswith("_")]).coalesce(1) \
        .write.option("header", True).csv(f"{land}/csv")
    csv_file = [f for f in os.listdir(f"{land}/csv") if f.endswith(".csv")][0]
    _write_docs(f"{land}/raw")
    store = TableStore(spark, root=f"{tmp_root}/wh")
    init_warehouse(store)
    as_of = dt.date(2024, 1, 7)
    rep = run_load(spark, store, "r1", csv_path=f"{land}/csv/{csv_file}", docs_dir=f"{land}/raw",
                   quarantine_dir=f"{tmp_root}/q", as_of=as_of)
    assert rep.counters["csv_filas"] == rows.count() and rep.counters["documentos_filas"] == 1
    assert rep.counters["documentos_cuarentena"] == 1
    assert all(v for k, v in rep.gate.items() if k.startswith("check_"))
    n_customers = fx.table(spark, SF_SMALL, "customer").count()
    assert store.read("silver.cleaned_application").count() == n_customers
    view = current_view(store)
    assert view.count() == store.read("gold.fact_creditos").count() > 0
    rep2 = run_load(spark, store, "r2", csv_path=f"{land}/csv/{csv_file}", docs_dir=f"{land}/raw",
                    quarantine_dir=f"{tmp_root}/q", as_of=as_of)
    assert rep2.counters == {"csv_omitido": csv_file, "documentos_filas": 0, "documentos_cuarentena": 0}
    assert store.read("bronze.raw_application").count() == rows.count() + 1
    assert [r["filas_procesadas"] for r in store.read("audit.etl_log").orderBy("log_id").collect()][2:] == [0, 0]


def test_stream_sink_skips_committed_batch(spark, tmp_root):
    from credlake.streaming.file_ingest import bronze_sink
    store = TableStore(spark, root=f"{tmp_root}/wh")
    sink = bronze_sink(spark, store, f"{tmp_root}/q", "r", stream_id="s1")
    batch = spark.createDataFrame([(SAMPLE_DOCUMENT, "idp_boleta_1.json")], "value string, nombre_archivo string")
    sink(batch, 0)
    sink(batch, 0)        # the engine re-runs batch 0 after a failure
    assert store.read("bronze.raw_application").count() == 1
    sink(batch, 1)        # a new batch id is a new batch
    assert store.read("bronze.raw_application").count() == 2


def test_full_load_writes_the_ledger(spark, tmp_root):
    from credlake.plans.run import load_silver
    store = TableStore(spark, root=f"{tmp_root}/wh")
    store.append_bronze(fx.bronze_all(spark, SF_SMALL))
    load_silver(store, run_id="full")
    stamps = _rows(store.read("silver.cleaned_application"), ["bk_id_solicitud", "fecha_ingestion"])
    assert store.read("audit.silver_ledger").count() > 0
    load_silver(store, incremental=True, run_id="next")                 # nothing new: nothing is touched
    assert _rows(store.read("silver.cleaned_application"), ["bk_id_solicitud", "fecha_ingestion"]) == stamps


def test_proxy_conflict_keeps_its_load_time(spark):
    old = F.lit(dt.datetime(2020, 1, 1))
    dim = gold.build_dim_proxy(spark, gold.empty(spark, S.DIM_PROXY), "r1", now=old.cast("timestamp_ntz"))
    again = gold.build_dim_proxy(spark, dim, "r2").first()
    assert again["fecha_carga"] == dt.datetime(2020, 1, 1) and again["via_airflow_run_id"] == "r1"


def test_bad_documents_go_to_a_default_quarantine(spark, tmp_root):
    raw = f"{tmp_root}/raw"
    os.makedirs(raw)
    for name, text in (("a", "{'SK_ID_CURR':'1'}"), ("b", SAMPLE_DOCUMENT + " trailing"), ("c", SAMPLE_DOCUMENT)):
        with open(f"{raw}/{name}.json", "w") as f:
            f.write(text)
    store = TableStore(spark, root=f"{tmp_root}/wh")
    c = ingest_batch(spark, store, "r", docs_dir=raw, docs_pattern="*.json")
    assert (c["documentos_filas"], c["documentos_cuarentena"]) == (1, 2)
    assert spark.read.parquet(f"{store.root}/quarantine").count() == 2


def test_csv_doubled_quotes_and_backslashes(spark, tmp_root):
    from credlake.sources.files import read_application_csv
    os.makedirs(tmp_root, exist_ok=True)
    with open(f"{tmp_root}/x.csv", "w") as f:
        f.write('SK_ID_CURR,T\n1,"Shop ""A"", big"\n2,"ends with \\"\n')
    rows = read_application_csv(spark, f"{tmp_root}/x.csv").collect()
    assert [r["T"] for r in rows] == ['Shop "A", big', "ends with \\"]


def test_new_delivery_under_an_old_name_is_loaded(spark, tmp_root):
    store = TableStore(spark, root=f"{tmp_root}/wh")
    for folder, key in (("a", "1"), ("b", "2")):
        os.makedirs(f"{tmp_root}/{folder}")
        with open(f"{tmp_root}/{folder}/application_train.csv", "w") as f:
            f.write(f"SK_ID_CURR,TARGET\n{key},0\n")
    for run, folder in (("r1", "a"), ("r2", "b"), ("r3", "b")):
        ingest_batch(spark, store, run, csv_path=f"{tmp_root}/{folder}/application_train.csv")
    with open(f"{tmp_root}/b/application_train.csv", "w") as f:          # the same path, new content
        f.write("SK_ID_CURR,TARGET\n3,0\n4,0\n")
    ingest_batch(spark, store, "r4", csv_path=f"{tmp_root}/b/application_train.csv")
    rows = store.read("bronze.raw_application").select("bk_id_solicitud", "via_airflow_run_id").collect()
    assert sorted(map(tuple, rows)) == [("1", "r1"), ("2", "r2"), ("3", "r4"), ("4", "r4")]


def test_repaired_document_is_loaded(spark, tmp_root):
    raw = f"{tmp_root}/raw"
    _write_docs(raw)
    store = TableStore(spark, root=f"{tmp_root}/wh")
    ingest_batch(spark, store, "r1", docs_dir=raw)
    with open(f"{raw}/idp_boleta_20260615_020457.json", "w") as f:
        f.write(SAMPLE_DOCUMENT.replace("999999", "5"))
    c = ingest_batch(spark, store, "r2", docs_dir=raw)
    assert (c["documentos_filas"], c["documentos_cuarentena"]) == (1, 0)
    assert sorted(r[0] for r in store.read("bronze.raw_application").select("bk_id_solicitud").collect()) == ["5", "999999"]


def test_batch_archives_loaded_files(spark, tmp_root):
    raw, arch = f"{tmp_root}/raw files", f"{tmp_root}/archive"           # a blank is escaped in file URIs
    store = TableStore(spark, root=f"{tmp_root}/wh")
    for run in ("r1", "r2"):                                              # the second delivery has the same names
        _write_docs(raw)
        ingest_batch(spark, store, run, docs_dir=raw, archive_dir=arch)
        assert sorted(os.listdir(raw)) == ["other.json"]
    names = [n for n in os.listdir(arch) if not n.startswith(".")]
    assert sorted(names) == [f"idp_boleta_20260615_02045{i}.json{s}" for i in (6, 7) for s in ("", ".1")]


def test_bronze_files_do_not_grow_with_tasks(spark, tmp_root):
    counts = []
    for tasks in (2, 40):
        store = TableStore(spark, root=f"{tmp_root}/wh{tasks}")
        store.append_bronze(fx.bronze_base(spark, SF_SMALL).repartition(tasks))
        b = store.read("bronze.raw_application")
        counts.append(b.select(F.col("_metadata.file_path")).distinct().count())
    assert counts[0] == counts[1]


SILVER_ROW = {"bk_id_solicitud": 1, "name_contract_type": "Cash"}
FACT_ROW = {"sk_fact": 1, "dd_id_solicitud": 1, "sk_cliente": 1, "sk_producto": 1, "sk_tiempo": 1, "sk_proxy_documental": 1}


@pytest.mark.parametrize("table,rows,rule", [
    ("silver.cleaned_application", [SILVER_ROW, SILVER_ROW], "duplicado_bk_id_solicitud"),
    ("silver.cleaned_application", [dict(SILVER_ROW, bk_id_solicitud=None)], "nulo_bk_id_solicitud"),
    ("silver.cleaned_application", [dict(SILVER_ROW, code_gender="x" * 11)], "largo_code_gender"),
    ("gold.dim_producto", [{"sk_producto": 1, "nombre_producto": "a"}, {"sk_producto": 2, "nombre_producto": "a"}],
     "duplicado_nombre_producto"),
    ("gold.fact_creditos", [FACT_ROW, dict(FACT_ROW, sk_fact=2)], "duplicado_dd_id_solicitud"),
    ("gold.fact_creditos", [dict(FACT_ROW, sk_cliente=9)], "huerfano_sk_cliente"),
    ("gold.fact_creditos", [dict(FACT_ROW, sk_tiempo=9)], "huerfano_sk_tiempo"),
])
def test_violated_constraint_keeps_the_previous_version(spark, tmp_root, table, rows, rule):
    from credlake.operators.quality import ConstraintError, constraint_check
    store = TableStore(spark, root=f"{tmp_root}/wh")

    def frame(name, data):
        cols = S.TABLES[name].fieldNames()
        loose = S.T.StructType([S.T.StructField(f.name, f.dataType, True) for f in S.TABLES[name].fields])
        return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in data], loose)

    parents = {"gold.dim_cliente": {"sk_cliente": 1}, "gold.dim_producto": {"sk_producto": 1},
               "gold.dim_tiempo": {"sk_tiempo": 1}, "gold.dim_proxy_documental": {"sk_proxy_documental": 1}}
    if table == "gold.fact_creditos":
        for name, row in parents.items():
            store.overwrite(name, frame(name, [row]))
    first = store.overwrite(table, frame(table, [rows[0] if len(rows) > 1 else {
        "silver.cleaned_application": SILVER_ROW, "gold.fact_creditos": FACT_ROW}[table]]),
        check=constraint_check(table, store.read))
    with pytest.raises(ConstraintError, match=rule):
        store.overwrite(table, frame(table, rows), check=constraint_check(table, store.read))
    assert store.current_path(table) == first and store.read(table).count() == 1


def test_published_view_in_another_session_after_three_loads(spark, tmp_root):
    from credlake.session import scratch_dir
    store = TableStore(spark, root=f"{tmp_root}/wh")
    init_warehouse(store)
    for i in range(3):
        run_load(spark, store, f"r{i}", bronze_rows=fx.bronze_all(spark, SF_SMALL), as_of=dt.date(2024, 1, 7 + i),
                 view_name="vista_publicada")
    other = spark.newSession().table("vista_publicada")
    assert other.columns == [n for _, n in S.VIEW_COLUMNS]
    assert {r[0] for r in other.select("fecha_evaluacion_datos").distinct().collect()} == {dt.date(2024, 1, 9)}
    assert sorted(r["log_id"] for r in store.read("audit.etl_log").collect()) == [1, 2, 3, 4, 5, 6]
    assert len(store._versions("gold.fact_creditos")) == 2
    # a load that dies after its commits leaves the view readable
    for _ in range(3):
        store.overwrite("gold.fact_creditos", store.read("gold.fact_creditos"))
    assert other.count() > 0
    scratch = os.path.dirname(scratch_dir(spark, "x")).removeprefix("file:")
    before = set(os.listdir(scratch))
    run_load(spark, store, "r9", bronze_rows=fx.bronze_all(spark, SF_SMALL), as_of=dt.date(2024, 1, 7),
             view_name="vista_publicada")
    assert set(os.listdir(scratch)) == before
