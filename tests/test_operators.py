"""Operators on tiny frames: latest record, upserts, surrogate keys, quality,
audit, receipts, ledger."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from credlake.operators.audit import audit_entries, with_log_ids
from credlake.operators.bronze import na_to_null, pack_bronze
from credlake.operators.keys import assign_keys, max_key
from credlake.operators.latest import latest_per_key
from credlake.operators.ledger import not_yet_ingested
from credlake.operators.quality import (QualityGateError, duplicate_keys, enforce, key_violations, orphans, silver_gate, star_integrity,
                                        varchar_violations)
from credlake.operators.receipts import extract_receipts
from credlake.operators.upsert import insert_ignore, upsert
from credlake import schemas as S

from conftest import SAMPLE_DOCUMENT

T1, T2, T3 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3)


@pytest.mark.parametrize("method", ["window", "aggregate"])
def test_latest_nulls_first_and_sequence_tiebreak(spark, method):
    df = spark.createDataFrame([
        ("a", T1, 1, "old"), ("a", T3, 2, "new"), ("a", T3, 3, "newest-seq"),
        ("b", T2, 4, "dated"), ("b", None, 5, "null-ts"),
        ("c", None, 6, "n1"), ("c", None, 7, "n2"),
    ], "k string, ts timestamp_ntz, seq long, v string")
    got = {r["k"]: r["v"] for r in latest_per_key(df, ["k"], "ts", "seq", method=method).collect()}
    assert got == {"a": "newest-seq", "b": "null-ts", "c": "n2"}


def _tgt(spark):
    return spark.createDataFrame([(1, 10, "a", "r0", None), (2, 20, "b", "r0", None)],
                                 "sk int, k int, v string, run string, ts timestamp_ntz")


def test_full_upsert_new_existing_absent(spark):
    src = spark.createDataFrame([(20, "B", "r1"), (30, "c", "r1")], "k int, v string, run string")
    out = {r["k"]: r for r in upsert(_tgt(spark), src, ["k"], touch_cols=["ts"], sk_col="sk").collect()}
    assert (out[10]["v"], out[10]["sk"], out[10]["ts"]) == ("a", 1, None)       # absent from source: kept
    assert (out[20]["v"], out[20]["sk"], out[20]["run"]) == ("B", 2, "r1")      # existing: replaced, key kept
    assert out[20]["ts"] is not None
    assert (out[30]["v"], out[30]["sk"]) == ("c", 3)                             # new: next key


def test_insert_ignore_keeps_existing(spark):
    src = spark.createDataFrame([(20, "B", "r1"), (30, "c", "r1")], "k int, v string, run string")
    out = {r["k"]: r for r in insert_ignore(_tgt(spark), src, ["k"], sk_col="sk", touch_cols=["ts"]).collect()}
    assert out[20]["v"] == "b" and out[20]["ts"] is None and out[30]["sk"] == 3


def test_partial_upsert_updates_only_listed_columns(spark):
    src = spark.createDataFrame([(20, "B", "r1")], "k int, v string, run string")
    out = {r["k"]: r for r in upsert(_tgt(spark), src, ["k"], update_cols=["run"], sk_col="sk").collect()}
    assert (out[20]["v"], out[20]["run"]) == ("b", "r1")


def test_upsert_into_empty_and_unchanged_rerun(spark):
    empty = spark.createDataFrame([], "sk int, k int, v string, run string, ts timestamp_ntz")
    src = spark.createDataFrame([(5, "x", "r"), (3, "y", "r")], "k int, v string, run string")
    once = upsert(empty, src, ["k"], sk_col="sk").select("sk", "k", "v", "run", "ts")
    twice = upsert(once, src, ["k"], sk_col="sk")
    a = sorted((r["sk"], r["k"], r["v"]) for r in once.collect())
    b = sorted((r["sk"], r["k"], r["v"]) for r in twice.collect())
    assert a == b == [(1, 3, "y"), (2, 5, "x")]   # keys in business-key order, stable on re-run


def test_assign_keys_dense_and_ordered(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5003).alias("k"))
    out = assign_keys(df, "sk", ["k"], start=100, num_partitions=7).orderBy("k").collect()
    assert [r["sk"] for r in out] == list(range(101, 5101))
    assert max_key(spark.createDataFrame([], "sk int"), "sk") == 0


def test_pack_bronze_keeps_nulls_and_key(spark):
    df = spark.createDataFrame([("7", None, 1.5)], "SK_ID_CURR string, A string, B double")
    row = pack_bronze(df, run_id="r", source_file="f.csv", sequence=F.lit(1), document=False).first()
    assert json.loads(row["datos_origen_raw"]) == {"SK_ID_CURR": "7", "A": None, "B": 1.5}
    assert (row["bk_id_solicitud"], row["via_airflow_run_id"], row["es_documento"]) == ("7", "r", False)


def test_default_run_id_and_na_tokens(spark):
    df = spark.createDataFrame([("1", "NA", "XNA", "")], "SK_ID_CURR string, a string, b string, c string")
    clean = na_to_null(df)
    r = clean.first()
    assert (r["a"], r["b"], r["c"]) == (None, "XNA", None)
    assert pack_bronze(clean, document=False, sequence=F.lit(1)).first()["via_airflow_run_id"] == S.DEFAULT_RUN_ID


def test_gate_passes_empty_and_fails_planted(spark):
    empty = spark.createDataFrame([], S.SILVER)
    assert enforce(silver_gate(empty))["check_pk_nula"] is True
    bad = spark.createDataFrame([(None, 365243, Decimal("-1.0000"))],
                                "bk_id_solicitud int, days_employed int, credit_to_income_ratio decimal(10,4)")
    rep = silver_gate(bad).first()
    assert (rep["n_outliers_empleo"], rep["n_pk_nula"], rep["n_ratio_negativo"]) == (1, 1, 1)
    with pytest.raises(QualityGateError):
        enforce(silver_gate(bad))
    null_ratio = spark.createDataFrame([(1, 1, None)], "bk_id_solicitud int, days_employed int, "
                                                       "credit_to_income_ratio decimal(10,4)")
    assert enforce(silver_gate(null_ratio))["check_ratio_valido"] is True   # NULL passes


def test_integrity_planted_faults(spark):
    fact = spark.createDataFrame([(1, 1), (2, 9), (2, None)], "dd int, sk_cliente int")
    dim = spark.createDataFrame([(1,), (2,)], "sk_cliente int")
    assert orphans(fact, dim, "sk_cliente").count() == 1
    d = duplicate_keys(fact, ["dd"]).collect()
    assert [(r["dd"], r["extra"]) for r in d] == [(2, 1)]
    v = varchar_violations(spark.createDataFrame([("x" * 11,)], "code_gender string"), {"code_gender": 10}).first()
    assert v[0] == 1


def test_star_integrity_counts_planted_faults(spark):
    """Every count against the separate row-level operators, with NULL, repeated and dangling keys."""
    make = spark.createDataFrame
    fact = make([(1, 1, 1, 1, 10), (2, 9, 1, 1, 10), (None, 1, 7, 1, 11), (2, 1, 1, None, None), (3, 1, 1, 8, None), (3, 1, 1, 1, 12)],
                "sk_cliente int, sk_producto int, sk_tiempo int, sk_proxy_documental int, dd_id_solicitud int")
    cliente = make([(1, 10), (2, 11), (2, 11), (4, None), (None, None), (None, 13)], "sk_cliente int, bk_id_solicitud int")
    silver = make([(10,), (10,), (10,), (None,), (None,)], "bk_id_solicitud int")
    producto, tiempo, proxy = make([(1,)], "sk_producto int"), make([(1,)], "sk_tiempo int"), make([(1,)], "sk_proxy_documental int")
    got = star_integrity(silver, cliente, producto, proxy, tiempo, fact).first().asDict()
    extra = lambda df, c: sum(r["extra"] for r in duplicate_keys(df, [c]).collect())
    assert got == {
        "huerfanos_cliente": orphans(fact, cliente, "sk_cliente").count(), "huerfanos_producto": orphans(fact, producto, "sk_producto").count(),
        "huerfanos_tiempo": orphans(fact, tiempo, "sk_tiempo").count(), "huerfanos_proxy": orphans(fact, proxy, "sk_proxy_documental").count(),
        "duplicados_silver": extra(silver, "bk_id_solicitud"), "duplicados_cliente": extra(cliente, "bk_id_solicitud"),
        "duplicados_fact": extra(fact, "dd_id_solicitud"), "duplicados_sk_cliente": extra(cliente, "sk_cliente"), "nulos_pk": 2}
    assert list(got.values()) == [2, 1, 1, 1, 3, 2, 2, 2, 2]


def test_key_violations_of_any_type(spark):
    """Dates and texts are keys like numbers; NULLs violate nothing; an empty table has no violations."""
    rows = [(1, "2024-01-01"), (1, "2024-01-01"), (None, None), (None, None), (2, "2024-01-02")]
    days = spark.createDataFrame(rows, "sk_tiempo int, fecha string").selectExpr("sk_tiempo", "cast(fecha as date) AS fecha")
    found = key_violations(days, "gold.dim_tiempo", None)
    assert {r["regla"]: r["filas"] for r in found.collect()} == {"duplicado_sk_tiempo": 1, "duplicado_fecha": 1}
    assert {r["filas"] for r in key_violations(days.limit(0), "gold.dim_tiempo", None).collect()} == {0}
    names = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, "1"), (5, "")], "sk_producto int, nombre_producto string")
    assert {r["regla"]: r["filas"] for r in key_violations(names, "gold.dim_producto", None).collect()} == {
        "duplicado_sk_producto": 0, "duplicado_nombre_producto": 1}
    fact = spark.createDataFrame([(1, 10, 1, 1, 1, 1), (2, 11, 2, None, 1, 3), (2, 11, 2, 1, 1, 1)],
                                 "sk_fact int, dd_id_solicitud int, sk_cliente int, sk_producto int, sk_tiempo int, sk_proxy_documental int")
    keys = {t: spark.createDataFrame([(1,)], f"{S.PRIMARY_KEYS[t]} int") for t in S.FOREIGN_KEYS["gold.fact_creditos"].values()}
    found = key_violations(fact, "gold.fact_creditos", keys.__getitem__)
    assert {r["regla"]: r["filas"] for r in found.collect()} == {
        "duplicado_sk_fact": 1, "duplicado_dd_id_solicitud": 1, "huerfano_sk_cliente": 2, "huerfano_sk_producto": 0,
        "huerfano_sk_tiempo": 0, "huerfano_sk_proxy_documental": 1}


def test_audit_counts_and_log_ids(spark):
    silver = spark.createDataFrame([("r1",), ("r1",), ("r2",)], "via_airflow_run_id string")
    e = audit_entries(silver, ["r1", "r3"])
    got = {r["via_airflow_run_id"]: r["filas_procesadas"] for r in e.collect()}
    assert got == {"r1": 2, "r3": 0}
    rows = with_log_ids(spark.createDataFrame([], S.AUDIT), e, 41).collect()
    assert sorted(r["log_id"] for r in rows) == [42, 43]
    assert {r["estado_ejecucion"] for r in rows} == {S.STATUS_OK}


def test_receipt_golden_payload(spark):
    """Text with 1,130.63 must give the sample payload's field values."""
    df = spark.createDataFrame([("999999_boleta.jpg", "EMPRESA\nNETO A PAGAR S/   \n 1,130.63\nFIRMA"),
                                ("x_boleta.jpg", "NETO A PAGAR S/ 10.00"),
                                ("5_b.jpg", "sin monto"),
                                ("6_b.jpg", None)], "nombre_archivo string, texto string")
    rows = {r["nombre_archivo"]: r for r in extract_receipts(df).collect()}
    p = json.loads(rows["999999_boleta.jpg"]["payload"])
    assert list(p) == list(json.loads(SAMPLE_DOCUMENT))
    assert p == json.loads(SAMPLE_DOCUMENT)
    assert rows["x_boleta.jpg"]["estado"] == "ignorado" and rows["x_boleta.jpg"]["payload"] is None
    assert (rows["5_b.jpg"]["amt_income_total"], rows["5_b.jpg"]["confidence_score"]) == (0.0, 30.0)
    assert rows["6_b.jpg"]["estado"] == "fallido"


def test_ledger_skips_pending_and_archived(spark):
    cand = spark.createDataFrame([("a.json",), ("b.json",), ("c.json",)], "nombre_archivo string")
    pending = spark.createDataFrame([("a.json",)], "nombre_archivo string")
    archived = spark.createDataFrame([("c.json",)], "nombre_archivo string")
    assert [r[0] for r in not_yet_ingested(cand, pending, archived).collect()] == ["b.json"]


def test_assign_keys_bucket_path_int_and_date(spark):
    from credlake.operators.keys import assign_keys_by_bucket
    df = spark.range(0, 3000).select(((F.col("id") * 7919 % 6007) * 1000 - 3_000_000).cast("int").alias("k"))
    out = assign_keys(df, "sk", ["k"], start=5).collect()          # int key -> bucket plan
    got = [r["sk"] for r in sorted(out, key=lambda r: r["k"])]
    assert got == list(range(6, 3006))
    small = assign_keys_by_bucket(df, "sk", "k", width=16).collect()  # many tiny buckets
    assert [r["sk"] for r in sorted(small, key=lambda r: r["k"])] == list(range(1, 3001))
    dates = spark.range(0, 400).select(F.date_add(F.lit("1990-01-01").cast("date"), (F.col("id") * 37).cast("int"))
                                       .alias("fecha"))
    dk = assign_keys(dates, "sk", ["fecha"]).collect()
    assert [r["sk"] for r in sorted(dk, key=lambda r: r["fecha"])] == list(range(1, 401))


def test_audit_sql_binds_run_id(spark):
    from credlake.operators.audit import audit_entry_sql
    spark.createDataFrame([("r1",), ("r1",), ("x' OR '1'='1",)], "via_airflow_run_id string") \
        .createOrReplaceTempView("silver_audit_test")
    assert audit_entry_sql(spark, "silver_audit_test", "r1").first()["filas_procesadas"] == 2
    assert audit_entry_sql(spark, "silver_audit_test", "x' OR '1'='1").first()["filas_procesadas"] == 1


def test_upsert_raises_on_a_key_that_occurs_twice(spark):
    src = spark.createDataFrame([(2, "x"), (2, "y")], "k int, v string")
    for target in (_tgt(spark), _tgt(spark).limit(0)):
        with pytest.raises(Exception, match="twice"):
            upsert(target, src, ["k"], sk_col="sk").collect()
