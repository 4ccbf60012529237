"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each query drives one operator family of the pipeline over the driver's test
tables (through ``sources.fixtures``) and returns a result whose columns match
the DuckDB oracle in ``credlake.oracle``.  Wall-clock load times are left out
of every compared result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas as S
from .plans import gold
from .plans.silver import build_silver, latest_base, latest_documents, type_base, type_documents
from .plans.view import VIEW_NAME, risk_view
from .sources import fixtures as fx
from .functions.text import base_name, document_file_name, id_prefix, is_numeric_id, upload_name
from .sources.files import open_deliveries, read_application_csv, read_documents, read_images
from .sources.store import TableStore
from .operators.audit import audit_entries
from .operators.ledger import not_yet_ingested
from .operators.quality import silver_gate, star_integrity, varchar_violations, violations
from .operators.receipts import extract_receipts
from .operators.upsert import upsert
from .plans.bronze import csv_to_bronze, receipts_to_bronze
from .plans.run import ingest_batch, init_warehouse, load_silver, run_load
from .session import materialize, scratch_dir
from .streaming.file_ingest import run_bronze_stream, start_bronze_stream

GOLD_RUN = "run_gold"


def _silver(spark, sf_dir, method="narrow") -> DataFrame:
    """The silver build over the driver tables."""
    return build_silver(fx.bronze_all(spark, sf_dir), method=method)


def q_latest_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    lb = latest_base(fx.bronze_base(spark, sf_dir))
    return lb.select("bk_id_solicitud", "id_secuencial", "via_airflow_run_id",
                     F.col("fecha_ingestion").cast("date").alias("fecha_carga_dia"))


def q_latest_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    ld = latest_documents(fx.bronze_documents(spark, sf_dir))
    return ld.select("bk_id_solicitud", "id_secuencial", "via_airflow_run_id",
                     F.col("fecha_ingestion").cast("date").alias("fecha_carga_dia"))


def q_base_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return type_base(latest_base(fx.bronze_base(spark, sf_dir)))


def q_document_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return type_documents(latest_documents(fx.bronze_documents(spark, sf_dir)))


def q_silver_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir, "fused")


def q_silver_features_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir, "window")


def q_silver_features_narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir, "narrow")


def _silver_two_loads(spark, sf_dir, store: bool = False) -> tuple[DataFrame, DataFrame]:
    """(silver after the previous load, silver after the current load).

    ``store=True`` materializes each silver version, as the pipeline stores
    the table between loads, so the gold steps read it instead of
    recomputing it.
    """
    keep = materialize if store else (lambda d: d)
    prev_bronze, cur_bronze = fx.bronze_split(spark, sf_dir)
    prev = keep(build_silver(prev_bronze).withColumn("fecha_ingestion", F.lit(None).cast("timestamp_ntz")))
    cur_src = build_silver(cur_bronze)
    cur = keep(upsert(prev, cur_src, ["bk_id_solicitud"], touch_cols=["fecha_ingestion"]))
    return prev, cur


def q_silver_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, cur = _silver_two_loads(spark, sf_dir)
    return cur.select(*S.SILVER_COLUMNS)


def q_dim_producto(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = _silver(spark, sf_dir)
    dim = gold.build_dim_producto(silver, gold.empty(spark, S.DIM_PRODUCTO), GOLD_RUN)
    return dim.drop("fecha_carga")


def _dim_cliente_two_loads(spark, sf_dir):
    prev, cur = _silver_two_loads(spark, sf_dir, store=True)
    d0 = materialize(gold.build_dim_cliente(prev, gold.empty(spark, S.DIM_CLIENTE), "run_prev"))
    d1 = gold.build_dim_cliente(cur, d0, "run_cur")
    return prev, cur, d0, d1


def q_dim_cliente_scd1(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, _, d1 = _dim_cliente_two_loads(spark, sf_dir)
    return d1.drop("fecha_carga")


def _order_dates(spark, sf_dir) -> DataFrame:
    o = fx.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("fecha"))
    extra = spark.createDataFrame([(fx.AS_OF_PREVIOUS,), (fx.AS_OF_CURRENT,)], "fecha date")
    return o.unionByName(extra)


def _dim_tiempo(spark, sf_dir) -> DataFrame:
    return gold.build_dim_tiempo(_order_dates(spark, sf_dir), gold.empty(spark, S.DIM_TIEMPO))


def q_dim_tiempo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dim_tiempo(spark, sf_dir)


def _star_one_load(spark, sf_dir):
    silver = materialize(_silver(spark, sf_dir))
    dc = materialize(gold.build_dim_cliente(silver, gold.empty(spark, S.DIM_CLIENTE), GOLD_RUN))
    dp = materialize(gold.build_dim_producto(silver, gold.empty(spark, S.DIM_PRODUCTO), GOLD_RUN))
    dx = gold.build_dim_proxy(spark, gold.empty(spark, S.DIM_PROXY), GOLD_RUN)
    dt = materialize(_dim_tiempo(spark, sf_dir))
    f = gold.build_fact(silver, dc, dp, dt, gold.empty(spark, S.FACT), fx.AS_OF_CURRENT, GOLD_RUN)
    return silver, dc, dp, dx, dt, f


def q_fact_creditos(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _star_one_load(spark, sf_dir)[-1]
    return f.drop("fecha_carga")


def _star_two_loads(spark, sf_dir):
    prev, cur, d0, d1 = _dim_cliente_two_loads(spark, sf_dir)
    d1 = materialize(d1)
    dt = materialize(_dim_tiempo(spark, sf_dir))
    p0 = materialize(gold.build_dim_producto(prev, gold.empty(spark, S.DIM_PRODUCTO), "run_prev"))
    p1 = materialize(gold.build_dim_producto(cur, p0, "run_cur"))
    f0 = materialize(gold.build_fact(prev, d0, p0, dt, gold.empty(spark, S.FACT), fx.AS_OF_PREVIOUS, "run_prev"))
    f1 = materialize(gold.build_fact(cur, d1, p1, dt, f0, fx.AS_OF_CURRENT, "run_cur"))
    dx = gold.build_dim_proxy(spark, gold.empty(spark, S.DIM_PROXY), "run_cur")
    return cur, d1, p1, dx, dt, f1


def q_fact_partial_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _star_two_loads(spark, sf_dir)[-1].drop("fecha_carga")


def q_vw_riesgo(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, dc, dp, dx, dt, f = _star_one_load(spark, sf_dir)
    return risk_view(f, dc, dp, dx, dt)


def q_bronze_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P-01..P-04: rows packed into JSON records, read back field by field."""
    b = fx.bronze_base(spark, sf_dir)
    p = F.col("datos_origen_raw")
    keys = F.json_object_keys(p)
    return b.select(
        "bk_id_solicitud", "id_secuencial", "via_airflow_run_id", "nombre_archivo_fuente",
        F.size(keys).cast("int").alias("n_claves"),
        (F.array_contains(keys, "NAME_CONTRACT_TYPE") & F.get_json_object(p, "$.NAME_CONTRACT_TYPE").isNull())
        .alias("producto_es_null"),
        F.get_json_object(p, "$.AMT_CREDIT").cast("decimal(12,2)").alias("amt_credit"),
        F.get_json_object(p, "$.DAYS_BIRTH").cast("int").alias("days_birth"),
        F.get_json_object(p, "$.DAYS_REGISTRATION").cast("double").alias("days_registration"))


def q_bronze_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-01 + P-02 + K-01: application rows written as a header CSV, read back
    as text columns (FAILFAST) and packed into bronze."""
    path = scratch_dir(spark, "application-csv")
    rows = fx.application_rows(spark, sf_dir)
    rows.select(*[c for c in rows.columns if not c.startswith("_")]).write.option("header", True).csv(path)
    b = csv_to_bronze(read_application_csv(spark, path), "run_csv")
    p = F.col("datos_origen_raw")
    return b.select(
        "bk_id_solicitud",
        F.get_json_object(p, "$.NAME_CONTRACT_TYPE").alias("name_contract_type"),
        F.get_json_object(p, "$.AMT_CREDIT").cast("decimal(12,2)").alias("amt_credit"),
        F.get_json_object(p, "$.AMT_ANNUITY").cast("decimal(12,2)").alias("amt_annuity"),
        F.get_json_object(p, "$.DAYS_EMPLOYED").cast("int").alias("days_employed"),
        "via_airflow_run_id", "nombre_archivo_fuente")


def q_dq_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_gate(_silver(spark, sf_dir))


def q_dq_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    cur, d1, p1, dx, dt, f1 = _star_two_loads(spark, sf_dir)
    return star_integrity(cur, d1, p1, dx, dt, f1)


def q_audit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_entries(_silver(spark, sf_dir), ["run_0", "run_1", "run_2", "run_idp"])


def q_receipt_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = extract_receipts(fx.receipt_rows(spark, sf_dir))
    return r.drop("payload")


def q_receipt_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K-02 + K-01: processed receipts appended to bronze as document records,
    read back through the silver document parser."""
    b = receipts_to_bronze(extract_receipts(fx.receipt_rows(spark, sf_dir)), "run_ocr")
    p = F.from_json("datos_origen_raw", S.DOC_PAYLOAD)
    return b.select(
        "bk_id_solicitud", "nombre_archivo_fuente", "es_documento", "via_airflow_run_id",
        p["AMT_INCOME_TOTAL"].cast("decimal(12,2)").alias("amt_income_total"),
        p[S.DOC_METADATA_KEY]["document_type"].alias("document_type"),
        p[S.DOC_METADATA_KEY]["confidence_score"].cast("decimal(5,2)").alias("confidence_score"))


def q_dq_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-08: values longer than the declared VARCHAR(n) widths of silver."""
    return varchar_violations(_silver(spark, sf_dir), S.VARCHAR_LIMITS["silver.cleaned_application"])


def q_ingest_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    cand, pending, archived = fx.manifest(spark, sf_dir)
    return not_yet_ingested(cand, pending, archived)


def q_stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-02 + K-01 + Q-09 as a stream: document payloads dropped as JSON-lines
    files, ingested by an AvailableNow file stream into an append-only bronze."""
    root = scratch_dir(spark, "stream")
    drop = f"{root}/raw"
    docs = fx.document_rows(spark, sf_dir)
    payload = F.to_json(F.struct(*[c for c in docs.columns if not c.startswith("_")]))
    docs.select(payload.alias("value")).write.text(drop)
    store = TableStore(spark, root=f"{root}/warehouse")
    q = start_bronze_stream(spark, store, drop, f"{root}/_checkpoint", f"{root}/quarantine", "run_stream",
                            pattern="*.txt", whole_file=False)
    q.awaitTermination()
    b = store.read("bronze.raw_application")
    p = F.from_json("datos_origen_raw", S.DOC_PAYLOAD)
    return b.select(
        "bk_id_solicitud",
        p["AMT_INCOME_TOTAL"].cast("decimal(12,2)").alias("amt_income_total"),
        p[S.DOC_METADATA_KEY]["document_type"].alias("document_type"),
        p[S.DOC_METADATA_KEY]["confidence_score"].cast("decimal(5,2)").alias("confidence_score"),
        "via_airflow_run_id", "es_documento")


def q_silver_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incremental silver: the previous load, then the current one, each
    rebuilding only applications with new bronze records."""
    store = TableStore(spark, root=scratch_dir(spark, "warehouse"))
    for i, rows in enumerate(fx.bronze_split(spark, sf_dir)):
        store.append_bronze(rows)
        load_silver(store, incremental=True, run_id=f"run_{i}")
    return store.read("silver.cleaned_application").select(*S.SILVER_COLUMNS)


def q_load_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G-10: one whole load into a fresh warehouse, read back through the published view."""
    store = TableStore(spark, root=scratch_dir(spark, "warehouse"))
    run_load(spark, store, GOLD_RUN, bronze_rows=fx.bronze_all(spark, sf_dir), as_of=fx.AS_OF_CURRENT)
    return spark.table(VIEW_NAME)


def q_ingest_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-02, K-01, K-10, Q-09, A-06: a delivery with broken documents, the
    same folder again, then a second delivery under the old file names."""
    root = scratch_dir(spark, "deliveries")
    store = TableStore(spark, root=f"{root}/warehouse")
    docs = fx.document_rows(spark, sf_dir)
    text = F.to_json(F.struct(*[c for c in docs.columns if not c.startswith("_")]))
    event = F.col("_seq") - fx.DOC_SEQ_BASE
    first = docs.select(F.when(event % 10 == 0, F.lit("{")).otherwise(text).alias("value"))
    first.write.text(f"{root}/raw")
    for run in ("run_1", "run_2"):
        ingest_batch(spark, store, run, docs_dir=f"{root}/raw", docs_pattern="*.txt", docs_whole_file=False)
    docs.filter(event % 3 == 0).select(text.alias("value")).write.text(f"{root}/raw2")
    ingest_batch(spark, store, "run_3", docs_dir=f"{root}/raw2", docs_pattern="*.txt", docs_whole_file=False)
    p = F.from_json("datos_origen_raw", S.DOC_PAYLOAD)
    loaded = store.read("bronze.raw_application").select(
        F.lit("cargado").alias("estado"), "bk_id_solicitud",
        p["AMT_INCOME_TOTAL"].cast("decimal(12,2)").alias("amt_income_total"),
        p[S.DOC_METADATA_KEY]["document_type"].alias("document_type"), "via_airflow_run_id")
    return loaded.unionByName(spark.read.parquet(f"{store.root}/quarantine").select(
        F.lit("cuarentena").alias("estado"), "via_airflow_run_id"), allowMissingColumns=True)


def q_load_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K-03..K-07, K-12: load times after two loads at two given times."""
    t1, t2 = (F.lit(d).cast("timestamp_ntz") for d in (fx.AS_OF_PREVIOUS, fx.AS_OF_CURRENT))
    tiempo = materialize(_dim_tiempo(spark, sf_dir))
    silver, client, product, proxy, fact = (
        gold.empty(spark, s) for s in (S.SILVER, S.DIM_CLIENTE, S.DIM_PRODUCTO, S.DIM_PROXY, S.FACT))
    for bronze, run, now, day in zip(fx.bronze_split(spark, sf_dir), ("run_prev", "run_cur"), (t1, t2),
                                     (fx.AS_OF_PREVIOUS, fx.AS_OF_CURRENT)):
        silver = materialize(upsert(silver, build_silver(bronze), ["bk_id_solicitud"],
                                    touch_cols=["fecha_ingestion"], now=now))
        client = materialize(gold.build_dim_cliente(silver, client, run, now=now))
        product = materialize(gold.build_dim_producto(silver, product, run, now=now))
        proxy = materialize(gold.build_dim_proxy(spark, proxy, run, now=now))
        fact = materialize(gold.build_fact(silver, client, product, tiempo, fact, day, run, now=now))

    def rows(name, df, key, stamp="fecha_carga"):
        return df.select(F.lit(name).alias("tabla"), F.col(key).cast("string").alias("clave"),
                         F.col(stamp).alias("fecha_carga"))

    return (rows("silver", silver, "bk_id_solicitud", "fecha_ingestion")
            .unionByName(rows("dim_cliente", client, "bk_id_solicitud"))
            .unionByName(rows("dim_producto", product, "nombre_producto"))
            .unionByName(rows("dim_proxy_documental", proxy, "sk_proxy_documental"))
            .unionByName(rows("fact_creditos", fact, "dd_id_solicitud")))


def q_dq_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-05..Q-08: every constraint counted over a star with planted faults
    (doubled rows, lost keys, long values, missing parents)."""
    silver, client, product, proxy, tiempo, fact = _star_one_load(spark, sf_dir)
    bk = F.col("bk_id_solicitud")
    silver = silver.unionByName(silver.filter(bk % 7 == 0)).withColumns({
        "name_education_type": F.when(bk % 13 == 0, F.repeat("name_education_type", 20)).otherwise(F.col("name_education_type")),
        "bk_id_solicitud": F.when(bk % 11 != 0, bk)})
    fact = materialize(fact)
    fact = fact.unionByName(fact.filter(F.col("dd_id_solicitud") % 7 == 0))
    parents = {"gold.dim_cliente": client.filter(bk % 5 != 0), "gold.dim_producto": product.filter("sk_producto > 1"),
               "gold.dim_tiempo": tiempo.filter(F.col("fecha") != F.lit(fx.AS_OF_CURRENT)), "gold.dim_proxy_documental": proxy}
    return reduce(lambda a, b: a.unionByName(b), [
        violations(df, name, parents.__getitem__).select(F.lit(name).alias("tabla"), "regla", "filas")
        for name, df in (("silver.cleaned_application", silver), ("gold.fact_creditos", fact))])


def _broken(docs: DataFrame, path: str) -> None:
    """Documents as JSON lines; every tenth is cut short."""
    text = F.to_json(F.struct(*[c for c in docs.columns if not c.startswith("_")]))
    docs.select(F.when((F.col("_seq") - fx.DOC_SEQ_BASE) % 10 == 0, F.lit("{")).otherwise(text).alias("value")).write.text(path)


def q_stream_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-06 of a stream: documents seen, loaded and quarantined, from the progress events, beside the rows stored."""
    root = scratch_dir(spark, "stream")
    _broken(fx.document_rows(spark, sf_dir), f"{root}/raw")
    store = TableStore(spark, root=f"{root}/warehouse")
    c = run_bronze_stream(spark, store, f"{root}/raw", f"{root}/_checkpoint", f"{root}/quarantine", "run_stream",
                          pattern="*.txt", whole_file=False)
    stored = store.read("bronze.raw_application").select(F.lit("documentos_filas").alias("contador")).unionByName(
        spark.read.parquet(f"{root}/quarantine").select(F.lit("documentos_cuarentena").alias("contador")))
    seen = spark.createDataFrame(sorted(c.items()), "contador string, observadas long")
    return seen.join(stored.groupBy("contador").agg(F.count(F.lit(1)).alias("guardadas")), "contador", "left")


def q_load_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K-03, K-05, K-06, S-05: a load that touches one key range of an existing star; the fact afterwards."""
    store = TableStore(spark, root=scratch_dir(spark, "warehouse"))
    for rows, run, day in zip(fx.bronze_one_range(spark, sf_dir), ("run_prev", "run_cur"), (fx.AS_OF_PREVIOUS, fx.AS_OF_CURRENT)):
        run_load(spark, store, run, bronze_rows=rows, as_of=day, incremental=True, view_name="vw_riesgo_incremental")
    fact = store.read("gold.fact_creditos").drop("fecha_carga", "sk_tiempo")
    view = spark.table("vw_riesgo_incremental").select(F.col("id_solicitud").alias("dd_id_solicitud"), "fecha_evaluacion_datos")
    return fact.join(view, "dd_id_solicitud")


def q_vw_riesgo_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-05 over bucketed catalog tables: fact and client meet without a shuffle."""
    store = TableStore(spark, root=scratch_dir(spark, "warehouse"))
    run_load(spark, store, GOLD_RUN, bronze_rows=fx.bronze_all(spark, sf_dir), as_of=fx.AS_OF_CURRENT,
             view_name="vw_riesgo_buckets", view_buckets=8)
    return spark.table("vw_riesgo_buckets")


def q_audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K-08, G-08: the audit table after two whole loads."""
    store = TableStore(spark, root=scratch_dir(spark, "warehouse"))
    for rows, run in zip(fx.bronze_split(spark, sf_dir), ("run_1", "run_idp")):
        run_load(spark, store, run, bronze_rows=rows, as_of=fx.AS_OF_CURRENT, view_name="vw_riesgo_auditada")
    return store.read("audit.etl_log").drop("fecha_ejecucion")


def q_warehouse_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K-11: rows per table after a load, after the reset, and after an incremental load rebuilds silver from bronze."""
    store = TableStore(spark, root=scratch_dir(spark, "warehouse"))

    def rows(moment: str) -> DataFrame:
        parts = [store.read(t).select(F.lit(t).alias("tabla")) for t in ("bronze.raw_application", "silver.cleaned_application",
                                                                         "gold.dim_cliente")]
        counted = reduce(DataFrame.unionByName, parts).groupBy("tabla").agg(F.count(F.lit(1)).alias("filas"))
        return materialize(counted.select(F.lit(moment).alias("momento"), "tabla", "filas"))

    store.append_bronze(fx.bronze_all(spark, sf_dir))
    load_silver(store, run_id="run_1")
    seen = [rows("cargado")]
    init_warehouse(store)
    seen.append(rows("reiniciado"))
    load_silver(store, incremental=True, run_id="run_2")
    return reduce(DataFrame.unionByName, [*seen, rows("recargado")])


def q_silver_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X-14: document type and confidence kept through the merge."""
    silver = build_silver(fx.bronze_all(spark, sf_dir), keep_document_columns=True)
    return silver.select("bk_id_solicitud", "tipo_documento", "confianza_ocr")


def q_vw_riesgo_hoy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X-17: a load without a given day is evaluated on the session's current date."""
    store = TableStore(spark, root=scratch_dir(spark, "warehouse"))
    run_load(spark, store, GOLD_RUN, bronze_rows=fx.bronze_all(spark, sf_dir), view_name="vw_riesgo_hoy")
    return spark.table("vw_riesgo_hoy").select("id_solicitud", (F.datediff(F.current_date(), "fecha_evaluacion_datos")).alias("dias"))


def q_bronze_csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-01: quoted cells with line breaks, commas and quotes."""
    path = scratch_dir(spark, "application-csv")
    rows = fx.application_rows(spark, sf_dir)
    cell = F.concat(F.col("ORGANIZATION_TYPE"), F.lit('\nlinea "dos", fin\n'), F.col("SK_ID_CURR"))
    rows = rows.withColumn("ORGANIZATION_TYPE", cell).select(*[c for c in rows.columns if not c.startswith("_")])
    rows.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    b = csv_to_bronze(read_application_csv(spark, path, multi_line=True), "run_csv")
    p = F.col("datos_origen_raw")
    return b.select("bk_id_solicitud", F.get_json_object(p, "$.ORGANIZATION_TYPE").alias("organization_type"),
                    F.get_json_object(p, "$.AMT_CREDIT").cast("decimal(12,2)").alias("amt_credit"))


def q_document_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-02, S-03, S-04, X-22, X-23: one many-line JSON file per supplier, read whole, joined to the file manifest;
    a folder that is absent adds nothing."""
    root = scratch_dir(spark, "files")
    s = fx.table(spark, sf_dir, "supplier")
    doc = F.to_json(F.struct(F.col("s_suppkey").cast("string").alias(S.BUSINESS_KEY_FIELD), F.col("s_acctbal").alias("AMT_INCOME_TOTAL")),
                    {"pretty": "true"})
    s.select(upload_name(F.col("s_suppkey").cast("string"), F.lit("boleta.json")).alias("carpeta"), doc.alias("value")) \
        .write.partitionBy("carpeta").text(f"{root}/raw")
    docs = read_documents(spark, f"{root}/raw", pattern="*.txt").unionByName(read_documents(spark, f"{root}/absent"))
    files = read_images(spark, f"{root}/raw", pattern="*.txt").unionByName(read_images(spark, f"{root}/absent"))
    folder = base_name(F.regexp_replace("ruta", "/[^/]+$", ""))
    files = files.select(F.regexp_replace(folder, "^carpeta=", "").alias("nombre"), "nombre_archivo", "tamano")
    value = F.col("value")
    docs = docs.select(F.get_json_object(value, f"$.{S.BUSINESS_KEY_FIELD}").alias("bk_id_solicitud"), "nombre_archivo",
                       F.get_json_object(value, "$.AMT_INCOME_TOTAL").cast("decimal(12,2)").alias("amt_income_total"),
                       F.octet_length("value").cast("long").alias("largo"), (F.size(F.split("value", "\n")) > 3).alias("varias_lineas"))
    files = files.withColumn("id", id_prefix(F.col("nombre")))
    joined = docs.join(files, (docs["bk_id_solicitud"] == files["id"]) & (docs["nombre_archivo"] == files["nombre_archivo"]))
    return joined.select("bk_id_solicitud", "nombre", is_numeric_id(F.col("id")).alias("id_numerico"), "amt_income_total",
                         "varias_lineas", (F.col("tamano") == F.col("largo")).alias("entero"))


def q_receipt_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-10, X-29: the three ends of a receipt (unreadable ones have no text) and the names of the files written."""
    k = F.col("s_suppkey")
    name = F.concat(F.when(k % 17 == 0, F.lit("x")).otherwise(k.cast("string")), F.lit("_boleta.jpg"))
    text = F.when(k % 7 != 0, F.concat(F.lit("NETO A PAGAR S/ "), F.format_string("%.2f", F.abs("s_acctbal"))))
    images = fx.table(spark, sf_dir, "supplier").select(name.alias("nombre_archivo"), text.alias("texto"))
    found = extract_receipts(images)
    stamp = F.lit(fx.AS_OF_CURRENT).cast("timestamp")
    return found.select("nombre_archivo", "estado", "amt_income_total", F.when(F.col("estado") == "procesado", document_file_name(
        stamp, F.col("id_solicitud"))).alias("archivo"))


def q_dq_gate_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q-01..Q-04 over planted faults: sentinels, lost keys, negative ratios."""
    bk = F.col("bk_id_solicitud")
    return silver_gate(_silver(spark, sf_dir).withColumns({
        "days_employed": F.when(bk % 7 == 0, F.lit(S.SENTINEL_DAYS_EMPLOYED)).otherwise(F.col("days_employed")),
        "credit_to_income_ratio": F.when(bk % 13 == 0, F.lit("-0.0001").cast("decimal(10,4)")).otherwise(F.col("credit_to_income_ratio")),
        "bk_id_solicitud": F.when(bk % 11 != 0, bk)}))


def q_ingest_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K-09 by delivery: a folder with broken documents, the empty folder, then the same documents anew."""
    root = scratch_dir(spark, "deliveries")
    store = TableStore(spark, root=f"{root}/warehouse")
    docs = fx.document_rows(spark, sf_dir)
    left = 0
    for run, arrives in (("run_1", True), ("run_2", False), ("run_3", True)):
        if arrives:
            _broken(docs, f"{root}/raw/{run}")
        ingest_batch(spark, store, run, docs_dir=f"{root}/raw/{run}", docs_pattern="*.txt", docs_whole_file=False,
                     archive_dir=f"{root}/archive", archive_by="delivery")
        left += len(open_deliveries(spark, f"{root}/archive", "documentos"))
    archived = spark.read.text(f"{root}/archive/*", pathGlobFilter="*.txt").groupBy(F.regexp_extract(
        F.col("_metadata.file_path"), "/documentos-(run_[0-9])/", 1).alias("via_airflow_run_id")).agg(F.count(F.lit(1)).alias("archivadas"))
    loaded = store.read("bronze.raw_application").groupBy("via_airflow_run_id").agg(
        F.count(F.lit(1)).alias("cargadas"), F.count_distinct("id_secuencial").alias("numeros"))
    return loaded.join(archived, "via_airflow_run_id", "full_outer").withColumn("abiertas", F.lit(left))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "latest_base": q_latest_base,
    "latest_document": q_latest_document,
    "base_typed": q_base_typed,
    "document_typed": q_document_typed,
    "silver_features": q_silver_features,
    "silver_features_window": q_silver_features_window,
    "silver_features_narrow": q_silver_features_narrow,
    "silver_upsert": q_silver_upsert,
    "dim_producto": q_dim_producto,
    "dim_cliente_scd1": q_dim_cliente_scd1,
    "dim_tiempo": q_dim_tiempo,
    "fact_creditos": q_fact_creditos,
    "fact_partial_upsert": q_fact_partial_upsert,
    "vw_riesgo": q_vw_riesgo,
    "bronze_pack": q_bronze_pack,
    "bronze_csv": q_bronze_csv,
    "dq_gate": q_dq_gate,
    "dq_integrity": q_dq_integrity,
    "audit_counts": q_audit_counts,
    "receipt_extract": q_receipt_extract,
    "receipt_bronze": q_receipt_bronze,
    "dq_domain": q_dq_domain,
    "ingest_once": q_ingest_once,
    "stream_bronze": q_stream_bronze,
    "load_run": q_load_run,
    "silver_incremental": q_silver_incremental,
    "ingest_batch": q_ingest_batch,
    "load_times": q_load_times,
    "dq_faults": q_dq_faults,
    "dq_gate_faults": q_dq_gate_faults,
    "stream_counters": q_stream_counters,
    "ingest_delivery": q_ingest_delivery,
    "load_incremental": q_load_incremental,
    "vw_riesgo_buckets": q_vw_riesgo_buckets,
    "audit_log": q_audit_log,
    "warehouse_reset": q_warehouse_reset,
    "silver_documents": q_silver_documents,
    "vw_riesgo_hoy": q_vw_riesgo_hoy,
    "bronze_csv_lines": q_bronze_csv_lines,
    "document_files": q_document_files,
    "receipt_states": q_receipt_states,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)
