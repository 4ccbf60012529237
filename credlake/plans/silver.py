"""Silver feature build (G-07): bronze -> one typed feature row per application.

Branch A is the latest historical record per application, branch B the latest
extracted document.  They are merged with the document's income taking
precedence, derived features are computed in exact decimals, and the two
risk ratios are guarded against non-positive income.

Three physical plans give the same rows:

* ``fused``: one ``groupBy`` on the integer application id picks both branches'
  latest records with ``max_by`` in a single shuffle; partial aggregation ships
  at most one record per key and branch from each map task (skew-safe), and no
  join is needed.  Payloads are parsed only for winners, and travel whole.
  Loads use it: stored bronze keeps an application's records together.
* ``narrow`` (default here): the same, but every record is parsed where it lies
  and only the 20 fields that silver reads are sorted and shuffled.
* ``window``: the SQL as written: a ``row_number`` window per branch
  (partitioned by the *text* key) and a left join on the integer id.

The window partitions by the text key while the merge joins on the integer
id, so two spellings of one id ('7' and '007') would hit one silver key twice;
the original upsert then fails, and so do both plans here (``strict``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..functions.payload import parse_base, parse_document
from ..functions.text import truncate
from ..operators.latest import latest_by_window, recency_key
from ..schemas import DOC_METADATA_KEY, LEGACY_CONFIDENCE, LEGACY_DOC_TYPE, SILVER_COLUMNS

DOC_EXTRA_COLUMNS = ["tipo_documento", "confianza_ocr"]


def base_records(bronze: DataFrame) -> DataFrame:
    """F-01: records without extraction metadata."""
    return bronze.filter(~F.col("es_documento"))


def document_records(bronze: DataFrame) -> DataFrame:
    """F-02: records with extraction metadata."""
    return bronze.filter(F.col("es_documento"))


def latest_base(bronze: DataFrame) -> DataFrame:
    """W-01 + F-03 on branch A (partitioned by the text key)."""
    return latest_by_window(base_records(bronze), ["bk_id_solicitud"])


def latest_documents(bronze: DataFrame) -> DataFrame:
    """W-01 + F-03 on branch B."""
    return latest_by_window(document_records(bronze), ["bk_id_solicitud"])


def _typed_base_columns(p: Column, key: Column, run: Column) -> list[Column]:
    """P-06: the 16 typed base columns from a parsed payload struct."""
    days_emp = p["DAYS_EMPLOYED"]
    return [
        key.alias("id_solicitud"),
        N.to_smallint(p["TARGET"]).alias("target"),
        p["NAME_CONTRACT_TYPE"].alias("name_contract_type"),
        p["CODE_GENDER"].alias("code_gender"),
        N.to_money(p["AMT_CREDIT"]).alias("amt_credit"),
        N.to_money(p["AMT_INCOME_TOTAL"]).alias("amt_income_total"),
        N.to_money(p["AMT_ANNUITY"]).alias("amt_annuity"),
        N.sentinel_to_null(N.to_int(days_emp)).alias("days_employed"),
        p["NAME_EDUCATION_TYPE"].alias("name_education_type"),
        p["NAME_FAMILY_STATUS"].alias("name_family_status"),
        N.to_smallint(p["CNT_CHILDREN"]).alias("cnt_children"),
        N.days_to_years_floor(p["DAYS_BIRTH"]).alias("edad_anios"),
        N.tenure_years(days_emp).alias("antiguedad_laboral_anios"),
        truncate(p["ORGANIZATION_TYPE"]).alias("sector_economico"),
        N.to_smallint(p["REGION_RATING_CLIENT_W_CITY"]).alias("calificacion_region_ciudad"),
        N.to_smallint(p["REG_CITY_NOT_WORK_CITY"]).alias("flag_discrepancia_ciudad"),
        N.days_to_years_round1(p["DAYS_REGISTRATION"]).alias("anios_residencia"),
        run.alias("via_airflow_run_id"),
    ]


def _typed_document_columns(p: Column, key: Column, run: Column) -> list[Column]:
    """P-07 + X-02: income, document type, confidence."""
    meta = p[DOC_METADATA_KEY]
    return [
        key.alias("id_solicitud"),
        N.to_money(p["AMT_INCOME_TOTAL"]).alias("amt_income_total_idp"),
        meta["document_type"].alias("tipo_documento"),
        N.to_pct(meta["confidence_score"]).alias("confianza_ocr"),
        run.alias("via_airflow_run_id"),
    ]


def type_base(latest: DataFrame) -> DataFrame:
    p = parse_base(F.col("datos_origen_raw"))
    return latest.select(*_typed_base_columns(p, N.to_int(F.col("bk_id_solicitud")), F.col("via_airflow_run_id")))


def type_documents(latest: DataFrame) -> DataFrame:
    p = parse_document(F.col("datos_origen_raw"))
    return latest.select(*_typed_document_columns(p, N.to_int(F.col("bk_id_solicitud")), F.col("via_airflow_run_id")))


def _merge_columns(b, d) -> list[Column]:
    """P-08 + X-13..X-16 over base columns ``b(name)`` and document columns ``d(name)``."""
    income = F.coalesce(d("amt_income_total_idp"), b("amt_income_total"))
    out = {
        "bk_id_solicitud": b("id_solicitud"),
        "amt_income_total": income,
        "credit_to_income_ratio": N.guarded_ratio(b("amt_credit"), income),
        "annuity_income_ratio": N.guarded_ratio(b("amt_annuity"), income),
        "via_airflow_run_id": F.coalesce(d("via_airflow_run_id"), b("via_airflow_run_id")),
    }
    cols = [(out[c] if c in out else b(c)).alias(c) for c in SILVER_COLUMNS]
    cols.append(F.coalesce(d("tipo_documento"), F.lit(LEGACY_DOC_TYPE)).alias("tipo_documento"))
    cols.append(F.coalesce(d("confianza_ocr"), F.lit(LEGACY_CONFIDENCE).cast("decimal(5,2)")).alias("confianza_ocr"))
    return cols


def merge_features(base_typed: DataFrame, doc_typed: DataFrame, keep_document_columns: bool = False) -> DataFrame:
    """J-01 (left join on the integer id) + merge projection + ratios."""
    b = base_typed.alias("b")
    d = doc_typed.alias("d")
    j = b.join(d, F.col("b.id_solicitud") == F.col("d.id_solicitud"), "left")
    out = j.select(*_merge_columns(lambda c: F.col(f"b.{c}"), lambda c: F.col(f"d.{c}")))
    return out if keep_document_columns else out.drop(*DOC_EXTRA_COLUMNS)


def _one_per_id(typed: DataFrame) -> DataFrame:
    """Raise on a NULL id and on an id that came under two spellings ('7', '007'); the
    count runs in the partitioning of the join by id that follows."""
    key, cols = F.col("id_solicitud"), typed.columns
    bad = (F.when(key.isNull(), F.raise_error(F.lit("silver: NULL application id")).cast("boolean"))
           .when(F.col("_hits") > 1, F.raise_error(F.concat(F.lit("silver: application id loaded twice under two "
                                                                  "spellings: "), key.cast("string"))).cast("boolean"))
           .otherwise(F.lit(True)))
    return typed.withColumn("_hits", F.count(F.lit(1)).over(Window.partitionBy("id_solicitud"))).where(bad).select(*cols)


def _silver_window(bronze: DataFrame, keep_document_columns: bool, strict: bool) -> DataFrame:
    base, docs = type_base(latest_base(bronze)), type_documents(latest_documents(bronze))
    if strict:
        base, docs = _one_per_id(base), _one_per_id(docs)
    return merge_features(base, docs, keep_document_columns)


def _silver_fused(bronze: DataFrame, keep_document_columns: bool, strict: bool, narrow: bool) -> DataFrame:
    doc = F.col("es_documento")
    base = ~doc
    rec = recency_key("fecha_ingestion", "id_secuencial")
    payload, run = F.col("datos_origen_raw"), F.col("via_airflow_run_id")
    fields = F.struct(payload.alias("p"), run.alias("run"))
    rows = bronze.select(
        N.to_int(F.col("bk_id_solicitud")).alias("_id"), "bk_id_solicitud", "es_documento", rec.alias("_ord"),
        F.when(base, F.struct(parse_base(payload).alias("p"), run.alias("run")) if narrow else fields).alias("_rb"),
        F.when(doc, F.struct(parse_document(payload).alias("p"), run.alias("run")) if narrow else fields).alias("_rd"))
    per_id = rows.groupBy("_id").agg(
        F.max_by("_rb", F.when(base, F.col("_ord"))).alias("_b"),
        F.max_by("_rd", F.when(doc, F.col("_ord"))).alias("_d"),
        # two text spellings of one id in a branch = a double hit on one key
        (F.min(F.when(base, F.col("bk_id_solicitud"))) != F.max(F.when(base, F.col("bk_id_solicitud"))))
        .alias("_b_clash"),
        (F.min(F.when(doc, F.col("bk_id_solicitud"))) != F.max(F.when(doc, F.col("bk_id_solicitud"))))
        .alias("_d_clash"),
    ).filter(F.col("_b").isNotNull())  # documents without a base record are dropped
    key = F.col("_id")
    if strict:
        clash = F.coalesce(F.col("_b_clash"), F.lit(False)) | F.coalesce(F.col("_d_clash"), F.lit(False))
        key = (F.when(key.isNull(), F.raise_error(F.lit("silver: NULL application id")))
               .when(clash, F.raise_error(F.concat(F.lit("silver: application id loaded twice under two "
                                                         "spellings: "), key.cast("string"))))
               .otherwise(key))
    # parse each winning payload once, in its own projection
    parsed = per_id.select(key.alias("_key"), F.col("_b.run").alias("_b_run"),
                           F.col("_d.run").alias("_d_run"), F.col("_d").isNotNull().alias("_has_d"),
                           (F.col("_b.p") if narrow else parse_base(F.col("_b.p"))).alias("_pb"),
                           (F.col("_d.p") if narrow else parse_document(F.col("_d.p"))).alias("_pd"))
    key = F.col("_key")
    pb, pd_ = F.col("_pb"), F.col("_pd")
    typed = parsed.select(
        F.struct(*_typed_base_columns(pb, key, F.col("_b_run"))).alias("b"),
        F.when(F.col("_has_d"), F.struct(*_typed_document_columns(pd_, key, F.col("_d_run")))).alias("d"))
    out = typed.select(*_merge_columns(lambda c: F.col(f"b.{c}"), lambda c: F.col(f"d.{c}")))
    return out if keep_document_columns else out.drop(*DOC_EXTRA_COLUMNS)


def build_silver(bronze: DataFrame, method: str = "narrow", keep_document_columns: bool = False,
                 strict: bool = True) -> DataFrame:
    """Silver feature rows (no load timestamp; the upsert stamps it)."""
    if method in ("fused", "narrow"):
        return _silver_fused(bronze, keep_document_columns, strict, method == "narrow")
    if method == "window":
        return _silver_window(bronze, keep_document_columns, strict)
    raise ValueError(f"unknown method {method!r}")
