"""DuckDB oracle SQL for every registered query.

The oracle computes each result straight from the driver tables' columns
(no JSON round trip), so it checks the packing, parsing, typing, latest-record,
merge, upsert and key logic of the Spark side independently.  Exact decimal
rounding is written as integer arithmetic because DuckDB's decimal division
yields DOUBLE.
"""

from __future__ import annotations

from .schemas import (CONFIDENCE_AMOUNT_FOUND, CONFIDENCE_AMOUNT_MISSING, LEGACY_CONFIDENCE,
                      LEGACY_DOC_TYPE, RECEIPT_DOCUMENT_TYPE, SILVER_COLUMNS, SILVER_MESSAGE,
                      SILVER_TARGET, SILVER_TASK, STATUS_OK, VIEW_COLUMNS, AMOUNT_PATTERN,
                      RECEIPT_PAYLOAD_CONSTANTS, VARCHAR_LIMITS)
from .sources.fixtures import AS_OF_CURRENT, AS_OF_PREVIOUS, DOC_SEQ_BASE, ID_STEP, UPSERT_SPLIT

LEGACY_DOC_TYPE_SQL = LEGACY_DOC_TYPE.replace("'", "''")


def _years_half_up(days_pos: str) -> str:
    # round(d / 365.25, 1) half-up for d >= 0, as NUMERIC(5,1)
    return f"CAST(((2000 * ({days_pos}) + 36525) // 73050) * 0.1 AS DECIMAL(5,1))"


def _ratio(n: str, inc: str) -> str:
    return (f"CASE WHEN {inc} > 0 THEN CAST(CAST((2 * CAST({n} * 100 AS HUGEINT) * 10000 + CAST({inc} * 100 AS HUGEINT))"
            f" // (2 * CAST({inc} * 100 AS HUGEINT)) AS DECIMAL(18,0)) * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(10,4)) END")


def base_rows_sql(where: str = "") -> str:
    return f"""
    SELECT o.o_orderkey AS seq, o.o_orderdate AS ts, o.o_custkey * {ID_STEP} AS cust, o.o_orderstatus, o.o_totalprice,
           o.o_orderpriority, c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey {where}"""


def doc_rows_sql() -> str:
    return f"""
    SELECT event_id + {DOC_SEQ_BASE} AS seq, ts, user_id * {20 * ID_STEP} AS cust, event_type, value, props
    FROM events"""


LATEST = "QUALIFY row_number() OVER (PARTITION BY cust ORDER BY ts DESC NULLS FIRST, seq DESC) = 1"

BASE_TYPED = f"""
    CAST(cust AS INTEGER) AS id_solicitud,
    CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS SMALLINT) AS target,
    CASE WHEN seq % 11 <> 0 THEN o_orderpriority END AS name_contract_type,
    o_orderstatus AS code_gender,
    CAST(o_totalprice AS DECIMAL(12,2)) AS amt_credit,
    CAST(c_acctbal * 100 AS DECIMAL(12,2)) AS amt_income_total,
    CASE WHEN seq % 13 <> 0 THEN CAST(c_nationkey * 100 + 850 AS DECIMAL(12,2)) END AS amt_annuity,
    CASE WHEN seq % 7 = 0 THEN NULL ELSE CAST(-(seq % 15000) AS INTEGER) END AS days_employed,
    c_mktsegment AS name_education_type,
    o_orderpriority AS name_family_status,
    CAST(seq % 4 AS SMALLINT) AS cnt_children,
    CAST(((7000 + seq % 18000) * 100) // 36525 AS DECIMAL(5,1)) AS edad_anios,
    CASE WHEN seq % 7 = 0 THEN CAST(0 AS DECIMAL(5,1)) ELSE {_years_half_up('seq % 15000')} END AS antiguedad_laboral_anios,
    substring(repeat(c_name, 4), 1, 50) AS sector_economico,
    CAST(c_nationkey % 3 + 1 AS SMALLINT) AS calificacion_region_ciudad,
    CAST(seq % 2 AS SMALLINT) AS flag_discrepancia_ciudad,
    {_years_half_up('seq % 9000')} AS anios_residencia,
    'run_' || CAST(seq % 3 AS VARCHAR) AS via_airflow_run_id"""

DOC_TYPED = """
    CAST(cust AS INTEGER) AS id_solicitud,
    CAST(CASE WHEN event_type = 'error' THEN 0.0 ELSE value * 100 END AS DECIMAL(12,2)) AS amt_income_total_idp,
    event_type AS tipo_documento,
    CAST(CAST(json_extract_string(props, '$.k') AS DOUBLE) AS DECIMAL(5,2)) AS confianza_ocr,
    'run_idp' AS via_airflow_run_id"""


def silver_ctes(prefix: str, base_where: str = "", with_docs: bool = True, doc_where: str = "") -> str:
    """CTEs ``{prefix}_silver`` with the 20 silver columns."""
    doc_cte = (f"{prefix}_doc AS (SELECT {DOC_TYPED} FROM ({doc_rows_sql()} {doc_where}) {LATEST}),"
               if with_docs else
               f"{prefix}_doc AS (SELECT CAST(NULL AS INTEGER) AS id_solicitud, CAST(NULL AS DECIMAL(12,2)) AS "
               f"amt_income_total_idp, CAST(NULL AS VARCHAR) AS tipo_documento, CAST(NULL AS DECIMAL(5,2)) AS "
               f"confianza_ocr, CAST(NULL AS VARCHAR) AS via_airflow_run_id WHERE FALSE),")
    merged_cols = []
    for c in SILVER_COLUMNS:
        if c == "bk_id_solicitud":
            merged_cols.append("b.id_solicitud AS bk_id_solicitud")
        elif c == "amt_income_total":
            merged_cols.append("COALESCE(d.amt_income_total_idp, b.amt_income_total) AS amt_income_total")
        elif c == "via_airflow_run_id":
            merged_cols.append("COALESCE(d.via_airflow_run_id, b.via_airflow_run_id) AS via_airflow_run_id")
        elif c in ("credit_to_income_ratio", "annuity_income_ratio"):
            continue
        else:
            merged_cols.append(f"b.{c}")
    merged_cols.append(f"COALESCE(d.tipo_documento, '{LEGACY_DOC_TYPE_SQL}') AS tipo_documento")
    merged_cols.append(f"COALESCE(d.confianza_ocr, CAST({LEGACY_CONFIDENCE} AS DECIMAL(5,2))) AS confianza_ocr")
    final_cols = []
    for c in SILVER_COLUMNS:
        if c == "credit_to_income_ratio":
            final_cols.append(f"{_ratio('amt_credit', 'amt_income_total')} AS credit_to_income_ratio")
        elif c == "annuity_income_ratio":
            final_cols.append(f"{_ratio('amt_annuity', 'amt_income_total')} AS annuity_income_ratio")
        else:
            final_cols.append(c)
    return f"""
    {prefix}_base AS (SELECT {BASE_TYPED} FROM ({base_rows_sql(base_where)}) {LATEST}),
    {doc_cte}
    {prefix}_merged AS (SELECT {', '.join(merged_cols)}
        FROM {prefix}_base b LEFT JOIN {prefix}_doc d ON b.id_solicitud = d.id_solicitud),
    {prefix}_silver AS (SELECT {', '.join(final_cols)}, tipo_documento, confianza_ocr FROM {prefix}_merged)"""


SILVER_SELECT = ", ".join(SILVER_COLUMNS)
PREV_WHERE = f"WHERE o.o_orderdate < TIMESTAMP '{UPSERT_SPLIT}'"
CUR_WHERE = f"WHERE o.o_orderdate >= TIMESTAMP '{UPSERT_SPLIT}'"


def q_latest_base() -> str:
    return f"""
    SELECT CAST(cust AS VARCHAR) AS bk_id_solicitud, seq AS id_secuencial,
           'run_' || CAST(seq % 3 AS VARCHAR) AS via_airflow_run_id, CAST(ts AS DATE) AS fecha_carga_dia
    FROM ({base_rows_sql()}) {LATEST}"""


def q_latest_document() -> str:
    return f"""
    SELECT CAST(cust AS VARCHAR) AS bk_id_solicitud, seq AS id_secuencial,
           'run_idp' AS via_airflow_run_id, CAST(ts AS DATE) AS fecha_carga_dia
    FROM ({doc_rows_sql()}) {LATEST}"""


def q_base_typed() -> str:
    return f"SELECT {BASE_TYPED} FROM ({base_rows_sql()}) {LATEST}"


def q_document_typed() -> str:
    return f"SELECT {DOC_TYPED} FROM ({doc_rows_sql()}) {LATEST}"


def q_silver_features() -> str:
    return f"WITH {silver_ctes('s')} SELECT {SILVER_SELECT} FROM s_silver"


def q_bronze_pack() -> str:
    return f"""
    SELECT CAST(cust AS VARCHAR) AS bk_id_solicitud, seq AS id_secuencial,
           'run_' || CAST(seq % 3 AS VARCHAR) AS via_airflow_run_id,
           'application_train.csv' AS nombre_archivo_fuente,
           CAST(16 AS INTEGER) AS n_claves,
           (seq % 11 = 0) AS producto_es_null,
           CAST(o_totalprice AS DECIMAL(12,2)) AS amt_credit,
           CAST(-(7000 + seq % 18000) AS INTEGER) AS days_birth,
           CAST(-(seq % 9000) AS DOUBLE) AS days_registration
    FROM ({base_rows_sql()})"""


def q_silver_upsert() -> str:
    return f"""
    WITH {silver_ctes('p', PREV_WHERE, with_docs=False)}, {silver_ctes('c', CUR_WHERE)}
    SELECT {SILVER_SELECT} FROM c_silver
    UNION ALL
    SELECT {SILVER_SELECT} FROM p_silver t WHERE NOT EXISTS (SELECT 1 FROM c_silver s WHERE s.bk_id_solicitud = t.bk_id_solicitud)"""


def q_dim_producto() -> str:
    return f"""
    WITH {silver_ctes('s')}
    SELECT CAST(row_number() OVER (ORDER BY name_contract_type) AS INTEGER) AS sk_producto,
           name_contract_type AS nombre_producto, 'run_gold' AS via_airflow_run_id
    FROM (SELECT DISTINCT name_contract_type FROM s_silver WHERE name_contract_type IS NOT NULL)"""


CLIENT_ATTRS_SQL = ("code_gender, name_education_type, name_family_status, cnt_children, edad_anios, "
                    "antiguedad_laboral_anios, sector_economico, calificacion_region_ciudad, "
                    "flag_discrepancia_ciudad, anios_residencia")


def _dim_cliente_scd1_ctes() -> str:
    # previous dim: keys 1..n by business key; current load upserts on top
    return f"""
    {silver_ctes('p', PREV_WHERE, with_docs=False)}, {silver_ctes('c', CUR_WHERE)},
    p_silver_all AS (SELECT * FROM p_silver),
    c_silver_all AS (
        SELECT {SILVER_SELECT} FROM c_silver
        UNION ALL
        SELECT {SILVER_SELECT} FROM p_silver t WHERE NOT EXISTS (SELECT 1 FROM c_silver s WHERE s.bk_id_solicitud = t.bk_id_solicitud)),
    dim_prev AS (
        SELECT CAST(row_number() OVER (ORDER BY bk_id_solicitud) AS INTEGER) AS sk_cliente, bk_id_solicitud,
               {CLIENT_ATTRS_SQL}, 'run_prev' AS via_airflow_run_id FROM p_silver_all),
    dim_new_keys AS (
        SELECT bk_id_solicitud, CAST((SELECT COALESCE(MAX(sk_cliente), 0) FROM dim_prev)
               + row_number() OVER (ORDER BY bk_id_solicitud) AS INTEGER) AS sk_cliente
        FROM c_silver_all s WHERE NOT EXISTS (SELECT 1 FROM dim_prev p WHERE p.bk_id_solicitud = s.bk_id_solicitud)),
    dim_cur AS (
        SELECT COALESCE(p.sk_cliente, k.sk_cliente) AS sk_cliente, s.bk_id_solicitud,
               {', '.join('s.' + a.strip() for a in CLIENT_ATTRS_SQL.split(','))}, 'run_cur' AS via_airflow_run_id
        FROM c_silver_all s LEFT JOIN dim_prev p ON s.bk_id_solicitud = p.bk_id_solicitud
        LEFT JOIN dim_new_keys k ON s.bk_id_solicitud = k.bk_id_solicitud
        UNION ALL
        SELECT p.* FROM dim_prev p WHERE NOT EXISTS (SELECT 1 FROM c_silver_all s WHERE s.bk_id_solicitud = p.bk_id_solicitud))"""


def q_dim_cliente_scd1() -> str:
    return f"WITH {_dim_cliente_scd1_ctes()} SELECT * FROM dim_cur"


def q_dim_tiempo() -> str:
    return f"""
    SELECT CAST(row_number() OVER (ORDER BY fecha) AS INTEGER) AS sk_tiempo, fecha,
           CAST(year(fecha) AS INTEGER) AS anio, CAST(month(fecha) AS INTEGER) AS mes,
           CAST(quarter(fecha) AS INTEGER) AS trimestre, CAST(dayofweek(fecha) AS INTEGER) AS dia_semana
    FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS fecha FROM orders
          UNION SELECT DATE '{AS_OF_PREVIOUS.isoformat()}' UNION SELECT DATE '{AS_OF_CURRENT.isoformat()}')"""


def _tiempo_sk(as_of) -> str:
    return f"""(SELECT CAST(count(*) AS INTEGER) FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS fecha FROM orders
          UNION SELECT DATE '{AS_OF_PREVIOUS.isoformat()}' UNION SELECT DATE '{AS_OF_CURRENT.isoformat()}')
          WHERE fecha <= DATE '{as_of.isoformat()}')"""


def _fact_ctes() -> str:
    # previous fact from the previous silver; the current load upserts partially
    return f"""
    {_dim_cliente_scd1_ctes()},
    prod_prev AS (SELECT CAST(row_number() OVER (ORDER BY n) AS INTEGER) AS sk_producto, n AS nombre_producto
        FROM (SELECT DISTINCT name_contract_type AS n FROM p_silver_all WHERE name_contract_type IS NOT NULL)),
    prod_new AS (SELECT CAST((SELECT COALESCE(MAX(sk_producto), 0) FROM prod_prev) + row_number() OVER (ORDER BY n)
            AS INTEGER) AS sk_producto, n AS nombre_producto
        FROM (SELECT DISTINCT name_contract_type AS n FROM c_silver_all WHERE name_contract_type IS NOT NULL
              AND name_contract_type NOT IN (SELECT nombre_producto FROM prod_prev))),
    prod_cur AS (SELECT * FROM prod_prev UNION ALL SELECT * FROM prod_new),
    fact_prev_src AS (
        SELECT s.bk_id_solicitud AS dd_id_solicitud, c.sk_cliente, p.sk_producto, {_tiempo_sk(AS_OF_PREVIOUS)} AS sk_tiempo,
               {', '.join('s.' + m for m in ['amt_credit', 'amt_income_total', 'amt_annuity', 'days_employed', 'credit_to_income_ratio', 'annuity_income_ratio', 'target'])}
        FROM p_silver_all s JOIN dim_prev c ON s.bk_id_solicitud = c.bk_id_solicitud
        JOIN prod_prev p ON s.name_contract_type = p.nombre_producto),
    fact_prev AS (SELECT CAST(row_number() OVER (ORDER BY dd_id_solicitud) AS INTEGER) AS sk_fact, *,
        CAST(1 AS INTEGER) AS sk_proxy_documental, 'run_prev' AS via_airflow_run_id FROM fact_prev_src),
    fact_src AS (
        SELECT s.bk_id_solicitud AS dd_id_solicitud, c.sk_cliente, p.sk_producto, {_tiempo_sk(AS_OF_CURRENT)} AS sk_tiempo,
               {', '.join('s.' + m for m in ['amt_credit', 'amt_income_total', 'amt_annuity', 'days_employed', 'credit_to_income_ratio', 'annuity_income_ratio', 'target'])}
        FROM c_silver_all s JOIN dim_cur c ON s.bk_id_solicitud = c.bk_id_solicitud
        JOIN prod_cur p ON s.name_contract_type = p.nombre_producto),
    fact_new_keys AS (SELECT dd_id_solicitud, CAST((SELECT COALESCE(MAX(sk_fact), 0) FROM fact_prev)
            + row_number() OVER (ORDER BY dd_id_solicitud) AS INTEGER) AS sk_fact
        FROM fact_src s WHERE NOT EXISTS (SELECT 1 FROM fact_prev f WHERE f.dd_id_solicitud = s.dd_id_solicitud)),
    fact_cur AS (
        SELECT COALESCE(f.sk_fact, k.sk_fact) AS sk_fact, s.dd_id_solicitud,
               COALESCE(f.sk_cliente, s.sk_cliente) AS sk_cliente, COALESCE(f.sk_producto, s.sk_producto) AS sk_producto,
               s.sk_tiempo, CAST(1 AS INTEGER) AS sk_proxy_documental,
               s.amt_credit, s.amt_income_total, s.amt_annuity, s.days_employed, s.credit_to_income_ratio,
               s.annuity_income_ratio, s.target, 'run_cur' AS via_airflow_run_id
        FROM fact_src s LEFT JOIN fact_prev f ON s.dd_id_solicitud = f.dd_id_solicitud
        LEFT JOIN fact_new_keys k ON s.dd_id_solicitud = k.dd_id_solicitud
        UNION ALL
        SELECT sk_fact, dd_id_solicitud, sk_cliente, sk_producto, sk_tiempo, sk_proxy_documental, amt_credit,
               amt_income_total, amt_annuity, days_employed, credit_to_income_ratio, annuity_income_ratio, target,
               via_airflow_run_id
        FROM fact_prev f WHERE NOT EXISTS (SELECT 1 FROM fact_src s WHERE s.dd_id_solicitud = f.dd_id_solicitud))"""


def q_fact_creditos() -> str:
    # one load into an empty star, evaluated on AS_OF_CURRENT
    return f"""
    WITH {silver_ctes('s')},
    dim AS (SELECT CAST(row_number() OVER (ORDER BY bk_id_solicitud) AS INTEGER) AS sk_cliente, bk_id_solicitud FROM s_silver),
    prod AS (SELECT CAST(row_number() OVER (ORDER BY n) AS INTEGER) AS sk_producto, n AS nombre_producto
        FROM (SELECT DISTINCT name_contract_type AS n FROM s_silver WHERE name_contract_type IS NOT NULL)),
    src AS (SELECT s.bk_id_solicitud AS dd_id_solicitud, c.sk_cliente, p.sk_producto, {_tiempo_sk(AS_OF_CURRENT)} AS sk_tiempo,
               CAST(1 AS INTEGER) AS sk_proxy_documental,
               s.amt_credit, s.amt_income_total, s.amt_annuity, s.days_employed, s.credit_to_income_ratio,
               s.annuity_income_ratio, s.target, 'run_gold' AS via_airflow_run_id
        FROM s_silver s JOIN dim c ON s.bk_id_solicitud = c.bk_id_solicitud
        JOIN prod p ON s.name_contract_type = p.nombre_producto)
    SELECT CAST(row_number() OVER (ORDER BY dd_id_solicitud) AS INTEGER) AS sk_fact, * FROM src"""


def q_fact_partial_upsert() -> str:
    return f"WITH {_fact_ctes()} SELECT * FROM fact_cur"


def q_vw_riesgo() -> str:
    view_src = {
        "dd_id_solicitud": "s.bk_id_solicitud", "nombre_producto": "s.name_contract_type",
        "tipo_documento_origen": f"'{LEGACY_DOC_TYPE_SQL}'",
        "nivel_confianza_extraccion": f"CAST({LEGACY_CONFIDENCE} AS DECIMAL(5,2))",
        "fecha": f"DATE '{AS_OF_CURRENT.isoformat()}'",
    }
    cols = ", ".join(f"{view_src.get(src, 's.' + src)} AS {name}" for src, name in VIEW_COLUMNS)
    return f"WITH {silver_ctes('s')} SELECT {cols} FROM s_silver s WHERE s.name_contract_type IS NOT NULL"


def q_dq_gate() -> str:
    return f"""
    WITH {silver_ctes('s')}
    SELECT CAST(count(*) FILTER (WHERE days_employed = 365243) AS BIGINT) AS n_outliers_empleo,
           CAST(count(*) FILTER (WHERE bk_id_solicitud IS NULL) AS BIGINT) AS n_pk_nula,
           CAST(count(*) FILTER (WHERE credit_to_income_ratio < 0) AS BIGINT) AS n_ratio_negativo,
           count(*) FILTER (WHERE days_employed = 365243) = 0 AS check_outliers_empleo,
           count(*) FILTER (WHERE bk_id_solicitud IS NULL) = 0 AS check_pk_nula,
           count(*) FILTER (WHERE credit_to_income_ratio < 0) = 0 AS check_ratio_valido
    FROM s_silver"""


def q_dq_integrity() -> str:
    return f"""
    WITH {_fact_ctes()}
    SELECT CAST((SELECT count(*) FROM fact_cur f WHERE NOT EXISTS (SELECT 1 FROM dim_cur c WHERE c.sk_cliente = f.sk_cliente)) AS BIGINT) AS huerfanos_cliente,
           CAST((SELECT count(*) FROM fact_cur f WHERE NOT EXISTS (SELECT 1 FROM prod_cur p WHERE p.sk_producto = f.sk_producto)) AS BIGINT) AS huerfanos_producto,
           CAST((SELECT count(*) FROM fact_cur f WHERE f.sk_tiempo NOT BETWEEN 1 AND {_tiempo_sk(AS_OF_CURRENT)}) AS BIGINT) AS huerfanos_tiempo,
           CAST((SELECT count(*) FROM fact_cur f WHERE f.sk_proxy_documental <> 1) AS BIGINT) AS huerfanos_proxy,
           CAST((SELECT count(*) - count(DISTINCT bk_id_solicitud) FROM c_silver_all) AS BIGINT) AS duplicados_silver,
           CAST((SELECT count(*) - count(DISTINCT bk_id_solicitud) FROM dim_cur) AS BIGINT) AS duplicados_cliente,
           CAST((SELECT count(*) - count(DISTINCT dd_id_solicitud) FROM fact_cur) AS BIGINT) AS duplicados_fact,
           CAST((SELECT count(*) - count(DISTINCT sk_cliente) FROM dim_cur) AS BIGINT) AS duplicados_sk_cliente,
           CAST((SELECT count(*) FROM c_silver_all WHERE bk_id_solicitud IS NULL) AS BIGINT) AS nulos_pk"""


def q_audit_counts() -> str:
    runs = ["run_0", "run_1", "run_2", "run_idp"]
    parts = [f"""SELECT '{r}' AS via_airflow_run_id, '{SILVER_TASK}' AS nombre_tarea, '{SILVER_TARGET}' AS capa_destino,
           CAST((SELECT count(*) FROM s_silver WHERE via_airflow_run_id = '{r}') AS INTEGER) AS filas_procesadas,
           '{STATUS_OK}' AS estado_ejecucion, '{SILVER_MESSAGE}' AS mensaje_detalle""" for r in runs]
    return f"WITH {silver_ctes('s')} " + " UNION ALL ".join(parts)


def q_receipt_extract() -> str:
    c = RECEIPT_PAYLOAD_CONSTANTS
    text = ("CASE WHEN o_orderkey % 5 = 0 THEN 'BOLETA DE PAGO' || chr(10) || 'TOTAL HABERES' || chr(10) || 'sin monto ' || CAST(o_orderkey AS VARCHAR) "
            "WHEN o_orderkey % 5 = 1 THEN 'boleta' || chr(10) || 'neto a pagar s/ ' || printf('%.2f', o_totalprice) "
            "ELSE 'BOLETA' || chr(10) || 'NETO A PAGAR S/' || chr(10) || chr(10) || format('{:,.2f}', o_totalprice) || ' ref 1.00' END")
    name = "(CASE WHEN o_orderkey % 17 = 0 THEN 'x' ELSE CAST(o_orderkey AS VARCHAR) END) || '_boleta.jpg'"
    pat = AMOUNT_PATTERN.replace("'", "''")
    return f"""
    WITH r AS (SELECT {name} AS nombre_archivo, {text} AS texto FROM orders),
    p AS (SELECT nombre_archivo, split_part(nombre_archivo, '_', 1) AS id_solicitud,
                 CAST(replace(NULLIF(regexp_extract(texto, '{pat}', 1), ''), ',', '') AS DOUBLE) AS monto FROM r)
    SELECT nombre_archivo, id_solicitud,
           CASE WHEN regexp_full_match(id_solicitud, '[0-9]+') THEN 'procesado' ELSE 'ignorado' END AS estado,
           CASE WHEN regexp_full_match(id_solicitud, '[0-9]+') THEN COALESCE(NULLIF(monto, 0), 0.0) END AS amt_income_total,
           CASE WHEN regexp_full_match(id_solicitud, '[0-9]+') THEN
                CAST(CASE WHEN monto IS NOT NULL AND monto <> 0 THEN {CONFIDENCE_AMOUNT_FOUND} ELSE {CONFIDENCE_AMOUNT_MISSING} END AS DOUBLE) END
                AS confidence_score,
           CASE WHEN regexp_full_match(id_solicitud, '[0-9]+') THEN '{RECEIPT_DOCUMENT_TYPE}' END AS document_type,
           CASE WHEN regexp_full_match(id_solicitud, '[0-9]+') THEN CAST({c['AMT_CREDIT']} AS DOUBLE) END AS amt_credit
    FROM p"""


def q_receipt_bronze() -> str:
    return f"""
    WITH x AS ({q_receipt_extract()})
    SELECT id_solicitud AS bk_id_solicitud, nombre_archivo AS nombre_archivo_fuente, true AS es_documento,
           'run_ocr' AS via_airflow_run_id, CAST(amt_income_total AS DECIMAL(12,2)) AS amt_income_total,
           document_type, CAST(confidence_score AS DECIMAL(5,2)) AS confidence_score
    FROM x WHERE estado = 'procesado'"""


def q_dq_domain() -> str:
    limits = VARCHAR_LIMITS["silver.cleaned_application"]
    cols = ", ".join(f"CAST(count(*) FILTER (WHERE length({c}) > {n}) AS BIGINT) AS largo_excedido_{c}"
                     for c, n in limits.items())
    return f"WITH {silver_ctes('s')} SELECT {cols} FROM s_silver"


def q_ingest_once() -> str:
    name = "source || '/doc_' || CAST(doc_id AS VARCHAR) || '.json'"
    return f"SELECT {name} AS nombre_archivo, source FROM documents WHERE lang NOT IN ('en', 'fr') OR lang IS NULL"


def q_stream_bronze() -> str:
    return f"""
    SELECT CAST(user_id * {20 * ID_STEP} AS VARCHAR) AS bk_id_solicitud,
           CAST(CASE WHEN event_type = 'error' THEN 0.0 ELSE value * 100 END AS DECIMAL(12,2)) AS amt_income_total,
           event_type AS document_type,
           CAST(CAST(json_extract_string(props, '$.k') AS DOUBLE) AS DECIMAL(5,2)) AS confidence_score,
           'run_stream' AS via_airflow_run_id, true AS es_documento
    FROM events"""


def q_ingest_batch() -> str:
    good = f"""SELECT 'cargado' AS estado, CAST(user_id * {20 * ID_STEP} AS VARCHAR) AS bk_id_solicitud,
           CAST(CASE WHEN event_type = 'error' THEN 0.0 ELSE value * 100 END AS DECIMAL(12,2)) AS amt_income_total,
           event_type AS document_type"""
    return f"""
    {good}, 'run_1' AS via_airflow_run_id FROM events WHERE event_id % 10 <> 0
    UNION ALL {good}, 'run_3' AS via_airflow_run_id FROM events WHERE event_id % 3 = 0
    UNION ALL SELECT 'cuarentena', NULL, NULL, NULL, 'run_1' FROM events WHERE event_id % 10 = 0"""


def q_load_times() -> str:
    def rows(name, key, source, stamp):
        return f"SELECT '{name}' AS tabla, CAST({key} AS VARCHAR) AS clave, {stamp} AS fecha_carga FROM {source}"

    t1, t2 = (f"TIMESTAMP '{d.isoformat()} 00:00:00'" for d in (AS_OF_PREVIOUS, AS_OF_CURRENT))
    return f"""WITH {_fact_ctes()} """ + " UNION ALL ".join([
        rows("silver", "bk_id_solicitud", "c_silver_all",
             f"CASE WHEN bk_id_solicitud IN (SELECT bk_id_solicitud FROM c_silver) THEN {t2} ELSE {t1} END"),
        rows("dim_cliente", "bk_id_solicitud", "dim_cur", t2),
        rows("dim_producto", "nombre_producto", "prod_prev", t1),
        rows("dim_producto", "nombre_producto", "prod_new", t2),
        rows("dim_proxy_documental", "'1'", "(SELECT 1)", t1),
        rows("fact_creditos", "dd_id_solicitud", "fact_cur",
             f"CASE WHEN dd_id_solicitud IN (SELECT dd_id_solicitud FROM fact_src) THEN {t2} ELSE {t1} END")])


def q_dq_faults() -> str:
    silver = {"nulo_bk_id_solicitud": "count(*) FILTER (WHERE id % 11 = 0)",
              "duplicado_bk_id_solicitud": "count(*) FILTER (WHERE id % 7 = 0 AND id % 11 <> 0) // 2",
              "largo_name_education_type": "count(*) FILTER (WHERE id % 13 = 0)"}
    silver |= {f"largo_{c}": "0 * count(*)" for c in VARCHAR_LIMITS["silver.cleaned_application"] if c != "name_education_type"}
    none = "0 * count(*)"
    fact = {"nulo_sk_fact": none, "largo_via_airflow_run_id": none, "huerfano_sk_proxy_documental": none,
            "duplicado_sk_fact": "count(*) FILTER (WHERE id % 7 = 0) // 2",
            "duplicado_dd_id_solicitud": "count(*) FILTER (WHERE id % 7 = 0) // 2",
            "huerfano_sk_cliente": "count(*) FILTER (WHERE id % 5 = 0)", "huerfano_sk_tiempo": "count(*)",
            "huerfano_sk_producto": "count(*) FILTER (WHERE producto = (SELECT min(producto) FROM doble))"}
    parts = [f"SELECT '{t}' AS tabla, '{rule}' AS regla, CAST((SELECT {n} FROM doble {where}) AS BIGINT) AS filas"
             for t, rules, where in (("silver.cleaned_application", silver, ""),
                                     ("gold.fact_creditos", fact, "WHERE producto IS NOT NULL"))
             for rule, n in rules.items()]
    return f"""WITH {silver_ctes('s')}, una AS (SELECT bk_id_solicitud AS id, name_contract_type AS producto FROM s_silver),
    doble AS (SELECT * FROM una UNION ALL SELECT * FROM una WHERE id % 7 = 0) """ + " UNION ALL ".join(parts)


def q_bronze_csv() -> str:
    return f"""
    SELECT CAST(cust AS VARCHAR) AS bk_id_solicitud,
           CASE WHEN seq % 11 <> 0 THEN o_orderpriority END AS name_contract_type,
           CAST(o_totalprice AS DECIMAL(12,2)) AS amt_credit,
           CASE WHEN seq % 13 <> 0 THEN CAST(c_nationkey * 100 + 850 AS DECIMAL(12,2)) END AS amt_annuity,
           CAST(CASE WHEN seq % 7 = 0 THEN 365243 ELSE -(seq % 15000) END AS INTEGER) AS days_employed,
           'run_csv' AS via_airflow_run_id, 'application_train.csv' AS nombre_archivo_fuente
    FROM ({base_rows_sql()})"""


def q_stream_counters() -> str:
    rows = {"documentos": ("count(*)", "NULL"), "documentos_filas": ("count(*) FILTER (WHERE event_id % 10 <> 0)",) * 2,
            "documentos_cuarentena": ("count(*) FILTER (WHERE event_id % 10 = 0)",) * 2}
    return " UNION ALL ".join(f"SELECT '{name}' AS contador, CAST({a} AS BIGINT) AS observadas, CAST({b} AS BIGINT) AS guardadas FROM events"
                              for name, (a, b) in rows.items())


MEASURES_SQL = "amt_credit, amt_income_total, amt_annuity, days_employed, credit_to_income_ratio, annuity_income_ratio, target"


def q_load_incremental() -> str:
    late = f"o.o_orderdate >= TIMESTAMP '{UPSERT_SPLIT}'"
    base, doc = f"o.o_custkey * {ID_STEP} // 65536 = 1", f"user_id * {20 * ID_STEP} // 65536 = 1"
    cols = ", ".join(f"s.{c.strip()}" for c in MEASURES_SQL.split(","))
    old = ", ".join(f"f.{c.strip()}" for c in MEASURES_SQL.split(","))
    # the previous star, then updates of the applications with current records and inserts after its last keys
    return f"""
    WITH {silver_ctes('p', f'WHERE NOT ({late} AND {base})', doc_where=f'WHERE NOT ({doc})')}, {silver_ctes('s')},
    changed AS (SELECT o_custkey * {ID_STEP} AS id FROM orders o WHERE {late} AND {base}
                UNION SELECT user_id * {20 * ID_STEP} FROM events WHERE {doc}),
    cur AS (SELECT * FROM s_silver WHERE bk_id_solicitud IN (SELECT id FROM changed)),
    client_prev AS (SELECT row_number() OVER (ORDER BY bk_id_solicitud) AS sk, bk_id_solicitud AS id FROM p_silver),
    client AS (SELECT * FROM client_prev UNION ALL
               SELECT (SELECT max(sk) FROM client_prev) + row_number() OVER (ORDER BY bk_id_solicitud), bk_id_solicitud FROM cur
               WHERE bk_id_solicitud NOT IN (SELECT id FROM client_prev)),
    prod_prev AS (SELECT row_number() OVER (ORDER BY n) AS sk, n FROM (
        SELECT DISTINCT name_contract_type AS n FROM p_silver WHERE name_contract_type IS NOT NULL)),
    prod AS (SELECT * FROM prod_prev UNION ALL
             SELECT (SELECT max(sk) FROM prod_prev) + row_number() OVER (ORDER BY n), n FROM (
                 SELECT DISTINCT name_contract_type AS n FROM cur WHERE name_contract_type NOT IN (SELECT n FROM prod_prev))),
    fact_prev AS (SELECT row_number() OVER (ORDER BY bk_id_solicitud) AS sk_fact, c.sk AS sk_cliente, p.sk AS sk_producto, s.*
        FROM p_silver s JOIN client_prev c ON c.id = s.bk_id_solicitud JOIN prod_prev p ON p.n = s.name_contract_type),
    src AS (SELECT c.sk AS sk_cliente, p.sk AS sk_producto, s.* FROM cur s
        JOIN client c ON c.id = s.bk_id_solicitud JOIN prod p ON p.n = s.name_contract_type),
    done AS (
      SELECT coalesce(f.sk_fact, (SELECT max(sk_fact) FROM fact_prev) + row_number() OVER (
                 PARTITION BY f.sk_fact IS NULL ORDER BY s.bk_id_solicitud)) AS sk_fact, s.bk_id_solicitud AS dd_id_solicitud,
             coalesce(f.sk_cliente, s.sk_cliente) AS sk_cliente, coalesce(f.sk_producto, s.sk_producto) AS sk_producto,
             {cols}, 'run_cur' AS via_airflow_run_id, DATE '{AS_OF_CURRENT.isoformat()}' AS fecha_evaluacion_datos
      FROM src s LEFT JOIN fact_prev f ON f.bk_id_solicitud = s.bk_id_solicitud
      UNION ALL
      SELECT f.sk_fact, f.bk_id_solicitud, f.sk_cliente, f.sk_producto, {old}, 'run_prev', DATE '{AS_OF_PREVIOUS.isoformat()}'
      FROM fact_prev f WHERE f.bk_id_solicitud NOT IN (SELECT bk_id_solicitud FROM src))
    SELECT CAST(sk_fact AS INTEGER) AS sk_fact, dd_id_solicitud, CAST(sk_cliente AS INTEGER) AS sk_cliente,
           CAST(sk_producto AS INTEGER) AS sk_producto, CAST(1 AS INTEGER) AS sk_proxy_documental, {MEASURES_SQL},
           via_airflow_run_id, fecha_evaluacion_datos FROM done"""


def q_audit_log() -> str:
    counts = {1: ("p", "run_1"), 2: ("p", "run_1"), 3: ("s", "run_idp"), 4: ("s", "run_idp")}
    return f"WITH {silver_ctes('p', PREV_WHERE, with_docs=False)}, {silver_ctes('s')} " + " UNION ALL ".join(f"""
    SELECT CAST({i} AS INTEGER) AS log_id, '{run}' AS via_airflow_run_id, '{SILVER_TASK}' AS nombre_tarea, '{SILVER_TARGET}' AS capa_destino,
           CAST((SELECT count(*) FROM {p}_silver WHERE via_airflow_run_id = '{run}') AS INTEGER) AS filas_procesadas,
           '{STATUS_OK}' AS estado_ejecucion, '{SILVER_MESSAGE}' AS mensaje_detalle""" for i, (p, run) in counts.items())


def q_warehouse_reset() -> str:
    bronze = "(SELECT count(*) FROM orders) + (SELECT count(*) FROM events)"
    silver = "(SELECT count(*) FROM s_silver)"
    return f"WITH {silver_ctes('s')} " + " UNION ALL ".join(
        f"SELECT '{m}' AS momento, '{t}' AS tabla, CAST({n} AS BIGINT) AS filas" for m, t, n in (
            ("cargado", "bronze.raw_application", bronze), ("cargado", "silver.cleaned_application", silver),
            ("reiniciado", "bronze.raw_application", bronze),
            ("recargado", "bronze.raw_application", bronze), ("recargado", "silver.cleaned_application", silver)))


def q_silver_documents() -> str:
    return f"WITH {silver_ctes('s')} SELECT bk_id_solicitud, tipo_documento, confianza_ocr FROM s_silver"


def q_vw_riesgo_hoy() -> str:
    return f"""WITH {silver_ctes('s')} SELECT bk_id_solicitud AS id_solicitud, CAST(0 AS INTEGER) AS dias
    FROM s_silver WHERE name_contract_type IS NOT NULL"""


def q_bronze_csv_lines() -> str:
    return f"""SELECT CAST(cust AS VARCHAR) AS bk_id_solicitud,
           repeat(c_name, 4) || chr(10) || 'linea "dos", fin' || chr(10) || CAST(cust AS VARCHAR) AS organization_type,
           CAST(o_totalprice AS DECIMAL(12,2)) AS amt_credit FROM ({base_rows_sql()})"""


def q_document_files() -> str:
    return """SELECT CAST(s_suppkey AS VARCHAR) AS bk_id_solicitud, s_suppkey || '_boleta.json' AS nombre, true AS id_numerico,
           CAST(s_acctbal AS DECIMAL(12,2)) AS amt_income_total, true AS varias_lineas, true AS entero FROM supplier"""


def q_receipt_states() -> str:
    return f"""
    WITH r AS (SELECT CASE WHEN s_suppkey % 17 = 0 THEN 'x' ELSE CAST(s_suppkey AS VARCHAR) END AS id,
               CASE WHEN s_suppkey % 17 = 0 THEN 'ignorado' WHEN s_suppkey % 7 = 0 THEN 'fallido' ELSE 'procesado' END AS estado,
               CASE WHEN s_suppkey % 7 <> 0 THEN 'NETO A PAGAR S/ ' || printf('%.2f', abs(s_acctbal)) END AS texto FROM supplier)
    SELECT id || '_boleta.jpg' AS nombre_archivo, estado,
           CASE WHEN estado = 'procesado' THEN coalesce(CAST(replace(NULLIF(regexp_extract(texto, '{AMOUNT_PATTERN.replace("'", "''")}', 1), ''), ',', '')
               AS DOUBLE), 0.0) END AS amt_income_total,
           CASE WHEN estado = 'procesado' THEN 'idp_boleta_{AS_OF_CURRENT.strftime("%Y%m%d")}_000000_' || id || '.json' END AS archivo FROM r"""


def q_dq_gate_faults() -> str:
    days, lost = "bk_id_solicitud % 7 = 0", "bk_id_solicitud % 11 = 0"
    ratio = "bk_id_solicitud % 13 = 0"
    return f"""
    WITH {silver_ctes('s')}
    SELECT count(*) FILTER (WHERE {days}) AS n_outliers_empleo, count(*) FILTER (WHERE {lost}) AS n_pk_nula,
           count(*) FILTER (WHERE {ratio}) AS n_ratio_negativo, count(*) FILTER (WHERE {days}) = 0 AS check_outliers_empleo,
           count(*) FILTER (WHERE {lost}) = 0 AS check_pk_nula, count(*) FILTER (WHERE {ratio}) = 0 AS check_ratio_valido
    FROM s_silver"""


def q_ingest_delivery() -> str:
    good = "CAST(count(*) FILTER (WHERE event_id % 10 <> 0) AS BIGINT)"
    return " UNION ALL ".join(f"""SELECT '{run}' AS via_airflow_run_id, {good} AS cargadas, {good} AS numeros,
        count(*) AS archivadas, CAST(0 AS INTEGER) AS abiertas FROM events""" for run in ("run_1", "run_3"))


def q_silver_window_plan() -> str:
    return q_silver_features()


ORACLES = {
    "bronze_pack": q_bronze_pack,
    "bronze_csv": q_bronze_csv,
    "latest_base": q_latest_base,
    "latest_document": q_latest_document,
    "base_typed": q_base_typed,
    "document_typed": q_document_typed,
    "silver_features": q_silver_features,
    "silver_features_window": q_silver_window_plan,
    "silver_features_narrow": q_silver_window_plan,
    "silver_upsert": q_silver_upsert,
    "dim_producto": q_dim_producto,
    "dim_cliente_scd1": q_dim_cliente_scd1,
    "dim_tiempo": q_dim_tiempo,
    "fact_creditos": q_fact_creditos,
    "fact_partial_upsert": q_fact_partial_upsert,
    "vw_riesgo": q_vw_riesgo,
    "dq_gate": q_dq_gate,
    "dq_integrity": q_dq_integrity,
    "audit_counts": q_audit_counts,
    "receipt_extract": q_receipt_extract,
    "receipt_bronze": q_receipt_bronze,
    "dq_domain": q_dq_domain,
    "ingest_once": q_ingest_once,
    "stream_bronze": q_stream_bronze,
    "load_run": q_vw_riesgo,
    "silver_incremental": q_silver_upsert,
    "ingest_batch": q_ingest_batch,
    "load_times": q_load_times,
    "dq_faults": q_dq_faults,
    "dq_gate_faults": q_dq_gate_faults,
    "stream_counters": q_stream_counters,
    "ingest_delivery": q_ingest_delivery,
    "load_incremental": q_load_incremental,
    "vw_riesgo_buckets": q_vw_riesgo,
    "audit_log": q_audit_log,
    "warehouse_reset": q_warehouse_reset,
    "silver_documents": q_silver_documents,
    "vw_riesgo_hoy": q_vw_riesgo_hoy,
    "bronze_csv_lines": q_bronze_csv_lines,
    "document_files": q_document_files,
    "receipt_states": q_receipt_states,
}


def oracle_sql() -> dict[str, str]:
    return {k: f() for k, f in ORACLES.items()}
