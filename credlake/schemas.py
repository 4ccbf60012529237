"""Table schemas and the fixed values the pipeline must reproduce.

Column and table names are the data model's own (Spanish) names so that a
BI report built on the original star keeps working.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES: these must equal the original pipeline's values for results
# to match.  Keep them here, together, in their natural order.
# ---------------------------------------------------------------------------
SENTINEL_DAYS_EMPLOYED = 365243            # "not employed" marker in DAYS_EMPLOYED
DAYS_PER_YEAR = "365.25"                   # divisor for age / tenure / residence years
ORG_TYPE_MAX_LEN = 50                      # ORGANIZATION_TYPE is cut to VARCHAR(50)
LEGACY_DOC_TYPE = "Dataset Histórico Kaggle (Legacy CSV)"
LEGACY_CONFIDENCE = "100.00"
DEFAULT_RUN_ID = "id_no_encontrado"
CSV_FILE_NAME = "application_train.csv"
DOC_FILE_GLOB = "idp_boleta_*.json"
DOC_FILE_PREFIX = "idp_boleta_"
DOC_FILE_TS_FORMAT = "yyyyMMdd_HHmmss"
IMAGE_GLOB = "*.jpg"
DOC_METADATA_KEY = "IDP_METADATA"
BUSINESS_KEY_FIELD = "SK_ID_CURR"
# Receipt amount: case-insensitive, dot matches newline, first match, group 1.
AMOUNT_PATTERN = r"(?is)NETO A PAGAR S/.*?([\d]{1,3}(?:,[\d]{3})*(?:\.\d{2}))"
CONFIDENCE_AMOUNT_FOUND = 85.5
CONFIDENCE_AMOUNT_MISSING = 30.0
# Constant attributes of every extracted receipt payload, in payload order.
RECEIPT_PAYLOAD_CONSTANTS = {
    "TARGET": 0,
    "NAME_CONTRACT_TYPE": "Cash loans",
    "CODE_GENDER": "M",
    "AMT_CREDIT": 15000.0,
    "AMT_ANNUITY": 850.0,
    "DAYS_EMPLOYED": -1200,
    "NAME_EDUCATION_TYPE": "Higher education",
    "NAME_FAMILY_STATUS": "Married",
    "CNT_CHILDREN": 1,
}
RECEIPT_DOCUMENT_TYPE = "Boleta_Pago_Fisica"
PROXY_DEFAULT_SK = 1
PROXY_DEFAULT_MANUAL_FLAG = True
SILVER_TASK = "transformacion_elt_a_silver"
SILVER_TARGET = "silver.cleaned_application"
STATUS_OK = "EXITO"
SILVER_MESSAGE = "Fusión de datos históricos Kaggle y métricas IDP completada exitosamente"
# Semantic view: (source column, published name), in view order.
VIEW_COLUMNS = [
    ("dd_id_solicitud", "id_solicitud"),
    ("amt_credit", "monto_credito_solicitado"),
    ("amt_income_total", "ingresos_totales_cliente"),
    ("amt_annuity", "monto_anualidad_credito"),
    ("credit_to_income_ratio", "ratio_credito_ingreso"),
    ("annuity_income_ratio", "ratio_anualidad_ingreso"),
    ("target", "flag_morosidad"),
    ("code_gender", "genero"),
    ("name_education_type", "nivel_educativo"),
    ("name_family_status", "estado_civil"),
    ("cnt_children", "cantidad_hijos"),
    ("edad_anios", "edad_anios"),
    ("antiguedad_laboral_anios", "antiguedad_laboral_anios"),
    ("sector_economico", "sector_economico"),
    ("calificacion_region_ciudad", "calificacion_region_ciudad"),
    ("flag_discrepancia_ciudad", "flag_discrepancia_ciudad"),
    ("anios_residencia", "anios_residencia"),
    ("nombre_producto", "tipo_contrato"),
    ("tipo_documento_origen", "origen_documental_ingresos"),
    ("nivel_confianza_extraccion", "confianza_ocr_idp"),
    ("fecha", "fecha_evaluacion_datos"),
]
# Declared VARCHAR(n) widths that the quality rules check.
VARCHAR_LIMITS = {
    "silver.cleaned_application": {
        "name_contract_type": 50, "code_gender": 10, "name_education_type": 50,
        "name_family_status": 50, "sector_economico": 100, "via_airflow_run_id": 100,
    },
    "gold.dim_producto": {"nombre_producto": 50, "via_airflow_run_id": 100},
    "gold.dim_proxy_documental": {"tipo_documento_origen": 50, "via_airflow_run_id": 100},
    "gold.dim_cliente": {
        "code_gender": 10, "name_education_type": 50, "name_family_status": 50,
        "sector_economico": 100, "via_airflow_run_id": 100,
    },
    "gold.fact_creditos": {"via_airflow_run_id": 100},
    "audit.etl_log": {
        "via_airflow_run_id": 100, "nombre_tarea": 100, "capa_destino": 50, "estado_ejecucion": 20,
    },
}
# Primary keys, and further UNIQUE columns (several NULLs are allowed there).
PRIMARY_KEYS = {
    "silver.cleaned_application": "bk_id_solicitud",
    "gold.dim_tiempo": "sk_tiempo",
    "gold.dim_producto": "sk_producto",
    "gold.dim_proxy_documental": "sk_proxy_documental",
    "gold.dim_cliente": "sk_cliente",
    "gold.fact_creditos": "sk_fact",
    "audit.etl_log": "log_id",
}
UNIQUE_COLUMNS = {
    "gold.dim_tiempo": ["fecha"],
    "gold.dim_producto": ["nombre_producto"],
    "gold.dim_cliente": ["bk_id_solicitud"],
    "gold.fact_creditos": ["dd_id_solicitud"],
}
NOT_NULL_COLUMNS = {"audit.etl_log": ["via_airflow_run_id", "nombre_tarea"]}
# Foreign keys: column -> the table whose primary key it refers to.
FOREIGN_KEYS = {
    "gold.fact_creditos": {
        "sk_cliente": "gold.dim_cliente", "sk_producto": "gold.dim_producto",
        "sk_tiempo": "gold.dim_tiempo", "sk_proxy_documental": "gold.dim_proxy_documental",
    },
}
# ---------------------------------------------------------------------------

TS = T.TimestampNTZType()
D12_2 = T.DecimalType(12, 2)
D5_1 = T.DecimalType(5, 1)
D10_4 = T.DecimalType(10, 4)
D5_2 = T.DecimalType(5, 2)


def _s(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


BRONZE = _s(
    ("id_secuencial", T.LongType(), False),
    ("bk_id_solicitud", T.StringType(), True),
    ("datos_origen_raw", T.StringType(), False),
    ("via_airflow_run_id", T.StringType(), True),
    ("nombre_archivo_fuente", T.StringType(), True),
    ("fecha_ingestion", TS, True),
    # layout column: True for extracted documents, so each silver branch
    # prunes to its own files instead of probing every payload for the key
    ("es_documento", T.BooleanType(), False),
)

SILVER_FEATURES = [
    ("bk_id_solicitud", T.IntegerType()),
    ("target", T.ShortType()),
    ("name_contract_type", T.StringType()),
    ("code_gender", T.StringType()),
    ("amt_credit", D12_2),
    ("amt_income_total", D12_2),
    ("amt_annuity", D12_2),
    ("days_employed", T.IntegerType()),
    ("name_education_type", T.StringType()),
    ("name_family_status", T.StringType()),
    ("cnt_children", T.ShortType()),
    ("edad_anios", D5_1),
    ("antiguedad_laboral_anios", D5_1),
    ("sector_economico", T.StringType()),
    ("calificacion_region_ciudad", T.ShortType()),
    ("flag_discrepancia_ciudad", T.ShortType()),
    ("anios_residencia", D5_1),
    ("credit_to_income_ratio", D10_4),
    ("annuity_income_ratio", D10_4),
    ("via_airflow_run_id", T.StringType()),
]
SILVER = _s(*[(n, t, True) for n, t in SILVER_FEATURES], ("fecha_ingestion", TS, True))
SILVER_COLUMNS = [n for n, _ in SILVER_FEATURES]

DIM_TIEMPO = _s(
    ("sk_tiempo", T.IntegerType(), False),
    ("fecha", T.DateType(), True),
    ("anio", T.IntegerType(), True),
    ("mes", T.IntegerType(), True),
    ("trimestre", T.IntegerType(), True),
    ("dia_semana", T.IntegerType(), True),
)
DIM_PRODUCTO = _s(
    ("sk_producto", T.IntegerType(), False),
    ("nombre_producto", T.StringType(), True),
    ("via_airflow_run_id", T.StringType(), True),
    ("fecha_carga", TS, True),
)
DIM_PROXY = _s(
    ("sk_proxy_documental", T.IntegerType(), False),
    ("tipo_documento_origen", T.StringType(), True),
    ("nivel_confianza_extraccion", D5_2, True),
    ("flag_verificacion_manual", T.BooleanType(), True),
    ("via_airflow_run_id", T.StringType(), True),
    ("fecha_carga", TS, True),
)
CLIENT_ATTRS = [
    "code_gender", "name_education_type", "name_family_status", "cnt_children",
    "edad_anios", "antiguedad_laboral_anios", "sector_economico",
    "calificacion_region_ciudad", "flag_discrepancia_ciudad", "anios_residencia",
]
_silver_type = dict(SILVER_FEATURES)
DIM_CLIENTE = _s(
    ("sk_cliente", T.IntegerType(), False),
    ("bk_id_solicitud", T.IntegerType(), True),
    *[(c, _silver_type[c], True) for c in CLIENT_ATTRS],
    ("via_airflow_run_id", T.StringType(), True),
    ("fecha_carga", TS, True),
)
FACT_MEASURES = [
    "amt_credit", "amt_income_total", "amt_annuity", "days_employed",
    "credit_to_income_ratio", "annuity_income_ratio", "target",
]
FACT = _s(
    ("sk_fact", T.IntegerType(), False),
    ("dd_id_solicitud", T.IntegerType(), True),
    ("sk_cliente", T.IntegerType(), True),
    ("sk_producto", T.IntegerType(), True),
    ("sk_tiempo", T.IntegerType(), True),
    ("sk_proxy_documental", T.IntegerType(), True),
    *[(c, _silver_type[c], True) for c in FACT_MEASURES],
    ("via_airflow_run_id", T.StringType(), True),
    ("fecha_carga", TS, True),
)
AUDIT = _s(
    ("log_id", T.IntegerType(), False),
    ("via_airflow_run_id", T.StringType(), False),
    ("nombre_tarea", T.StringType(), False),
    ("capa_destino", T.StringType(), True),
    ("filas_procesadas", T.IntegerType(), True),
    ("estado_ejecucion", T.StringType(), True),
    ("mensaje_detalle", T.StringType(), True),
    ("fecha_ejecucion", TS, True),
)

# Fields of the raw application record that silver reads, all as text: the
# payload is parsed once with this narrow schema (unread keys are skipped).
BASE_FIELDS = [
    "SK_ID_CURR", "TARGET", "NAME_CONTRACT_TYPE", "CODE_GENDER", "AMT_CREDIT",
    "AMT_INCOME_TOTAL", "AMT_ANNUITY", "DAYS_EMPLOYED", "NAME_EDUCATION_TYPE",
    "NAME_FAMILY_STATUS", "CNT_CHILDREN", "DAYS_BIRTH", "ORGANIZATION_TYPE",
    "REGION_RATING_CLIENT_W_CITY", "REG_CITY_NOT_WORK_CITY", "DAYS_REGISTRATION",
]
BASE_PAYLOAD = T.StructType([T.StructField(f, T.StringType()) for f in BASE_FIELDS])
DOC_PAYLOAD = T.StructType([
    T.StructField("AMT_INCOME_TOTAL", T.StringType()),
    T.StructField(DOC_METADATA_KEY, T.StructType([
        T.StructField("document_type", T.StringType()),
        T.StructField("confidence_score", T.StringType()),
    ])),
])

# Bronze files already folded into silver (incremental silver loads).
SILVER_LEDGER = _s(
    ("ruta", T.StringType(), False),
    ("via_airflow_run_id", T.StringType(), True),
    ("fecha_carga", TS, True),
)

# Source files already appended to bronze (ingest-once).  A file is known by
# its path, modification time and length, so a new delivery under an old name
# is a new file; a stream's batch markers carry a name alone.  ``marca`` is the
# largest bronze sequence number that a load may use: a row with it is written
# before the load writes, so numbers are never used twice and bronze is not
# read to find the next one.
INGEST_LEDGER = _s(
    ("nombre_archivo", T.StringType(), False),
    ("ruta", T.StringType(), True),
    ("fecha_archivo", T.TimestampType(), True),
    ("tamano", T.LongType(), True),
    ("via_airflow_run_id", T.StringType(), True),
    ("fecha_carga", TS, True),
    ("marca", T.LongType(), True),
)

TABLES = {
    "bronze.raw_application": BRONZE,
    "silver.cleaned_application": SILVER,
    "gold.dim_tiempo": DIM_TIEMPO,
    "gold.dim_producto": DIM_PRODUCTO,
    "gold.dim_proxy_documental": DIM_PROXY,
    "gold.dim_cliente": DIM_CLIENTE,
    "gold.fact_creditos": FACT,
    "audit.etl_log": AUDIT,
    "audit.silver_ledger": SILVER_LEDGER,
    "bronze.ingested_files": INGEST_LEDGER,
}
# Layers rebuilt from bronze on re-initialisation; bronze is the only state kept.
REBUILDABLE = [t for t in TABLES if not t.startswith("bronze.")]
