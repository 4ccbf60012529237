"""Batch bronze ingestion (G-10 stage 2: K-01, P-01..P-04, Q-09).

The historical CSV is packed row by row into JSON records; extracted
documents are validated and kept as their own JSON text.  A malformed
document goes to quarantine with its raw text while the rest load (the CSV,
in contrast, aborts on a bad row: FAILFAST).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.payload import field, is_document, is_loadable, is_valid_json_object
from ..operators.bronze import pack_bronze
from ..schemas import BRONZE, BUSINESS_KEY_FIELD, CSV_FILE_NAME, DOC_METADATA_KEY


def _sequence(seq_base: int) -> Column:
    return F.lit(int(seq_base)) + F.monotonically_increasing_id()


def csv_to_bronze(csv_rows: DataFrame, run_id: str, file_name: str = CSV_FILE_NAME, seq_base: int = 0,
                  loaded_at: Column | None = None) -> DataFrame:
    doc = None if DOC_METADATA_KEY in csv_rows.columns else False
    return pack_bronze(csv_rows, run_id=run_id, source_file=file_name, loaded_at=loaded_at,
                       sequence=_sequence(seq_base), document=doc)


def documents_to_bronze(docs: DataFrame, run_id: str, seq_base: int = 0,
                        loaded_at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(bronze rows, quarantined rows) from ``value`` + ``nombre_archivo``.

    A document is loadable when it is a JSON object with a business key;
    a column ``cargable`` says so where that has been found before.
    """
    key = field(F.col("value"), BUSINESS_KEY_FIELD)
    ok = F.col("cargable") if "cargable" in docs.columns else is_loadable(F.col("value"))
    good = docs.filter(ok).select(
        _sequence(seq_base).alias("id_secuencial"),
        key.alias("bk_id_solicitud"),
        F.trim(F.col("value")).alias("datos_origen_raw"),
        F.lit(run_id).alias("via_airflow_run_id"),
        F.col("nombre_archivo").alias("nombre_archivo_fuente"),
        (loaded_at if loaded_at is not None else F.current_timestamp()).cast("timestamp_ntz").alias("fecha_ingestion"),
        is_document(F.col("value")).alias("es_documento"),
    ).select(*[F.col(f.name) for f in BRONZE.fields])
    bad = docs.filter(~ok).select(
        "nombre_archivo", F.col("value").alias("texto_crudo"), F.lit(run_id).alias("via_airflow_run_id"),
        F.when(~is_valid_json_object(F.col("value")), F.lit("json_invalido"))
        .otherwise(F.lit("sin_clave_negocio")).alias("motivo"),
        F.current_timestamp().cast("timestamp_ntz").alias("fecha_rechazo"))
    return good, bad


def receipts_to_bronze(extracted: DataFrame, run_id: str, seq_base: int = 0,
                       loaded_at: Column | None = None) -> DataFrame:
    """K-02 re-aimed: processed receipts go straight to bronze as document
    records (their payload JSON), skipping the one-file-per-document hop.

    Ignored and failed receipts produce no record, as before.
    """
    # the payload is built by the extractor: valid JSON with the key and the
    # metadata by construction, so no re-parse is needed to route it
    return extracted.filter(F.col("estado") == "procesado").select(
        _sequence(seq_base).alias("id_secuencial"),
        F.col("id_solicitud").alias("bk_id_solicitud"),
        F.col("payload").alias("datos_origen_raw"),
        F.lit(run_id).alias("via_airflow_run_id"),
        F.col("nombre_archivo").alias("nombre_archivo_fuente"),
        (loaded_at if loaded_at is not None else F.current_timestamp()).cast("timestamp_ntz").alias("fecha_ingestion"),
        F.lit(True).alias("es_documento"),
    )


def write_payloads(extracted: DataFrame, directory: str) -> None:
    """K-02 as files: processed payloads appended as JSON lines (one document
    per line; many per file), readable by the file stream with
    ``whole_file=False``.  One file per document, as the original wrote, does
    not scale to millions of receipts."""
    (extracted.filter(F.col("payload").isNotNull()).select(F.col("payload").alias("value"))
     .write.mode("append").text(directory))
