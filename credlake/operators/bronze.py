"""Bronze record packing (P-01..P-04, K-01 shape).

A source row becomes one append-only bronze record: the whole row as a JSON
object (nulls kept as JSON null), the business key promoted to a text column,
and lineage (run id, source file, load time).  Bronze stays schema-on-read:
new source columns never break ingestion.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.payload import is_document
from ..schemas import BRONZE, BUSINESS_KEY_FIELD, DEFAULT_RUN_ID

NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
             "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
"""Text a pandas CSV reader turns into a missing value (``XNA`` stays data)."""


def na_to_null(df: DataFrame, columns: list[str] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """P-02: NaN -> NULL for string columns read from CSV."""
    cols = columns if columns is not None else [f.name for f in df.schema.fields
                                                if f.dataType.simpleString() == "string"]
    return df.select(*[
        (F.when(~F.col(c).isin(NA_TOKENS), F.col(c)).alias(c) if c in cols and c not in keep else F.col(c))
        for c in df.columns])


def row_to_json(columns: list[str]) -> Column:
    """P-01: whole row -> JSON object, JSON null for SQL NULL."""
    return F.to_json(F.struct(*[F.col(c) for c in columns]), {"ignoreNullFields": "false"})


def pack_bronze(df: DataFrame, *, run_id: str | Column | None = None, source_file: str | Column | None = None,
                loaded_at: Column | None = None, sequence: Column | None = None,
                payload_columns: list[str] | None = None, key_field: str = BUSINESS_KEY_FIELD,
                document: bool | None = None) -> DataFrame:
    """Pack source rows into the bronze schema.

    ``payload_columns`` defaults to every column that does not start with
    ``_`` (underscore columns carry lineage from adapters).  ``sequence`` is
    the within-load tie-break; by default the scan position
    (``monotonically_increasing_id``), which is unique and follows file
    order inside each split.
    """
    payload_cols = payload_columns or [c for c in df.columns if not c.startswith("_")]
    run = run_id if isinstance(run_id, Column) else F.lit(run_id or DEFAULT_RUN_ID)
    src = source_file if isinstance(source_file, Column) else F.lit(source_file)
    payload = row_to_json(payload_cols)
    if document is None:
        doc_flag = is_document(payload)
    else:
        doc_flag = F.lit(bool(document))
    out = df.select(
        (sequence if sequence is not None else F.monotonically_increasing_id()).cast("long").alias("id_secuencial"),
        F.col(key_field).cast("string").alias("bk_id_solicitud"),
        payload.alias("datos_origen_raw"),
        run.cast("string").alias("via_airflow_run_id"),
        src.cast("string").alias("nombre_archivo_fuente"),
        (loaded_at if loaded_at is not None else F.current_timestamp()).cast("timestamp_ntz").alias("fecha_ingestion"),
        doc_flag.alias("es_documento"),
    )
    return out.select(*[F.col(f.name) for f in BRONZE.fields])
