"""Receipt field extraction (X-21, X-24..X-28, F-07, F-10).

Input: one row per receipt image, ``nombre_archivo`` and the OCR ``texto``
(the OCR engine itself is outside the library).  Output: the extraction
status and the document payload that the bronze loader ingests.  All of it is
native column expressions: no Python per row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import extract_amount, id_prefix, is_numeric_id
from ..schemas import (CONFIDENCE_AMOUNT_FOUND, CONFIDENCE_AMOUNT_MISSING, DOC_METADATA_KEY,
                       RECEIPT_DOCUMENT_TYPE, RECEIPT_PAYLOAD_CONSTANTS)

STATUS_DONE = "procesado"
STATUS_IGNORED = "ignorado"   # file name without a numeric application id
STATUS_FAILED = "fallido"     # no text (unreadable image): stays in landing


def extract_receipts(images: DataFrame, strict: bool = False) -> DataFrame:
    app_id = id_prefix(F.col("nombre_archivo"))
    valid = is_numeric_id(app_id)
    amount = extract_amount(F.col("texto"), strict=strict)
    found = amount.isNotNull() & (amount != 0)
    status = (F.when(~valid, F.lit(STATUS_IGNORED))
              .when(F.col("texto").isNull(), F.lit(STATUS_FAILED))
              .otherwise(F.lit(STATUS_DONE)))
    ok = status == STATUS_DONE
    income = F.when(found, amount).otherwise(F.lit(0.0))
    conf = F.when(found, F.lit(CONFIDENCE_AMOUNT_FOUND)).otherwise(F.lit(CONFIDENCE_AMOUNT_MISSING))
    fields = [app_id.alias("SK_ID_CURR")]
    for k, v in RECEIPT_PAYLOAD_CONSTANTS.items():
        fields.append(F.lit(v).alias(k))
        if k == "AMT_CREDIT":
            fields.append(income.alias("AMT_INCOME_TOTAL"))
    fields.append(F.struct(F.lit(RECEIPT_DOCUMENT_TYPE).alias("document_type"),
                           conf.alias("confidence_score")).alias(DOC_METADATA_KEY))
    payload = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return images.select(
        "nombre_archivo",
        app_id.alias("id_solicitud"),
        status.alias("estado"),
        F.when(ok, income).alias("amt_income_total"),
        F.when(ok, conf).alias("confidence_score"),
        F.when(ok, F.lit(RECEIPT_DOCUMENT_TYPE)).alias("document_type"),
        F.when(ok, F.lit(RECEIPT_PAYLOAD_CONSTANTS["AMT_CREDIT"])).alias("amt_credit"),
        F.when(ok, payload).alias("payload"),
    )
