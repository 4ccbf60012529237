"""Adapters from the driver's test tables to the pipeline's input shapes.

The driver ships TPC-H-like tables, not loan applications.  These adapters
derive application records, extracted-document payloads, receipt texts and a
file manifest from them with plain column expressions, so every query reads
the given tables and its work grows with them.  The mapping is documented in
FIXTURES.md section 4; the DuckDB oracle applies the same mapping to the raw
columns.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.bronze import pack_bronze
from ..schemas import CSV_FILE_NAME, DOC_METADATA_KEY
from ..session import spread

# Split point between the "previous" and the "current" load in upsert tests.
UPSERT_SPLIT = "1997-01-01"
# Evaluation dates used in place of CURRENT_DATE so results are reproducible.
AS_OF_PREVIOUS = _dt.date(1998, 8, 2)
AS_OF_CURRENT = _dt.date(2001, 8, 2)
DOC_SEQ_BASE = 1_000_000_000
# Application ids are customer keys times this, so they spread over several key
# ranges of 65,536 even in the small tables.
ID_STEP = 97


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; a single-row-group file is spread over the cores so
    the per-row JSON work that follows runs in parallel."""
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def application_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Historical application records, one per order (about 10 per customer).

    Payload columns carry the source CSV's header names; ``_seq``, ``_ts``
    and ``_run`` carry lineage.  ``customer`` is a dimension keyed by
    ``c_custkey``; the join is planned by size (AQE).  Incomes are scaled by
    100 so every credit/income ratio fits NUMERIC(10,4), as real incomes
    would; raw balances of a few cents would overflow it.
    """
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    return j.selectExpr(
        f"CAST(o_custkey * {ID_STEP} AS STRING) AS SK_ID_CURR",
        "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS TARGET",
        "CASE WHEN o_orderkey % 11 != 0 THEN o_orderpriority END AS NAME_CONTRACT_TYPE",
        "o_orderstatus AS CODE_GENDER",
        "o_totalprice AS AMT_CREDIT",
        "c_acctbal * 100 AS AMT_INCOME_TOTAL",
        "CASE WHEN o_orderkey % 13 != 0 THEN CAST(c_nationkey * 100 + 850 AS DOUBLE) END AS AMT_ANNUITY",
        "CAST(CASE WHEN o_orderkey % 7 = 0 THEN 365243 ELSE -(o_orderkey % 15000) END AS BIGINT) AS DAYS_EMPLOYED",
        "c_mktsegment AS NAME_EDUCATION_TYPE",
        "o_orderpriority AS NAME_FAMILY_STATUS",
        "o_orderkey % 4 AS CNT_CHILDREN",
        "-(7000 + o_orderkey % 18000) AS DAYS_BIRTH",
        "repeat(c_name, 4) AS ORGANIZATION_TYPE",
        "c_nationkey % 3 + 1 AS REGION_RATING_CLIENT_W_CITY",
        "o_orderkey % 2 AS REG_CITY_NOT_WORK_CITY",
        "CAST(-(o_orderkey % 9000) AS DOUBLE) AS DAYS_REGISTRATION",
        "o_orderkey AS _seq",
        "o_orderdate AS _ts",
        "concat('run_', CAST(o_orderkey % 3 AS STRING)) AS _run",
    )


def document_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracted-document payloads, one per event.

    An ``error`` event stands for a failed extraction: income 0.0.
    """
    e = table(spark, sf_dir, "events")
    return e.selectExpr(
        f"CAST(user_id * {20 * ID_STEP} AS STRING) AS SK_ID_CURR",
        "CASE WHEN event_type = 'error' THEN 0.0D ELSE value * 100 END AS AMT_INCOME_TOTAL",
        f"named_struct('document_type', event_type, 'confidence_score', "
        f"CAST(get_json_object(props, '$.k') AS DOUBLE)) AS {DOC_METADATA_KEY}",
        f"{DOC_SEQ_BASE} + event_id AS _seq",
        "ts AS _ts",
        "'run_idp' AS _run",
        "concat('idp_boleta_', CAST(event_id AS STRING), '.json') AS _file",
    )


def bronze_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = application_rows(spark, sf_dir)
    return pack_bronze(a, run_id=F.col("_run"), source_file=CSV_FILE_NAME, loaded_at=F.col("_ts"),
                       sequence=F.col("_seq"), document=False)


def bronze_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = document_rows(spark, sf_dir)
    return pack_bronze(d, run_id=F.col("_run"), source_file=F.col("_file"), loaded_at=F.col("_ts"),
                       sequence=F.col("_seq"), document=True)


def bronze_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_base(spark, sf_dir).unionByName(bronze_documents(spark, sf_dir))


def bronze_split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(previous load, current load): base records before / from UPSERT_SPLIT;
    all documents belong to the current load."""
    b = bronze_base(spark, sf_dir)
    split = F.lit(UPSERT_SPLIT).cast("timestamp_ntz")
    prev = b.filter(F.col("fecha_ingestion") < split)
    cur = b.filter(F.col("fecha_ingestion") >= split).unionByName(bronze_documents(spark, sf_dir))
    return prev, cur


def bronze_one_range(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(previous load, current load): the current one holds the base records from UPSERT_SPLIT and the
    documents of the applications in the second key range, the previous one the rest."""
    b, d = bronze_base(spark, sf_dir), bronze_documents(spark, sf_dir)
    mine = F.floor(F.col("bk_id_solicitud").cast("long") / 65536) == 1
    late = F.col("fecha_ingestion") >= F.lit(UPSERT_SPLIT).cast("timestamp_ntz")
    return b.filter(~(mine & late)).unionByName(d.filter(~mine)), b.filter(mine & late).unionByName(d.filter(mine))


def receipt_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receipt images as (file name, OCR text), one per order.

    Every 17th name has a non-numeric prefix; texts rotate between no
    amount, a lower-case label with an ungrouped amount, and the label, two
    line breaks, a grouped amount and a decoy.
    """
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    k = F.col("o_orderkey")
    name = F.concat(F.when(k % 17 == 0, F.lit("x")).otherwise(k.cast("string")), F.lit("_boleta.jpg"))
    amount_plain = F.format_string("%.2f", F.col("o_totalprice"))
    text = (F.when(k % 5 == 0, F.concat(F.lit("BOLETA DE PAGO\nTOTAL HABERES\nsin monto "), k.cast("string")))
            .when(k % 5 == 1, F.concat(F.lit("boleta\nneto a pagar s/ "), amount_plain))
            .otherwise(F.concat(F.lit("BOLETA\nNETO A PAGAR S/\n\n"), F.format_number(F.col("o_totalprice"), 2),
                                F.lit(" ref 1.00"))))
    return o.select(name.alias("nombre_archivo"), text.alias("texto"), k.alias("_seq"))


def manifest(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(candidate files, files pending in raw, files already archived).

    One candidate per document; English documents are pending, French ones
    archived; the rest are new.
    """
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    name = F.concat(F.col("source"), F.lit("/doc_"), F.col("doc_id").cast("string"), F.lit(".json"))
    cand = d.select(name.alias("nombre_archivo"), "source", "lang")
    pending = cand.filter(F.col("lang") == "en").select("nombre_archivo")
    archived = cand.filter(F.col("lang") == "fr").select("nombre_archivo")
    return cand.select("nombre_archivo", "source"), pending, archived
