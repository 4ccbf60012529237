"""Gold star builders (G-01..G-05).

Each builder takes the current dimension/fact content and returns the new
content; dimensions must be committed before the fact reads them so the fact
carries the keys that were stored (FK order).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import as_date, date_parts
from ..operators.upsert import insert_ignore, upsert
from ..schemas import (CLIENT_ATTRS, DIM_CLIENTE, DIM_PRODUCTO, DIM_PROXY, DIM_TIEMPO, FACT, FACT_MEASURES,
                       LEGACY_CONFIDENCE, LEGACY_DOC_TYPE, PROXY_DEFAULT_MANUAL_FLAG, PROXY_DEFAULT_SK)


def empty(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema)


def build_dim_producto(silver: DataFrame, dim: DataFrame, run_id: str, now: Column | None = None) -> DataFrame:
    """G-01: distinct non-null product names, insert-ignore on the name."""
    src = (silver.filter(F.col("name_contract_type").isNotNull())
           .select(F.col("name_contract_type").alias("nombre_producto"))
           .distinct()
           .withColumn("via_airflow_run_id", F.lit(run_id)))
    return insert_ignore(dim, src, ["nombre_producto"], sk_col="sk_producto", touch_cols=["fecha_carga"], now=now)


def build_dim_cliente(silver: DataFrame, dim: DataFrame, run_id: str, now: Column | None = None,
                      start: int | None = None) -> DataFrame:
    """G-02: SCD-1 on the application id; the surrogate key never changes.

    The original selects DISTINCT over these columns; silver's key is
    unique, so the rows are already distinct and no aggregation is planned.
    """
    src = silver.select("bk_id_solicitud", *CLIENT_ATTRS).withColumn("via_airflow_run_id", F.lit(run_id))
    return upsert(dim, src, ["bk_id_solicitud"], update_cols=[*CLIENT_ATTRS, "via_airflow_run_id"],
                  touch_cols=["fecha_carga"], sk_col="sk_cliente", now=now, start=start)


def build_dim_proxy(spark: SparkSession, dim: DataFrame, run_id: str, now: Column | None = None) -> DataFrame:
    """G-03: the default document-proxy row (key 1); on conflict only its
    document type is refreshed (run id, confidence and load time stay)."""
    src = spark.createDataFrame(
        [(PROXY_DEFAULT_SK, LEGACY_DOC_TYPE, PROXY_DEFAULT_MANUAL_FLAG, run_id)],
        "sk_proxy_documental int, tipo_documento_origen string, flag_verificacion_manual boolean, "
        "via_airflow_run_id string",
    ).withColumn("nivel_confianza_extraccion", F.lit(LEGACY_CONFIDENCE).cast("decimal(5,2)"))
    return upsert(dim, src, ["sk_proxy_documental"], update_cols=["tipo_documento_origen"],
                  stamp_cols=["fecha_carga"], now=now)


def build_dim_tiempo(dates: DataFrame, dim: DataFrame) -> DataFrame:
    """G-04: one row per date (insert-ignore on ``fecha``).

    ``dates`` has one column of dates; the original inserts CURRENT_DATE
    only, see ``today``.
    """
    d = dates.select(F.col(dates.columns[0]).cast("date").alias("_d")).distinct()
    src = d.select(*date_parts(F.col("_d")))
    return insert_ignore(dim, src, ["fecha"], sk_col="sk_tiempo")


def today(spark: SparkSession, as_of=None) -> DataFrame:
    """The evaluation date as a one-row frame (S-08; CURRENT_DATE by default)."""
    return spark.range(1).select(as_date(as_of).alias("fecha"))


def fact_source(silver: DataFrame, dim_cliente: DataFrame, dim_producto: DataFrame, dim_tiempo: DataFrame,
                as_of, run_id: str) -> DataFrame:
    """J-02..J-04 + P-11: silver rows resolved to their dimension keys.

    * client: inner equi-join on the application id (large-large, planned by
      AQE as sort-merge or shuffled hash);
    * product: inner join on the name; rows without a product are dropped;
      the dimension is tiny in practice and AQE broadcasts it by its
      measured size;
    * time: the evaluation date's row.  ``fecha`` is unique, so it is one
      key value, read as a scalar (a join on a constant would plan as a
      nested loop); a missing date yields zero fact rows, as in the original.
    """
    d = as_date(as_of)
    # the evaluation date's key: one value (fecha is unique), or none
    row = dim_tiempo.filter(F.col("fecha") == d).select("sk_tiempo").limit(1).first()
    c = dim_cliente.select("bk_id_solicitud", "sk_cliente")
    p = dim_producto.select(F.col("nombre_producto").alias("name_contract_type"), "sk_producto")
    s = silver.select("bk_id_solicitud", "name_contract_type", *FACT_MEASURES)
    if row is None:
        s = s.filter(F.lit(False))   # date row missing: zero fact rows
    j = (s.join(c, "bk_id_solicitud", "inner")
         .join(p, "name_contract_type", "inner")
         .withColumn("sk_tiempo", F.lit(row["sk_tiempo"] if row is not None else None).cast("int")))
    return j.select(
        F.col("bk_id_solicitud").alias("dd_id_solicitud"), "sk_cliente", "sk_producto", "sk_tiempo",
        F.lit(PROXY_DEFAULT_SK).alias("sk_proxy_documental"), *FACT_MEASURES,
        F.lit(run_id).alias("via_airflow_run_id"))


def build_fact(silver: DataFrame, dim_cliente: DataFrame, dim_producto: DataFrame, dim_tiempo: DataFrame,
               fact: DataFrame, as_of, run_id: str, now: Column | None = None, start: int | None = None) -> DataFrame:
    """G-05 + K-06: partial upsert on the degenerate id.

    An existing fact row gets the new time key, measures, ratios, target
    and run id; its client, product and proxy keys are never re-pointed.
    """
    src = fact_source(silver, dim_cliente, dim_producto, dim_tiempo, as_of, run_id)
    return upsert(fact, src, ["dd_id_solicitud"],
                  update_cols=["sk_tiempo", *FACT_MEASURES, "via_airflow_run_id"],
                  touch_cols=["fecha_carga"], sk_col="sk_fact", now=now, start=start)


GOLD_SCHEMAS = {
    "gold.dim_tiempo": DIM_TIEMPO,
    "gold.dim_producto": DIM_PRODUCTO,
    "gold.dim_proxy_documental": DIM_PROXY,
    "gold.dim_cliente": DIM_CLIENTE,
    "gold.fact_creditos": FACT,
}
