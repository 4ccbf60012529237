"""Semantic risk view (G-06, J-05, P-09, K-13)."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import VIEW_COLUMNS
from ..sources.files import _hadoop_path

VIEW_NAME = "vw_analisis_riesgo_crediticio"
# which table each published column comes from (the rest: the client dimension)
_VIEW_SOURCE = {
    "dd_id_solicitud": "f", "amt_credit": "f", "amt_income_total": "f", "amt_annuity": "f",
    "credit_to_income_ratio": "f", "annuity_income_ratio": "f", "target": "f",
    "nombre_producto": "p", "tipo_documento_origen": "pd", "nivel_confianza_extraccion": "pd", "fecha": "t",
}
VIEW_TABLES = {"f": "gold.fact_creditos", "c": "gold.dim_cliente", "p": "gold.dim_producto",
               "pd": "gold.dim_proxy_documental", "t": "gold.dim_tiempo"}
GOLD_VIEWS = {"f": "gold_fact_creditos", "c": "gold_dim_cliente", "p": "gold_dim_producto",
              "pd": "gold_dim_proxy_documental", "t": "gold_dim_tiempo"}


def risk_view(fact: DataFrame, dim_cliente: DataFrame, dim_producto: DataFrame, dim_proxy: DataFrame,
              dim_tiempo: DataFrame) -> DataFrame:
    """Fact joined to its four dimensions, columns renamed for BI.

    The client join is large-large (AQE: sort-merge, skew split); product,
    proxy and time are small and broadcast by AQE from their measured sizes.
    Catalyst does not drop unused inner joins, so a report that needs only
    fact columns should read the fact directly.
    """
    f = fact.alias("f")
    c = dim_cliente.alias("c")
    p = dim_producto.alias("p")
    pd_ = dim_proxy.alias("pd")
    t = dim_tiempo.alias("t")
    j = (f.join(c, F.col("f.sk_cliente") == F.col("c.sk_cliente"), "inner")
         .join(p, F.col("f.sk_producto") == F.col("p.sk_producto"), "inner")
         .join(pd_, F.col("f.sk_proxy_documental") == F.col("pd.sk_proxy_documental"), "inner")
         .join(t, F.col("f.sk_tiempo") == F.col("t.sk_tiempo"), "inner"))
    return j.select(*[F.col(f"{_VIEW_SOURCE.get(src, 'c')}.{src}").alias(name) for src, name in VIEW_COLUMNS])


def publish_view(spark: SparkSession, tables: dict[str, str], name: str = VIEW_NAME) -> None:
    """K-13: a catalog view over the given relations (keys as in
    ``GOLD_VIEWS``), bound anew to the version folders by every load.

    Every session of the catalog sees it; with a metastore it outlives the
    application.
    """
    spark.sql(view_sql(name, tables, kind="VIEW"))


# published beside the gold tables, dealt by the key they are joined on
BUCKETED = {"f": "sk_cliente", "c": "sk_cliente"}


def publish_bucketed_view(spark: SparkSession, tables: dict[str, str], root: str, buckets: int, name: str = VIEW_NAME) -> None:
    """J-05 for many reports over one load: fact and client dimension as catalog tables, bucketed and
    sorted by the client key (one shuffle each, once), so that no report shuffles them to join them.

    The tables are named after the view and the load; those of the load before
    stay for its readers, older ones are dropped with their files.
    """
    made = sorted(t.name for t in spark.catalog.listTables() if re.fullmatch(rf"{re.escape(name.lower())}_[0-9]+_[fc]", t.name))
    n = 1 + max((int(t.split("_")[-2]) for t in made), default=0)
    relations = dict(tables)
    for k, key in BUCKETED.items():
        table, path = f"{name}_{n}_{k}".lower(), f"{root}/{name}/{uuid.uuid4().hex[:12]}/{k}"
        (spark.sql(f"SELECT * FROM {tables[k]}").repartition(buckets, key).write.option("path", path)
         .bucketBy(buckets, key).sortBy(key).saveAsTable(table))
        relations[k] = table
    spark.sql(view_sql(name, relations, kind="VIEW"))
    for t in made:
        if int(t.split("_")[-2]) < n - 1:
            location = spark.sql(f"DESCRIBE FORMATTED {t}").where("col_name = 'Location'").first()["data_type"]
            spark.sql(f"DROP TABLE {t}")
            p, fs = _hadoop_path(spark, location)
            fs.delete(p, True)


def view_sql(name: str = VIEW_NAME, tables: dict[str, str] | None = None, kind: str = "TEMP VIEW") -> str:
    """K-13 as a statement: the same star join over registered gold views or other relations."""
    cols = ",\n    ".join(f"{_VIEW_SOURCE.get(src, 'c')}.{src} AS {pub}" for src, pub in VIEW_COLUMNS)
    v = tables or GOLD_VIEWS
    return (f"CREATE OR REPLACE {kind} {name} AS\nSELECT\n    {cols}\n"
            f"FROM {v['f']} f\n"
            f"JOIN {v['c']} c ON f.sk_cliente = c.sk_cliente\n"
            f"JOIN {v['p']} p ON f.sk_producto = p.sk_producto\n"
            f"JOIN {v['pd']} pd ON f.sk_proxy_documental = pd.sk_proxy_documental\n"
            f"JOIN {v['t']} t ON f.sk_tiempo = t.sk_tiempo")


def publish_view_sql(spark: SparkSession, fact: DataFrame, dim_cliente: DataFrame, dim_producto: DataFrame,
                     dim_proxy: DataFrame, dim_tiempo: DataFrame, name: str = VIEW_NAME) -> DataFrame:
    """Register the gold tables and publish the view with SQL."""
    for alias, df in zip(["f", "c", "p", "pd", "t"], [fact, dim_cliente, dim_producto, dim_proxy, dim_tiempo]):
        df.createOrReplaceTempView(GOLD_VIEWS[alias])
    spark.sql(view_sql(name))
    return spark.table(name)
