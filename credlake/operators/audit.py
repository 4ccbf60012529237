"""Audit log rows (K-08, A-05, F-06)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import AUDIT, SILVER_MESSAGE, SILVER_TARGET, SILVER_TASK, STATUS_OK


def audit_entries(layer: DataFrame, run_ids: list[str], task: str = SILVER_TASK, target: str = SILVER_TARGET,
                  status: str = STATUS_OK, message: str = SILVER_MESSAGE) -> DataFrame:
    """One audit row per run id: rows of ``layer`` whose winning record came
    from that run (``COUNT(*) ... WHERE via_airflow_run_id = run``).

    All counts come from one aggregate pass over the layer.
    """
    counts = layer.agg(*[F.count_if(F.coalesce(F.col("via_airflow_run_id") == r, F.lit(False)))
                         .cast("int").alias(f"_c{i}") for i, r in enumerate(run_ids)])
    rows = F.array(*[F.struct(F.lit(r).alias("via_airflow_run_id"), F.col(f"_c{i}").alias("filas_procesadas"))
                     for i, r in enumerate(run_ids)])
    return counts.select(F.inline(rows)).select(
        "via_airflow_run_id",
        F.lit(task).alias("nombre_tarea"),
        F.lit(target).alias("capa_destino"),
        "filas_procesadas",
        F.lit(status).alias("estado_ejecucion"),
        F.lit(message).alias("mensaje_detalle"),
    )


def audit_entry(layer: DataFrame, run_id: str, **kw) -> DataFrame:
    """The original's single audit row for the current run."""
    return audit_entries(layer, [run_id], **kw)


def with_log_ids(log: DataFrame, entries: DataFrame, start: int) -> DataFrame:
    """Append-ready audit rows: ``log_id`` continues after ``start`` and the
    execution time is stamped.  ``entries`` holds one row per logged task
    (a handful per run), so a global ordering window is bounded."""
    w = Window.orderBy("via_airflow_run_id", "nombre_tarea")
    out = entries.select(
        (F.lit(int(start)) + F.row_number().over(w)).cast("int").alias("log_id"), "*",
        F.current_timestamp().cast("timestamp_ntz").alias("fecha_ejecucion"))
    return out.select(*[F.col(f.name).cast(f.dataType) for f in AUDIT.fields])


AUDIT_SQL = """
SELECT :run_id AS via_airflow_run_id,
       :task AS nombre_tarea,
       :target AS capa_destino,
       CAST((SELECT count(*) FROM IDENTIFIER(:layer) WHERE via_airflow_run_id = :run_id) AS INT) AS filas_procesadas,
       :status AS estado_ejecucion,
       :message AS mensaje_detalle
"""


def audit_entry_sql(spark, layer_view: str, run_id: str, task: str = SILVER_TASK, target: str = SILVER_TARGET,
                    status: str = STATUS_OK, message: str = SILVER_MESSAGE) -> DataFrame:
    """P-05 + A-05 in SQL: the run id is a bound parameter (never spliced
    into the text, so it cannot inject SQL) and the count is a scalar
    subquery over a registered view."""
    return spark.sql(AUDIT_SQL, args={"run_id": run_id, "task": task, "target": target, "status": status,
                                      "message": message, "layer": layer_view})
