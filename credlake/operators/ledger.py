"""Ingest-once checks (K-10, J-08).

A file is skipped when it is already waiting in the raw zone (pending) or
already archived (done).  Both listings are DataFrames of file names, so
the check is one anti join and scales with the number of files.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import INGEST_LEDGER
from .keys import max_key

_ROWS_PER_TASK = 1 << 33  # monotonically_increasing_id: partition << 33 | row


def not_yet_ingested(candidates: DataFrame, *seen: DataFrame, on: tuple[str, ...] = ("nombre_archivo",)) -> DataFrame:
    """``candidates`` whose ``on`` columns (the name, or a file's identity) occur in no listing."""
    if not seen:
        return candidates
    known = reduce(lambda a, b: a.unionByName(b), [s.select(*[F.col(c) for c in on]) for s in seen])
    return candidates.join(known, list(on), "left_anti")


def ledger_entry(df: DataFrame, run_id: str) -> DataFrame:
    """Ledger rows from a frame with some of the ledger's columns; the rest is NULL or the run's."""
    given = {"via_airflow_run_id": F.lit(run_id), "fecha_carga": F.current_timestamp()}
    return df.select(*[(F.col(f.name) if f.name in df.columns else given.get(f.name, F.lit(None)))
                       .cast(f.dataType).alias(f.name) for f in INGEST_LEDGER.fields])


def next_sequence(ledger: DataFrame, bronze: DataFrame) -> int:
    """The first bronze sequence number that no load has used or reserved: the
    ledger's high-water mark, one column of one row per load and file.  Bronze
    is read only where it was filled before the ledger carried marks."""
    mark = ledger.agg(F.max("marca").alias("m")).first()["m"]
    return (max_key(bronze, "id_secuencial") if mark is None else int(mark)) + 1


def reservation(df: DataFrame, run_id: str, base: int) -> DataFrame:
    """The ledger row to append before ``df`` (numbered from ``base`` by scan position) is written."""
    mark = base + df.rdd.getNumPartitions() * _ROWS_PER_TASK - 1
    row = df.sparkSession.range(1).select(F.lit(f"reserva:{run_id}").alias("nombre_archivo"), F.lit(mark).alias("marca"))
    return ledger_entry(row, run_id)
