"""Date-part functions for the time dimension (X-17, X-19, X-20)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(d) -> Column:
    """A Python date / ISO string / Column as a DateType column."""
    if isinstance(d, Column):
        return d.cast("date")
    if d is None:
        return F.current_date()
    if isinstance(d, (_dt.date, _dt.datetime)):
        d = d.isoformat()[:10]
    return F.lit(d).cast("date")


def day_of_week_sunday0(d: Column) -> Column:
    """EXTRACT(DOW): Sunday = 0 ... Saturday = 6 (Spark's dayofweek is 1-based)."""
    return F.dayofweek(d) - 1


def date_parts(d: Column) -> list[Column]:
    """The time-dimension attributes of a date column."""
    return [
        d.alias("fecha"),
        F.year(d).alias("anio"),
        F.month(d).alias("mes"),
        F.quarter(d).alias("trimestre"),
        day_of_week_sunday0(d).alias("dia_semana"),
    ]
