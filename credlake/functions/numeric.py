"""Exact-decimal feature arithmetic (X-03..X-16).

Everything stays in DecimalType so results are exact and JVM-side: text is
cast straight to the target NUMERIC type (half-up), divisions are decimal
divisions and ``round`` on decimals rounds half away from zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import DAYS_PER_YEAR, SENTINEL_DAYS_EMPLOYED

# An unbounded NUMERIC read from text.  Never plain "decimal": Spark reads
# that as decimal(10,0) and would round the days away.
WIDE_DECIMAL = "decimal(20,6)"


def _neg_year() -> Column:
    return F.lit(f"-{DAYS_PER_YEAR}").cast("decimal(6,2)")


def to_smallint(c: Column) -> Column:
    return c.cast("smallint")


def to_int(c: Column) -> Column:
    return c.cast("int")


def to_money(c: Column) -> Column:
    """Text -> NUMERIC(12,2), half-up; overflow raises under ANSI."""
    return c.cast("decimal(12,2)")


def to_pct(c: Column) -> Column:
    """Text -> NUMERIC(5,2)."""
    return c.cast("decimal(5,2)")


def days_to_years_floor(days_text: Column) -> Column:
    """FLOOR(days / -365.25) as SMALLINT, stored as NUMERIC(5,1) (age)."""
    q = days_text.cast(WIDE_DECIMAL) / _neg_year()
    return F.floor(q).cast("smallint").cast("decimal(5,1)")


def days_to_years_round1(days_text: Column) -> Column:
    """ROUND(days / -365.25, 1) as NUMERIC(5,1) (tenure, residence)."""
    q = days_text.cast(WIDE_DECIMAL) / _neg_year()
    return F.round(q, 1).cast("decimal(5,1)")


def sentinel_to_null(days: Column) -> Column:
    """DAYS_EMPLOYED with the 'not employed' sentinel turned into NULL."""
    return F.nullif(days, F.lit(SENTINEL_DAYS_EMPLOYED))


def tenure_years(days_text: Column) -> Column:
    """0 for the sentinel, else days in years rounded to one decimal.

    A NULL DAYS_EMPLOYED falls to the ELSE branch and stays NULL.
    """
    return (F.when(days_text.cast("int") == SENTINEL_DAYS_EMPLOYED, F.lit(0).cast("decimal(5,1)"))
            .otherwise(days_to_years_round1(days_text)))


def guarded_ratio(num: Column, den: Column) -> Column:
    """ROUND(num / den, 4) as NUMERIC(10,4) when den > 0, else NULL.

    The guard is required: under ANSI a division by zero raises.
    decimal(12,2) / decimal(12,2) is decimal(27,15); rounding to 4 places
    is half away from zero.
    """
    return F.when(den > 0, F.round(num / den, 4).cast("decimal(10,4)"))
