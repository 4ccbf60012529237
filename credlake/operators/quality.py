"""Data-quality and integrity operators (Q-01..Q-08, A-04).

Every check is a distributed aggregate returning a small DataFrame; only the
final one-row verdict reaches the driver (``enforce``).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import (FOREIGN_KEYS, NOT_NULL_COLUMNS, PRIMARY_KEYS, SENTINEL_DAYS_EMPLOYED, UNIQUE_COLUMNS,
                       VARCHAR_LIMITS)


class QualityGateError(RuntimeError):
    """A gate rule failed; downstream layers must not load."""


class ConstraintError(RuntimeError):
    """A table's rows violate its declared constraints; the version is not committed."""


def _count_if(cond: Column) -> Column:
    return F.count_if(F.coalesce(cond, F.lit(False)))


def silver_gate(silver: DataFrame) -> DataFrame:
    """Q-01..Q-04 in one pass: counts and the three booleans of the gate.

    An empty silver passes (every count is 0).
    """
    agg = silver.agg(
        _count_if(F.col("days_employed") == SENTINEL_DAYS_EMPLOYED).alias("n_outliers_empleo"),
        _count_if(F.col("bk_id_solicitud").isNull()).alias("n_pk_nula"),
        _count_if(F.col("credit_to_income_ratio") < 0).alias("n_ratio_negativo"),
    )
    return agg.select(
        "n_outliers_empleo", "n_pk_nula", "n_ratio_negativo",
        (F.col("n_outliers_empleo") == 0).alias("check_outliers_empleo"),
        (F.col("n_pk_nula") == 0).alias("check_pk_nula"),
        (F.col("n_ratio_negativo") == 0).alias("check_ratio_valido"),
    )


def enforce(report: DataFrame, prefix: str = "check_") -> dict:
    """Q-04: fetch the one-row report and raise if any ``check_*`` is false."""
    row = report.first()
    values = row.asDict() if row is not None else {}
    failed = [k for k, v in values.items() if k.startswith(prefix) and v is not True]
    if failed:
        raise QualityGateError(f"quality gate failed: {failed} ({values})")
    return values


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> Column | DataFrame:
    """Q-05: child rows whose foreign key has no parent (NULL keys are not orphans)."""
    pk = parent_key or key
    c = child.select(F.col(key).alias("_k")).filter(F.col("_k").isNotNull())
    p = parent.select(F.col(pk).alias("_k"))
    return c.join(p, "_k", "left_anti")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Q-06: key values that occur more than once, with their extra count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") > 1).select(*keys, (F.col("_n") - 1).alias("extra")))


def null_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    """Q-07: rows violating NOT NULL on any of ``cols``."""
    cond = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
    return df.filter(cond)


def varchar_violations(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Q-08: one-row count of values longer than their declared VARCHAR(n)."""
    return df.agg(*[_count_if(F.length(F.col(c)) > n).alias(f"largo_excedido_{c}") for c, n in limits.items()])


def row_rules(table: str) -> dict[str, Column]:
    """Q-07, Q-08: the constraints a row can break by itself, as conditions."""
    rules = {f"nulo_{c}": F.col(c).isNull() for c in [PRIMARY_KEYS[table], *NOT_NULL_COLUMNS.get(table, [])]}
    return rules | {f"largo_{c}": F.length(F.col(c)) > n for c, n in VARCHAR_LIMITS.get(table, {}).items()}


def row_violations(df: DataFrame, table: str) -> DataFrame:
    """(regla, filas) of the row rules, counted in one pass."""
    rules = row_rules(table)
    once = df.agg(*[_count_if(cond).alias(rule) for rule, cond in rules.items()])
    return once.select(F.inline(F.array(*[
        F.struct(F.lit(rule).alias("regla"), F.col(rule).cast("long").alias("filas")) for rule in rules])))


def key_violations(df: DataFrame, table: str, read: Callable[[str], DataFrame]) -> DataFrame:
    """(regla, filas) of unique columns (one aggregation of the column each) and foreign keys (one anti
    join of the column with the parent's key each); NULLs violate neither."""
    parts = []
    for c in [PRIMARY_KEYS[table], *UNIQUE_COLUMNS.get(table, [])]:
        extra = extra_of(duplicate_keys(df.filter(F.col(c).isNotNull()), [c]))
        parts.append(extra.select(F.lit(f"duplicado_{c}").alias("regla"), F.col("n").cast("long").alias("filas")))
    for c, parent in FOREIGN_KEYS.get(table, {}).items():
        lost = count_of(orphans(df, read(parent), c, PRIMARY_KEYS[parent]))
        parts.append(lost.select(F.lit(f"huerfano_{c}").alias("regla"), F.col("n").alias("filas")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def violations(df: DataFrame, table: str, read: Callable[[str], DataFrame]) -> DataFrame:
    """Q-05..Q-08 for one table: a row (regla, filas) per declared constraint."""
    return row_violations(df, table).unionByName(key_violations(df, table, read))


class Constraints:
    """A table's constraints, as the original's inserts enforce them.

    ``TableStore.overwrite`` observes the row rules while it writes a version
    and reads back only what uniqueness and foreign keys need.  Calling it
    checks a frame that is not written by the store.
    """

    def __init__(self, table: str, read: Callable[[str], DataFrame]):
        self.table, self.read = table, read

    def metrics(self) -> list[Column]:
        return [_count_if(cond).alias(rule) for rule, cond in row_rules(self.table).items()]

    def enforce(self, counts: dict[str, int]) -> None:
        failed = {rule: n for rule, n in counts.items() if n}
        if failed:
            raise ConstraintError(f"{self.table}: " + ", ".join(f"{rule} ({n})" for rule, n in failed.items()))

    def check_keys(self, df: DataFrame) -> None:
        self._check(key_violations(df, self.table, self.read))

    def __call__(self, df: DataFrame) -> None:
        self._check(violations(df, self.table, self.read))

    def _check(self, found: DataFrame) -> None:
        self.enforce({r["regla"]: r["filas"] for r in found.filter(F.col("filas") > 0).collect()})  # a row per rule


def constraint_check(table: str, read: Callable[[str], DataFrame]) -> Constraints:
    return Constraints(table, read)


def metrics_row(metrics: dict[str, DataFrame]) -> DataFrame:
    """Fold several one-value frames into one row (no cross join).

    Each frame has one numeric column; the frames are stacked as
    (name, value) rows and pivoted back with a global aggregate.
    """
    parts = [df.select(F.lit(name).alias("_m"), F.col(df.columns[0]).cast("long").alias("_v"))
             for name, df in metrics.items()]
    stacked = reduce(lambda a, b: a.unionByName(b), parts)
    return stacked.agg(*[F.coalesce(F.max(F.when(F.col("_m") == n, F.col("_v"))), F.lit(0)).alias(n)
                         for n in metrics])


def count_of(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def extra_of(dups: DataFrame) -> DataFrame:
    return dups.agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("n"))


def star_integrity(silver: DataFrame, dim_cliente: DataFrame, dim_producto: DataFrame, dim_proxy: DataFrame,
                   dim_tiempo: DataFrame, fact: DataFrame) -> DataFrame:
    """Q-05..Q-07 over a star: orphan FKs, duplicate keys, NULL keys (all 0 when sound)."""
    return metrics_row({
        "huerfanos_cliente": count_of(orphans(fact, dim_cliente, "sk_cliente")),
        "huerfanos_producto": count_of(orphans(fact, dim_producto, "sk_producto")),
        "huerfanos_tiempo": count_of(orphans(fact, dim_tiempo, "sk_tiempo")),
        "huerfanos_proxy": count_of(orphans(fact, dim_proxy, "sk_proxy_documental")),
        "duplicados_silver": extra_of(duplicate_keys(silver, ["bk_id_solicitud"])),
        "duplicados_cliente": extra_of(duplicate_keys(dim_cliente, ["bk_id_solicitud"])),
        "duplicados_fact": extra_of(duplicate_keys(fact, ["dd_id_solicitud"])),
        "duplicados_sk_cliente": extra_of(duplicate_keys(dim_cliente, ["sk_cliente"])),
        "nulos_pk": count_of(null_rows(silver, ["bk_id_solicitud"])),
    })


def integrity_gate(report: DataFrame) -> DataFrame:
    """Turn an integrity report into ``check_*`` booleans for ``enforce``."""
    return report.select("*", *[(F.col(c) == 0).alias(f"check_{c}") for c in report.columns])
