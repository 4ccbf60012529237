"""Surrogate-key assignment at scale (G-09).

Keys are dense and deterministic: ``start + position`` in business-key order.
A global ``row_number()`` over an unpartitioned window would pull every row
into one task, so two distributed plans are used instead.

Integer and date keys (``bk_id_solicitud``, ``dd_id_solicitud``, ``fecha``):
fixed-width range buckets.  ``bucket = floor(key / WIDTH)`` is monotone in the
key, so ordering by (bucket, key) *is* key order.  Keys are unique, so a
bucket holds at most WIDTH rows (a bounded task, whatever the skew of the
data elsewhere), and the per-bucket counts table has at most
``key range / WIDTH`` rows (65,536 for 32-bit keys), a proven bound for its
broadcast.  Key = start + rows in earlier buckets + ``row_number()`` inside
the bucket.  Everything stays lazy and deterministic: no sampling, no
checkpoint, recomputation after an executor loss yields the same keys.

Other key types (product names): up to WIDTH rows are numbered in one bounded
task.  More are range-partitioned by the key, WIDTH rows a partition on
average; each row's partition id and position inside its sorted partition are
recorded as columns and stored (``materialize``, a written table in the shared
folder) so the counts and the keys see the same layout; count rows per
partition (one row per partition), broadcast the running offsets, key = offset
+ position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

BUCKET_WIDTH = 1 << 16
_PID_SHIFT = 1 << 33  # monotonically_increasing_id = partition id << 33 | row index


def bucketable(df: DataFrame, order_cols: list[str]) -> bool:
    """One column whose ranges of BUCKET_WIDTH are at most 65,536: 32-bit integers and dates."""
    if len(order_cols) != 1:
        return False
    t = df.schema[order_cols[0]].dataType
    return isinstance(t, (T.IntegerType, T.ShortType, T.ByteType, T.DateType))


def _as_long(df: DataFrame, col: str) -> Column:
    c = F.col(col)
    if isinstance(df.schema[col].dataType, T.DateType):
        return F.unix_date(c).cast("long")
    return c.cast("long")


def key_bucket(df: DataFrame, key: str, width: int = BUCKET_WIDTH) -> Column:
    """The range of a key, monotone in it."""
    return F.floor(_as_long(df, key) / F.lit(width))


def assign_keys_by_bucket(df: DataFrame, sk_col: str, key: str, start: int = 0, key_type: str = "int",
                          width: int = BUCKET_WIDTH) -> DataFrame:
    with_b = df.withColumn("_bkt", key_bucket(df, key, width))
    offsets = (with_b.groupBy("_bkt").agg(F.count(F.lit(1)).alias("_n"))
               .select("_bkt", F.coalesce(F.sum("_n").over(
                   Window.orderBy(F.col("_bkt").asc_nulls_first())
                   .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off")))
    ranked = with_b.withColumn(
        "_pos", F.row_number().over(Window.partitionBy("_bkt").orderBy(F.col(key).asc_nulls_first())))
    keyed = ranked.join(F.broadcast(offsets), ranked["_bkt"].eqNullSafe(offsets["_bkt"]), "inner")
    sk = (F.lit(int(start)) + F.col("_off") + F.col("_pos")).cast(key_type)
    return keyed.select(*[ranked[c] for c in df.columns], sk.alias(sk_col))


def assign_keys_by_range(df: DataFrame, sk_col: str, order_cols: list[str], start: int = 0,
                         num_partitions: int | None = None, key_type: str = "int") -> DataFrame:
    """``df`` should be stored: without ``num_partitions`` its rows are counted first."""
    n = num_partitions
    if n is None:
        rows = df.count()
        if rows <= BUCKET_WIDTH:
            pos = F.row_number().over(Window.orderBy(*[F.col(c).asc_nulls_first() for c in order_cols]))
            return df.withColumn(sk_col, (F.lit(int(start)) + pos).cast(key_type))
        n = -(-rows // BUCKET_WIDTH)
    ranged = (df.repartitionByRange(n, *[F.col(c).asc_nulls_first() for c in order_cols])
              .sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order_cols])
              .withColumn("_pid", F.spark_partition_id())
              # position inside this (sorted) partition
              .withColumn("_pos", F.monotonically_increasing_id() - F.col("_pid").cast("long") * F.lit(_PID_SHIFT)))
    frozen = materialize(ranged, "keys")
    counts = frozen.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    keyed = frozen.join(F.broadcast(offsets), "_pid", "inner")
    sk = (F.lit(int(start)) + F.col("_off") + F.col("_pos") + F.lit(1)).cast(key_type)
    return keyed.withColumn(sk_col, sk).drop("_pid", "_pos", "_off")


def assign_keys(df: DataFrame, sk_col: str, order_cols: list[str], start: int = 0,
                num_partitions: int | None = None, key_type: str = "int") -> DataFrame:
    """Add ``sk_col`` = start + 1 .. start + n in ``order_cols`` order (unique keys)."""
    if bucketable(df, order_cols):
        return assign_keys_by_bucket(df, sk_col, order_cols[0], start, key_type)
    return assign_keys_by_range(df, sk_col, order_cols, start, num_partitions, key_type)


def max_key(df: DataFrame, sk_col: str) -> int:
    """Current maximum surrogate key (0 for an empty table).

    One scalar to the driver.  Column pruning makes it a one-column scan;
    with the DSv2 Parquet reader and aggregate pushdown it comes from file
    footers alone.
    """
    row = df.agg(F.max(sk_col).alias("m")).first()
    return int(row["m"]) if row is not None and row["m"] is not None else 0
