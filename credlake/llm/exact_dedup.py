"""Exact deduplication: group by 128-bit content hash and compare bytes.

Rows group by (md5 of the normalised text, normalised text): the hash spreads
the groups, and the text beside it makes Spark compare bytes, so rows that
only share a hash never meet.  Counts and kept ids are combined before the
shuffle, so a group of copies that holds a third of all rows crosses the
network once per map task.  Rows then find their class by (md5, sha256) in
one join of narrow rows, where AQE splits a hot key.

Defined results: null text is empty text, and empty texts are equal to one
another.  Rows with a null id count in group_size and are never kept unless
all ids of the group are null.  Rows that repeat an id and its text count
separately and share one decision.  An empty table gives no rows.  Other
columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, fresh, keep_rows, row_hashes, table


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
                normalise: Callable[[Column], Column] | None = ascii_lower,
                digest: Callable[[Column], Column] = F.md5) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    ``keep``: the smallest or the largest id of a class stays.  ``digest`` is
    the grouping hash (a parameter so that tests can force collisions)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), (normalise(text) if normalise else text).alias("norm"))
    rows = rows.select("doc_id", "norm", digest(F.col("norm").cast("binary")).alias("key"))
    pick = F.min if keep == "smallest" else F.max
    classes = (
        rows.groupBy("key", "norm")
        .agg(pick("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("key", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"), "keep_id", "group_size")
    )
    members = rows.select("doc_id", "key", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"))
    return members.join(classes, ["key", "text_sha256"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, keep: str = "smallest", normalise: Callable[[Column], Column] | None = ascii_lower) -> DataFrame:
    """The documents that stay, one row of each class of equal texts, with their columns as they came.

    Of a class the row of the smallest or largest id stays (null ids last); if
    rows share that id, one of them, picked by a hash of all its columns."""
    a, b = fresh(docs, "row_a"), fresh(docs, "row_b")
    hashes = row_hashes(docs)
    docs = docs.withColumns({a: hashes[0], b: hashes[1]})
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").alias("id"), (normalise(text) if normalise else text).alias("norm"),
                       F.col(a).alias("a"), F.col(b).alias("b"))
    nil = F.col("id").isNull()
    pick, order = (F.min, F.struct(nil.alias("z"), "id", "a", "b")) if keep == "smallest" else (F.max, F.struct((~nil).alias("z"), "id", "a", "b"))
    classes = rows.groupBy(F.md5(F.col("norm").cast("binary")).alias("key"), "norm").agg(pick(order).alias("one"))
    return keep_rows(docs, a, b, classes.select(F.col("one.a").alias(a), F.col("one.b").alias(b)))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, equal when identical after lower-casing A-Z; the largest doc_id stays."""
    return exact_dedup(table(spark, sf_dir, "documents"), keep="largest")


#: DuckDB's form of the same rows.
ORACLE = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm)
"""
