"""Line deduplication: lines that many documents hold stay in one of them.

A line's key is the line stripped of ASCII white space and lower-cased over
A-Z.  Each document's distinct keys are exploded as 128-bit hashes and counted
per hash; the counts are combined before the shuffle, so a line that a third
of all documents hold crosses the network once per map task.  Hashes found in
``min_docs`` documents or more are joined to the (document, position) of their
lines, where AQE splits a hot hash; the positions to drop come together per
document, and the document's lines are reassembled by position without them.
Texts are shuffled once.  Everything is built-in functions.

Keys are compared by md5: among 10**13 lines two texts share one with a chance
of about 10**-13.

Defined results: null text is one empty line.  A key shorter than ``min_chars``
code points is never dropped.  Every row is a document of its own when
documents are counted; rows that repeat an id count separately, and where they
hold the largest id of a key all of them keep the line.  A null id is smaller
than any other; if all ids of a key are null its lines stay.  An empty table
gives no rows.  Other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, table

SPACE = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased."""
    bare = F.btrim(line, F.lit(SPACE))
    plain = F.octet_length(bare) == F.char_length(bare)  # ASCII has a faster way
    return F.when(plain, F.lower(bare)).otherwise(ascii_lower(bare))


def _hash(key: Column) -> Column:
    return F.md5(key.cast("binary"))


def common_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(key_hash, n_docs, keep_id) of the keys that ``min_docs`` rows of (doc_id, lines) or more hold."""
    long = F.filter("lines", lambda x: F.octet_length(x) >= min_chars)
    keys = F.filter(F.transform(long, line_key), lambda k: F.char_length(k) >= min_chars)
    held = docs.select("doc_id", F.explode(F.array_distinct(F.transform(keys, _hash))).alias("key_hash"))
    return (held.groupBy("key_hash").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keep_id"))
            .where(F.col("n_docs") >= min_docs))


def without(lines: Column, drop: Column) -> Column:
    """``lines`` without those at the ascending positions ``drop``, as the slices between them."""
    def between(j: Column) -> Column:
        first = F.coalesce(F.get(drop, j - 1) + 2, F.lit(1))
        return F.slice(lines, first, F.coalesce(F.get(drop, j), F.size(lines)) - first + 1)

    return F.when(drop.isNull(), lines).otherwise(F.flatten(F.transform(F.sequence(F.lit(0), F.size(drop)), between)))


def line_dedup(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_lines (before), n_dropped, text (the lines that stay)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.split(text, "\n").alias("lines"),
        # 128 bits over id and text name a row; rows alike in both drop the same lines
        F.xxhash64(F.col(id_col), text).alias("k1"), F.xxhash64(F.lit(1), F.col(id_col), text).alias("k2"))
    common = common_lines(rows, min_chars, min_docs).select("key_hash", "keep_id")
    line = F.col("line")
    at = (rows.select("doc_id", "k1", "k2", F.posexplode("lines").alias("pos", "line"))
          .where(F.octet_length(line) >= min_chars)
          .select("doc_id", "k1", "k2", "pos", line_key(line).alias("key"))
          .where(F.char_length("key") >= min_chars)
          .select("doc_id", "k1", "k2", "pos", _hash(F.col("key")).alias("key_hash")))
    gone = (at.join(common, "key_hash").where(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
            .groupBy("k1", "k2").agg(F.sort_array(F.collect_set("pos")).alias("drop")))
    return rows.join(gone, ["k1", "k2"], "left").select(
        "doc_id", F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"),
        F.array_join(without(F.col("lines"), F.col("drop")), "\n").alias("text"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: lines of 40 characters or more in 5 documents or more stay in the largest doc_id alone."""
    kept = line_dedup(table(spark, sf_dir, "documents"), min_chars=40, min_docs=5)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


#: DuckDB's form of the same rows.
ORACLE = r"""
WITH t AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM t),
k AS (
  SELECT *, translate(regexp_replace(line, '^[ \t-\r]+|[ \t-\r]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (
  SELECT key, max(doc_id) AS keep_id FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT k.*, coalesce(k.doc_id <> c.keep_id, false) AS gone FROM k LEFT JOIN c ON c.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
