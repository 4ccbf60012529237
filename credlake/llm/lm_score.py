"""Language-model scores by stupid backoff over corpus-wide n-gram counts.

Count tables of all n-grams of the corpus are partitioned by the n-gram's
hash.  Documents are dealt to groups of bounded size; a group explodes its
n-grams, counts the distinct ones and sends (n-gram, count) to the partition of
their hash; the partition adds the counts of all groups and answers each group
with the totals in the order asked; the group joins the totals to its n-grams
and sums each document's logarithms.  An n-gram as frequent as any reaches a
partition once per group, so no partition grows with a word's frequency, and
what is shuffled grows with the corpus.

Words and pairs are asked for first; longer n-grams in rounds of their own,
one per length, and only where both n-grams within are found twice or more:
one that holds an n-gram found once is found once itself.  No count is cut or
guessed.

Score of a word w after a context h, for the longest h of up to order - 1
words of its document: c(hw) / c(h) if c(hw) >= least, else ``backoff`` times
the score after h without its first word; in the end c(w) / N.  Words are runs
of bytes other than space and \\t to \\r.  N-grams are known by 64-bit hashes:
among 10**10 different n-grams about 3 share one, among 10**12 some 27,000.

Defined results: null, empty and blank texts have 0 words, log_score 0 and a
null mean.  Rows that repeat an id count and score separately.  Rows with a
null id count and score too.  An empty table gives no rows.  Other columns are
not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import flat, id_text, partitions, slices, stored, table
from .suffix_dedup import _shuffles_end
from .toxicity import _mix, word_hashes

_IN_WORD = np.ones(256, bool)
_IN_WORD[[32, *range(9, 14)]] = False
_SAME = np.arange(256, dtype=np.uint8)
GROUP_BYTES = 32 << 20  # of text, on average
TOTAL = -1  # the group under which partitions report the words they hold


def ngrams(texts: pa.ChunkedArray, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """(hash of the n-gram that ends at each word, for n = 1..order; the text of each word).
    An n-gram that would reach over the start of its text has hash 0."""
    words, owner, base = [], [], 0
    batch = pa.RecordBatch.from_arrays([texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts], ["text"])
    for part in slices(batch):
        h, d = word_hashes(*flat(part.column("text")), _IN_WORD, _SAME)
        words.append(h)
        owner.append(d + base)
        base += part.num_rows
    h = np.concatenate(words) if words else np.zeros(0, np.uint64)
    doc = np.concatenate(owner) if owner else np.zeros(0, np.int64)
    grams = [h]
    for n in range(2, order + 1):
        g = np.zeros(len(h), np.uint64)
        if len(h) >= n:
            joined = _mix(grams[-1][:-1] * np.uint64(0xA0761D6478BD642F) + h[1:])[n - 2:]
            g[n - 1:] = np.where(doc[n - 1:] == doc[:len(doc) - n + 1], joined, 0)
        grams.append(g)
    return grams, doc


def distinct(g: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct hashes ordered, place of each word's n-gram among them, counts)."""
    return np.unique(g, return_inverse=True, return_counts=True)


def _bounds(u: np.ndarray, buckets: int) -> np.ndarray:
    """Ordered hashes are cut into partitions by their highest bits."""
    edges = np.array([(i << 64) // buckets for i in range(1, buckets)], np.uint64)
    return np.concatenate([[0], np.searchsorted(u, edges), [len(u)]])


def _counts(grams: list[np.ndarray], told: pa.Table | None, upto: int) -> tuple[list[np.ndarray], np.ndarray]:
    """(count of the n-gram that ends at each word, for n = 1..upto; where the n-grams of length upto + 1 are asked for)."""
    d, counts = zstandard.ZstdDecompressor(), []
    parts = sorted(zip(told.column("n").to_pylist(), told.column("bucket").to_pylist(), told.column("payload").to_pylist()),
                   key=lambda r: r[:2]) if told is not None else []
    for n in range(1, upto + 1):
        c = (grams[n - 1] != 0).astype(np.int64)
        ask = asked(grams, counts, n)
        total = [np.frombuffer(d.decompress(p), np.int64) for k, _, p in parts if k == n]
        if total:
            c[ask] = np.concatenate(total)[distinct(grams[n - 1][ask])[1]]
        counts.append(c)
    return counts, asked(grams, counts, upto + 1) if upto < len(grams) else np.zeros(0, bool)


def asked(grams: list[np.ndarray], counts: list[np.ndarray], n: int) -> np.ndarray:
    """Words that end an n-gram whose count must be asked for: beyond pairs, those with both n-grams within found twice or more."""
    here = grams[n - 1] != 0
    if n < 3:
        return here if n > 1 else np.ones(len(here), bool)
    often = counts[n - 2] >= 2
    return here & often & np.concatenate([[False], often[:-1]])[:len(here)]


def _ask(lengths: list[int], buckets: int):
    def later(t: pa.Table, told: pa.Table | None) -> pa.Table:
        z, out = zstandard.ZstdCompressor(level=1), []
        if t.num_rows:
            grp = t.column("__grp")[0].as_py()
            grams = ngrams(t.column("text"), max(lengths))[0]
            counts = _counts(grams, told, lengths[0] - 1)[0]
            for n in lengths:
                u, _, k = distinct(grams[n - 1][asked(grams, counts, n)])
                cut = _bounds(u, buckets).tolist()
                for b, (lo, hi) in enumerate(zip(cut[:-1], cut[1:])):
                    if lo < hi:
                        steps = np.diff(u[lo:hi], prepend=np.uint64(0))
                        planes = steps.view(np.uint8).reshape(-1, 8).T.tobytes()  # like bytes together: the high ones are mostly 0
                        out.append((b, n, grp, hi - lo, z.compress(planes + k[lo:hi].astype(np.uint32).tobytes())))
        cols = list(zip(*out)) or [()] * 5
        kinds = pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()
        return pa.table([pa.array(c, k) for c, k in zip(cols, kinds)], ["bucket", "n", "grp", "size", "payload"])

    def first(t: pa.Table) -> pa.Table:
        return later(t, None)

    return first if lengths[0] == 1 else later


def _answer(t: pa.Table) -> pa.Table:
    z, d = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()
    bucket, out = t.column("bucket")[0].as_py(), []
    size, n_of, grp = t.column("size").to_numpy(), t.column("n").to_numpy(), t.column("grp").to_pylist()
    for n in np.unique(n_of):
        at = np.flatnonzero(n_of == n)
        keys, counts = [], []
        for i in at:
            raw, m = d.decompress(t.column("payload")[int(i)].as_py()), int(size[i])
            planes = np.frombuffer(raw, np.uint8, 8 * m).reshape(8, m).T
            keys.append(np.cumsum(np.ascontiguousarray(planes).view(np.uint64).ravel(), dtype=np.uint64))
            counts.append(np.frombuffer(raw, np.uint32, m, 8 * m))
        u, where = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(where, np.concatenate(counts)).astype(np.int64)
        if n == 1:
            out.append((TOTAL, bucket, 1, int(total.sum()), None))
        cut = np.cumsum([0, *size[at]]).tolist()
        for i, lo, hi in zip(at, cut[:-1], cut[1:]):
            out.append((grp[i], bucket, int(n), hi - lo, z.compress(total[where[lo:hi]].tobytes())))
    cols = list(zip(*out)) or [()] * 5
    kinds = pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()
    return pa.table([pa.array(c, k) for c, k in zip(cols, kinds)], ["grp", "bucket", "n", "size", "payload"])


def _score(order: int, least: int, backoff: float, words: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        grams, doc = ngrams(left.column("text"), order)
        rows = left.num_rows
        counts, _ = _counts(grams, right, order)
        logs = np.log(np.maximum(counts[0], 1) / max(words, 1))
        for n in range(2, order + 1):
            c = counts[n - 1]
            reach = (grams[n - 1] != 0)  # words with a context of n - 1 words in their text
            context = np.concatenate([[1], counts[n - 2][:-1]])[:len(c)]
            logs = np.where(reach, np.where(c >= least, np.log(np.maximum(c, 1) / np.maximum(context, 1)), np.log(backoff) + logs), logs)
        n_words, score = np.bincount(doc, minlength=rows), np.bincount(doc, logs, rows).astype(float)
        mean = pa.array(score / np.maximum(n_words, 1), mask=n_words == 0)
        return pa.Table.from_arrays([left.column("doc_id"), pa.array(n_words.astype(np.int64)), pa.array(score), mean], ["doc_id", "n_words", "log_score", "mean_log_score"])

    return run


def lm_scores(docs: DataFrame, order: int = 2, least: int = 2, backoff: float = 0.4, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(doc_id, n_words, log_score, mean_log_score) of every whole text under the counts of all texts."""
    spark = docs.sparkSession
    buckets = partitions(spark)
    rows = id_text(docs)
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    groups = max(buckets, -(-int(size) // group_bytes))
    rows = rows.withColumn("__grp", F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)))
    shape, answer = "bucket long, n int, grp long, size long, payload binary", "grp long, bucket long, n int, size long, payload binary"
    told, words = None, 0
    for lengths in [[1, 2][:order], *[[n] for n in range(3, order + 1)]]:
        with _shuffles_end(spark):
            by = rows.groupBy("__grp")
            if told is None:
                asks = by.applyInArrow(_ask(lengths, buckets), shape)
            else:
                asks = by.cogroup(told.groupBy("__grp")).applyInArrow(_ask(lengths, buckets), shape)
            answers = stored(asks.groupBy("bucket").applyInArrow(_answer, answer), "lm-counts")
        if told is None:
            words = answers.where(F.col("grp") == TOTAL).agg(F.sum("size")).first()[0] or 0
        mine = answers.where(F.col("grp") != TOTAL).withColumnRenamed("grp", "__grp")
        told = mine if told is None else told.unionByName(mine)
    return rows.groupBy("__grp").cogroup(told.groupBy("__grp")).applyInArrow(
        _score(order, least, backoff, words), "doc_id long, n_words long, log_score double, mean_log_score double")


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document under the counts of words, pairs and triples of all documents; logarithms to 6 places."""
    found = lm_scores(table(spark, sf_dir, "documents"), order=3, least=1, backoff=0.4)
    return found.select("doc_id", "n_words", F.round("log_score", 6).alias("log_score"), F.round("mean_log_score", 6).alias("mean_log_score"))


#: DuckDB's form of the same rows.
ORACLE = r"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+') AS ws FROM documents),
w AS (
  SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM t),
g AS (
  SELECT doc_id, w, i, lag(w) OVER (PARTITION BY doc_id ORDER BY i) AS h, lag(w, 2) OVER (PARTITION BY doc_id ORDER BY i) AS h2 FROM w),
one AS (SELECT w, count(*) AS c FROM g GROUP BY w),
two AS (SELECT h, w, count(*) AS c FROM g WHERE h IS NOT NULL GROUP BY h, w),
three AS (SELECT h2, h, w, count(*) AS c FROM g WHERE h2 IS NOT NULL GROUP BY h2, h, w),
s AS (
  SELECT g.doc_id,
         CASE WHEN g.h IS NULL THEN ln(one.c / n.n)
              WHEN g.h2 IS NULL THEN ln(two.c / hc.c)
              ELSE ln(three.c / hhc.c) END AS l
  FROM g JOIN one ON one.w = g.w
  LEFT JOIN two ON two.h = g.h AND two.w = g.w
  LEFT JOIN one AS hc ON hc.w = g.h
  LEFT JOIN three ON three.h2 = g.h2 AND three.h = g.h AND three.w = g.w
  LEFT JOIN two AS hhc ON hhc.h = g.h2 AND hhc.w = g.h
  CROSS JOIN (SELECT count(*)::DOUBLE AS n FROM w) AS n),
d AS (SELECT doc_id, count(*) AS n_words, sum(l) AS l FROM s GROUP BY doc_id)
SELECT t.doc_id, coalesce(d.n_words, 0) AS n_words, round(coalesce(d.l, 0), 6) AS log_score,
       round(d.l / d.n_words, 6) AS mean_log_score
FROM t LEFT JOIN d ON d.doc_id = t.doc_id
"""
