"""Ranked lexical search: hybrid term-at-a-time and document-at-a-time over document shards.

Each task turns its documents into index segments: for the terms of a block of
queries, postings (document, occurrences) in document order, with the counts
that give document frequencies.  Segments are written to the shared folder.
Frequencies of all segments are added up, and each segment is then searched
where it lies; a task keeps the best ``top`` documents of each query over its
segments, so postings are never shuffled and what meets in the end is ``top``
rows per query and task.

Within a segment a query's short lists are taken term at a time: their scores
are summed into accumulators, one ordered list.  That list is then one iterator
among the long lists, with its largest sum as bound, and documents are taken in
document order, a window at a time: windows whose block bounds stay below the
score that is needed are skipped; in the others only documents of the iterators
that can reach it are scored, and the remaining lists are probed for those alone
that still can.  The score needed starts at the ``top``-th largest accumulator.
Nothing that could enter the result is skipped, so results are exact.

Queries are taken in blocks of about ``block_bytes`` of distinct text; terms of
one block, at most, are what tasks receive.  Terms are found by hash and then
compared byte by byte.

Defined results: null and blank texts hold no terms; a query without terms has
no rows.  Rows of ``documents`` that repeat an id are documents of their own;
a null id ranks after all others of its score.  Every row of ``queries`` gets
its rows, also if ids or texts repeat.  With no documents there are no rows.
Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import flat, id_text, slices, stored, table
from .words import LOWER, same_bytes, span_hashes, spans

IN_TERM = np.zeros(256, bool)
IN_TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
SEGMENT = 48 << 20  # bytes of text a segment covers
WINDOW = 4096  # documents scored at a time
SEGMENT_SHAPE = "n_docs long, n_terms long, terms array<int>, dfs array<int>, ids long, payload binary"
FOUND = pa.schema([("query", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])


def terms_of(text: str) -> set[bytes]:
    return set(re.findall(rb"[0-9A-Za-z\x80-\xff]+", text.encode().lower()))  # bytes.lower() is A-Z only


class Vocabulary:
    """The terms of a block of queries, ordered by hash."""

    def __init__(self, terms: list[bytes]):
        size = np.array([len(t) for t in terms], np.int64)
        buf = np.frombuffer(b"".join(terms), np.uint8)
        end = np.cumsum(size)
        h = span_hashes(buf, end - size, end) if terms else np.zeros(0, np.uint64)
        order = np.argsort(h, kind="stable")
        self.buf, self.start, self.size, self.hash = buf, (end - size)[order], size[order], h[order]
        self.terms = [terms[i] for i in order.tolist()]

    def find(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Number of each span's term, or -1."""
        at = np.full(len(start), -1, np.int64)
        if not len(self.hash) or not len(start):
            return at
        h = span_hashes(buf, start, end)
        place = np.searchsorted(self.hash, h)
        todo = np.flatnonzero((place < len(self.hash)) & (self.hash[np.minimum(place, len(self.hash) - 1)] == h))
        while len(todo):  # terms that share a hash stand side by side
            p = place[todo]
            hit = same_bytes(buf, start[todo], end[todo] - start[todo], self.buf, self.start[p], self.size[p])
            at[todo[hit]] = p[hit]
            todo = todo[~hit]
            place[todo] += 1
            todo = todo[(place[todo] < len(self.hash))]
            todo = todo[self.hash[place[todo]] == h[todo]]
        return at


def _postings(batch: pa.RecordBatch, vocabulary: Vocabulary) -> tuple[np.ndarray, ...]:
    """(terms of each text, then term, text, occurrences of each posting)."""
    raw, offs = flat(batch.column("text"))
    buf = LOWER[raw]
    start, end, doc = spans(buf, offs, IN_TERM)
    n = np.bincount(doc, minlength=batch.num_rows)
    term = vocabulary.find(buf, start, end)
    hit = term >= 0
    both, tf = np.unique(term[hit] * batch.num_rows + doc[hit], return_counts=True)
    return n, both // max(batch.num_rows, 1), both % max(batch.num_rows, 1), tf


def _segment(ids: list, counts: list, postings: list) -> tuple:
    """One index row: documents that hold a term of the block, ordered by id (null last), lists ordered by term and document."""
    n = np.concatenate(counts)
    base = np.cumsum([0, *map(len, counts)])
    term = np.concatenate([p[0] for p in postings])
    doc = np.concatenate([p[1] + b for p, b in zip(postings, base)])
    tf = np.concatenate([p[2] for p in postings])
    held, doc = np.unique(doc, return_inverse=True)
    id_col = pa.concat_arrays(ids).take(pa.array(held))
    nil = id_col.is_null().to_numpy(zero_copy_only=False)
    known = id_col.fill_null(0).to_numpy()
    order = np.lexsort((known, nil))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    doc = place[doc]
    by = np.lexsort((doc, term))
    terms, dfs = np.unique(term, return_counts=True)
    payload = b"".join(a.tobytes() for a in (known[order].astype(np.int64), nil[order], n[held][order].astype(np.int64),
                                             doc[by].astype(np.int32), tf[by].astype(np.int32)))
    return int((n > 0).sum()), int(n.sum()), terms.astype(np.int32), dfs.astype(np.int32), len(held), zstandard.ZstdCompressor(level=1).compress(payload)


def _index(vocabulary: Vocabulary) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(found: tuple) -> pa.RecordBatch:
        n_docs, n_terms, terms, dfs, ids, payload = found
        lists = pa.list_(pa.int32())
        return pa.RecordBatch.from_arrays([
            pa.array([n_docs], pa.int64()), pa.array([n_terms], pa.int64()), pa.array([terms], lists), pa.array([dfs], lists),
            pa.array([ids], pa.int64()), pa.array([payload], pa.binary())], ["n_docs", "n_terms", "terms", "dfs", "ids", "payload"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, counts, postings, size = [], [], [], 0
        for batch in batches:
            for part in slices(batch):
                n, term, doc, tf = _postings(part, vocabulary)
                ids.append(part.column("doc_id"))
                counts.append(n)
                postings.append((term, doc, tf))
                size += part.column("text").nbytes
                if size >= SEGMENT:
                    yield rows(_segment(ids, counts, postings))
                    ids, counts, postings, size = [], [], [], 0
        if counts:
            yield rows(_segment(ids, counts, postings))

    return run


class Best:
    """The best ``top`` (score, id) of one query so far."""

    def __init__(self, top: int):
        self.top, self.need = top, 1  # scores of 0 are no results
        self.score, self.id, self.nil = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, score: np.ndarray, ids: np.ndarray, nil: np.ndarray) -> None:
        if not len(score):
            return
        s, i, z = np.concatenate([self.score, score]), np.concatenate([self.id, ids]), np.concatenate([self.nil, nil])
        keep = np.lexsort((i, z, -s))[:self.top]
        self.score, self.id, self.nil = s[keep], i[keep], z[keep]
        if len(keep) == self.top:
            self.need = max(self.need, int(self.score[-1]))


class List:
    """Documents in order, their scores, the largest score, and the largest of each window."""

    def __init__(self, doc: np.ndarray, score: np.ndarray):
        self.doc, self.score, self.bound = doc, score, int(score.max()) if len(score) else 0

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(first entry of each window of documents and one past the last, largest score in each)."""
        cut = np.searchsorted(self.doc, np.arange(n + 1) * WINDOW)
        top = np.zeros(n, np.int64)
        some = cut[:-1] < cut[1:]
        if some.any():
            top[some] = np.maximum.reduceat(self.score, cut[:-1][some])
        return cut, top


def accumulate(lists: list[List]) -> List:
    """Term at a time: one list of the summed scores."""
    doc = np.concatenate([x.doc for x in lists])
    order = np.argsort(doc, kind="stable")
    docs, first = np.unique(doc[order], return_index=True)
    return List(docs, np.add.reduceat(np.concatenate([x.score for x in lists])[order], first))


def search(lists: list[List], n_docs: int, best: Best, ids: np.ndarray, nil: np.ndarray, short: int) -> None:
    """Document at a time over the accumulators of the shortest lists (``short`` postings in all) and the others."""
    lists = sorted((x for x in lists if x.bound > 0), key=lambda x: len(x.doc))
    sizes = np.cumsum([len(x.doc) for x in lists])
    k = int(np.searchsorted(sizes, short, "right"))
    its = ([accumulate(lists[:k])] if k else []) + lists[k:]
    if not its:
        return
    if k and len(its[0].doc) >= best.top:  # sums of some lists: whole scores are at least these
        best.need = max(best.need, int(np.partition(its[0].score, -best.top)[-best.top]))
    its.sort(key=lambda x: x.bound)
    n = -(-n_docs // WINDOW)
    cuts, tops = zip(*(x.windows(n) for x in its))
    reach = np.cumsum(np.array(tops), axis=0)  # bound of the first j + 1 iterators, by window
    for w in np.flatnonzero(reach[-1] >= best.need).tolist():
        if reach[-1, w] < best.need:
            continue
        first = int(np.searchsorted(reach[:, w], best.need))  # iterators before it cannot reach the need together
        lo, score, seen = w * WINDOW, np.zeros(WINDOW, np.int64), np.zeros(WINDOW, bool)
        for x, cut in zip(its[first:], cuts[first:]):
            at = x.doc[cut[w]:cut[w + 1]] - lo
            score[at] += x.score[cut[w]:cut[w + 1]]  # a list holds a document once
            seen[at] = True
        doc = np.flatnonzero(seen)
        score = score[doc]
        for j in range(first - 1, -1, -1):
            can = score + reach[j, w] >= best.need
            doc, score = doc[can], score[can]
            if not len(doc):
                break
            x, lo_j, hi_j = its[j], cuts[j][w], cuts[j][w + 1]
            if lo_j < hi_j:
                part = x.doc[lo_j:hi_j]
                p = np.minimum(np.searchsorted(part, doc + lo), hi_j - lo_j - 1)
                score = score + np.where(part[p] == doc + lo, x.score[lo_j:hi_j][p], 0)
        can = score >= best.need
        best.add(score[can], ids[doc[can] + lo], nil[doc[can] + lo])


def _search(queries: list[np.ndarray], weight: np.ndarray, n_docs: int, n_terms: int, top: int, short: int | None):
    """Search every segment of a partition for every query (its term numbers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, d = [Best(top) for _ in queries], zstandard.ZstdDecompressor()
        for batch in batches:
            for terms, dfs, size, payload in zip(batch.column("terms"), batch.column("dfs"), batch.column("ids").to_pylist(), batch.column("payload")):
                raw = d.decompress(payload.as_py())
                df = np.asarray(dfs.values, np.int64)
                total = int(df.sum())
                ids = np.frombuffer(raw, np.int64, size)
                nil = np.frombuffer(raw, bool, size, 8 * size)
                n = np.frombuffer(raw, np.int64, size, 9 * size)
                doc = np.frombuffer(raw, np.int32, total, 17 * size).astype(np.int64)
                tf = np.frombuffer(raw, np.int32, total, 17 * size + 4 * total).astype(np.int64)
                m = 50 + (50 * n * n_docs) // n_terms
                number = np.asarray(terms.values, np.int64)
                score = np.repeat(weight[number], df) * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
                end = np.cumsum(df)
                lists = {t: List(doc[e - k:e], score[e - k:e]) for t, k, e in zip(number.tolist(), df.tolist(), end.tolist())}
                for q, b in zip(queries, best):
                    search([lists[t] for t in q.tolist() if t in lists], size, b, ids, nil, short or max(1024, size // 8))
        for i, b in enumerate(best):
            if len(b.score):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(b.score), i, np.int32)), pa.array(b.id, pa.int64(), mask=b.nil), pa.array(b.score)], schema=FOUND)

    return run


def _block(docs: DataFrame, texts: list[str], keys: list[str], top: int, short: int | None) -> DataFrame | None:
    """(key, rank, doc_id, score) of the queries of one block."""
    spark = docs.sparkSession
    wanted = [terms_of(t) for t in texts]
    vocabulary = Vocabulary(sorted(set().union(*wanted)))
    number = {t: i for i, t in enumerate(vocabulary.terms)}
    index = stored(docs.mapInArrow(_index(vocabulary), SEGMENT_SHAPE), "search-index")
    seen = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    if not seen[1]:
        return None
    n_docs, n_terms = int(seen[0]), int(seen[1])
    df = np.zeros(len(number), np.int64)
    pairs = index.select(F.inline(F.arrays_zip("terms", "dfs"))).groupBy("terms").agg(F.sum("dfs").alias("df"))
    for r in pairs.collect():  # one row a term of the block
        df[r["terms"]] = r["df"]
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
    queries = [np.array(sorted(number[t] for t in w), np.int64) for w in wanted]
    best = index.select("terms", "dfs", "ids", "payload").mapInArrow(
        _search(queries, weight, n_docs, n_terms, top, short), "query int, doc_id long, score long")
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    names = spark.createDataFrame(list(enumerate(keys)), "query int, key string")
    return names.join(ranked, "query").select("key", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, queries: DataFrame, top: int = 50, id_col: str = "item_id", text_col: str = "text",
                  block_bytes: int = 4 << 20, short: int | None = None) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each query by descending score, then ascending doc_id.

    ``short``: postings of the lists that are summed first (by default an eighth of a segment's documents)."""
    spark = docs.sparkSession
    rows = queries.select(F.col(id_col).alias("item_id"), F.coalesce(F.col(text_col), F.lit("")).alias("q"))
    rows = rows.withColumn("key", F.sha2(F.col("q").cast("binary"), 256))
    texts = stored(rows.groupBy("key").agg(F.first("q").alias("q")), "search-queries")
    size = texts.agg(F.sum(F.octet_length("q"))).first()[0] or 0
    blocks = -(-int(size) // block_bytes) or 1
    found = []
    for b in range(blocks):
        mine = texts.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == b).orderBy("key").collect()
        hits = _block(id_text(docs), [r["q"] for r in mine], [r["key"] for r in mine], top, short) if mine else None
        if hits is not None:
            found.append(hits if blocks == 1 else stored(hits, "search-hits"))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    hits = reduce(DataFrame.unionByName, found)
    return rows.select("item_id", "key").join(hits, "key").select("item_id", "rank", "doc_id", "score")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for every benchmark item."""
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=50)


#: DuckDB's form of the same rows.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM benchmark),
q AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest(ws) AS term FROM b)),
s AS (SELECT count(*) AS n_docs, CAST(sum(len(ws)) AS BIGINT) AS n_terms FROM d WHERE len(ws) > 0),
p AS (
  SELECT doc_id, len(ws) AS n, term, count(*) AS tf FROM (SELECT doc_id, ws, unnest(ws) AS term FROM d)
  GROUP BY doc_id, ws, term),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM p, s GROUP BY term, n_docs),
c AS (
  SELECT p.doc_id, p.term, w.w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))) AS score
  FROM p JOIN w ON w.term = p.term CROSS JOIN s),
r AS (
  SELECT item_id, doc_id, CAST(sum(score) AS BIGINT) AS score
  FROM q JOIN c ON c.term = q.term GROUP BY item_id, doc_id HAVING sum(score) > 0)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM r QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 50
"""
