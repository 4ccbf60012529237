"""Phrase collocation mining: HAT-trie counting of word n-grams, merged per prefix partition.

Each task counts the n-grams of its texts in a HAT-trie: word ids are the
symbols, hash containers hold the n-grams below a prefix, and a container that
grows beyond ``BURST`` entries bursts at the word in its middle (the first
word, below a single first word the second, and so on).  The trie is shallow, so
it is kept as the ordered list of its containers with the prefix each starts
at.  When a task holds ``limit`` entries, its largest subtrees (all containers
below a first word) leave it whole as sorted runs, cut into partitions by a hash
of the first two words.  Spark brings the runs of a partition together, where
they are merged and n-grams found fewer than ``least`` times go.  A word pair
that is everywhere reaches its partition once per task and third word.

What is left is relational: parts of a phrase are at least as frequent as the
phrase, so every count that a score needs is among those kept.  Phrases are
joined to the counts of their parts, scored in decimals of 38 digits (a phrase
may occur 10**15 times), freed of those that lie in a longer phrase at least
``inside`` per cent as frequent, and ranked per language; only ``top`` rows per
language and task reach the ranking.

Words are known by task-local ids made from their bytes: hashes find a word,
its bytes decide.

Defined results: null text is empty; a null language is ``und``.  Rows count
each for themselves, repeats too; ids are not read.  Texts without a phrase of
``least`` occurrences, and an empty table, give no rows.  Other columns are not
read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import flat, partitions, slices, stored, table
from .toxicity import _mix
from .words import LOWER, same_bytes, span_hashes, spans

BREAK = np.zeros(256, bool)  # ends a piece: no phrase reaches over it
BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
IN_WORD = ~BREAK
IN_WORD[[0x20, 0x09]] = False
BITS = 21  # a key holds three word ids, 0 for none
IDS = (1 << BITS) - 1
BURST = 1 << 14
LIMIT = 1_200_000  # entries a task holds before it spills, some 100 bytes each
RUNS = "lang string, part int, payload binary"
COUNTS = "lang string, w1 string, w2 string, w3 string, f long"


class Ids:
    """Word ids of one language in one task, from 1 in order of appearance."""

    def __init__(self):
        self.of, self.words, self.hash = {}, [b""], [0]

    def take(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h, raw = span_hashes(buf, start, end), buf.tobytes()
        u, first, inv = np.unique(h, return_index=True, return_inverse=True)
        ids = np.array([self._id(raw[a:b], k) for a, b, k in zip(start[first].tolist(), end[first].tolist(), u.tolist())], np.int64)[inv]
        like = first[inv]
        size = end - start
        other = np.flatnonzero(~same_bytes(buf, start, size, buf, start[like], size[like]))
        for i in other.tolist():  # another word of the same hash
            ids[i] = self._id(raw[start[i]:end[i]], int(h[i]))
        return ids

    def _id(self, word: bytes, h: int) -> int:
        i = self.of.setdefault(word, len(self.words))
        if i == len(self.words):
            self.words.append(word)
            self.hash.append(h)
        return i


def ngram_keys(ids: np.ndarray, piece: np.ndarray, begin: int) -> np.ndarray:
    """Ordered keys of the n-grams of 1 to 3 words that lie within a piece and start at one of the first ``begin`` words."""
    w = ids.astype(np.uint64)
    one = w << np.uint64(2 * BITS)
    two = one[:-1] | w[1:] << np.uint64(BITS)
    three = two[:-1] | w[2:]
    same2, same3 = piece[1:] == piece[:-1], piece[2:] == piece[:-2]
    return np.sort(np.concatenate([one[:begin], two[:begin][same2[:begin]], three[:begin][same3[:begin]]]))


def _prefix_edge(keys: np.ndarray) -> int:
    """The prefix nearest the middle of ordered keys at which they can be cut: of one word if that
    leaves both sides some, else of two, else of three."""
    half = len(keys) // 2
    for bits in (2 * BITS, BITS, 0):
        p = keys >> np.uint64(bits)
        lo, hi = int(np.searchsorted(p, p[half], "left")), int(np.searchsorted(p, p[half], "right"))
        cut = min((c for c in (lo, hi) if 0 < c < len(keys)), key=lambda c: abs(c - half), default=0)
        if cut:
            return int(p[cut]) << bits
    return 0


def _items(box: Counter) -> tuple[np.ndarray, np.ndarray]:
    """(ordered keys, counts) of a container."""
    k, c = np.fromiter(box.keys(), np.uint64, len(box)), np.fromiter(box.values(), np.int64, len(box))
    order = np.argsort(k)
    return k[order], c[order]


class HatTrie:
    """Counts of packed n-grams in burstable hash containers, ordered by prefix."""

    def __init__(self, burst: int = BURST):
        self.burst, self.edges, self.boxes, self.size = burst, [0], [Counter()], 0

    def add(self, keys: np.ndarray) -> None:
        """Count ordered keys."""
        cut = np.searchsorted(keys, np.array([*self.edges[1:]], np.uint64)).tolist()
        full = []
        for i, (lo, hi) in enumerate(zip([0, *cut], [*cut, len(keys)])):
            if lo < hi:
                box = self.boxes[i]
                before = len(box)
                box.update(keys[lo:hi].tolist())
                self.size += len(box) - before
                if len(box) > self.burst:
                    full.append(i)
        for i in reversed(full):
            self._burst(i)

    def _burst(self, i: int) -> None:
        keys, counts = _items(self.boxes[i])
        todo, done = [(self.edges[i], 0, len(keys))], []
        while todo:
            edge, lo, hi = todo.pop()
            at = _prefix_edge(keys[lo:hi]) if hi - lo > self.burst else 0
            if not at:
                done.append((edge, Counter(dict(zip(keys[lo:hi].tolist(), counts[lo:hi].tolist())))))
                continue
            cut = int(np.searchsorted(keys, np.uint64(at)))
            todo += [(at, cut, hi), (edge, lo, cut)]
        self.edges[i:i + 1], self.boxes[i:i + 1] = [e for e, _ in done], [b for _, b in done]

    def _subtrees(self) -> list[tuple[int, int]]:
        """Ranges of containers that share no first word with another range."""
        first = [e >> 2 * BITS for e in self.edges]
        inner = [e != f << 2 * BITS for e, f in zip(self.edges, first)]  # starts below a first word
        starts = [i for i in range(len(first)) if not inner[i]] + [len(first)]
        return list(zip(starts[:-1], starts[1:]))

    def spill(self, share: float) -> tuple[np.ndarray, np.ndarray]:
        """Take out the largest subtrees, ``share`` of all entries or a little more: (ordered keys, counts)."""
        sizes = sorted(((sum(len(self.boxes[i]) for i in range(a, b)), a, b) for a, b in self._subtrees()), reverse=True)
        keys, counts, goal = [], [], share * self.size
        for size, a, b in sizes:
            if goal <= 0:
                break
            goal -= size
            for i in range(a, b):
                k, c = _items(self.boxes[i])
                keys.append(k)
                counts.append(c)
                self.size -= len(k)
                self.boxes[i] = Counter()
        order = sorted(range(len(keys)), key=lambda i: int(keys[i][0]) if len(keys[i]) else 0)  # containers do not overlap
        return (np.concatenate([np.zeros(0, np.uint64), *(keys[i] for i in order)]),
                np.concatenate([np.zeros(0, np.int64), *(counts[i] for i in order)]))


def _unpack(keys: np.ndarray) -> list[np.ndarray]:
    return [(keys >> np.uint64(s) & np.uint64(IDS)).astype(np.int64) for s in (2 * BITS, BITS, 0)]


def _planes(a: np.ndarray) -> bytes:
    """32-bit numbers, like bytes together."""
    return np.ascontiguousarray(a.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _unplanes(raw: bytes, n: int, at: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, 4 * n, at).reshape(4, n).T).view("<u4").ravel().astype(np.int64)


def _by_hash(h: np.ndarray, empty: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order of words by hash, the empty word first; place of each word in it)."""
    order = np.lexsort((h, ~empty))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return order, rank


def runs(ids: Ids, keys: np.ndarray, counts: np.ndarray, parts: int) -> Iterator[tuple[int, bytes]]:
    """(partition, run): the n-grams of each partition in the order of their words' hashes, with those words."""
    h = np.array(ids.hash, np.uint64)
    order, rank = _by_hash(h, np.arange(len(h)) == 0)  # the empty word stands for none
    words = pa.array(ids.words, pa.large_binary()).take(pa.array(order))
    w = _unpack(keys)
    part = (_mix(h[w[0]] * np.uint64(0xA0761D6478BD642F) + h[w[1]]) % np.uint64(parts)).astype(np.int32)
    a, b, c = (rank[x] for x in w)
    order = np.argsort(a << 2 * BITS | b << BITS | c)
    order = order[np.argsort(part[order], kind="stable")]
    z, local = zstandard.ZstdCompressor(level=1), np.zeros(len(h), np.int64)
    edge = np.searchsorted(part[order], np.arange(parts + 1)).tolist()
    for p, (lo, hi) in enumerate(zip(edge[:-1], edge[1:])):
        for at in range(lo, hi, 1 << 22):  # runs of bounded size
            mine = order[at:min(hi, at + (1 << 22))]
            x, y, v, k = a[mine], b[mine], c[mine], counts[mine]
            mark = np.zeros(len(h), bool)
            mark[0] = mark[x] = mark[y] = mark[v] = True
            used = np.flatnonzero(mark)
            local[used] = np.arange(len(used))
            text, offs = flat(words.take(pa.array(used)))
            yield p, z.compress(b"".join([
                np.array([len(mine), len(used), len(text)], "<i8").tobytes(), text.tobytes(), _planes(np.diff(offs)), _planes(np.diff(local[x], prepend=0)),
                _planes(local[y]), _planes(local[v]), _planes(k & 0xFFFFFFFF), _planes(k >> 32)]))


def unpacked(raw: bytes) -> tuple[pa.Array, list[np.ndarray], np.ndarray]:
    """(words, n-grams as places among them, counts) of a run."""
    n, m, size = np.frombuffer(raw, "<i8", 3).tolist()
    offs = np.concatenate([[0], np.cumsum(_unplanes(raw, m, 24 + size))])
    words = pa.Array.from_buffers(pa.large_binary(), m, [None, pa.py_buffer(offs), pa.py_buffer(raw[24:24 + size])])
    x, y, v, lo, hi = (_unplanes(raw, n, 24 + size + 4 * (m + n * i)) for i in range(5))
    return words, [np.cumsum(x.astype(np.uint32), dtype=np.uint32).astype(np.int64), y, v], hi << 32 | lo


def _count(parts: int, limit: int, burst: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries: dict[str, tuple[Ids, HatTrie]] = {}
        stretch = min(max(limit // 4, 1), IDS // 2)  # words counted at a time

        def spill(lang: str, share: float) -> Iterator[pa.RecordBatch]:
            ids, trie = tries[lang]
            for p, payload in runs(ids, *trie.spill(share), parts):
                yield pa.RecordBatch.from_arrays([pa.array([lang], pa.string()), pa.array([p], pa.int32()), pa.array([payload], pa.binary())],
                                                 ["lang", "part", "payload"])

        for batch in batches:
            for s in slices(batch):
                langs = s.column("lang").to_pylist()
                kinds, of = np.unique(np.array(langs, object), return_inverse=True)
                raw, offs = flat(s.column("text"))
                buf = LOWER[raw]
                start, end, doc = spans(buf, offs, IN_WORD)
                piece = np.searchsorted(np.flatnonzero(BREAK[buf]), start) + doc  # grows at a break and at a text's start
                for i, lang in enumerate(kinds.tolist()):
                    mine = np.flatnonzero(of[doc] == i)
                    for lo in range(0, len(mine), stretch):  # every n-gram begins in one stretch
                        at = mine[lo:lo + stretch + 2]
                        if lang in tries and len(tries[lang][0].words) + len(at) > IDS:
                            yield from spill(lang, 1)
                            del tries[lang]  # ids are used up: begin anew
                        ids, trie = tries.setdefault(lang, (Ids(), HatTrie(burst)))
                        first = int(start[at[0]])
                        w = ids.take(buf[first:end[at[-1]]], start[at] - first, end[at] - first)
                        trie.add(ngram_keys(w, piece[at], stretch))
                        while sum(t.size for _, t in tries.values()) > limit:
                            yield from spill(max(tries, key=lambda x: tries[x][1].size), 0.6)
        for lang in list(tries):
            yield from spill(lang, 1)

    return run


def _merge(least: int):
    def run(t: pa.Table) -> pa.Table:
        """Merge the runs of one language and partition."""
        d, lang = zstandard.ZstdDecompressor(), t.column("lang")[0].as_py()
        tables, grams, counts = zip(*(unpacked(d.decompress(p.as_py())) for p in t.column("payload")))
        coded = pa.concat_arrays(tables).dictionary_encode()
        text, offs = flat(coded.dictionary)
        order, rank = _by_hash(span_hashes(text, offs[:-1], offs[1:]), np.diff(offs) == 0)
        of, base = rank[coded.indices.to_numpy()], np.cumsum([0, *map(len, tables)])
        a, b, c = (np.concatenate([of[g[i] + k] for g, k in zip(grams, base)]) for i in range(3))
        if len(order) <= IDS:
            key = a << 2 * BITS | b << BITS | c
        else:
            key = np.unique(a << 32 | b, return_inverse=True)[1] << 32 | c
        by = np.argsort(key, kind="stable")  # merges ordered stretches
        key = key[by]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        f = np.add.reduceat(np.concatenate(counts)[by], first)
        a, b, c = (x[by][first] for x in (a, b, c))
        n = int(f[b == 0].sum())
        keep = f >= least
        words = coded.dictionary.take(pa.array(order)).cast(pa.large_string()).cast(pa.string())

        def column(x: np.ndarray) -> pa.Array:
            return words.take(pa.array(x, mask=x == 0))

        out = [pa.array([lang] * int(keep.sum()), pa.string()), *(column(x[keep]) for x in (a, b, c)), pa.array(f[keep])]
        names = ["lang", "w1", "w2", "w3", "f"]
        total = pa.table([pa.array([lang], pa.string()), *[pa.array([None], pa.string())] * 3, pa.array([n], pa.int64())], names)
        return pa.concat_tables([pa.table(out, names), total])

    return run


def ngram_counts(docs: DataFrame, least: int = 10, limit: int = LIMIT, burst: int = BURST, text_col: str = "text",
                 lang_col: str = "lang") -> DataFrame:
    """(lang, w1, w2, w3, f) of every n-gram of up to three words found ``least`` times or more; rows
    without w1 add up to all words of the language."""
    rows = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = rows.mapInArrow(_count(2 * partitions(docs.sparkSession), limit, burst), RUNS)
    return stored(found.groupBy("lang", "part").applyInArrow(_merge(least), COUNTS), "collocation-counts")


def _score(a: str, left: str, right: str) -> Column:
    wide = {c: f"CAST({c} AS DECIMAL(38, 0))" for c in (a, left, right)}
    return F.expr(f"(CAST(1000000 AS DECIMAL(7, 0)) * {wide[a]} * {wide[a]}) div ({wide[left]} * {wide[right]})")


def collocations(docs: DataFrame, least: int = 10, inside: int = 50, top: int = 2000, **kw) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the ``top`` phrases of two or three words of each language."""
    counts = ngram_counts(docs, least, **kw)
    n = counts.where("w1 IS NULL").groupBy("lang").agg(F.sum("f").alias("n"))
    one = counts.where("w1 IS NOT NULL AND w2 IS NULL").select("lang", "w1", "f")
    two = counts.where("w2 IS NOT NULL AND w3 IS NULL").select("lang", "w1", "w2", "f")
    three = counts.where("w3 IS NOT NULL").select("lang", "w1", "w2", "w3", F.col("f").alias("a"))

    def with_count(df: DataFrame, of: DataFrame, words: list[str], name: str) -> DataFrame:
        keys = [F.col(f"w{i}").alias(w) for i, w in enumerate(words, 1)]
        return df.join(of.select("lang", *keys, F.col("f").alias(name)), ["lang", *words])

    three = with_count(with_count(three, one, ["w1"], "l1"), two, ["w2", "w3"], "r1")
    three = with_count(with_count(three, two, ["w1", "w2"], "l2"), one, ["w3"], "r2")
    three = three.withColumn("s1", _score("a", "l1", "r1")).withColumn("s2", _score("a", "l2", "r2"))
    first = F.col("s1") <= F.col("s2")  # the cut that scores least, of equals the first
    three = three.select("lang", "w1", "w2", "w3", "a", F.when(first, F.col("l1")).otherwise(F.col("l2")).alias("l"),
                         F.when(first, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score"))
    held = three.select("lang", F.inline(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))), "a")
    longer = held.groupBy("lang", "w1", "w2").agg(F.max("a").alias("longer"))
    pairs = two.withColumnRenamed("f", "a").join(longer, ["lang", "w1", "w2"], "left")
    pairs = pairs.where(F.col("longer").isNull() | (100 * F.col("longer") < inside * F.col("a"))).drop("longer")
    pairs = with_count(with_count(pairs, one, ["w1"], "l"), one, ["w2"], "r").withColumn("score", _score("a", "l", "r"))
    phrases = pairs.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", "score").unionByName(
        three.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", "l", "r", "score"))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc())
    ranked = phrases.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of each language, of two or three words found 10 times or more."""
    return collocations(table(spark, sf_dir, "documents"), least=10, inside=50, top=2000)


#: DuckDB's form of the same rows.
ORACLE = r"""
WITH p AS (
  SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM (
    SELECT coalesce(lang, 'und') AS lang,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents)),
w AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS ws FROM p),
i AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
one AS (SELECT lang, ws[i] AS w1, count(*) AS f FROM i GROUP BY ALL),
two AS (SELECT lang, ws[i] AS w1, ws[i + 1] AS w2, count(*) AS f FROM i WHERE i < len(ws) GROUP BY ALL HAVING count(*) >= 10),
three AS (
  SELECT lang, ws[i] AS w1, ws[i + 1] AS w2, ws[i + 2] AS w3, count(*) AS f FROM i WHERE i + 1 < len(ws)
  GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM one GROUP BY lang),
cuts AS (
  SELECT t.lang, t.w1 || ' ' || t.w2 AS phrase, t.f AS a, 1 AS k, x.f AS l, y.f AS r FROM two t
  JOIN one x ON x.lang = t.lang AND x.w1 = t.w1 JOIN one y ON y.lang = t.lang AND y.w1 = t.w2
  WHERE NOT EXISTS (SELECT 1 FROM three o WHERE o.lang = t.lang AND o.w1 = t.w1 AND o.w2 = t.w2 AND 100 * o.f >= 50 * t.f)
    AND NOT EXISTS (SELECT 1 FROM three o WHERE o.lang = t.lang AND o.w2 = t.w1 AND o.w3 = t.w2 AND 100 * o.f >= 50 * t.f)
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 1, x.f, y.f FROM three t
  JOIN one x ON x.lang = t.lang AND x.w1 = t.w1 JOIN two y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 2, x.f, y.f FROM three t
  JOIN two x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2 JOIN one y ON y.lang = t.lang AND y.w1 = t.w3),
s AS (
  SELECT *, CAST((1000000 * CAST(a AS HUGEINT) * a) // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cuts),
c AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT c.lang, row_number() OVER (PARTITION BY c.lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM c JOIN n ON n.lang = c.lang
QUALIFY row_number() OVER (PARTITION BY c.lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""
