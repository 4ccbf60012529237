"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the distinct words, word pairs and pairs around one
word, hashed to 2**BITS slots.  Words are runs of ASCII letters, digits and
non-ASCII bytes, lower-cased over A-Z, so punctuation glued to a word does not
hide it.  FTRL-proximal keeps a rate per coordinate and an L1 threshold, so
most slots end at exactly 0; the rest, at most 2**BITS pairs of slot and
weight, is what tasks receive for scoring.

Fitting reads a bounded sample: the ``sample`` labelled rows with the smallest
hashes of their ids (12,000 rows at most by default), brought together in one
task.  Scoring reads every whole text, where the data lie, without a shuffle.

Defined results: null and empty texts have no features and score the model's
bias.  Rows with a null id are scored, never learned from and not held out.
Null labels are not learned from; of several labels for an id the larger
counts.  With no labelled rows the score is 0.5 - EMPTY for every text, so
nothing is rejected.  Repeated rows score alike.  Columns beyond id and text
are passed through untouched by ``drop_toxic`` and not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import flat, held_out, id_text, slices, table

BITS = 22
SAMPLE = 12_000
CHUNK = 1 << 19  # bytes of text whose features are made at once
RUN = 1 << 16    # bytes of words that are hashed at once
EMPTY = 0.1  # with nothing to learn from, a score this far below one half

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_MUL = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    if n:
        p[0] = 1
    return np.multiply.accumulate(p)


_TABLES = [_powers(_INV, RUN), _powers(_MUL, RUN)]


def word_hashes(buf: np.ndarray, offs: np.ndarray, in_word: np.ndarray = _WORD, fold: np.ndarray = _FOLD) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word of the texts end to end, and the text each belongs to.
    A word is a run of bytes that ``in_word`` marks, folded by ``fold``."""
    n = len(buf)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    word = in_word[buf]
    brk = np.zeros(n + 1, bool)
    brk[offs] = True  # a word ends with its text
    start = np.flatnonzero(word & (brk[:n] | ~np.concatenate([[False], word[:-1]])))
    end = np.flatnonzero(word & (brk[1:] | ~np.concatenate([word[1:], [False]]))) + 1
    # sum of byte * MUL**-i as prefix sums: a word's polynomial is a difference, brought to position 0;
    # by runs of words of RUN bytes, so that there is no 64-bit number of every byte, however long the texts are
    h, i = np.empty(len(start), np.uint64), 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + RUN, "right")))
        lo, hi = int(start[i]), int(end[j - 1])
        value = fold[buf[lo:hi]].astype(np.uint64)
        value += np.uint64(1)
        down, up = _TABLES if hi - lo <= RUN else (_powers(_INV, hi - lo), _powers(_MUL, 1))  # one word beyond RUN begins at 0
        value *= down[:hi - lo]
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(value, out=sums[1:])
        a, b = start[i:j] - lo, end[i:j] - lo
        h[i:j] = _mix((sums[b] - sums[a]) * up[a] + (b - a).astype(np.uint64))
        i = j
    return h, np.searchsorted(offs, start, "right") - 1


def features(buf: np.ndarray, offs: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(slot, text) of every word, pair and skip pair occurrence."""
    h, doc = word_hashes(buf, offs)
    slots, docs = [h], [doc]
    for gap, salt in ((1, 0xA0761D6478BD642F), (2, 0xE7037ED1A0B428DB)):
        same = doc[gap:] == doc[:-gap] if len(doc) > gap else np.zeros(0, bool)
        pair = _mix(h[:-gap] * np.uint64(salt) + h[gap:]) if len(doc) > gap else np.zeros(0, np.uint64)
        slots.append(pair[same])
        docs.append(doc[:len(doc) - gap][same] if len(doc) > gap else np.zeros(0, np.int64))
    return (np.concatenate(slots) >> np.uint64(64 - bits)).astype(np.int64), np.concatenate(docs)


def distinct_features(buf: np.ndarray, offs: np.ndarray, keep: np.ndarray | None = None, bits: int = BITS):
    """The same, once for each text, ordered by text; ``keep`` marks slots of interest."""
    slot, doc = features(buf, offs, bits)
    if keep is not None:
        hit = keep[slot]
        slot, doc = slot[hit], doc[hit]
    both = np.unique(doc << bits | slot)
    return both & ((1 << bits) - 1), both >> bits


def ftrl(rows: list[np.ndarray], y: np.ndarray, bits: int = BITS, epochs: int = 4,
         alpha: float = 1.0, beta: float = 1.0, l1: float = 8.0, l2: float = 0.01) -> tuple[np.ndarray, float]:
    """FTRL-proximal over rows of distinct slots: (weights, bias).  The bias is a coordinate without L1."""
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
    bias = np.array([1 << bits])

    def weights(i):
        zi = z[i]
        pen = np.where(i == bias, 0.0, l1)
        w = -(zi - np.sign(zi) * pen) / ((beta + np.sqrt(n[i])) / alpha + l2)
        w[np.abs(zi) <= pen] = 0.0
        return w

    for _ in range(epochs):
        for slots, label in zip(rows, y):
            i = np.concatenate([slots, bias])
            w = weights(i)
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            root = np.sqrt(n[i])
            n[i] += g * g
            z[i] += g - (np.sqrt(n[i]) - root) / alpha * w
    out, on = np.zeros(1 << bits), np.flatnonzero((z[:-1] > l1) | (z[:-1] < -l1))
    out[on] = weights(on)
    return out, float(weights(bias)[0])


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, sample: int) -> DataFrame:
    """(doc_id, text, y) of the ``sample`` labelled documents that come first by
    hash of the id, rows held out excepted.  The chosen ids are at most
    ``sample`` rows, which bounds the broadcast."""
    ids = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isNotNull()).where(~held_out())
        .groupBy("doc_id").agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    return id_text(docs).join(F.broadcast(ids), "doc_id")


def learned(batches: Iterator[pa.RecordBatch], bits: int = BITS) -> Iterator[pa.RecordBatch]:
    """(slot, w) of the non-zero weights, the bias at slot -1, from rows of doc_id, y and the bytes x of distinct slots."""
    got = []
    for b in batches:
        x, offs = flat(b.column("x"))  # views: the features are not copied
        got += [(i, y, x[lo:hi]) for i, y, lo, hi in zip(b.column("doc_id").to_pylist(), b.column("y").to_pylist(), offs[:-1].tolist(), offs[1:].tolist())]
    if not got:
        return
    rows_of = Counter(i for i, _, _ in got)
    # an order unlike that of the ids; rows that share one by their features
    got.sort(key=lambda r: (hash((r[0], 11)), r[0], r[2].tobytes() if rows_of[r[0]] > 1 else b""))
    y = np.array([float(y > 0) for _, y, _ in got])
    w, bias = ftrl([x.view(np.int32) for _, _, x in got], y, bits)
    slot = np.flatnonzero(w)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(slot, -1)), pa.array(np.append(w[slot], bias))], ["slot", "w"])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, float]:
    """(slots, weights, bias): the non-zero part of the model."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, max_bytes=CHUNK):
                slot, doc = distinct_features(*flat(batch.column("text")), bits=bits)
                at = np.searchsorted(doc, np.arange(batch.num_rows + 1))
                rows = [slot[a:b].astype(np.int32).tobytes() for a, b in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array(rows, pa.binary())], ["doc_id", "y", "x"])

    # at most ``sample`` rows meet in the one task that learns
    model = (
        labelled_sample(docs, labels, "toxic", sample).mapInArrow(read, "doc_id long, y int, x binary")
        .repartition(1).mapInArrow(lambda batches: learned(batches, bits), "slot long, w double").toPandas()
    )
    slot, w = model["slot"].to_numpy(np.int64), model["w"].to_numpy(np.float64)
    if not len(slot):
        p = 0.5 - EMPTY
        return slot, w, float(np.log(p / (1 - p)))
    return slot[slot >= 0], w[slot >= 0], float(w[slot < 0][0])


def scored(batches: Iterator[pa.RecordBatch], model: tuple[np.ndarray, np.ndarray, float], bits: int = BITS) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Runs of whole rows, about CHUNK bytes of text each, with their scores."""
    slots, w, bias = model
    by = np.argsort(slots)
    slots, w = slots[by], w[by]
    keep = np.zeros(1 << bits, bool)
    keep[slots] = True
    for whole in batches:
        for batch in slices(whole, max_bytes=CHUNK):
            slot, doc = distinct_features(*flat(batch.column("text")), keep=keep, bits=bits)
            total = np.bincount(doc, w[np.searchsorted(slots, slot)], batch.num_rows) + bias
            yield batch, 1.0 / (1.0 + np.exp(-np.clip(total, -35, 35)))


def toxicity_scores(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], bits: int = BITS) -> DataFrame:
    """(doc_id, score) of every whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, score in scored(batches, sent.value, bits):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    return id_text(docs).mapInArrow(run, "doc_id long, score double")


def drop_toxic(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], threshold: float = 0.5, bits: int = BITS) -> DataFrame:
    """The documents that score below the threshold, with their columns as they came."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, score in scored(batches, sent.value, bits):
            yield batch.filter(pa.array(score < threshold))

    return docs.mapInArrow(run, docs.schema)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scores = toxicity_scores(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scores.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
