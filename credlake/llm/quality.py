"""Quality: a linear-chain conditional random field over the lines of a text.

Every line is good or bad.  A line's features are those of its own and of the
two lines around it (0 beyond the ends); neighbouring labels are tied by
transition weights.  The marginal P(good) of each line comes from
forward-backward over the whole text.  Their mean m, weighted by line length
in bytes, is the document's quality; the score is m on a probability scale,
by a logistic curve in m fitted on the same sample.

Lines take the label of their document for learning.  Fitting reads a bounded
sample: the ``sample`` labelled rows with the smallest hashes of their ids
(4,000 at most by default), brought together in one task.  Scoring reads every
whole text where it lies, without a shuffle; a very long line is one line.

Defined results: null text is empty; an empty text is one empty line.  Empty
lines count one byte.  Null labels are not learned from; of several labels for
an id the larger counts.  With no labelled rows every score is 0.5.  Repeated
rows score alike.  An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import flat, held_out, id_text, slices, table
from .toxicity import labelled_sample

SAMPLE = 4_000
_UPPER = bytes(range(65, 91))
_LETTER = bytes([*range(65, 91), *range(97, 123), *range(128, 256)])
_DIGIT = b"0123456789"
_PLAIN = b".,;:!?'\"()- \t\r"
OWN = 12  # features of a line by itself


def _line(b: bytes, times: int) -> tuple:
    """Features of one line, each between 0 and about 1."""
    n = len(b)
    words = b.split()
    k = len(words)
    if not k:
        return (0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0)
    letters = n - len(b.translate(None, _LETTER))
    upper = n - len(b.translate(None, _UPPER))
    digits = n - len(b.translate(None, _DIGIT))
    odd = len(b.translate(None, _LETTER + _DIGIT + _PLAIN))
    twins = sum(map(bytes.__eq__, words, words[1:]))
    bangs = b.count(b"!")
    return (
        min(upper / max(letters, 1), 1.0),
        min(4.0 * odd / n, 1.0),
        digits / n,
        min(bangs / k, 1.0),
        twins / k,
        1.0 - len(set(words)) / k,
        min(b.count(b"|") * 3.0 / k, 1.0),
        min(letters / (12.0 * k), 1.0),
        min(math.log1p(k) / 6.0, 1.0),
        1.0 if b[-1:] in b".!?" else 0.0,
        0.0,
        min(times - 1, 4) / 4.0,
    )


def line_features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(lines x features with neighbours and a constant, length of each line in bytes)."""
    lines = text.split(b"\n")
    seen = Counter(lines)
    own = np.array([_line(b, seen[b]) for b in lines])
    pad = np.zeros((1, OWN))
    x = np.hstack([own, np.vstack([pad, own[:-1]]), np.vstack([own[1:], pad]), np.ones((len(own), 1))])
    return x, np.array([max(len(b), 1) for b in lines], float)


def marginals(s: list[float], a: list[float]) -> tuple[list[float], float, list[float]]:
    """Forward-backward of a two-label chain.  s: score of good for each line (bad: 0);
    a: transition scores bad-bad, bad-good, good-bad, good-good.
    Returns P(good) of each line, log Z, and the expected count of each transition."""
    t00, t01, t10, t11 = map(math.exp, a)
    n = len(s)
    e = [math.exp(max(-30.0, min(30.0, x))) for x in s]
    f, norm, logz = [], [], 0.0
    p0, p1 = 1.0, e[0]
    for i in range(n):
        if i:
            q0, q1 = f[-1]
            p0, p1 = q0 * t00 + q1 * t10, (q0 * t01 + q1 * t11) * e[i]
        c = p0 + p1
        f.append((p0 / c, p1 / c))
        norm.append(c)
        logz += math.log(c)
    good = [0.0] * n
    good[-1] = f[-1][1]
    b0 = b1 = 1.0
    c00 = c01 = c10 = c11 = 0.0
    for i in range(n - 2, -1, -1):
        (q0, q1), g1, c = f[i], e[i + 1] * b1, norm[i + 1]
        g0 = b0
        c00 += q0 * t00 * g0 / c
        c01 += q0 * t01 * g1 / c
        c10 += q1 * t10 * g0 / c
        c11 += q1 * t11 * g1 / c
        b0, b1 = (t00 * g0 + t01 * g1) / c, (t10 * g0 + t11 * g1) / c
        good[i] = q1 * b1
    return good, logz, [c00, c01, c10, c11]


def fit_chain(docs: list[tuple[np.ndarray, np.ndarray, int]], steps: int = 60, rate: float = 0.3, l2: float = 1e-3):
    """Maximum conditional likelihood by AdaGrad over whole-sample gradients; each document
    weighs one, its lines by their length.  Returns (emission weights, transitions)."""
    if not docs:
        return np.zeros(3 * OWN + 1), np.zeros(4)
    dim = docs[0][0].shape[1]
    w, a = np.zeros(dim), np.zeros(4)
    hw, ha = np.full(dim, 1e-8), np.full(4, 1e-8)
    x = np.vstack([d[0] for d in docs])
    cut = np.cumsum([0] + [len(d[0]) for d in docs])
    weight = np.concatenate([d[1] / d[1].sum() for d in docs])
    target = np.repeat([float(d[2]) for d in docs], np.diff(cut))
    for _ in range(steps):
        s = (x @ w).tolist()
        tr = a.tolist()
        good, ga = np.empty(len(x)), np.zeros(4)
        for (lo, hi), d in zip(zip(cut[:-1], cut[1:]), docs):
            g, _, c = marginals(s[lo:hi], tr)
            good[lo:hi] = g
            n = hi - lo - 1
            if n:
                ga += np.array([(n if d[2] == 0 else 0) - c[0], -c[1], -c[2], (n if d[2] else 0) - c[3]]) / n
        gw = x.T @ ((target - good) * weight) / len(docs) - l2 * w
        ga = ga / len(docs) - l2 * a
        hw += gw * gw
        ha += ga * ga
        w += rate * gw / np.sqrt(hw)
        a += rate * ga / np.sqrt(ha)
    return w, a


def fit_curve(m: np.ndarray, y: np.ndarray, steps: int = 30, l2: float = 1e-2) -> np.ndarray:
    """Slope and offset of the logistic curve from mean marginal to P(good), by Newton's method."""
    x, p = np.column_stack([m, np.ones(len(m))]), np.zeros(2)
    for _ in range(steps):
        q = 1.0 / (1.0 + np.exp(-np.clip(x @ p, -30, 30)))
        h = (x * (q * (1 - q))[:, None]).T @ x + l2 * np.eye(2)
        p += np.clip(np.linalg.solve(h, x.T @ (y - q) - l2 * p), -4, 4)
    return p


def mean_marginal(x: np.ndarray, size: np.ndarray, w: np.ndarray, a: list[float]) -> tuple[float, np.ndarray]:
    good = np.array(marginals((x @ w).tolist(), a)[0])
    return float(good @ size / size.sum()), good


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(emission weights, transitions, curve), fitted in one task on at most ``sample`` documents."""
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [r for b in batches for r in zip(b.column("doc_id").to_pylist(), b.column("y").to_pylist(), b.column("text").to_pylist())]
        got.sort(key=lambda r: (r[0], r[2]))
        if not got:
            return
        rows = [(*line_features(t.encode()), int(y > 0)) for _, y, t in got]
        w, a = fit_chain(rows)
        m = np.array([mean_marginal(x, size, w, a.tolist())[0] for x, size, _ in rows])
        curve = fit_curve(m, np.array([float(y) for _, _, y in rows]))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([w, a, curve]))], ["w"])

    p = labelled_sample(docs, labels, "quality", sample).repartition(1).mapInArrow(learn, "w double").toPandas()["w"].to_numpy()
    return (p[:-6], p[-6:-2], p[-2:]) if len(p) else (np.zeros(3 * OWN + 1), np.zeros(4), np.zeros(2))


def quality_scores(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """(doc_id, score, n_lines, n_bad): P(document is good), its lines, and lines labelled bad."""
    w, a, (slope, offset) = model
    tr = a.tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                buf, offs = flat(batch.column("text"))
                raw, out = buf.tobytes(), []
                for lo, hi in zip(offs[:-1].tolist(), offs[1:].tolist()):
                    x, size = line_features(raw[lo:hi])
                    m, good = mean_marginal(x, size, w, tr)
                    out.append((1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, slope * m + offset)))), len(good), int((good < 0.5).sum())))
                cols = [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.float64(), pa.int64(), pa.int64()))]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *cols], ["doc_id", "score", "n_lines", "n_bad"])

    return id_text(docs).mapInArrow(run, "doc_id long, score double, n_lines long, n_bad long")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scores = quality_scores(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scores.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "n_lines", "n_bad")
