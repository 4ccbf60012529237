"""Suffix-array deduplication of long byte strings that documents share.

A byte is removed if a string of ``size`` (50) bytes that covers it also
starts in a document with a smaller doc_id.  Texts are UTF-8 bytes, matches
stay inside documents, strings are judged on the input.

Only suffixes that can matter are sorted.  Of the 16-byte strings inside a
window of 50 bytes the one with the smallest hash is the window's anchor;
equal windows have equal anchors, and neighbouring windows mostly share one.
A stretch of windows with one anchor travels as one record.  Records are
range-partitioned by the leading bytes of the suffix at their anchor, between
splitters taken from a bounded sample.  A bucket sorts its suffixes by
multikey quicksort, eight bytes at a time, keeps the groups of equal anchors
that hold two documents or more, and compares all their windows: by a 64-bit
hash, then byte by byte.  Splitters are no longer than an anchor, so equal
anchors never lie on two sides of a boundary and nothing is lost there.

Before the shuffle a task keeps of every repeated stretch the occurrences in
the smallest document it has seen; the others are removed on the spot.  So a
passage that a third of all documents hold crosses the network once per task.
Buckets hold packed records, about as many as the session has shuffle
partitions.

A phrase shorter than a window, in many documents with other words around it,
makes as many different records with one anchor.  Anchors are counted in a
pass of their own; those of more than ``hot`` records (and 16 a task) are not
sorted as suffixes.  Their windows are compared in the task first, and the ones
left go out one by one, to buckets by the hash of all their bytes.  So no bucket
grows with how often an anchor occurs.

Defined results: null text is empty.  Texts shorter than ``size`` lose
nothing.  Rows with the same doc_id are one document to the rule (no string is
removed for being in the other row) and are answered row by row with all that
is removed from either.  Rows with a null id neither give nor lose strings.
An empty table gives no rows.  Other columns are passed through untouched by
``strip_repeats`` and not read otherwise.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import flat, fresh, id_text, partitions, slices, stored, table
from .words import same_bytes

ANCHOR = 16
SAMPLE_DOCS, SAMPLE_KEYS = 1000, 64  # splitters: at most so many documents, and anchors of each
CHUNK = 2 << 20                      # bytes of text, or of records, that are worked on at once
REPEATED = 1 << 19                   # repeated stretches a task remembers
HOT = 1 << 15                        # records that an anchor's group may have, about
SEEN, CELLS = 16, 1 << 22            # records of an anchor in a task that are told; counters of a task
SPREAD = 1 << 14                     # records whose windows are sent one by one, at once
_M = np.uint64(0x9E3779B97F4A7C15)
_I = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    got = _powers.get(int(base))
    if got is None or len(got) < n:
        p = np.full(max(n, CHUNK + 1), base, np.uint64)
        p[0] = 1
        got = _powers[int(base)] = np.multiply.accumulate(p)
    return got[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def eights(buf: np.ndarray) -> np.ndarray:
    """The 8 bytes from every position on, first byte highest (zeros beyond the end)."""
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    return np.ndarray((len(buf),), ">u8", padded, strides=(1,))


def range_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of buf[start:end] for many ranges, from prefix sums of byte * M**-i."""
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * powers(_I, len(buf)), out=sums[1:])
    return mix((sums[end] - sums[start]) * powers(_M, len(buf) + 1)[start])


def anchor_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(mix(a * np.uint64(0xC2B2AE3D27D4EB4F)) + b * np.uint64(0x165667B19E3779F9))


def anchor_hashes(buf: np.ndarray) -> np.ndarray:
    """Hash of the ANCHOR bytes from every position on."""
    u = eights(buf).astype(np.uint64)
    return anchor_hash(u[:-8], u[8:])[:len(buf) - ANCHOR + 1]


def cells(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(CELLS - 1)).astype(np.int64)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:len(x) - (width - span)], x[width - span:]) if span < width else x


def heads(buf: np.ndarray, offs: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hashes of all positions, smallest one of the window from every position on, first window of every
    stretch of windows with one anchor, windows that lie in one text)."""
    h = anchor_hashes(buf)
    low = sliding_min(h, size - ANCHOR + 1)
    n = len(low)
    ok = np.ones(n + 1, bool)
    for a, b in zip(np.maximum(offs[1:-1] - size + 1, offs[:-2]).tolist(), offs[1:-1].tolist()):
        ok[a:b] = False  # windows that would reach into the next text
    ok[n] = False
    head = ok[:n].copy()
    head[1:] &= ~ok[:n - 1] | (low[1:] != low[:-1])
    return h, low, np.flatnonzero(head), ok[:n]


def stretches(buf: np.ndarray, offs: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first window, windows, anchor's place in the stretch) of every stretch of windows with one anchor."""
    none = np.zeros(0, np.int64)
    if len(buf) < size:
        return none, none, none, none
    width = size - ANCHOR + 1
    h, low, first, ok = heads(buf, offs, size)
    n = len(low)
    if not len(first):
        return none, none, none, none
    head = np.zeros(n, bool)
    head[first] = True
    edge = np.flatnonzero(head | ~ok)  # a stretch ends where the next begins or windows stop
    nxt = np.searchsorted(edge, first, "right")
    last = np.append(edge, n)[nxt]
    place = np.empty(len(first), np.int64)
    steps = np.arange(width)
    for i in range(0, len(first), 1 << 16):
        f = first[i:i + (1 << 16)]
        place[i:i + (1 << 16)] = (h[f[:, None] + steps] == low[f][:, None]).argmax(axis=1)
    return np.searchsorted(offs, first, "right") - 1, first, last - first, place


def gather(buf: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """buf[start:start + length] of many ranges, end to end."""
    to = np.cumsum(length) - length
    return buf[np.arange(length.sum()) + np.repeat(start - to, length)]


def multikey_groups(tokens: list[Callable[[np.ndarray], np.ndarray]], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Multikey sort: (order, group of each sorted row).  Rows are ordered by the first token;
    only rows that still tie are ordered by the next."""
    order = np.argsort(tokens[0](np.arange(n)), kind="stable")
    key = tokens[0](order)
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    for token in tokens[1:]:
        group = np.cumsum(new)
        tied = np.zeros(n, bool)
        tied[1:] = ~new[1:]
        tied[:-1] |= ~new[1:]
        at = np.flatnonzero(tied)
        k = token(order[at])
        by = np.lexsort((k, group[at]))
        order[at] = order[at][by]
        k = k[by]
        new[at[1:]] |= (k[1:] != k[:-1]) & (group[at][1:] == group[at][:-1])
    return order, np.cumsum(new) - 1


def doc_group(ids: np.ndarray, groups: int) -> np.ndarray:
    return (ids ^ (ids >> 9) ^ (ids >> 21)) % groups


def doc_group_column(id_col: str, groups: int, null: int | None = 0):
    """The same in Spark; ``null`` is the group of rows without an id."""
    i = F.col(id_col).cast("long")
    of = F.pmod(i.bitwiseXOR(F.shiftright(i, 9)).bitwiseXOR(F.shiftright(i, 21)), F.lit(groups).cast("long"))
    return of if null is None else F.coalesce(of, F.lit(null).cast("long"))


SHAPE = "bucket long, kind int, grp long, n long, payload binary"
NAMES = ["bucket", "kind", "grp", "n", "payload"]


def rows_of(bucket, kind, grp, n, payload) -> pa.RecordBatch:
    kinds = pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((bucket, kind, grp, n, payload), kinds)], NAMES)


def span_rows(doc: np.ndarray, start: np.ndarray, end: np.ndarray, groups: int, buckets: int) -> pa.RecordBatch | None:
    """Removed runs, packed by group of documents (kind 1)."""
    if not len(doc):
        return None
    grp = doc_group(doc, groups)
    order = np.lexsort((start, doc, grp))
    grp, doc, start, end = grp[order], doc[order], start[order].astype(np.int32), end[order].astype(np.int32)
    cut = np.append(np.flatnonzero(np.concatenate([[True], grp[1:] != grp[:-1]])), len(grp))
    z = zstandard.ZstdCompressor(level=3)
    data = [z.compress(doc[a:b].tobytes() + start[a:b].tobytes() + end[a:b].tobytes()) for a, b in zip(cut[:-1], cut[1:])]
    g = grp[cut[:-1]]
    return rows_of((g % buckets).tolist(), [1] * len(g), g.tolist(), np.diff(cut).tolist(), data)


class Splitters:
    """Buckets by the first 16 bytes of a suffix."""

    def __init__(self, keys: list[tuple[int, int]], buckets: int):
        keys = sorted(keys)
        cut = sorted({keys[len(keys) * i // buckets] for i in range(1, buckets)}) if keys else []
        self.a, self.b = np.array([k[0] for k in cut], np.uint64), np.array([k[1] for k in cut], np.uint64)

    def bucket(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        lo, hi = np.searchsorted(self.a, a, "left"), np.searchsorted(self.a, a, "right")
        for v in np.unique(a[lo < hi]):  # splitters that share their first 8 bytes with the suffix
            at = np.flatnonzero(a == v)
            lo[at] += np.searchsorted(self.b[lo[at[0]]:hi[at[0]]], b[at], "right")
        return lo


def _splitters(docs: DataFrame, size: int, buckets: int) -> Splitters:
    ids = docs.select("doc_id").where("doc_id is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS).distinct()

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, max_bytes=CHUNK):
                buf, offs = flat(batch.column("text"))
                text, first, _, place = stretches(buf, offs, size)
                if not len(text):
                    continue
                u, at = eights(buf), first + place
                n = np.bincount(text)[text]
                nth = np.arange(len(text)) - np.searchsorted(text, text, "left")
                at = at[nth % np.maximum(n // SAMPLE_KEYS, 1) == 0]
                yield pa.RecordBatch.from_arrays([pa.array(u[at].astype(np.uint64).view(np.int64)), pa.array(u[at + 8].astype(np.uint64).view(np.int64))], ["a", "b"])

    found = docs.join(F.broadcast(ids), "doc_id", "left_semi").mapInArrow(keys, "a long, b long").toPandas()  # some 100,000 pairs at most
    return Splitters([(int(a) % 2**64, int(b) % 2**64) for a, b in zip(found["a"], found["b"])], buckets)


def _hot(docs: DataFrame, size: int, most: int) -> np.ndarray:
    """Cells of the anchors with more than ``most`` records (and SEEN a task); at most one in most / 2 of all records."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(CELLS, np.int32)
        for whole in batches:
            whole = whole.filter(whole.column("doc_id").is_valid())
            for batch in slices(whole, max_bytes=CHUNK):
                buf, offs = flat(batch.column("text"))
                if len(buf) >= size:
                    _, low, first, _ = heads(buf, offs, size)
                    np.add.at(n, cells(low[first]), 1)
        at = np.flatnonzero(n >= max(min(SEEN, most), 8 * n.mean()))  # the mean: many anchors share a counter
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(n[at], pa.int64())], ["cell", "n"])

    found = docs.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).where(F.col("n") > most)
    return np.sort(found.select("cell").toPandas()["cell"].to_numpy(np.int64))


def runs(rec: np.ndarray, window: np.ndarray, doc: np.ndarray, start: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, first byte, byte after the last) of every run of windows (record, window) that follow each other."""
    new = np.ones(len(rec), bool)
    new[1:] = (rec[1:] != rec[:-1]) | (window[1:] != window[:-1] + 1)
    a = np.flatnonzero(new)
    b = np.append(a[1:], len(rec)) - 1
    return doc[rec[a]], start[rec[a]] + window[a], start[rec[b]] + window[b] + size


class Memory:
    """Stretches that a task has met more than once: hash, smallest document, bytes."""

    def __init__(self):
        self.hash, self.owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.start, self.size, self.blob = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8)

    def smaller(self, h: np.ndarray, doc: np.ndarray, buf: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether a document smaller than its own is known, here or from before, to hold the bytes of each stretch.
        Hashes find it and bytes decide; a stretch of another's hash goes on as if new."""
        order = np.lexsort((doc, h))
        hs = h[order]
        cut = np.flatnonzero(np.concatenate([[True], hs[1:] != hs[:-1]]))
        n = np.diff(np.append(cut, len(hs)))
        one = order[cut]  # of each hash, the stretch of the smallest document
        of = np.empty(len(h), np.int64)
        of[order] = np.repeat(np.arange(len(cut)), n)
        like = np.zeros(len(h), bool)
        at = np.flatnonzero(n[of] > 1)
        r = one[of[at]]
        like[at] = same_bytes(buf, first[at], length[at], buf, first[r], length[r], None)
        own = like & (doc > doc[one][of])
        least = doc[one].copy()
        if len(self.hash):
            k = np.minimum(np.searchsorted(self.hash, hs[cut]), len(self.hash) - 1)
            hit = np.flatnonzero(self.hash[k] == hs[cut])
            k, s = k[hit], one[hit]
            same = same_bytes(buf, first[s], length[s], self.blob, self.start[k], self.size[k], None)
            hit, k = hit[same], k[same]
            least[hit] = np.minimum(least[hit], self.owner[k])
            before = np.full(len(cut), np.iinfo(np.int64).max)
            before[hit] = self.owner[k]
            self.owner[k] = least[hit]
            like[one] = True
            own |= like & (doc > before[of])
        if (n > 1).any():
            self._add(hs[cut][n > 1], least[n > 1], buf, first[one[n > 1]], length[one[n > 1]].astype(np.int64))
        return own

    def _add(self, h: np.ndarray, owner: np.ndarray, buf: np.ndarray, first: np.ndarray, size: np.ndarray) -> None:
        """Remember stretches by their (ordered) hashes, until the memory is full: a smaller one only ships more."""
        k = np.searchsorted(self.hash, h)
        new = np.flatnonzero((k == len(self.hash)) | (self.hash[np.minimum(k, len(self.hash) - 1)] != h) if len(self.hash) else np.ones(len(h), bool))
        new = new[:max(REPEATED - len(self.hash), 0)]
        start = len(self.blob) + np.cumsum(size[new]) - size[new]
        self.blob = np.concatenate([self.blob, gather(buf, first[new], size[new])])
        self.hash, self.owner = np.concatenate([self.hash, h[new]]), np.concatenate([self.owner, owner[new]])
        self.start, self.size = np.concatenate([self.start, start]), np.concatenate([self.size, size[new]])
        by = np.argsort(self.hash, kind="stable")
        self.hash, self.owner, self.start, self.size = self.hash[by], self.owner[by], self.start[by], self.size[by]


def _records(splitters: Splitters, size: int, groups: int, buckets: int, hot: np.ndarray):
    """Texts to packed records by bucket (kind 0), windows of hot anchors by bucket (kind 2), and what a task can
    remove itself (kind 1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=3)
        memory = Memory()
        held: dict[tuple[int, int], list] = {}
        weight = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal weight
            for kind, b in sorted(held):
                cols = [np.concatenate(c) for c in zip(*held[kind, b])]
                yield rows_of([b], [kind], [None], [len(cols[0])], [z.compress(b"".join(c.tobytes() for c in cols))])
            held.clear()
            weight = 0

        def spread(buf: np.ndarray, doc: np.ndarray, first: np.ndarray, start: np.ndarray, length: np.ndarray) -> Iterator[pa.RecordBatch]:
            nonlocal weight
            n = length.astype(np.int64)
            blob = gather(buf, first, n)
            rec, window = repeated_windows(doc, n, blob, size)
            if len(rec):
                yield span_rows(*runs(rec, window, doc, start, size), groups, buckets)
            w = n - size + 1
            to = np.cumsum(w) - w
            stay = np.ones(w.sum(), bool)
            stay[to[rec] + window] = False  # a smaller document here has them
            owner = np.repeat(np.arange(len(n)), w)[stay]
            nth = np.flatnonzero(stay) - to[owner]
            s = (np.cumsum(n) - n)[owner] + nth
            bucket = buckets + (range_hashes(blob, s, s + size) % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            edge = np.append(np.flatnonzero(np.diff(bucket[by], prepend=-1)), len(by))
            windows = np.lib.stride_tricks.sliding_window_view(blob, size)
            for a, b in zip(edge[:-1], edge[1:]):
                k = by[a:b]
                held.setdefault((2, int(bucket[k[0]])), []).append(
                    (doc[owner[k]], (start[owner[k]] + nth[k]).astype(np.int32), np.full(len(k), size, np.int32), np.zeros(len(k), np.uint8), windows[s[k]].ravel()))
                weight += size * len(k)
            if weight > 24 * CHUNK:
                yield from flush()

        for whole in batches:
            whole = whole.filter(whole.column("doc_id").is_valid())
            for batch in slices(whole, max_bytes=CHUNK):
                buf, offs = flat(batch.column("text"))
                ids = batch.column("doc_id").to_numpy()
                text, first, windows, place = stretches(buf, offs, size)
                if not len(text):
                    continue
                doc, length = ids[text], windows + size - 1
                h = mix(range_hashes(buf, first, first + length) + length.astype(np.uint64))
                own = memory.smaller(h, doc, buf, first, length)  # a smaller document of this task has the whole stretch
                out = span_rows(doc[own], (first - offs[text])[own], (first - offs[text] + length)[own], groups, buckets)
                if out is not None:
                    yield out
                u = eights(buf)
                rest = np.flatnonzero(~own)
                at = (first + place)[rest]
                a, b = u[at].astype(np.uint64), u[at + 8].astype(np.uint64)
                if len(hot):
                    often = np.isin(cells(anchor_hash(a, b)), hot)
                    k = rest[often]
                    for i in range(0, len(k), SPREAD):
                        j = k[i:i + SPREAD]
                        yield from spread(buf, doc[j], first[j], (first - offs[text])[j], length[j])
                    rest, a, b = rest[~often], a[~often], b[~often]
                bucket = splitters.bucket(a, b)
                by = np.argsort(bucket, kind="stable")
                keep = rest[by]
                bucket = bucket[by]
                edge = np.append(np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])), len(bucket)) if len(bucket) else []
                for a, b in zip(edge[:-1], edge[1:]):
                    k = keep[a:b]
                    blob = gather(buf, first[k], length[k])
                    held.setdefault((0, int(bucket[a])), []).append(
                        (doc[k], (first - offs[text])[k].astype(np.int32), length[k].astype(np.int32), place[k].astype(np.uint8), blob))
                    weight += len(blob)
                if weight > 24 * CHUNK:
                    yield from flush()
        yield from flush()

    return run


def unpack(payload: bytes, n: int) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(payload)
    out, at = [], 0
    for kind, width in ((np.int64, 8), (np.int32, 4), (np.int32, 4), (np.uint8, 1)):
        out.append(np.frombuffer(raw, kind, n, at))
        at += width * n
    return [*out, np.frombuffer(raw, np.uint8, offset=at)]


def repeated_windows(doc: np.ndarray, length: np.ndarray, blob: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(record, window) of every window whose bytes a record of a smaller document holds too."""
    end = np.cumsum(length)
    begin = end - length
    hashes, owners, starts = [], [], []
    i = 0
    while i < len(doc):  # by runs of records, so that prefix sums stay small
        j = max(i + 1, int(np.searchsorted(end, begin[i] + CHUNK, "right")))
        w = length[i:j] - size + 1
        s = np.arange(w.sum()) + np.repeat(begin[i:j] - begin[i] - (np.cumsum(w) - w), w)
        hashes.append(range_hashes(blob[begin[i]:end[j - 1]], s, s + size))
        owners.append(np.repeat(np.arange(i, j, dtype=np.int32), w))
        starts.append(s + begin[i])
        i = j
    h, owner, start = np.concatenate(hashes), np.concatenate(owners), np.concatenate(starts)
    order = np.argsort(h, kind="stable")
    hs = h[order]
    del h, hashes
    new = np.ones(len(hs), bool)
    new[1:] = hs[1:] != hs[:-1]
    cut = np.flatnonzero(new)
    run = np.cumsum(new) - 1
    d = doc[owner[order]]
    least = np.minimum.reduceat(d, cut)
    hit = d > least[run]
    # byte by byte against an occurrence in the smallest document
    source = np.empty(len(cut), np.int64)
    is_least = np.flatnonzero(~hit)
    source[run[is_least]] = start[order[is_least]]
    at, r = order[hit], run[hit]
    same = np.ones(len(at), bool)
    u = eights(blob)
    for o in [*range(0, size - 7, 8), size - 8]:
        same &= u[start[at] + o] == u[source[r] + o]
    if not same.all():  # strings that only share a hash: take the run apart by content
        found = [at[same & ~np.isin(r, r[~same])]]
        for x in np.unique(r[~same]):
            rows = order[run == x]
            low: dict[bytes, int] = {}
            text = {int(k): blob[start[k]:start[k] + size].tobytes() for k in rows}
            for k in rows:
                t = text[int(k)]
                low[t] = min(low.get(t, doc[owner[k]]), doc[owner[k]])
            found.append(np.array([k for k in rows if doc[owner[k]] > low[text[int(k)]]], np.int64))
        at = np.concatenate(found)
    at = np.sort(at)
    return owner[at].astype(np.int64), start[at] - begin[owner[at]]


def _bucket(size: int, groups: int, buckets: int):
    def run(t: pa.Table) -> pa.Table:
        shape = pa.schema([("grp", pa.int64()), ("n", pa.int64()), ("payload", pa.binary())])
        out = [t.filter(pa.compute.equal(t.column("kind"), 1)).select(["grp", "n", "payload"]).cast(shape)]
        alone = t.filter(pa.compute.equal(t.column("kind"), 2))
        if alone.num_rows:  # windows of hot anchors, grouped by all their bytes
            parts = [unpack(p, n) for p, n in zip(alone.column("payload").to_pylist(), alone.column("n").to_pylist())]
            doc, start, _, _, blob = (np.concatenate(c) for c in zip(*parts))
            del parts
            u, begin = eights(blob), np.arange(len(doc)) * size
            order, group = multikey_groups([lambda i, o=o: u[begin[i] + o].astype(np.uint64) for o in [*range(0, size - 7, 8), size - 8]], len(doc))
            d = doc[order]
            least = np.minimum.reduceat(d, np.flatnonzero(np.diff(group, prepend=-1)))
            gone = order[d > least[group]]
            spans = span_rows(doc[gone], start[gone], start[gone] + size, groups, buckets)
            if spans is not None:
                out.append(pa.Table.from_batches([spans]).select(["grp", "n", "payload"]).cast(shape))
            del blob, u
        recs = t.filter(pa.compute.equal(t.column("kind"), 0))
        if recs.num_rows:
            found: list[tuple] = []
            parts = [unpack(p, n) for p, n in zip(recs.column("payload").to_pylist(), recs.column("n").to_pylist())]
            doc, start, length, place, blob = (np.concatenate(c) for c in zip(*parts))
            del parts
            begin = np.cumsum(length, dtype=np.int64) - length
            u, suffix = eights(blob), begin + place
            order, group = multikey_groups([lambda i: u[suffix[i]].astype(np.uint64), lambda i: u[suffix[i] + 8].astype(np.uint64)], len(doc))
            del u, suffix
            cut = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            d = doc[order]
            two = np.minimum.reduceat(d, cut) < np.maximum.reduceat(d, cut)
            keep = order[two[group]]
            edge = np.append(np.flatnonzero(np.diff(group[two[group]], prepend=-1)), len(keep))  # where groups of anchors begin
            weight = np.concatenate([[0], np.cumsum(length[keep], dtype=np.int64)])[edge]
            i = 0
            while i < len(edge) - 1:  # equal windows lie in one group, so groups can be taken a few at a time
                j = max(i + 1, int(np.searchsorted(weight, weight[i] + CHUNK, "right")) - 1)
                k = keep[edge[i]:edge[j]]
                i = j
                n = length[k].astype(np.int64)
                rec, window = repeated_windows(doc[k], n, gather(blob, begin[k], n), size)
                if len(rec):
                    found.append(runs(rec, window, doc[k], start[k], size))
            if found:
                spans = span_rows(*(np.concatenate(c) for c in zip(*found)), groups, buckets)
                out.append(pa.Table.from_batches([spans]).select(["grp", "n", "payload"]).cast(shape))
        return pa.concat_tables(out)

    return run


@contextmanager
def _shuffles_end(spark: SparkSession):
    """Shuffle files of the query inside go when it ends; its result is stored."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    try:
        before = spark.conf.get(key)
    except Exception:  # an older Spark without the setting
        yield
        return
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def removed_spans(docs: DataFrame, size: int = 50, groups: int | None = None, hot: int = HOT) -> DataFrame:
    """(grp, n, payload): packed removed runs (doc_id, first byte, byte after the last), overlaps not merged."""
    spark = docs.sparkSession
    rows = id_text(docs)
    groups = groups or partitions(spark)
    buckets = 3 * groups
    splitters = _splitters(rows, size, buckets)
    with _shuffles_end(spark):
        return stored(
            rows.mapInArrow(_records(splitters, size, groups, buckets, _hot(rows, size, hot)), SHAPE)
            .groupBy("bucket").applyInArrow(_bucket(size, groups, buckets), "grp long, n long, payload binary"),
            "suffix-spans")


def _kept(text: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mask of the bytes that stay."""
    edge = np.zeros(len(text) + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, end, -1)
    return np.cumsum(edge[:-1]) == 0


def _apply(docs: DataFrame, size: int, answer: Callable[[pa.Table, list[tuple[bytes, np.ndarray]]], pa.Table], schema, hot: int = HOT) -> DataFrame:
    """Bring documents and their removed runs together by group; ``answer`` makes the rows of a group."""
    groups, grp = partitions(docs.sparkSession), fresh(docs, "group_of")
    spans = removed_spans(docs, size, groups, hot)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.drop_columns([grp])
        raw = [zstandard.ZstdDecompressor().decompress(p) for p in right.column("payload").to_pylist()]
        n = right.column("n").to_pylist()
        doc = np.concatenate([np.frombuffer(r, np.int64, k) for r, k in zip(raw, n)]) if n else np.zeros(0, np.int64)
        start = np.concatenate([np.frombuffer(r, np.int32, k, 8 * k) for r, k in zip(raw, n)]) if n else np.zeros(0, np.int32)
        end = np.concatenate([np.frombuffer(r, np.int32, k, 12 * k) for r, k in zip(raw, n)]) if n else np.zeros(0, np.int32)
        by = np.argsort(doc, kind="stable")
        doc, start, end = doc[by], start[by], end[by]
        ids = left.column("doc_id").to_pylist()
        lo = np.searchsorted(doc, [i if i is not None else 0 for i in ids], "left").tolist()
        hi = np.searchsorted(doc, [i if i is not None else 0 for i in ids], "right").tolist()
        buf, offs = flat(left.column("text"))
        kept = []
        for k, i in enumerate(ids):
            text = buf[offs[k]:offs[k + 1]]
            a, b = (lo[k], hi[k]) if i is not None else (0, 0)
            s, e = start[a:b], end[a:b]
            inside = e <= len(text)  # rows that share an id may differ in length
            kept.append((text.tobytes(), _kept(text, s[inside], e[inside]) if inside.any() else None))
        return answer(left, kept)

    # texts without an id have no runs: spread by their bytes
    of = F.coalesce(doc_group_column("doc_id", groups, None), F.pmod(F.xxhash64("text"), F.lit(groups)))
    return (docs.withColumn(grp, of).groupBy(grp)
            .cogroup(spans.withColumnRenamed("grp", grp).groupBy(grp)).applyInArrow(run, schema))


def suffix_digests(docs: DataFrame, size: int = 50, hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    def answer(left: pa.Table, kept: list) -> pa.Table:
        rows = []
        for text, mask in kept:
            if mask is None:
                rows.append((len(text), 0, 0, hashlib.sha256(text).hexdigest()))
                continue
            gone = ~mask
            spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
            rows.append((len(text), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(text, np.uint8)[mask].tobytes()).hexdigest()))
        cols = list(zip(*rows)) or [(), (), (), ()]
        kinds = pa.int64(), pa.int64(), pa.int64(), pa.string()
        return pa.Table.from_arrays([left.column("doc_id"), *(pa.array(c, t) for c, t in zip(cols, kinds))],
                                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return _apply(id_text(docs), size, answer, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", hot)


def strip_repeats(docs: DataFrame, size: int = 50) -> DataFrame:
    """The documents with repeated bytes taken out of their text and n_chars set anew,
    other columns as they came.  A character goes only if all its bytes do."""
    def answer(left: pa.Table, kept: list) -> pa.Table:
        texts = []
        for text, mask in kept:
            if mask is not None:
                b = np.frombuffer(text, np.uint8)
                lead = np.flatnonzero((b & 0xC0) != 0x80)  # first bytes of characters
                stay = np.maximum.reduceat(mask, lead)
                text = b[np.repeat(stay, np.diff(np.append(lead, len(b))))].tobytes()
            texts.append(text.decode())
        cols = {"text": pa.array(texts, pa.string()), "n_chars": pa.array(map(len, texts), pa.int64())}
        return pa.Table.from_arrays([cols.get(c, left.column(c)).cast(left.schema.field(c).type) for c in left.column_names], left.column_names)

    return _apply(docs, size, answer, docs.schema)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes that 50-byte strings of smaller documents cover."""
    return suffix_digests(table(spark, sf_dir, "documents"), 50)
