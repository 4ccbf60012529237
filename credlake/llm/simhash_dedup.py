"""SimHash near-deduplication by anchor-point covering.

Fingerprint: 64 bits; a bit is 1 if it is set in over half of the XXH64
hashes of a text's word shingles.  Two fingerprints link at max_bits or fewer
differing bits; documents fall into the components of these links.

Candidates come from covering codes.  The 64 bits are split into blocks; of
``max_bits`` differing bits, at least one block holds at most
t = max_bits // blocks.  Within a block the anchors are the words of a
covering code of radius 1: a Hamming word of 15 bits with the remaining bits
free.  A fingerprint has one home anchor within the covering radius in every
block, and is replicated to every anchor within radius + t.  If two block
values differ in at most t bits, the home anchor of one is within radius + t
of the other, so both meet there: no link is lost, and there is no cap.  (One
code over all 64 bits would need at least V(64, R+4)/V(64, R) replicas, over
700 at radius 8; three blocks of 21 or 22 bits need about 45.)

Rows meet per anchor: homes are compared with all entries of the anchor.
Distinct fingerprints alone take part, so copies cost nothing; an anchor with
more than ``TILE`` entries is cut into tiles that different tasks compare.
Links are reduced to spanning stars where they are found, so a dense group
gives as many links as it has fingerprints, not its pairs.

Defined results: null text is empty; texts without words have fingerprint
zero and link like any other; texts with fewer words than a shingle hash the
whole sequence.  Repeated rows give repeated results.  An empty table gives
no rows.  Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import flat, fresh, id_text, keep_rows, local_components, partitions, row_hashes, slices, stored, table
from .components import components

HAMMING = 15  # length of the Hamming word in a block: radius 1, 2**11 words
TILE = 4096   # entries of an anchor that one task compares with one another
SEED = 42


def _fingerprint(text: bytes, size: int) -> int:
    words = text.lower().split()
    if not words:
        return 0
    joined, h = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= size:
        return h(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(words) - size + 1
    hashes = np.fromiter((h(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[size - 1:].tolist())), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        bits = np.unpackbits(hashes[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for j in range(0, len(bits), 255):  # sums of 255 fit in a byte: the fast path of numpy
            ones += bits[j:j + 255].sum(axis=0, dtype=np.uint8)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long.  ``carry``: long columns that come along as c0, c1, ..."""
    extra = [f"c{i}" for i in range(len(carry))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                buf, offs = flat(batch.column("text"))
                raw = buf.tobytes()
                fps = np.array([_fingerprint(raw[a:b], shingle) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())], np.uint64)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps.view(np.int64)), *map(batch.column, extra)], ["doc_id", "fp", *extra])

    shape = ", ".join(f"{c} long" for c in ["doc_id", "fp", *extra])
    return id_text(docs, id_col, text_col, dict(zip(extra, carry))).mapInArrow(run, shape)


def _spans(blocks: int) -> list[tuple[int, int]]:
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    return list(zip(cuts[:-1], cuts[1:]))


def _syndromes(x: np.ndarray) -> np.ndarray:
    """Syndrome of the low 15 bits: bit position i stands for the column i + 1."""
    s = np.zeros(len(x), np.uint64)
    for i in range(HAMMING):
        s ^= ((x >> np.uint64(i)) & np.uint64(1)) * np.uint64(i + 1)
    return s


def _flips(n: int, most: int) -> list[int]:
    """All words of n bits with at most ``most`` ones."""
    words = {0}
    for _ in range(most):
        words |= {w | 1 << i for w in words for i in range(n)}
    return sorted(words)


def anchors(fps: np.ndarray, lo: int, hi: int, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index into fps, anchor, whether it is the home anchor) for every anchor of
    the block of bits lo..hi within ``reach`` = radius + t of a fingerprint."""
    part = (fps >> np.uint64(lo)) & np.uint64((1 << (hi - lo)) - 1)
    fix = lambda x: x ^ np.where((s := _syndromes(x)) > 0, np.uint64(1) << (np.maximum(s, 1) - np.uint64(1)), np.uint64(0))
    home = fix(part)
    at, found = [], []
    # the home of a fingerprint within t bits is the home of a word within t = reach - 1 bits of this one;
    # those are the anchors within reach that a home can lie on
    for w in _flips(hi - lo, max(reach - 1, 0)):
        a = fix(part ^ np.uint64(w))
        near = np.bitwise_count(a ^ part) <= reach
        at.append(np.flatnonzero(near))
        found.append(a[near])
    at, found = np.concatenate(at), np.concatenate(found)
    order = np.lexsort((found, at))
    at, found = at[order], found[order]
    first = np.ones(len(at), bool)
    first[1:] = (at[1:] != at[:-1]) | (found[1:] != found[:-1])
    at, found = at[first], found[first]
    return at, found, found == home[at]


def _entries(fps: np.ndarray, max_bits: int, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """(cell, fingerprint): a cell is block, anchor and, in its lowest bit, 1 for a home."""
    cells, out = [], []
    for k, (lo, hi) in enumerate(_spans(blocks)):
        at, anchor, home = anchors(fps, lo, hi, 1 + max_bits // blocks)
        cells.append(np.uint64(k) << np.uint64(56) | anchor << np.uint64(1) | home.astype(np.uint64))
        out.append(fps[at])
    return np.concatenate(cells).view(np.int64), np.concatenate(out).view(np.int64)


def _compare(fp: np.ndarray, home: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of one cell between its homes and all its entries, as spanning stars."""
    u, v = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    homes = fp[home]
    for i in range(0, len(homes), 256):
        h = homes[i:i + 256]
        a, b = np.nonzero(np.bitwise_count(h[:, None] ^ fp[None, :]) <= max_bits)
        a, b = h[a], fp[b]
        other = a != b
        u, v = np.concatenate([u, a[other]]), np.concatenate([v, b[other]])
        if len(u) > 1 << 18:
            u, v = local_components(u, v)
    return u, v


def _compare_small(cell: np.ndarray, fp: np.ndarray, home: np.ndarray, starts: np.ndarray, sizes: np.ndarray, max_bits: int):
    """The same for many small cells at once."""
    first, size = np.repeat(starts, sizes)[home], np.repeat(sizes, sizes)[home]
    h = np.repeat(fp[home], size)
    other = fp[np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)]
    hit = (np.bitwise_count(h ^ other) <= max_bits) & (h != other)
    return h[hit], other[hit]


def links(distinct: DataFrame, max_bits: int, blocks: int = 3, tile: int = TILE) -> DataFrame:
    """(a, b) spanning all pairs of fingerprints (column fp) within max_bits bits."""
    spark = distinct.sparkSession
    if any(hi - lo < HAMMING for lo, hi in _spans(blocks)):
        raise ValueError(f"blocks of 64 bits must hold {HAMMING} bits or more")

    def sizes(batches):
        for batch in batches:
            cell, _ = _entries(batch.column("fp").to_numpy().view(np.uint64), max_bits, blocks)
            u, n = np.unique(cell >> 1, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(n)], ["cell", "n"])

    # cells are at most blocks * 2**(bits - 4), whatever the input: under 0.8 million
    hot = {r["cell"]: -(-r["n"] // tile) for r in distinct.mapInArrow(sizes, "cell long, n long")
           .groupBy("cell").agg(F.sum("n").alias("n")).where(F.col("n") > tile).collect()}
    hot_cells = np.array(sorted(hot), np.int64)
    hot_tiles = np.array([hot[c] for c in sorted(hot)], np.int64)

    def spread(batches):
        for batch in batches:
            cell, fp = _entries(batch.column("fp").to_numpy().view(np.uint64), max_bits, blocks)
            t = np.ones(len(cell), np.int64)
            if len(hot_cells):
                pos = np.minimum(np.searchsorted(hot_cells, cell >> 1), len(hot_cells) - 1)
                t = np.where(hot_cells[pos] == cell >> 1, hot_tiles[pos], 1)
            # a tile is (chunk of homes, chunk of entries): a home goes to a row of tiles, every entry to a column
            mix = (fp.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % t
            k = np.repeat(np.arange(len(cell)), t)
            step = np.arange(len(k)) - np.repeat(np.cumsum(t) - t, t)
            is_home = ((cell & 1) == 1)[k]
            column = pa.array((cell >> 1)[k]), pa.array(step * t[k] + mix[k]), pa.array(np.zeros(len(k), bool)), pa.array(fp[k])
            row = pa.array((cell >> 1)[k][is_home]), pa.array((mix[k] * t[k] + step)[is_home]), pa.array(np.ones(is_home.sum(), bool)), pa.array(fp[k][is_home])
            for arrays in (column, row):
                yield pa.RecordBatch.from_arrays(list(arrays), ["cell", "tile", "home", "fp"])

    def compare(batches):
        u, v, rest = [], [], None
        found = 0
        names = ("cell", "tile", "home", "fp")

        def work(c, t, h, f):
            nonlocal found
            starts = np.flatnonzero(np.concatenate([[True], (c[1:] != c[:-1]) | (t[1:] != t[:-1])]))
            n = np.diff(np.append(starts, len(c)))
            small = np.repeat(n <= 64, n)
            sn = n[n <= 64]
            if len(sn):
                a, b = _compare_small(c[small], f[small], h[small], np.cumsum(sn) - sn, sn, max_bits)
                u.append(a), v.append(b)
            for s, k in zip(starts[n > 64].tolist(), n[n > 64].tolist()):
                a, b = _compare(f[s:s + k], h[s:s + k], max_bits)
                u.append(a), v.append(b)
            found = sum(map(len, u))
            if found > 1 << 20:
                a, b = local_components(np.concatenate(u), np.concatenate(v))
                u[:], v[:] = [a], [b]

        for batch in batches:  # rows come sorted by cell and tile; the last one may go on in the next batch
            cols = [batch.column(x).to_numpy(zero_copy_only=False) for x in names]
            cols[3] = cols[3].view(np.uint64)
            if rest is not None:
                cols = [np.concatenate([p, q]) for p, q in zip(rest, cols)]
            c, t = cols[0], cols[1]
            if not len(c):
                continue
            cut = int(np.argmax((c == c[-1]) & (t == t[-1])))
            rest = [x[cut:].copy() for x in cols]
            if cut:
                work(*(x[:cut] for x in cols))
        if rest is not None and len(rest[0]):
            work(*rest)
        if u:
            a, b = local_components(np.concatenate(u), np.concatenate(v))
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return (
        distinct.select("fp").mapInArrow(spread, "cell long, tile long, home boolean, fp long")
        .repartition(partitions(spark), "cell", "tile").sortWithinPartitions("cell", "tile")
        .mapInArrow(compare, "a long, b long")
    )


def simhash_components(docs: DataFrame, shingle: int = 4, max_bits: int = 4, blocks: int = 3,
                       id_col: str = "doc_id", text_col: str = "text", tile: int = TILE, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest doc_id reachable over links.
    With ``carry``, also root, a fingerprint that names the component, and those columns."""
    fp = stored(fingerprints(docs, shingle, id_col, text_col, carry), "fingerprints")
    distinct = stored(fp.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct")
    stars = components(links(distinct, max_bits, blocks, tile))
    rooted = distinct.join(stars, distinct["fp"] == stars["a"], "left").select("fp", "low", F.coalesce("b", "fp").alias("root"))
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    of = rooted.join(lows, "root").select("fp", "component_id", "root")
    more = ["root", *fp.columns[2:]] if carry else []
    return fp.join(of, "fp").select("doc_id", "fp", "component_id", *more)


def drop_near_copies(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """One document of each component, with its columns as they came: that of the smallest id
    (null ids last); if rows share it, one of them, picked by a hash of all its columns."""
    a, b = fresh(docs, "row_a"), fresh(docs, "row_b")
    hashes = row_hashes(docs)
    docs = docs.withColumns({a: hashes[0], b: hashes[1]})
    found = simhash_components(docs, shingle, max_bits, carry=(a, b))
    one = F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "c0", "c1")).alias("one")
    chosen = found.groupBy("root").agg(one).select(F.col("one.c0").alias(a), F.col("one.c1").alias(b))
    return keep_rows(docs, a, b, chosen)


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: fingerprint of 4-word shingles and component over links of at most 4 bits."""
    found = simhash_components(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
