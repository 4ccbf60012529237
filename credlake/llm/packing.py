"""Packing: documents cut and packed into sequences by minimum bin slack.

A document's ids are cut at multiples of the window, so only its last piece is
shorter than a window; whole windows are sequences of their own.  The last
pieces of a group of documents are packed by minimum bin slack: a window takes
the longest piece left, then a subset-sum over the multiset of remaining
lengths, held as bits of one integer, finds the sum closest to what is free,
and backtracking gives the counts taken of each length.  A sequence whose
length is a power of two needs no padding, so such sums count as filled.

Groups are formed of last pieces, by hash of the row's number, and have about
``group`` of them each, as there is one a document, whether ids repeat or are
null; a group is packed in one task.  Whole windows get their ids in Spark and travel in blocks of at most
``group``, however long a text is.  One pass over the
texts makes rows of one piece each (its checksum included); only those rows
are shuffled.

Ids follow the tokenizer file (byte-level BPE).  A word with the space before
it encodes on its own, so words are encoded once and kept as id bytes in a
bounded memory; a text where white space meets white space, or that holds an
added token of the file (<|endoftext|>), is encoded whole.

Defined results: null and empty texts are the closing id 0 alone.  A special
token written out in a text has its own id, as the library gives it with
add_special_tokens=False.  Rows that repeat a doc_id are packed like any other document.  An empty table gives no
rows.  Other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_text, partitions, slices, table

WINDOW = 1024
GROUP = 20_000  # pieces of a group, about
KEEP = 200_000  # words a worker remembers
# fixed value: how byte-level BPE of this kind cuts a text into words
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_MEETS = r"\s\s"  # white space next to white space: words don't encode apart there


class _Words(dict):
    """Id bytes of words, each with the space before it; a word not met before is encoded when asked for.
    The merges of the file are its vocabulary in order of id, which is what tiktoken merges by."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            whole = json.load(f)
        vocab = whole["model"]["vocab"]
        self.added = [t["content"] for t in whole.get("added_tokens") or []]
        # byte-level tokens write a byte as a character: printable Latin-1 as itself, the rest from 256 on
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
        ranks = {bytes(byte_of[c] for c in w): i for w, i in vocab.items() if all(c in byte_of for c in w)}
        ranks = {w: i for w, i in ranks.items() if w not in {a.encode() for a in self.added}}
        self.ids = tiktoken.Encoding("words", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def __missing__(self, word: str) -> bytes:
        got = array("I", self.ids(" " + word)).tobytes()
        if len(self) >= KEEP:
            self.clear()
        if len(word) <= 64:
            self[word] = got
        return got


class WordEncoder:
    """Texts to little-endian unsigned 32-bit ids of a byte-level BPE tokenizer file."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words = _Words(path)
        # texts whose words don't encode apart
        self.whole = re.compile("|".join([_MEETS, *map(re.escape, self.words.added)]))

    def plain(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes() if text else b""

    def encode(self, text: str) -> bytes:
        """Ids of a whole text."""
        if self.whole.search(text) or text[:1].isspace():
            return self.plain(text)
        first, *rest = text.split(" ")
        return self.plain(first) + b"".join(map(self.words.__getitem__, rest))


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def closest_fill(counts: dict[int, int], room: int, filled: int, window: int) -> list[tuple[int, int]]:
    """[(length, how many)] out of ``counts`` whose sum s <= room leaves the least padding
    in a sequence that holds ``filled`` already.  Bit k of the reach: sum k can be made."""
    reach, steps, full = 1, [], (1 << room + 1) - 1
    for length in sorted(counts, reverse=True):
        if length > room:
            continue
        left, take = min(counts[length], room // length), 1
        while left:  # binary multiples of a length
            k = min(take, left)
            steps.append((reach, length, k))
            reach |= (reach << length * k) & full
            left -= k
            take *= 2
        if reach >> room & 1:
            break
    best = reach.bit_length() - 1
    if best + filled < window:  # a power of two needs no padding
        p = 1 << max(filled - 1, 0).bit_length()
        powers = []
        while p < window:
            if p >= filled and reach >> (p - filled) & 1:
                powers.append(p - filled)
            p *= 2
        if powers:
            best = powers[-1]
    chosen, s = [], best
    for before, length, k in reversed(steps):
        if not before >> s & 1:
            chosen.append((length, k))
            s -= length * k
    return chosen


def pack_lengths(lengths: list[int], window: int = WINDOW) -> list[list[int]]:
    """Sequences as lists of indexes into ``lengths``, each 1..window."""
    by: dict[int, list[int]] = {}
    for i, n in enumerate(lengths):
        by.setdefault(n, []).append(i)
    sequences = [[i] for i in by.pop(window, [])]
    counts = {n: len(rows) for n, rows in by.items()}

    def take(n: int, k: int) -> list[int]:
        got = [by[n].pop() for _ in range(k)]
        counts[n] -= k
        if not counts[n]:
            del counts[n]
        return got

    while counts:
        longest = max(counts)
        sequence = take(longest, 1)
        for n, k in closest_fill(counts, window - longest, longest, window):
            sequence += take(n, k)
        sequences.append(sequence)
    return sequences


def pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): one row per piece, cut at multiples of the window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        for whole in batches:
            for batch in slices(whole):
                rows = []
                for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                    ids = enc.encode(text) + b"\0\0\0\0"
                    n = len(ids) // 4
                    rows += [(doc, a, min(window, n - a), zlib.crc32(ids[4 * a:4 * (a + window)]), n) for a in range(0, n, window)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)

    return id_text(docs).mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def grouped(docs: DataFrame, tokenizer: str, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """Pieces with the group (grp) that they are packed in; whole windows with their sequence (own)
    and a block below 0."""
    n = docs.count()  # from the files' row counts
    groups = max(1, -(-n // group))
    row = F.monotonically_increasing_id()  # (doc_id, start) is not unique where ids repeat or are null
    whole = F.col("length") == window
    return pieces(docs, tokenizer, window).withColumn("row", row).select(
        "*", F.when(whole, F.col("row").bitwiseOR(F.lit(1 << 62))).alias("own"),
        F.when(whole, -1 - F.expr(f"row div {group}")).otherwise(F.pmod(F.xxhash64("row"), F.lit(groups))).alias("grp")).drop("row")


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """One row per piece with its sequence_id and its offset in the sequence."""
    def one(t: pa.Table) -> pa.Table:
        g = t.column("grp")[0].as_py()
        if g < 0:
            seq, off = t.column("own"), pa.array([0] * t.num_rows, pa.int64())
            return t.drop_columns(["grp", "own"]).append_column("sequence_id", seq).append_column("offset", off)
        t = t.sort_by([("doc_id", "ascending"), ("start", "ascending")])
        length = t.column("length").to_pylist()
        seq, off = [0] * len(length), [0] * len(length)
        for k, rows in enumerate(pack_lengths(length, window)):
            at = 0
            for i in rows:
                seq[i], off[i] = g << 32 | k, at
                at += length[i]
        return t.drop_columns(["grp", "own"]).append_column("sequence_id", pa.array(seq, pa.int64())).append_column("offset", pa.array(off, pa.int64()))

    spread = grouped(docs, tokenizer, window, group)
    return spread.repartition(partitions(docs.sparkSession), "grp").groupBy("grp").applyInArrow(
        one, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
