"""SentencePiece encoding and decoding: exact merge-type encoding by backtracking.

A sequence of pieces is the encoding of a text if every piece encodes to
itself and every two neighbours are compatible: merging the text of both again
gives those two pieces.  The encoder walks left to right.  At each position it
takes the longest matching piece (one Aho-Corasick pass finds the longest
match of every position), shortens it until it is compatible with the piece
before and does not end at a position known to fail, and steps back when none
is left; a bitfield keeps the failed positions, so each is given up once.

No piece crosses from another character into the white space mark, so texts
fall apart before each run of marks; the parts are encoded on their own and
kept in a bounded memory of recent parts.  Characters outside the vocabulary
become their UTF-8 byte pieces; no merge crosses them either.

Python's sentencepiece only reads the model file (pieces and scores); encoding
and decoding are done here, in tasks, one pass over the texts, no shuffle.

Defined results: null and empty texts have no ids and decode to the empty
text.  The mark U+2581 in a text decodes to a space, as in the library.  Long
texts and long parts are encoded whole, in time linear in their length.
Repeated rows give repeated results.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from operator import add

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import id_text, slices, table

MARK = "▁"
PART = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
KEEP = 500_000  # parts, atoms and piece pairs a worker remembers, each


class Codec:
    """Encoder and decoder of one merge-type model with byte fallback."""

    def __init__(self, pieces: list[str], scores: list[float], plain: list[bool], bytes_: dict[int, int]):
        self.pieces = pieces
        self.rank = {p: -s for p, s, ok in zip(pieces, scores, plain) if ok}
        self.byte_id = bytes_                                   # byte -> id
        self.byte_of = {i: b for b, i in bytes_.items()}        # id -> byte
        self.pairs: dict[int, bool] = {}
        self.atoms: dict[str, str] = {}
        self.parts: dict[str, str] = {}
        # pieces that merging cannot build are never part of an encoding
        self.id = {p: i for i, (p, ok) in enumerate(zip(pieces, plain)) if ok and self.merge(p) == [p]}
        self.chars = {p for p in self.rank if len(p) == 1}
        # neighbours inside some piece: no merge crosses any other two characters
        self.joins = {p[i:i + 2] for p in self.rank for i in range(len(p) - 1)}
        self.size = {i: len(p) for p, i in self.id.items()}
        self.shorter = {i: next((self.id[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in self.id), -1) for p, i in self.id.items()}
        self.automaton = ahocorasick.Automaton()
        for p, i in self.id.items():
            self.automaton.add_word(p, i)
        if self.id:
            self.automaton.make_automaton()
        # texts must fall apart before runs of the mark
        if any(x[0] != MARK and x[1] == MARK for x in self.joins):
            raise ValueError("a piece holds the white space mark after another character")

    @classmethod
    def from_file(cls, path: str) -> Codec:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(sp.get_piece_size())
        special = [sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) for i in ids]
        names = [sp.id_to_piece(i) for i in ids]
        return cls(names, [sp.get_score(i) for i in ids], [not x for x in special],
                   {int(names[i][3:5], 16): i for i in ids if sp.is_byte(i)})

    def merge(self, text: str) -> list[str]:
        """The definition: merge the best-scored neighbours, leftmost first, until none is a piece.
        Used on single pieces and pairs of pieces only."""
        out, rank = list(text), self.rank
        while len(out) > 1:
            best = min(((rank[m], i) for i in range(len(out) - 1) if (m := out[i] + out[i + 1]) in rank), default=None)
            if best is None:
                break
            i = best[1]
            out[i:i + 2] = [out[i] + out[i + 1]]
        return out

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the text of the two pieces again gives the two pieces."""
        if len(self.pairs) >= KEEP:
            self.pairs.clear()
        p, q = self.pieces[a], self.pieces[b]
        ok = self.pairs[a << 16 | b] = p + q not in self.id and self.merge(p + q) == [p, q]
        return ok

    def _known(self, text: str) -> list[int]:
        """Encode characters that all are in the vocabulary."""
        one = self.id.get(text)
        if one is not None:
            return [one]
        known, test = self.pairs.get, self.compatible
        # the longest matches one after another, if no two neighbours object
        out = [i for _, i in self.automaton.iter_long(text)]
        a = out[0]
        for b in out[1:]:
            if not (test(a, b) if (ok := known(a << 16 | b)) is None else ok):
                break
            a = b
        else:
            return out
        return self._backtrack(text)

    def _backtrack(self, text: str) -> list[int]:
        known, test, size, shorter = self.pairs.get, self.compatible, self.size, self.shorter
        n = len(text)
        longest = [0] * n
        for end, i in self.automaton.iter(text):  # ends ascend, so the longest match of a start comes last
            longest[end - size[i] + 1] = i
        failed = bytearray(n + 1)  # the bitfield
        out: list[int] = []
        pos, i = 0, longest[0]
        while pos < n:
            last = out[-1] if out else -1
            while True:
                end = pos + size[i]
                if not failed[end] and (last < 0 or (test(last, i) if (ok := known(last << 16 | i)) is None else ok)):
                    out.append(i)
                    pos = end
                    if pos < n:
                        i = longest[pos]
                    break
                i = shorter[i]
                if i < 0:
                    failed[pos] = 1
                    i = out.pop()
                    pos -= size[i]
                    break
        return out

    def encode_part(self, part: str) -> str:
        """Ids of a part, joined by commas: cut where no piece can cross, encode the atoms between."""
        joins, known = self.joins, self.atoms.get
        cuts = [i for i, x in enumerate(map(add, part, part[1:]), 1) if x not in joins]
        if not cuts:
            return known(part) or self.encode_atom(part)
        atoms = map(part.__getitem__, map(slice, [0, *cuts], [*cuts, len(part)]))
        return ",".join([known(x) or self.encode_atom(x) for x in atoms])

    def encode_atom(self, atom: str) -> str:
        ids = self._known(atom) if len(atom) > 1 or atom in self.chars else [self.byte_id[b] for b in atom.encode()]
        if self._join(ids, False) != atom.replace(MARK, " "):
            raise ValueError("decoding does not give back an atom")
        got = ",".join(map(str, ids))
        if len(self.atoms) >= KEEP:
            self.atoms.clear()
        if len(atom) <= 64:
            self.atoms[atom] = got
        return got

    def encode(self, text: str) -> list[int]:
        """All ids of a text."""
        if not text:
            return []
        parts = PART.findall(MARK + text.replace(" ", MARK))
        return [int(i) for part in parts for i in self.encode_part(part).split(",")]

    def decode(self, ids: list[int]) -> str:
        """The text of ids: byte pieces as UTF-8, marks as spaces, without the space put before the text."""
        return self._join(ids, True)

    def _join(self, ids: list[int], first: bool) -> str:
        out, run = [], bytearray()
        for i in ids:
            b = self.byte_of.get(i)
            if b is not None:
                run.append(b)
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run.clear()
            out.append(self.pieces[i])
        if run:
            out.append(run.decode("utf-8", "replace"))
        text = "".join(out).replace(MARK, " ")
        return text[1:] if first and text[:1] == " " and ids and ids[0] not in self.byte_of else text

    def digest_part(self, part: str) -> str:
        got = self.encode_part(part)
        if len(part) <= 64:
            if len(self.parts) >= KEEP:
                self.parts.clear()
            self.parts[part] = got
        return got

    def digest(self, text: str) -> tuple[int, str, str]:
        """(number of ids, sha256 of the ids joined by commas, sha256 of decode(encode(text)))."""
        if not text:
            return 0, hashlib.sha256(b"").hexdigest(), hashlib.sha256(b"").hexdigest()
        known, digest = self.parts.get, self.digest_part
        if "  " in text or text[0] == " " or text[-1] == " " or MARK in text:
            parts = PART.findall(MARK + text.replace(" ", MARK))
        else:  # single spaces: the same parts, by a plain split
            parts = (MARK + text.replace(" ", " " + MARK)).split(" ")
        ids = ",".join([known(p) or digest(p) for p in parts])
        back = self.decode(list(map(int, ids.split(","))))
        return ids.count(",") + 1, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()


_codecs: dict[str, Codec] = {}  # one for each model file and worker process


def codec(path: str) -> Codec:
    if path not in _codecs:
        _codecs[path] = Codec.from_file(path)
    return _codecs[path]


def encode_documents(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids): all ids of every whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for whole in batches:
            for batch in slices(whole):
                ids = pa.array([c.encode(t) for t in batch.column("text").to_pylist()], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])

    return id_text(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids are no ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for batch in batches:
            text = pa.array([c.decode(i or []) for i in batch.column("ids").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), text], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) without keeping the ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for whole in batches:
            for batch in slices(whole):
                rows = [c.digest(t) for t in batch.column("text").to_pylist()]
                cols = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.string(), pa.string()))]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *cols], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return id_text(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
