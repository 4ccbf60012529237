"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize

A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    """Buckets for packed exchanges: the session's shuffle partitions, which
    a cluster sets in proportion to its input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only, as a native expression."""
    return F.translate(col, A_TO_Z, A_TO_Z.lower())


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back (cuts lineage, survives lost executors)."""
    return materialize(df, f"llm-{name}")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", more: dict[str, str] | None = None) -> DataFrame:
    """The two columns an operator reads, under fixed names; null text is empty.  ``more``: further columns by new name."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        *[F.col(c).alias(name) for name, c in (more or {}).items()],
    )


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (names differ beyond case)."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def row_hashes(df: DataFrame) -> list[Column]:
    """Two longs, 128 bits over all columns of a row: rows that share both are alike."""
    def plain(f) -> Column:
        c = F.col(f"`{f.name}`")
        return c if f.dataType.simpleString() in _PLAIN else F.to_json(F.struct(c))

    cols = [F.struct(plain(f)) for f in df.schema.fields]  # a null inside a struct leaves the hash as it is
    marks = F.array(*[F.col(f"`{c}`").isNull() for c in df.columns])
    return [F.xxhash64(*cols, marks), F.xxhash64(F.lit(1), *cols, marks)]


_PLAIN = {"string", "binary", "boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz"}


def keep_rows(docs: DataFrame, a: str, b: str, chosen: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose hashes (columns a, b) ``chosen`` holds, one of those alike, without a and b.

    ``chosen`` has columns a, b.  Its join leaves rows alike side by side, so one is
    taken as they pass."""
    rest = [c for c in docs.columns if c not in (a, b)]
    whole = fresh(docs, "row")
    rows = docs.join(chosen, [a, b], "left_semi").select(a, b, F.struct(*[F.col(f"`{c}`") for c in rest]).alias(whole))
    one = rows.groupBy(a, b).agg(F.first(whole).alias(whole))
    return one.select(*[F.col(whole)[c].alias(c) for c in rest])


def held_out(id_col: str = "doc_id") -> Column:
    """Rows never learned from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def flat(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column end to end, and the n+1 row offsets (null: empty)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
        if isinstance(col, pa.ChunkedArray):
            col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], pa.string())
    wide = pa.large_binary()
    col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    col = col.cast(pa.large_string()).cast(wide) if pa.types.is_string(col.type) else col.cast(wide)
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = col.buffers()
    offsets = np.frombuffer(offs, np.int64, len(col) + 1, col.offset * 8)
    lo, hi = int(offsets[0]), int(offsets[-1])
    buf = np.frombuffer(data, np.uint8, hi - lo, lo) if hi > lo else np.zeros(0, np.uint8)
    return buf, offsets - lo


def slices(batch: pa.RecordBatch, text: str = "text", max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of whole rows of about max_bytes of text, so that
    a worker's memory follows max_bytes or the longest text, not the batch."""
    _, offs = flat(batch.column(text))
    i, n = 0, batch.num_rows
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + max_bytes, "right")) - 1)
        yield batch.slice(i, j - i)
        i = j


def local_components(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spanning stars of the links (u, v): (node, smallest node of its component), node != root."""
    if len(u) == 0:
        return u, v
    nodes, idx = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = idx[: len(u)], idx[len(u):]
    lab = np.arange(len(nodes))
    while True:
        la, lb = lab[a], lab[b]
        open_ = la != lb
        if not open_.any():
            break
        a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
        np.minimum.at(lab, np.maximum(la, lb), np.minimum(la, lb))
        while (nxt := lab[lab]) is not None and (nxt != lab).any():
            lab = nxt
    child = lab != np.arange(len(nodes))
    return nodes[child], nodes[lab[child]]
