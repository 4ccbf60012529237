"""Table store on plain Parquet folders (S-05, S-06, K-01, K-11).

Parquet has no MERGE and overwriting a folder that is being read destroys it,
so rebuildable tables are written as immutable *versions*:
``<root>/<schema>/<table>/v=<n>/``.  A version is current once its
``_SUCCESS`` marker exists; readers pick the highest such version, so a failed
or half-written load is never visible and an upsert can read version n while
writing n+1.  The marker is written only after the new version has passed its
constraints: those of single rows are observed during the write, uniqueness and
foreign keys are read back.

Silver, the client dimension and the fact are laid out by key range (65,536
keys) inside a version; the ranges are dealt in turn over at most 128 folders,
so that listings and commits do not grow with the span of the ids.  A load that
touches some folders writes only those, as ``p=<n>/``; the table then is the
newest committed folder of each number, back to the last whole version.  The
other files stay as they are.  Tables written before, one folder a range, are
read as they lie: a folder stands for its number modulo 128.

Old versions are deleted by ``prune``, which a load calls once its view points
at the new ones.  Bronze is append-only and lives in one folder partitioned by
branch, so each silver branch prunes to its own files; the audit log and the
silver ledger are appended inside their current version.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.keys import key_bucket
from ..operators.quality import Constraints
from ..schemas import BRONZE, TABLES
from ..session import shared_root
from .files import _hadoop_path

BRONZE_TABLE = "bronze.raw_application"
INGEST_LEDGER = "bronze.ingested_files"
APPEND_ONLY = (BRONZE_TABLE, INGEST_LEDGER)
KEY_RANGE_WIDTH = 1 << 16
RANGE_FOLDERS = 128
RANGED = {"silver.cleaned_application": "bk_id_solicitud", "gold.dim_cliente": "bk_id_solicitud",
          "gold.fact_creditos": "dd_id_solicitud"}
RANGE = "rango_clave"
BRONZE_STORED = T.StructType(BRONZE.fields + [T.StructField("rango_clave", T.LongType(), True)])


_NULL = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder for rows without a range


def _dealt(folder: str) -> int | None:
    """The number among RANGE_FOLDERS that a folder of ranges stands for."""
    r = folder.partition("=")[2]
    return None if r == _NULL else int(r) % RANGE_FOLDERS


def range_folder(r: Column) -> Column:
    """The folder number of a range, or of a folder from before ranges were dealt."""
    return F.pmod(r.cast("long"), F.lit(RANGE_FOLDERS).cast("long"))


def key_range(bk_text: Column) -> Column:
    """Bronze layout folder of a text application id."""
    return range_folder(F.floor(bk_text.try_cast("long") / F.lit(KEY_RANGE_WIDTH)))


class TableStore:
    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = (root or f"{shared_root(spark)}/warehouse").rstrip("/")

    # -- paths -----------------------------------------------------------
    def table_dir(self, table: str) -> str:
        schema, name = table.split(".", 1)
        return f"{self.root}/{schema}/{name}"

    def _folders(self, table: str, committed: bool = True) -> dict[int, str]:
        """Version folders by number; ``committed`` keeps only those whose
        commit finished (``_SUCCESS`` written)."""
        p, fs = _hadoop_path(self.spark, self.table_dir(table))
        if not fs.exists(p):
            return {}
        out = {}
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            if st.isDirectory() and name[:2] in ("v=", "p="):
                ok, _ = _hadoop_path(self.spark, f"{st.getPath().toString()}/_SUCCESS")
                if not committed or fs.exists(ok):
                    out[int(name[2:])] = name
        return dict(sorted(out.items()))

    def _versions(self, table: str, committed: bool = True) -> list[int]:
        return list(self._folders(table, committed))

    def current_path(self, table: str) -> str | None:
        """The folder written last."""
        if table in APPEND_ONLY:
            p = self.table_dir(table)
            path, fs = _hadoop_path(self.spark, p)
            return p if fs.exists(path) else None
        v = self._folders(table)
        return f"{self.table_dir(table)}/{v[max(v)]}" if v else None

    def _layout(self, table: str, upto: int | None = None) -> list[tuple[str, list[str]]]:
        """(folder, its ranges that no later folder holds) of a table laid out by range, newest first."""
        out, taken = [], set()
        for n, name in sorted(self._folders(table).items(), reverse=True):
            if upto is not None and n > upto:
                continue
            p, fs = _hadoop_path(self.spark, f"{self.table_dir(table)}/{name}")
            ranges = [st.getPath().getName() for st in fs.listStatus(p) if st.getPath().getName().startswith(f"{RANGE}=")]
            out.append((f"{self.table_dir(table)}/{name}", sorted(r for r in ranges if _dealt(r) not in taken)))
            taken |= set(map(_dealt, ranges))
            if name.startswith("v="):
                break
        return out

    # -- read ------------------------------------------------------------
    def read(self, table: str, ranges: list[int | None] | None = None) -> DataFrame:
        """Current content, or an empty frame with the table's schema.

        ``ranges``: only these range folders (``key_range``) of a table laid out by range.
        Bronze also carries its layout column ``rango_clave``.
        """
        schema = BRONZE_STORED if table == BRONZE_TABLE else TABLES[table]
        if table in RANGED:
            paths = [f"{folder}/{r}" for folder, held in self._layout(table) for r in held if ranges is None or _dealt(r) in ranges]
        else:
            path = self.current_path(table)
            paths = [path] if path else []
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def relation_sql(self, table: str) -> str:
        """The current content as a SQL relation, for views."""
        if table not in RANGED:
            return f"parquet.`{self.current_path(table)}`"
        cols = ", ".join(TABLES[table].fieldNames())
        parts = []
        for folder, held in self._layout(table):
            ids = [r.partition("=")[2] for r in held]
            tests = [f"{RANGE} IN ({', '.join(i for i in ids if i != _NULL)})"] if any(i != _NULL for i in ids) else []
            tests += [f"{RANGE} IS NULL"] if _NULL in ids else []
            if tests:
                parts.append(f"SELECT {cols} FROM parquet.`{folder}` WHERE {' OR '.join(tests)}")
        if not parts:
            none = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in TABLES[table].fields)
            parts = [f"SELECT {none} WHERE false"]
        return f"({' UNION ALL '.join(parts)})"

    # -- write -----------------------------------------------------------
    def overwrite(self, table: str, df: DataFrame, sort_within: list[str] | None = None,
                  check: Constraints | None = None, ranges: list[int | None] | None = None) -> str:
        """Commit ``df`` as the table's next version and return its path.

        With ``ranges``, ``df`` is the new content of those range folders and
        only they are written.  Rows are rebalanced by folder, as bronze's are.
        ``check`` sees the version before any reader does; if it raises, what
        was current stays current.
        """
        schema = TABLES[table]
        # past every folder, committed or not: a failed load leaves a partial
        # version that readers ignore and writers never reuse
        v = self._versions(table, committed=False)
        part = ranges is not None and bool(self._versions(table))
        path = f"{self.table_dir(table)}/{'p' if part else 'v'}={(v[-1] + 1) if v else 1}"
        out = df.select(*[df[f.name].cast(f.dataType) for f in schema.fields])
        layout = [RANGE] if table in RANGED else []
        if layout:
            out = out.withColumn(RANGE, range_folder(key_bucket(out, RANGED[table], KEY_RANGE_WIDTH))).hint("rebalance", RANGE)
        if sort_within:
            out = out.sortWithinPartitions(*layout, *sort_within)
        seen = Observation() if check is not None else None
        if seen is not None:
            out = out.observe(seen, *check.metrics())
        write = out.write.mode("errorifexists").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
        # tasks move their own files: nobody reads the version before its marker, so the driver need not
        write = write.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
        write.partitionBy(*layout).parquet(path)
        if check is not None:
            check.enforce(seen.get)
            check.check_keys(self.spark.read.schema(schema).parquet(path))
        marker, fs = _hadoop_path(self.spark, f"{path}/_SUCCESS")
        fs.create(marker).close()
        return path

    def append_bronze(self, df: DataFrame, observation: Observation | None = None, *metrics: Column) -> None:
        """K-01: append-only bronze, partitioned by branch and key range.

        The rows are rebalanced by folder before the write, so a load leaves
        about one file per folder and target size, however many tasks read
        it; AQE splits a hot folder.  ``metrics`` are observed on the way.

        ``rango_clave`` = floor(id / 65536) modulo 128 of the numeric application id
        (NULL when the text is not a number; silver rejects it later, as the
        original's cast would): records of one application always share a
        folder, so an incremental silver load prunes bronze to the folders of
        the applications that changed.
        """
        out = df.select(*[df[f.name].cast(f.dataType) for f in BRONZE.fields],
                        key_range(F.col("bk_id_solicitud")).alias("rango_clave"))
        out = out.hint("rebalance", "es_documento", "rango_clave")
        if observation is not None:
            out = out.observe(observation, *metrics)
        (out.write.mode("append").partitionBy("es_documento", "rango_clave")
         .parquet(self.table_dir(BRONZE_TABLE)))

    def append(self, table: str, df: DataFrame) -> None:
        """Add rows without rewriting the table: bronze's own tables in their
        folder, the others inside their current version (``reset`` starts a
        new one), whose first rows commit version 1."""
        schema = TABLES[table]
        path = self.table_dir(table) if table in APPEND_ONLY else self.current_path(table)
        if path is None:
            self.overwrite(table, df)
        else:
            df.select(*[df[f.name].cast(f.dataType) for f in schema.fields]).write.mode("append").parquet(path)

    def prune(self, keep: int = 2) -> None:
        """Delete the versions that none of the last ``keep`` states of a table
        reads.  A load calls this after publishing its view, so the published
        versions stay, and a reader of the load before keeps its files."""
        for table in TABLES:
            if table in APPEND_ONLY:
                continue
            folders = self._folders(table)
            used = set()
            for n in list(folders)[-keep:]:
                if table in RANGED:
                    used |= {folder.rsplit("/", 1)[1] for folder, held in self._layout(table, n)}
                else:
                    used.add(folders[n])
            for name in set(folders.values()) - used:
                p, fs = _hadoop_path(self.spark, f"{self.table_dir(table)}/{name}")
                fs.delete(p, True)

    # -- streams over bronze ----------------------------------------------
    def stream_dir(self, reader: str) -> str:
        """Checkpoint of the stream through which ``reader`` follows bronze."""
        return f"{self.root}/streams/{reader}"

    def forget_stream(self, reader: str) -> None:
        p, fs = _hadoop_path(self.spark, self.stream_dir(reader))
        fs.delete(p, True)

    # -- schema management (K-11) -----------------------------------------
    def reset(self, tables: list[str]) -> None:
        """Drop-and-recreate: commit an empty version of each table."""
        for t in tables:
            self.overwrite(t, self.spark.createDataFrame([], TABLES[t]))
