"""One whole load (G-10): sources -> bronze -> silver -> gate -> gold -> view.

The stage order is the original's: documents and CSV into bronze, the silver
upsert plus its audit row, the quality gate, the gold dimensions (committed
first, FK order), the fact, gold's audit row, and finally the view.  Every
commit is a new table version, so a failure at any step leaves the previous
state readable and the run can simply be repeated.
"""

from __future__ import annotations

from contextvars import copy_context
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.audit import audit_entry, with_log_ids
from ..operators.keys import max_key
from ..operators.ledger import ledger_entry, next_sequence, not_yet_ingested, reservation
from ..operators.quality import constraint_check, enforce, silver_gate
from ..operators.upsert import upsert
from ..schemas import DOC_FILE_GLOB, REBUILDABLE
from ..session import materialize, scratch_scope
from ..sources.files import (FILE_IDENTITY, archive_file, claim_delivery, close_delivery, list_files, open_deliveries,
                             read_application_csv, read_documents)
from ..sources.store import BRONZE_STORED, BRONZE_TABLE, INGEST_LEDGER, TableStore, key_range, range_folder
from . import gold
from .bronze import csv_to_bronze, documents_to_bronze
from .silver import build_silver
from .view import VIEW_NAME, VIEW_TABLES, publish_bucketed_view, publish_view, risk_view

SILVER = "silver.cleaned_application"


@dataclass
class RunReport:
    run_id: str
    gate: dict = field(default_factory=dict)
    counters: dict = field(default_factory=dict)
    versions: dict = field(default_factory=dict)


def init_warehouse(store: TableStore) -> None:
    """K-11: reset the rebuildable layers and what silver knows of bronze; bronze is kept."""
    store.reset(REBUILDABLE)
    store.forget_stream(SILVER)


def ingest_batch(spark: SparkSession, store: TableStore, run_id: str, csv_path: str | None = None,
                 docs_dir: str | None = None, quarantine_dir: str | None = None,
                 docs_pattern: str | None = None, docs_whole_file: bool = True, archive_dir: str | None = None,
                 archive_by: str = "file", csv_multi_line: bool = False) -> dict:
    """Stage 2 as a batch: CSV (optional) then documents (optional).

    Returns the load counters (A-06), gathered with ``observe`` while the
    rows are written, so counting costs no extra pass.  Source files are
    loaded once: path, modification time and length go to the
    ``bronze.ingested_files`` ledger after the append, and later runs skip
    files with all three alike, so a new delivery under an old name is loaded.
    Files are listed first, without their contents; only new ones are read.
    Sequence numbers continue after the ledger's high-water mark, which is
    raised before rows are written.

    With ``archive_dir`` loaded files are moved there (K-09): one rename a file
    afterwards, as the original did (``archive_by="file"``), or one rename for
    the whole file or folder beforehand (``"delivery"``), whatever the number
    of files; a load that failed finds its delivery again.  Files of one run
    share their run's load time.
    """
    if archive_by not in ("file", "delivery"):
        raise ValueError(f"unknown way to archive {archive_by!r}")
    counters: dict = {}
    seen = store.read(INGEST_LEDGER).select(*FILE_IDENTITY)
    loaded = []

    def add(name: str, n: int) -> None:
        counters[name] = counters.get(name, 0) + n

    def fresh_files(listing: DataFrame) -> tuple[DataFrame, list[str]]:
        fresh = materialize(not_yet_ingested(listing, seen, on=FILE_IDENTITY), "files")
        # names alone, of one delivery; Spark's own listing has them on the driver as well
        return fresh, [r["_leer"] for r in fresh.select("_leer").collect()]

    def numbered(make) -> DataFrame:
        """Bronze rows from the next free sequence number on, which is reserved."""
        base = next_sequence(store.read(INGEST_LEDGER), store.read(BRONZE_TABLE))
        rows = make(base)
        store.append(INGEST_LEDGER, reservation(rows, run_id, base))
        return rows

    def enter(files: DataFrame) -> None:
        """Files in bronze or quarantine: to the ledger, and out of the way."""
        store.append(INGEST_LEDGER, ledger_entry(files.select("nombre_archivo", *FILE_IDENTITY), run_id))
        loaded.append(files.select("ruta"))

    def load_csv(path: str, name: str) -> None:
        listing = list_files(spark, path)
        fresh, paths = fresh_files(listing)
        if paths:
            csv = read_application_csv(spark, paths, multi_line=csv_multi_line)
            obs = Observation("csv")
            store.append_bronze(numbered(lambda base: csv_to_bronze(csv, run_id, file_name=name, seq_base=base)), obs,
                                F.count(F.lit(1)).alias("filas"))
            add("csv_filas", obs.get.get("filas", 0))
            enter(fresh)
        elif not listing.isEmpty():
            counters["csv_omitido"] = name           # loaded by an earlier run

    def load_documents(path: str) -> None:
        # K-10: files already loaded (or quarantined) by an earlier run are not read
        fresh, paths = fresh_files(list_files(spark, path, docs_pattern or DOC_FILE_GLOB))
        docs = materialize(read_documents(spark, paths, whole_file=docs_whole_file), "docs")
        bad = documents_to_bronze(docs, run_id)[1]
        obs, qobs = Observation("documentos"), Observation("cuarentena")
        store.append_bronze(numbered(lambda base: documents_to_bronze(docs, run_id, seq_base=base)[0]), obs,
                            F.count(F.lit(1)).alias("filas"))
        add("documentos_filas", obs.get.get("filas", 0))
        # no file enters the ledger unless its text is in bronze or in quarantine
        bad.observe(qobs, F.count(F.lit(1)).alias("filas")).write.mode("append").parquet(
            quarantine_dir or f"{store.root}/quarantine")
        add("documentos_cuarentena", qobs.get.get("filas", 0))
        if paths:
            enter(fresh)

    by_delivery = archive_dir is not None and archive_by == "delivery"
    for path, kind, load in ((csv_path, "csv", lambda p: load_csv(p, csv_path.rstrip("/").rsplit("/", 1)[-1])),
                             (docs_dir, "documentos", load_documents)):
        if path and by_delivery:
            claim_delivery(spark, path, archive_dir, f"{kind}-{run_id}")
            for folder in open_deliveries(spark, archive_dir, kind):
                load(folder)
                close_delivery(spark, folder)
        elif path:
            load(path)
    if archive_dir and not by_delivery:
        for files in loaded:
            for r in files.toLocalIterator():
                archive_file(spark, r["ruta"], archive_dir)
    return counters


LEDGER = "audit.silver_ledger"


@dataclass
class Changes:
    """Applications with new bronze records: their ids, stored, and key ranges."""
    ids: DataFrame
    ranges: list

    def of(self, df: DataFrame, key: str) -> DataFrame:
        """The rows of ``df`` whose integer ``key`` changed; Spark chooses the join by the stored size."""
        return df.join(self.ids, df[key].eqNullSafe(self.ids["_id"]), "left_semi")


def load_silver(store: TableStore, method: str = "fused", incremental: bool = False,
                run_id: str | None = None) -> tuple[str | None, Changes | None]:
    """Stage 3: rebuild features from bronze and upsert them (K-03).

    ``incremental=False`` is the original's behaviour: every run rebuilds
    silver from all of bronze and touches every row.  ``incremental=True``
    rebuilds only applications that received bronze records since the last
    load of either kind.  Bronze is followed as a stream of files: the
    stream's checkpoint holds the files seen, so finding the new records reads
    new files alone, and an ``AvailableNow`` batch gives them to ``fold``, which
    commits silver before the checkpoint commits the batch (a crash in between
    makes the next run redo the same keys).  Of bronze and silver only the key
    ranges that changed are read, and only those of silver are written.  Values
    are the same as a full rebuild (a silver row depends only on its own
    application's records); rows of untouched applications keep their load
    time.  Each batch enters its files in the silver ledger.

    Stored records of an application lie in one folder, so ``fused`` leaves few
    of them after the partial aggregation and parses only those.

    Returns the path of silver's new version, and what changed (None for a
    full load, which changes everything).
    """
    spark = store.spark
    done: dict = {}

    def build(source: DataFrame, ranges: list | None) -> str:
        merged = upsert(store.read(SILVER, ranges), build_silver(source, method=method), ["bk_id_solicitud"],
                        touch_cols=["fecha_ingestion"])
        return store.overwrite(SILVER, merged, check=constraint_check(SILVER, store.read), ranges=ranges)

    def fold(batch: DataFrame, batch_id: int) -> None:
        added = materialize(batch.select("ruta").distinct(), "files", spark)
        if incremental:
            key = F.col("bk_id_solicitud")
            ids = materialize(batch.select(key.cast("int").alias("_id"), key_range(key).alias("_rango")).distinct(),
                              "changed", spark)
            # at most RANGE_FOLDERS values and NULL, a proven bound for the list
            ranges = [r["_rango"] for r in ids.select("_rango").distinct().collect()]
            if done:
                ids, ranges = ids.unionByName(done["changes"].ids).distinct(), list({*ranges, *done["changes"].ranges})
            bronze = store.read(BRONZE_TABLE)
            in_range = range_folder(F.col("rango_clave")).isin([r for r in ranges if r is not None])
            if None in ranges:
                in_range = in_range | F.col("rango_clave").isNull()
            done["changes"] = Changes(ids.select("_id"), ranges)
            mine = bronze.filter(in_range).withColumn("_clave", key.cast("int"))
            done["path"] = build(done["changes"].of(mine, "_clave").drop("_clave"), ranges)
        else:
            done["path"] = build(store.read(BRONZE_TABLE), None)
        store.append(LEDGER, added.select("ruta", F.lit(run_id).alias("via_airflow_run_id"),
                                          F.current_timestamp().cast("timestamp_ntz").alias("fecha_carga")))

    follow_bronze(store, SILVER, fold)
    if "path" not in done and not incremental:
        done["path"] = build(store.read(BRONZE_TABLE), None)
    return done.get("path"), done.get("changes", Changes(spark.createDataFrame([], "_id int"), []) if incremental else None)


def follow_bronze(store: TableStore, reader: str, fold) -> None:
    """S-05: give bronze's files that ``reader`` has not seen to ``fold``, as one AvailableNow stream."""
    spark = store.spark
    if store.current_path(BRONZE_TABLE) is None:
        return
    context, error = copy_context(), []

    def sink(batch: DataFrame, batch_id: int) -> None:  # runs in a thread of its own: keep the caller's scratch scope
        try:
            context.run(fold, batch, batch_id)
        except Exception as e:
            error.append(e)
            raise

    # files older than the newest by more than this are taken for seen; a restored bronze may hold such
    rows = (spark.readStream.schema(BRONZE_STORED).option("maxFileAge", "36500d").parquet(store.table_dir(BRONZE_TABLE))
            .select(F.col("_metadata.file_path").alias("ruta"), "bk_id_solicitud"))
    query = (rows.writeStream.foreachBatch(sink).option("checkpointLocation", store.stream_dir(reader))
             .trigger(availableNow=True).start())
    try:
        query.awaitTermination()
    except Exception:
        if error:
            raise error[0]
        raise


def log(store: TableStore, layer: DataFrame, run_id: str) -> None:
    """K-08: append the audit row (gold repeats silver's task and target)."""
    log_t = store.read("audit.etl_log")
    rows = with_log_ids(log_t, audit_entry(layer, run_id), max_key(log_t, "log_id"))
    constraint_check("audit.etl_log", store.read)(rows)
    store.append("audit.etl_log", rows)


def load_gold(spark: SparkSession, store: TableStore, run_id: str, as_of=None, changes: Changes | None = None) -> dict:
    """Stage 5: dimensions first (each committed), then the fact.

    With ``changes`` only the applications that changed are taken from silver,
    and only their key ranges of the client dimension and the fact are read and
    written; other fact rows keep the evaluation date they had.
    """
    ranges = None if changes is None else changes.ranges
    silver = store.read(SILVER, ranges)
    if changes is not None:
        silver = changes.of(silver, "bk_id_solicitud")
    as_of = as_of or spark.sql("SELECT current_date()").first()[0]  # the session's day, as the stamps
    out = {}

    def commit(table: str, df: DataFrame, **kw) -> None:
        out[table] = store.overwrite(table, df, check=constraint_check(table, store.read), **kw)

    def last(table: str, key: str) -> int | None:
        """The largest key of a table of which only some ranges are read: a scan of that column."""
        return None if ranges is None else max_key(store.read(table), key)

    commit("gold.dim_producto", gold.build_dim_producto(silver, store.read("gold.dim_producto"), run_id))
    commit("gold.dim_cliente", gold.build_dim_cliente(silver, store.read("gold.dim_cliente", ranges), run_id,
                                                      start=last("gold.dim_cliente", "sk_cliente")), ranges=ranges)
    commit("gold.dim_proxy_documental", gold.build_dim_proxy(spark, store.read("gold.dim_proxy_documental"), run_id))
    commit("gold.dim_tiempo", gold.build_dim_tiempo(gold.today(spark, as_of), store.read("gold.dim_tiempo")))
    fact = gold.build_fact(silver, store.read("gold.dim_cliente", ranges), store.read("gold.dim_producto"),
                           store.read("gold.dim_tiempo"), store.read("gold.fact_creditos", ranges), as_of, run_id,
                           start=last("gold.fact_creditos", "sk_fact"))
    commit("gold.fact_creditos", fact, sort_within=["sk_cliente", "sk_producto", "sk_tiempo"], ranges=ranges)
    return out


def current_view(store: TableStore) -> DataFrame:
    return risk_view(store.read("gold.fact_creditos"), store.read("gold.dim_cliente"),
                     store.read("gold.dim_producto"), store.read("gold.dim_proxy_documental"),
                     store.read("gold.dim_tiempo"))


def run_load(spark: SparkSession, store: TableStore, run_id: str, *, bronze_rows: DataFrame | None = None,
             csv_path: str | None = None, docs_dir: str | None = None, quarantine_dir: str | None = None,
             as_of=None, silver_method: str = "fused", incremental: bool = False,
             archive_dir: str | None = None, archive_by: str = "file", view_name: str = VIEW_NAME,
             view_buckets: int | None = None) -> RunReport:
    """Stages 2 to 6.  Scratch tables of the run are deleted when it ends, and
    old table versions once the view points at the new ones.

    ``incremental``: silver, client dimension and fact follow the applications
    that changed, range by range, and so do the audit counts and the gate (rows
    of other ranges passed it before).  ``view_buckets``: the view reads fact
    and client dimension from bucketed tables made for it."""
    rep = RunReport(run_id)
    with scratch_scope(spark):
        if bronze_rows is not None:
            seen = Observation("bronze")
            store.append_bronze(bronze_rows, seen, F.max("id_secuencial").alias("marca"))
            mark = spark.range(1).select(F.lit(f"carga:{run_id}").alias("nombre_archivo"), F.lit(seen.get.get("marca")).alias("marca"))
            store.append(INGEST_LEDGER, ledger_entry(mark, run_id))
        else:
            rep.counters = ingest_batch(spark, store, run_id, csv_path, docs_dir, quarantine_dir,
                                        archive_dir=archive_dir, archive_by=archive_by)
        rep.versions[SILVER], changes = load_silver(store, silver_method, incremental=incremental, run_id=run_id)
        ranges = None if changes is None else changes.ranges
        log(store, store.read(SILVER, ranges), run_id)
        rep.gate = enforce(silver_gate(store.read(SILVER, ranges)))
        rep.versions.update(load_gold(spark, store, run_id, as_of, changes))
        log(store, store.read(SILVER, ranges), run_id)
        tables = {k: store.relation_sql(t) for k, t in VIEW_TABLES.items()}
        if view_buckets:
            publish_bucketed_view(spark, tables, f"{store.root}/views", view_buckets, view_name)
        else:
            publish_view(spark, tables, view_name)
        store.prune()
    return rep
