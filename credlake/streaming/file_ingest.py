"""File-drop ingestion as a Structured Streaming job (S-02, K-01, K-09, K-10, Q-09).

The original globs a raw folder each run, loads every ``idp_boleta_*.json``
into bronze and moves it to an archive folder; a file that fails stays and
is retried.  Here the file source's checkpoint is the ingest-once ledger:
each file is committed exactly once to the stream, ``cleanSource=archive``
moves consumed files (one batch later, with their source path recreated under
the archive folder) and ``Trigger.AvailableNow`` gives the on-demand "process
what is there and stop" behaviour.  Malformed documents go to a quarantine
table with their raw text instead of being retried forever.

The sink is ``foreachBatch``.  Each committed batch leaves a marker in the
ingest ledger, so a batch the engine re-runs after a failure is skipped when it
had already been committed; a crash between the bronze append and the marker
replays it once (at-least-once), which the silver latest-record rule absorbs.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..functions.payload import is_loadable
from ..operators.ledger import ledger_entry, next_sequence, reservation
from ..plans.bronze import documents_to_bronze
from ..schemas import DOC_FILE_GLOB
from ..session import materialize
from ..sources.store import BRONZE_TABLE, INGEST_LEDGER, TableStore


METRICS = "ingesta"
MAX_FILES = 100_000  # of one micro-batch


class IngestCounters(StreamingQueryListener):
    """A-06 for streams: the observed counters of every micro-batch, added up per run of a stream.

    They are gathered while the batch is read, so counting costs no pass.  A
    batch that the engine re-runs is counted again."""

    def __init__(self):
        self._of: dict[str, dict[str, int]] = {}
        self._ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(METRICS)
        counts = self._of.setdefault(str(event.progress.runId), {})
        for name, n in (row.asDict() if row is not None else {}).items():
            counts[name] = counts.get(name, 0) + int(n or 0)

    def onQueryTerminated(self, event) -> None:
        self._ended.setdefault(str(event.runId), threading.Event()).set()

    def of(self, query: StreamingQuery, timeout: float = 60.0) -> dict[str, int]:
        """Counters of a stream that has ended; its last events may still be on their way."""
        run = str(query.runId)
        self._ended.setdefault(run, threading.Event()).wait(timeout)
        return dict(self._of.get(run, {}))


def document_stream(spark: SparkSession, source_dir: str, pattern: str = DOC_FILE_GLOB,
                    archive_dir: str | None = None, max_files_per_trigger: int | None = MAX_FILES,
                    whole_file: bool = True) -> DataFrame:
    """Streaming frame of (value, nombre_archivo): one row per file
    (``whole_file``) or per line for JSON-lines drops."""
    r = spark.readStream.format("text").option("pathGlobFilter", pattern)
    if whole_file:
        r = r.option("wholetext", True)
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.load(source_dir).select("value", F.col("_metadata.file_name").alias("nombre_archivo"))


def bronze_sink(spark: SparkSession, store: TableStore, quarantine_dir: str, run_id: str, stream_id: str):
    """The ``foreachBatch`` function: loadable documents to bronze, the rest
    to quarantine, then a batch marker in the ingest ledger.

    A batch whose marker is present was fully committed before (the stream
    is re-running it after a failure) and is skipped; a crash between the
    bronze append and the marker still replays it once (at-least-once).
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        marker = f"stream:{stream_id}:{batch_id}"
        ledger = store.read(INGEST_LEDGER)
        if not ledger.filter(F.col("nombre_archivo") == marker).isEmpty():
            return
        # the rows are read twice (loadable ones and quarantine): stored once, in the shared folder
        rows = materialize(batch, "batch", spark)
        base = next_sequence(ledger, store.read(BRONZE_TABLE))
        good, bad = documents_to_bronze(rows, run_id, seq_base=base)
        store.append(INGEST_LEDGER, reservation(good, run_id, base))
        store.append_bronze(good)
        bad.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(quarantine_dir)
        store.append(INGEST_LEDGER, ledger_entry(spark.range(1).select(F.lit(marker).alias("nombre_archivo")), run_id))

    return sink


def start_bronze_stream(spark: SparkSession, store: TableStore, source_dir: str, checkpoint_dir: str,
                        quarantine_dir: str, run_id: str, pattern: str = DOC_FILE_GLOB,
                        archive_dir: str | None = None, whole_file: bool = True,
                        available_now: bool = True, max_files_per_trigger: int | None = MAX_FILES) -> StreamingQuery:
    """The stream, started.  Its progress events carry the counters ``METRICS``."""
    stream = document_stream(spark, source_dir, pattern, archive_dir, max_files_per_trigger, whole_file)
    stream = stream.withColumn("cargable", is_loadable(F.col("value"))).observe(
        METRICS, F.count(F.lit(1)).alias("documentos"), F.count_if("cargable").alias("documentos_filas"),
        F.count_if(~F.col("cargable")).alias("documentos_cuarentena"))
    sink = bronze_sink(spark, store, quarantine_dir, run_id, stream_id=checkpoint_dir.rstrip("/"))
    w = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def run_bronze_stream(spark: SparkSession, *args, **kw) -> dict[str, int]:
    """Process what is there (``AvailableNow``) and return the counters of the run."""
    counters = IngestCounters()
    spark.streams.addListener(counters)
    try:
        query = start_bronze_stream(spark, *args, **kw)
        query.awaitTermination()
        return counters.of(query)
    finally:
        spark.streams.removeListener(counters)
