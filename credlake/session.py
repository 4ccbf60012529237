"""Session helpers: one place for the Spark settings the library relies on."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Settings every job in this library assumes.
#  - ANSI mode: bad casts raise, like the typed inserts of the original
#    pipeline (a text key that is not a number aborts the load).
#  - UTC session zone: load timestamps are zone-less wall clock values.
#  - AQE: runtime coalescing of shuffle partitions, skew-join splitting and
#    broadcast conversion once real sizes are known.
BASE_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # listing many folders: by default a task for each of up to 10,000, whose start costs more than the listing
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
    # min/max/count from Parquet footers where the DSv2 reader is used
    "spark.sql.parquet.aggregatePushdown": "true",
    # keep one from_json per payload: the default rewrite turns each field
    # access into its own parse of the whole JSON text
    "spark.sql.optimizer.enableJsonExpressionOptimization": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Settings for a large cluster: apply_conf(spark, CLUSTER_CONF) (get_spark is local and does not).
# Scans: 256 MB splits.  Shuffles: start with many partitions and let AQE
# coalesce them to ~256 MB each, so the same job fits 1 GB and 100 TB; skewed
# join partitions above 5x the median and 512 MB are split.  Broadcasts stay
# behind Spark's measured-size threshold (AQE re-checks it at runtime).
CLUSTER_CONF = {
    **BASE_CONF,
    "spark.sql.files.maxPartitionBytes": str(256 << 20),
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
    "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
}


def get_spark(app: str = "credlake", cpus: str | int = "*", shuffle_partitions: int = 8,
              driver_memory: str = "16g", extra: dict | None = None) -> SparkSession:
    """Local session for tests and benchmarks (clusters bring their own)."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_conf(spark)
    ensure_checkpoint_dir(spark)
    return spark


def apply_conf(spark: SparkSession, conf: dict | None = None) -> None:
    """Apply the runtime-settable part of BASE_CONF (or CLUSTER_CONF) to an existing session."""
    for k, v in (conf or BASE_CONF).items():
        if not k.startswith("spark.ui."):  # fixed when the context starts
            spark.conf.set(k, v)


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only where unset.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder (HDFS,
    object store); a machine-local folder would lose checkpoints with the
    executor, so we refuse to invent one there.  Local sessions (tests) get
    a fresh folder under the system temp directory.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    d = tempfile.mkdtemp(prefix="credlake-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir()


def shared_root(spark: SparkSession) -> str:
    """Shared folder for library-managed data (warehouse, scratch).

    ``credlake.warehouse.dir`` wins; otherwise a sibling of the checkpoint
    folder, which is shared by construction.
    """
    w = spark.conf.get("credlake.warehouse.dir", None)
    if w:
        return w.rstrip("/")
    ck = ensure_checkpoint_dir(spark).rstrip("/")
    # getCheckpointDir() ends in a folder of this application; stay beside it, where later ones look too
    return ck.rsplit("/", 1)[0] + "/credlake"


_scratch: ContextVar[list | None] = ContextVar("credlake_scratch", default=None)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared root."""
    path = f"{shared_root(spark)}/scratch/{name}-{uuid.uuid4().hex[:12]}"
    if _scratch.get() is not None:
        _scratch.get().append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch folders made inside once the block has ended.

    For jobs whose results are committed tables; frames built inside must not
    be read after it.
    """
    made: list[str] = []
    token = _scratch.set(made)
    try:
        yield
    finally:
        _scratch.reset(token)
        jvm = spark.sparkContext._jvm
        for path in made:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def to_local_path(path: str) -> str | None:
    """Local filesystem path for a file: URI or bare path, else None."""
    if path.startswith("file:"):
        return path[len("file:"):]
    if "://" in path:
        return None
    return path if os.path.isabs(path) else None


def materialize(df, name: str = "stage", session: SparkSession | None = None):
    """Store an intermediate layer and cut its lineage; it is read back in ``session`` (by default the frame's).

    Writes a Parquet table in a fresh folder under the shared root and reads
    it back: the layer is computed once (an eager ``checkpoint()`` computes
    it twice unless cached), later jobs read compact columnar files with
    real size statistics (so the planner can decide broadcasts statically),
    and a lost executor recomputes nothing upstream of it.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return (session or spark).read.schema(df.schema).parquet(path)  # known schema: no inference job


def spread(df, min_partitions: int | None = None):
    """Give per-row work enough tasks when the input is a few unsplittable
    files (one parquet row group is one scan task).

    Round-robins the rows only when the scan has fewer partitions than the
    cluster's default parallelism, so large inputs (thousands of splits) are
    left untouched.  Only the partition count is planned; nothing runs.
    """
    target = int(min_partitions or df.sparkSession.sparkContext.defaultParallelism)
    try:
        parts = df.rdd.getNumPartitions()
    except Exception:  # no RDD view of the plan (e.g. a remote session): leave as is
        return df
    return df.repartition(target) if parts < target else df
