"""File sources (S-01..S-04).

* Historical CSV: header names, every column as text (no per-chunk type
  guessing), FAILFAST so short/long rows abort the load like the original.
  Splittable: Spark reads it in parallel file splits instead of a chunk loop.
* Extracted documents: one JSON object per file (``idp_boleta_*.json``),
  read whole with the file name and modification time for lineage.
* Receipt images: ``*.jpg`` listing (name, size, time) via ``binaryFile``;
  the image bytes are not loaded unless asked for.
* Optional sources: a missing path yields an empty frame of the right shape.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import base_name
from ..operators.bronze import na_to_null
from ..schemas import DOC_FILE_GLOB, IMAGE_GLOB

DOC_TEXT = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("nombre_archivo", T.StringType()),
    T.StructField("ruta", T.StringType()),
    T.StructField("fecha_archivo", T.TimestampType()),
    T.StructField("tamano", T.LongType()),
])
# what makes a source file the same file on a later run
FILE_IDENTITY = ["ruta", "fecha_archivo", "tamano"]
IMAGES = T.StructType([
    T.StructField("ruta", T.StringType()),
    T.StructField("nombre_archivo", T.StringType()),
    T.StructField("tamano", T.LongType()),
    T.StructField("fecha_archivo", T.TimestampType()),
])


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _hadoop_path(spark, path)
    return bool(fs.exists(p))


def list_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Name, identity and readable path (``_leer``) of the files under ``path``; contents are not read."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], T.StructType([
            T.StructField("nombre_archivo", T.StringType()), *DOC_TEXT.fields[2:], T.StructField("_leer", T.StringType())]))
    reader = spark.read.format("binaryFile")
    df = (reader.option("pathGlobFilter", pattern) if pattern else reader).load(path)
    return df.select(F.col("_metadata.file_name").alias("nombre_archivo"), *file_identity(), F.col("path").alias("_leer"))


def read_application_csv(spark: SparkSession, path: str | list[str], na_tokens: bool = True,
                         multi_line: bool = False) -> DataFrame | None:
    """S-01 + P-02.  Returns None when the file is absent (S-04: warn and skip).

    ``multi_line``: quoted cells may hold line breaks; a file is then one
    split.  Without it each part is a line, which FAILFAST rejects where the
    number of its cells is another."""
    if isinstance(path, str) and not path_exists(spark, path):
        return None
    df = (spark.read.option("header", True).option("mode", "FAILFAST").option("inferSchema", False)
          .option("enforceSchema", False).option("multiLine", multi_line)
          .option("escape", '"').csv(path))  # doubled quotes in a quoted cell; a backslash is text
    return na_to_null(df) if na_tokens else df


def read_documents(spark: SparkSession, directory: str | list[str], pattern: str = DOC_FILE_GLOB,
                   whole_file: bool = True) -> DataFrame:
    """S-02: JSON documents with lineage columns: one per file (the original
    layout) or, with ``whole_file=False``, one per line (JSON-lines drops).
    A list names the files to read."""
    reader = spark.read
    if isinstance(directory, str):
        if not path_exists(spark, directory):
            return spark.createDataFrame([], DOC_TEXT)
        reader = reader.option("pathGlobFilter", pattern)
    elif not directory:
        return spark.createDataFrame([], DOC_TEXT)
    # text()'s own wholetext argument overrides a reader option, so pass it here
    df = reader.text(directory, wholetext=whole_file)
    return df.select("value", F.col("_metadata.file_name").alias("nombre_archivo"), *file_identity())


def file_identity() -> list[Column]:
    """Path, modification time and length of the file a row was read from."""
    return [F.col("_metadata.file_path").alias("ruta"),
            F.col("_metadata.file_modification_time").alias("fecha_archivo"),
            F.col("_metadata.file_size").alias("tamano")]


def archive_file(spark: SparkSession, path: str, directory: str) -> None:
    """K-09: move a loaded file to the archive folder.  A name that is taken
    there gets a number, so no delivery overwrites an earlier one."""
    target, fs = _hadoop_path(spark, directory)
    fs.mkdirs(target)
    # file_path is a URI: %-escapes are decoded by java.net.URI
    jvm = spark.sparkContext._jvm
    src = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path))
    n, to = 0, jvm.org.apache.hadoop.fs.Path(target, src.getName())
    while fs.exists(to):
        n += 1
        to = jvm.org.apache.hadoop.fs.Path(target, f"{src.getName()}.{n}")
    if not fs.rename(src, to):
        raise OSError(f"{path} could not be moved to {directory}")


LOADED = "_CARGADO"  # marks a claimed delivery whose files are in bronze or quarantine


def claim_delivery(spark: SparkSession, path: str, directory: str, name: str) -> None:
    """K-09 by delivery: move what lies at ``path`` (a file, or a folder, which is made anew) to the
    archive as ``<name>``, or with a number if that is taken, in one rename, however many files it holds.

    What arrives afterwards belongs to the next delivery.  A delivery is open
    until ``close_delivery`` marks it, so a load that fails finds it again."""
    src, fs = _hadoop_path(spark, path)
    if not fs.exists(src):
        return
    folder = fs.getFileStatus(src).isDirectory()
    if folder and not len(fs.listStatus(src)):
        return
    n, to = 0, _hadoop_path(spark, f"{directory}/{name}")[0]
    while fs.exists(to):
        n += 1
        to = _hadoop_path(spark, f"{directory}/{name}.{n}")[0]
    fs.mkdirs(to.getParent() if folder else to)
    if not fs.rename(src, to if folder else _hadoop_path(spark, f"{to.toString()}/{src.getName()}")[0]):
        raise OSError(f"{path} could not be moved to {directory}")
    if folder:
        fs.mkdirs(src)


def open_deliveries(spark: SparkSession, directory: str, kind: str) -> list[str]:
    """Claimed deliveries of a kind (the prefix of their names) that are not marked as loaded."""
    p, fs = _hadoop_path(spark, directory)
    if not fs.exists(p):
        return []
    found = [st.getPath() for st in fs.listStatus(p) if st.isDirectory() and st.getPath().getName().startswith(f"{kind}-")]
    return sorted(f.toString() for f in found if not fs.exists(_hadoop_path(spark, f"{f.toString()}/{LOADED}")[0]))


def close_delivery(spark: SparkSession, folder: str) -> None:
    p, fs = _hadoop_path(spark, f"{folder}/{LOADED}")
    fs.create(p).close()


def read_images(spark: SparkSession, directory: str, pattern: str = IMAGE_GLOB) -> DataFrame:
    """S-03: image manifest (the bytes column is pruned away)."""
    if not path_exists(spark, directory):
        return spark.createDataFrame([], IMAGES)
    df = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(directory)
    return df.select(F.col("path").alias("ruta"), base_name(F.col("path")).alias("nombre_archivo"),
                     F.col("length").alias("tamano"), F.col("modificationTime").alias("fecha_archivo"))
