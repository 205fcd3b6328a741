"""What the operators of this package share: the shared folder, written tables, word splitting."""

from __future__ import annotations

import contextlib
import gc
import re
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java pattern of the white space that separates words: space and \x09-\x0D.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: Texts or records that a batch holds: a batch is in memory several times, between Spark and Python and on both sides.
TEXTS = 512


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, set here only if it is unset, and only
    where driver and executors are one process. On a cluster without it there is no such folder: an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        current = spark.sparkContext.getCheckpointDir()
        if not current and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = current or "file://" + tempfile.mkdtemp(prefix="lectern-")
        if not current:
            spark.sparkContext.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_root(spark)}/lectern/{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, tag: str, compression: str | None = None) -> DataFrame:
    """Cuts lineage with a table in the shared folder: one evaluation, readable after any executor is lost."""
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.parquet(path, compression=compression)
    out = spark.read.schema(df.schema).parquet(path)
    out._lectern_path = path
    return out


@contextlib.contextmanager
def batches_of(spark: SparkSession, rows: int):
    """What is written meanwhile goes to Python in batches of so many rows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def discard(*dfs: DataFrame | None) -> None:
    """Deletes tables of materialise() that nothing reads any more."""
    for df in dfs:
        path = getattr(df, "_lectern_path", None)
        if path:
            p, fs = _file(df.sparkSession, path)
            fs.delete(p, True)


def _file(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _file(spark, path)
    return bool(fs.exists(p))


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file as text; None if there is none."""
    p, fs = _file(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    p, fs = _file(spark, path)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def release(spark: SparkSession) -> None:
    """Spark deletes the shuffle files of finished phases when the driver collects its garbage; this asks for it."""
    for _ in range(2):  # what the first round frees may hold more
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.3)


def let(value, body):
    """Binds value once for body, inside one expression; a lambda that names a column would compute it for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
