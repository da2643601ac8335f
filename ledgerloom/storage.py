"""Shared intermediate storage: tables written to the folder all executors share.

Lineage is cut with written parquet tables, never with executor-local blocks, so a lost executor costs a re-read
and not the job. The folder is the session's ``spark.checkpoint.dir``; a local one is chosen only where the session
names none (tests, local mode).
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: list[str] = []
_WRITTEN: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; in local mode a temporary one, removed at exit."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="ledgerloom-"))
        atexit.register(_remove_local)
    return _LOCAL[0]


def _remove_local() -> None:
    import shutil

    for path in _LOCAL:
        shutil.rmtree(path, ignore_errors=True)


def fresh_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_dir(spark)}/{label}-{os.getpid()}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def cleanup(spark: SparkSession) -> None:
    """Delete this driver's intermediate tables. To be called once no result that was built on them is read any more."""
    while _WRITTEN:
        drop_path(spark, _WRITTEN.pop())


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: a cut in the lineage that survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a written intermediate table that no plan reads any more."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """A new small file; raises if it is there already, so that of two writers one wins. A reader sees all of it or none:
    it is written beside and renamed."""
    target, fs = _file_system(spark, path)
    if fs.exists(target):
        raise FileExistsError(path)
    beside, _ = _file_system(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    stream = fs.create(beside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not fs.rename(beside, target):
        fs.delete(beside, False)
        raise FileExistsError(path)


def list_texts(spark: SparkSession, folder: str) -> list[str]:
    """The contents of a folder's small files; none if there is no such folder."""
    target, fs = _file_system(spark, folder)
    if not fs.exists(target):
        return []
    out = []
    for status in fs.listStatus(target):
        if status.isFile() and not status.getPath().getName().startswith(".") and not status.getPath().getName().endswith(".tmp"):
            stream = fs.open(status.getPath())
            try:
                out.append(bytes(stream.readAllBytes()).decode())
            finally:
                stream.close()
    return out


#: Rows up to which a side is broadcast; of the narrow tables in question a few megabytes.
SMALL_ROWS = 100_000


def small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """``df`` to be broadcast if it proves to have at most ``rows`` rows, else as it is (a join then shuffles or decides by
    size). Rows are counted, so give a table that is stored or cheap."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
