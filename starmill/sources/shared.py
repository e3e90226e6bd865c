"""Intermediate tables in the folder every executor can reach."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

# Of tables that are written to be read again; smaller than with Spark's default.
COMPRESSION = "zstd"

_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``, or the folder given to ``setCheckpointDir``; a temporary
    folder only where all of Spark runs in this process."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.conf.get("spark.app.id")
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="starmill-")
    return _local_folders[app]


def unused(path: str) -> str:
    """A name beside ``path`` that nobody else uses."""
    return f"{path}-{uuid.uuid4().hex}"


def new_path(spark: SparkSession, name: str) -> str:
    return unused(f"{shared_folder(spark)}/starmill/{name}")


def materialize(df: DataFrame, path: str, by: str | None = None) -> DataFrame:
    """Write a table once and read it back, with a folder for each value of ``by``.

    Cuts the lineage like a checkpoint, survives lost executors, and keeps column pruning and
    filter pushdown for every later reader, which a checkpointed DataFrame would lose.
    """
    spark = df.sparkSession
    if by is None:
        df.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)
    else:
        with _open_writers(spark, 8):
            df.write.mode("overwrite").option("compression", COMPRESSION).partitionBy(by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def _open_writers(spark: SparkSession, files: int) -> Iterator[None]:
    """Let a task write several folders side by side; otherwise it sorts its whole rows by folder first."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, files)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _file_system(spark, path)
    return files.exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    files, target = _file_system(spark, path)
    return [f.getPath().getName() for f in files.listStatus(target)] if files.exists(target) else []


def place(path: str) -> str:
    """A path in one spelling, however the local file system and odd characters are written."""
    return unquote(re.sub(r"^file:/*(?=/)", "", path))


def rename(spark: SparkSession, source: str, target: str) -> bool:
    """Move a folder to a name that must be free; False if it is taken.

    One step on file systems whose rename is one, such as HDFS. A store without such a rename needs
    a lock around publishing.
    """
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(spark.sparkContext._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(hadoop.Path(source), hadoop.Path(target), no_options)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless it is there; False if it is."""
    files, target = _file_system(spark, path)
    try:
        out = files.create(target, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file; None if there is none."""
    files, target = _file_system(spark, path)
    if not files.exists(target):
        return None
    stream = files.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def state_of(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """Change time, size and number of files of a table, from its listing alone."""
    files, target = _file_system(spark, path)
    summary = files.getContentSummary(target)
    return files.getFileStatus(target).getModificationTime(), summary.getLength(), summary.getFileCount()


def discard(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table made by this session."""
    files, target = _file_system(spark, path)
    files.delete(target, True)
