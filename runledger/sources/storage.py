"""Small files in any file system that Spark knows: listing, reading, creating once, deleting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only a session whose executors are threads of the driver may go without that setting; it gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="runledger-")


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    p, fs = _path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _path(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file whole, unless it is there already. It appears under its name only when it is complete."""
    p, fs = _path(spark, path)
    fs.mkdirs(p.getParent())
    hidden = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f"._{uuid.uuid4().hex}")
    stream = fs.create(hidden, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(hidden), fs.makeQualified(p), none)  # refuses to replace
        return True
    except Exception as e:
        fs.delete(hidden, False)
        if "FileAlreadyExists" in str(e):
            return False
        raise


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)
