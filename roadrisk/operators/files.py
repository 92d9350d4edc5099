"""Small files that record the state of a table, in whatever file system holds the table."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    kind = spark._jvm.org.apache.hadoop.fs.Path(path)
    return kind, kind.getFileSystem(spark._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder in rising order; none if there is no folder."""
    path, system = _at(spark, folder)
    return sorted(s.getPath().getName() for s in system.listStatus(path)) if system.exists(path) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or None if there is none."""
    at, system = _at(spark, path)
    if not system.exists(at):
        return None
    stream = system.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file at once and whole; false, and nothing done, if there is one of that name.

    Written under another name and renamed without overwriting, as Spark commits the logs of its streams.
    """
    target, system = _at(spark, path)
    folder = path.rsplit("/", 1)[0]
    system.mkdirs(_at(spark, folder)[0])
    draft, _ = _at(spark, f"{folder}/.{uuid.uuid4().hex}")
    stream = system.create(draft, False)
    stream.write(text.encode())
    stream.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.makeQualified(
        system.getUri(), system.getWorkingDirectory()).toUri(), spark._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(draft, target, plain)
    except Py4JJavaError as error:
        system.delete(draft, False)
        if "FileAlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    return True


def drop(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all it holds; nothing if there is none."""
    at, system = _at(spark, path)
    system.delete(at, True)
