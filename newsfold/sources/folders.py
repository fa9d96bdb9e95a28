"""Small files and folders on whatever file system a path is on."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _handle(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def children(spark: SparkSession, path: str) -> list[str]:
    files, location = _handle(spark, path)
    return sorted(status.getPath().getName() for status in files.listStatus(location)) if files.exists(location) else []


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below ``path``; 0 if there is none."""
    files, location = _handle(spark, path)
    return files.getContentSummary(location).getLength() if files.exists(location) else 0


def remove(spark: SparkSession, path: str) -> None:
    files, location = _handle(spark, path)
    files.delete(location, True)


def read_text(spark: SparkSession, path: str) -> str:
    files, location = _handle(spark, path)
    stream = files.open(location)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str, scratch: str) -> None:
    """A new file that appears whole or not at all; ``FileExistsError`` if there is one by that name.

    The text is written aside and renamed without overwriting, which one of several writers can do.
    """
    files, location = _handle(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(scratch)
    files.mkdirs(location.getParent())
    stream = files.create(aside, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    fs = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 1)
    options[0] = getattr(getattr(fs, "Options$Rename"), "NONE")
    try:
        fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration()).rename(aside, location, options)
    except Py4JJavaError as problem:
        files.delete(aside, False)
        if "FileAlreadyExistsException" in str(problem.java_exception):
            raise FileExistsError(path) from None
        raise
