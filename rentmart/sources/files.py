"""Small files beside the tables (pointers, not data), on whatever file system a path names, by Hadoop's own API."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), p


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder, sorted; none if there is no such folder."""
    fs, p = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Full paths that a glob pattern matches, sorted."""
    fs, p = _at(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(p) or [])


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _at(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that does not exist yet, whole or not at all: under another name first, then renamed.

    False if the file is there already.
    """
    fs, p = _at(spark, path)
    if fs.exists(p):
        return False
    _, part = _at(spark, f"{path}.{uuid.uuid4().hex}.part")
    stream = fs.create(part)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    if fs.rename(part, p):
        return True
    fs.delete(part, False)
    return False


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file or of all files below a folder; 0 if there is none."""
    fs, p = _at(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def modified(spark: SparkSession, path: str) -> int:
    """When a file was written, in milliseconds, by the clock of its file system."""
    fs, p = _at(spark, path)
    return fs.getFileStatus(p).getModificationTime()


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)
