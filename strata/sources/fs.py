"""File-system metadata through Hadoop's FileSystem API, so the same calls work
on local disk, HDFS and object stores (the driver's local disk is never assumed).
Metadata only: nothing here reads data."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _resolve(spark, path)
    return bool(fs.exists(p))


def total_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Size of all files under ``paths``."""
    total = 0
    for path in paths:
        p, fs = _resolve(spark, path)
        total += fs.getContentSummary(p).getLength()
    return int(total)


def largest_file(spark: SparkSession, path: str) -> int:
    """Size of the largest file under ``path`` (0 if there is none)."""
    p, fs = _resolve(spark, path)
    largest, files = 0, fs.listFiles(p, True)
    while files.hasNext():
        largest = max(largest, files.next().getLen())
    return int(largest)


def has_files(spark: SparkSession, directory: str) -> bool:
    """Whether any visible file (not a ``_``/``.`` name) lies under ``directory``."""
    p, fs = _resolve(spark, directory)
    if not fs.exists(p):
        return False
    files = fs.listFiles(p, True)
    while files.hasNext():  # ends at the first visible file
        if not files.next().getPath().getName().startswith(("_", ".")):
            return True
    return False


def subdirectories(spark: SparkSession, directory: str) -> list[str]:
    """Names of the folders directly under ``directory`` (sorted); [] if absent."""
    p, fs = _resolve(spark, directory)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory())


def delete(spark: SparkSession, path: str) -> None:
    """Delete ``path`` recursively."""
    p, fs = _resolve(spark, path)
    fs.delete(p, True)
