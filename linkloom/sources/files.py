"""Files as Spark's file systems see them, so on any path that Spark reads."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

# Files of a frame that are asked for their size; more are taken to be as large as these on average.
_ASKED = 1000
# So much of the files a frame is read from makes one task of :func:`spread`, some half a million
# links, up to so many tasks or as many as the session gives to a shuffle.
_EACH, _MOST = 8 << 20, 4096


def _located(spark: SparkSession, path: str):
    """The Hadoop path and its file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, files = _located(spark, path)
    return files.exists(where)


def is_complete(spark: SparkSession, folder: str) -> bool:
    """Whether a job of Spark that wrote ``folder`` came to its end."""
    return exists(spark, f"{folder}/_SUCCESS")


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if it is missing."""
    where, files = _located(spark, folder)
    if not files.exists(where):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(where))


def delete(spark: SparkSession, path: str) -> None:
    where, files = _located(spark, path)
    files.delete(where, True)


def version_of(spark: SparkSession, paths: list[str]) -> str:
    """A name for the content of some files or folders: it changes when a file comes, goes, or is
    written anew."""
    seen = hashlib.sha256()
    for path in sorted(paths):
        where, files = _located(spark, path)
        found = files.listFiles(where, True)
        lines = []
        while found.hasNext():
            status = found.next()
            lines.append(f"{status.getPath()} {status.getLen()} {status.getModificationTime()}")
        seen.update("\n".join([path, *sorted(lines), ""]).encode())
    return seen.hexdigest()[:32]


def size_of(frame: DataFrame) -> int:
    """Bytes of the files that a frame is read from; 0 if it is read from none."""
    spark, paths = frame.sparkSession, sorted(frame.inputFiles())
    total = 0
    for path in paths[:_ASKED]:
        where, files = _located(spark, path)
        total += files.getFileStatus(where).getLen()
    return total * len(paths) // max(1, min(len(paths), _ASKED))


def spread(frame: DataFrame, *keys: str) -> DataFrame:
    """``frame`` dealt out by ``keys`` to tasks whose number grows with the files it is read from, so
    that what a task holds of it does not. AQE would merge them up to its advisory size, which is of
    packed bytes: an aggregate of many small keys takes some thirty times that in memory.

    Rows are dealt out as they are, so take keys of which single ones have few rows of all.
    """
    tasks = -(-size_of(frame) // _EACH)
    if not tasks:
        return frame.repartition(*keys)
    most = max(_MOST, int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return frame.repartition(min(tasks, most), *keys)
