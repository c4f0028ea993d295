"""Folders on whatever storage Spark uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, if it is there."""
    system, target = _file_system(spark, path)
    system.delete(target, True)


def finished_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below a path whose write was finished; none if the path is not there."""
    system, target = _file_system(spark, path)
    if not system.exists(target):
        return []
    mark = spark._jvm.org.apache.hadoop.fs.Path
    return [s.getPath().getName() for s in system.listStatus(target) if system.exists(mark(s.getPath(), "_SUCCESS"))]


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below a path, hidden ones left out; none if the path is not there."""
    system, target = _file_system(spark, path)
    if not system.exists(target):
        return []
    names = [s.getPath().getName() for s in system.listStatus(target) if s.isDirectory()]
    return sorted(n for n in names if n[0] not in "._")


def list_paths(spark: SparkSession, path: str, suffix: str = "") -> list[tuple[str, int]]:
    """(path, bytes) of the files below a folder, in name order; hidden ones are left out."""
    system, target = _file_system(spark, path)
    files, found = system.listFiles(target, True), []
    while files.hasNext():
        status = files.next()
        if status.getPath().getName().endswith(suffix) and status.getPath().getName()[0] not in "._":
            found.append((status.getPath().toString(), status.getLen()))
    return sorted(found)


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a text file; None for an empty one."""
    system, target = _file_system(spark, path)
    stream = system.open(target)
    try:
        return spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()
