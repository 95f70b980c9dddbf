"""Folders of a shared file system, through Hadoop's own access so that any scheme works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none where there is no such folder."""
    place, files = _place(spark, path)
    if not files.exists(place):
        return []
    return sorted(f.getPath().getName() for f in files.listStatus(place) if f.isDirectory())


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a job has written the folder to its end."""
    place, files = _place(spark, f"{path}/_SUCCESS")
    return files.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    place, files = _place(spark, path)
    files.delete(place, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file, None where there is none."""
    place, files = _place(spark, path)
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, whole or not at all: written under another name and renamed."""
    place, files = _place(spark, path)
    beside, _ = _place(spark, f"{path}.new")
    stream = files.create(beside, True)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    files.delete(place, False)
    files.rename(beside, place)
