"""Folders and small files of a lake, through the file system that Spark uses for its path."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _on(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _on(spark, path)
    return system.exists(place)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder; empty if there is no such folder."""
    system, place = _on(spark, path)
    return [s.getPath().getName() for s in system.listStatus(place)] if system.exists(place) else []


def count_files(spark: SparkSession, path: str) -> int:
    """Files in a folder and below it, counted by the file system; none if there is no such folder."""
    system, place = _on(spark, path)
    return system.getContentSummary(place).getFileCount() if system.exists(place) else 0


def make_folder(spark: SparkSession, path: str) -> None:
    system, place = _on(spark, path)
    system.mkdirs(place)


def delete_folder(spark: SparkSession, path: str) -> None:
    system, place = _on(spark, path)
    system.delete(place, True)


def set_modified(spark: SparkSession, path: str, milliseconds: int) -> None:
    """Set the modification time of a file, as copying tools and archives do."""
    system, place = _on(spark, path)
    system.setTimes(place, milliseconds, -1)
