"""Folders of a table on whatever store holds it, through Hadoop's file system."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


def _folder(spark: SparkSession, path: str):
    """Hadoop's file system and path of a folder; works on whatever store the path names."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def numbered_folders(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """The numbers n of the completely written folders ``<prefix>=n`` below a path, in order."""
    files, where = _folder(spark, path)
    if not files.exists(where):
        return []
    names = [status.getPath() for status in files.listStatus(where)]
    found = []
    for place in names:
        number = re.fullmatch(rf"{prefix}=(\d+)", place.getName())
        if number and files.exists(_folder(spark, f"{place.toString()}/_SUCCESS")[1]):
            found.append(int(number[1]))
    return sorted(found)


def remove_folder(spark: SparkSession, path: str) -> None:
    files, where = _folder(spark, path)
    files.delete(where, True)


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _folder(spark, path)
    return files.exists(where)
