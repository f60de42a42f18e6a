"""Folders of tables, through Spark's own file systems."""

from __future__ import annotations

from pyspark.sql import SparkSession

NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def place(spark: SparkSession, path: str):
    """File system and path object of a folder or file."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def matching(spark: SparkSession, pattern: str) -> list:
    fs, found = place(spark, pattern)
    return [status.getPath() for status in fs.globStatus(found) or []]


def remove(spark: SparkSession, path: str) -> None:
    fs, found = place(spark, path)
    fs.delete(found, True)


def partition_folder(spark: SparkSession, path: str, partition: str, value):
    """File system and path of a partition value's folder, named as Spark's writers name it."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    name = NULL_FOLDER if value is None else escape(str(value))
    # the name is taken as it is, without a second reading of its escapes
    fs, folder = place(spark, path)
    return fs, spark._jvm.org.apache.hadoop.fs.Path(folder, f"{partition}={name}")


def partition_files(spark: SparkSession, path: str, partition: str, values: list) -> dict:
    """The names of the files each partition value holds, empty for a value without a folder."""
    found = {}
    for value in values:
        fs, folder = partition_folder(spark, path, partition, value)
        found[value] = {status.getPath().getName() for status in fs.listStatus(folder)} if fs.exists(folder) else set()
    return found


def drop_stale_partitions(spark: SparkSession, path: str, partition: str, before: dict) -> list:
    """Remove the partitions that a write left as they were in ``before``; returns their values.

    A dynamic overwrite replaces all files of a partition, and no two writes name a file alike. So a partition that has no
    new file got no row, which is known without evaluating the written rows a second time.
    """
    now = partition_files(spark, path, partition, list(before))
    stale = [value for value, files in before.items() if files and now[value] <= files]
    for value in stale:
        fs, folder = partition_folder(spark, path, partition, value)
        fs.delete(folder, True)
    return stale
