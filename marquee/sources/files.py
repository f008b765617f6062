"""State of files, asked of the file system that holds them."""

from __future__ import annotations

from pyspark.sql import SparkSession


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder this library wrote."""
    context = spark.sparkContext
    located = context._jvm.org.apache.hadoop.fs.Path(path)
    located.getFileSystem(context._jsc.hadoopConfiguration()).delete(located, True)


def make(spark: SparkSession, path: str) -> None:
    """Create a folder; one that is there stays as it is."""
    context = spark.sparkContext
    located = context._jvm.org.apache.hadoop.fs.Path(path)
    located.getFileSystem(context._jsc.hadoopConfiguration()).mkdirs(located)


def remove_uri(spark: SparkSession, uri: str) -> None:
    """:func:`remove` of a folder named as file sources name it, with escapes."""
    remove(spark, spark.sparkContext._jvm.java.net.URI.create(uri))


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder."""
    context = spark.sparkContext
    located = context._jvm.org.apache.hadoop.fs.Path(path)
    found = located.getFileSystem(context._jsc.hadoopConfiguration()).listStatus(located)
    return [status.getPath().getName() for status in found]


def exists(spark: SparkSession, path: str) -> bool:
    context = spark.sparkContext
    located = context._jvm.org.apache.hadoop.fs.Path(path)
    return located.getFileSystem(context._jsc.hadoopConfiguration()).exists(located)
