"""Folders that sinks replace as a whole, by the Hadoop file API of the session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def folder_exists(spark: SparkSession, path: str) -> bool:
    jpath, fs = _at(spark, path)
    return fs.exists(jpath)


def drop_folder(spark: SparkSession, path: str) -> None:
    jpath, fs = _at(spark, path)
    fs.delete(jpath, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder of few entries; none if it is not there."""
    jpath, fs = _at(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(jpath)] if fs.exists(jpath) else []


def partition_folder(spark: SparkSession, base: str, column: str, value: str) -> str:
    """``base/column=value``, the value escaped as Spark does for partition folders."""
    escaped = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)
    return f"{base.rstrip('/')}/{column}={escaped}"
