"""A bundler's members read by tasks: once each, a bad one told from the good ones.

A member is a file, or a folder of files (bulk output).  Its manifest is the file
``<member>.manifest`` beside it, or what ``manifests`` names.  Neither the paths of
members nor those of manifests reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intake.functions.paths import path_key
from intake.operators.joins import broadcast_if_small
from intake.sources.groups import FILE, REJECT, read_groups
from intake.sources.typed import TypeSpec


@dataclass(frozen=True)
class Members:
    """How members are read: a format of ``intake.sources.formats`` with the entries' columns as schema;
    ``files`` and ``manifests`` (``member, path, length``) where a member or its manifest is a folder of files."""
    spec: TypeSpec
    files: DataFrame | None = None
    manifests: DataFrame | None = None


def _read(spark: SparkSession, files: DataFrame, spec: TypeSpec) -> DataFrame:
    """Records of ``files`` (member, path, length) with the member as ``source_path``, and ``reject``."""
    rows = read_groups(spark, files.select("path", "length"), spec.format, spec.schema, spec.options)
    lookup = broadcast_if_small(files.select(path_key("path").alias("_key"), "member").distinct())
    return rows.withColumn("_key", path_key(FILE)).drop(FILE).join(lookup, "_key").drop("_key").withColumnRenamed("member", FILE)


def read_members(spark: SparkSession, members: DataFrame, how: Members) -> DataFrame:
    """Records of ``members`` (path, length): the columns of the schema, ``source_path`` (the member) and
    ``reject`` (why a member could not be read; null in records)."""
    wanted = members.select(F.col("path").alias("member"), "length")
    if how.files is None:
        return _read(spark, wanted.select("member", F.col("member").alias("path"), "length"), how.spec)
    return _read(spark, how.files.select("member", "path", "length").join(wanted.select("member"), "member", "left_semi"), how.spec)


def read_manifest_lines(spark: SparkSession, members: DataFrame, inventory: DataFrame, how: Members) -> DataFrame:
    """Lines of the members' manifests (``value, manifest_file, reject``).  ``inventory`` has the manifests beside
    the members, unless ``how`` says where they are."""
    own = members.select("path").distinct()
    if how.manifests is None:
        beside = own.select(F.col("path").alias("member"), F.concat("path", F.lit(".manifest")).alias("path"))
        files = beside.join(inventory.select("path", "length"), "path").select("member", "path", "length")
    else:
        files = how.manifests.select("member", "path", "length").join(own.withColumnRenamed("path", "member"), "member", "left_semi")
    lines = read_groups(spark, files.select("path", "length"), "text", "value string")
    return lines.select("value", F.col(FILE).alias("manifest_file"), REJECT)
