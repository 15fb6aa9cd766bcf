"""Typed reads of work items: each data type names a file format, a fixed
schema and reader options (no inference in production paths).

Items of one data type and format are read together, and the data types are
then stacked with ``unionByName(allowMissingColumns=True)``.  Spark's own formats
go through ``spark.read`` over their paths, which Spark's file sources need on the
driver (never the records); formats of ``intake.sources.formats`` go through
file groups, where no path reaches the driver.  ``guarded`` reads csv, json, text and
parquet that way too: a file that cannot be read then gives a row with ``reject``
instead of an error.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from intake.functions.paths import source_file_path
from intake.sources import storage
from intake.sources.formats import FORMATS
from intake.sources.groups import REJECT, STAT, STAT_TYPE, read_groups

SPARK_FORMATS = ("csv", "json", "parquet", "orc", "text", "binaryFile")   # read without a further package


@dataclass(frozen=True)
class TypeSpec:
    format: str
    schema: T.StructType | str
    options: Mapping[str, str] = field(default_factory=dict)


def can_guard(fmt: str, spec: TypeSpec, schemes: set[str]) -> bool:
    """Whether tasks can read the format themselves: known to them, records not over several lines, in a store they can open."""
    return (fmt in FORMATS and str(spec.options.get("multiLine", "false")).lower() != "true"
            and all(storage.openable(f"{s}:") for s in schemes))


def read_typed_feed(spark: SparkSession, items: DataFrame,
                    registry: Mapping[str, TypeSpec], guarded: bool = False, stats: bool = False) -> DataFrame:
    """Records of every work item (``path, data_type`` and optionally the
    item's ``format`` and ``length``), tagged with the trimmed ``data_type`` and their
    ``source_path``.  The item's format wins over the registry's, as the
    reference opens each file with the format its message names; schema and
    options come from the registry.  A data type missing from the registry is
    an error.

    A file of a format of our own that cannot be read is an error, as with Spark's
    formats; with ``guarded`` it is a row whose ``reject`` says why (null in
    records), and so it is for csv, json, text and parquet.  ``stats`` (with ``guarded``): see
    :func:`intake.sources.groups.read_groups`; formats that only Spark reads have no such rows."""
    items = items.select("path", F.trim("data_type").alias("dt"),
                         (F.col("format") if "format" in items.columns else F.lit(None).cast("string")).alias("fmt"),
                         (F.col("length") if "length" in items.columns else F.lit(None)).cast("long").alias("length"))
    # a row per data type and format, not per file
    kinds = [(r["dt"], r["fmt"], set(r["schemes"])) for r in items.groupBy("dt", "fmt").agg(
        F.collect_set(F.lower(F.regexp_extract("path", "^(?:([A-Za-z][A-Za-z0-9+.-]*):)?", 1))).alias("schemes")).collect()]
    kinds = [(dt, fmt, {s or "file" for s in schemes}) for dt, fmt, schemes in kinds]
    unknown = {dt for dt, _, _ in kinds} - set(registry)
    if unknown:
        raise KeyError(f"data types without a registry entry: {sorted(map(str, unknown))}")
    frames = []
    for dt, fmt, schemes in sorted(kinds, key=lambda k: (k[0], k[1] or "")):
        spec, own = registry[dt], fmt or registry[dt].format
        mine = items.where((F.col("dt") == dt) & F.col("fmt").eqNullSafe(F.lit(fmt)))
        if (guarded or own not in SPARK_FORMATS) and can_guard(own, spec, schemes):
            df = read_groups(spark, mine.select("path", "length"), own, spec.schema, spec.options, stats=stats and guarded)
            if not guarded:
                df = df.where(F.when(F.col(REJECT).isNull(), True).otherwise(F.raise_error(
                    F.concat(F.lit("cannot read "), "source_path", F.lit(": "), REJECT)).cast("boolean"))).drop(REJECT)
        else:
            paths = sorted(r["path"] for r in mine.select("path").distinct().collect())
            df = (spark.read.format(own).schema(spec.schema).options(**dict(spec.options)).load(paths)
                  .select(source_file_path().alias("source_path"), "*"))
            if guarded:
                df = df.withColumn(REJECT, F.lit(None).cast("string"))
            if guarded and stats:
                df = df.withColumn(STAT, F.lit(None).cast(STAT_TYPE))
        frames.append(df.select(F.lit(dt).alias("data_type"), "*"))
    if not frames:
        raise ValueError("no work items to read")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
