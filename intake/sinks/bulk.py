"""Bulk mode: entries of each input file are written, then a manifest line
``work_id<TAB>source path`` per input.

Commit order is kept: a batch's old manifests go first, then its data is
written, then its new manifests, so a manifest's presence means its data is
complete.

Layout: the reference writes one file per input.  With Spark's committer
every partition folder costs a serial rename on the driver at job commit, so
one folder per input would make the driver the bottleneck at millions of
inputs.  Outputs are therefore partitioned by ``batch_id`` (the planned batch
the inputs came in) and ``bucket`` = ``pmod(xxhash64(work_id), buckets)``,
with ``work_id`` kept as a column; manifests lie in the same folders below
their own root.  A batch is one folder that a replay replaces as a whole, so
nothing stays of inputs the replay no longer has.  ``rebalance`` lets AQE split
a bucket that holds a huge input over several tasks and pack small buckets
together.  A (batch, bucket) folder with its manifest is what the bundler takes
(:func:`bulk_units`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from intake.functions.paths import file_name, parent_dir, source_file_path
from intake.schemas import ENTRY_COLUMNS, ENTRY_DDL
from intake.sinks.files import drop_folder, folder_exists, partition_folder
from intake.sources.inventory import landing_inventory
from intake.sources.members import Members
from intake.sources.typed import TypeSpec

DEFAULT_BUCKETS = 64


def work_bucket(work_id, buckets: int = DEFAULT_BUCKETS) -> Column:
    c = F.col(work_id) if isinstance(work_id, str) else work_id
    return F.pmod(F.xxhash64(c), F.lit(buckets)).cast("int")


def _writer(df: DataFrame):
    return (df.hint("rebalance", "bucket").write.mode("overwrite")
            .option("partitionOverwriteMode", "static").partitionBy("bucket"))


def write_bulk(entries: DataFrame, items: DataFrame, out_dir: str, batch_id: str = "0",
               buckets: int = DEFAULT_BUCKETS) -> dict[str, str]:
    """Write ``entries`` (entry columns + ``work_id``) under ``out_dir/data``,
    then one manifest line per row of ``items`` (``work_id, source_path``)
    under ``out_dir/manifests``, both for batch ``batch_id``."""
    spark = entries.sparkSession
    base = out_dir.rstrip("/")
    data_dir, manifest_dir = f"{base}/data", f"{base}/manifests"
    manifests = partition_folder(spark, manifest_dir, "batch_id", batch_id)
    drop_folder(spark, manifests)
    data = entries.select(*ENTRY_COLUMNS, "work_id", work_bucket("work_id", buckets).alias("bucket"))
    _writer(data).parquet(partition_folder(spark, data_dir, "batch_id", batch_id))
    lines = items.select(F.concat_ws("\t", "work_id", "source_path").alias("value"),
                         work_bucket("work_id", buckets).alias("bucket"))
    _writer(lines).text(manifests)
    return {"data": data_dir, "manifests": manifest_dir}


def bulk_units(spark: SparkSession, out_dir: str, feed: str | None = None) -> DataFrame:
    """Bulk output as the bundler's inventory (``feed, path, name, length, mtime``):
    a row per (batch, bucket) data folder with the sum of its files' lengths and
    their last time, and a row ``<folder>.manifest`` per folder of its manifest lines."""
    base = out_dir.rstrip("/")

    def folders(root: str) -> DataFrame:
        files = landing_inventory(spark, f"{base}/{root}", recursive=True, feed=feed)
        return (files.where(F.col("path").rlike("/batch_id=[^/]*/bucket=[^/]*/[^/]*$"))
                .groupBy("feed", parent_dir("path").alias("path"))
                .agg(F.sum("length").alias("length"), F.max("mtime").alias("mtime")))

    beside = F.concat(F.regexp_replace("path", "/manifests(/batch_id=[^/]*/bucket=[^/]*)$", "/data$1"), F.lit(".manifest"))
    units = folders("data")
    if folder_exists(spark, f"{base}/manifests"):
        units = units.unionByName(folders("manifests").withColumn("path", beside))
    return units.select("feed", "path", file_name("path").alias("name"), "length", "mtime")


def read_units(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Entries of data folders of :func:`bulk_units`, with the folder as ``source_path``."""
    from intake.sources.entries import read_entries
    return read_entries(spark, paths, "work_id string").withColumn("source_path", parent_dir(source_file_path()))


def read_unit_manifests(spark: SparkSession, manifest_paths: list[str]) -> DataFrame:
    """Manifest lines of ``<folder>.manifest`` rows of :func:`bulk_units`."""
    tail = ".manifest"
    folders = ["/manifests/".join(p[:-len(tail)].rsplit("/data/", 1)) for p in manifest_paths]
    return spark.read.text(folders).select("value", source_file_path().alias("manifest_file"))


def unit_members(spark: SparkSession, out_dir: str) -> Members:
    """How tasks read the units of :func:`bulk_units`: the files of each data and manifest folder."""
    base = out_dir.rstrip("/")

    def files(root: str, member) -> DataFrame:
        listed = landing_inventory(spark, f"{base}/{root}", recursive=True)
        return (listed.where(F.col("path").rlike("/batch_id=[^/]*/bucket=[^/]*/[^/]*$"))
                .select(member.alias("member"), "path", "length"))

    own = parent_dir("path")
    manifests = None
    if folder_exists(spark, f"{base}/manifests"):
        manifests = files("manifests", F.regexp_replace(own, "/manifests(/batch_id=[^/]*/bucket=[^/]*)$", "/data$1"))
    return Members(TypeSpec("parquet", f"{ENTRY_DDL}, work_id string"), files("data", own), manifests)


def read_work_item(spark: SparkSession, data_dir: str, batch_id: str, work_id: str,
                   buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Entries of one input: partition pruning on (batch, bucket), then a
    pushed-down filter on ``work_id``."""
    from intake.sources.entries import read_entries
    bucket = spark.range(1).select(work_bucket(F.lit(work_id), buckets)).first()[0]
    df = read_entries(spark, data_dir, "work_id string, batch_id string, bucket int")
    return df.where((F.col("batch_id") == batch_id) & (F.col("bucket") == bucket)
                    & (F.col("work_id") == work_id))


def read_manifests(spark: SparkSession, manifest_dir: str) -> DataFrame:
    """Manifest lines with the file they came from."""
    return (spark.read.text(manifest_dir)
            .select("value", source_file_path().alias("manifest_file")))
