"""Compaction: concatenate the entries of a batch's files into one bundle.

Rows are kept as they are (no sort, no dedupe).  All bundles of one run go to
one ``tick=`` folder below the dated output folder, dealt over a fixed number of
``bucket=`` folders with ``bundle_id`` as a column: with a folder per bundle the
commit would be a serial rename for every few files.  AQE's rebalance splits a
huge bundle over several tasks instead of funnelling it through one.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intake.functions.paths import source_file_path
from intake.operators.bundle import bundle_ids
from intake.operators.joins import broadcast_if_small
from intake.schemas import ENTRY_COLUMNS, ENTRY_DDL
from intake.sinks.files import folder_exists, partition_folder

BUNDLE_BUCKETS = 64
LEDGER = "path string, length long, mtime timestamp_ntz, bundle_id string, tick string"


def bundle_folder(output_dir: str, as_of_text: str | None, dated: bool = True) -> str:
    base = output_dir.rstrip("/")
    return f"{base}/{as_of_text}" if dated and as_of_text else base


def compact_bundles(entries: DataFrame, plan: DataFrame, folder: str,
                    only_fired: bool = True, columns=None, tick: str | None = None,
                    buckets: int = BUNDLE_BUCKETS) -> DataFrame:
    """Write the entries (``source_path`` + entry columns) of every planned
    batch (``feed, path, length, mtime, batch_no, fired``) as bundles under ``folder``.

    ``tick`` names the run (default: a digest of its bundle ids); its folder is
    replaced as a whole, so a replay of the same plan changes nothing.
    Returns the members table (``feed, path, length, mtime, batch_no, bundle_id,
    tick``) that was written, for the accounting step."""
    p = (plan.where(F.col("fired")) if only_fired else plan).persist(StorageLevel.MEMORY_AND_DISK)
    # the plan feeds both the members and their ids: evaluate it once, and
    # freeze the member table (one row per file) for the write and the caller
    # null-safe: files without a feed are one feed, as in batch_plan
    ids = bundle_ids(p).select(F.col("feed").alias("_feed"), F.col("batch_no").alias("_no"), "bundle_id")
    members = (p.select("feed", "path", "length", "mtime", "batch_no")
               .join(ids, F.col("feed").eqNullSafe(F.col("_feed")) & (F.col("batch_no") == F.col("_no")))
               .drop("_feed", "_no").checkpoint(eager=True))
    p.unpersist()
    if tick is None:
        part = F.conv(F.substring("bundle_id", 1, 15), 16, 10).cast("decimal(20,0)")
        tick = (members.select("bundle_id").distinct()
                .agg(F.md5(F.concat_ws("#", F.count(F.lit(1)).cast("string"), F.sum(part).cast("string"))).alias("t")).first()["t"])
    keep = list(columns) if columns else [*ENTRY_COLUMNS]
    # one row per member file: broadcast when small, so the bundle data is
    # shuffled once (by bundle) instead of twice
    lookup = broadcast_if_small(members.select(F.col("path").alias("source_path"), "bundle_id"))
    bucket = F.pmod(F.xxhash64("bundle_id"), F.lit(buckets)).cast("int")
    (entries.join(lookup, "source_path").select(*keep, "source_path", "bundle_id", bucket.alias("bucket"))
     .hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy("bucket").parquet(partition_folder(entries.sparkSession, folder, "tick", tick)))
    return members.withColumn("tick", F.lit(tick))


def bundled_files(spark: SparkSession, state_dir: str) -> DataFrame:
    """The ledger of bundled members (``path, length, mtime, bundle_id, tick``)."""
    ledger = f"{state_dir.rstrip('/')}/bundled"
    if not folder_exists(spark, ledger):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(ledger)


def record_bundled(members: DataFrame, state_dir: str, tick: str) -> None:
    """Add one run's members to the ledger.  A bundle counts from here on: what a
    run wrote that broke off before is not in the ledger and is not read."""
    spark = members.sparkSession
    (members.select("path", "length", "mtime", "bundle_id").write.mode("overwrite").option("partitionOverwriteMode", "static")
     .parquet(partition_folder(spark, f"{state_dir.rstrip('/')}/bundled", "tick", tick)))


def read_bundles(spark: SparkSession, output_dir: str, state_dir: str) -> DataFrame:
    """Entries of all bundles of the ledger, with ``source_path, bundle_id, tick``."""
    rows = (spark.read.schema(f"{ENTRY_DDL}, source_path string, bundle_id string")
            .option("recursiveFileLookup", "true").parquet(output_dir)
            # of a row's path the tick alone is decoded
            .withColumn("tick", source_file_path(F.substring_index(F.substring_index("_metadata.file_path", "/tick=", -1), "/", 1))))
    done = bundled_files(spark, state_dir).select("tick", "bundle_id").distinct()
    return rows.join(broadcast_if_small(done), ["tick", "bundle_id"], "left_semi")
