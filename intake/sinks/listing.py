"""Snapshots of a directory tree: a listing a run, and what changed since the one before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from intake.sinks.files import drop_folder, folder_exists, folder_names, partition_folder
from intake.sources.walk import LISTING, listing_diff, walk


def snapshots(spark: SparkSession, state_dir: str) -> list[int]:
    """Numbers of the complete snapshots below ``state_dir``, ascending."""
    base = f"{state_dir.rstrip('/')}/listing"
    numbers = [int(n[len("snapshot="):]) for n in folder_names(spark, base) if n.startswith("snapshot=")]
    return sorted(n for n in numbers if folder_exists(spark, f"{base}/snapshot={n}/_SUCCESS"))


def take_snapshot(spark: SparkSession, root: str, state_dir: str, keep: int = 2, **options) -> tuple[int, DataFrame]:
    """List ``root``, write the listing below ``state_dir`` and compare it with the one before: its number
    (from 0) and the rows of :func:`listing_diff`.  A run that breaks off leaves no complete snapshot, so the
    next one compares with the last complete one; the ``keep`` newest are kept."""
    base = f"{state_dir.rstrip('/')}/listing"
    done = snapshots(spark, state_dir)
    number = done[-1] + 1 if done else 0
    where = partition_folder(spark, base, "snapshot", str(number))
    walk(spark, root, **options).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(where)
    after = spark.read.schema(LISTING).parquet(where)
    before = spark.read.schema(LISTING).parquet(f"{base}/snapshot={done[-1]}") if done else spark.createDataFrame([], LISTING)
    for old in done[:-(keep - 1)] if keep > 1 else []:
        drop_folder(spark, f"{base}/snapshot={old}")
    return number, listing_diff(before, after)
