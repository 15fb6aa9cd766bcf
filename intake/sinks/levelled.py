"""Live tables in key buckets: runs of sorted entries, and versions that readers pin.

    data/run=<name>/bucket=<k>/   a run's entries of a bucket, in key order
    versions/version=<n>          the runs that count, a row per run and bucket

A micro-batch adds one run, of the buckets its keys fall in.  A version is a small table that names the
runs of every bucket; the newest complete one is current.  A reader takes the runs of one version, and
nothing a version names is changed or deleted before :func:`vacuum` forgets the version, so a reader that
began before a compaction ends with what it began with.

:func:`compact` merges the runs of the buckets that hold too many, and only those are read and written.
A batch that is there is replaced; one that a merged run holds already is not added to that bucket again (a
merged run knows the last batch of each stream that is in it; a stream's batches come in order).  One writer at a
time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intake.operators.combine import plain_number
from intake.schemas import ENTRY_COLUMNS, ENTRY_DDL, ENTRY_KEY
from intake.sinks.files import drop_folder, folder_exists, folder_names, partition_folder
from intake.sinks.live import batch_tag

BUCKETS, MAX_RUNS = 64, 8
PART_ROWS = 1_000_000       # entries that a task folds when runs are merged or read, about
ROWS = f"{ENTRY_DDL}, batch_id string"
# a batch's run has its stream and number, a merged one the last number of every stream in it; rows: entries of the bucket
VERSION = "bucket int, run string, run_id string, batch long, held map<string, bigint>, rows long"
_COLUMNS = ["bucket", "run", "run_id", "batch", "held", "rows"]


def _base(table_dir: str) -> str:
    return table_dir.rstrip("/")


def versions(spark: SparkSession, table_dir: str) -> list[int]:
    """Numbers of the complete versions, ascending."""
    where = f"{_base(table_dir)}/versions"
    numbers = [int(n[len("version="):]) for n in folder_names(spark, where) if n.startswith("version=")]
    return sorted(n for n in numbers if folder_exists(spark, f"{where}/version={n}/_SUCCESS"))


def runs_of(spark: SparkSession, table_dir: str, version: int | None = None) -> DataFrame:
    """(bucket, run, run_id, batch, held, rows) of a version (default: the newest; none yet: no rows)."""
    done = versions(spark, table_dir)
    if version is None and not done:
        return spark.createDataFrame([], VERSION)
    return spark.read.schema(VERSION).parquet(f"{_base(table_dir)}/versions/version={done[-1] if version is None else version}")


def _commit(runs: DataFrame, table_dir: str) -> int:
    done = versions(runs.sparkSession, table_dir)
    number = done[-1] + 1 if done else 0
    runs.select(*_COLUMNS).coalesce(1).write.mode("overwrite").option(
        "partitionOverwriteMode", "static").parquet(f"{_base(table_dir)}/versions/version={number}")
    return number


def _bucket(buckets: int):
    return F.pmod(F.xxhash64(*ENTRY_KEY), F.lit(buckets)).cast("int").alias("bucket")


def _write_run(rows: DataFrame, table_dir: str, run: str) -> DataFrame:
    """Write (entry columns, batch_id, bucket), dealt by bucket, as a run, each bucket in key order; (bucket, rows) of
    what was written."""
    where = partition_folder(rows.sparkSession, f"{_base(table_dir)}/data", "run", run)
    (rows.sortWithinPartitions("bucket", *ENTRY_KEY).write.mode("overwrite")
     .option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(where))
    return rows.sparkSession.read.schema("table_name string, bucket int").parquet(where).groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"))


def _folded(rows: DataFrame, sum_tables: Sequence[str], by: Sequence[str] = (), sum_type: str = "decimal(28,9)") -> DataFrame:
    """One entry per key: the newest (latest ts, then batch, then value), counters summed.

    ``by``: columns the key implies, grouped on as well; ``bucket`` among them is kept.  Aggregates of texts sort and
    ship their rows.  So the newest is one struct of the entry's own fields, and a short text comes first that is in key
    order unless tables begin alike: a sort compares eight bytes of its first column without looking into the rows."""
    is_sum = F.col("table_name").isin(list(sum_tables)) if sum_tables else F.lit(False)
    own = [c for c in ("ts", "batch_id") if c in rows.columns]
    text = F.when(is_sum, F.lit(None)).otherwise(F.col("value")).alias("value")
    near = F.substring(F.concat(F.substring("table_name", 1, 1), "row_key"), 1, 8).alias("_near")
    agg = rows.groupBy(near, *by, *ENTRY_KEY).agg(
        F.max(F.struct(*own, text)).alias("_newest"), F.sum(F.when(is_sum, F.col("value").try_cast(sum_type))).alias("_sum"))
    value = F.when(is_sum, plain_number(F.col("_sum"))).otherwise(F.col("_newest.value")).alias("value")
    return agg.select(*ENTRY_KEY, "_newest.ts", value, *[f"_newest.{c}" for c in own[1:]], *[c for c in by if c == "bucket"])


def _entries(spark: SparkSession, table_dir: str, runs: DataFrame) -> DataFrame:
    """Entries of the runs and buckets named, which are at most buckets x runs folders."""
    base = f"{_base(table_dir)}/data"
    named = [(r["run"], r["bucket"]) for r in runs.select("run", "bucket").collect()]
    if not named:
        return spark.createDataFrame([], f"{ROWS}, bucket int")
    folders = [f"{partition_folder(spark, base, 'run', run)}/bucket={bucket}" for run, bucket in named]
    return spark.read.schema(f"{ROWS}, bucket int").option("basePath", base).parquet(*folders)


def _dealt(spark: SparkSession, table_dir: str, runs: DataFrame) -> DataFrame:
    """Entries of the runs, a task to each part (``_part``) of a bucket.  A run holds a key once and in key order: there is
    nothing to fold before the rows are dealt, and what a task gets is in order run by run."""
    size = runs.groupBy("bucket").agg(F.sum("rows").alias("n")).agg(F.max("bucket").alias("last"), F.max("n").alias("n")).first()
    parts = max(1, -(-(size["n"] or 0) // PART_ROWS))
    part = F.col("bucket") * parts + F.pmod(F.shiftright(F.xxhash64(*ENTRY_KEY), 32), F.lit(parts)).cast("int")
    return _entries(spark, table_dir, runs).withColumn("_part", part).repartitionById(((size["last"] or 0) + 1) * parts, F.col("_part"))


def upsert(entries: DataFrame, table_dir: str, run_id: str, batch: int, sum_tables: Sequence[str] = (), buckets: int = BUCKETS) -> int:
    """Add batch ``batch`` of the stream ``run_id`` (entry columns) and return the new version.

    The batch is folded to one entry per key first.  A batch that is there is replaced; in buckets where it was
    merged already its entries are left out, as they are in the merged run."""
    spark = entries.sparkSession
    old, tag = runs_of(spark, table_dir), batch_tag(run_id, batch)
    # a row per bucket
    merged = [r["bucket"] for r in old.where(F.col("held")[run_id] >= batch).select("bucket").distinct().collect()]
    left = entries.select(*ENTRY_COLUMNS)
    if merged:
        left = left.where(~_bucket(buckets).isin(merged))
    rows = _folded(left, sum_tables).select("*", F.lit(tag).alias("batch_id"), _bucket(buckets))
    mine = F.coalesce((F.col("run_id") == run_id) & (F.col("batch") == batch), F.lit(False))
    name, done = f"batch-{tag}", versions(spark, table_dir)
    if folder_exists(spark, partition_folder(spark, f"{_base(table_dir)}/data", "run", name)):
        name = f"{name}-{done[-1] + 1 if done else 0}"      # versions may name the first one: a replay has a name of its own
    written = _write_run(rows.hint("rebalance", "bucket"), table_dir, name)
    new = written.select("bucket", F.lit(name).alias("run"), F.lit(run_id).alias("run_id"), F.lit(batch).cast("long").alias("batch"),
                         F.lit(None).cast("map<string, bigint>").alias("held"), "rows")
    return _commit(old.where(~mine).unionByName(new), table_dir)


def read(spark: SparkSession, table_dir: str, sum_tables: Sequence[str] = (), version: int | None = None) -> DataFrame:
    """Current entries of a version (default: the newest), one per key; the version is pinned here, not when the
    frame is evaluated."""
    return _folded(_dealt(spark, table_dir, runs_of(spark, table_dir, version)), sum_tables, ["_part", "bucket"]).select(*ENTRY_COLUMNS)


def compact(spark: SparkSession, table_dir: str, sum_tables: Sequence[str] = (), max_runs: int = MAX_RUNS) -> list[int]:
    """Merge the runs of the buckets that hold more than ``max_runs``; the buckets that were merged.

    The newest batch of every stream is left as it is, since it may be replayed."""
    runs = runs_of(spark, table_dir)
    last = {r["run_id"]: r["b"] for r in runs.where("run_id is not null").groupBy("run_id").agg(F.max("batch").alias("b")).collect()}
    full = [r["bucket"] for r in runs.groupBy("bucket").count().where(F.col("count") > max_runs).orderBy("bucket").collect()]
    if not full:
        return []
    open_ = F.lit(False)
    for run_id, batch in last.items():                  # a stream each
        open_ = open_ | ((F.col("run_id") == run_id) & (F.col("batch") == batch))
    here = F.col("bucket").isin(full) & ~F.coalesce(open_, F.lit(False))
    old = runs.where(here)
    name = f"merged-{versions(spark, table_dir)[-1]}"
    written = _write_run(_folded(_dealt(spark, table_dir, old), sum_tables, ["_part", "bucket"]), table_dir, name)
    one = F.when(F.col("run_id").isNotNull(), F.create_map("run_id", "batch")).otherwise(F.col("held"))
    held = (old.select("bucket", F.explode(one).alias("k", "v")).groupBy("bucket", "k").agg(F.max("v").alias("v"))
            .groupBy("bucket").agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("held")))
    new = held.join(written, "bucket").select("bucket", F.lit(name).alias("run"), F.lit(None).cast("string").alias("run_id"),
                                              F.lit(None).cast("long").alias("batch"), "held", "rows")
    _commit(runs.where(~here).unionByName(new), table_dir)
    return full


def vacuum(spark: SparkSession, table_dir: str, keep: int = 2) -> int:
    """Forget all but the ``keep`` newest versions and delete the run folders that none of those names; the number deleted."""
    done = versions(spark, table_dir)
    base = _base(table_dir)
    for n in done[:-keep] if keep else []:
        drop_folder(spark, f"{base}/versions/version={n}")
    used: set[tuple[str, int]] = set()
    for n in done[-keep:]:
        used |= {(r["run"], r["bucket"]) for r in runs_of(spark, table_dir, n).select("run", "bucket").collect()}
    gone = 0
    for folder in [f for f in folder_names(spark, f"{base}/data") if f.startswith("run=")]:
        run = folder[len("run="):]
        for name in folder_names(spark, f"{base}/data/{folder}"):
            if name.startswith("bucket=") and (run, int(name[len("bucket="):])) not in used:
                drop_folder(spark, f"{base}/data/{folder}/{name}")
                gone += 1
    return gone
