"""The feeder's fixed-rate scan as a Structured Streaming query.

A ``rate`` source is only the clock: each trigger is one tick of the
reference's scheduled scan, and the stream's checkpoint numbers the ticks.
Each tick lists the landing folder (zero-length files included), drops files
taken by earlier ticks (same path, length and time: a file that is replaced is
taken again), applies the reference's rules (ignore prefix,
quarantine, count / bytes / age thresholds) and writes the work items of the
feeds that fire into ``state_dir/work_items/tick=<n>``.

Replay safety: the time a tick runs at is recorded once per tick and reused
when Spark replays the tick after a failure, the tick's items overwrite only
their own partition, and "already taken" is the snapshot written by the tick
before (files taken earlier and still in the folder), so its size follows
the landing folder, not the history.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from intake.config import FeederConfig, ScanConfig
from intake.plans.lifecycle import feeder_tick
from intake.schemas import QUARANTINE_SCHEMA
from intake.sinks.mover import move_files, plan_moves
from intake.sources.inventory import feed_inventories, landing_inventory


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def tick_time(spark: SparkSession, ticks_dir: str, tick: int) -> dt.datetime:
    """The wall-clock time of ``tick``, recorded on its first run."""
    where = f"{ticks_dir}/tick={tick}"
    if _exists(spark, f"{where}/_SUCCESS"):
        return spark.read.parquet(where).first()["as_of"]
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    (spark.createDataFrame([(now.isoformat(sep=" "),)], "t string")
     .select(F.col("t").cast("timestamp_ntz").alias("as_of"))
     .coalesce(1).write.mode("overwrite").parquet(where))
    return spark.read.parquet(where).first()["as_of"]


#: What makes a landed file that file: one that lands again under an old name is another.
IDENTITY = ["path", "length", "mtime"]
_TAKEN = "path string, length long, mtime timestamp_ntz"


def taken_before(spark: SparkSession, taken_dir: str, tick: int) -> DataFrame:
    """Files (path, length, mtime) taken by ticks before ``tick``: the snapshot the
    previous tick wrote (immutable once the next tick runs)."""
    where = f"{taken_dir}/tick={tick - 1}"
    if tick == 0 or not _exists(spark, f"{where}/_SUCCESS"):
        return spark.createDataFrame([], _TAKEN)
    return spark.read.schema(_TAKEN).parquet(where)


def feeder_stream(spark: SparkSession, landing_dir: str | dict[str, str], state_dir: str, scan: ScanConfig,
                  feeder: FeederConfig, feed: str = "default", trigger_ms: int = 5000,
                  failures_dir: str | None = None, query_name: str | None = None,
                  limits: DataFrame | None = None, move: bool = False) -> StreamingQuery:
    """Start the feeder loop; see the module docstring.  ``landing_dir`` may
    map several feeds to their folders (``{feed: folder}``), and ``limits``
    give feeds their own thresholds — all feeds run in the same ticks.

    With ``move`` a tick's files then move to their flagged targets, by tasks and from
    intents below ``state_dir/moves`` (see :mod:`intake.sinks.mover`): the landing folder
    keeps what no tick has taken.  A tick that broke off while moving is finished by its
    items and intents as written, not planned anew."""
    state = state_dir.rstrip("/")
    items_dir, ticks_dir, taken_dir = f"{state}/work_items", f"{state}/ticks", f"{state}/taken"

    def tick(_clock: DataFrame, batch_id: int) -> None:
        if not (move and _exists(spark, f"{taken_dir}/tick={batch_id}/_SUCCESS")):
            plan(batch_id)
        if move and _exists(spark, f"{items_dir}/tick={batch_id}"):
            mine = spark.read.schema("path string, target_path string, length long, tick long").parquet(items_dir).where(F.col("tick") == batch_id)
            move_files(spark, plan_moves(mine), f"{state}/moves", f"tick-{batch_id}")

    def plan(batch_id: int) -> None:
        as_of = tick_time(spark, ticks_dir, batch_id)
        if isinstance(landing_dir, dict):
            inv = feed_inventories(spark, landing_dir, scan.recursive)
        else:
            inv = landing_inventory(spark, landing_dir, scan.recursive, feed)
        taken = taken_before(spark, taken_dir, batch_id)
        pending = inv.join(taken, IDENTITY, "left_anti")
        if failures_dir and _exists(spark, failures_dir):
            failures = spark.read.schema(QUARANTINE_SCHEMA).parquet(failures_dir)
        else:
            failures = spark.createDataFrame([], QUARANTINE_SCHEMA)
        items = feeder_tick(pending, failures, scan, feeder, as_of, limits=limits)["items"]
        (items.select("feed", "path", "length", "mtime", "target_path", "format", "data_type",
                      "work_id", "message")
         .withColumn("tick", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("tick").parquet(items_dir))
        # taken set for the next tick: earlier takes still in the folder plus
        # this tick's; its size is bounded by the landing folder, not history
        still = taken.join(inv.select(*IDENTITY), IDENTITY, "left_semi")
        if _exists(spark, items_dir):
            now = (spark.read.schema(f"{_TAKEN}, tick long").parquet(items_dir)
                   .where(F.col("tick") == batch_id).select(*IDENTITY))
        else:
            now = spark.createDataFrame([], _TAKEN)
        (still.unionByName(now).distinct()
         .write.mode("overwrite").parquet(f"{taken_dir}/tick={batch_id}"))

    clock = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    writer = (clock.writeStream.foreachBatch(tick)
              .option("checkpointLocation", f"{state}/checkpoint")
              .trigger(processingTime=f"{int(trigger_ms)} milliseconds"))
    if query_name:
        writer = writer.queryName(query_name)
    return writer.start()
