"""Per work item metrics: which attempt, which file, how many records and bytes, how long.

The reference logs attempt, file and milliseconds per file; here they are a
table, timed in the tasks that read the files (``intake.sources.groups``).  Batch
timings come from ``StreamingQueryProgress``, kept by :class:`ProgressLog`, or
``DataFrame.observe``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.observation import Observation
from pyspark.sql.streaming import StreamingQueryListener

from intake.functions.paths import path_key
from intake.sources import storage


def ingest_metrics(records: DataFrame, work_col: str = "work_id",
                   bytes_col: str | None = None) -> DataFrame:
    """``n_records`` and, if given, ``n_bytes`` per work item."""
    aggs = [F.count(F.lit(1)).alias("n_records")]
    if bytes_col:
        aggs.append(F.sum(bytes_col).cast("long").alias("n_bytes"))
    return records.groupBy(work_col).agg(*aggs)


def item_metrics(items: DataFrame, stats: DataFrame | None) -> DataFrame:
    """One row per work item (``work_id, attempt, path, status, n_records, n_bytes, duration_ms``).

    ``items`` as parsed (``work_id, path, status``, where they were read ``read_path`` and, if there is one, their
    ``attempt``; else 1), ``stats`` of the files read (``source_path, n_records, n_bytes, duration_ms``).  Items that were not read, or
    by a reader that keeps no time, have nulls."""
    attempt = F.coalesce(F.col("attempt").cast("int"), F.lit(1)) if "attempt" in items.columns else F.lit(1)
    rows = items.select("work_id", attempt.alias("attempt"), "path", "status", path_key("read_path").alias("_key"))
    measures = {"n_records": "long", "n_bytes": "long", "duration_ms": "double"}
    if stats is None:
        return rows.drop("_key").select("*", *[F.lit(None).cast(t).alias(c) for c, t in measures.items()])
    read = stats.select(path_key("source_path").alias("_file"), *measures)
    return rows.join(read, F.col("_key") == F.col("_file"), "left").drop("_key", "_file")


class ProgressLog(StreamingQueryListener):
    """Keeps every progress report of the session's streams, a JSON file each below ``folder``
    (``spark.streams.addListener(ProgressLog(folder))``); read them with :func:`progress_log`."""

    def __init__(self, folder: str):
        self.folder = folder.rstrip("/")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        with storage.open_output(f"{self.folder}/query={p.id}/run={p.runId}/batch-{p.batchId}-{p.timestamp.replace(':', '')}.json") as out:
            out.write(" ".join(p.json.split("\n")).encode())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def progress_log(spark: SparkSession, folder: str) -> DataFrame:
    """(query_id, run_id, name, batch_id, started, n_input_rows, trigger_ms, add_batch_ms) of the reports kept."""
    schema = ("id string, runId string, name string, batchId long, timestamp string, numInputRows long, "
              "durationMs struct<triggerExecution: long, addBatch: long>")
    rows = spark.read.schema(schema).option("recursiveFileLookup", "true").json(folder)
    return rows.select(
        F.col("id").alias("query_id"), F.col("runId").alias("run_id"), "name", F.col("batchId").alias("batch_id"),
        F.to_timestamp("timestamp").alias("started"), F.col("numInputRows").alias("n_input_rows"),
        F.col("durationMs.triggerExecution").alias("trigger_ms"), F.col("durationMs.addBatch").alias("add_batch_ms"))


def observed(df: DataFrame, name: str = "intake") -> tuple[DataFrame, Observation]:
    """Attach row counters that are filled in by whatever action runs ``df``
    (no extra pass over the data)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def stream_progress(spark, query) -> DataFrame:
    """Per micro-batch metrics of a streaming query from its recent progress
    reports (at most ``spark.sql.streaming.numRecentProgressUpdates`` of
    them, already held by the driver): batch id, start time, input rows and
    the trigger's duration."""
    rows = []
    for p in query.recentProgress:
        d = p.durationMs or {}
        rows.append((int(p.batchId), str(p.timestamp), int(p.numInputRows or 0),
                     int(d.get("triggerExecution", 0)), int(d.get("addBatch", 0))))
    return (spark.createDataFrame(rows, "batch_id long, started string, n_input_rows long, "
                                        "trigger_ms long, add_batch_ms long")
            .withColumn("started", F.to_timestamp("started")))
