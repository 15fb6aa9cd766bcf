"""The bundler's fixed-rate loop as a Structured Streaming query.

A ``rate`` source is the clock, as for the feeder: each trigger is one
:func:`intake.plans.lifecycle.bundler_run` at a recorded time.  What is bundled is in
the ledger below ``state_dir``, the quarantine goes from tick to tick as a snapshot of
the paths still in it, and a tick's accounting rows are written last.

Replay safety: a tick whose accounting is written is not run again.  One that broke off
before runs anew under its number and time, without regard to what it had put into the
ledger, and replaces its own bundles, ledger rows and snapshot.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from intake.config import BundlerConfig, ScanConfig
from intake.operators.filters import current_quarantine
from intake.plans.lifecycle import bundler_run
from intake.schemas import QUARANTINE_SCHEMA
from intake.sinks.files import folder_exists
from intake.sources.members import Members
from intake.streaming.feeder import tick_time

ACCOUNTING = "work_id string, origin string, loaded_path string, status string, manifest_file string"


def bundler_tick(spark: SparkSession, tick: int, state_dir: str, scan: ScanConfig, bundler: BundlerConfig,
                 inventory: Callable[[], DataFrame], members: Callable[[], Members],
                 flagged: Callable[[], DataFrame] | None = None) -> None:
    """One tick of the loop; does nothing if it was done before."""
    state = state_dir.rstrip("/")
    done = f"{state}/accounting/tick={tick}"
    if folder_exists(spark, f"{done}/_SUCCESS"):
        return
    as_of = tick_time(spark, f"{state}/ticks", tick)
    before = f"{state}/quarantine/tick={tick - 1}"
    failures = spark.read.schema(QUARANTINE_SCHEMA).parquet(before) if folder_exists(spark, before) else \
        spark.createDataFrame([], QUARANTINE_SCHEMA)
    out = bundler_run(spark, inventory(), failures, scan, bundler, as_of, members(), flagged() if flagged else None, state,
                      tick=f"{tick:012d}")
    current_quarantine(out["failures"], as_of, scan.retry_ms).select(*QUARANTINE_SCHEMA.names).write.mode("overwrite").parquet(
        f"{state}/quarantine/tick={tick}")
    out["accounting"].select("work_id", "origin", "loaded_path", "status", "manifest_file").write.mode("overwrite").parquet(done)


def bundler_stream(spark: SparkSession, state_dir: str, scan: ScanConfig, bundler: BundlerConfig,
                   inventory: Callable[[], DataFrame], members: Callable[[], Members],
                   flagged: Callable[[], DataFrame] | None = None, trigger_ms: int = 60_000,
                   query_name: str | None = None) -> StreamingQuery:
    """Start the loop; see the module docstring.  ``inventory`` lists data files and manifests (or
    :func:`intake.sinks.bulk.bulk_units`), ``members`` says how they are read and ``flagged`` lists the flagged
    originals; each is called once a tick."""
    clock = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    writer = (clock.writeStream
              .foreachBatch(lambda _, tick: bundler_tick(spark, tick, state_dir, scan, bundler, inventory, members, flagged))
              .option("checkpointLocation", f"{state_dir.rstrip('/')}/checkpoint")
              .trigger(processingTime=f"{int(trigger_ms)} milliseconds"))
    if query_name:
        writer = writer.queryName(query_name)
    return writer.start()
