"""Polled folder -> micro-batches -> handler.

The reference polls a folder at a fixed rate; Spark's file stream source does
the listing, remembers what it has seen in the checkpoint, and hands each new
batch to ``foreachBatch``.  Note the differences (documented, not patched):
``maxFilesPerTrigger`` and ``maxBytesPerTrigger`` cannot be combined, and the
byte limit stops *before* the file that would pass it, where the reference
includes it.  Use :func:`intake.operators.batching.batch_plan` inside the
handler when the reference's exact cut matters.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from intake.functions.paths import source_file_path
from intake.operators.combine import combine_entries
from intake.sinks.live import batch_tag, run_id_for, upsert_live
from intake.sinks.seen import compact_seen, new_records


def stream_feed(spark: SparkSession, input_dir: str, fmt: str, schema: T.StructType | str,
                handler: Callable[[DataFrame, int], None], checkpoint: str,
                trigger_ms: int = 5000, available_now: bool = False,
                max_files: int | None = None, max_bytes: int | None = None,
                options: Mapping[str, str] | None = None,
                query_name: str | None = None) -> StreamingQuery:
    """Start a file stream over ``input_dir`` and call ``handler(batch_df,
    batch_id)`` per micro-batch.  Each record carries its ``source_path``."""
    if max_files is not None and max_bytes is not None:
        raise ValueError("Spark's file source takes either max_files or max_bytes, not both")
    reader = spark.readStream.format(fmt).schema(schema).options(**dict(options or {}))
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes))
    df = reader.load(input_dir).withColumn("source_path", source_file_path())
    writer = df.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{int(trigger_ms)} milliseconds")
    return writer.start()


def ingest_stream(spark: SparkSession, input_dir: str, fmt: str, schema, checkpoint: str,
                  table_dir: str, shred: Callable[[DataFrame], DataFrame],
                  sum_tables=(), record: Sequence[str] | None = None, seen_dir: str | None = None,
                  ids: Sequence[str] = (), **kw) -> StreamingQuery:
    """Live ingest as a stream: shred -> dedupe -> aggregate -> upsert of the
    micro-batch under ``run_id-batch_id`` (a replayed batch overwrites itself).

    Counters (``sum_tables``) tell events apart by the columns ``record`` that ``shred``
    carries beside the entries: two events of one type, time and value count twice,
    one event that is there twice once.  Counters need them, if only to say ``()``
    where equal entries are one.

    With ``seen_dir`` records (not entries) whose ``ids`` columns an earlier micro-batch, or an
    earlier run of the stream under another checkpoint, has brought are left out:
    a file that is delivered again counts once (:mod:`intake.sinks.seen`)."""
    if seen_dir is not None and not ids:
        raise ValueError("a store of seen records needs `ids`: the columns that name a record")
    if sum_tables and record is None:
        raise ValueError("counters need `record`: the columns of shred's result that tell events apart")
    run_id = run_id_for(spark, checkpoint)

    def handle(batch: DataFrame, batch_id: int) -> None:
        if seen_dir is not None:
            tag = batch_tag(run_id, batch_id)
            batch = new_records(batch, ids, seen_dir, tag)
            compact_seen(spark, seen_dir, tag)
        entries = combine_entries(shred(batch), sum_tables, record=record or ())
        upsert_live(entries, table_dir, run_id, batch_id)

    return stream_feed(spark, input_dir, fmt, schema, handle, checkpoint, **kw)
