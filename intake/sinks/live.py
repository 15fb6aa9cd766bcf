"""Live mode: entries go straight into tables, no files and no manifest.

There is no table format jar here, so a "table" is a parquet folder
partitioned by ``table_name`` and ``batch_id``.  Each micro-batch overwrites
only its own ``batch_id`` partitions, so replaying a batch after a failure
changes nothing (exactly-once effect).  Readers see the newest value per key
(:func:`newest_per_key`), or the sum over batches for counter tables;
newest-wins is our decision.  A ``run_id`` kept
beside the stream's checkpoint prefixes every batch id, because a new
checkpoint restarts batch numbers at 0.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from intake.operators.combine import key_hash, plain_number
from intake.schemas import ENTRY_COLUMNS, ENTRY_KEY, ENTRY_SCHEMA


def batch_tag(run_id: str, batch_id: int) -> str:
    return f"{run_id}-{int(batch_id):012d}"


def upsert_live(entries: DataFrame, table_dir: str, run_id: str, batch_id: int | None = None,
                batch_col: str | None = None) -> None:
    """Write one micro-batch (``batch_id``) or many (``batch_col`` holds a
    batch number per row) into the live tables, replacing those batches."""
    if batch_col is not None:
        tag = F.concat(F.lit(run_id + "-"), F.lpad(F.col(batch_col).cast("string"), 12, "0"))
    else:
        tag = F.lit(batch_tag(run_id, batch_id))
    keep = [*ENTRY_COLUMNS, batch_col] if batch_col is not None else ENTRY_COLUMNS
    (entries.select(*keep).withColumn("batch_id", tag).select(*ENTRY_COLUMNS, "batch_id")
     .hint("rebalance", "table_name", "batch_id")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("table_name", "batch_id").parquet(table_dir))


SNAPSHOT = "~snapshot"


def newest_per_key(history: DataFrame, sum_tables: Sequence[str] = (), sum_type: str = "decimal(28,9)") -> DataFrame:
    """Newest value per entry key: latest ``ts``, then latest batch, then
    greatest value (so equal stamps never make the answer depend on order).
    Tables in ``sum_tables`` are counters whose batches hold partial counts:
    their value is the sum over batches."""
    is_sum = F.col("table_name").isin(list(sum_tables)) if sum_tables else F.lit(False)
    agg = history.groupBy(key_hash(), *ENTRY_KEY).agg(
        F.max_by("value", F.struct("ts", "batch_id", "value")).alias("_newest"),
        F.sum(F.when(is_sum, F.col("value").try_cast(sum_type))).alias("_sum"),
        F.max("ts").alias("ts"), F.count(F.lit(1)).alias("n_versions"))
    value = F.when(is_sum, plain_number(F.col("_sum"))).otherwise(F.col("_newest"))
    return agg.select(*ENTRY_KEY, value.alias("value"), "ts", "n_versions")


def live_history(spark: SparkSession, table_dir: str) -> DataFrame:
    """Entries that count: each table's latest snapshot and the batches after it.

    A snapshot stands for every batch up to the one it is named after, so
    folded batches that are still there (before they are deleted, or after a
    crash) are not read twice."""
    schema = T.StructType([*ENTRY_SCHEMA.fields, T.StructField("batch_id", T.StringType())])
    history = spark.read.schema(schema).parquet(table_dir)
    base = F.regexp_replace("batch_id", SNAPSHOT + "$", "")
    is_snapshot = F.col("batch_id").endswith(SNAPSHOT)
    # one row per live table
    latest = F.broadcast(history.where(is_snapshot).groupBy("table_name").agg(F.max(base).alias("_upto")))
    return (history.join(latest, "table_name", "left")
            .where(F.col("_upto").isNull() | F.when(is_snapshot, base == F.col("_upto")).otherwise(F.col("batch_id") > F.col("_upto")))
            .drop("_upto"))


def live_current(spark: SparkSession, table_dir: str, sum_tables: Sequence[str] = ()) -> DataFrame:
    """Current view of the live tables; ``sum_tables`` as given to the writer."""
    return newest_per_key(live_history(spark, table_dir), sum_tables)


def run_id_for(spark: SparkSession, checkpoint: str) -> str:
    """The run id stored beside a stream checkpoint, made on first use (if
    two starts race, the one that loses the create reads the winner's id)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(checkpoint.rstrip("/") + "-run-id")
    fs = p.getFileSystem(conf)

    def read() -> str:
        stream = fs.open(p)
        try:
            reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
            return reader.readLine().strip()
        finally:
            stream.close()

    if fs.exists(p):
        return read()
    rid = uuid.uuid4().hex[:12]
    try:
        out = fs.create(p, False)
    except Exception:  # noqa: BLE001 - created meanwhile by another start
        return read()
    try:
        out.write(bytearray(rid.encode("utf-8")))
    finally:
        out.close()
    return rid


def compact_live(spark: SparkSession, table_dir: str, upto: str | None = None, sum_tables: Sequence[str] = ()) -> str:
    """Fold every batch up to ``upto`` (default: all) into one snapshot batch
    per table holding the newest value per key (counters: the sum), then drop
    the folded batch folders.

    The snapshot is written first (dynamic partition overwrite: a replay
    writes the same snapshot); from then on :func:`live_history` reads it in
    place of the folded batches, whether or not their folders are gone yet.
    Returns the snapshot's batch id.
    """
    schema = T.StructType([*ENTRY_SCHEMA.fields, T.StructField("batch_id", T.StringType())])
    history = spark.read.schema(schema).parquet(table_dir)
    base = F.regexp_replace("batch_id", SNAPSHOT + "$", "")
    if upto is None:
        upto = history.agg(F.max(base)).first()[0]
        if upto is None:
            return ""
    tag = f"{upto}{SNAPSHOT}"
    # after a crash some tables may have their snapshot already: folding that alone gives it again
    folded = live_history(spark, table_dir).where(base <= upto)
    snapshot = (newest_per_key(folded, sum_tables).select(*ENTRY_COLUMNS)
                .withColumn("batch_id", F.lit(tag)))
    (snapshot.hint("rebalance", "table_name")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("table_name", "batch_id").parquet(table_dir))
    return _drop_folded(spark, table_dir, spark.read.schema(schema).parquet(table_dir).where(base <= upto), tag)


def _drop_folded(spark: SparkSession, table_dir: str, folded: DataFrame, tag: str) -> str:
    """Delete the folders of the folded batches: one per (table, batch)."""
    old = folded.where(F.col("batch_id") != tag).select("table_name", "batch_id").distinct().collect()
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for r in old:
        p = jvm.org.apache.hadoop.fs.Path(f"{table_dir.rstrip('/')}/table_name={r['table_name']}/batch_id={r['batch_id']}")
        p.getFileSystem(conf).delete(p, True)
    return tag
