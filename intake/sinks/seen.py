"""Which records were delivered before: a store of record ids, so that a record that comes in two
micro-batches counts once.

Ids are dealt over ``buckets`` by hash; a batch adds one run of ids to each bucket and a
Bloom filter of it.  A batch's ids are first asked of the filters of their bucket, and
only the runs that may hold some of them are read for the exact answer: a batch of new
records reads next to nothing of the store.  :func:`compact_seen` keeps the number
of runs in a bucket small.

A batch does not look at its own run and replaces it as a whole, so a replay under the same
tag gives what the first try gave; the same records under another tag give none.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from intake.session import checkpoint_dir
from intake.sinks.files import drop_folder, folder_exists, partition_folder

BUCKETS = 64
BITS, HASHES = 12, 8            # of the filter, an id: about one in 300 wrong answers
MERGED = "~merged"
CHUNK = 1 << 16                 # ids whose bits are computed together
_FILTERS = "bucket int, batch_id string, n long, bits binary"


def record_key(cols: Sequence[str]) -> Column:
    """The id columns as one text; a null in them is a value like any other."""
    return F.to_json(F.struct(*[F.col(c) for c in cols]), {"ignoreNullFields": "false"})


def _places(keys: np.ndarray, size: int) -> np.ndarray:
    """Bits of a filter of ``size`` bits, a row per key (two 64-bit hashes)."""
    one, two = keys[:, 0].view(np.uint64), keys[:, 1].view(np.uint64) | np.uint64(1)
    with np.errstate(over="ignore"):
        return (one[:, None] + np.arange(HASHES, dtype=np.uint64)[None, :] * two[:, None]) % np.uint64(size)


def bloom(keys: np.ndarray) -> bytes:
    bits = np.zeros(max(64, -(-len(keys) * BITS // 8) * 8), np.uint8)
    for at in range(0, len(keys), CHUNK):
        bits[_places(keys[at:at + CHUNK], len(bits)).ravel()] = 1
    return np.packbits(bits).tobytes()


def may_hold(blob: bytes, keys: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(blob, np.uint8))
    hit = np.zeros(len(keys), bool)
    for at in range(0, len(keys), CHUNK):
        hit[at:at + CHUNK] = bits[_places(keys[at:at + CHUNK], len(bits))].all(axis=1)
    return hit


def _keys(table: pa.Table) -> np.ndarray:
    return np.column_stack([table.column(c).to_numpy() for c in ("h1", "h2")])


def _hashed(df: DataFrame, buckets: int) -> DataFrame:
    return df.withColumn("h1", F.xxhash64("rid")).withColumn("h2", F.xxhash64("rid", F.lit(1))).withColumn(
        "bucket", F.pmod(F.xxhash64("rid", F.lit(2)), F.lit(buckets)).cast("int"))


def _filters(spark: SparkSession, seen_dir: str) -> DataFrame:
    where = f"{seen_dir.rstrip('/')}/filters"
    return spark.read.schema(_FILTERS).parquet(where) if folder_exists(spark, where) else spark.createDataFrame([], _FILTERS)


def _write_run(ids: DataFrame, seen_dir: str, tag: str) -> None:
    """A run per bucket of ``ids`` (bucket, rid, h1, h2) and its filters, replacing those of the tag."""
    spark, base = ids.sparkSession, seen_dir.rstrip("/")

    def build(key: tuple, run: pa.Table) -> pa.Table:
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int32()), "n": pa.array([run.num_rows], pa.int64()),
                         "bits": pa.array([bloom(_keys(run))], pa.binary())})

    over = {"mode": "overwrite"}
    for name in ("filters", "ids"):               # no filter without its run
        drop_folder(spark, partition_folder(spark, f"{base}/{name}", "batch_id", tag))
    where = partition_folder(spark, f"{base}/ids", "batch_id", tag)
    (ids.select("rid", "h1", "h2", "bucket").repartition("bucket").write.option("partitionOverwriteMode", "static")
     .partitionBy("bucket").parquet(where, **over))
    run = spark.read.schema("h1 long, h2 long, bucket int").parquet(where)
    (run.groupBy("bucket").applyInArrow(build, "bucket int, n long, bits binary")
     .write.option("partitionOverwriteMode", "static").parquet(partition_folder(spark, f"{base}/filters", "batch_id", tag), **over))


def seen_before(ids: DataFrame, seen_dir: str, tag: str) -> DataFrame:
    """Those of ``ids`` (rid, h1, h2, bucket) that runs of other batches hold: (rid)."""
    spark = ids.sparkSession

    # the ids themselves stay with Spark: a bucket's hashes are all that a task of Python holds
    def ask(key: tuple, mine: pa.Table, runs: pa.Table) -> pa.Table:
        keys, bucket, out = _keys(mine), key[0].as_py(), []
        for batch, blob in zip(runs.column("batch_id").to_pylist(), runs.column("bits")):
            hit = keys[may_hold(blob.as_py(), keys)]
            out.append(pa.table({"h1": pa.array(hit[:, 0], pa.int64()), "h2": pa.array(hit[:, 1], pa.int64()),
                                 "bucket": pa.repeat(pa.scalar(bucket, pa.int32()), len(hit)),
                                 "batch_id": pa.repeat(pa.scalar(batch, pa.string()), len(hit))}))
        return pa.concat_tables(out) if out else pa.table({c: pa.array([], t) for c, t in (
            ("h1", pa.int64()), ("h2", pa.int64()), ("bucket", pa.int32()), ("batch_id", pa.string()))})

    runs = _filters(spark, seen_dir).where(F.col("batch_id") != tag)
    checkpoint_dir(spark)
    maybe = (ids.select("bucket", "h1", "h2").groupBy("bucket").cogroup(runs.groupBy("bucket"))
             .applyInArrow(ask, "h1 long, h2 long, bucket int, batch_id string").checkpoint())
    # at most buckets x runs of them
    named = maybe.select("bucket", "batch_id").distinct().collect()
    if not named:
        return spark.createDataFrame([], "rid string")
    base = seen_dir.rstrip("/")
    folders = [f"{partition_folder(spark, f'{base}/ids', 'batch_id', r['batch_id'])}/bucket={r['bucket']}" for r in named]
    held = spark.read.schema("rid string").parquet(*folders)
    asked = ids.join(maybe.select("bucket", "h1", "h2"), ["bucket", "h1", "h2"], "left_semi").select("rid").distinct()
    return asked.join(held, "rid", "left_semi")


def new_records(records: DataFrame, id_cols: Sequence[str], seen_dir: str, tag: str, buckets: int = BUCKETS) -> DataFrame:
    """The rows of ``records`` whose id (``id_cols``) no other batch has brought, one per id, and their ids noted
    under ``tag``.  Of rows of one id the first by a hash of the whole row stays."""
    rid = record_key(id_cols)
    order = F.xxhash64(*[F.col(f"`{c}`") for c in records.columns])
    one = (records.withColumn("rid", rid).groupBy("rid").agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in records.columns]), order).alias("_row")))
    checkpoint_dir(records.sparkSession)
    ids = _hashed(one.select("rid"), buckets).checkpoint()
    old = seen_before(ids, seen_dir, tag)
    fresh = ids.join(old, "rid", "left_anti").checkpoint()
    _write_run(fresh, seen_dir, tag)
    return one.join(fresh.select("rid"), "rid", "left_semi").select("_row.*")


def compact_seen(spark: SparkSession, seen_dir: str, before: str, max_runs: int = 8) -> int:
    """Merge the runs older than the batch ``before`` (which may still be replayed) into one where there are more
    than ``max_runs`` of them; returns the number of runs merged.  The merged run is written first, so a
    run that breaks off leaves ids twice, never none."""
    runs = sorted(r["batch_id"] for r in _filters(spark, seen_dir).where(F.col("batch_id") < before).select("batch_id").distinct().collect())
    if len(runs) <= max_runs:
        return 0
    base = seen_dir.rstrip("/")
    folders = [partition_folder(spark, f"{base}/ids", "batch_id", r) for r in runs]
    ids = spark.read.schema("rid string, h1 long, h2 long, bucket int").option("basePath", f"{base}/ids").parquet(*folders)
    # a name of its own, between the last of them and the next batch
    tag = runs[-1] + MERGED
    _write_run(ids.select("rid", "h1", "h2", "bucket").dropDuplicates(["rid"]), seen_dir, tag)
    for r in runs:
        for name in ("filters", "ids"):
            drop_folder(spark, partition_folder(spark, f"{base}/{name}", "batch_id", r))
    return len(runs)
