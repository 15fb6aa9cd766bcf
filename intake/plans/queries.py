"""Registered queries: one per operator, each with its DuckDB oracle.

Every query reads the given tables (or data Spark derives from them) in
full.  Queries of sinks write to a fresh folder below the session's shared
checkpoint folder and read the result back.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intake.functions.ids import as_of_col
from intake.functions.paths import file_name, flagged_path, loaded_path
from intake.config import BundlerConfig, FeederConfig, ScanConfig
from intake.operators import batching, bundle, combine, filters, metrics, shred, work
from intake.plans import lifecycle
from intake.plans import standins as S
from intake.schemas import ENTRY_COLUMNS, ENTRY_DDL, QUARANTINE_SCHEMA
from intake.session import scratch_dir
from intake.sinks import bulk, bundles, keyed, levelled, live, mover, seen
from intake.sinks.files import folder_exists, folder_names
from intake.sinks.framed import write_framed
from intake.sinks.listing import take_snapshot
from intake.sources import storage
from intake.sources.entries import read_entries
from intake.sources.formats import Framed
from intake.sources.groups import read_groups
from intake.sources.inventory import landing_inventory
from intake.sources.members import Members
from intake.sources.typed import TypeSpec, read_typed_feed
from intake.streaming import state as timed
from intake.streaming.bundler import ACCOUNTING, bundler_stream
from intake.streaming.feed import ingest_stream, stream_feed
from intake.streaming.feeder import feeder_stream

LANDING_COLS = ["feed", "doc_id", "path", "name", "length", "mtime"]
_LANDING_SQL_COLS = "feed, doc_id, path, name, length, mtime"


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        REGISTRY[name] = Query(fn, sql)
        return fn
    return deco


def _cte(*parts: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(parts)


# ---------------------------------------------------------------- flagship

FLAGSHIP_SQL = _cte(S.EVENT_ENTRIES_SQL, """counters AS (
  SELECT 'event_count' AS table_name, event_type AS row_key, 'day' AS family,
         strftime(ts, '%Y-%m-%d') AS qualifier, ts, '1' AS value FROM events WHERE event_type IS NOT NULL),
allentries AS (SELECT DISTINCT * FROM (SELECT * FROM entries UNION ALL SELECT * FROM counters))""") + r"""
SELECT table_name, row_key, family, qualifier, max(ts) AS ts,
       CASE WHEN table_name = 'event_count'
            THEN regexp_replace(CAST(sum(TRY_CAST(value AS DECIMAL(28,9))) AS VARCHAR), '\.?0*$', '')
            ELSE first(value ORDER BY ts DESC, value DESC) END AS value,
       count(*) AS n_combined,
       count(*) FILTER (WHERE table_name = 'event_count' AND TRY_CAST(value AS DECIMAL(28,9)) IS NULL) AS n_rejected
FROM allentries GROUP BY table_name, row_key, family, qualifier"""


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """shred -> dedupe -> aggregate over all events (the ingest writer chain)."""
    rec = S.event_records(spark, d)
    entries = S.event_entries(rec, extra=[S.event_counter()])
    return combine.aggregate_entries(combine.dedupe_entries(entries), sum_tables=["event_count"])


register("shred_dedupe_aggregate", FLAGSHIP_SQL)(flagship)


# ---------------------------------------------------------------- sources

@register("landing_inventory", """
SELECT 'feed=' || source AS folder, CAST(sum(strlen(text) + 1) AS BIGINT) AS n_bytes FROM documents GROUP BY source""")
def q_landing_inventory(spark, d):
    """The documents written as text files, a folder per source, and listed:
    the listed lengths add up to the bytes of the texts."""
    out = scratch_dir(spark, "landing")
    (S.table(spark, d, "documents").select(F.concat(F.lit("feed="), "source").alias("f"), F.col("text").alias("value"))
     .hint("rebalance", "f").write.partitionBy("f").option("compression", "none").text(out))
    inv = landing_inventory(spark, out, recursive=True, feed="documents")
    return (inv.withColumn("folder", F.url_decode(F.regexp_extract("path", "/f=([^/]*)/[^/]*$", 1)))
            .where(F.col("folder") != "").groupBy("folder").agg(F.sum("length").alias("n_bytes")))


_WALK_SQL = """names AS (
  SELECT doc_id, coalesce(text, '') AS text,
         lang || '/' || source || '/' || CASE WHEN doc_id % 7 = 0 THEN '.part-' WHEN doc_id % 11 = 0 THEN '_tmp/' ELSE '' END || doc_id || '.txt' AS path
  FROM documents),
before AS (SELECT path, CASE WHEN doc_id % 5 = 0 THEN 0 ELSE strlen(text) END AS length FROM names),
after AS (SELECT path, CASE WHEN doc_id % 3 = 0 THEN strlen(text) + 1 WHEN doc_id % 5 = 0 THEN 0 ELSE strlen(text) END AS length
          FROM names WHERE doc_id % 13 <> 0
          UNION ALL SELECT 'new/' || path, 3 FROM names WHERE doc_id % 17 = 0)"""


def _write_files(files: DataFrame, root: str) -> None:
    """Files (``path`` below ``root``, ``body``; a null body deletes) written by tasks."""
    def write(rows):
        for r in rows:
            if r["body"] is None:
                storage.remove(f"{root}/{r['path']}")
            else:
                with storage.open_output(f"{root}/{r['path']}") as out:
                    out.write(bytes(r["body"]))
    files.select("path", F.col("body").cast("binary").alias("body")).foreachPartition(write)


@register("listing_changes", f"""WITH {_WALK_SQL}
SELECT coalesce(a.path, b.path) AS path, CASE WHEN b.path IS NULL THEN 'new' WHEN a.path IS NULL THEN 'gone'
       WHEN a.length = b.length THEN 'same' ELSE 'changed' END AS status, a.length, b.length AS old_length
FROM after a FULL JOIN before b ON a.path = b.path""")
def q_listing_changes(spark, d):
    """The documents written as files with nested, hidden and empty ones among them and listed; then some
    replaced, some deleted and some added, and listed again: what changed."""
    root = scratch_dir(spark, "walk")
    doc, rest = F.col("doc_id"), lambda n: F.col("doc_id") % n == 0
    name = F.concat("lang", F.lit("/"), "source", F.lit("/"), F.when(rest(7), ".part-").when(rest(11), "_tmp/").otherwise(""),
                    doc.cast("string"), F.lit(".txt"))
    docs = S.table(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), name.alias("path"))
    first = docs.select("path", F.when(rest(5), "").otherwise(F.col("text")).alias("body"))
    _write_files(first, f"{root}/tree")
    take_snapshot(spark, f"{root}/tree", f"{root}/state")
    body = F.when(rest(13), None).otherwise(F.concat("text", F.lit("+")))
    second = docs.where(rest(13) | rest(3)).select("path", body.alias("body")).unionByName(
        docs.where(rest(17)).select(F.concat(F.lit("new/"), "path").alias("path"), F.lit("new").alias("body")))
    _write_files(second, f"{root}/tree")
    _, diff = take_snapshot(spark, f"{root}/tree", f"{root}/state")
    return diff.select(F.regexp_extract("path", "/tree/(.*)$", 1).alias("path"), "status", "length", "old_length")


READ_TYPED_SQL = """
SELECT 'events' AS data_type, 'events.parquet' AS source_file, event_id, ts, event_type,
       CAST(NULL AS BIGINT) AS o_orderkey, CAST(NULL AS TIMESTAMP) AS o_orderdate,
       CAST(NULL AS VARCHAR) AS o_orderstatus FROM events
UNION ALL
SELECT 'orders', 'orders.parquet', NULL, NULL, NULL, o_orderkey, o_orderdate, o_orderstatus FROM orders"""

TYPED_REGISTRY = {
    "events": TypeSpec("parquet", "event_id BIGINT, ts TIMESTAMP_NTZ, event_type STRING"),
    "orders": TypeSpec("parquet", "o_orderkey BIGINT, o_orderdate TIMESTAMP_NTZ, o_orderstatus STRING"),
}


@register("read_typed_feed", READ_TYPED_SQL)
def q_read_typed_feed(spark, d):
    inv = landing_inventory(spark, d, feed="testdata")
    items = (inv.where(F.col("name").isin("events.parquet", "orders.parquet"))
             .select("path", F.regexp_extract("name", r"^(.*)\.parquet$", 1).alias("data_type")))
    recs = read_typed_feed(spark, items, TYPED_REGISTRY)
    return recs.select("data_type", file_name("source_path").alias("source_file"),
                       "event_id", "ts", "event_type", "o_orderkey", "o_orderdate", "o_orderstatus")


CUT_BUCKET = 5      # the file of the custom format that is cut off
_EVENT_COLUMNS = "event_id, ts, user_id, event_type, value, props"


def _cut_off(path: str, lost: int) -> None:
    """Take the last ``lost`` bytes off a file."""
    with storage.open_input(path) as f:
        f.seek(0, 2)
        left = f.tell() - lost
        f.seek(0)
        with storage.open_output(path + ".cut") as out:
            while left > 0 and (block := f.read(min(left, 1 << 20))):
                out.write(block)
                left -= len(block)
    storage.move(path + ".cut", path)


@register("read_custom_format", f"""
WITH e AS (SELECT *, coalesce(event_id, 0) % 16 AS b FROM events),
o AS (SELECT *, row_number() OVER (PARTITION BY b ORDER BY event_id DESC NULLS LAST, ts DESC, user_id DESC, event_type DESC, value DESC, props DESC) AS last FROM e)
SELECT 'bucket-' || b || '.frm' AS file, {_EVENT_COLUMNS}, NULL::VARCHAR AS problem FROM o WHERE b <> {CUT_BUCKET} OR last > 1
UNION ALL SELECT DISTINCT 'bucket-{CUT_BUCKET}.frm', NULL, NULL, NULL, NULL, NULL, NULL, 'ValueError: cut off' FROM e WHERE b = {CUT_BUCKET}""")
def q_read_custom_format(spark, d):
    """The events written in the framed format, a file per bucket, one file cut
    off within its last record, and read back: every record before the cut and one
    row that rejects the file."""
    folder = scratch_dir(spark, "framed")
    events = S.table(spark, d, "events").select(
        "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value", "props",
        F.concat(F.lit("bucket-"), F.pmod(F.coalesce("event_id", F.lit(0)), F.lit(16))).alias("bucket"))
    write_framed(events.repartition("bucket").sortWithinPartitions("bucket", "event_id", "ts", "user_id", "event_type", "value", "props"),
                 folder, file_by="bucket")
    cut = f"{folder}/bucket-{CUT_BUCKET}.frm"
    if folder_exists(spark, cut):
        _cut_off(cut, Framed.HEAD.size + 1)
    files = landing_inventory(spark, folder).select("path", "length")
    rows = read_groups(spark, files, "framed", "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    return rows.select(file_name("source_path").alias("file"), *_EVENT_COLUMNS.split(", "),
                       F.regexp_replace("reject", " at byte.*", "").alias("problem"))


def _event_entries_sql(with_work: bool) -> str:
    extra = (", md5('/landing/flagged/events/user-' || CAST(user_id AS VARCHAR) || '.json') AS work_id"
             if with_work else "")
    return f"""entries AS (
  SELECT 'event' AS table_name, CAST(event_id AS VARCHAR) AS row_key, 'events' AS family,
         'event_type' AS qualifier, ts, event_type AS value{extra} FROM events WHERE event_type IS NOT NULL
  UNION ALL
  SELECT 'index', event_type, 'event_type', CAST(event_id AS VARCHAR), ts, 'events'{extra}
  FROM events WHERE event_type IS NOT NULL
  UNION ALL
  SELECT 'event', CAST(event_id AS VARCHAR), 'events', 'value', ts,
         CAST(CAST(value AS DECIMAL(18,4)) AS VARCHAR){extra} FROM events WHERE value IS NOT NULL
  UNION ALL
  SELECT 'event', CAST(event_id AS VARCHAR), 'events', 'props', ts, props{extra} FROM events WHERE props IS NOT NULL)"""


def _bulk_written(spark, d):
    rec = S.event_records(spark, d)
    entries = S.event_entries(rec, carry=["work_id"])
    items = rec.select("work_id", "source_path").distinct()
    return bulk.write_bulk(entries, items, scratch_dir(spark, "bulk"))


@register("read_entries", _cte(_event_entries_sql(True)) + "\nSELECT * FROM entries")
def q_read_entries(spark, d):
    paths = _bulk_written(spark, d)
    return read_entries(spark, paths["data"]).drop("batch_id", "bucket")


STREAM_SQL = _cte(S.EVENT_ENTRIES_SQL) + """
SELECT table_name, row_key, family, qualifier, value, ts, CAST(1 AS BIGINT) AS n_versions FROM entries"""


@register("stream_feed", STREAM_SQL)
def q_stream_feed(spark, d):
    schema = S.table(spark, d, "events").schema
    out = scratch_dir(spark, "stream")
    table_dir, ckpt = f"{out}/tables", f"{out}/checkpoint"
    run_id = live.run_id_for(spark, ckpt)

    def handle(batch: DataFrame, batch_id: int) -> None:
        entries = combine.aggregate_entries(combine.dedupe_entries(S.event_entries(batch)))
        live.upsert_live(entries, table_dir, run_id, batch_id)

    q = stream_feed(spark, d, "parquet", schema, handle, ckpt, available_now=True,
                    options={"pathGlobFilter": "events.parquet"})
    q.awaitTermination()
    return live.live_current(spark, table_dir)


# ---------------------------------------------------------------- filters

@register("ignore_prefix", _cte(S.LANDING_SQL) + f"""
SELECT {_LANDING_SQL_COLS} FROM landing WHERE NOT starts_with(name, '1')""")
def q_ignore_prefix(spark, d):
    return filters.ignore_prefix(S.landing_files(spark, d), "1").select(*LANDING_COLS)


@register("exclude_manifests", _cte(S.LANDING_SQL, S.MANIFEST_SQL) + f"""
SELECT {_LANDING_SQL_COLS} FROM (
  SELECT {_LANDING_SQL_COLS} FROM landing UNION ALL SELECT {_LANDING_SQL_COLS} FROM manifests)
WHERE NOT ends_with(path, '.manifest')""")
def q_exclude_manifests(spark, d):
    both = (S.landing_files(spark, d).select(*LANDING_COLS)
            .unionByName(S.manifest_files(spark, d).select(*LANDING_COLS)))
    return filters.exclude_manifests(both)


_TTL_US = S.FAILURE_TTL_MS * 1000
_FAIL_AS_OF_SQL = f"TIMESTAMP '{S.FAILURE_AS_OF:%Y-%m-%d %H:%M:%S}'"


@register("quarantine_filter", _cte(S.LANDING_SQL, S.FAILURES_SQL) + f"""
SELECT {_LANDING_SQL_COLS} FROM landing l
WHERE NOT EXISTS (SELECT 1 FROM failures f WHERE f.path = l.path
                  AND epoch_us({_FAIL_AS_OF_SQL}) - epoch_us(f.failed_at) < {_TTL_US})""")
def q_quarantine_filter(spark, d):
    return filters.quarantine_filter(S.landing_files(spark, d), S.failures(spark, d),
                                     S.FAILURE_AS_OF, S.FAILURE_TTL_MS).select(*LANDING_COLS)


@register("quarantine_update", _cte(S.LANDING_SQL, S.FAILURES_SQL) + """
SELECT path, max(failed_at) AS failed_at, first(reason ORDER BY failed_at DESC, reason DESC) AS reason,
       count(*) AS n_failures
FROM failures GROUP BY path""")
def q_quarantine_update(spark, d):
    log = spark.createDataFrame([], "path string, failed_at timestamp_ntz, reason string")
    log = filters.quarantine_update(log, S.failures(spark, d))
    return filters.quarantine_state(log)


@register("flagged_path", _cte(S.LANDING_SQL) + """
SELECT path, '/data/flagged/' || name AS flat_target,
       CASE WHEN instr(path, '/landing/flagged') > 0
            THEN '/data/flagged/' || substr(path, instr(path, '/landing/flagged') + 17)
            ELSE '/data/flagged/' || name END AS preserved_target
FROM landing""")
def q_flagged_path(spark, d):
    files = S.landing_files(spark, d)
    return files.select(
        "path",
        flagged_path("path", "/data/flagged/").alias("flat_target"),
        flagged_path("path", "/data/flagged/", "/landing/flagged/", True).alias("preserved_target"))


@register("loaded_path", _cte(S.LANDING_SQL) + """
SELECT path, replace(path, '/flagged/', '/loaded/') AS loaded_all,
       regexp_replace(path, '/flagged/', '/loaded/') AS loaded_first
FROM landing""")
def q_loaded_path(spark, d):
    files = S.landing_files(spark, d)
    return files.select("path", loaded_path("path", "all").alias("loaded_all"),
                        loaded_path("path", "first").alias("loaded_first"))


# ---------------------------------------------------------------- batching

_CFG = S.BATCH_CFG
_FILE_AS_OF_SQL = f"TIMESTAMP '{S.FILE_AS_OF:%Y-%m-%d %H:%M:%S}'"
_AGE_SQL = f"(epoch_us({_FILE_AS_OF_SQL}) - epoch_us(mtime) > {_CFG.max_age * 1000})"

THRESHOLD_SQL_BODY = f"""ordered AS (
  SELECT feed, path, length, mtime, admitted,
         row_number() OVER w AS seq,
         CAST(coalesce(sum(CAST(admitted AS BIGINT)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS prior_taken,
         CAST(coalesce(sum(length) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS prior_bytes
  FROM paired WINDOW w AS (PARTITION BY feed ORDER BY mtime, path)),
scan AS (
  SELECT *, (seq = 1 OR (prior_taken < {_CFG.max_files} AND prior_bytes < {_CFG.max_size})) AS scanned
  FROM ordered)"""

THRESHOLD_BATCH_SQL = _cte(S.LANDING_SQL, S.MANIFEST_SQL, S.PAIRED_SQL, THRESHOLD_SQL_BODY) + f"""
SELECT feed, path, length, mtime, admitted, seq, prior_taken, prior_bytes, scanned,
       (scanned AND admitted) AS taken, (scanned AND {_AGE_SQL}) AS over_age
FROM scan"""


def _threshold(spark, d):
    return batching.threshold_batch(S.paired_landing(spark, d), _CFG, S.FILE_AS_OF)


register("threshold_batch", THRESHOLD_BATCH_SQL)(_threshold)


@register("threshold_trigger", _cte(S.LANDING_SQL, S.MANIFEST_SQL, S.PAIRED_SQL, THRESHOLD_SQL_BODY) + f"""
SELECT feed, count(*) AS n_scanned, CAST(sum(CAST(admitted AS BIGINT)) AS BIGINT) AS n_taken,
       CAST(sum(length) AS BIGINT) AS bytes, bool_or({_AGE_SQL}) AS aged,
       (sum(CAST(admitted AS BIGINT)) >= {_CFG.max_files} OR bool_or({_AGE_SQL})
        OR sum(length) >= {_CFG.max_size}) AS fired
FROM scan WHERE scanned GROUP BY feed""")
def q_threshold_trigger(spark, d):
    return batching.threshold_trigger(_threshold(spark, d), _CFG)


PLAN_SQL_BODY = f"""files AS (
  SELECT feed, path, length, mtime, row_number() OVER (PARTITION BY feed ORDER BY mtime, path) AS seq
  FROM paired WHERE admitted),
walk(feed, seq, batch_no, n, bytes) AS (
  SELECT feed, seq, CAST(0 AS BIGINT), CAST(1 AS BIGINT), length FROM files WHERE seq = 1
  UNION ALL
  SELECT f.feed, f.seq,
         CASE WHEN w.n >= {_CFG.max_files} OR w.bytes >= {_CFG.max_size} THEN w.batch_no + 1 ELSE w.batch_no END,
         CASE WHEN w.n >= {_CFG.max_files} OR w.bytes >= {_CFG.max_size} THEN 1 ELSE w.n + 1 END,
         CASE WHEN w.n >= {_CFG.max_files} OR w.bytes >= {_CFG.max_size} THEN f.length ELSE w.bytes + f.length END
  FROM walk w JOIN files f ON f.feed = w.feed AND f.seq = w.seq + 1),
planned AS (SELECT f.*, w.batch_no FROM files f JOIN walk w ON w.feed = f.feed AND w.seq = f.seq),
stats AS (
  SELECT feed, batch_no, count(*) AS batch_files, CAST(sum(length) AS BIGINT) AS batch_bytes,
         bool_or({_AGE_SQL}) AS aged
  FROM planned GROUP BY feed, batch_no),
plan AS (
  SELECT p.feed, p.path, p.length, p.mtime, p.seq, p.batch_no, s.batch_files, s.batch_bytes,
         (s.batch_files >= {_CFG.max_files} OR s.aged OR s.batch_bytes >= {_CFG.max_size}) AS fired
  FROM planned p JOIN stats s ON s.feed = p.feed AND s.batch_no = p.batch_no)"""


def _plan(spark, d):
    return batching.batch_plan(S.paired_landing(spark, d), _CFG, S.FILE_AS_OF)


register("batch_plan", _cte(S.LANDING_SQL, S.MANIFEST_SQL, S.PAIRED_SQL, PLAN_SQL_BODY)
         + "\nSELECT * FROM plan")(_plan)


_PROFILE_SQL = """limits AS (
  SELECT feed,
         CASE WHEN CAST(substr(feed, 4) AS INTEGER) % 2 = 0 THEN 5 ELSE 12 END AS max_files,
         CASE WHEN CAST(substr(feed, 4) AS INTEGER) % 2 = 0 THEN 8000 ELSE 30000 END AS max_size
  FROM (SELECT DISTINCT source AS feed FROM documents)),
files AS (
  SELECT p.feed, path, length, mtime, row_number() OVER (PARTITION BY p.feed ORDER BY mtime, path) AS seq,
         l.max_files, l.max_size
  FROM paired p JOIN limits l ON l.feed = p.feed WHERE admitted),
walk(feed, seq, batch_no, n, bytes) AS (
  SELECT feed, seq, CAST(0 AS BIGINT), CAST(1 AS BIGINT), length FROM files WHERE seq = 1
  UNION ALL
  SELECT f.feed, f.seq,
         CASE WHEN w.n >= f.max_files OR w.bytes >= f.max_size THEN w.batch_no + 1 ELSE w.batch_no END,
         CASE WHEN w.n >= f.max_files OR w.bytes >= f.max_size THEN 1 ELSE w.n + 1 END,
         CASE WHEN w.n >= f.max_files OR w.bytes >= f.max_size THEN f.length ELSE w.bytes + f.length END
  FROM walk w JOIN files f ON f.feed = w.feed AND f.seq = w.seq + 1),
planned AS (SELECT f.*, w.batch_no FROM files f JOIN walk w ON w.feed = f.feed AND w.seq = f.seq),
stats AS (
  SELECT feed, batch_no, count(*) AS batch_files, CAST(sum(length) AS BIGINT) AS batch_bytes,
         bool_or(""" + _AGE_SQL + """) AS aged, max(max_files) AS mf, max(max_size) AS ms
  FROM planned GROUP BY feed, batch_no)"""


@register("batch_plan_per_feed", _cte(S.LANDING_SQL, S.MANIFEST_SQL, S.PAIRED_SQL, _PROFILE_SQL) + """
SELECT p.feed, p.path, p.length, p.mtime, p.seq, p.batch_no, s.batch_files, s.batch_bytes,
       (s.batch_files >= s.mf OR s.aged OR s.batch_bytes >= s.ms) AS fired
FROM planned p JOIN stats s ON s.feed = p.feed AND s.batch_no = p.batch_no""")
def q_batch_plan_per_feed(spark, d):
    """Feeds with their own limits, cut in one run (settings derived by rule
    from the feeds present)."""
    feeds = S.table(spark, d, "documents").select(F.col("source").alias("feed")).distinct()
    even = F.substring("feed", 4, 10).cast("int") % 2 == 0
    limits = feeds.select("feed", F.when(even, 5).otherwise(12).cast("long").alias("max_files"),
                          F.when(even, 8000).otherwise(30000).cast("long").alias("max_size"),
                          F.lit(_CFG.max_age).cast("long").alias("max_age"))
    return batching.batch_plan(S.paired_landing(spark, d), _CFG, S.FILE_AS_OF, limits=limits)


def _order_entries(records: DataFrame) -> DataFrame:
    return shred.shred_entries(
        records, "orders", F.col("o_orderkey"),
        {"status": F.col("o_orderstatus"), "total": F.col("o_totalprice").cast("decimal(18,2)")},
        F.col("o_orderdate"), index_fields=["status"], table="order", carry=["work_id"])


INGEST_TYPES_SQL = """
SELECT table_name, count(*) AS n_entries, count(DISTINCT src) AS n_work_items FROM (
  SELECT 'event' AS table_name, 'events' AS src FROM events, (VALUES (1), (2), (3)) f(k)
  WHERE (k = 1 AND event_type IS NOT NULL) OR (k = 2 AND value IS NOT NULL) OR (k = 3 AND props IS NOT NULL)
  UNION ALL SELECT 'index', 'events' FROM events WHERE event_type IS NOT NULL
  UNION ALL SELECT 'order', 'orders' FROM orders, (VALUES (1), (2)) f(k)
  WHERE (k = 1 AND o_orderstatus IS NOT NULL) OR (k = 2 AND o_totalprice IS NOT NULL)
  UNION ALL SELECT 'index', 'orders' FROM orders WHERE o_orderstatus IS NOT NULL)
GROUP BY table_name"""


@register("ingest_items", INGEST_TYPES_SQL)
def q_ingest_items(spark, d):
    """The ingest job end to end: the events and orders files become work
    messages, are read by data type, shredded, deduped and aggregated per
    work item, written as bulk output with manifests and read back."""
    inv = landing_inventory(spark, d, feed="testdata")
    files = inv.where(F.col("name").isin("events.parquet", "orders.parquet"))
    dtype = F.regexp_extract("name", r"^(.*)\.parquet$", 1)
    msgs = files.select(F.concat_ws(",", "path", F.lit("parquet"), dtype).alias("message"),
                        F.md5("path").alias("work_id"))
    types = {
        "events": lifecycle.DataType(TypeSpec("parquet", "event_id BIGINT, ts TIMESTAMP_NTZ, "
                                              "event_type STRING, value DOUBLE, props STRING"),
                                     lambda r: S.event_entries(r, carry=["work_id"])),
        "orders": lifecycle.DataType(TypeSpec("parquet", "o_orderkey BIGINT, o_orderdate TIMESTAMP_NTZ, "
                                              "o_orderstatus STRING, o_totalprice DOUBLE"), _order_entries),
    }
    out_dir = scratch_dir(spark, "ingest")
    lifecycle.ingest_items(spark, msgs, inv, types, S.FILE_AS_OF, "bulk", out_dir, batch_id="0")
    back = read_entries(spark, f"{out_dir}/data")
    return back.groupBy("table_name").agg(F.count(F.lit(1)).alias("n_entries"),
                                          F.countDistinct("work_id").alias("n_work_items"))


# ---------------------------------------------------------------- work items

_TARGET_SQL = """CASE WHEN instr(path, '/landing/flagged') > 0
            THEN '/data/flagged/' || substr(path, instr(path, '/landing/flagged') + 17)
            ELSE '/data/flagged/' || name END"""


@register("work_items", _cte(S.LANDING_SQL) + f"""
SELECT path, target_path, 'csv' AS format, 'mycsv' AS data_type,
       md5(target_path || '#' || CAST(length AS VARCHAR) || '#' || CAST(epoch_us(mtime) AS VARCHAR)) AS work_id,
       target_path || ',csv,mycsv' AS message
FROM (SELECT *, {_TARGET_SQL} AS target_path FROM landing)""")
def q_work_items(spark, d):
    items = work.work_items(S.landing_files(spark, d), "/data/flagged", "csv", "mycsv",
                            input_dir="/landing/flagged", preserve_path=True)
    return items.select("path", "target_path", "format", "data_type", "work_id", "message")


# The feeder tick of the end-to-end query.
TICK_SCAN = ScanConfig(input_dir="/landing/flagged", ignore_prefix="1", max_files=10, max_size=20_000,
                       max_age=60_000, error_retry_interval=1, error_retry_time_unit="DAYS")
TICK_FEEDER = FeederConfig(target_dir="/data/flagged", input_format="csv", data_type="mycsv", preserve_path=True)

_TICK_SQL_BODY = f"""files AS (
  SELECT l.* FROM landing l
  WHERE NOT EXISTS (SELECT 1 FROM failures f WHERE f.path = l.path
                    AND epoch_us({_FILE_AS_OF_SQL}) - epoch_us(f.failed_at) < {TICK_SCAN.retry_ms * 1000})
    AND NOT starts_with(l.name, '1')),
ordered AS (
  SELECT feed, path, name, length, mtime, row_number() OVER w AS seq,
         coalesce(count(*) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior_taken,
         coalesce(sum(length) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior_bytes
  FROM files WINDOW w AS (PARTITION BY feed ORDER BY mtime, path)),
scan AS (
  SELECT *, (seq = 1 OR (prior_taken < 10 AND prior_bytes < 20000)) AS scanned FROM ordered),
fired AS (
  SELECT feed FROM scan WHERE scanned GROUP BY feed
  HAVING count(*) >= 10 OR bool_or({_AGE_SQL}) OR sum(length) >= 20000)"""


@register("feeder_tick", _cte(S.LANDING_SQL, S.FAILURES_SQL, _TICK_SQL_BODY) + f"""
SELECT s.feed, s.path, t.target_path, 'csv' AS format, 'mycsv' AS data_type,
       md5(t.target_path || '#' || CAST(s.length AS VARCHAR) || '#' || CAST(epoch_us(s.mtime) AS VARCHAR)) AS work_id,
       t.target_path || ',csv,mycsv' AS message
FROM scan s JOIN fired USING (feed)
JOIN (SELECT path, {_TARGET_SQL} AS target_path FROM landing) t ON t.path = s.path
WHERE s.scanned""")
def q_feeder_tick(spark, d):
    out = lifecycle.feeder_tick(S.landing_files(spark, d).select(*LANDING_COLS), S.failures(spark, d),
                                TICK_SCAN, TICK_FEEDER, S.FILE_AS_OF)
    return out["items"].select("feed", "path", "target_path", "format", "data_type", "work_id", "message")


_MESSAGES_SQL = """msgs AS (
  SELECT doc_id, path || ',' || (CASE WHEN doc_id % 11 = 0 THEN 'xml' ELSE 'csv' END) || ',mycsv '
         || (CASE WHEN doc_id % 7 = 0 THEN ',extra' ELSE ',' END) AS message
  FROM landing
  UNION ALL SELECT doc_id, path || '.gone,csv,mycsv' FROM landing WHERE doc_id % 5 = 0),
inv AS (SELECT path AS inv_path, length FROM landing)"""


@register("parse_work_items", _cte(S.LANDING_SQL, _MESSAGES_SQL) + """
SELECT message, n_fields, p[1] AS path, p[2] AS format, trim(p[3]) AS data_type, inv.length,
       CASE WHEN n_fields <> 3 THEN 'bad_fields'
            WHEN p[2] NOT IN ('csv','json','parquet','orc','text','avro','binaryFile') THEN 'unknown_format'
            WHEN inv.inv_path IS NULL THEN 'missing'
            ELSE 'ok' END AS status
FROM (SELECT message, string_split(regexp_replace(message, ',+$', ''), ',') AS p,
             CAST(CASE WHEN message = '' THEN 0
                  ELSE len(string_split(regexp_replace(message, ',+$', ''), ',')) END AS INTEGER) AS n_fields
      FROM msgs) m
LEFT JOIN inv ON inv.inv_path = m.p[1]""")
def q_parse_work_items(spark, d):
    files = S.landing_files(spark, d)
    fmt = F.when(F.col("doc_id") % 11 == 0, F.lit("xml")).otherwise(F.lit("csv"))
    tail = F.when(F.col("doc_id") % 7 == 0, F.lit(",extra")).otherwise(F.lit(","))
    msgs = files.select(F.concat(F.col("path"), F.lit(","), fmt, F.lit(",mycsv "), tail).alias("message"))
    gone = files.where("doc_id % 5 = 0").select(F.concat("path", F.lit(".gone,csv,mycsv")).alias("message"))
    parsed = work.parse_work_items(msgs.unionByName(gone), files.select("path", "length"))
    return parsed.select("message", "n_fields", "path", "format", "data_type", "length", "status")


# Feeds and pools of the routing query, shaped like the
# reference's sample (plus a feed and a pool without partner).
ROUTE_FEEDS = [(f"src{i}", ("fast", "fastest", "slow")[i % 3]) for i in range(19)]  # src19 has no queue
ROUTE_POOLS = [("speedy", "fast", 1), ("speediest", "fastest", 1), ("idle", "unused", 1)]

_ROUTE_SQL = """feeds(feed, queue) AS (
  SELECT 'src' || CAST(i AS VARCHAR), CASE i % 3 WHEN 0 THEN 'fast' WHEN 1 THEN 'fastest' ELSE 'slow' END FROM range(19) t(i)),
pools(pool, queue, replicas) AS (VALUES ('speedy','fast',1), ('speediest','fastest',1), ('idle','unused',1))"""


@register("route_work", _cte(S.LANDING_SQL, _ROUTE_SQL) + """
SELECT f.queue, l.feed, l.path, p.pool, p.replicas,
       CASE WHEN f.queue IS NULL THEN 'no_queue' WHEN p.pool IS NULL THEN 'no_pool' ELSE 'ok' END AS route
FROM landing l LEFT JOIN feeds f ON f.feed = l.feed LEFT JOIN pools p ON p.queue = f.queue""")
def q_route_work(spark, d):
    feeds = work.config_table(spark, ROUTE_FEEDS, "feed string, queue string")
    pools = work.config_table(spark, ROUTE_POOLS, "pool string, queue string, replicas int")
    items = S.landing_files(spark, d).select("feed", "path")
    return work.route_work(items, feeds, pools).select("queue", "feed", "path", "pool", "replicas", "route")


DEAL_POOLS = [("speedy", "fast", 3), ("speediest", "fastest", 5), ("idle", "unused", 2)]   # replicas to deal to


@register("deal_work", _cte(S.LANDING_SQL, _ROUTE_SQL) + """
SELECT p.pool, count(*) AS n_items, CAST(sum(l.length) AS BIGINT) AS n_bytes,
       CASE p.pool WHEN 'speedy' THEN 3 WHEN 'speediest' THEN 5 END AS n_replicas,
       CASE WHEN p.pool IS NOT NULL THEN TRUE END AS bounded
FROM landing l LEFT JOIN feeds f ON f.feed = l.feed LEFT JOIN pools p ON p.queue = f.queue GROUP BY p.pool""")
def q_deal_work(spark, d):
    """The landing files dealt to their pools' replicas: items, bytes and replicas of each pool, and whether no
    replica has more than 1.25 times the mean (or its largest file); files without pool are one row."""
    feeds = work.config_table(spark, ROUTE_FEEDS, "feed string, queue string")
    pools = work.config_table(spark, DEAL_POOLS, "pool string, queue string, replicas int")
    items = S.landing_files(spark, d).select("feed", "path", "length", F.md5("path").alias("work_id"))
    dealt = work.deal_to_replicas(work.route_work(items, feeds, pools))
    per = dealt.groupBy("pool", "replica").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("b"), F.bool_and(F.col("deal") == "ok").alias("ok"))
    return per.groupBy("pool").agg(
        F.sum("n").alias("n_items"), F.sum("b").alias("n_bytes"),
        F.when(F.col("pool").isNotNull(), F.count("replica").cast("int")).alias("n_replicas"),
        F.bool_and(F.col("ok")).alias("_ok"), (F.max("b") <= F.ceil(1.25 * F.sum("b") / F.count("replica"))).alias("_within")).select(
        "pool", "n_items", "n_bytes", "n_replicas", F.when(F.col("pool").isNotNull(), F.col("_ok") & F.col("_within")).alias("bounded"))


@register("attempt_ledger", f"""
SELECT work_id, max(attempt) AS attempts,
       first(status ORDER BY attempt DESC, status = 'ok' DESC, ts DESC, status DESC) AS last_status, max(ts) AS last_at,
       CASE WHEN bool_or(status = 'ok') THEN 'done' WHEN max(attempt) >= {S.MAX_ATTEMPTS} THEN 'dead_letter'
            ELSE 'retry' END AS state
FROM (SELECT 'user-' || CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y-%m-%d') AS work_id, ts,
             CAST(extract(hour FROM ts) AS INTEGER) + 1 AS attempt,
             CASE WHEN event_type IN ('error', 'view') THEN 'failed' ELSE 'ok' END AS status FROM events)
GROUP BY work_id""")
def q_attempt_ledger(spark, d):
    """Work item = a user's day, delivery = its hour (reported once per event)."""
    ev = S.table(spark, d, "events")
    outcomes = ev.select(
        F.concat(F.lit("user-"), F.col("user_id").cast("string"), F.lit("-"), F.date_format("ts", "yyyy-MM-dd")).alias("work_id"),
        (F.hour("ts") + 1).alias("attempt"), F.col("ts").alias("at"),
        F.when(F.col("event_type").isin("error", "view"), F.lit("failed")).otherwise(F.lit("ok")).alias("status"))
    return work.attempt_ledger(outcomes, S.MAX_ATTEMPTS).select(
        "work_id", "attempts", "last_status", "last_at", "state")


# ---------------------------------------------------------------- mapping

@register("shred_entries", _cte(S.EVENT_ENTRIES_SQL) + "\nSELECT * FROM entries")
def q_shred_entries(spark, d):
    return S.event_entries(S.event_records(spark, d))


@register("metadata_updates", _cte(S.EVENT_ENTRIES_SQL) + """
SELECT 'metadata' AS table_name, family AS row_key, 'field' AS family, qualifier,
       max(ts) AS ts, CAST(count(*) AS VARCHAR) AS value, min(ts) AS first_ts
FROM entries WHERE table_name = 'event' GROUP BY family, qualifier""")
def q_metadata_updates(spark, d):
    return shred.metadata_updates(S.event_entries(S.event_records(spark, d)))


# ---------------------------------------------------------------- combine

@register("dedupe_entries", _cte(S.LINEITEM_ENTRIES_SQL) + "\nSELECT DISTINCT * FROM entries")
def q_dedupe_entries(spark, d):
    return combine.dedupe_entries(S.lineitem_entries(spark, d))


@register("aggregate_entries", _cte(S.LINEITEM_ENTRIES_SQL) + r"""
SELECT table_name, row_key, family, qualifier, max(ts) AS ts,
       CASE WHEN table_name = 'qty'
            THEN regexp_replace(CAST(sum(TRY_CAST(value AS DECIMAL(28,9))) AS VARCHAR), '\.?0*$', '')
            ELSE first(value ORDER BY ts DESC, value DESC) END AS value,
       count(*) AS n_combined,
       count(*) FILTER (WHERE table_name = 'qty' AND TRY_CAST(value AS DECIMAL(28,9)) IS NULL) AS n_rejected
FROM (SELECT DISTINCT * FROM entries) GROUP BY table_name, row_key, family, qualifier""")
def q_aggregate_entries(spark, d):
    deduped = combine.dedupe_entries(S.lineitem_entries(spark, d))
    return combine.aggregate_entries(deduped, sum_tables=["qty"])


@register("sort_entries", _cte(S.LINEITEM_ENTRIES_SQL) + "\nSELECT * FROM entries")
def q_sort_entries(spark, d):
    return combine.sort_entries(S.lineitem_entries(spark, d))


@register("table_counters", _cte(S.EVENT_ENTRIES_SQL) + """
SELECT table_name, count(*) AS n_entries FROM (
  SELECT table_name FROM entries
  UNION ALL SELECT 'metadata' FROM (SELECT DISTINCT family, qualifier FROM entries WHERE table_name = 'event'))
GROUP BY table_name""")
def q_table_counters(spark, d):
    entries = S.event_entries(S.event_records(spark, d))
    meta = shred.metadata_updates(entries).drop("first_ts")
    return combine.table_counters(entries.unionByName(meta))


# ---------------------------------------------------------------- sinks

@register("write_bulk", _cte(_event_entries_sql(True), """srcs AS (
  SELECT DISTINCT '/landing/flagged/events/user-' || CAST(user_id AS VARCHAR) || '.json' AS source_path FROM events)""") + """
SELECT m.source_path, e.* FROM srcs m LEFT JOIN entries e ON e.work_id = md5(m.source_path)""")
def q_write_bulk(spark, d):
    """Every written entry, found through its manifest line."""
    paths = _bulk_written(spark, d)
    lines = bulk.read_manifests(spark, paths["manifests"])
    parts = F.split("value", "\t", -1)
    man = lines.select(F.get(parts, 0).alias("work_id"), F.get(parts, 1).alias("source_path"))
    return man.join(read_entries(spark, paths["data"]).drop("batch_id", "bucket"), "work_id", "left")


@register("upsert_live", """
SELECT 'user_last' AS table_name, CAST(user_id AS VARCHAR) AS row_key, event_type AS family,
       'value' AS qualifier, first(v ORDER BY ts DESC, v DESC) AS value, max(ts) AS ts,
       count(*) AS n_versions
FROM (SELECT *, CAST(CAST(value AS DECIMAL(18,4)) AS VARCHAR) AS v FROM events
      WHERE value IS NOT NULL AND event_type IS NOT NULL)
GROUP BY user_id, event_type""")
def q_upsert_live(spark, d):
    ev = S.table(spark, d, "events").where(F.col("value").isNotNull() & F.col("event_type").isNotNull())
    entries = ev.select(
        F.lit("user_last").alias("table_name"), F.col("user_id").cast("string").alias("row_key"),
        F.col("event_type").alias("family"), F.lit("value").alias("qualifier"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.col("value").cast("decimal(18,4)").cast("string").alias("value"),
        F.dayofmonth("ts").alias("day"))
    table_dir = scratch_dir(spark, "live")
    live.upsert_live(entries, table_dir, run_id="q", batch_col="day")
    return live.live_current(spark, table_dir).select(
        "table_name", "row_key", "family", "qualifier", "value", "ts", "n_versions")


LIVE_COUNTERS_SQL = r"""
WITH e AS (
  SELECT 'qty' AS table_name, CAST(l_suppkey AS VARCHAR) AS row_key, l_returnflag AS qualifier, l_shipdate AS ts,
         CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR) AS value FROM lineitem
  UNION ALL
  SELECT 'price', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), l_shipdate,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) FROM lineitem)
SELECT table_name, row_key, 'line' AS family, qualifier, max(ts) AS ts,
       CASE WHEN table_name = 'qty'
            THEN regexp_replace(CAST(sum(CAST(value AS DECIMAL(28,9))) AS VARCHAR), '\.?0*$', '')
            ELSE first(value ORDER BY ts DESC, value DESC) END AS value
FROM e GROUP BY table_name, row_key, qualifier"""


@register("live_counters", LIVE_COUNTERS_SQL)
def q_live_counters(spark, d):
    """Counters and newest values over four batches: one replayed, two folded
    into a snapshot before the last two arrive, the third folded again."""
    rows = _line_entries(spark, d)
    table_dir = scratch_dir(spark, "live-counters")
    for batch in (0, 1, 1):
        live.upsert_live(combine.aggregate_entries(rows.where(F.col("batch") == batch), ["qty"]), table_dir, "q", batch)
    live.compact_live(spark, table_dir, sum_tables=["qty"])
    for batch in (2, 3):
        live.upsert_live(combine.aggregate_entries(rows.where(F.col("batch") == batch), ["qty"]), table_dir, "q", batch)
    live.compact_live(spark, table_dir, upto=live.batch_tag("q", 2), sum_tables=["qty"])
    return live.live_current(spark, table_dir, ["qty"]).drop("n_versions")


@register("levelled_live", LIVE_COUNTERS_SQL)
def q_levelled_live(spark, d):
    """The same batches in key buckets: one replayed, merged where a bucket has too many runs, one replayed
    again after that, read from the newest version."""
    rows = _line_entries(spark, d)
    table_dir = scratch_dir(spark, "levelled")
    for batch in (0, 1, 1, 2, 0, 3):
        levelled.upsert(rows.where(F.col("batch") == batch), table_dir, "q", batch, ["qty"], buckets=8)
        levelled.compact(spark, table_dir, ["qty"], max_runs=2)
    levelled.vacuum(spark, table_dir)
    return levelled.read(spark, table_dir, ["qty"])


def _line_entries(spark, d):
    """Quantity counters and newest prices of all lines, with the batch (of four) they come in."""
    li = S.table(spark, d, "lineitem").select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("_kind"))

    def of(qty, price):
        return F.when(F.col("_kind") == 0, qty).otherwise(price)

    return li.select((F.col("l_linenumber") % 4).alias("batch"), of(F.lit("qty"), F.lit("price")).alias("table_name"),
                     of(F.col("l_suppkey"), F.col("l_orderkey")).cast("string").alias("row_key"), F.lit("line").alias("family"),
                     of(F.col("l_returnflag"), F.col("l_linenumber").cast("string")).alias("qualifier"), F.col("l_shipdate").cast("timestamp_ntz").alias("ts"),
                     of(F.col("l_quantity"), F.col("l_extendedprice")).cast("decimal(18,2)").cast("string").alias("value"))


# ---------------------------------------------------------------- bundles

@register("pair_manifests", _cte(S.LANDING_SQL, S.MANIFEST_SQL) + f"""
SELECT l.feed, l.doc_id, l.path, l.name, l.length, l.mtime, m.path AS manifest_path
FROM landing l JOIN manifests m ON m.path = l.path || '.manifest'""")
def q_pair_manifests(spark, d):
    paired = bundle.pair_manifests(S.landing_files(spark, d).select(*LANDING_COLS), S.manifest_files(spark, d))
    return paired.select(*LANDING_COLS, "manifest_path")


@register("unpaired_files", _cte(S.LANDING_SQL, S.MANIFEST_SQL) + """,
allmanifests AS (SELECT path FROM manifests UNION ALL SELECT path || '.gone.manifest' FROM landing WHERE doc_id % 9 = 0)
SELECT 'no_manifest' AS kind, path FROM landing d
WHERE NOT EXISTS (SELECT 1 FROM allmanifests m WHERE m.path = d.path || '.manifest')
UNION ALL
SELECT 'no_data', path FROM allmanifests m
WHERE NOT EXISTS (SELECT 1 FROM landing d WHERE d.path || '.manifest' = m.path)""")
def q_unpaired_files(spark, d):
    """All data files; some manifests name files that are gone."""
    data = S.landing_files(spark, d)
    gone = data.where("doc_id % 9 = 0").select(F.concat("path", F.lit(".gone.manifest")).alias("path"))
    return bundle.unpaired_files(data, S.manifest_files(spark, d).select("path").unionByName(gone))


@register("compact_bundles", _cte(S.LANDING_SQL, S.MANIFEST_SQL, S.PAIRED_SQL, PLAN_SQL_BODY) + """,
own AS (SELECT *, md5(path || '#' || CAST(length AS VARCHAR) || '#' || CAST(epoch_us(mtime) AS VARCHAR)) AS h
        FROM plan WHERE fired),
ids AS (
  SELECT feed, batch_no, md5(feed || '#' || CAST(batch_no AS VARCHAR) || '#' || CAST(count(*) AS VARCHAR)
         || '#' || CAST(sum(CAST('0x' || substr(h, 1, 15) AS BIGINT)) AS VARCHAR)
         || '#' || CAST(sum(CAST('0x' || substr(h, 16, 15) AS BIGINT)) AS VARCHAR)) AS bundle_id
  FROM own GROUP BY feed, batch_no)
SELECT i.bundle_id, p.path, doc.doc_id, doc.n_chars, md5(doc.text) AS text_md5
FROM own p JOIN ids i ON i.feed = p.feed AND i.batch_no = p.batch_no
JOIN landing l ON l.path = p.path JOIN documents doc ON doc.doc_id = l.doc_id""")
def q_compact_bundles(spark, d):
    """Every member as read back from its bundle."""
    plan = _plan(spark, d)
    docs = S.table(spark, d, "documents")
    records = docs.select(
        F.concat(F.lit(S.LANDING_ROOT), "source", F.lit(S.FEED_FOLDER), F.col("doc_id").cast("string"),
                 F.lit(".txt")).alias("source_path"), "doc_id", "n_chars", "text")
    folder = bundles.bundle_folder(scratch_dir(spark, "bundles"), f"{S.FILE_AS_OF:%Y/%m/%d}")
    bundles.compact_bundles(records, plan, folder, columns=["doc_id", "n_chars", "text"])
    back = spark.read.schema("doc_id bigint, n_chars bigint, text string, source_path string, "
                             "bundle_id string").parquet(folder)
    return back.select("bundle_id", F.col("source_path").alias("path"), "doc_id", "n_chars", F.md5("text").alias("text_md5"))


@register("pipeline_end_to_end", """
SELECT 'event' AS table_name, CAST(event_id AS VARCHAR) AS row_key, 'events' AS family, 'event_type' AS qualifier, ts, event_type AS value,
       TRUE AS accounted FROM events WHERE event_id IS NOT NULL AND event_type IS NOT NULL
UNION ALL
SELECT 'event', CAST(event_id AS VARCHAR), 'events', 'props', ts, props, TRUE FROM events WHERE event_id IS NOT NULL AND props IS NOT NULL""")
def q_pipeline_end_to_end(spark, d):
    """Every bundled entry of an event, with whether the bundles' inputs are accounted
    for.  Entries of records without event_id are bundled and counted, see ``end_to_end``."""
    return end_to_end(spark, d).where("table_name = 'event'")


def end_to_end(spark, d):
    """Events written as files, then feeder, ingest and bundler, each on what the
    one before left; the bundler runs twice, the second time it finds nothing
    new.  Every bundled entry, those of rejected records too, with whether every
    input is bundled once and every record without event_id is among the rejected."""
    root = scratch_dir(spark, "end-to-end")
    stamp = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    (S.table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_type", "props")
     .write.options(**stamp).json(f"{root}/input"))
    as_of = dt.datetime(2100, 1, 1)   # every file is over age
    scan = ScanConfig(input_dir=f"{root}/input", max_age=0)
    feeder = FeederConfig(f"{root}/flagged", "json", "events")
    inv = landing_inventory(spark, f"{root}/input", feed="events")
    none = spark.createDataFrame([], "path string, failed_at timestamp_ntz, reason string")
    items = lifecycle.feeder_tick(inv, none, scan, feeder, as_of)["items"]
    spec = TypeSpec("json", "event_id long, ts timestamp_ntz, event_type string, props string", stamp)
    types = {"events": lifecycle.DataType(spec, lambda r: shred.shred_entries(
        r, "events", "event_id", {"event_type": "event_type", "props": "props"}, "ts", carry=["work_id"]))}
    lifecycle.ingest_items(spark, items.select("message", "work_id"), inv, types, as_of, "bulk", f"{root}/out", moved=items)
    bundler = BundlerConfig(f"{root}/bundles")
    lines = []
    for day in range(2):
        got = lifecycle.bundler_run(
            spark, bulk.bulk_units(spark, f"{root}/out", "bulk"), none, scan, bundler, as_of + dt.timedelta(days=day),
            bulk.unit_members(spark, f"{root}/out"), items.select(F.col("target_path").alias("path")), f"{root}/state")
        lines.append(got["accounting"].select("work_id", "status"))
    moved = lines[0].unionByName(lines[1]).where("status = 'moved'")
    # every input is accounted for, once
    whole = items.join(moved.groupBy("work_id").count(), "work_id", "left").agg(
        F.bool_and(F.coalesce(F.col("count") == 1, F.lit(False)))).first()[0]
    entries = bundles.read_bundles(spark, f"{root}/bundles", f"{root}/state")
    whole = bool(whole) and entries.where("table_name = 'rejected'").count() == \
        S.table(spark, d, "events").where("event_id is null").count()
    return entries.select(
        "table_name", "row_key", "family", "qualifier", "ts", "value", F.lit(whole).alias("accounted"))


# ---------------------------------------------------------------- streams with state, streams over files

HALF = dt.datetime(2024, 1, 16)      # the streams below stop here and are started again


def _in_two_runs(rows: DataFrame, time: str, start: Callable[[DataFrame, str], None], root: str) -> None:
    """``rows`` as files of a stream: those before ``HALF``, a run of the stream, the others, a second run."""
    spark = rows.sparkSession
    for k, part in enumerate((F.col(time) < as_of_col(HALF), F.col(time) >= as_of_col(HALF))):
        rows.where(part).write.mode("append").parquet(f"{root}/in/run={k}")
        start(spark.readStream.schema(rows.schema).option("recursiveFileLookup", "true").parquet(f"{root}/in"), f"{root}/state")


@register("quarantine_stream", _cte(S.LANDING_SQL, S.FAILURES_SQL, f"""ordered AS (
  SELECT *, lag(failed_at) OVER (PARTITION BY path ORDER BY failed_at, reason) AS before FROM failures WHERE failed_at IS NOT NULL),
stays AS (
  SELECT *, sum(CASE WHEN before IS NULL OR epoch_us(failed_at) - epoch_us(before) >= {_TTL_US} THEN 1 ELSE 0 END)
            OVER (PARTITION BY path ORDER BY failed_at, reason ROWS UNBOUNDED PRECEDING) AS stay FROM ordered)""") + f"""
SELECT path, min(failed_at) AS quarantined_at, max(failed_at) + INTERVAL {S.FAILURE_TTL_MS} MILLISECONDS AS released_at,
       count(*) AS n_failures, first(reason ORDER BY failed_at DESC, reason DESC) AS reason
FROM stays GROUP BY path, stay
HAVING ceil((epoch_us(max(failed_at)) + {_TTL_US}) / 1000.0) <= floor((SELECT max(epoch_us(failed_at)) FROM failures) / 1000.0)""")
def q_quarantine_stream(spark, d):
    """The ended stays in quarantine by a stream with a timer per path, stopped and started again half-way."""
    root = scratch_dir(spark, "quarantine-stream")
    rows = S.failures(spark, d).withColumn("failed_at", F.col("failed_at").cast("timestamp_ntz"))
    _in_two_runs(rows, "failed_at", lambda st, state: timed.run_to_table(
        timed.quarantine_stays(st, S.FAILURE_TTL_MS, "0 seconds"), f"{state}/out", f"{state}/checkpoint").awaitTermination(), root)
    return spark.read.schema("path string, quarantined_at timestamp_ntz, released_at timestamp_ntz, n_failures long, "
                             "reason string").parquet(f"{root}/state/out")


@register("feeder_stream", """
SELECT lang || '/' || doc_id || '.txt' AS name, strlen(coalesce(text, '')) AS length, 1::BIGINT AS n_items FROM documents
UNION ALL SELECT lang || '/' || doc_id || '.txt', strlen(coalesce(text, '')) + 1, 1 FROM documents WHERE doc_id % 3 = 0""")
def q_feeder_stream(spark, d):
    """The documents land as files and a third of them again under their old names with other bytes: work items
    of the feeder's ticks, each version once."""
    root = scratch_dir(spark, "feeder-stream")
    docs = S.table(spark, d, "documents").select(
        "doc_id", F.concat("lang", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"), F.coalesce("text", F.lit("")).alias("text"))
    scan = ScanConfig(input_dir=f"{root}/landing", recursive=True, max_files=-1, max_age=0)
    for files in (docs.select("path", F.col("text").alias("body")),
                  docs.where("doc_id % 3 = 0").select("path", F.concat("text", F.lit("+")).alias("body"))):
        _write_files(files, f"{root}/landing")
        time.sleep(1.1)                 # a tick's time has whole seconds; a file must be older
        q = feeder_stream(spark, f"{root}/landing", f"{root}/state", scan, FeederConfig("/flagged", "text", "doc"), feed="documents", trigger_ms=1000)
        while q.isActive and not any(p["numInputRows"] >= 0 and p["durationMs"].get("addBatch") for p in q.recentProgress):
            time.sleep(0.2)
        q.stop()
        if q.exception():
            raise q.exception()
    items = spark.read.schema("path string, length long, work_id string, tick long").parquet(f"{root}/state/work_items")
    return (items.groupBy(F.regexp_extract("path", "/landing/(.*)$", 1).alias("name"), "length")
            .agg(F.count(F.lit(1)).alias("n_items")))


@register("feeder_moves", """
SELECT s_nationkey || '/' || s_suppkey || '.txt' AS name, CASE WHEN s_suppkey % 5 = 0 THEN 'landing' ELSE 'flagged' END AS folder,
       strlen(s_name)::BIGINT AS length, CASE WHEN s_suppkey % 5 = 0 THEN 'clash' ELSE 'moved' END AS status FROM supplier
UNION ALL SELECT s_nationkey || '/' || s_suppkey || '.txt', 'flagged', 4, NULL FROM supplier WHERE s_suppkey % 5 = 0""")
def q_feeder_moves(spark, d):
    """The suppliers land as files in two lots; the feeder's loop, stopped in between, flags them and moves them.  At
    some targets lies another file, so these stay.  Where every file lies and what became of its move."""
    root = scratch_dir(spark, "feeder-moves")
    rows = S.table(spark, d, "supplier").select(
        "s_suppkey", F.concat(F.col("s_nationkey").cast("string"), F.lit("/"), F.col("s_suppkey").cast("string"), F.lit(".txt")).alias("path"),
        F.col("s_name").alias("body"))
    target = f"file:{root}/flagged" if root.startswith("/") else f"{root}/flagged"
    _write_files(rows.where("s_suppkey % 5 = 0").select("path", F.lit("old.").alias("body")), f"{root}/flagged")
    scan = ScanConfig(input_dir=f"{root}/landing", recursive=True, max_files=-1, max_age=0)
    for half in ("s_suppkey % 2 = 0", "s_suppkey % 2 = 1"):
        _write_files(rows.where(half).select("path", "body"), f"{root}/landing")
        time.sleep(1.1)                 # a tick's time has whole seconds; a file must be older
        _one_tick(feeder_stream(spark, f"{root}/landing", f"{root}/state", scan, FeederConfig(target, "text", "supplier", preserve_path=True),
                                feed="suppliers", trigger_ms=1000, move=True))
    lies = [landing_inventory(spark, f"{root}/{f}", recursive=True).select(
        F.regexp_extract("path", f"/{f}/(.*)$", 1).alias("name"), F.lit(f).alias("folder"), "length") for f in ("landing", "flagged")]
    moves = spark.read.schema("path string, target string, status string").parquet(f"{root}/state/moves/outcomes").select(
        F.regexp_extract("path", "/landing/(.*)$", 1).alias("name"), "status",
        F.when(F.col("status") == "moved", "flagged").otherwise("landing").alias("folder"))
    return lies[0].unionByName(lies[1]).join(moves, ["name", "folder"], "left").select("name", "folder", "length", "status")


def _one_tick(q) -> None:
    """Run a loop until a tick is done."""
    while q.isActive and not any(p["numInputRows"] >= 0 and p["durationMs"].get("addBatch") for p in q.recentProgress):
        time.sleep(0.2)
    q.stop()
    if q.exception():
        raise q.exception()


@register("bundler_stream", f"""
WITH e AS (SELECT *, coalesce(event_id, 0) % 16 AS b FROM events)
SELECT 'bucket-' || b || '.frm' AS file, 'event' AS table_name, CAST(event_id AS VARCHAR) AS row_key, 'events' AS family, 'event_type' AS qualifier, ts,
       event_type AS value, 'bundled' AS status FROM e WHERE b <> {CUT_BUCKET}
UNION ALL SELECT DISTINCT 'bucket-' || b || '.frm', NULL, NULL, NULL, NULL, NULL, NULL, 'moved' FROM e WHERE b <> {CUT_BUCKET}
UNION ALL SELECT DISTINCT 'bucket-{CUT_BUCKET}.frm', NULL, NULL, NULL, NULL, NULL, NULL, 'quarantined' FROM e WHERE b = {CUT_BUCKET}""")
def q_bundler_stream(spark, d):
    """Entries of the events as files with manifests, one file cut off, land in two lots; the bundler's loop is
    stopped in between.  Every bundled entry, every input that is accounted for and the file in quarantine."""
    root = scratch_dir(spark, "bundler-stream")
    bucket = F.pmod(F.coalesce("event_id", F.lit(0)), F.lit(16))
    entries = S.table(spark, d, "events").select(
        F.lit("event").alias("table_name"), F.col("event_id").cast("string").alias("row_key"), F.lit("events").alias("family"),
        F.lit("event_type").alias("qualifier"), F.col("ts").cast("timestamp_ntz").alias("ts"), F.col("event_type").alias("value"),
        F.concat(F.lit("bucket-"), bucket).alias("bucket"), bucket.alias("b"))
    name = F.regexp_extract("path", "([^/]*)$", 1).alias("file")
    members = Members(TypeSpec("framed", ENTRY_DDL))
    for lot, part in enumerate((F.col("b") < 8, F.col("b") >= 8)):
        here = entries.where(part)
        each = here.repartitionById(8, F.pmod("b", F.lit(8)).cast("int")).drop("b")       # a task per file of the lot
        here = here.drop("b")
        write_framed(each.sortWithinPartitions("bucket", "row_key", "ts", "value"), f"{root}/work/lot-{lot}", file_by="bucket")
        _write_files(here.select("bucket").distinct().select(
            F.concat("bucket", F.lit(".frm.manifest")).alias("path"),
            F.concat(F.lit("w-"), "bucket", F.lit("\t/in/flagged/"), "bucket", F.lit(".frm\n")).alias("body")), f"{root}/work/lot-{lot}")
        cut = f"{root}/work/lot-{lot}/bucket-{CUT_BUCKET}.frm"
        if folder_exists(spark, cut):
            _cut_off(cut, Framed.HEAD.size + 1)
        time.sleep(1.1)                 # a tick's time has whole seconds; a file must be older
        _one_tick(bundler_stream(spark, f"{root}/state", ScanConfig(max_files=3, max_age=0, error_retry_interval=3_600_000),
                                 BundlerConfig(f"{root}/bundles"), lambda: landing_inventory(spark, f"{root}/work", recursive=True, feed="events"),
                                 lambda: members, trigger_ms=1000))
    last = max(int(n.split("=")[1]) for n in folder_names(spark, f"{root}/state/quarantine"))
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (x.split() for x in ENTRY_DDL.split(", "))]
    bundled = bundles.read_bundles(spark, f"{root}/bundles", f"{root}/state").select(
        F.substring_index("source_path", "/", -1).alias("file"), *ENTRY_COLUMNS, F.lit("bundled").alias("status"))
    accounted = spark.read.schema(ACCOUNTING).parquet(f"{root}/state/accounting").select(
        F.regexp_extract("loaded_path", "^/in/loaded/(.*)$", 1).alias("file"), *nothing, "status")
    failed = spark.read.schema(QUARANTINE_SCHEMA).parquet(f"{root}/state/quarantine/tick={last}").select(
        name, *nothing, F.lit("quarantined").alias("status"))
    return bundled.unionByName(accounted).unionByName(failed)


@register("move_files", """
SELECT lang || '/' || doc_id || '.txt' AS name, CASE WHEN doc_id % 9 = 0 THEN 'missing' WHEN doc_id % 10 = 0 THEN 'clash' ELSE 'moved' END AS status,
       doc_id % 9 > 0 AND doc_id % 10 = 0 AS landed, doc_id % 10 = 0 OR doc_id % 9 > 0 AS flagged,
       CASE WHEN doc_id % 10 = 0 THEN 4 WHEN doc_id % 9 > 0 THEN strlen(coalesce(text, '')) END AS flagged_length
FROM documents""")
def q_move_files(spark, d):
    """The documents as landed files moved to their flagged targets, run twice: some are gone before, at some targets
    there is another file.  What became of each, and where the files lie."""
    root = scratch_dir(spark, "move")
    docs = S.table(spark, d, "documents").select(
        "doc_id", F.concat("lang", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"), F.coalesce("text", F.lit("")).alias("text"))
    _write_files(docs.select("path", F.col("text").alias("body")), f"{root}/landed")
    _write_files(docs.where("doc_id % 10 = 0").select("path", F.lit("old.").alias("body")), f"{root}/flagged")
    inv = landing_inventory(spark, f"{root}/landed", recursive=True)
    moves = mover.plan_moves(inv.withColumn("target_path", flagged_path("path", f"file:{root}/flagged" if root.startswith("/") else f"{root}/flagged",
                                                                        f"{root}/landed", True)))
    _write_files(docs.where("doc_id % 9 = 0").select("path", F.lit(None).cast("string").alias("body")), f"{root}/landed")
    for _ in range(2):
        done = mover.move_files(spark, moves, f"{root}/state", "tick-0")
    name = lambda c, folder: F.regexp_extract(c, f"/{folder}/(.*)$", 1).alias("name")
    here = landing_inventory(spark, f"{root}/landed", recursive=True).select(name("path", "landed"), F.lit(True).alias("l"))
    there = landing_inventory(spark, f"{root}/flagged", recursive=True).select(name("path", "flagged"), F.col("length").alias("flagged_length"))
    return (done.select(name("path", "landed"), "status").join(here, "name", "left").join(there, "name", "left")
            .select("name", "status", F.coalesce("l", F.lit(False)).alias("landed"), F.col("flagged_length").isNotNull().alias("flagged"), "flagged_length"))


@register("ingest_stream", r"""
SELECT 'count' AS table_name, event_type AS row_key, 'day' AS family, strftime(ts, '%Y-%m-%d') AS qualifier,
       CAST(count(*) AS VARCHAR) AS value, max(date_trunc('day', ts)) AS ts
FROM (SELECT DISTINCT * FROM events) WHERE event_type IS NOT NULL GROUP BY ALL""")
def q_ingest_stream(spark, d):
    """Events per type and day counted by the live stream: events of one type and day are equal but for their ids."""
    out = scratch_dir(spark, "ingest-stream")
    day = F.date_trunc("day", F.col("ts")).cast("timestamp_ntz")

    def shred_counts(batch):
        return batch.select(F.lit("count").alias("table_name"), F.col("event_type").alias("row_key"), F.lit("day").alias("family"),
                            F.date_format("ts", "yyyy-MM-dd").alias("qualifier"), day.alias("ts"), F.lit("1").alias("value"),
                            "event_id").where("event_type is not null")

    q = ingest_stream(spark, d, "parquet", S.table(spark, d, "events").schema, f"{out}/checkpoint", f"{out}/tables", shred_counts,
                      sum_tables=["count"], record=["event_id"], available_now=True, options={"pathGlobFilter": "events.parquet"})
    q.awaitTermination()
    return live.live_current(spark, f"{out}/tables", ["count"]).drop("n_versions")


@register("redelivered_records", r"""
SELECT 'count' AS table_name, event_type AS row_key, 'events' AS family, 'n' AS qualifier, CAST(count(DISTINCT event_id) AS VARCHAR) AS value
FROM events WHERE event_type IS NOT NULL GROUP BY event_type""")
def q_redelivered_records(spark, d):
    """Events counted over four batches: the second brings half of the first again, the third is replayed,
    the fourth brings everything again; each event counts once."""
    out = scratch_dir(spark, "redelivered")
    events = S.table(spark, d, "events")
    part = F.pmod(F.xxhash64("event_id"), F.lit(4))
    for batch, rows in ((0, part < 2), (1, (part == 1) | (part == 2)), (2, part >= 2), (2, part >= 2), (3, part >= 0)):
        fresh = seen.new_records(events.where(rows), ["event_id"], f"{out}/seen", live.batch_tag("q", batch))
        seen.compact_seen(spark, f"{out}/seen", live.batch_tag("q", batch), max_runs=1)
        counts = fresh.where("event_type is not null").groupBy("event_type").agg(F.max("ts").cast("timestamp_ntz").alias("ts"), F.count(F.lit(1)).alias("n"))
        live.upsert_live(counts.select(F.lit("count").alias("table_name"), F.col("event_type").alias("row_key"), F.lit("events").alias("family"),
                                       F.lit("n").alias("qualifier"), "ts", F.col("n").cast("string").alias("value")), f"{out}/tables", "q", batch)
    return live.live_current(spark, f"{out}/tables", ["count"]).select("table_name", "row_key", "family", "qualifier", "value")


BACKOFF_MS, MOST_MS = 60_000, 86_400_000


@register("redelivery_stream", f"""
WITH o AS (SELECT 'user-' || CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y-%m') AS work_id, ts, ts >= TIMESTAMP '{HALF}' AS second,
                  CAST(extract(day FROM ts) AS INTEGER) AS attempt, event_type NOT IN ('error', 'view', 'click') AS ok FROM events),
over AS (SELECT work_id, first(ok ORDER BY attempt, ts) AS ok, min(attempt) AS attempt, first(ts ORDER BY attempt, ts) AS ts
         FROM o WHERE ok OR attempt >= {S.MAX_ATTEMPTS} GROUP BY work_id),
last AS (SELECT work_id, second, max(attempt) AS attempt, arg_min(ts, (-attempt, ts)) AS ts,
                max(CAST(second AS INTEGER)) OVER (PARTITION BY work_id) = CAST(second AS INTEGER) AS newest
         FROM o GROUP BY work_id, second),
marks AS (SELECT max(ts) FILTER (NOT second) AS first, max(ts) AS final FROM o),
due AS (SELECT work_id, last.attempt + 1 AS attempt, newest, second,
               last.ts + to_microseconds(CAST(1000 * least({MOST_MS}, {BACKOFF_MS} * 2 ** (last.attempt - 1)) AS BIGINT)) AS due
        FROM last LEFT JOIN over USING (work_id) WHERE over.ts IS NULL OR (NOT second AND over.ts >= TIMESTAMP '{HALF}'))
SELECT work_id, CASE WHEN ok THEN 'done' ELSE 'dead_letter' END AS "action", attempt, ts AS "at" FROM over
UNION ALL SELECT work_id, 'deliver', attempt, due FROM due, marks
WHERE ceil(epoch_us(due) / 1000.0) <= floor(epoch_us(CASE WHEN newest THEN marks.final ELSE marks.first END) / 1000.0)""")
def q_redelivery_stream(spark, d):
    """Work item = a user's month, delivery = its day: what a stream with a timer per item does with the
    items, stopped and started again half-way."""
    root = scratch_dir(spark, "redelivery-stream")
    rows = S.table(spark, d, "events").select(
        F.concat(F.lit("user-"), F.col("user_id").cast("string"), F.lit("-"), F.date_format("ts", "yyyy-MM")).alias("work_id"),
        F.dayofmonth("ts").alias("attempt"), F.col("ts").cast("timestamp_ntz").alias("at"),
        F.when(F.col("event_type").isin("error", "view", "click"), "failed").otherwise("ok").alias("status"))
    _in_two_runs(rows, "at", lambda st, state: timed.run_to_table(
        timed.redelivery_actions(st, S.MAX_ATTEMPTS, timed.doubling_backoff(BACKOFF_MS, MOST_MS), "0 seconds"),
        f"{state}/out", f"{state}/checkpoint").awaitTermination(), root)
    return spark.read.schema("work_id string, action string, attempt int, at timestamp_ntz").parquet(f"{root}/state/out")


@register("keyed_lookup", _cte(S.LINEITEM_ENTRIES_SQL) + """
SELECT 'key' AS asked, entries.* FROM entries JOIN (SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS k FROM orders WHERE o_orderkey % 50 = 0) o
  ON entries.row_key = o.k WHERE table_name = 'price'
UNION ALL SELECT 'range', * FROM entries WHERE table_name = 'qty' AND row_key BETWEEN '10' AND '2'""")
def q_keyed_lookup(spark, d):
    """Entries of all lines in two sorted folders merged into one; the prices of every fiftieth order and the
    quantities of a range of keys looked up."""
    root = scratch_dir(spark, "keyed")
    entries = S.lineitem_entries(spark, d)
    half = F.pmod(F.xxhash64("row_key"), F.lit(2)) == 0
    for name, part in (("a", half), ("b", ~half)):
        keyed.write_keyed(entries.where(part), f"{root}/{name}", files=8)
    keyed.merge_keyed(spark, [f"{root}/a", f"{root}/b"], f"{root}/whole", files=16)
    keys = S.table(spark, d, "orders").where("o_orderkey % 50 = 0").select(F.lit("price").alias("table_name"), F.col("o_orderkey").cast("string").alias("row_key"))
    columns = ["table_name", "row_key", "family", "qualifier", "ts", "value"]
    return (keyed.lookup_keys(spark, f"{root}/whole", keys).select(F.lit("key").alias("asked"), *columns)
            .unionByName(keyed.lookup_range(spark, f"{root}/whole", "qty", "10", "2").select(F.lit("range").alias("asked"), *columns)))


@register("dated_output", """
SELECT event_id, '/bundles/' || strftime(ts, '%Y/%m/%d') AS dated_dir, '/bundles' AS flat_dir FROM events""")
def q_dated_output(spark, d):
    ev = S.table(spark, d, "events")
    return ev.select("event_id", bundle.dated_output("/bundles/", F.col("ts")).alias("dated_dir"),
                     bundle.dated_output("/bundles/", F.col("ts"), dated=False).alias("flat_dir"))


_LINES_SQL = """lines AS (
  SELECT CASE WHEN m.toxic = 1 THEN md5(l.path) ELSE md5(l.path) || chr(9) || l.path END AS value
  FROM manifests m JOIN landing l ON m.path = l.path || '.manifest')"""
_MORE_LINES_SQL = """morelines AS (
  SELECT value FROM lines UNION ALL SELECT md5(path) || chr(9) || path || '.gone' FROM landing WHERE doc_id % 4 = 0)"""


@register("file_accounting", _cte(S.LANDING_SQL, S.MANIFEST_SQL, _LINES_SQL, _MORE_LINES_SQL) + """,
inv AS (SELECT path AS inv_path FROM landing)
SELECT value, s[1] AS work_id, s[2] AS origin,
       CASE WHEN s[2] IS NULL OR s[2] = '' THEN NULL ELSE replace(s[2], '/flagged/', '/loaded/') END AS loaded_path,
       CASE WHEN s[2] IS NULL OR s[2] = '' THEN 'malformed'
            WHEN inv.inv_path IS NULL THEN 'missing' ELSE 'moved' END AS status
FROM (SELECT value, string_split(value, chr(9)) AS s FROM morelines) x
LEFT JOIN inv ON inv.inv_path = x.s[2]""")
def q_file_accounting(spark, d):
    files = S.landing_files(spark, d)
    manifests = S.manifest_files(spark, d)
    paired = bundle.pair_manifests(files, manifests).join(
        manifests.select(F.col("path").alias("manifest_path"), "toxic"), "manifest_path")
    line = F.when(F.col("toxic") == 1, F.md5("path")).otherwise(
        F.concat(F.md5("path"), F.lit("\t"), F.col("path")))
    gone = files.where("doc_id % 4 = 0").select(F.concat(F.md5("path"), F.lit("\t"), "path", F.lit(".gone")).alias("value"))
    lines = paired.select(line.alias("value")).unionByName(gone)
    inv = files.select("path")
    return bundle.file_accounting(lines, inv).select("value", "work_id", "origin", "loaded_path", "status")


_LEDGER_SQL = f"""events AS (
  SELECT path, 'landed' AS stage, mtime AS "at" FROM landing
  UNION ALL
  SELECT l.path, 'flagged', TIMESTAMP '{S.FILE_AS_OF:%Y-%m-%d %H:%M:%S}' FROM landing l
  JOIN manifests m ON m.path = l.path || '.manifest'
  UNION ALL
  SELECT path, 'quarantined', failed_at FROM failures
  UNION ALL
  SELECT s[2], 'loaded', TIMESTAMP '{S.FILE_AS_OF:%Y-%m-%d %H:%M:%S}' + INTERVAL 1 HOUR
  FROM (SELECT string_split(value, chr(9)) AS s FROM lines) WHERE s[2] IS NOT NULL AND s[2] <> ''),
ranked AS (
  SELECT *, list_position(['landed','flagged','quarantined','dead_letter','loaded'], stage) AS rk FROM events)"""


@register("file_ledger", _cte(S.LANDING_SQL, S.MANIFEST_SQL, S.FAILURES_SQL, _LINES_SQL, _LEDGER_SQL) + """
SELECT path, first(stage ORDER BY "at" DESC, rk DESC) AS status, max("at") AS status_at, count(*) AS n_events,
       min("at") FILTER (WHERE stage = 'landed') AS landed_at,
       min("at") FILTER (WHERE stage = 'flagged') AS flagged_at,
       min("at") FILTER (WHERE stage = 'quarantined') AS quarantined_at,
       min("at") FILTER (WHERE stage = 'dead_letter') AS dead_letter_at,
       min("at") FILTER (WHERE stage = 'loaded') AS loaded_at
FROM ranked GROUP BY path""")
def q_file_ledger(spark, d):
    files = S.landing_files(spark, d)
    manifests = S.manifest_files(spark, d)
    paired = bundle.pair_manifests(files, manifests).join(
        manifests.select(F.col("path").alias("manifest_path"), "toxic"), "manifest_path")
    lines = paired.select(F.when(F.col("toxic") == 1, F.md5("path")).otherwise(
        F.concat(F.md5("path"), F.lit("\t"), F.col("path"))).alias("value"))
    acc = bundle.file_accounting(lines).where(F.col("status") != "malformed")
    as_of = as_of_col(S.FILE_AS_OF)
    events = (files.select("path", F.lit("landed").alias("stage"), F.col("mtime").alias("at"))
              .unionByName(paired.select("path", F.lit("flagged").alias("stage"), as_of.alias("at")))
              .unionByName(S.failures(spark, d).select("path", F.lit("quarantined").alias("stage"),
                                                       F.col("failed_at").alias("at")))
              .unionByName(acc.select(F.col("origin").alias("path"), F.lit("loaded").alias("stage"),
                                      F.timestamp_add("HOUR", F.lit(1), as_of).alias("at"))))
    return bundle.file_ledger(events)


@register("ingest_metrics", _cte(S.LANDING_SQL) + """
SELECT md5(l.path) AS work_id, count(*) AS n_records, CAST(sum(strlen(line)) AS BIGINT) AS n_bytes
FROM documents d JOIN landing l ON l.doc_id = d.doc_id,
     unnest(string_split(d.text, chr(10))) AS t(line)
GROUP BY l.path""")
def q_ingest_metrics(spark, d):
    docs = S.table(spark, d, "documents")
    work_id = F.md5(F.concat(F.lit(S.LANDING_ROOT), "source", F.lit(S.FEED_FOLDER),
                             F.col("doc_id").cast("string"), F.lit(".txt")))
    lines = docs.select(work_id.alias("work_id"), F.explode(F.split("text", "\n", -1)).alias("line"))
    return metrics.ingest_metrics(lines.withColumn("n", F.octet_length("line")), bytes_col="n")


@register("item_metrics", """
SELECT 'doc-' || doc_id || '.txt' AS work_id, CAST(1 + doc_id % 3 AS INTEGER) AS attempt, 'doc-' || doc_id || '.txt' AS file,
       CASE WHEN doc_id % 11 = 0 THEN 'missing' ELSE 'ok' END AS status,
       CASE WHEN doc_id % 11 > 0 THEN len(string_split(text, chr(10))) - CAST(text = '' OR text LIKE '%' || chr(10) AS INTEGER) END AS n_records,
       CASE WHEN doc_id % 11 > 0 THEN strlen(text) END AS n_bytes, doc_id % 11 > 0 AS timed
FROM (SELECT doc_id, replace(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS text FROM documents)""")
def q_item_metrics(spark, d):
    """The documents as text files, ingested line by line, some gone before they are read: attempt, file, records,
    bytes and whether the read was timed, per work item."""
    root = scratch_dir(spark, "item-metrics")
    docs = S.table(spark, d, "documents")
    name = F.concat(F.lit("doc-"), F.col("doc_id").cast("string"), F.lit(".txt"))
    # one kind of line end
    _write_files(docs.where("doc_id % 11 > 0").select(name.alias("path"), F.regexp_replace(
        F.coalesce("text", F.lit("")), "\r\n?", "\n").alias("body")), f"{root}/in")
    inv = landing_inventory(spark, f"{root}/in")
    msgs = docs.select(F.concat(F.lit(f"{root}/in/"), name, F.lit(",text,lines")).alias("message"), name.alias("work_id"),
                       (1 + F.col("doc_id") % 3).cast("int").alias("attempt"))
    types = {"lines": lifecycle.DataType(TypeSpec("text", "value string"), lambda r: shred.shred_entries(
        r, "lines", F.md5("value"), {"length": F.length("value")}, F.lit(None), carry=["work_id"]))}
    got = lifecycle.ingest_items(spark, msgs, inv, types, S.FILE_AS_OF, "bulk", f"{root}/out")["metrics"]
    return got.select("work_id", "attempt", file_name("path").alias("file"), "status", "n_records", "n_bytes",
                      (F.coalesce(F.col("duration_ms"), F.lit(0)) > 0).alias("timed"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q.run for name, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.sql for name, q in REGISTRY.items() if q.sql is not None}

