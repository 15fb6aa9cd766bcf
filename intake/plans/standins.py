"""How the given test tables stand in for ingest inputs.

* landing file  = one ``documents`` row: feed = source, length = n_chars,
  mtime = doc_id seconds after 1970-01-01, path below a ``/flagged/`` folder
  (twice, so first-only and every-occurrence rewrites differ);
* manifest      = one ``labels`` row, beside its data file;
* failure       = an ``events`` row of type ``error``, for the file whose
  doc_id is the event's user_id;
* record        = an ``events`` row; its input file is the user's file;
* repeated entries = ``lineitem`` (order key, line number is not unique).

Each stand-in has a Spark form and the same rows as a SQL CTE for the oracle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intake.config import ScanConfig
from intake.functions.ids import from_epoch_seconds
from intake.operators.shred import shred_entries
from intake.schemas import ENTRY_COLUMNS

# Stand-in layout and the settings the registered queries use.
LANDING_ROOT = "/landing/flagged/"
FEED_FOLDER = "/flagged/"
FILE_AS_OF = dt.datetime(1970, 1, 1, 0, 15, 0)
FAILURE_AS_OF = dt.datetime(2024, 1, 31, 0, 0, 0)
FAILURE_TTL_MS = 86_400_000
BATCH_CFG = ScanConfig(max_files=10, max_size=20_000, max_age=60_000)
MAX_ATTEMPTS = 20
EVENTS_SOURCE = "/landing/flagged/events/user-"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _landing_path(source, doc_id):
    return F.concat(F.lit(LANDING_ROOT), source, F.lit(FEED_FOLDER), doc_id.cast("string"), F.lit(".txt"))


def landing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = table(spark, sf_dir, "documents")
    return doc.select(
        F.col("source").alias("feed"), "doc_id", "lang",
        _landing_path(F.col("source"), F.col("doc_id")).alias("path"),
        F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("name"),
        F.col("n_chars").alias("length"),
        from_epoch_seconds(F.col("doc_id")).alias("mtime"))


def manifest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = table(spark, sf_dir, "labels")
    doc = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    m = lab.join(doc, "doc_id")
    return m.select(
        F.col("source").alias("feed"), "doc_id", "lang", "toxic",
        F.concat(_landing_path(F.col("source"), F.col("doc_id")), F.lit(".manifest")).alias("path"),
        F.concat(F.col("doc_id").cast("string"), F.lit(".txt.manifest")).alias("name"),
        F.lit(0).cast("long").alias("length"),
        from_epoch_seconds(F.col("doc_id") + 1).alias("mtime"))


def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").where(F.col("event_type") == "error")
    files = landing_files(spark, sf_dir).select("doc_id", "path")
    return ev.join(files, ev["user_id"] == files["doc_id"]).select(
        "path", F.col("ts").alias("failed_at"), F.col("props").alias("reason"))


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    src = F.concat(F.lit(EVENTS_SOURCE), F.col("user_id").cast("string"), F.lit(".json"))
    return ev.withColumn("source_path", src).withColumn("work_id", F.md5(src))


def event_fields() -> dict:
    return {
        "event_type": F.col("event_type"),
        "value": F.col("value").cast("decimal(18,4)"),
        "props": F.col("props"),
    }


def event_entries(records: DataFrame, carry=(), extra=()) -> DataFrame:
    return shred_entries(records, "events", F.col("event_id"), event_fields(), F.col("ts"),
                         index_fields=["event_type"], carry=carry, extra=extra)


def event_counter(ts="ts"):
    """One counter entry per event: events per type and day (an entry struct)."""
    return F.struct(
        F.lit("event_count").alias("table_name"), F.col("event_type").alias("row_key"),
        F.lit("day").alias("family"), F.date_format(ts, "yyyy-MM-dd").alias("qualifier"),
        F.col(ts).cast("timestamp_ntz").alias("ts"), F.lit("1").alias("value"))


def lineitem_entries(spark: SparkSession, sf_dir: str, redeliver: bool = True) -> DataFrame:
    """Quantity counters and newest-price entries per (order, line); with
    ``redeliver`` the rows of every third order key arrive twice.  One scan:
    the copies and both entry kinds come from ``explode``, and columns that are
    not asked for are not made."""
    li = table(spark, sf_dir, "lineitem")
    copies = (F.when(F.col("l_orderkey") % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
              if redeliver else F.array(F.lit(0)))
    return (li.select(F.explode(copies).alias("_copy"), "*").select(F.explode(F.array(F.lit(0), F.lit(1))).alias("_kind"), "*")
            .select(F.when(F.col("_kind") == 0, "qty").otherwise("price").alias("table_name"), F.col("l_orderkey").cast("string").alias("row_key"),
                    F.lit("line").alias("family"), F.col("l_linenumber").cast("string").alias("qualifier"),
                    F.col("l_shipdate").cast("timestamp_ntz").alias("ts"),
                    F.when(F.col("_kind") == 0, F.col("l_quantity")).otherwise(F.col("l_extendedprice")).cast("decimal(18,2)").cast("string").alias("value"))
            .select(*ENTRY_COLUMNS))


def paired_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from intake.operators.bundle import mark_paired
    return mark_paired(landing_files(spark, sf_dir), manifest_files(spark, sf_dir))


# ---- the same stand-ins as SQL CTEs (DuckDB) ----

LANDING_SQL = """landing AS (
  SELECT source AS feed, doc_id, lang,
         '/landing/flagged/' || source || '/flagged/' || CAST(doc_id AS VARCHAR) || '.txt' AS path,
         CAST(doc_id AS VARCHAR) || '.txt' AS name,
         n_chars AS length,
         TIMESTAMP '1970-01-01 00:00:00' + to_seconds(doc_id) AS mtime
  FROM documents)"""

MANIFEST_SQL = """manifests AS (
  SELECT d.source AS feed, l.doc_id, d.lang, l.toxic,
         '/landing/flagged/' || d.source || '/flagged/' || CAST(l.doc_id AS VARCHAR) || '.txt.manifest' AS path,
         CAST(l.doc_id AS VARCHAR) || '.txt.manifest' AS name,
         CAST(0 AS BIGINT) AS length,
         TIMESTAMP '1970-01-01 00:00:00' + to_seconds(l.doc_id + 1) AS mtime
  FROM labels l JOIN documents d ON d.doc_id = l.doc_id)"""

PAIRED_SQL = """paired AS (
  SELECT l.feed, l.doc_id, l.lang, l.path, l.name, l.length, l.mtime, (m.path IS NOT NULL) AS admitted
  FROM landing l LEFT JOIN manifests m ON m.path = l.path || '.manifest')"""

FAILURES_SQL = """failures AS (
  SELECT l.path, e.ts AS failed_at, e.props AS reason
  FROM events e JOIN landing l ON l.doc_id = e.user_id
  WHERE e.event_type = 'error')"""

EVENT_ENTRIES_SQL = """entries AS (
  SELECT 'event' AS table_name, CAST(event_id AS VARCHAR) AS row_key, 'events' AS family,
         'event_type' AS qualifier, ts, event_type AS value FROM events WHERE event_type IS NOT NULL
  UNION ALL
  SELECT 'index', event_type, 'event_type', CAST(event_id AS VARCHAR), ts, 'events'
  FROM events WHERE event_type IS NOT NULL
  UNION ALL
  SELECT 'event', CAST(event_id AS VARCHAR), 'events', 'value', ts,
         CAST(CAST(value AS DECIMAL(18,4)) AS VARCHAR) FROM events WHERE value IS NOT NULL
  UNION ALL
  SELECT 'event', CAST(event_id AS VARCHAR), 'events', 'props', ts, props FROM events WHERE props IS NOT NULL)"""

LINEITEM_ENTRIES_SQL = """li AS (
  SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 3 = 0),
entries AS (
  SELECT 'qty' AS table_name, CAST(l_orderkey AS VARCHAR) AS row_key, 'line' AS family,
         CAST(l_linenumber AS VARCHAR) AS qualifier, l_shipdate AS ts,
         CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR) AS value FROM li
  UNION ALL
  SELECT 'price', CAST(l_orderkey AS VARCHAR), 'line', CAST(l_linenumber AS VARCHAR), l_shipdate,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) FROM li)"""
