"""Scan filters: ignored prefix, manifest pre-check, quarantine.

The quarantine replaces the reference's in-memory expire-after-write cache by
a failure log table, so it survives a restart.  An entry written at
``failed_at`` is live while ``as_of - failed_at < ttl``; at exactly ``ttl`` it
has expired.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import datetime as dt

from intake.functions.ids import age_micros, as_of_col, ntz_literal


def _still_live(as_of, ttl_ms: int):
    """``as_of - failed_at < ttl``.  With a fixed ``as_of`` this is the plain
    comparison ``failed_at > as_of - ttl`` on a literal, which the parquet
    scan can use to skip row groups of a large failure log."""
    if isinstance(as_of, (dt.datetime, str)):
        t = as_of if isinstance(as_of, dt.datetime) else dt.datetime.fromisoformat(as_of)
        return F.col("failed_at") > ntz_literal(t - dt.timedelta(milliseconds=ttl_ms))
    return age_micros("failed_at", as_of) < F.lit(ttl_ms * 1000)


def ignore_prefix(files: DataFrame, prefix: str | None) -> DataFrame:
    """Drop files whose *name* starts with ``prefix``; ``None`` keeps all."""
    if prefix is None:
        return files
    return files.where(~F.col("name").startswith(prefix))


def exclude_manifests(files: DataFrame, suffix: str = ".manifest") -> DataFrame:
    """Bundler pre-check: a path ending in ``.manifest`` is not a data file."""
    return files.where(~F.col("path").endswith(suffix))


def quarantine_state(failures: DataFrame) -> DataFrame:
    """Latest failure per path (a re-failure restarts the interval, so the
    newest ``failed_at`` wins) and how often the path failed.  The ``groupBy``
    is partial-aggregated: a path that fails very often costs one row per map
    task in the shuffle."""
    return failures.groupBy("path").agg(
        F.max("failed_at").alias("failed_at"),
        F.max_by("reason", F.struct("failed_at", "reason")).alias("reason"),
        F.count(F.lit(1)).alias("n_failures"),
    )


def current_quarantine(failures: DataFrame, as_of, ttl_ms: int) -> DataFrame:
    """Paths still inside their retry interval at ``as_of``."""
    return quarantine_state(failures).where(_still_live(as_of, ttl_ms))


def quarantine_filter(files: DataFrame, failures: DataFrame, as_of, ttl_ms: int) -> DataFrame:
    """Skip files that failed within the retry interval (anti join on path).
    Repeated failures of one path are collapsed first (partial aggregate), so
    a path that fails very often does not skew the join."""
    live = failures.where(_still_live(as_of, ttl_ms)).select("path").distinct()
    return files.join(live, "path", "left_anti")


def quarantine_update(failures: DataFrame, new_failures: DataFrame, as_of=None,
                      reason: str | None = None) -> DataFrame:
    """Append failures (path, failed_at, reason) to the failure log.

    ``new_failures`` needs a ``path``; ``failed_at`` defaults to ``as_of`` and
    ``reason`` to the given text.
    """
    add = new_failures
    if "failed_at" not in add.columns:
        add = add.withColumn("failed_at", as_of_col(as_of))
    if "reason" not in add.columns:
        add = add.withColumn("reason", F.lit(reason).cast("string"))
    return failures.select("path", "failed_at", "reason").unionByName(
        add.select("path", "failed_at", "reason"))
