"""Bundling: pair data files with manifests, name bundles, date their folder
and account for every original input from the manifests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from intake.functions.ids import as_of_col, epoch_micros
from intake.functions.paths import loaded_path


def pair_manifests(data: DataFrame, manifests: DataFrame, suffix: str = ".manifest") -> DataFrame:
    """Data files whose ``<path>.manifest`` exists beside them (equi-join on the
    computed manifest path).  Adds ``manifest_path``."""
    m = manifests.select(F.col("path").alias("manifest_path"))
    d = data.withColumn("_want", F.concat(F.col("path"), F.lit(suffix)))
    return d.join(m, d["_want"] == m["manifest_path"], "inner").drop("_want")


def mark_paired(data: DataFrame, manifests: DataFrame, suffix: str = ".manifest") -> DataFrame:
    """All data files with an ``admitted`` flag: has a manifest."""
    m = manifests.select(F.col("path").alias("_mpath")).withColumn("_has", F.lit(True))
    d = data.withColumn("_want", F.concat(F.col("path"), F.lit(suffix)))
    return (d.join(m, d["_want"] == m["_mpath"], "left")
            .withColumn("admitted", F.coalesce(F.col("_has"), F.lit(False)))
            .drop("_want", "_mpath", "_has"))


def unpaired_files(data: DataFrame, manifests: DataFrame, suffix: str = ".manifest") -> DataFrame:
    """Data files without manifest (``no_manifest``) and manifests without
    data (``no_data``, left by a half-done cleanup)."""
    d = data.select("path").withColumn("_want", F.concat(F.col("path"), F.lit(suffix)))
    m = manifests.select(F.col("path").alias("mpath"))
    no_manifest = (d.join(m, d["_want"] == m["mpath"], "left_anti")
                   .select(F.lit("no_manifest").alias("kind"), "path"))
    m2 = manifests.select("path").withColumn(
        "_data", F.expr(f"substring(path, 1, length(path) - {len(suffix)})"))
    no_data = (m2.where(F.col("path").endswith(suffix))
               .join(data.select(F.col("path").alias("dpath")), F.col("_data") == F.col("dpath"), "left_anti")
               .select(F.lit("no_data").alias("kind"), "path"))
    return no_manifest.unionByName(no_data)


def bundle_ids(plan: DataFrame) -> DataFrame:
    """A repeatable id per planned batch from all its members: md5 of feed, batch
    number, member count and two sums over the members' own md5 (path, length,
    mtime).  Sums are free of order and need no gathering, so a batch of any
    size is one partial row per map task; other members give another id, a
    replay the same."""
    own = F.md5(F.concat_ws("#", "path", F.col("length").cast("string"), epoch_micros("mtime").cast("string")))

    def part(at: int):  # 60 bits of a member's md5
        return F.sum(F.conv(F.substring("_own", at, 15), 16, 10).cast("decimal(20,0)")).cast("string")

    ident = plan.withColumn("_own", own).groupBy("feed", "batch_no").agg(
        F.count(F.lit(1)).alias("_n"), part(1).alias("_a"), part(16).alias("_b"))
    return ident.select(
        "feed", "batch_no",
        F.md5(F.concat_ws("#", F.coalesce("feed", F.lit("")), F.col("batch_no").cast("string"),
                          F.col("_n").cast("string"), "_a", "_b")).alias("bundle_id"))


def dated_output(output_dir: str, as_of, date_format: str = "yyyy/MM/dd",
                 dated: bool = True):
    """Folder a bundle is published to: ``output_dir/<as_of formatted>`` or
    flat.  ``as_of`` may be a column (per row) or one timestamp."""
    base = output_dir.rstrip("/")
    if not dated:
        return F.lit(base)
    return F.concat(F.lit(base + "/"), F.date_format(as_of_col(as_of), date_format))


def file_accounting(manifest_lines: DataFrame, inventory: DataFrame | None = None,
                    to_replace: str = "/flagged/", replacement: str = "/loaded/",
                    line_col: str = "value") -> DataFrame:
    """Ledger of original inputs from manifest lines ``work_id<TAB>origin``.

    A line without a second field (or an empty one) is ``malformed`` and the
    rest goes on.  Every good line gets its ``loaded_path`` (every
    ``/flagged/`` replaced).  With an ``inventory`` of the flagged files,
    ``moved`` means the origin is there to move, ``missing`` that it is not.
    """
    parts = F.split(F.col(line_col), "\t", -1)
    lines = manifest_lines.select(
        "*", F.get(parts, 0).alias("work_id"), F.get(parts, 1).alias("origin"))
    good = F.col("origin").isNotNull() & (F.col("origin") != "")
    lines = lines.withColumn("loaded_path", F.when(good, loaded_path("origin", "all", to_replace, replacement)))
    status = F.when(~good, F.lit("malformed"))
    if inventory is not None:
        inv = inventory.select(F.col("path").alias("_inv")).withColumn("_seen", F.lit(True))
        lines = lines.join(inv, lines["origin"] == inv["_inv"], "left")
        status = status.when(F.col("_seen").isNull(), F.lit("missing")).otherwise(F.lit("moved"))
        return lines.withColumn("status", status).drop("_inv", "_seen")
    return lines.withColumn("status", status.otherwise(F.lit("moved")))


# Lifecycle stages, in the order a tie on time is broken.
STAGES = ("landed", "flagged", "quarantined", "dead_letter", "loaded")


def file_ledger(events: DataFrame) -> DataFrame:
    """Where every input is: one row per original ``path`` from stage events
    (``path, stage, at``).  ``status`` is the latest stage (a tie on ``at``
    goes to the later stage in :data:`STAGES`); the first time of each stage
    is kept beside it.  A partial-aggregated ``groupBy``: a path with many
    events costs one row per map task in the shuffle."""
    rank = F.array_position(F.array(*[F.lit(s) for s in STAGES]), F.col("stage"))
    ev = events.select("path", "stage", "at", rank.alias("_rank"))
    firsts = [F.min(F.when(F.col("stage") == s, F.col("at"))).alias(f"{s}_at") for s in STAGES]
    return ev.groupBy("path").agg(
        F.max_by("stage", F.struct("at", "_rank")).alias("status"),
        F.max("at").alias("status_at"),
        F.count(F.lit(1)).alias("n_events"),
        *firsts)
