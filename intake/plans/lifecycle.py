"""The reference's three entry points as Spark jobs built from the operators.

* :func:`feeder_tick` — scan a landing inventory: filters, thresholds,
  trigger, work items of the feeds that fire;
* :func:`ingest_items` — parse work items, read them by data type, shred,
  dedupe, aggregate, then bulk output + manifests or live upserts, and the
  outcome rows for the attempt ledger;
* :func:`bundle_files` — cut paired files into batches, compact each fired
  batch into a bundle; a member that cannot be read is quarantined and the
  batches are planned again without it (the reference fails the whole batch
  and retries later); :func:`bundler_run` adds the dated output folder and
  the accounting of the members' manifests.

Driver-side control flow only: every data step is a DataFrame job.
"""

from __future__ import annotations

import re
from urllib.parse import unquote
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from intake.config import BundlerConfig, FeederConfig, IngestConfig, ScanConfig
from intake.functions.ids import as_of_col
from intake.functions.paths import loaded_path, path_key, source_file_path
from intake.operators.batching import batch_plan, threshold_batch, threshold_trigger
from intake.operators.bundle import file_accounting, mark_paired
from intake.operators.combine import combine_entries
from intake.operators.metrics import item_metrics
from intake.operators.joins import broadcast_if_small
from intake.operators.filters import exclude_manifests, ignore_prefix, quarantine_filter, quarantine_update
from intake.operators.work import flagged_collisions, parse_work_items, work_items
from intake.operators.shred import metadata_updates
from intake.schemas import ENTRY_COLUMNS, ENTRY_SCHEMA
from intake.session import checkpoint_dir, scratch_dir
from intake.sinks.bulk import write_bulk
from intake.sinks.bundles import bundle_folder, bundled_files, compact_bundles, record_bundled
from intake.sinks.live import upsert_live
from intake.sources.inventory import _norm_uri
from intake.sources.formats import FORMATS
from intake.sources.groups import REJECT, file_stats, rejected_files, whole_files
from intake.sources.members import Members, read_manifest_lines
from intake.sources.members import read_members as read_by_tasks
from intake.sources.typed import SPARK_FORMATS, TypeSpec, read_typed_feed


Hook = Callable[[DataFrame], DataFrame]
SHRED_RECORDS = 250_000         # about as many records a task maps to entries and combines


def scan_filters(inventory: DataFrame, failures: DataFrame, scan: ScanConfig, as_of,
                 pre_check: Hook | None = None, admit: Hook | None = None) -> DataFrame:
    """What reaches the threshold loop, in the reference's order: quarantine,
    ignored prefix, pre-check hook; then the admit hook adds ``admitted``
    (default: every file).  Hooks are ``DataFrame -> DataFrame`` functions."""
    files = quarantine_filter(inventory, failures, as_of, scan.retry_ms)
    files = ignore_prefix(files, scan.ignore_prefix)
    if pre_check is not None:
        files = pre_check(files)
    return admit(files) if admit is not None else files.withColumn("admitted", F.lit(True))


def feeder_tick(inventory: DataFrame, failures: DataFrame, scan: ScanConfig, feeder: FeederConfig,
                as_of, pre_check: Hook | None = None, admit: Hook | None = None,
                limits: DataFrame | None = None) -> dict[str, DataFrame]:
    """One scan of every feed in ``inventory`` (``feed, path, name, length,
    mtime``), with per-feed ``limits`` if given.  Returns the scan flags, the
    trigger per feed, the work items of the feeds that fire and any
    flagged-path collisions."""
    files = scan_filters(inventory, failures, scan, as_of, pre_check, admit)
    scanned = threshold_batch(files, scan, as_of, limits=limits)
    trigger = threshold_trigger(scanned, scan, limits)
    fired = trigger.where("fired").select("feed")
    # null-safe: files without a feed are one feed
    taken = scanned.where("taken").join(fired, scanned["feed"].eqNullSafe(fired["feed"]), "left_semi")
    items = work_items(taken, feeder.target_dir, feeder.input_format, feeder.data_type,
                       scan.input_dir, feeder.preserve_path)
    return {"scan": scanned, "trigger": trigger, "items": items, "collisions": flagged_collisions(items)}


@dataclass(frozen=True)
class DataType:
    """How one data type is read and mapped to entries."""
    spec: TypeSpec
    # records (+ work_id) -> entries (+ work_id; + record_id, if counters tell events apart by it)
    shred: Callable[[DataFrame], DataFrame]
    sum_tables: tuple[str, ...] = ()


def ingest_items(spark: SparkSession, messages: DataFrame, inventory: DataFrame,
                 types: Mapping[str, DataType], as_of, mode: str | IngestConfig = "bulk",
                 out_dir: str | None = None, batch_id: str = "0", run_id: str = "run",
                 moved: DataFrame | None = None) -> dict[str, DataFrame]:
    """Work messages (``message, work_id``) -> entries -> sink.

    Messages may name flagged targets: ``moved`` (the feeder's items:
    ``target_path, path, length``) says where those files are.  Inputs fail one
    by one: a bad message, an unreadable format, a data type without reader, a
    missing or a corrupt file gives a ``failed`` outcome and the others go on.  Formats
    that tasks read themselves (csv, json, text, parquet and those of
    ``intake.sources.formats``) are read once into a staging table, bad files and all; other
    formats (and stores that only Spark reads) are read again without the bad file.

    Bulk: entries and manifests under ``out_dir`` for batch ``batch_id``.
    Live: upserts into the live tables under ``out_dir`` and each input's
    loaded path (first ``/flagged/`` replaced).  ``mode`` may be an
    :class:`IngestConfig` (its ``live_ingest`` flag and ``output_dir``).
    Returns the parsed items, the outcome rows (``work_id, at, status,
    reason``), the metrics (one row per item, see :func:`intake.operators.metrics.item_metrics`; messages may
    have an ``attempt``), the metadata entries of what was written and, for live, the moves."""
    if isinstance(mode, IngestConfig):
        out_dir = out_dir or mode.output_dir
        mode = "live" if mode.live_ingest else "bulk"
    if mode not in ("bulk", "live"):
        raise ValueError(f"mode must be 'bulk' or 'live', got {mode!r}")
    files = inventory.select("path", "length", F.col("path").alias("read_path"))
    if moved is not None:
        files = files.unionByName(moved.select(F.col("target_path").alias("path"), "length",
                                               F.col("path").alias("read_path"))).dropDuplicates(["path"])
    parsed = parse_work_items(messages, files, sorted({*SPARK_FORMATS, *FORMATS}))
    known = F.col("data_type").isin(list(types))
    parsed = parsed.withColumn("status", F.when((F.col("status") == "ok") & ~known, "unknown_type").otherwise(F.col("status")))
    checkpoint_dir(spark)
    parsed = parsed.checkpoint()
    out: dict[str, DataFrame] = {}
    while True:
        ok = parsed.where(F.col("status") == "ok")
        try:
            entries, rejected, read = _entries_of(spark, ok, types)
            if rejected is not None:
                bad = broadcast_if_small(rejected.select(path_key("source_path").alias("_bad")).distinct())
                parsed = parsed.join(bad, path_key("read_path") == F.col("_bad"), "left").withColumn(
                    "status", F.when((F.col("status") == "ok") & F.col("_bad").isNotNull(), "unreadable")
                    .otherwise(F.col("status"))).drop("_bad").checkpoint()
                ok = parsed.where(F.col("status") == "ok")
            if mode == "bulk":
                write_bulk(entries, ok.select("work_id", F.col("path").alias("source_path")), out_dir, batch_id)
            else:
                upsert_live(entries.drop("work_id"), out_dir, run_id, int(batch_id))
                out["moves"] = ok.select("work_id", "path", loaded_path("path", "first").alias("loaded_path"))
            break
        except Exception as e:  # noqa: BLE001 - Spark wraps the reader's exception
            bad = failed_member(e)
            if bad is None or ok.where(path_key("read_path") == path_key(F.lit(bad))).isEmpty():
                raise
            # one corrupt file fails its own items; every round takes one file out
            hit = (F.col("status") == "ok") & (path_key("read_path") == path_key(F.lit(bad)))
            parsed = parsed.withColumn("status", F.when(hit, "unreadable").otherwise(F.col("status"))).checkpoint()
    out["parsed"] = parsed
    out["metrics"] = item_metrics(parsed, read)
    out["metadata"] = metadata_updates(entries)
    good = F.col("status") == "ok"
    out["outcomes"] = parsed.select(
        "work_id", as_of_col(as_of).alias("at"), F.when(good, F.lit("ok")).otherwise(F.lit("failed")).alias("status"),
        F.when(~good, F.col("status")).alias("reason"))
    return out


def _entries_of(spark: SparkSession, ok: DataFrame, types: Mapping[str, DataType]) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """Entries of the good items, read and shredded type by type (types may give one column
    name different kinds), (source_path, reason) of the files that could not be read and the files' statistics."""
    entries = spark.createDataFrame([], T.StructType([*ENTRY_SCHEMA.fields, T.StructField("work_id", T.StringType())]))
    rejected = read = None
    for dt, t in types.items():
        mine = ok.where(F.col("data_type") == dt)
        if mine.isEmpty():
            continue
        items = mine.select(F.col("read_path").alias("path"), "length", "data_type", "format")
        records = read_typed_feed(spark, items, {dt: t.spec}, guarded=True, stats=True)
        # read once: whether a file is whole is known at its end, and the entries are used more than once
        staging = scratch_dir(spark, "staging")
        records.write.parquet(staging)
        records = spark.read.schema(records.schema).parquet(staging)
        bad = rejected_files(records)
        rejected = bad if rejected is None else rejected.unionByName(bad)
        times = file_stats(records)
        read = times if read is None else read.unionByName(times)
        lookup = broadcast_if_small(mine.select(path_key("read_path").alias("_key"), "work_id"))
        whole = whole_files(_dealt(records))
        part = t.shred(whole.withColumn("_key", path_key("source_path")).join(lookup, "_key").drop("_key"))
        record = [c for c in ("record_id",) if c in part.columns]
        part = combine_entries(part, t.sum_tables, ["work_id"], record)
        entries = entries.unionByName(part.select(*ENTRY_COLUMNS, "work_id"))
    return entries, rejected, read


def _dealt(records: DataFrame) -> DataFrame:
    """The staged records dealt over tasks by their place: a task of the reader stages a whole file or group, and
    combining sorts a task's entries, which are several a record."""
    pieces = -(-records.count() // SHRED_RECORDS)
    if pieces < 2:
        return records
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    return records.withColumn("_place", place).repartition(pieces, "_place").drop("_place")


_FAILED_FILE = re.compile(r"(?:reading file|Could not read footer for file[: ]*|FileStatus\{path=)\s*(\S+?)[.;]?(?:\s|$)")


def failed_member(error: BaseException) -> str | None:
    """The file a failed Spark read names in its error, if any."""
    m = _FAILED_FILE.search(str(error))
    return _norm_uri(unquote(m.group(1))) if m else None


def bundle_files(spark: SparkSession, inventory: DataFrame, failures: DataFrame, scan: ScanConfig,
                 as_of, folder: str, read_members: Callable[[list[str]], DataFrame] | Members,
                 tick: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Bundle the paired data files of ``inventory`` (data + ``.manifest``).

    ``read_members`` is a :class:`Members` (tasks read every member once, bad ones
    are told in that run and no path reaches the driver) or a function of paths
    that reads member files into entries with a ``source_path`` column (a run per
    bad member).  Returns (members written, failure log).
    """
    manifests = inventory.where(F.col("path").endswith(".manifest"))
    if isinstance(read_members, Members):
        return _bundle_whole(spark, inventory, manifests, failures, scan, as_of, folder, read_members, tick)
    while True:  # every round but the last quarantines one more file
        files = scan_filters(inventory, failures, scan, as_of, pre_check=exclude_manifests,
                             admit=lambda df: mark_paired(df, manifests))
        plan = batch_plan(files, scan, as_of).cache()
        paths = [r["path"] for r in plan.where("fired").select("path").collect()]
        if not paths:
            return plan.limit(0).withColumn("bundle_id", F.lit(None).cast("string")), failures
        try:
            members = compact_bundles(read_members(paths), plan, folder, tick=tick)
            return members, failures
        except Exception as e:  # noqa: BLE001 - Spark wraps the reader's IOException
            bad = failed_member(e)
            if bad is None or bad not in paths:
                raise
            new = spark.createDataFrame([(bad,)], "path string")
            failures = quarantine_update(failures, new, as_of, reason=f"unreadable bundle member: {type(e).__name__}")
        finally:
            plan.unpersist()


def _bundle_whole(spark: SparkSession, inventory: DataFrame, manifests: DataFrame, failures: DataFrame, scan: ScanConfig,
                  as_of, folder: str, how: Members, tick: str | None) -> tuple[DataFrame, DataFrame]:
    """Members are read into a staging table; batches are planned again without the bad ones, and what the
    new plan has beside the old one is read too, until it has nothing unread."""
    checkpoint_dir(spark)
    staging = scratch_dir(spark, "members")
    read = bad = spark.createDataFrame([], "path string")
    rounds: list[DataFrame] = []
    while True:
        files = scan_filters(inventory.join(bad, "path", "left_anti"), failures, scan, as_of, pre_check=exclude_manifests,
                             admit=lambda df: mark_paired(df, manifests))
        plan = batch_plan(files, scan, as_of).checkpoint()
        fresh = plan.where("fired").select("path", "length").join(read, "path", "left_anti").checkpoint()
        if fresh.isEmpty():
            break
        where = f"{staging}/round={len(rounds)}"
        records = read_by_tasks(spark, fresh, how)
        records.write.parquet(where)
        rounds.append(spark.read.schema(records.schema).parquet(where))
        failed = rejected_files(rounds[-1]).select(F.col("source_path").alias("path"), F.concat(
            F.lit("unreadable bundle member: "), "reason").alias("reason")).checkpoint()
        if failed.isEmpty():
            break
        read = read.unionByName(fresh.select("path")).checkpoint()
        bad = bad.unionByName(failed.select("path")).checkpoint()
        failures = quarantine_update(failures, failed, as_of)
    if not rounds or plan.where("fired").isEmpty():
        return plan.limit(0).withColumn("bundle_id", F.lit(None).cast("string")), failures
    entries = rounds[0]
    for more in rounds[1:]:
        entries = entries.unionByName(more)
    return compact_bundles(entries.where(F.col(REJECT).isNull()).drop(REJECT), plan, folder, tick=tick), failures


def bundler_run(spark: SparkSession, inventory: DataFrame, failures: DataFrame, scan: ScanConfig,
                bundler: BundlerConfig, as_of, read_members: Callable[[list[str]], DataFrame] | Members,
                flagged: DataFrame | None = None, state_dir: str | None = None,
                read_lines: Callable[[list[str]], DataFrame] | None = None,
                tick: str | None = None) -> dict[str, DataFrame | str]:
    """One bundler tick: bundles under ``bundle_output_dir[/as_of date]``,
    then the accounting ledger of the bundled members' manifests (origin,
    loaded path, ``moved`` / ``missing`` against ``flagged`` / ``malformed``).

    With a ``state_dir`` the bundler remembers its members: files (path, length,
    mtime) of earlier ticks are not bundled again, and
    :func:`intake.sinks.bundles.read_bundles` reads what its ledger holds.  ``tick``
    names the run (default: its time); a run under the name of one before replaces it.
    With :class:`Members` a manifest that cannot be read joins the failures.
    ``read_lines(manifest paths)`` reads manifest lines (default: text files); for
    bulk output use :func:`intake.sinks.bulk.bulk_units` as ``inventory`` with
    ``read_units`` and ``read_unit_manifests``."""
    stamp, time_name = spark.range(1).select(F.date_format(as_of_col(as_of), bundler.date_format),
                                        F.date_format(as_of_col(as_of), "yyyyMMdd-HHmmssSSSSSS")).first()
    tick = tick or time_name
    folder = bundle_folder(bundler.bundle_output_dir, stamp, bundler.date_bundle_output)
    if state_dir:
        checkpoint_dir(spark)
        identity = ["path", "length", "mtime"]
        others = bundled_files(spark, state_dir).where(F.col("tick") != tick).select(*identity)
        inventory = inventory.join(others, identity, "left_anti").checkpoint()
    members, failures = bundle_files(spark, inventory, failures, scan, as_of, folder, read_members, tick if state_dir else None)
    if isinstance(read_members, Members):
        lines = None if members.isEmpty() else read_manifest_lines(spark, members, inventory, read_members).checkpoint()
        if lines is not None:
            bad = lines.where(F.col(REJECT).isNotNull()).select(
                F.col("manifest_file").alias("path"), F.concat(F.lit("unreadable manifest: "), REJECT).alias("reason"))
            failures, lines = quarantine_update(failures, bad, as_of), lines.where(F.col(REJECT).isNull()).drop(REJECT)
    else:
        manifest_paths = [r["m"] for r in members.select(F.concat("path", F.lit(".manifest")).alias("m")).collect()]
        lines = None
        if manifest_paths:
            lines = read_lines(manifest_paths) if read_lines else spark.read.text(manifest_paths).select(
                "value", source_file_path().alias("manifest_file"))
    if lines is not None:
        accounting = file_accounting(lines, flagged, bundler.manifest_path_to_replace,
                                     bundler.manifest_path_replacement)
        if state_dir:
            record_bundled(members, state_dir, tick)
    else:
        accounting = spark.createDataFrame([], "value string, manifest_file string, work_id string, "
                                               "origin string, loaded_path string, status string")
    return {"folder": folder, "members": members, "failures": failures, "accounting": accounting}
