"""The bundler's members read by tasks, and its loop: bad members, replays, bulk output."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from intake.config import BundlerConfig, ScanConfig
from intake.plans import lifecycle
from intake.schemas import ENTRY_DDL, QUARANTINE_SCHEMA
from intake.sinks import bulk
from intake.sinks.bundles import bundled_files, read_bundles
from intake.sinks.framed import write_framed
from intake.sources.inventory import landing_inventory
from intake.sources.members import Members
from intake.sources.typed import TypeSpec
from intake.streaming import bundler as loop

LATE = dt.datetime(2100, 1, 1)
FRAMED = Members(TypeSpec("framed", ENTRY_DDL))


def land(spark, root, n, bad=(), rows=3, first=0):
    """``n`` framed files of ``rows`` entries each with their manifests; ``bad`` ones cut off."""
    entries = spark.range(first * rows, (first + n) * rows).select(
        F.lit("t").alias("table_name"), F.col("id").cast("string").alias("row_key"), F.lit("f").alias("family"), F.lit("q").alias("qualifier"),
        F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("ts"), F.lit("v").alias("value"),
        F.concat(F.lit("m"), F.floor(F.col("id") / rows).cast("string")).alias("file"))
    write_framed(entries.repartition(2, "file"), str(root), file_by="file")
    for i in range(first, first + n):
        (root / f"m{i}.frm.manifest").write_text(f"w{i}\t/in/flagged/{i}.csv\n")
        if i in bad:
            whole = (root / f"m{i}.frm").read_bytes()
            (root / f"m{i}.frm").write_bytes(whole[:-9])


def keys(df):
    return sorted(int(r["row_key"]) for r in df.select("row_key").collect())


def no_failures(spark):
    return spark.createDataFrame([], QUARANTINE_SCHEMA)


@pytest.mark.parametrize("max_files,reads", [(-1, 1), (4, None)])
def test_many_bad_members_cost_one_read(spark, tmp_path, monkeypatch, max_files, reads):
    root, bad = tmp_path / "work", set(range(0, 24, 3))
    root.mkdir()
    land(spark, root, 24, bad)
    asked, real = [], lifecycle.read_by_tasks

    def counted(spark, members, how):
        asked.extend(r["path"] for r in members.collect())
        asked.append(None)
        return real(spark, members, how)

    monkeypatch.setattr(lifecycle, "read_by_tasks", counted)
    members, failures = lifecycle.bundle_files(spark, landing_inventory(spark, str(root), feed="p"), no_failures(spark),
                                               ScanConfig(max_files=max_files, max_age=0), LATE, str(tmp_path / "b"), FRAMED)
    good = [i for i in range(24) if i not in bad]
    assert sorted(r["path"].rsplit("/m", 1)[1] for r in members.collect()) == sorted(f"{i}.frm" for i in good)
    assert sorted(r["path"].rsplit("/m", 1)[1] for r in failures.collect()) == sorted(f"{i}.frm" for i in bad)
    assert all("cut off" in r["reason"] for r in failures.collect())
    back = spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "b"))
    assert keys(back) == [3 * i + k for i in good for k in range(3)]
    files = [p for p in asked if p]
    assert len(files) == len(set(files)) == 24            # every member once
    assert reads is None or asked.count(None) == reads


def test_nothing_to_bundle(spark, tmp_path):
    root = tmp_path / "work"
    root.mkdir()
    (root / "lonely.frm").write_bytes(b"x")
    members, failures = lifecycle.bundle_files(spark, landing_inventory(spark, str(root), feed="p"), no_failures(spark),
                                               ScanConfig(max_age=0), LATE, str(tmp_path / "b"), FRAMED)
    assert members.count() == failures.count() == 0
    (root / "lonely.frm.manifest").write_text("w\t/in/flagged/x\n")
    members, failures = lifecycle.bundle_files(spark, landing_inventory(spark, str(root), feed="p"), no_failures(spark),
                                               ScanConfig(max_age=0, error_retry_interval=0), LATE, str(tmp_path / "b"), FRAMED)
    assert members.count() == 0 and failures.count() == 1  # the only member is bad, also where no time is left in quarantine


def test_a_tick_that_broke_off_replaces_what_it_wrote(spark, tmp_path, monkeypatch):
    root, state = tmp_path / "work", str(tmp_path / "state")
    root.mkdir()
    land(spark, root, 5, bad={1})
    scan, bundler = ScanConfig(max_files=2, max_age=0, error_retry_interval=10 ** 9), BundlerConfig(str(tmp_path / "b"))
    monkeypatch.setattr(loop, "tick_time", lambda *a: LATE)

    def tick(n):
        loop.bundler_tick(spark, n, state, scan, bundler, lambda: landing_inventory(spark, str(root), feed="p"), lambda: FRAMED)

    def broken(*a):
        raise RuntimeError("lost here")

    with monkeypatch.context() as m:          # bundles and ledger are written, the tick's end is not
        m.setattr(loop, "current_quarantine", broken)
        with pytest.raises(RuntimeError):
            tick(0)
    assert bundled_files(spark, state).count() == 4
    land(spark, root, 2, first=5)             # what came since belongs to the tick run anew
    for n in (0, 0, 1):
        tick(n)
    good = [0, 2, 3, 4, 5, 6]
    assert keys(read_bundles(spark, str(tmp_path / "b"), state)) == [3 * i + k for i in good for k in range(3)]
    accounting = spark.read.schema(loop.ACCOUNTING).parquet(f"{state}/accounting").collect()
    assert sorted((r["work_id"], r["loaded_path"], r["status"]) for r in accounting) == [
        (f"w{i}", f"/in/loaded/{i}.csv", "moved") for i in good]
    for n in (0, 1):
        held = spark.read.parquet(f"{state}/quarantine/tick={n}").collect()
        assert [r["path"].rsplit("/", 1)[1] for r in held] == ["m1.frm"]
    land(spark, root, 1, first=1)             # mended: another file under the old name, still in quarantine by path
    tick(2)
    assert len(keys(read_bundles(spark, str(tmp_path / "b"), state))) == 18


def test_units_of_bulk_output_are_read_by_tasks(spark, tmp_path):
    out = str(tmp_path / "out")
    entries = spark.range(60).select(
        F.lit("t").alias("table_name"), F.col("id").cast("string").alias("row_key"), F.lit("f").alias("family"), F.lit("q").alias("qualifier"),
        F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("ts"), F.lit(None).cast("string").alias("value"),
        F.concat(F.lit("w"), (F.col("id") % 7).cast("string")).alias("work_id"))
    items = entries.select("work_id").distinct().withColumn("source_path", F.concat(F.lit("/in/flagged/"), "work_id"))
    bulk.write_bulk(entries, items, out, "1", buckets=4)
    state, bundler = str(tmp_path / "state"), BundlerConfig(str(tmp_path / "b"))
    for day, fresh in ((0, 7), (1, 0)):
        got = lifecycle.bundler_run(spark, bulk.bulk_units(spark, out, "bulk"), no_failures(spark), ScanConfig(max_age=0), bundler,
                                    LATE + dt.timedelta(days=day), bulk.unit_members(spark, out), state_dir=state)
        assert sorted(r["work_id"] for r in got["accounting"].collect()) == [f"w{i}" for i in range(7)][:fresh]
        assert got["failures"].count() == 0
    assert keys(read_bundles(spark, str(tmp_path / "b"), state)) == list(range(60))
