"""File tests: bulk write + manifests, live upserts with replay, bundles,
accounting and a restarted stream."""

import datetime as dt
import glob
import os
import re
import time

import pytest
from pyspark.sql import functions as F

from intake.config import ScanConfig
from intake.operators.batching import batch_plan
from intake.operators.bundle import dated_output, file_accounting
from intake.operators.combine import aggregate_entries, combine_entries, dedupe_entries, sort_entries, table_counters
from intake.operators.shred import metadata_updates, shred_entries
from intake.sinks.bulk import bulk_units, read_manifests, read_work_item, write_bulk
from intake.sinks.bundles import bundle_folder, compact_bundles
from intake.sinks.live import compact_live, live_current, run_id_for, upsert_live
from intake.sources.entries import read_entries
from intake.streaming.feed import ingest_stream, stream_feed

T0 = dt.datetime(2024, 1, 1)


def records(spark, n=40):
    rows = [(i, T0 + dt.timedelta(minutes=i), f"u{i % 4}", ["click", "view"][i % 2], float(i), f"/in/u{i % 4}.csv")
            for i in range(n)]
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz, user string, kind string, amount double, source_path string")
    return df.withColumn("work_id", F.md5("source_path"))


def shred(df):
    return shred_entries(df, "events", F.col("id"), {"kind": F.col("kind"), "amount": F.col("amount").cast("decimal(18,2)")},
                         F.col("ts"), index_fields=["kind"], carry=["work_id"])


def test_shred_and_chain(spark):
    e = shred(records(spark))
    assert e.count() == 40 * 3
    again = e.unionByName(e.limit(10))
    assert dedupe_entries(again).count() == 120
    agg = aggregate_entries(e.withColumn("row_key", F.lit("r")), sum_tables=["event"])
    assert agg.count() > 0
    counts = {r["table_name"]: r["n_entries"] for r in table_counters(e).collect()}
    assert counts == {"event": 80, "index": 40}
    meta = {r["qualifier"]: r["value"] for r in metadata_updates(e).collect()}
    assert meta == {"kind": "40", "amount": "40"}


def test_shred_reads_all_columns_for_null_keys_only(spark, tmp_path):
    records(spark).drop("work_id").write.parquet(str(tmp_path / "r"))
    df = spark.read.parquet(str(tmp_path / "r"))
    e = shred_entries(df, "d", F.col("id"), {"kind": F.col("kind")}, F.col("ts"))
    plan = e._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"FileScan parquet.*", plan)
    schemas = sorted(re.search(r"ReadSchema: struct<(.*?)>", s)[1].split(",") for s in scans)
    assert [sorted(c.split(":")[0] for c in s) for s in schemas if len(s) <= 3] == [["id", "kind", "ts"]]
    assert len(scans) == 2 and any("IsNull(id)" in s for s in scans)


def test_aggregate_has_partial_and_final(spark):
    agg = aggregate_entries(shred(records(spark)), sum_tables=["event"])
    plan = agg._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") + plan.count("SortAggregate") + plan.count("ObjectHashAggregate") >= 2


def test_sort_entries_orders_each_range(spark):
    e = sort_entries(shred(records(spark)), partitions=3)
    parts = e.rdd.glom().map(lambda rows: [(r.table_name, r.row_key, r.family, r.qualifier) for r in rows]).collect()
    flat = [k for p in parts for k in p]
    assert flat == sorted(flat)


def test_sort_entries_splits_a_hot_row(spark):
    hot = shred(records(spark, 400)).withColumn("row_key", F.lit("hot"))
    sizes = sort_entries(hot, partitions=4).rdd.glom().map(len).collect()
    assert max(sizes) < sum(sizes)


def test_bulk_write_replay_and_manifest(spark, tmp_path):
    rec = records(spark)
    entries = shred(rec)
    items = rec.select("work_id", "source_path").distinct()
    out = str(tmp_path / "bulk")
    paths = write_bulk(entries, items, out)
    write_bulk(entries, items, out)  # redelivery: same ids, same result
    back = read_entries(spark, paths["data"])
    assert back.count() == 120
    assert back.select("work_id").distinct().count() == 4
    lines = read_manifests(spark, paths["manifests"]).collect()
    assert len(lines) == 4 and all("\t/in/u" in r["value"] for r in lines)
    # one folder per (batch, bucket), not per work item
    assert 1 <= len(glob.glob(os.path.join(paths["data"], "batch_id=0", "bucket=*"))) <= 4
    # a second batch leaves the first alone; replaying it changes nothing
    write_bulk(entries, items, out, batch_id="1")
    write_bulk(entries, items, out, batch_id="1")
    assert read_entries(spark, paths["data"]).count() == 240
    wid = rec.select("work_id").first()[0]
    one = read_work_item(spark, paths["data"], "1", wid)
    assert one.count() == 30
    assert "PartitionFilters" in one._jdf.queryExecution().executedPlan().toString()


def test_bulk_replay_leaves_nothing_of_inputs_that_are_gone(spark, tmp_path):
    rec = records(spark)
    entries, items = shred(rec), rec.select("work_id", "source_path").distinct()
    out = str(tmp_path / "bulk")
    paths = write_bulk(entries, items, out, batch_id="a:1")
    gone = rec.first()["work_id"]
    write_bulk(entries.where(F.col("work_id") != gone), items.where(F.col("work_id") != gone), out, batch_id="a:1")
    assert read_entries(spark, paths["data"]).where(F.col("work_id") == gone).isEmpty()
    assert read_entries(spark, paths["data"]).count() == 90
    assert read_manifests(spark, paths["manifests"]).count() == 3
    units = [r["path"] for r in bulk_units(spark, out).collect()]
    data = {u for u in units if not u.endswith(".manifest")}
    assert data and {u[:-len(".manifest")] for u in units if u.endswith(".manifest")} == data


def test_counters_tell_events_apart_by_record(spark):
    rows = [("r1", "c", "k", "f", "q", T0, "1"), ("r2", "c", "k", "f", "q", T0, "1"), ("r2", "c", "k", "f", "q", T0, "1"),
            ("r1", "n", "k", "f", "q", T0, "a"), ("r2", "n", "k", "f", "q", T0 + dt.timedelta(1), "b"), ("r3", "c", "z", "f", "q", T0, None)]
    e = spark.createDataFrame(rows, "record_id string, " + COUNTERS)
    got = {(r["table_name"], r["row_key"]): (r["value"], r["n_rejected"]) for r in combine_entries(e, ["c"], record=["record_id"]).collect()}
    assert got == {("c", "k"): ("2", 0), ("n", "k"): ("b", 0), ("c", "z"): ("0", 1)}
    assert {r["value"] for r in combine_entries(e.where("table_name = 'n'")).collect()} == {"b"}


def test_live_upsert_replay_and_newest(spark, tmp_path):
    e = shred(records(spark)).drop("work_id")
    tdir = str(tmp_path / "live")
    upsert_live(e, tdir, "run1", 0)
    upsert_live(e, tdir, "run1", 0)  # replay of batch 0 changes nothing
    cur = live_current(spark, tdir)
    assert cur.count() == 120 and cur.where("n_versions > 1").count() == 0
    newer = e.where(F.col("qualifier") == "amount").withColumn("value", F.lit("9.99")) \
             .withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 SECOND"))
    upsert_live(newer, tdir, "run1", 1)
    cur = live_current(spark, tdir)
    assert cur.where((F.col("qualifier") == "amount") & (F.col("value") != "9.99")).count() == 0
    assert cur.count() == 120


def test_run_id_is_kept(spark, tmp_path):
    ck = str(tmp_path / "ck")
    assert run_id_for(spark, ck) == run_id_for(spark, ck)


def test_bundles_and_accounting(spark, tmp_path):
    files = spark.createDataFrame(
        [(f"feed{i % 2}", f"/data/flagged/in/{i}.seq", 10 + i, T0 + dt.timedelta(seconds=i), True) for i in range(12)],
        "feed string, path string, length long, mtime timestamp_ntz, admitted boolean")
    plan = batch_plan(files, ScanConfig(max_files=2, max_size=1000), T0)
    entries = spark.createDataFrame(
        [(f"/data/flagged/in/{i}.seq", "t", f"r{i}-{k}", "f", "q", T0, str(k)) for i in range(12) for k in range(3)],
        "source_path string, table_name string, row_key string, family string, qualifier string, ts timestamp_ntz, value string")
    folder = bundle_folder(str(tmp_path / "bundles"), "2024/01/01")
    members = compact_bundles(entries, plan, folder)
    first = sorted(glob.glob(os.path.join(folder, "tick=*", "bucket=*")))
    assert members.select("bundle_id").distinct().count() == 6 and members.count() == 12
    assert len({f.split("/bucket=")[0] for f in first}) == 1
    compact_bundles(entries, plan, folder)  # replay: same bundle ids, same folder
    assert sorted(glob.glob(os.path.join(folder, "tick=*", "bucket=*"))) == first
    back = read_entries(spark, folder, "source_path string, bundle_id string")
    assert back.count() == 36
    lines = spark.createDataFrame([(f"w{i}\t/data/flagged/in/{i}.seq",) for i in range(3)] + [("no tab here",)], "value string")
    inv = files.select("path").where(F.col("path") != "/data/flagged/in/2.seq")
    acc = {r["value"]: (r["status"], r["loaded_path"]) for r in file_accounting(lines, inv).collect()}
    assert acc["w0\t/data/flagged/in/0.seq"] == ("moved", "/data/loaded/in/0.seq")
    assert acc["w2\t/data/flagged/in/2.seq"][0] == "missing"
    assert acc["no tab here"] == ("malformed", None)


def test_dated_output(spark):
    df = spark.createDataFrame([(T0,)], "ts timestamp_ntz")
    row = df.select(dated_output("/out/", F.col("ts")).alias("d"),
                    dated_output("/out", T0, dated=False).alias("f")).collect()[0]
    assert row["d"] == "/out/2024/01/01" and row["f"] == "/out"


def test_stream_restart_and_live_ingest(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    (src / "a.csv").write_text("1,click\n2,view\n")
    schema = "id long, kind string"
    seen = []

    def handler(df, batch_id):
        seen.append((batch_id, sorted(r["id"] for r in df.collect())))

    ck = str(tmp_path / "ck")
    q = stream_feed(spark, str(src), "csv", schema, handler, ck, available_now=True, max_files=1)
    q.awaitTermination()
    from intake.operators.metrics import stream_progress
    prog = stream_progress(spark, q).where("n_input_rows > 0").collect()
    assert [(r["batch_id"], r["n_input_rows"]) for r in prog] == [(0, 2)] and prog[0]["trigger_ms"] >= 0
    (src / "b.csv").write_text("3,click\n")
    q = stream_feed(spark, str(src), "csv", schema, handler, ck, available_now=True, max_files=1)
    q.awaitTermination()
    assert [ids for _b, ids in seen] == [[1, 2], [3]]
    assert [b for b, _ in seen] == [0, 1]

    tdir = str(tmp_path / "tables")

    def to_entries(df):
        return shred_entries(df.withColumn("ts", F.lit(T0).cast("timestamp_ntz")), "csv", F.col("id"),
                             {"kind": F.col("kind")}, F.col("ts"))

    q = ingest_stream(spark, str(src), "csv", schema, str(tmp_path / "ck2"), tdir, to_entries, available_now=True)
    q.awaitTermination()
    assert live_current(spark, tdir).count() == 3


def test_every_progress_report_is_kept(spark, tmp_path):
    from intake.operators.metrics import ProgressLog, progress_log
    src = tmp_path / "src"
    src.mkdir()
    for k in range(3):
        (src / f"{k}.csv").write_text("1,a\n" * (k + 1))
    log = ProgressLog(str(tmp_path / "log"))
    spark.streams.addListener(log)
    try:
        for _ in range(2):          # two runs of one stream
            stream_feed(spark, str(src), "csv", "id long, kind string", lambda df, b: df.count(), str(tmp_path / "ck"),
                        available_now=True, max_files=1, query_name="feed").awaitTermination()
            (src / f"late{_}.csv").write_text("1,a\n" * 9)
        deadline = time.time() + 30
        while time.time() < deadline and len(glob.glob(str(tmp_path / "log/*/*/*.json"))) < 4:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(log)
    rows = progress_log(spark, str(tmp_path / "log")).where("n_input_rows > 0").collect()
    assert sorted(r["n_input_rows"] for r in rows) == [1, 2, 3, 9] and {r["name"] for r in rows} == {"feed"}
    assert len({r["query_id"] for r in rows}) == 1 and len({r["run_id"] for r in rows}) == 2
    assert all(r["trigger_ms"] > 0 and r["started"] for r in rows)


def test_live_counters_of_a_stream_count_equal_events(spark, tmp_path):
    """Two events of one type, time and value count twice, one delivered twice in a micro-batch once."""
    src = tmp_path / "src"
    src.mkdir()
    (src / "a.csv").write_text("1,click\n2,click\n3,view\n3,view\n")

    def to_entries(df):
        return df.select(F.lit("n").alias("table_name"), F.col("kind").alias("row_key"), F.lit("f").alias("family"), F.lit("q").alias("qualifier"),
                         F.lit(T0).cast("timestamp_ntz").alias("ts"), F.lit("1").alias("value"), "id")

    args = (spark, str(src), "csv", "id long, kind string", str(tmp_path / "ck"), str(tmp_path / "t"), to_entries)
    with pytest.raises(ValueError):
        ingest_stream(*args, sum_tables=["n"])
    ingest_stream(*args, sum_tables=["n"], record=["id"], available_now=True).awaitTermination()
    assert {r["row_key"]: r["value"] for r in live_current(spark, str(tmp_path / "t"), ["n"]).collect()} == {"click": "2", "view": "1"}


def test_hot_work_item_is_split_over_files(spark, tmp_path):
    """A work item holding most entries: AQE's rebalance splits its bucket
    over several tasks (several files) instead of one long task."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    try:
        n = 6000
        df = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit("cold")).otherwise(F.lit("hot")).alias("work_id"),
            F.lit("t").alias("table_name"), F.col("id").cast("string").alias("row_key"),
            F.lit("f").alias("family"), F.lit("q").alias("qualifier"),
            F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("ts"),
            F.lpad(F.col("id").cast("string"), 40, "x").alias("value"))
        items = spark.createDataFrame([("hot", "/in/hot"), ("cold", "/in/cold")], "work_id string, source_path string")
        paths = write_bulk(df, items, str(tmp_path / "bulk"))
        hot_bucket = spark.range(1).select(F.pmod(F.xxhash64(F.lit("hot")), F.lit(64))).first()[0]
        files = glob.glob(os.path.join(paths["data"], "batch_id=0", f"bucket={hot_bucket}", "*.parquet"))
        assert len(files) > 1
        assert read_entries(spark, paths["data"]).count() == n
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_observed_counts_rows_of_the_write(spark, tmp_path):
    from intake.operators.metrics import observed
    df, obs = observed(shred(records(spark)), "entries")
    df.write.mode("overwrite").parquet(str(tmp_path / "o"))
    assert obs.get["rows"] == 120


def test_compact_live_keeps_the_current_view(spark, tmp_path):
    e = shred(records(spark)).drop("work_id")
    tdir = str(tmp_path / "live")
    for b in range(3):
        upsert_live(e.withColumn("value", F.concat(F.col("value"), F.lit(f"-{b}")))
                     .withColumn("ts", F.col("ts") + F.expr(f"INTERVAL {b} SECOND")), tdir, "r", b)
    before = sorted(tuple(r) for r in live_current(spark, tdir).drop("n_versions").collect())
    tag = compact_live(spark, tdir)
    assert tag == "r-000000000002~snapshot"
    after = sorted(tuple(r) for r in live_current(spark, tdir).drop("n_versions").collect())
    assert after == before
    assert glob.glob(os.path.join(tdir, "table_name=event", "batch_id=*")) == \
        [os.path.join(tdir, "table_name=event", "batch_id=" + tag)]
    upsert_live(e, tdir, "r", 3)   # later batches still land beside the snapshot
    assert live_current(spark, tdir).count() == 120


def test_compact_live_twice_is_harmless(spark, tmp_path):
    e = shred(records(spark)).drop("work_id")
    tdir = str(tmp_path / "live2")
    upsert_live(e, tdir, "r", 0)
    upsert_live(e.withColumn("value", F.lit("v")), tdir, "r", 1)
    before = sorted(tuple(r) for r in live_current(spark, tdir).drop("n_versions").collect())
    compact_live(spark, tdir)
    compact_live(spark, tdir)       # e.g. a re-run after a crash between write and delete
    after = sorted(tuple(r) for r in live_current(spark, tdir).drop("n_versions").collect())
    assert after == before
    assert len(glob.glob(os.path.join(tdir, "table_name=event", "batch_id=*"))) == 1


COUNTERS = "table_name string, row_key string, family string, qualifier string, ts timestamp_ntz, value string"


def test_counters_lose_no_digit_and_report_what_is_no_number(spark):
    rows = [("c", "r", "f", "q", T0, v) for v in ("0.004", "0.004", "0.004", "x")] + [("c", "z", "f", "q", T0, "10"), ("c", "n", "f", "q", T0, "?")]
    got = {r["row_key"]: (r["value"], r["n_rejected"]) for r in
           aggregate_entries(spark.createDataFrame(rows, COUNTERS), ["c"]).collect()}
    assert got == {"r": ("0.012", 1), "z": ("10", 0), "n": ("0", 1)}


def test_live_counters_add_up_before_and_after_compaction(spark, tmp_path):
    def batch(n):
        return spark.createDataFrame([("c", "r", "f", "q", T0, str(n)), ("last", "r", "f", "q", T0 + dt.timedelta(days=n), str(n))], COUNTERS)

    tdir = str(tmp_path / "live")

    def view():
        return {r["table_name"]: r["value"] for r in live_current(spark, tdir, ["c"]).collect()}

    for n in (1, 2, 2):
        upsert_live(batch(n), tdir, "run", n)
    assert view() == {"c": "3", "last": "2"}
    compact_live(spark, tdir, sum_tables=["c"])
    assert view() == {"c": "3", "last": "2"}
    upsert_live(batch(3), tdir, "run", 3)
    assert view() == {"c": "6", "last": "3"}
    compact_live(spark, tdir, sum_tables=["c"])
    compact_live(spark, tdir, sum_tables=["c"])
    assert view() == {"c": "6", "last": "3"}


def test_folded_batches_do_not_count_twice(spark, tmp_path):
    """A crash between the snapshot's write and the deletes."""
    tdir = str(tmp_path / "live")
    one = spark.createDataFrame([("c", "r", "f", "q", T0, "5")], COUNTERS)
    upsert_live(one, tdir, "run", 0)
    compact_live(spark, tdir, sum_tables=["c"])
    upsert_live(one, tdir, "run", 0)   # as if its folder had not been deleted
    assert [r["value"] for r in live_current(spark, tdir, ["c"]).collect()] == ["5"]
    compact_live(spark, tdir, sum_tables=["c"])
    assert [r["value"] for r in live_current(spark, tdir, ["c"]).collect()] == ["5"]


def test_bundle_ids_are_of_all_members_and_files_without_feed_stay(spark, tmp_path):
    from intake.operators.bundle import bundle_ids

    def plan(names, feed="f"):
        return spark.createDataFrame([(feed, n, 1, T0, 0, True) for n in names],
                                     "feed string, path string, length long, mtime timestamp_ntz, batch_no long, fired boolean")

    ids = [bundle_ids(plan(n)).first()["bundle_id"] for n in ("abd", "acd", "dba")]
    assert ids[0] != ids[1] and ids[0] == ids[2]
    entries = spark.createDataFrame([(n, "t", n, "f", "q", T0, "v") for n in "abd"], "source_path string, " + COUNTERS)
    members = compact_bundles(entries, plan("abd", None), str(tmp_path / "b"))
    assert members.count() == 3 and spark.read.parquet(str(tmp_path / "b")).count() == 3


def test_record_without_key_is_an_entry_of_its_own(spark):
    from intake.operators.shred import shred_entries
    rec = spark.createDataFrame([("a", "x"), (None, "y")], "id string, kind string").withColumn("ts", F.lit(T0).cast("timestamp_ntz"))
    got = sorted((r["table_name"], r["qualifier"], r["value"]) for r in shred_entries(rec, "d", F.col("id"), {"kind": F.col("kind")}, F.col("ts")).collect())
    assert [g[:2] for g in got] == [("event", "kind"), ("rejected", "null_key")] and '"kind":"y"' in got[1][2]
