"""End-to-end: landing folder -> feeder tick -> ingest -> bundles, with real files."""

import datetime as dt
import os

from pyspark.sql import functions as F

from intake.config import PROFILES, FeederConfig, ScanConfig
from intake.operators.shred import shred_entries
from intake.plans.lifecycle import DataType, bundle_files, feeder_tick, ingest_items
from intake.sinks.bulk import read_manifests
from intake.sources.entries import read_entries
from intake.sources.inventory import landing_inventory
from intake.sources.typed import TypeSpec

NO_FAILURES = "path string, failed_at timestamp_ntz, reason string"


def write_csvs(root, n):
    root.mkdir(parents=True, exist_ok=True)
    for i in range(n):
        (root / f"f{i}.csv").write_text("".join(f"{i * 10 + k},kind{k % 3},{k}.5\n" for k in range(4)))
    (root / ".partial.csv").write_text("9,x,1\n")


def test_feed_ingest_end_to_end(spark, tmp_path):
    land = tmp_path / "input" / "csv"
    write_csvs(land, 5)
    inv = landing_inventory(spark, str(land), feed="csv")
    as_of = dt.datetime.now() + dt.timedelta(hours=1)   # every file is over age
    scan = ScanConfig(input_dir=str(land), ignore_prefix=".", max_files=2, max_age=60_000)
    feeder = FeederConfig(target_dir=str(tmp_path / "flagged" / "csv"), input_format="csv", data_type="mycsv")
    failures = spark.createDataFrame([], NO_FAILURES)
    tick = feeder_tick(inv, failures, scan, feeder, as_of)
    items = tick["items"].collect()
    assert len(items) == 2 and tick["trigger"].collect()[0]["fired"]
    assert tick["collisions"].count() == 0

    # ingest the landed files themselves (no physical move in Spark tasks)
    msgs = inv.select(F.concat_ws(",", "path", F.lit("csv"), F.lit("mycsv")).alias("message"),
                      F.md5("path").alias("work_id"))
    msgs = msgs.unionByName(spark.createDataFrame([("bad,message", "w-bad")], "message string, work_id string"))

    def shred(df):
        return shred_entries(df.withColumn("ts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")),
                             "mycsv", F.col("id"), {"kind": F.col("kind"), "amount": F.col("amount")},
                             F.col("ts"), carry=["work_id"])

    types = {"mycsv": DataType(TypeSpec("csv", "id long, kind string, amount double"), shred)}
    out = ingest_items(spark, msgs, inv, types, as_of, "bulk", str(tmp_path / "out"), batch_id="7")
    entries = read_entries(spark, str(tmp_path / "out" / "data"))
    assert entries.count() == 5 * 4 * 2
    assert read_manifests(spark, str(tmp_path / "out" / "manifests")).count() == 5
    outcomes = {r["work_id"]: r["status"] for r in out["outcomes"].collect()}
    assert outcomes["w-bad"] == "failed" and sum(v == "ok" for v in outcomes.values()) == 5

    live = ingest_items(spark, msgs, inv, types, as_of, "live", str(tmp_path / "live"), batch_id="1")
    assert all("/loaded/" not in r["loaded_path"] for r in live["moves"].collect())  # no /flagged/ here


def test_bundler_quarantines_unreadable_member(spark, tmp_path):
    root = tmp_path / "work"
    root.mkdir()
    rows = [("t", f"r{i}", "f", "q", dt.datetime(2024, 1, 1), str(i)) for i in range(3)]
    schema = "table_name string, row_key string, family string, qualifier string, ts timestamp_ntz, value string"
    for i in range(6):
        if i == 3:
            (root / "out3.seq").write_bytes(b"this is not parquet at all")
        else:
            spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"tmp{i}"))
            part = [f for f in os.listdir(tmp_path / f"tmp{i}") if f.endswith(".parquet")][0]
            os.link(tmp_path / f"tmp{i}" / part, root / f"out{i}.seq")
        (root / f"out{i}.seq.manifest").write_text(f"w{i}\t/data/flagged/in/{i}.csv\n")
    inv = landing_inventory(spark, str(root), feed="pool1")
    as_of = dt.datetime.now() + dt.timedelta(hours=1)
    cfg = ScanConfig(max_files=2, max_size=1_000_000, max_age=60_000)

    def read_members(paths):
        from intake.functions.paths import source_file_path
        return spark.read.schema(schema).parquet(*paths).withColumn("source_path", source_file_path())

    failures = spark.createDataFrame([], NO_FAILURES)
    members, failures = bundle_files(spark, inv, failures, cfg, as_of, str(tmp_path / "bundles"), read_members)
    bad = [r["path"] for r in failures.collect()]
    assert len(bad) == 1 and bad[0].endswith("out3.seq")
    names = sorted(os.path.basename(r["path"]) for r in members.collect())
    assert names == ["out0.seq", "out1.seq", "out2.seq", "out4.seq", "out5.seq"]
    back = read_entries(spark, str(tmp_path / "bundles"), "source_path string, bundle_id string")
    assert back.count() == 5 * 3

    # the whole bundler tick with dated output and accounting
    from intake.config import BundlerConfig
    from intake.plans.lifecycle import bundler_run
    flagged = spark.createDataFrame([(f"/data/flagged/in/{i}.csv",) for i in (0, 1, 2, 4)], "path string")
    out = bundler_run(spark, inv, spark.createDataFrame([], NO_FAILURES), cfg,
                      BundlerConfig(bundle_output_dir=str(tmp_path / "pub")), as_of, read_members, flagged)
    assert out["folder"].startswith(str(tmp_path / "pub") + "/") and out["folder"].count("/") >= 3
    acc = {r["origin"]: (r["status"], r["loaded_path"]) for r in out["accounting"].collect()}
    assert acc["/data/flagged/in/0.csv"] == ("moved", "/data/loaded/in/0.csv")
    assert acc["/data/flagged/in/5.csv"][0] == "missing" and len(acc) == 5


def test_profiles_are_usable():
    assert PROFILES["feeder_csv"].max_files == 2


def test_feeder_stream_takes_files_tick_by_tick(spark, tmp_path):
    import time
    from intake.streaming.feeder import feeder_stream
    land = tmp_path / "landing"
    write_csvs(land, 5)
    scan = ScanConfig(input_dir=str(land), ignore_prefix=".", max_files=2)
    feeder = FeederConfig(target_dir="/flagged/csv", input_format="csv", data_type="mycsv")
    state = str(tmp_path / "state")
    q = feeder_stream(spark, str(land), state, scan, feeder, feed="csv", trigger_ms=1000)
    try:
        deadline = time.time() + 120
        while time.time() < deadline and (q.lastProgress or {}).get("batchId", -1) < 2:
            time.sleep(0.5)
    finally:
        q.stop()
    items = spark.read.parquet(state + "/work_items")
    per_tick = {r["tick"]: r["n"] for r in items.groupBy("tick").agg(F.count("*").alias("n")).collect()}
    # two files per tick until one is left, which waits (below max_files, no age limit)
    assert per_tick.get(0) == 2 and per_tick.get(1) == 2 and sum(per_tick.values()) == 4
    assert items.select("path").distinct().count() == 4


def test_feeder_stream_takes_a_replaced_file_again(spark, tmp_path):
    import time
    from intake.streaming.feeder import feeder_stream
    land = tmp_path / "landing"
    write_csvs(land, 2)
    os.utime(land / "f0.csv", (1000, 1000))
    scan = ScanConfig(input_dir=str(land), ignore_prefix=".", max_files=1, max_age=-1)

    def ticks(upto):
        q = feeder_stream(spark, str(land), str(tmp_path / "state"), scan, FeederConfig("/flagged", "csv", "d"), trigger_ms=500)
        try:
            deadline = time.time() + 120
            while time.time() < deadline and (q.lastProgress or {}).get("batchId", -1) < upto:
                time.sleep(0.2)
        finally:
            q.stop()
        return sorted((os.path.basename(r["path"]), r["length"]) for r in spark.read.parquet(str(tmp_path / "state" / "work_items")).collect())

    size, other = (os.path.getsize(land / n) for n in ("f0.csv", "f1.csv"))
    assert ticks(2) == [("f0.csv", size), ("f1.csv", other)]
    os.utime(land / "f0.csv", (2000, 2000))                  # same bytes, landed again
    (land / "f1.csv").write_text("1,x,2\n")
    assert ticks(6) == [("f0.csv", size), ("f0.csv", size), ("f1.csv", 6), ("f1.csv", other)]


def test_read_typed_feed_mixes_csv_and_json(spark, tmp_path):
    from intake.sources.typed import read_typed_feed
    (tmp_path / "a.csv").write_text("1,click\n2,view\n")
    (tmp_path / "b.json").write_text('{"id": 3, "kind": "view", "extra": "x"}\n{"id": 4}\n')
    items = spark.createDataFrame([(str(tmp_path / "a.csv"), " mycsv", "csv"),
                                   (str(tmp_path / "b.json"), "myjson ", "json")],
                                  "path string, data_type string, format string")
    reg = {"mycsv": TypeSpec("csv", "id long, kind string"),
           "myjson": TypeSpec("json", "id long, kind string, extra string")}
    rows = sorted((r["data_type"], r["id"], r["kind"], r["extra"]) for r in read_typed_feed(spark, items, reg).collect())
    assert rows == [("mycsv", 1, "click", None), ("mycsv", 2, "view", None),
                    ("myjson", 3, "view", "x"), ("myjson", 4, None, None)]


def test_feeder_stream_several_feeds_with_own_limits(spark, tmp_path):
    import time
    from intake.streaming.feeder import feeder_stream
    write_csvs(tmp_path / "a", 4)
    write_csvs(tmp_path / "b", 4)
    limits = spark.createDataFrame([("fa", 1, -1, -1), ("fb", 3, -1, -1)],
                                   "feed string, max_files long, max_size long, max_age long")
    scan = ScanConfig(ignore_prefix=".")
    feeder = FeederConfig(target_dir="/flagged", input_format="csv", data_type="mycsv")
    state = str(tmp_path / "state")
    q = feeder_stream(spark, {"fa": str(tmp_path / "a"), "fb": str(tmp_path / "b")}, state, scan, feeder,
                      trigger_ms=1000, limits=limits)
    try:
        deadline = time.time() + 120
        while time.time() < deadline and (q.lastProgress or {}).get("batchId", -1) < 0:
            time.sleep(0.5)
    finally:
        q.stop()
    items = spark.read.parquet(state + "/work_items").where("tick = 0")
    per_feed = {r["feed"]: r["n"] for r in items.groupBy("feed").agg(F.count("*").alias("n")).collect()}
    assert per_feed == {"fa": 1, "fb": 3}


def test_source_paths_match_the_listing_for_odd_names(spark, tmp_path):
    from intake.sources.typed import read_typed_feed
    d = tmp_path / "odd"
    d.mkdir()
    names = ["with space.csv", "a+b.csv", "pct%41.csv", "ünï.csv"]
    for i, n in enumerate(names):
        (d / n).write_text(f"{i},x\n")
    inv = landing_inventory(spark, str(d))
    items = inv.select("path", F.lit("t").alias("data_type"))
    recs = read_typed_feed(spark, items, {"t": TypeSpec("csv", "id long, k string")})
    joined = recs.join(inv.select(F.col("path").alias("source_path")), "source_path")
    assert joined.count() == len(names)


def test_ingest_mode_from_ingest_config(spark, tmp_path):
    from intake.config import IngestConfig
    from intake.sinks.live import live_current
    land = tmp_path / "in" / "flagged" / "csv"
    write_csvs(land, 2)
    inv = landing_inventory(spark, str(land), feed="csv")
    msgs = inv.select(F.concat_ws(",", "path", F.lit("csv"), F.lit("mycsv")).alias("message"),
                      F.md5("path").alias("work_id"))

    def shred(df):
        return shred_entries(df.withColumn("ts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")),
                             "mycsv", F.col("id"), {"kind": F.col("kind")}, F.col("ts"), carry=["work_id"])

    types = {"mycsv": DataType(TypeSpec("csv", "id long, kind string, amount double"), shred)}
    cfg = IngestConfig(live_ingest=True, output_dir=str(tmp_path / "live"))
    out = ingest_items(spark, msgs, inv, types, dt.datetime(2024, 1, 2), cfg, batch_id="3")
    assert live_current(spark, str(tmp_path / "live")).count() == 8
    moves = {r["loaded_path"] for r in out["moves"].collect()}
    assert all("/in/loaded/csv/" in m for m in moves) and len(moves) == 2


def _by_kind(df):
    return shred_entries(df.withColumn("ts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")),
                         "d", F.col("id"), {"kind": F.col("kind")}, F.col("ts"), carry=["work_id"])


def test_feeder_items_are_read_where_they_are(spark, tmp_path):
    """The feeder's own messages name flagged targets; nothing has been moved."""
    land = tmp_path / "input" / "csv"
    write_csvs(land, 3)
    inv = landing_inventory(spark, str(land)).withColumn("feed", F.lit(None).cast("string"))   # files without a feed
    as_of = dt.datetime.now() + dt.timedelta(hours=1)
    scan = ScanConfig(input_dir=str(land), ignore_prefix=".", max_files=10, max_age=60_000)
    feeder = FeederConfig(target_dir=str(tmp_path / "flagged"), input_format="csv", data_type="d")
    items = feeder_tick(inv, spark.createDataFrame([], NO_FAILURES), scan, feeder, as_of)["items"]
    assert items.count() == 3
    types = {"d": DataType(TypeSpec("csv", "id long, kind string, amount double"), _by_kind)}
    out = ingest_items(spark, items.select("message", "work_id"), inv, types, as_of, "bulk", str(tmp_path / "out"), moved=items)
    assert {r["status"] for r in out["outcomes"].collect()} == {"ok"}
    assert read_entries(spark, str(tmp_path / "out" / "data")).count() == 12
    lines = [r["value"] for r in read_manifests(spark, str(tmp_path / "out" / "manifests")).collect()]
    assert len(lines) == 3 and all("/flagged/" in x for x in lines)
    meta = out["metadata"].collect()
    assert [(r["qualifier"], r["value"]) for r in meta] == [("kind", "12")]


def test_inputs_fail_one_by_one(spark, tmp_path):
    land = tmp_path / "in"
    write_csvs(land, 2)
    (land / "broken.parquet").write_bytes(b"this is not parquet at all")
    spark.createDataFrame([("k1", "x")], "id string, kind string").coalesce(1).write.parquet(str(tmp_path / "ok"))
    part = [f for f in os.listdir(tmp_path / "ok") if f.endswith(".parquet")][0]
    os.link(tmp_path / "ok" / part, land / "good.parquet")
    inv = landing_inventory(spark, str(land), feed="f")
    name = lambda f, fmt, dt_: (f"{land}/{f},{fmt},{dt_}", f)
    msgs = spark.createDataFrame([
        name("f0.csv", "csv", "mycsv"), name("f1.csv", "csv", "nosuchtype"), name("f1.csv", "avro", "mycsv"),
        name("gone.csv", "csv", "mycsv"), name("broken.parquet", "parquet", "mypq"), name("good.parquet", "parquet", "mypq"),
        ("x,y", "bad")], "message string, work_id string")
    msgs = msgs.withColumn("work_id", F.concat_ws(":", "work_id", F.md5("message")))
    types = {"mycsv": DataType(TypeSpec("csv", "id long, kind string, amount double"), _by_kind),
             "mypq": DataType(TypeSpec("parquet", "id string, kind string"), _by_kind),    # id of another kind
             "absent": DataType(TypeSpec("json", "id long, kind string"), _by_kind)}
    out = ingest_items(spark, msgs, inv, types, dt.datetime(2024, 1, 2), "bulk", str(tmp_path / "out"))
    got = sorted((r["work_id"].split(":")[0], r["status"], r["reason"]) for r in out["outcomes"].collect())
    assert got == [("bad", "failed", "bad_fields"), ("broken.parquet", "failed", "unreadable"), ("f0.csv", "ok", None),
                   ("f1.csv", "failed", "unknown_format"), ("f1.csv", "failed", "unknown_type"),
                   ("gone.csv", "failed", "missing"), ("good.parquet", "ok", None)]
    assert read_entries(spark, str(tmp_path / "out" / "data")).count() == 5
    assert read_manifests(spark, str(tmp_path / "out" / "manifests")).count() == 2


def test_end_to_end_keeps_records_without_id(spark, tmp_path):
    from intake.plans import queries as Q

    spark.sql("""SELECT CASE WHEN id % 10 <> 3 THEN id END AS event_id, TIMESTAMP '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS ts,
                        'click' AS event_type, CASE WHEN id % 20 = 3 THEN NULL ELSE '{}' END AS props FROM range(40)"""
              ).write.parquet(str(tmp_path / "events.parquet"))
    rows = Q.end_to_end(spark, str(tmp_path)).collect()
    lost = [r for r in rows if r["table_name"] == "rejected"]
    assert len(lost) == 4 and all(r["qualifier"] == "null_key" and '"event_type":"click"' in r["value"] for r in lost)
    assert all(r["accounted"] for r in rows)
    assert sorted(r["row_key"] for r in rows if r["qualifier"] == "event_type") == sorted(str(i) for i in range(40) if i % 10 != 3)
    own = Q.q_pipeline_end_to_end(spark, str(tmp_path)).collect()
    assert {r["table_name"] for r in own} == {"event"} and len(own) == len(rows) - 4
