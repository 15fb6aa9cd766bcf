import datetime as dt

import pytest

from intake.config import PROFILES, SAMPLE_FEEDS, SAMPLE_POOLS, ScanConfig
from intake.functions.paths import flagged_path, loaded_path
from intake.operators import work
from pyspark.sql import functions as F

from intake.operators.work import (attempt_ledger, config_table, flagged_collisions, parse_work_items,
                                   route_orphans, route_work, select_retries, work_items)


def test_parse_messages(spark):
    msgs = spark.createDataFrame([(m,) for m in [
        "/data/input/flagged/csv/a.csv,csv,mycsv",
        "/data/input/flagged/csv/b.csv,csv",
        "/data/input/flagged/csv/c.csv,csv,mycsv,extra",
        "/data/input/flag,ged/csv/d.csv,csv,mycsv",
        "/data/input/flagged/csv/e.csv,xml,mycsv",
        "/data/input/flagged/csv/f.csv,json, myjson ,,,",
        "/data/input/flagged/csv/gone.csv,csv,mycsv",
    ]], "message string")
    inv = spark.createDataFrame([(f"/data/input/flagged/csv/{n}.csv", 10) for n in "abcdef"],
                                "path string, length long")
    got = {r["message"]: (r["status"], r["data_type"], r["length"]) for r in parse_work_items(msgs, inv).collect()}
    assert got["/data/input/flagged/csv/a.csv,csv,mycsv"] == ("ok", "mycsv", 10)
    assert got["/data/input/flagged/csv/b.csv,csv"][0] == "bad_fields"
    assert got["/data/input/flagged/csv/c.csv,csv,mycsv,extra"][0] == "bad_fields"
    assert got["/data/input/flag,ged/csv/d.csv,csv,mycsv"][0] == "bad_fields"
    assert got["/data/input/flagged/csv/e.csv,xml,mycsv"][0] == "unknown_format"
    assert got["/data/input/flagged/csv/f.csv,json, myjson ,,,"] == ("ok", "myjson", 10)
    assert got["/data/input/flagged/csv/gone.csv,csv,mycsv"][0] == "missing"


def test_work_items_and_collisions(spark):
    files = spark.createDataFrame([
        ("/in/csv/2024/a.csv", 5, dt.datetime(2024, 1, 1)),
        ("/in/csv/2025/a.csv", 6, dt.datetime(2024, 1, 2)),
    ], "path string, length long, mtime timestamp_ntz")
    flat = work_items(files, "/flagged/csv/", "csv", "mycsv")
    assert {r["target_path"] for r in flat.collect()} == {"/flagged/csv/a.csv"}
    assert flagged_collisions(flat).collect()[0]["n_sources"] == 2
    kept = work_items(files, "/flagged/csv", "csv", "mycsv", input_dir="/in/csv/", preserve_path=True)
    rows = {r["target_path"]: r for r in kept.collect()}
    assert set(rows) == {"/flagged/csv/2024/a.csv", "/flagged/csv/2025/a.csv"}
    assert rows["/flagged/csv/2024/a.csv"]["message"] == "/flagged/csv/2024/a.csv,csv,mycsv"
    assert flagged_collisions(kept).count() == 0
    ids = [r["work_id"] for r in kept.collect()]
    assert len(set(ids)) == 2 and ids == [r["work_id"] for r in kept.collect()]


def test_loaded_path_modes(spark):
    df = spark.createDataFrame([("/d/flagged/x/flagged/f.csv",), ("/d/x$1/flagged/g",)], "p string")
    rows = df.select(loaded_path("p", "all").alias("a"), loaded_path("p", "first").alias("f")).collect()
    assert rows[0]["a"] == "/d/loaded/x/loaded/f.csv" and rows[0]["f"] == "/d/loaded/x/flagged/f.csv"
    assert rows[1]["f"] == "/d/x$1/loaded/g"
    with pytest.raises(ValueError):
        loaded_path("p", "some")


def test_flagged_path_outside_input_dir_is_flat(spark):
    df = spark.createDataFrame([("/elsewhere/q/z.csv",)], "path string")
    got = df.select(flagged_path("path", "/t", "/in", True).alias("t")).collect()[0]["t"]
    assert got == "/t/z.csv"


def test_routing_and_orphans(spark):
    feeds = config_table(spark, SAMPLE_FEEDS + [("feed4", "nowhere")], "feed string, queue string")
    pools = config_table(spark, SAMPLE_POOLS + [("lazy", "empty", 2)], "pool string, queue string, replicas int")
    items = spark.createDataFrame([("feed1", "/a"), ("feed3", "/b"), ("feed4", "/c"), ("feed9", "/d")],
                                  "feed string, path string")
    routed = route_work(items, feeds, pools)
    got = {r["path"]: r["pool"] for r in routed.collect()}
    assert got == {"/a": "speedy", "/b": "speediest", "/c": None, "/d": None}
    assert {r["path"]: r["route"] for r in routed.collect()} == {"/a": "ok", "/b": "ok", "/c": "no_pool", "/d": "no_queue"}
    assert "BroadcastHashJoin" in routed._jdf.queryExecution().executedPlan().toString()
    orphans = {(r["kind"], r["name"]) for r in route_orphans(feeds, pools).collect()}
    assert orphans == {("feed_without_pool", "feed4"), ("pool_without_feed", "lazy")}


def test_attempt_ledger_states(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("a", 1, "failed"), ("a", 2, "ok"), ("b", 1, "failed"), ("b", 2, "failed"), ("b", 3, "failed"), ("c", 1, "failed"),
            ("d", 1, "failed"), ("d", 1, "failed"), ("d", 1, "failed"),     # one delivery reported three times
            ("e", 1, "ok"), ("e", 2, "failed")]                             # an ok is final
    out = spark.createDataFrame([(w, n, t + dt.timedelta(seconds=i), s) for i, (w, n, s) in enumerate(rows)],
                                "work_id string, attempt int, at timestamp_ntz, status string")
    ledger = attempt_ledger(out, 3)
    assert {r["work_id"]: (r["attempts"], r["state"]) for r in ledger.collect()} == {
        "a": (2, "done"), "b": (3, "dead_letter"), "c": (1, "retry"), "d": (1, "retry"), "e": (2, "done")}
    items = spark.createDataFrame([("a", "x"), ("c", "y"), ("d", "z")], "work_id string, message string")
    assert {(r["work_id"], r["attempt"]) for r in select_retries(items, ledger).collect()} == {("c", 2), ("d", 2)}


def test_config_profiles_and_strict_keys():
    assert PROFILES["bundler_pri1"].max_files == 10
    assert ScanConfig(error_retry_interval=60, error_retry_time_unit="SECONDS").retry_ms == 60_000
    with pytest.raises(ValueError):
        ScanConfig.from_dict({"maxFiles": 3})
    with pytest.raises(ValueError):
        ScanConfig(error_retry_time_unit="FORTNIGHTS").retry_ms


def test_time_arithmetic_ignores_session_zone(spark):
    from pyspark.sql import functions as F
    from intake.functions.ids import age_micros, epoch_micros, from_epoch_seconds
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([(dt.datetime(2024, 7, 1, 12, 0, 0, 7),)], "ts timestamp_ntz")
        row = df.select(epoch_micros("ts").alias("m"), from_epoch_seconds(F.lit(3600)).alias("t"),
                        age_micros("ts", dt.datetime(2024, 7, 1, 13)).alias("age")).collect()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert row["m"] == 1719835200000007
    assert row["t"] == dt.datetime(1970, 1, 1, 1, 0)
    assert row["age"] == 3_600_000_000 - 7


def test_cluster_conf_sizes_partitions():
    from intake.session import cluster_conf
    conf = cluster_conf(100 << 40, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    assert int(cluster_conf(1 << 20, 8)["spark.sql.shuffle.partitions"]) == 24


def test_reference_configuration_sections():
    from intake.config import from_reference, load_reference_yaml
    text = """
file:
  frequency: 1000
  recursive: true
  inputDir: '/data/input/csv'
  ignorePrefix: '.'
  maxFiles: 2
  maxAge: 60000
feeder:
  targetDir: '/data/input/flagged/csv'
  inputFormatClass: 'csv'
  dataType: 'mycsv'
  preservePath: true
bundler:
  workDir: /tmp/work
  bundleOutputDir: /data/input/csvSeq/
ingest:
  liveIngest: true
  fsConfigResources: [a.xml]
"""
    cfg = load_reference_yaml(text)
    assert cfg["file"].max_files == 2 and cfg["file"].recursive and cfg["file"].max_size == -1
    assert cfg["feeder"].preserve_path and cfg["bundler"].date_format == "yyyy/MM/dd"
    assert cfg["ingest"].live_ingest
    # retry settings belong to `file`, not `feeder` (refused, not silently dropped)
    with pytest.raises(ValueError):
        from_reference("feeder", {"targetDir": "/x", "inputFormatClass": "csv", "dataType": "t",
                                  "errorRetryInterval": 60})


def test_first_occurrence_rewrite_is_literal(spark):
    df = spark.createDataFrame([("/d/aXb/q/a.b/f",)], "p string")
    got = df.select(loaded_path("p", "first", "/a.b/", "/$0/").alias("f")).collect()[0]["f"]
    assert got == "/d/aXb/q/$0/f"   # '.' and '$0' are literal, not regex


def test_empty_and_comma_only_messages(spark):
    msgs = spark.createDataFrame([("",), (",,,",), ("/p,csv,t,,",)], "message string")
    got = {r["message"]: (r["n_fields"], r["status"]) for r in parse_work_items(msgs).collect()}
    assert got[""] == (0, "bad_fields")
    assert got[",,,"][1] == "bad_fields"
    assert got["/p,csv,t,,"] == (3, "ok")


def test_local_paths_match_with_or_without_scheme(spark):
    inv = spark.createDataFrame([("file:/in/a.csv", 5)], "path string, length long")
    msgs = spark.createDataFrame([("/in/a.csv,csv,t",), ("file:///in/a.csv,csv,t",), ("/in/b.csv,csv,t",)], "message string")
    got = [(r["status"], r["read_path"]) for r in parse_work_items(msgs, inv).orderBy("message").collect()]
    assert sorted(got, key=str) == sorted([("ok", "file:/in/a.csv"), ("missing", None), ("ok", "file:/in/a.csv")], key=str)


def test_deal_is_bounded_and_stable(spark):
    """No replica above 1.25 times the mean, whatever the order of rows; a further replica takes its share and little else moves."""
    import random

    rnd = random.Random(4)
    rows = [(f"w{i}", f"/in/{i}", rnd.choice([0, 1, 10, 50, rnd.randint(0, 300)]), "p") for i in range(1200)] + [
        ("x1", "/x", 5, None), ("x2", "/x2", None, "p"), ("y", "/y", 7, "lone")]
    items = spark.createDataFrame(rows, "work_id string, path string, length long, pool string")

    def deal(n, df=items):
        routed = df.withColumn("replicas", F.when(F.col("pool") == "p", n).when(F.col("pool") == "lone", 1))
        return {r["work_id"]: (r["replica"], r["length"] or 0, r["deal"]) for r in work.deal_to_replicas(routed).collect()}

    def loads(dealt, n):
        out = [0] * n
        for k, (r, size, _) in dealt.items():
            if k.startswith("w") or k == "x2":
                out[r] += size
        return out

    four = deal(4)
    assert len(four) == len(rows) and four["x1"] == (None, 5, None) and four["y"] == (0, 7, "ok")
    total = sum(loads(four, 4))
    assert max(loads(four, 4)) <= 1.25 * total / 4 + 1 and min(loads(four, 4)) > 0
    assert {d for k, (_, _, d) in four.items() if k != "x1"} == {"ok"}
    assert deal(4, items.repartition(5).orderBy(F.rand(1))) == four
    five = deal(5)
    assert max(loads(five, 5)) <= 1.25 * total / 5 + 1
    moved = sum(size for k, (r, size, _) in five.items() if r != four[k][0])
    to_new = sum(size for k, (r, size, _) in five.items() if r == 4)
    assert to_new <= 1.25 * total / 5 + 1 and moved - to_new <= 0.15 * total


def test_an_item_beyond_the_bound_is_told(spark):
    rows = [("huge", "/h", 1000, "p", 3), ("a", "/a", 1, "p", 3), ("b", "/b", 1, "p", 3)]
    items = spark.createDataFrame(rows, "work_id string, path string, length long, pool string, replicas int")
    got = {r["work_id"]: (r["replica"], r["deal"]) for r in work.deal_to_replicas(items).collect()}
    assert got["huge"][1] == "over" and got["huge"][0] in (0, 1, 2) and got["a"][1] == got["b"][1] == "ok"
    assert work.deal_to_replicas(items.limit(0)).count() == 0
