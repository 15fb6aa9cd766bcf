import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from intake.operators.bundle import mark_paired, pair_manifests, unpaired_files
from intake.operators.filters import (current_quarantine, exclude_manifests, ignore_prefix,
                                      quarantine_filter, quarantine_state, quarantine_update)
from intake.sources.inventory import landing_inventory


@pytest.fixture()
def landing(tmp_path):
    root = tmp_path / "landing"
    (root / "a").mkdir(parents=True)
    (root / "b").mkdir()
    files = {
        "empty.csv": b"",
        ".hidden.csv": b"x",
        "_under.csv": b"x",
        "x.csv": b"1,2\n",
        "x.csv.manifest": b"id\t/p/x.csv\n",
        "y.csv": b"3,4\n",
        "with,comma.csv": b"5\n",
        "a/same.csv": b"aa",
        "b/same.csv": b"bbb",
    }
    for name, data in files.items():
        (root / name).write_bytes(data)
    return root


def test_inventory_lists_top_level_only_by_default(spark, landing):
    inv = landing_inventory(spark, str(landing), feed="f")
    names = sorted(r["name"] for r in inv.collect())
    # Spark never lists names starting with "." or "_" (documented limit)
    assert names == ["empty.csv", "with,comma.csv", "x.csv", "x.csv.manifest", "y.csv"]
    lengths = {r["name"]: r["length"] for r in inv.collect()}
    assert lengths["empty.csv"] == 0 and lengths["x.csv"] == 4


def test_inventory_recursive_keeps_equal_names(spark, landing):
    inv = landing_inventory(spark, str(landing), recursive=True)
    same = [r["path"] for r in inv.collect() if r["name"] == "same.csv"]
    assert len(same) == 2


def test_inventory_refuses_a_file(spark, landing):
    with pytest.raises(ValueError):
        landing_inventory(spark, str(landing / "x.csv"))


def test_inventory_does_not_read_content(spark, landing):
    plan = landing_inventory(spark, str(landing))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_prefix_and_manifest_filters(spark, landing):
    inv = landing_inventory(spark, str(landing))
    assert ignore_prefix(inv, None).count() == inv.count()
    assert sorted(r["name"] for r in ignore_prefix(inv, "x").collect()) == ["empty.csv", "with,comma.csv", "y.csv"]
    data = exclude_manifests(inv)
    assert "x.csv.manifest" not in [r["name"] for r in data.collect()]
    manifests = inv.where(F.col("path").endswith(".manifest"))
    assert [r["name"] for r in pair_manifests(data, manifests).collect()] == ["x.csv"]
    flags = {r["name"]: r["admitted"] for r in mark_paired(data, manifests).collect()}
    assert flags["x.csv"] and not flags["y.csv"]
    kinds = sorted((r["kind"], os.path.basename(r["path"])) for r in unpaired_files(data, manifests).collect())
    assert ("no_manifest", "y.csv") in kinds and all(k != "no_data" for k, _ in kinds)
    orphan = unpaired_files(data.where(F.col("name") != "x.csv"), manifests).collect()
    assert [(r["kind"], os.path.basename(r["path"])) for r in orphan if r["kind"] == "no_data"] == \
        [("no_data", "x.csv.manifest")]


def test_quarantine_ttl_edge(spark):
    as_of = dt.datetime(2024, 1, 2, 0, 0, 0)
    ttl = 60_000
    fails = spark.createDataFrame([
        ("/a", as_of - dt.timedelta(milliseconds=ttl), "exactly ttl"),
        ("/b", as_of - dt.timedelta(milliseconds=ttl - 1), "inside"),
        ("/c", as_of - dt.timedelta(hours=1), "old"),
        ("/c", as_of - dt.timedelta(seconds=1), "again"),
    ], "path string, failed_at timestamp_ntz, reason string")
    files = spark.createDataFrame([(p,) for p in ["/a", "/b", "/c", "/d"]], "path string")
    kept = sorted(r["path"] for r in quarantine_filter(files, fails, as_of, ttl).collect())
    assert kept == ["/a", "/d"]
    cur = {r["path"]: r["reason"] for r in current_quarantine(fails, as_of, ttl).collect()}
    assert cur == {"/b": "inside", "/c": "again"}
    state = {r["path"]: r["n_failures"] for r in quarantine_state(fails).collect()}
    assert state == {"/a": 1, "/b": 1, "/c": 2}


def test_quarantine_update_appends(spark):
    log = spark.createDataFrame([], "path string, failed_at timestamp_ntz, reason string")
    new = spark.createDataFrame([("/x",)], "path string")
    out = quarantine_update(log, new, as_of=dt.datetime(2024, 1, 1), reason="bad member").collect()
    assert out[0]["reason"] == "bad member" and out[0]["failed_at"] == dt.datetime(2024, 1, 1)


def test_feed_inventories_tag_each_folder(spark, landing):
    from intake.sources.inventory import feed_inventories
    inv = feed_inventories(spark, {"fa": str(landing / "a"), "fb": str(landing / "b")})
    assert sorted((r["feed"], r["name"], r["length"]) for r in inv.collect()) == \
        [("fa", "same.csv", 2), ("fb", "same.csv", 3)]
