"""Levelled live tables: replays, merges of overfull buckets only, pinned readers."""

import datetime as dt
import os

from pyspark.sql import functions as F

from intake.sinks import levelled

T0 = dt.datetime(2024, 1, 1)
ENTRY = "table_name string, row_key string, family string, qualifier string, ts timestamp_ntz, value string"


def batch(spark, rows):
    return spark.createDataFrame([(t, k, "f", "q", T0 + dt.timedelta(seconds=s), v) for t, k, s, v in rows], ENTRY)


def current(spark, where, version=None):
    rows = levelled.read(spark, where, ["n"], version).collect()
    assert len(rows) == len({(r["table_name"], r["row_key"]) for r in rows})
    return {(r["table_name"], r["row_key"]): r["value"] for r in rows}


def sizes(where):
    return {os.path.relpath(f"{d}/{n}", where): os.path.getmtime(f"{d}/{n}") for d, _, names in os.walk(f"{where}/data") for n in names if n.endswith(".parquet")}


def test_upserts_replays_and_merges(spark, tmp_path):
    where = str(tmp_path / "t")
    put = lambda tag, rows: levelled.upsert(batch(spark, rows), where, tag[0], int(tag[1:]), ["n"], buckets=4)
    assert current(spark, where) == {}
    put("b0", [("n", "x", 0, "2"), ("n", "x", 1, "3"), ("v", "k", 5, "old"), ("n", "y", 0, "1.50")])
    put("b1", [("n", "x", 0, "10"), ("v", "k", 9, "new"), ("v", "k", 1, "older")])
    put("b1", [("n", "x", 0, "10"), ("v", "k", 9, "new"), ("v", "k", 1, "older")])          # replay
    want = {("n", "x"): "15", ("n", "y"): "1.5", ("v", "k"): "new"}
    assert current(spark, where) == want
    put("b2", [("n", "x", 0, "1")])
    want["n", "x"] = "16"
    assert current(spark, where) == want
    assert levelled.compact(spark, where, ["n"], max_runs=5) == []
    assert levelled.compact(spark, where, ["n"], max_runs=1)
    assert current(spark, where) == want
    put("b2", [("n", "x", 0, "1")])                     # the newest batch may be replayed after a merge
    put("b0", [("n", "x", 0, "2"), ("n", "x", 1, "3"), ("v", "k", 5, "old"), ("n", "y", 0, "1.50")])   # and an older one too
    assert current(spark, where) == want
    put("b3", [("v", "k", 9, "tie")])                   # equal time: the later batch
    want["v", "k"] = "tie"
    assert current(spark, where) == want
    put("a0", [("n", "x", 0, "5")])                     # another stream, named before the others: not taken for a replay
    want["n", "x"] = "21"
    assert current(spark, where) == want
    levelled.compact(spark, where, ["n"], max_runs=1)
    assert current(spark, where) == want


def test_only_overfull_buckets_are_merged(spark, tmp_path):
    where = str(tmp_path / "t")
    keys = [("v", f"k{i}", 0, "0") for i in range(200)]
    levelled.upsert(batch(spark, keys), where, "b", 0, ["n"], buckets=8)
    hot = batch(spark, [("v", "k0", 0, "0")]).select(levelled._bucket(8)).first()["bucket"]
    for i in range(1, 5):                                # one bucket gets run after run
        levelled.upsert(batch(spark, [("v", "k0", i, str(i))]), where, "b", i, ["n"], buckets=8)
    before = sizes(where)
    assert levelled.compact(spark, where, ["n"], max_runs=3) == [hot]
    new = set(sizes(where)) - set(before)
    assert new and all(f"/bucket={hot}/" in f for f in new)
    assert all(sizes(where)[f] == t for f, t in before.items())
    runs = {r["bucket"]: r["count"] for r in levelled.runs_of(spark, where).groupBy("bucket").count().collect()}
    assert runs.pop(hot) == 2 and set(runs.values()) == {1}
    got = current(spark, where)
    assert len(got) == 200 and got["v", "k0"] == "4"


def test_a_reader_keeps_its_version(spark, tmp_path):
    where = str(tmp_path / "t")
    for i in range(4):
        levelled.upsert(batch(spark, [("n", "x", i, "1"), ("v", f"k{i}", 0, "a")]), where, "b", i, ["n"], buckets=2)
    pinned, version = levelled.read(spark, where, ["n"]), levelled.versions(spark, where)[-1]
    levelled.compact(spark, where, ["n"], max_runs=1)
    levelled.upsert(batch(spark, [("n", "x", 9, "100")]), where, "b", 4, ["n"], buckets=2)
    assert {r["value"] for r in pinned.where("table_name = 'n'").collect()} == {"4"}       # began before, ends as it began
    assert levelled.vacuum(spark, where, keep=3) >= 0
    assert current(spark, where, version)["n", "x"] == "4" and current(spark, where)["n", "x"] == "104"
    assert levelled.vacuum(spark, where, keep=1) > 0
    assert current(spark, where)["n", "x"] == "104" and len(levelled.versions(spark, where)) == 1
    assert levelled.read(spark, where, ["n"]).where(F.col("table_name") == "v").count() == 4


def test_runs_are_dealt_once_and_folded_where_they_are_written(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(levelled, "PART_ROWS", 20, raising=False)           # several parts to a bucket
    where = str(tmp_path / "t")
    for i in range(4):
        rows = [("v", f"k{j}", (i * 7 + j) % 4, f"{i}-{j}") for j in range(200)] + [("n", f"k{j}", i, "1.5") for j in range(100)]
        rows += [("n", "k0", 9, None), ("v", "k0", 9, None), ("n", "k1", 0, "no number")]
        levelled.upsert(batch(spark, rows), where, "b", i, ["n"], buckets=4)

    def right():
        got = current(spark, where)
        newest = {("v", f"k{j}"): max(((i * 7 + j) % 4, i, f"{i}-{j}") for i in range(4))[2] for j in range(1, 200)}
        return got == newest | {("v", "k0"): None} | {("n", f"k{j}"): "6" for j in range(100)}

    assert right()
    plan = levelled.read(spark, where, ["n"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Aggregate" not in plan.split("Exchange ")[1] and "max_by" not in plan
    assert levelled.compact(spark, where, ["n"], max_runs=1) == [0, 1, 2, 3]
    assert right()
    merged = [d for d, _, names in os.walk(f"{where}/data") if "run=merged" in d and any(n.endswith(".parquet") for n in names)]
    files = [f"{d}/{n}" for d in merged for n in os.listdir(d) if n.endswith(".parquet")]
    assert len(merged) == 4 and len(files) > 4
    for f in files:
        keys = [tuple(r) for r in spark.read.parquet(f).select("table_name", "row_key").collect()]
        assert keys == sorted(set(keys))


def test_a_replay_of_what_is_merged_is_not_folded(spark, tmp_path, monkeypatch):
    where, folded, real = str(tmp_path / "t"), [], levelled._folded
    put = lambda i: levelled.upsert(batch(spark, [("n", f"k{j}", i, "1") for j in range(50)]), where, "b", i, ["n"], buckets=2)
    for i in range(3):
        put(i)
    levelled.compact(spark, where, ["n"], max_runs=1)
    monkeypatch.setattr(levelled, "_folded", lambda rows, *a, **k: folded.append(rows.count()) or real(rows, *a, **k))
    put(0)
    assert folded == [0]
    put(2)                                              # the newest batch is not in the merged run
    assert folded == [0, 50]
    monkeypatch.undo()
    assert set(current(spark, where).values()) == {"3"}
