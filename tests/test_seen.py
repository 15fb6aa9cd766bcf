"""The store of seen records: filters, replays, redelivery, merging."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from intake.sinks import seen
from intake.sinks.live import live_current
from intake.streaming.feed import ingest_stream


def test_filters_forget_nothing():
    rng = np.random.default_rng(1)
    keys = rng.integers(-2 ** 63, 2 ** 63 - 1, (20_000, 2))
    blob = seen.bloom(keys)
    assert seen.may_hold(blob, keys).all() and len(blob) <= 20_000 * seen.BITS / 8 + 8
    others = rng.integers(-2 ** 63, 2 ** 63 - 1, (20_000, 2))
    assert seen.may_hold(blob, others).mean() < 0.01
    assert not seen.may_hold(seen.bloom(keys[:0]), others).any()


def frame(spark, ids):
    return spark.createDataFrame([(i, f"v{i}") for i in ids], "id long, v string")


def take(spark, folder, ids, tag):
    return sorted((r["id"] for r in seen.new_records(frame(spark, ids), ["id"], folder, tag, buckets=5).collect()), key=lambda x: (x is not None, x))


def test_records_come_once(spark, tmp_path):
    folder = str(tmp_path / "seen")
    assert take(spark, folder, [1, 2, 3, 3, None, None], "b0") == [None, 1, 2, 3]
    assert take(spark, folder, [1, 2, 3, 3, None, None], "b0") == [None, 1, 2, 3]     # a replay gives the same
    assert take(spark, folder, [3, 4, None], "b1") == [4]
    assert take(spark, folder, [], "b2") == []
    assert take(spark, folder, list(range(1, 6)), "b3") == [5]
    assert take(spark, folder, [3, 4, None], "b1") == [4]
    # a replay that lost a record gives it free again
    assert take(spark, folder, [1, 2, 3], "b0") == [1, 2, 3]
    assert take(spark, folder, [None, 9], "b4") == [None, 9]


def test_merging_keeps_every_id(spark, tmp_path):
    folder = str(tmp_path / "seen")
    for k in range(5):
        assert take(spark, folder, range(10 * k, 10 * k + 12), f"b{k}") == list(range(10 * k + (2 if k else 0), 10 * k + 12))
    assert seen.compact_seen(spark, folder, "b4", max_runs=4) == 0
    assert seen.compact_seen(spark, folder, "b4", max_runs=3) == 4
    assert sorted(os.listdir(f"{folder}/ids")) == ["batch_id=b3~merged", "batch_id=b4"] == sorted(os.listdir(f"{folder}/filters"))
    assert take(spark, folder, range(0, 60), "b5") == list(range(52, 60))
    assert take(spark, folder, range(40, 52), "b4") == list(range(42, 52))             # the last batch may still be replayed
    assert seen.compact_seen(spark, folder, "b6", max_runs=1) == 3
    assert take(spark, folder, range(0, 61), "b6") == [60]


def test_only_runs_that_may_hold_ids_are_read(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "seen")
    for k in range(3):
        take(spark, folder, range(100 * k, 100 * k + 100), f"b{k}")
    ids = seen._hashed(frame(spark, [105]).select(seen.record_key(["id"]).alias("rid")), 5)
    bucket = ids.first()["bucket"]
    old = seen.seen_before(ids, folder, "b9")
    files = old._jdf.queryExecution().optimizedPlan().collectLeaves()
    assert [r["rid"] for r in old.collect()] == ['{"id":105}']
    read = [f for f in old.inputFiles() if "/ids/" in f]
    assert read and all(f"bucket={bucket}" in f and "batch_id=b1/" in f for f in read) and files is not None
    assert seen.seen_before(seen._hashed(frame(spark, [10 ** 9]).select(seen.record_key(["id"]).alias("rid")), 5), folder, "b9").count() == 0


def test_stream_counts_a_redelivered_file_once(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    (src / "a.csv").write_text("1,click\n2,click\n3,view\n")

    def to_entries(df):
        return df.select(F.lit("n").alias("table_name"), F.col("kind").alias("row_key"), F.lit("f").alias("family"), F.lit("q").alias("qualifier"),
                         F.lit("2024-01-01").cast("timestamp_ntz").alias("ts"), F.lit("1").alias("value"), "id")

    def run(checkpoint):
        ingest_stream(spark, str(src), "csv", "id long, kind string", str(tmp_path / checkpoint), str(tmp_path / "t"), to_entries, sum_tables=["n"],
                      record=["id"], seen_dir=str(tmp_path / "seen"), ids=["id"], available_now=True, max_files=1).awaitTermination()
        return {r["row_key"]: r["value"] for r in live_current(spark, str(tmp_path / "t"), ["n"]).collect()}

    with pytest.raises(ValueError):
        ingest_stream(spark, str(src), "csv", "id long", "c", "t", to_entries, seen_dir="s")
    assert run("ck") == {"click": "2", "view": "1"}
    (src / "a-again.csv").write_text("1,click\n2,click\n3,view\n4,view\n")               # the same and one more
    assert run("ck") == {"click": "2", "view": "2"}
    assert run("other-checkpoint") == {"click": "2", "view": "2"}                        # all files again
