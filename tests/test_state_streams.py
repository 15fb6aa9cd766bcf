"""Quarantine and redelivery as stream state: restarts, timers to the millisecond, bounded deliveries."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from intake.streaming.state import PROVIDER, doubling_backoff, quarantine_stays, redelivery_actions, run_to_table

T0 = dt.datetime(2024, 1, 1)
FAILURES = "path string, failed_at timestamp_ntz, reason string"
OUTCOMES = "work_id string, attempt int, at timestamp_ntz, status string"


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


class Steps:
    """A stream fed step by step, stopped and started again for each."""

    def __init__(self, spark, root, schema, build):
        self.spark, self.root, self.schema, self.build, self.n = spark, str(root), schema, build, 0

    def feed(self, rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.parquet(f"{self.root}/in/{self.n}")
        self.n += 1
        stream = self.spark.readStream.schema(self.schema).option("recursiveFileLookup", "true").parquet(f"{self.root}/in")
        run_to_table(self.build(stream), f"{self.root}/out", f"{self.root}/ck").awaitTermination()
        return self.spark.read.parquet(f"{self.root}/out").collect()


def test_a_path_is_released_at_exactly_the_ttl(spark, tmp_path):
    before = spark.conf.get(PROVIDER, None)
    s = Steps(spark, tmp_path, FAILURES, lambda st: quarantine_stays(st, 100_000, "0 seconds"))
    assert s.feed([("a", at(0), "x"), ("b", at(0.0005), "x"), ("clock", at(99.999), None)]) == []
    got = s.feed([("clock2", at(100), None)])               # a restarted stream, watermark exactly at a's end
    assert [(r["path"], r["quarantined_at"], r["released_at"]) for r in got] == [("a", at(0), at(100))]
    got = s.feed([("clock2", at(100.001), None), (None, at(100.002), None), ("q", None, None)])
    assert {(r["path"], r["released_at"]) for r in got} == {("a", at(100)), ("b", at(100.0005))}
    assert spark.conf.get(PROVIDER, None) == before


def test_a_failure_again_restarts_the_interval(spark, tmp_path):
    s = Steps(spark, tmp_path, FAILURES, lambda st: quarantine_stays(st, 100_000, "0 seconds"))
    s.feed([("a", at(0), "one")])
    s.feed([("a", at(50), "two"), ("a", at(50), "three"), ("clock", at(120), None)])
    got = s.feed([("clock", at(149.5), None)])
    assert got == []                                         # without the second failure it would be out at 100
    got = s.feed([("a", at(150), "next stay"), ("clock", at(150), None)])
    assert [tuple(r) for r in got] == [("a", at(0), at(150), 3, "two")]
    got = s.feed([("clock", at(1000), None)])
    assert {(r["path"], r["quarantined_at"], r["released_at"], r["n_failures"]) for r in got if r["path"] == "a"} == {
        ("a", at(0), at(150), 3), ("a", at(150), at(250), 1)}


def test_redelivery_by_hand(spark, tmp_path):
    pause = doubling_backoff(10_000, 30_000)
    s = Steps(spark, tmp_path, OUTCOMES, lambda st: redelivery_actions(st, 3, pause, "0 seconds"))
    assert s.feed([("w", 1, at(0), "failed"), ("good", 1, at(0), "ok"), ("clock", 1, at(9.9), "failed")]) == [
        ("good", "done", 1, at(0))]
    new = lambda rows, old: sorted(set(map(tuple, rows)) - set(old))
    seen = []

    def step(rows):
        got = s.feed(rows)
        out = new(got, seen)
        assert len(got) == len(seen) + len(out)               # every action once
        seen.extend(out)
        return out

    assert step([("w", 1, at(10), "failed"), ("good", 1, at(10), "failed")]) == [     # reported again: nothing new
        ("good", "done", 1, at(0)), ("w", "deliver", 2, at(10))]
    assert step([("w", 2, at(12), "failed"), ("clock", 2, at(31), "ok")]) == [("clock", "done", 2, at(31))]   # reported before its timer
    assert step([("x", 1, at(33), "ok")]) == [("w", "deliver", 3, at(32)), ("x", "done", 1, at(33))]
    assert step([("w", 3, at(40), "failed"), ("w", 2, at(41), "failed")]) == [("w", "dead_letter", 3, at(40))]
    assert step([("w", 3, at(500), "ok"), ("x", 9, at(900), "failed")]) == []           # over is over


def test_redelivery_is_bounded(spark, tmp_path):
    """Random reports, many of them repeated: at most ``max_attempts`` deliveries, one end per item, none after it."""
    rnd = random.Random(5)
    s = Steps(spark, tmp_path, OUTCOMES, lambda st: redelivery_actions(st, 4, doubling_backoff(1000, 4000), "0 seconds"))
    fate = {f"w{i}": rnd.choice([1, 2, 3, 4, None]) for i in range(30)}      # the attempt that works
    tries, now, rows = dict.fromkeys(fate, 1), 0, []
    todo = set(fate)
    for _ in range(6):
        reports = []
        for w in todo:
            now += 0.01
            reports += [(w, tries[w], at(now), "ok" if fate[w] == tries[w] else "failed")] * rnd.randint(1, 3)
        now += 10
        rows = s.feed(reports + [("clock", 1, at(now), "ok")])
        todo = set()
        for r in rows:
            if r["action"] == "deliver" and r["attempt"] == tries.get(r["work_id"], 0) + 1:
                tries[r["work_id"]] += 1
                todo.add(r["work_id"])
    for w, works in fate.items():
        mine = [(r["action"], r["attempt"]) for r in rows if r["work_id"] == w]
        last = works or 4
        assert sorted(mine) == sorted([("deliver", k) for k in range(2, last + 1)] + [("done" if works else "dead_letter", last)])


def test_settings_are_checked(spark):
    with pytest.raises(ValueError):
        redelivery_actions(spark.createDataFrame([], OUTCOMES), 0, doubling_backoff(1, 1))
    assert [doubling_backoff(10, 35)(n) for n in (1, 2, 3, 99)] == [10_000, 20_000, 35_000, 35_000]


def test_stamps_do_not_depend_on_the_zone(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        s = Steps(spark, tmp_path, FAILURES, lambda st: quarantine_stays(st, 100_000, "0 seconds"))
        got = s.feed([("a", dt.datetime(2024, 3, 10, 2, 30), "in the gap"), ("clock", dt.datetime(2024, 3, 10, 5), None)])
        assert [(r["path"], r["released_at"]) for r in got] == [("a", dt.datetime(2024, 3, 10, 2, 31, 40))]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
