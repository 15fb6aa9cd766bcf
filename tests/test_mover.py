"""Files moved by tasks: replays, clashes, files that are gone."""

import os

import pytest

from intake.sinks import mover
from intake.sources import landing_inventory

MOVES = "path string, target_path string, length long"


def test_moves_and_replay(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    for i in range(30):
        (src / f"{i} +%.txt").write_text("x" * i)
    out.mkdir()
    (out / "3 +%.txt").write_text("other")
    inv = landing_inventory(spark, str(src))
    rows = [(r["path"], f"file:{out}/{r['name']}", r["length"]) for r in inv.collect()]
    os.unlink(src / "5 +%.txt")
    rows += [(str(src / "7 +%.txt"), f"file:{out}/sub/same", 7), (str(src / "8 +%.txt"), f"file:{out}/sub/same", 8)]
    rows = [r for r in rows if r[0] not in (f"file:{src}/7 +%.txt", f"file:{src}/8 +%.txt")] + rows[:1] + [(None, "x", 1), ("x", None, 1)]
    plan = mover.plan_moves(spark.createDataFrame(rows, MOVES))
    got = {os.path.basename(r["path"]): r["status"] for r in mover.move_files(spark, plan, str(tmp_path / "state"), "r1").collect()}
    assert got.pop("3 +%.txt") == "clash" and got.pop("5 +%.txt") == "missing" and got.pop("8 +%.txt") == "clash"
    assert set(got.values()) == {"moved"} and len(got) == 27
    assert sorted(os.listdir(src)) == ["3 +%.txt", "8 +%.txt"] and (out / "sub" / "same").read_text() == "x" * 7
    assert (out / "3 +%.txt").read_text() == "other" and (out / "9 +%.txt").read_text() == "x" * 9
    # the same run again moves nothing, whatever it is given
    (src / "0 +%.txt").write_text("late")
    again = mover.move_files(spark, plan.limit(0), str(tmp_path / "state"), "r1")
    assert again.count() == 30 and (src / "0 +%.txt").exists()


def test_a_run_that_broke_off_is_finished(spark, tmp_path):
    src, out, state = tmp_path / "in", tmp_path / "out", str(tmp_path / "state")
    src.mkdir()
    for i in range(6):
        (src / str(i)).write_text("x" * i)
    plan = mover.plan_moves(spark.createDataFrame([(str(src / str(i)), str(out / str(i)), i) for i in range(6)], MOVES))
    plan.write.parquet(f"{state}/intents/run=r")             # intents are there, two files moved, no outcomes
    for i in (0, 4):
        assert mover.move_one(str(src / str(i)), str(out / str(i)), i, False) == "moved"
    (src / "2").unlink()
    got = {os.path.basename(r["path"]): r["status"] for r in mover.move_files(spark, plan, state, "r").collect()}
    assert got == {"0": "moved", "1": "moved", "2": "missing", "3": "moved", "4": "moved", "5": "moved"}
    assert sorted(os.listdir(out)) == ["0", "1", "3", "4", "5"] and os.listdir(src) == []


def test_unknown_stores_are_refused(spark, tmp_path):
    plan = mover.plan_moves(spark.createDataFrame([("odd://x/a", "odd://x/b", 1)], MOVES))
    with pytest.raises(ValueError):
        mover.move_files(spark, plan, str(tmp_path / "state"), "r")


def test_the_feeder_finishes_a_tick_that_broke_off_while_moving(spark, tmp_path, monkeypatch):
    import os
    import time

    import pytest

    from intake.config import FeederConfig, ScanConfig
    from intake.streaming import feeder

    land, flagged, state = tmp_path / "landing", tmp_path / "flagged", str(tmp_path / "state")
    land.mkdir()
    for i in range(6):
        (land / f"f{i}.txt").write_text("x" * (i + 1))
        os.utime(land / f"f{i}.txt", (1000, 1000))
    scan = ScanConfig(input_dir=str(land), max_files=-1, max_age=0)

    def run():
        q = feeder.feeder_stream(spark, str(land), state, scan, FeederConfig(f"file:{flagged}", "text", "d"), trigger_ms=500, move=True)
        until = time.time() + 120
        try:
            while q.isActive and time.time() < until and not any(p["durationMs"].get("addBatch") for p in q.recentProgress):
                time.sleep(0.2)
        finally:
            q.stop()
        if q.exception():
            raise q.exception()

    real = feeder.move_files

    def some(spark, moves, *rest):        # the intents are written and half of the files are gone when it breaks off
        real(spark, moves, *rest)
        for f in ("f0.txt", "f1.txt", "f2.txt"):
            os.rename(flagged / f, land / f)
        import shutil
        shutil.move(f"{state}/moves/outcomes", str(tmp_path / "lost-outcomes"))
        raise RuntimeError("lost here")

    with monkeypatch.context() as m:
        m.setattr(feeder, "move_files", some)
        with pytest.raises(Exception, match="lost here"):
            run()
    assert sorted(os.listdir(land)) == ["f0.txt", "f1.txt", "f2.txt"]
    run()
    assert os.listdir(land) == [] and sorted(f for f in os.listdir(flagged) if not f.startswith(".")) == [f"f{i}.txt" for i in range(6)]
    items = spark.read.parquet(f"{state}/work_items").collect()
    assert sorted(r["path"].rsplit("/", 1)[1] for r in items) == [f"f{i}.txt" for i in range(6)]
    assert {r["status"] for r in spark.read.parquet(f"{state}/moves/outcomes").collect()} == {"moved"}
