"""Loop equivalence for the batch operators.

A small pure-Python copy of the documented scan rules is run on random
inventories; every random case is its own feed, so one Spark run checks many
cases at once (feeds are independent).
"""

import datetime as dt
import random

import pytest

from intake.config import ScanConfig
from intake.operators import batching
from intake.operators.batching import batch_plan, threshold_batch, threshold_trigger

AS_OF = dt.datetime(2024, 1, 1, 1, 0, 0)


def make_cases(seed, n_feeds=60):
    rnd = random.Random(seed)
    rows = []
    for f in range(n_feeds):
        n = rnd.choice([1, 2, 3, 5, 8, 13, 30])
        for i in range(n):
            length = rnd.choice([0, 1, 3, 8, 10, 25, 100, rnd.randint(0, 60)])
            mtime = AS_OF - dt.timedelta(seconds=rnd.randint(0, 300))
            rows.append((f"f{f}", f"/in/f{f}/file{i:03d}", length, mtime, rnd.random() < 0.75))
    return rows


def loop_scan(files, cfg):
    """One scan of a feed by the documented rules (files already in order):
    a file is looked at while no limit has been reached by the files before
    it; the first file is always looked at."""
    def reached(taken, seen_bytes):
        return ((cfg.max_files > -1 and taken >= cfg.max_files)
                or (cfg.max_size > -1 and seen_bytes >= cfg.max_size))

    looked, taken, seen_bytes, any_old = {}, 0, 0, False
    for path, length, mtime, admitted in files:
        if looked and reached(taken, seen_bytes):
            break
        looked[path] = admitted
        taken += int(admitted)
        seen_bytes += length
        any_old = any_old or (cfg.max_age > -1 and (AS_OF - mtime).total_seconds() * 1000 > cfg.max_age)
    fired = taken >= cfg.max_files or any_old or (cfg.max_size > -1 and seen_bytes >= cfg.max_size)
    return looked, fired


def loop_cut(files, cfg):
    """Greedy cut of the admitted files into batches (one pass)."""
    out, batch, n, size = {}, 0, 0, 0
    for path, length, _mtime, admitted in files:
        if not admitted:
            continue
        if n > 0 and ((cfg.max_files > -1 and n >= cfg.max_files) or (cfg.max_size > -1 and size >= cfg.max_size)):
            batch, n, size = batch + 1, 0, 0
        n += 1
        size += length
        out[path] = batch
    return out


def batch_stats(rows, cut, cfg):
    """(files, bytes, fired) of each file's batch, from a cut."""
    info = {p: (f, l, m) for f, p, l, m, _a in rows}
    per = {}
    for path, b in cut.items():
        feed, length, mtime = info[path]
        n, size, old = per.get((feed, b), (0, 0, False))
        aged = cfg.max_age > -1 and (AS_OF - mtime).total_seconds() * 1000 > cfg.max_age
        per[(feed, b)] = (n + 1, size + length, old or aged)
    out = {}
    for path, b in cut.items():
        n, size, old = per[(info[path][0], b)]
        fired = n >= cfg.max_files or old or (cfg.max_size > -1 and size >= cfg.max_size)
        out[path] = (n, size, fired)
    return out


def by_feed(rows):
    feeds = {}
    for feed, path, length, mtime, admitted in rows:
        feeds.setdefault(feed, []).append((path, length, mtime, admitted))
    for v in feeds.values():
        v.sort(key=lambda r: (r[2], r[0]))
    return feeds


CONFIGS = [
    ScanConfig(max_files=10, max_size=50, max_age=120_000),
    ScanConfig(max_files=-1, max_size=30),
    ScanConfig(max_files=3, max_size=-1),
    ScanConfig(max_files=1, max_size=1_000_000_000, max_age=10_000),
    ScanConfig(max_files=0, max_size=-1),
    ScanConfig(max_files=4, max_size=0),
    ScanConfig(max_files=2, max_size=20),
    ScanConfig(),
]


@pytest.mark.parametrize("cfg", CONFIGS, ids=lambda c: f"mf{c.max_files}_ms{c.max_size}_age{c.max_age}")
def test_threshold_batch_matches_loop(spark, cfg):
    rows = make_cases(hash((cfg.max_files, cfg.max_size)) & 0xFFFF)
    df = spark.createDataFrame(rows, "feed string, path string, length long, mtime timestamp_ntz, admitted boolean")
    scan = threshold_batch(df, cfg, AS_OF, chunks=5)
    got = {r["path"]: (r["scanned"], r["taken"]) for r in scan.collect()}
    trig = {r["feed"]: r["fired"] for r in threshold_trigger(scan, cfg).collect()}
    for feed, files in by_feed(rows).items():
        want, fired = loop_scan(files, cfg)
        for path, _l, _m, admitted in files:
            scanned, taken = got[path]
            assert scanned == (path in want), (feed, path)
            assert taken == (path in want and admitted), (feed, path)
        assert trig[feed] == fired, feed


@pytest.mark.parametrize("cfg", CONFIGS, ids=lambda c: f"mf{c.max_files}_ms{c.max_size}")
def test_batch_plan_matches_greedy_cut(spark, cfg):
    rows = make_cases(7 + cfg.max_files * 31 + cfg.max_size)
    df = spark.createDataFrame(rows, "feed string, path string, length long, mtime timestamp_ntz, admitted boolean")
    plan = batch_plan(df, cfg, AS_OF, chunks=6, chunk_rows=4).collect()
    got = {r["path"]: r["batch_no"] for r in plan}
    want = {}
    for files in by_feed(rows).values():
        want.update(loop_cut(files, cfg))
    assert got == want
    assert len(plan) == len(want)
    assert {r["path"]: (r["batch_files"], r["batch_bytes"], r["fired"]) for r in plan} == batch_stats(rows, want, cfg)


def test_batch_plan_hot_feed_is_spread(spark):
    """One feed with most files: the running totals use many range slices,
    and the cut still equals the greedy loop."""
    rnd = random.Random(3)
    rows = [("hot", f"/in/hot/{i:05d}", rnd.randint(0, 40), AS_OF - dt.timedelta(seconds=i), True)
            for i in range(3000)]
    rows += [("cold", f"/in/cold/{i:03d}", 5, AS_OF, True) for i in range(20)]
    cfg = ScanConfig(max_files=25, max_size=300)
    df = spark.createDataFrame(rows, "feed string, path string, length long, mtime timestamp_ntz, admitted boolean")
    got = {r["path"]: r["batch_no"] for r in batch_plan(df, cfg, AS_OF, chunks=16, chunk_rows=97).collect()}
    want = {}
    for files in by_feed(rows).values():
        want.update(loop_cut(files, cfg))
    assert got == want


def test_running_totals_slices_hot_group(spark):
    from pyspark.sql import functions as F
    from intake.operators.prefix import running_totals
    df = spark.range(5000).select(F.lit("k").alias("g"), F.col("id").alias("o"), F.lit(2).cast("long").alias("x"))
    out = running_totals(df, ["g"], ["o"], ["x"], chunks=8)
    bad = out.where((F.col("seq") != F.col("o") + 1) | (F.col("x_before") != F.col("o") * 2)).count()
    assert bad == 0


@pytest.mark.parametrize("cfg", [ScanConfig(max_files=3, max_size=40), ScanConfig(max_files=-1, max_size=40)],
                         ids=["chunks", "doubling"])
def test_batch_plan_keeps_files_without_feed(spark, cfg):
    rows = [(None, f"/in/x{i}", 15, AS_OF, True) for i in range(7)]
    df = spark.createDataFrame(rows, "feed string, path string, length long, mtime timestamp_ntz, admitted boolean")
    got = {r["path"]: r["batch_no"] for r in batch_plan(df, cfg, AS_OF, chunk_rows=4).collect()}
    want = loop_cut([(p, l, m, a) for _f, p, l, m, a in sorted(rows, key=lambda r: r[1])], cfg)
    assert got == want


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=50), min_size=1, max_size=40),
       st.integers(min_value=1, max_value=12), st.integers(min_value=1, max_value=120))
def test_next_starts_matches_definition(lengths, mf, ms):
    """next(i): the batch opened at i closes at the first file where it holds
    mf files or >= ms bytes (or at the end); the next batch starts after it."""
    from intake.operators.batching import _next_starts
    got = list(_next_starts(lengths, mf, ms))
    for i in range(len(lengths)):
        n = size = 0
        j = i
        while j < len(lengths):
            n, size = n + 1, size + lengths[j]
            if n >= mf or size >= ms:
                break
            j += 1
        assert got[i] == min(j, len(lengths) - 1) + 1, (i, lengths, mf, ms)


def test_checkpoints_go_to_the_session_folder(spark):
    import glob
    import os
    from pyspark.sql import functions as F
    from intake.operators.prefix import running_totals
    from intake.session import checkpoint_dir
    folder = checkpoint_dir(spark)
    assert folder == spark.sparkContext.getCheckpointDir()
    local = folder.replace("file:", "", 1)
    before = set(glob.glob(os.path.join(local, "*")))
    df = spark.range(100).select(F.lit("g").alias("g"), F.col("id").alias("o"))
    running_totals(df, ["g"], ["o"], chunks=2).count()
    assert set(glob.glob(os.path.join(local, "*"))) - before   # a new rdd-* checkpoint folder


def test_cluster_session_without_checkpoint_dir_is_refused():
    from unittest import mock
    from intake.session import checkpoint_dir
    sc = mock.Mock()
    sc.getCheckpointDir.return_value = None
    sc.getConf.return_value.get.return_value = None
    sc.master = "yarn"
    with pytest.raises(RuntimeError):
        checkpoint_dir(mock.Mock(sparkContext=sc))


PER_FEED = [ScanConfig(max_files=3, max_size=40, max_age=120_000), ScanConfig(max_files=-1, max_size=30),
            ScanConfig(max_files=2, max_size=-1), ScanConfig(max_files=0), ScanConfig()]


def test_per_feed_limits_match_loop(spark):
    rows = make_cases(99, n_feeds=40)
    feeds = sorted({r[0] for r in rows})
    prof = {f: PER_FEED[i % len(PER_FEED)] for i, f in enumerate(feeds) if i % 7 != 6}  # some use the default
    default = ScanConfig(max_files=4, max_size=60)
    limits = spark.createDataFrame([(f, c.max_files, c.max_size, c.max_age) for f, c in prof.items()],
                                   "feed string, max_files long, max_size long, max_age long")
    df = spark.createDataFrame(rows, "feed string, path string, length long, mtime timestamp_ntz, admitted boolean")
    scan = threshold_batch(df, default, AS_OF, chunks=5, limits=limits)
    got = {r["path"]: r["scanned"] for r in scan.collect()}
    trig = {r["feed"]: r["fired"] for r in threshold_trigger(scan, default, limits).collect()}
    plan = {r["path"]: r["batch_no"] for r in batch_plan(df, default, AS_OF, chunk_rows=5, limits=limits).collect()}
    for feed, files in by_feed(rows).items():
        cfg = prof.get(feed, default)
        want, fired = loop_scan(files, cfg)
        assert {p: got[p] for p, *_ in files} == {p: p in want for p, *_ in files}, feed
        assert trig[feed] == fired, feed
        cut = loop_cut(files, cfg)
        assert {p: plan[p] for p in cut} == cut and all(p in cut for p in plan if p.startswith(f"/in/{feed}/")), feed


def test_large_file_limit_goes_to_doubling_and_matches(spark):
    """max_files above chunk_rows: slices would exceed their bound, so the
    doubling path (with the file cap) cuts these feeds."""
    rows = make_cases(5, n_feeds=30)
    cfg = ScanConfig(max_files=6, max_size=45)
    df = spark.createDataFrame(rows, "feed string, path string, length long, mtime timestamp_ntz, admitted boolean")
    got = {r["path"]: r["batch_no"] for r in batch_plan(df, cfg, AS_OF, chunk_rows=3).collect()}
    want = {}
    for files in by_feed(rows).values():
        want.update(loop_cut(files, cfg))
    assert got == want


def plain_walk(maps):
    """entry and offset of every slice, one slice after the other."""
    at, n, out = 1, 0, {}
    for chunk in sorted(maps):
        out[chunk] = (at, n)
        if at in maps[chunk]:
            at, n = maps[chunk][at][0], n + maps[chunk][at][1]
    return out


@pytest.mark.parametrize("fan", [2, 3, 7, 1000])
def test_slices_compose_in_any_grouping(spark, fan, monkeypatch):
    """Random maps of slices of 10 files, composed level by level, against the plain walk; no group is larger than ``fan`` slices."""
    rnd = random.Random(fan)
    rows, want = [], {}
    for feed, n in (("a", 1), ("b", 5), ("hot", 60), (None, 23)):
        maps = {c: {10 * c + 1 + e: (min(10 * (c + 1) + rnd.randint(1, 4), 10 * n + 1), rnd.randint(1, 9)) for e in range(4)} for c in range(n)}
        rows += [(feed, c, e, x, k) for c, m in maps.items() for e, (x, k) in m.items()]
        want |= {(feed, c): v for c, v in plain_walk(maps).items()}
    table = spark.createDataFrame(rows, "feed string, _chunk long, entry long, exit long, starts long").repartition(3)

    def bounded(pdf, *a):
        assert pdf["_chunk"].nunique() <= fan, "a group holds more than its slices"
        return real(pdf, *a)

    real = batching._through
    monkeypatch.setattr(batching, "_through", bounded)
    got = {(r["feed"], r["_chunk"]): (r["entry"], r["offset"]) for r in batching.compose_slices(table, 60, fan).collect()}
    assert got == want


def test_a_feed_of_many_slices_matches_the_walk(spark):
    """One feed of 10^6 files in 1,000 slices: composed in two levels, equal to the greedy cut."""
    import numpy as np
    from pyspark.sql import functions as F

    n, cfg = 1_000_000, ScanConfig(max_files=20, max_size=900, max_age=-1)
    files = spark.range(n).select(
        F.lit("hot").alias("feed"), F.format_string("/in/%09d", "id").alias("path"), F.pmod(F.hash("id"), F.lit(100)).cast("long").alias("length"),
        F.lit(AS_OF).cast("timestamp_ntz").alias("mtime"), F.lit(True).alias("admitted"), "id")
    lengths = np.array([r["length"] for r in files.select("id", "length").orderBy("id").collect()])
    want, batch, count, size = np.zeros(n, np.int64), 0, 0, 0
    for i, length in enumerate(lengths.tolist()):
        if count and (count >= 20 or size >= 900):
            batch, count, size = batch + 1, 0, 0
        count, size = count + 1, size + length
        want[i] = batch
    plan = batch_plan(files.drop("id"), cfg, AS_OF, chunk_rows=1000).select("seq", "batch_no").toPandas()
    got = np.full(n, -1)
    got[plan["seq"].to_numpy() - 1] = plan["batch_no"].to_numpy()
    assert len(plan) == n and (got == want).all()
