"""Mixing and the embedding join."""

import random
import re
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from intake.llm import embedding_join as E
from intake.llm import mixing as M

from .conftest import Sets


def test_quotas():
    got = M.quotas({"a": 100, "b": 100, "c": 100, None: 100})
    # weights 5, 2, 1, 5 of 600 words: a and the null source stop at 200, b and c share 200
    assert got == {"a": 200, None: 200, "b": Fraction(400, 3), "c": Fraction(200, 3)}
    assert M.quotas({}) == {} and M.quotas({"a": 0}) == {"a": 0}
    rng = random.Random(0)
    for _ in range(100):
        sizes = {f"s{i}": rng.randint(0, 50) for i in range(rng.randint(1, 9))}
        got = M.quotas(sizes)
        assert sum(got.values()) == Fraction(3, 2) * sum(sizes.values())
        assert all(got[s] <= 2 * sizes[s] for s in sizes)


def test_flow_repeats_only_what_it_must():
    flow = M.min_cost_flow({"ab": 10, "a": 10, "b": 10}, {"ab": ["a", "b"], "a": ["a"], "b": ["b"]}, {"a": 15, "b": 15})
    assert sum(flow.values()) == 30
    used = {p: sum(w for (q, _), w in flow.items() if q == p) for p in ("ab", "a", "b")}
    assert used == {"ab": 10, "a": 10, "b": 10}
    flow = M.min_cost_flow({"a": 10}, {"a": ["a"]}, {"a": 100})
    assert flow == {("a", "a"): 20}


def test_flow_against_all_flows():
    """Least convex cost over every whole flow of a small instance."""
    rng = random.Random(3)
    for _ in range(30):
        cap = {"x": rng.randint(0, 3), "y": rng.randint(0, 3), "z": rng.randint(0, 3)}
        members = {"x": ["a"], "y": ["a", "b"], "z": ["b"]}
        wanted = {"a": rng.randint(0, 6), "b": rng.randint(0, 6)}
        best = None
        for xa in range(2 * cap["x"] + 1):
            for ya in range(2 * cap["y"] + 1):
                for yb in range(2 * cap["y"] - ya + 1):
                    for zb in range(2 * cap["z"] + 1):
                        if xa + ya <= wanted["a"] and yb + zb <= wanted["b"]:
                            cost = sum(max(0, u - cap[p]) for p, u in (("x", xa), ("y", ya + yb), ("z", zb)))
                            best = max(best or (-1, 0), (xa + ya + yb + zb, -cost))
        flow = M.min_cost_flow(cap, members, wanted)
        used = {p: sum(w for (q, _), w in flow.items() if q == p) for p in cap}
        assert (sum(flow.values()), -sum(max(0, used[p] - cap[p]) for p in cap)) == best


def test_fill():
    rng = random.Random(4)
    for _ in range(200):
        sizes = [rng.randint(0, 40) for _ in range(rng.randint(1, 30))]
        room = rng.randint(0, sum(sizes))
        off = abs(sum(s for s, p in zip(sizes, M.fill(sizes, room)) if p) - room)
        assert off <= max(sizes)
    assert M.fill([], 5) == [] and M.fill([3, 3], 0) == [False, False]


@pytest.mark.parametrize("last", [512, 8])
def test_mix(spark, monkeypatch, last):
    monkeypatch.setattr(M, "LAST_ROWS", last)
    rng = random.Random(5)
    rows = [(i, rng.choice([None, 0, 1, 5, 30, 200]), rng.choice(["hot", "hot", "hot", "b", "c", None, "é"])) for i in range(900)]
    rows += [(3000, 50, "b")] * 4 + [(None, 20, "c")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, words long, source string")
    out = M.mix(docs, F.col("words"), F.array("source")).collect()
    assert len(out) == len(rows)
    taken, target, size = {}, {}, {}
    for r in out:
        s = r["sources"][0]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[s], target[s], size[s] = taken.get(s, 0) + r["taken"], r["target"], r["source_size"]
    want = M.quotas({s: sum(w or 0 for _, w, x in rows if x == s) for s in {x for _, _, x in rows}})
    for s in want:
        assert target[s] == pytest.approx(float(want[s])) and abs(taken[s] - target[s]) <= 200
    again = M.mix(docs.repartition(7), F.col("words"), F.array("source")).collect()
    key = lambda r: (str(r["doc_id"]), r["size"], r["taken"], str(r["sources"]))
    assert sorted(map(key, out)) == sorted(map(key, again))


def test_overlapping_sources_and_rows(spark):
    rows = [(i, 10, ["a", "b"] if i % 3 == 0 else ["a"] if i % 3 == 1 else ["b"]) for i in range(300)] + [(900, 10, []), (901, 10, None)]
    docs = spark.createDataFrame(rows, "doc_id long, words long, src array<string>")
    out = M.mix(docs, F.col("words"), F.col("src"), targets=lambda sizes: {"a": 1500, "b": 1500})
    got = out.groupBy("sources").agg(F.sum("taken").alias("t")).collect()
    by = {tuple(r["sources"] or ()): r["t"] for r in got}
    assert by[("a",)] == by[("b",)] == by[("a", "b")] == 1000 and by[()] == 0
    mixed = M.repeat_rows(docs, out, F.col("words"), F.col("src"))
    assert mixed.columns == docs.columns and mixed.count() == 300


def test_ids_repeated_across_sources(spark):
    """Rows of one id and size in two sources, one taken twice, the other not at all: each as often as its mix says."""
    rng = random.Random(8)
    rows = [(i % 60, rng.choice([3, 5]), rng.choice(["a", "b", "c", None]), f"t{i}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, words long, source string, note string")
    mixed = M.mix(docs, F.col("words"), F.array("source"))
    assert mixed.where("taken = 0").count() and mixed.where("taken > size").count()
    times = {}
    for r in mixed.collect():
        key = (r["doc_id"], r["size"], r["sources"][0])
        times.setdefault(key, set()).add(r["taken"] // r["size"])
    assert all(len(t) == 1 for t in times.values())
    out = {}
    for r in M.repeat_rows(docs, mixed, F.col("words")).collect():
        out[tuple(r)] = out.get(tuple(r), 0) + 1
    assert out == {r: n for r in rows if (n := min(times[r[:3]]))}
    assert max(out.values()) <= M.MOST


def test_the_query_routes_words_by_the_flow(spark, monkeypatch):
    from intake.llm import queries as Q
    from .conftest import SF

    calls, real = [], M.min_cost_flow
    monkeypatch.setattr(M, "min_cost_flow", lambda *a, **k: calls.append(len(a[0])) or real(*a, **k))
    out = Q.op7_mixing(spark, SF).collect()
    sources = {(r["source_size"], r["target"]) for r in out}
    assert calls and calls[0] >= len(sources) > 1


# --- embeddings

def brute(rows, cosine):
    sets, links = Sets(), {}
    good = [(i, l, np.array(v, float)) for i, l, v in rows if i is not None and l is not None and v and None not in v
            and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))]
    for i, _, _ in rows:
        if i is not None:
            sets.find(i)
            links.setdefault(i, 0)
    for x, (i, l, a) in enumerate(good):
        for j, m, b in good[x + 1:]:
            if l == m and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= cosine:
                links[i] += 1
                links[j] += 1
                sets.join(i, j)
    return {i: (links[i], sets.find(i), sets.find(i) == i) for i in links}


def vectors(dims=24, n=220, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        if i and rng.random() < 0.6:
            base = np.array(rows[int(rng.integers(0, len(rows)))][2]) + rng.normal(0, rng.choice([0, 0.05, 0.09]), dims)
        else:
            base = rng.normal(0, 1, dims)
        rows.append((i * 3 + 1, str(int(rng.integers(0, 3))), [float(x) for x in np.float32(base)]))
    return rows


@pytest.mark.parametrize("chunk,grid", [(4096, 1), (7, 1), (4096, 2)])
def test_vectors(spark, monkeypatch, chunk, grid):
    monkeypatch.setattr(E, "CHUNK", chunk)
    monkeypatch.setattr(E, "TILE", 16)
    rows = vectors()
    d = len(rows[0][2])
    rows += [(5000, "0", None), (5001, "0", [0.0] * d), (5002, "0", [None] + [1.0] * (d - 1)), (5003, "0", [float("nan")] * d),
             (5004, "0", [float("inf")] + [0.0] * (d - 1)), (5005, None, rows[0][2]), (5006, "0", []), (5007, "0", [1.0, 2.0]),
             (5008, "0", [2.0, 4.0]), (5009, "0", [1e200] * d), (5010, "0", [1e-200] * d)]
    docs = spark.createDataFrame([(i, l, v, "x", "y") for i, l, v in rows],
                                 "vec_id long, label string, embedding array<double>, rep string, n string")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in E.near_vectors(docs, 0.93, 8, grid).collect()}
    with np.errstate(over="ignore", under="ignore", invalid="ignore", divide="ignore"):
        want = brute([r for r in rows if r[0] not in (5009, 5010)], 0.93)
    assert {k: v for k, v in got.items() if k not in (5009, 5010)} == want
    assert got[5009] == (1, 5009, True) and got[5010] == (1, 5009, False)  # scaled first: no overflow


def near_threshold(cosine=0.93, dims=64, n=300):
    """Pairs built to lie at the threshold, where only the last bits decide, far from all others."""
    rng = np.random.default_rng(6)
    rows = []
    for i in range(n):
        a = rng.normal(0, 1, dims)
        a /= np.linalg.norm(a)
        side = rng.normal(0, 1, dims)
        side -= (side @ a) * a
        b = cosine * a + (1 - cosine ** 2) ** 0.5 * side / np.linalg.norm(side)
        rows += [(2 * i, "x", a.tolist()), (2 * i + 1, "x", (3 * b).tolist())]
    return rows


@pytest.mark.parametrize("chunk", [16384, 40])
def test_pairs_at_the_threshold_go_by_their_original_components(spark, monkeypatch, chunk):
    monkeypatch.setattr(E, "CHUNK", chunk)
    rows = near_threshold()
    docs = spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>")
    got = {r["vec_id"]: r["n_links"] for r in E.near_vectors(docs).collect()}
    want = {}
    for (i, _, a), (j, _, b) in zip(rows[::2], rows[1::2]):
        a, b = np.array(a), np.array(b)
        c = (a * b).sum() / np.sqrt((a * a).sum() * (b * b).sum())
        want |= {i: int(c >= 0.93), j: int(c >= 0.93)}
        assert abs(c - 0.93) < 1e-12
    assert 0 < sum(want.values()) < len(want)
    assert got == want


def test_a_pair_meets_in_one_cell():
    """Every pair in range of a block is at home or guest and host in just one cell, for each number of coordinates."""
    rng = np.random.default_rng(3)
    q = np.rint(rng.normal(0, 900, (400, 4))).astype(np.int16)
    share = 600.0 ** 2
    far = ((q[:, None].astype(float) - q[None]) ** 2).sum(axis=2)
    for g in (1, 2, 3):
        met = {}
        rows, cells, home = E.placements(q, share, g)
        at = {}
        for r, c, h in zip(rows.tolist(), map(tuple, cells.tolist()), home.tolist()):
            at.setdefault(c, []).append((r, h))
        for group in at.values():
            for k, (x, hx) in enumerate(group):
                for y, hy in group[k + 1:]:
                    if hx or hy:
                        met[min(x, y), max(x, y)] = met.get((min(x, y), max(x, y)), 0) + 1
        x, y = np.nonzero(np.triu(far <= share, 1))
        assert len(x) > 100 and all(met[p] == 1 for p in zip(x.tolist(), y.tolist()))


def test_the_range_join_finds_its_pairs_and_evaluates_few_distances():
    rng = np.random.default_rng(8)
    v = pd.Series([x.tolist() for x in rng.normal(0, 1, (1500, 64))] + [[1.0] * 64, [1.0] * 63 + [1.01]])
    q = E.turned(v)
    counted = []
    for (lo, hi), share in zip(E.blocks(64), E.shares(64, E.BLOCK_DIMS, 0.93)):
        own = q[:, lo:hi].astype(float)
        far = ((own[:, None] - own[None]) ** 2).sum(axis=2)
        want = set(zip(*(x.tolist() for x in np.nonzero(np.triu(far <= share, 1)))))
        got = [(min(p), max(p)) for x, y in E.close_pairs(q[:, lo:hi], share, tile=64, count=counted) for p in zip(x.tolist(), y.tolist())]
        assert len(got) == len(set(got)) and set(got) == want and (1500, 1501) in want
    assert sum(counted) < 0.2 * len(q) * (len(q) - 1) / 2


def test_given_vectors_need_fewer_distances_than_pairs(spark):
    """Every label of the largest given table, blocks taken together."""
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").toPandas()
    for _, part in rows.groupby("label"):
        q, counted = E.turned(part["embedding"]), []
        for (lo, hi), share in zip(E.blocks(64), E.shares(64, E.BLOCK_DIMS, 0.93)):
            for _ in E.close_pairs(q[:, lo:hi], share, count=counted):
                pass
        assert sum(counted) < 0.2 * len(q) * (len(q) - 1) / 2


def test_repeated_and_missing_ids(spark):
    v = [1.0, 2.0, 3.0]
    docs = spark.createDataFrame([(1, 0, v), (1, 0, v), (2, 0, v), (None, 0, v), (None, 0, v)], "vec_id long, label int, embedding array<float>")
    got = sorted(map(tuple, E.near_vectors(docs).collect()), key=str)
    assert got == [(1, 1, 1, True), (2, 1, 1, False), (None, 0, None, True)]
    assert E.near_vectors(docs.where("false")).count() == 0


@pytest.mark.parametrize("most", [0, 10_000])
def test_lone_patterns_need_no_flow(most, monkeypatch):
    """Quotas beyond ``MAX_PATTERNS`` give what the flow gives."""
    monkeypatch.setattr(M, "MAX_PATTERNS", most)
    rng = random.Random(12)
    for _ in range(200):
        members = {s: [s] for s in "abcdef" if rng.random() < 0.8}
        members |= {p: list(p) for p in ("ab", "bc", "abc") if rng.random() < 0.3}
        capacity = {p: rng.randint(0, 20) for p in members}
        wanted = {s: rng.randint(0, 40) for s in sorted({s for x in members.values() for s in x})}
        want = dict.fromkeys(capacity, 0)
        for (p, _), words in M.min_cost_flow(capacity, members, wanted).items():
            want[p] += words
        got = M.given_words(capacity, members, wanted)
        assert sum(got.values()) == sum(want.values())
        assert sum(max(0, got[p] - capacity[p]) for p in got) == sum(max(0, want[p] - capacity[p]) for p in want)
        assert all(got[s] == want[s] for s in members if not any(len(p) > 1 and s in p for p in members))


@pytest.mark.parametrize("most", [20, 10_000])
def test_more_sources_than_the_flow_may_have_patterns(spark, monkeypatch, most):
    monkeypatch.setattr(M, "MAX_PATTERNS", most)
    rows = [(i, 1 + i % 9, [f"s{i % 300}"]) for i in range(1500)] + [(2000 + i, 5, ["s1", "s2"]) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, words long, src array<string>")
    out = M.mix(docs, F.col("words"), F.col("src")).collect()
    assert sorted(r["doc_id"] for r in out) == [r[0] for r in rows]
    assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in out)
    for s in ("s7", "s250", "s299"):
        mine = [r for r in out if r["sources"] == [s]]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= max(r["size"] for r in mine)


def test_repeated_rows_are_one_row_of_the_last_step(spark):
    rows = [(None, 3, "a")] * 3000 + [(i, 3, "a") for i in range(40)] + [(i, 2, "b") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, words long, source string")
    out = M.mix(docs, F.col("words"), F.array("source"))
    got = out.collect()
    assert len(got) == len(rows) and len({r["taken"] for r in got if r["doc_id"] is None}) == 1
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"FlatMapGroupsInPandas.*\n[^\n]*Aggregate \[pattern#\d+, u#\d+L\]", re.sub(r"\n[^\n]*Project[^\n]*", "", plan)), plan
