"""Trees listed by tasks, snapshots and their differences."""

import os

import pytest

from intake.sinks.listing import snapshots, take_snapshot
from intake.sources import landing_inventory
from intake.sources.walk import listing_diff, walk


def tree(root, folders=3, depth=2):
    n = 0
    for path in [root] + [root / "/".join(f"d{(i >> k) % folders}" for k in range(level)) for level in range(1, depth + 1) for i in range(folders ** level)]:
        path.mkdir(parents=True, exist_ok=True)
        for name in ("a.txt", ".hidden", "_under", "with space+%.txt", "empty"):
            (path / name).write_text("" if name == "empty" else name * (n % 3 + 1))
            n += 1
    return root


def plainly(root, keep=lambda name: True):
    out = {}
    for folder, dirs, names in os.walk(root):
        dirs[:] = [d for d in dirs if keep(d) and not os.path.islink(os.path.join(folder, d))]
        out |= {os.path.join(folder, n): os.path.getsize(os.path.join(folder, n)) for n in names if keep(n)}
    return out


@pytest.mark.parametrize("budget", [1, 7, 10_000])
def test_walk_finds_every_file_once(spark, tmp_path, budget):
    """Whatever the budget: with one entry a task, folder after folder is handed on."""
    root = tree(tmp_path / "t")
    os.symlink(root, root / "loop")                 # a link to a folder is not followed
    os.symlink(root / "a.txt", root / "link.txt")   # a link to a file is a file
    (root / "_folder").mkdir()
    (root / "_folder" / "x").write_text("x")
    got = walk(spark, str(root), budget=budget).collect()
    want = plainly(root)
    want[str(root / "link.txt")] = 5
    assert len(got) == len(want) and {r["path"]: r["length"] for r in got} == want
    assert all(r["mtime"] == os.stat(r["path"]).st_mtime_ns // 1000 and r["name"] == os.path.basename(r["path"]) for r in got)


def test_walk_options_and_inventory(spark, tmp_path):
    root = tree(tmp_path / "t")
    shown = lambda n: not n.startswith((".", "_"))
    assert {r["path"]: r["length"] for r in walk(spark, str(root), hidden=False).collect()} == plainly(root, shown)
    assert {r["name"] for r in walk(spark, str(root), recursive=False).collect()} == {n for n in os.listdir(root) if not n.startswith("d")}
    (tmp_path / "none").mkdir()
    assert walk(spark, str(tmp_path / "none")).count() == 0
    inv = landing_inventory(spark, str(root), recursive=True, feed="f", hidden=True)
    assert {r["path"][len("file:"):] for r in inv.collect()} == set(plainly(root))
    assert landing_inventory(spark, str(root), recursive=True, include_empty=False).where("length = 0").count() == 0
    with pytest.raises(ValueError):
        walk(spark, "unknown://store/x")


def test_differences(spark):
    schema = "path string, length long, mtime long"
    before = spark.createDataFrame([("same", 1, 1), ("longer", 1, 1), ("newer", 1, 1), ("gone", 1, 1)], schema)
    after = spark.createDataFrame([("same", 1, 1), ("longer", 2, 1), ("newer", 1, 2), ("new", 0, 1)], schema)
    got = {r["path"]: (r["status"], r["length"], r["old_length"]) for r in listing_diff(before, after).collect()}
    assert got == {"same": ("same", 1, 1), "longer": ("changed", 2, 1), "newer": ("changed", 1, 1), "gone": ("gone", None, 1), "new": ("new", 0, None)}


def test_snapshots_follow_a_folder(spark, tmp_path):
    root, state = tree(tmp_path / "t", 2, 1), str(tmp_path / "state")
    number, diff = take_snapshot(spark, str(root), state)
    assert number == 0 and {r["status"] for r in diff.collect()} == {"new"} and diff.count() == 15
    (root / "a.txt").write_text("other bytes")
    os.utime(root / "d0" / "a.txt", (1, 1))         # replaced by one of the same length
    (root / "d1" / "empty").unlink()
    (root / "d1" / "late").write_text("x")
    number, diff = take_snapshot(spark, str(root), state)
    got = {os.path.relpath(r["path"], root): r["status"] for r in diff.where("status <> 'same'").collect()}
    assert number == 1 and got == {"a.txt": "changed", "d0/a.txt": "changed", "d1/empty": "gone", "d1/late": "new"}
    # a run that broke off does not count, and only the newest are kept
    os.unlink(os.path.join(state, "listing", "snapshot=1", "_SUCCESS"))
    number, diff = take_snapshot(spark, str(root), state)
    assert number == 1 and diff.where("status <> 'same'").count() == 4
    for k in (2, 3, 4):
        number, diff = take_snapshot(spark, str(root), state)
        assert number == k and {r["status"] for r in diff.collect()} == {"same"}
    assert snapshots(spark, state) == [3, 4]
