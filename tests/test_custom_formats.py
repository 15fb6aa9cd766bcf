"""File groups, formats that tasks read themselves, and inputs that fail one by one in one pass."""

import datetime as dt
import gzip
import os

import pytest
from pyspark.sql import functions as F

from intake.operators.shred import shred_entries
from intake.plans.lifecycle import DataType, ingest_items
from intake.sinks.framed import write_framed
from intake.sources import TypeSpec, landing_inventory, read_typed_feed
from intake.sources.entries import read_entries
from intake.sources.formats import FORMATS, FileFormat, Framed, register_format
from intake.sources.groups import file_groups, read_groups, rejected_files, whole_files

SCHEMA = "id long, kind string, amount double, day date, at timestamp_ntz, price decimal(12,3), tags array<string>"


def rows(n):
    import decimal
    return [(i, None if i % 7 == 0 else f"k{i % 3} ü\n", i / 3, dt.date(2024, 1, 1 + i % 28), dt.datetime(2024, 1, 1, 0, 0, i % 60, i),
             decimal.Decimal(i) / 8, [str(i)] * (i % 3)) for i in range(n)]


def listed(spark, folder):
    return landing_inventory(spark, str(folder)).select("path", "length")


def test_framed_round_trip(spark, tmp_path):
    df = spark.createDataFrame(rows(5000), SCHEMA).repartition(3)
    write_framed(df, str(tmp_path / "f"))
    assert sorted(os.listdir(tmp_path / "f")) == [f"part-{k:05d}.frm" for k in range(3)]     # no staging left
    back = read_groups(spark, listed(spark, tmp_path / "f"), "framed", SCHEMA)
    assert rejected_files(back).isEmpty()
    assert sorted(whole_files(back).drop("source_path").collect()) == sorted(df.collect())


def test_framed_damage(spark, tmp_path):
    df = spark.createDataFrame(rows(70), SCHEMA).withColumn("file", (F.col("id") / 10).cast("int"))
    write_framed(df.repartition("file").sortWithinPartitions("file", "id"), str(tmp_path), file_by="file")
    data = {k: (tmp_path / f"{k}.frm").read_bytes() for k in range(7)}
    (tmp_path / "0.frm").write_bytes(data[0][:-8])                      # no end mark
    (tmp_path / "1.frm").write_bytes(data[1][:-9])                      # within the last record
    (tmp_path / "2.frm").write_bytes(b"junk" + data[2][4:])
    (tmp_path / "3.frm").write_bytes(data[3].replace(b'"id": 35', b'"id": 36'))
    (tmp_path / "4.frm").write_bytes(data[4] + b"x")
    (tmp_path / "5.frm").write_bytes(b"")
    gone = spark.createDataFrame([(f"file:{tmp_path}/gone.frm", 5)], "path string, length long")
    got = read_groups(spark, listed(spark, tmp_path).unionByName(gone), "framed", SCHEMA)
    name = F.regexp_extract("source_path", "([^/]*)$", 1)
    bad = {r["n"]: r["reason"] for r in rejected_files(got).select(name.alias("n"), "reason").collect()}
    assert set(bad) == {"0.frm", "1.frm", "2.frm", "3.frm", "4.frm", "5.frm", "gone.frm"}
    assert "checksum" in bad["3.frm"] and "cut off" in bad["1.frm"] and "FileNotFound" in bad["gone.frm"]
    good = {r["n"]: r["c"] for r in got.where("reject is null").groupBy(name.alias("n")).agg(F.count("*").alias("c")).collect()}
    assert good == {"0.frm": 10, "1.frm": 9, "3.frm": 5, "4.frm": 10, "6.frm": 10}
    assert {r["id"] for r in whole_files(got).collect()} == set(range(60, 70))


def test_groups_are_bounded(spark):
    files = spark.createDataFrame([(f"/d/{i}", n) for i, n in enumerate([10] * 50 + [0] * 30 + [1000, 95, None])],
                                  "path string, length long")
    groups = file_groups(files.unionByName(files.limit(5)), Framed(), 100, 10).groupBy("group").agg(
        F.count("*").alias("n"), F.collect_list("path").alias("p")).collect()
    size = {f"/d/{i}": n or 0 for i, n in enumerate([10] * 50 + [0] * 30 + [1000, 95, None])}
    assert sorted(p for g in groups for p in g["p"]) == sorted(size)
    assert all(g["n"] <= 10 for g in groups)
    assert all(sum(size[p] for p in g["p"]) <= 100 + max(size[p] for p in g["p"]) for g in groups)
    parts = file_groups(files, FORMATS["json"], 100, 10).where("path = '/d/80'").collect()
    assert sorted((p["start"], p["end"]) for p in parts) == [(k, k + 100) for k in range(0, 1000, 100)]
    assert file_groups(files.limit(0), Framed()).count() == 0


@pytest.mark.parametrize("size", [1, 7, 64, 10_000])
def test_lines_in_parts(spark, tmp_path, size):
    """Every line once, whatever the cuts; gzip files are not cut."""
    lines = [f"{i},{'x' * (i % 13)}é" for i in range(60)]
    (tmp_path / "a.csv").write_bytes(b"\xef\xbb\xbfid,k\n" + "\r\n".join(lines).encode() + b"\n\n#no\n")
    (tmp_path / "b.csv.gz").write_bytes(gzip.compress(("id,k\n" + "\n".join(lines)).encode()))
    (tmp_path / "empty.csv").write_bytes(b"")
    got = read_groups(spark, listed(spark, tmp_path), "csv", "id long, k string", {"header": "true", "comment": "#"}, group_bytes=size)
    want = sorted(2 * [(i, "x" * (i % 13) + "é") for i in range(60)])
    assert sorted((r["id"], r["k"]) for r in got.collect()) == want and rejected_files(got).isEmpty()


def test_same_records_as_sparks_readers(spark, tmp_path):
    df = spark.createDataFrame([(i, f"k{i}", i / 4, dt.datetime(2024, 1, 1, 0, 0, i % 60)) for i in range(500)],
                               "id long, kind string, amount double, at timestamp_ntz")
    for fmt in ("csv", "json", "parquet"):
        df.repartition(3).write.format(fmt).save(str(tmp_path / fmt))
        files = landing_inventory(spark, str(tmp_path / fmt)).where("name like 'part%'").select("path", "length")
        schema = "id int, kind string, absent string, at timestamp_ntz" if fmt != "csv" else df.schema
        own = read_groups(spark, files, fmt, schema, group_bytes=1000).drop("source_path", "reject")
        if fmt == "parquet":       # narrower and missing columns
            assert sorted(own.collect(), key=str) == sorted(df.selectExpr("cast(id as int) id", "kind", "cast(null as string) absent", "at").collect(), key=str)
        else:
            assert sorted(own.collect(), key=str) == sorted(spark.read.schema(schema).format(fmt).load(str(tmp_path / fmt)).collect(), key=str)


def test_formats_by_name_in_typed_reads(spark, tmp_path):
    class Pairs(FileFormat):
        """A format of a user, known to the driver only: ``key=value`` separated by semicolons."""

        name = "pairs"

        def batches(self, stream, part, schema, options):
            import pyarrow as pa
            parts = [p.partition("=") for p in stream.read().decode().split(options.get("sep", ";"))]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _, _ in parts]), pa.array([int(v) for _, _, v in parts], pa.int64())], schema=schema)

    register_format(Pairs())
    try:
        (tmp_path / "a.kv").write_text("x=1;y=2")
        (tmp_path / "b.kv").write_text("x=1;y=two")
        (tmp_path / "c.csv").write_text("z,3\n")
        items = spark.createDataFrame([(str(tmp_path / n), t, f) for n, t, f in (("a.kv", " mine ", "pairs"), ("c.csv", "mine", "csv"))],
                                      "path string, data_type string, format string")
        registry = {"mine": TypeSpec("pairs", "k string, v long")}
        assert sorted((r["k"], r["v"]) for r in read_typed_feed(spark, items, registry).collect()) == [("x", 1), ("y", 2), ("z", 3)]
        bad = spark.createDataFrame([(str(tmp_path / "b.kv"), "mine", "pairs")], items.schema)
        with pytest.raises(Exception, match="cannot read .*b.kv"):
            read_typed_feed(spark, bad, registry).collect()
        got = read_typed_feed(spark, items.unionByName(bad), registry, guarded=True)
        assert [(r["source_path"].endswith("b.kv"), "two" in r["reject"]) for r in got.where("reject is not null").collect()] == [(True, True)]
    finally:
        del FORMATS["pairs"]


def shred(df):
    return shred_entries(df.withColumn("ts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")),
                         "d", F.col("id"), {"kind": F.col("kind")}, F.col("ts"), carry=["work_id"])


def test_many_corrupt_files_cost_one_run(spark, tmp_path, monkeypatch):
    """50 of 200 inputs are corrupt, some only at their end: one read, 50 failed outcomes, nothing of them written."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    from intake.plans import lifecycle

    land = tmp_path / "in"
    land.mkdir()
    for i in range(200):
        if i % 2:
            pq.write_table(pa.table({"id": list(range(10)), "kind": ["a"] * 10}), land / f"{i}.parquet")
            if i % 4 == 1 and i < 100:
                data = (land / f"{i}.parquet").read_bytes()
                (land / f"{i}.parquet").write_bytes(data[:len(data) // 2])
        else:
            text = gzip.compress("".join(f'{{"id": {k}, "kind": "a"}}\n' for k in range(10)).encode())
            (land / f"{i}.json.gz").write_bytes(text[:-5] if i % 4 == 0 and i < 100 else text)
    inv = landing_inventory(spark, str(land))
    fmt = F.when(F.col("name").endswith(".parquet"), "parquet").otherwise("json")
    msgs = inv.select(F.concat_ws(",", "path", fmt, F.concat(F.lit("my"), fmt)).alias("message"), F.col("name").alias("work_id"))
    types = {f"my{f}": DataType(TypeSpec(f, "id long, kind string"), shred) for f in ("parquet", "json")}
    reads = []
    real = lifecycle.read_typed_feed
    monkeypatch.setattr(lifecycle, "read_typed_feed", lambda *a, **k: reads.append(1) or real(*a, **k))
    out = ingest_items(spark, msgs, inv, types, dt.datetime(2024, 1, 2), "bulk", str(tmp_path / "out"))
    assert len(reads) == 2                                  # one a data type
    got = {r["work_id"]: (r["status"], r["reason"]) for r in out["outcomes"].collect()}
    bad = {f"{i}.parquet" for i in range(1, 100, 4)} | {f"{i}.json.gz" for i in range(0, 100, 4)}
    assert {k for k, v in got.items() if v == ("failed", "unreadable")} == bad and len(bad) == 50
    assert sum(v == ("ok", None) for v in got.values()) == 150
    for r in out["metrics"].collect():
        assert (r["attempt"], r["n_records"]) == (1, 0 if r["work_id"] in bad else 10) and r["duration_ms"] > 0
        assert r["n_bytes"] == os.path.getsize(land / r["work_id"])
    entries = read_entries(spark, str(tmp_path / "out" / "data"))
    assert entries.count() == 1500 and entries.select("work_id").distinct().count() == 150
