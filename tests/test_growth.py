"""Work that grows with the input stays in bounded tasks: staged records, sorts by key, framed files, filters, keyed files."""

import datetime as dt
import json
import tracemalloc

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from intake.operators import combine
from intake.operators.shred import shred_entries
from intake.plans import lifecycle
from intake.schemas import ENTRY_DDL
from intake.sinks import bundles, keyed, live, seen
from intake.sinks.framed import FramedSink, write_framed
from intake.sources import TypeSpec, landing_inventory
from intake.sources.entries import read_entries
from intake.sources.formats import Framed


def test_a_large_file_is_shredded_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lifecycle, "SHRED_RECORDS", 100, raising=False)
    land = tmp_path / "in"
    spark.range(2000).selectExpr("id", "'same' AS kind").coalesce(1).write.parquet(str(land))
    inv = landing_inventory(spark, str(land), feed="f").where(F.col("path").endswith(".parquet"))
    msgs = inv.select(F.concat_ws(",", "path", F.lit("parquet"), F.lit("d")).alias("message"), F.lit("w").alias("work_id"))
    most = []

    def to_entries(records):
        most.append(records.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0])
        return shred_entries(records, "d", F.col("id"), {"kind": F.col("kind")}, F.lit("2024-01-01").cast("timestamp_ntz"), carry=["work_id"])

    types = {"d": lifecycle.DataType(TypeSpec("parquet", "id long, kind string"), to_entries)}
    lifecycle.ingest_items(spark, msgs, inv, types, dt.datetime(2024, 1, 2), "bulk", str(tmp_path / "out"))
    assert most[0] < 400
    back = read_entries(spark, str(tmp_path / "out" / "data"))
    assert (back.count(), back.select("row_key").distinct().count()) == (2000, 2000)


def first_sort_columns(df):
    found = []
    for line in df._jdf.queryExecution().executedPlan().toString().split("\n"):
        if "Sort [" in line:
            found.append(line.split("Sort [", 1)[1].split("#")[0])
    return found


def test_aggregates_of_texts_sort_by_a_number(spark):
    rows = spark.createDataFrame([("t", "r", "f", "q", dt.datetime(2024, 1, 1), "1", "b")] * 2, f"{ENTRY_DDL}, batch_id string")
    for out in (combine.aggregate_entries(rows, ["t"]), combine.combine_entries(rows, ["t"]), live.newest_per_key(rows, ["t"])):
        assert set(first_sort_columns(out)) == {"_groupingexpression"}         # the hash, not a text
        assert out.count() == 1
    assert live.newest_per_key(rows, ["t"]).first()["value"] == "2"


def test_framed_batches_and_rows_write_the_same(spark, tmp_path):
    schema = T._parse_datatype_string("id long, kind string, amount double, day date, at timestamp_ntz, price decimal(12,3), ok boolean")
    df = spark.range(300).selectExpr("id", "if(id % 7 = 0, null, concat('kü', id))", "id / 3", "date_add(DATE'2024-01-01', int(id % 28))",
                                     "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id / 7)", "cast(id / 8 as decimal(12,3))", "id % 2 = 0").toDF(*schema.names)
    sink = FramedSink({"path": str(tmp_path)})
    assert type(sink.writer(schema, False)).__name__ == "_FramedBatchWriter"
    assert type(sink.writer(schema.add("tags", T.ArrayType(T.StringType())), False)).__name__ == "_FramedWriter"
    by_batch, by_row = tmp_path / "batch", tmp_path / "row"
    write_framed(df.coalesce(1), str(by_batch))
    write_framed(df.withColumn("none", F.array().cast("array<string>")).coalesce(1), str(by_row))

    def records(folder):
        data, at, out = (folder / "part-00000.frm").read_bytes(), 4, []
        while True:
            size, _ = Framed.HEAD.unpack(data[at:at + 8])
            if size == Framed.END:
                return out
            out.append(json.loads(data[at + 8:at + 8 + size]))
            at += 8 + size

    rows = records(by_row)
    assert [r.pop("none") for r in rows] == [[]] * 300
    assert records(by_batch) == rows


def test_bundles_below_a_folder_named_like_a_tick(spark, tmp_path):
    out, state = str(tmp_path / "tick=old" / "bundles"), str(tmp_path / "state")
    members = spark.createDataFrame([("/in/a b", 1, dt.datetime(2024, 1, 1), "b1")], "path string, length long, mtime timestamp_ntz, bundle_id string")
    bundles.record_bundled(members, state, "t+1 x")
    rows = spark.createDataFrame([("t", "r", "f", "q", dt.datetime(2024, 1, 1), "v", "/in/a b", "b1")], f"{ENTRY_DDL}, source_path string, bundle_id string")
    rows.write.parquet(f"{out}/tick=t+1 x/bucket=0")
    assert [r["tick"] for r in bundles.read_bundles(spark, out, state).collect()] == ["t+1 x"]


def test_filters_are_asked_in_chunks():
    keys = np.random.default_rng(3).integers(-2 ** 63, 2 ** 63 - 1, (400_000, 2))
    tracemalloc.start()
    blob = seen.bloom(keys)
    assert seen.may_hold(blob, keys).all()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24 << 20                  # bits of all ids at once are 25 MB, and there are several of such arrays


def test_keyed_files_hold_a_bounded_number_of_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed, "FILE_ROWS", 500, raising=False)
    rows = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, "u").when(F.col("id") % 3 == 1, "t").alias("table_name"), F.when(F.col("id") % 50 > 1, F.col("id").cast("string")).alias("row_key"),
        F.lit("f").alias("family"), F.lit("q").alias("qualifier"), F.lit("2024-01-01").cast("timestamp_ntz").alias("ts"), F.lit("v").alias("value"))
    for name in "ab":
        keyed.write_keyed(rows, str(tmp_path / name), files=2)
    keyed.merge_keyed(spark, [str(tmp_path / "a"), str(tmp_path / "b")], str(tmp_path / "m"), files=2)
    for name, times in (("a", 1), ("m", 2)):
        index = keyed.keyed_index(spark, str(tmp_path / name))
        by_file = index.groupBy("file").agg(F.sum("rows").alias("n")).collect()
        assert len(by_file) >= 8 * times and sum(r["n"] for r in by_file) == 4000 * times and max(r["n"] for r in by_file) < 1000
        data = spark.read.schema(ENTRY_DDL).parquet(str(tmp_path / name / "data")).select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"))
        want = data.groupBy("file", "table_name").agg(F.min("row_key").alias("first_key"), F.max("row_key").alias("last_key"), F.count("*").alias("rows"))
        assert index.exceptAll(want).isEmpty() and want.exceptAll(index).isEmpty()
        for part in data.orderBy("file", "at").rdd.map(lambda r: (r["file"], tuple((v is not None, v) for v in (r["table_name"], r["row_key"])))).groupByKey().collect():
            assert list(part[1]) == sorted(part[1])
