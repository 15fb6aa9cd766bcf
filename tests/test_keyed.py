"""Keyed entry files: lookups read only what can match."""

from pyspark.sql import functions as F

from intake.sinks import keyed


def entries(spark, n, table="t", start=0):
    return spark.range(start, start + n).select(
        F.lit(table).alias("table_name"), F.format_string("k%06d", "id").alias("row_key"), F.lit("f").alias("family"), F.lit("q").alias("qualifier"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("ts"), F.sha2(F.col("id").cast("string"), 256).alias("value"))


def scanned(df):
    """(rows that came out of the scans, files read)"""
    df.collect()
    todo, rows, files = [df._jdf.queryExecution().executedPlan()], 0, 0
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("Scan parquet"):
            metrics = node.metrics()
            rows, files = rows + metrics.get("numOutputRows").get().value(), files + metrics.get("numFiles").get().value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return rows, files


def test_lookups_read_little(spark, tmp_path):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")               # plans as they are run
    try:
        look_up(spark, tmp_path)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def look_up(spark, tmp_path):
    where = str(tmp_path / "k")
    keyed.write_keyed(entries(spark, 40_000).unionByName(entries(spark, 50, "u")), where, files=8, group_bytes=100_000)
    index = keyed.keyed_index(spark, where).collect()
    assert len({r["file"] for r in index}) == 8 and sum(r["rows"] for r in index) == 40_050
    assert keyed.lookup_range(spark, where, "t", "k000000", "k999999").count() == 40_000
    some = keyed.lookup_range(spark, where, "t", "k020000", "k020009")
    rows, files = scanned(some)
    assert some.count() == 10 and files == 1 and rows < 3_000          # a file, and of it a row group or two
    one = keyed.lookup_keys(spark, where, spark.createDataFrame([("t", "k031234"), ("t", "absent"), ("u", "k000007"), (None, "x")], "table_name string, row_key string"))
    rows, files = scanned(one)
    assert files == 2 and rows < 6_000
    assert sorted((r["table_name"], r["row_key"]) for r in one.collect()) == [("t", "k031234"), ("u", "k000007")]
    assert keyed.lookup_keys(spark, where, spark.createDataFrame([("v", "k000001")], "table_name string, row_key string")).count() == 0


def test_merge_and_many_keys(spark, tmp_path):
    for name, start in (("a", 0), ("b", 300), ("c", 100)):
        keyed.write_keyed(entries(spark, 400, start=start), str(tmp_path / name), files=3)
    keyed.merge_keyed(spark, [str(tmp_path / n) for n in "abc"], str(tmp_path / "m"), files=4)
    index = sorted((r["first_key"], r["last_key"]) for r in keyed.keyed_index(spark, str(tmp_path / "m")).collect())
    assert all(a[1] <= b[0] for a, b in zip(index, index[1:]))
    keys = entries(spark, 250, start=200)                              # more keys than are named to the scan
    assert keyed.lookup_keys(spark, str(tmp_path / "m"), keys).count() == 200 + 150 + 250
    keyed.write_keyed(entries(spark, 0), str(tmp_path / "none"))
    assert keyed.lookup_range(spark, str(tmp_path / "none"), "t", "a", "z").count() == 0
