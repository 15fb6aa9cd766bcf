"""Entry files in key order with an index, for point and range lookups.

``write_keyed`` range-partitions entries by key and writes each range in order, with small row groups whose
minimum and maximum keys Parquet keeps and a Bloom filter of the row keys in every one.  Beside the data lies an
index, a row per file with its first and last key: a lookup opens only the files whose range can hold what is asked for, and
within those the scan leaves out row groups by their statistics and filters.  ``merge_keyed`` makes one such
folder of several, dealt anew into ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intake.operators.combine import sort_entries
from intake.operators.joins import broadcast_if_small
from intake.schemas import ENTRY_DDL, ENTRY_KEY
from intake.session import checkpoint_dir

GROUP_BYTES = 8 << 20           # of a row group
FILE_ROWS = 2_000_000           # of a file, about: a task sorts one
TABLES = 200                    # that the sort tells apart by a number
INDEX = "file string, table_name string, first_key string, last_key string, rows long"


def write_keyed(entries: DataFrame, folder: str, files: int | None = None, group_bytes: int = GROUP_BYTES) -> None:
    """Write ``entries`` (entry columns) as sorted files below ``folder`` (replaced), about ``files`` of them and more
    where those would hold more than ``FILE_ROWS`` each."""
    held = entries.groupBy("table_name").agg(F.count(F.lit(1)).alias("rows"))
    _write_keyed(entries, held, folder, files, group_bytes)


def _write_keyed(entries: DataFrame, held: DataFrame, folder: str, files: int | None, group_bytes: int) -> None:
    """:func:`write_keyed` with the rows of each table (table_name, rows) known."""
    spark, base = entries.sparkSession, folder.rstrip("/")
    checkpoint_dir(spark)
    held = held.checkpoint()
    total = held.agg(F.sum("rows")).first()[0] or 0
    tables = [r["table_name"] for r in held.where("table_name is not null").orderBy("table_name").limit(TABLES + 1).collect()]
    least = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (sort_entries(entries, max(least, -(-total // FILE_ROWS)), tables if len(tables) <= TABLES else None)
     .write.mode("overwrite").option("partitionOverwriteMode", "static")
     .option("parquet.block.size", str(group_bytes)).option("parquet.block.size.row.check.min", "100")
     .option("parquet.bloom.filter.enabled#row_key", "true").parquet(f"{base}/data"))
    # files are in key order: where a table's keys begin and end is told by row numbers, which need no sort
    rows = spark.read.schema(ENTRY_DDL).parquet(f"{base}/data").select(
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"), "table_name", "row_key")
    known = F.when(F.col("row_key").isNotNull(), F.col("at"))
    ends = rows.groupBy("file", "table_name").agg(F.min(known).alias("_first"), F.max(known).alias("_last"), F.count(F.lit(1)).alias("rows")).checkpoint()
    # two rows a file and table
    marks = F.broadcast(ends.select("file", F.explode(F.array_distinct(F.array("_first", "_last"))).alias("at")).where("at is not null"))
    keys = rows.join(marks, ["file", "at"]).select("file", "at", "row_key").checkpoint()
    first, last = (keys.select("file", F.col("at").alias(f"_{c}"), F.col("row_key").alias(f"{c}_key")) for c in ("first", "last"))
    (ends.join(first, ["file", "_first"], "left").join(last, ["file", "_last"], "left")
     .select("file", "table_name", "first_key", "last_key", "rows")
     .coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{base}/index"))


def keyed_index(spark: SparkSession, folder: str) -> DataFrame:
    """(file, table_name, first_key, last_key, rows): a row per file and table in it."""
    return spark.read.schema(INDEX).parquet(f"{folder.rstrip('/')}/index")


def _files(spark: SparkSession, folder: str, hits: DataFrame) -> DataFrame:
    names = sorted(r["file"] for r in hits.select("file").distinct().collect())      # of the files a lookup opens
    if not names:
        return spark.createDataFrame([], ENTRY_DDL)
    return spark.read.schema(ENTRY_DDL).parquet(*[f"{folder.rstrip('/')}/data/{n}" for n in names])


def lookup_range(spark: SparkSession, folder: str, table_name: str, first: str, last: str) -> DataFrame:
    """Entries of a table with row keys from ``first`` to ``last``, both included."""
    hits = keyed_index(spark, folder).where((F.col("table_name") == table_name) & (F.col("first_key") <= last) & (F.col("last_key") >= first))
    return _files(spark, folder, hits).where((F.col("table_name") == table_name) & F.col("row_key").between(first, last))


def lookup_keys(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """Entries of the (table_name, row_key) of ``keys``.  A few keys are looked up by the files' filters too; many by a join."""
    keys = keys.select("table_name", "row_key").where("table_name is not null and row_key is not null").distinct()
    index = keyed_index(spark, folder)
    hits = index.join(broadcast_if_small(keys.withColumnRenamed("table_name", "_t")),
                      (F.col("table_name") == F.col("_t")) & F.col("row_key").between(F.col("first_key"), F.col("last_key")), "left_semi")
    rows = _files(spark, folder, hits)
    few = [r["row_key"] for r in keys.select("row_key").distinct().limit(101).collect()]
    if len(few) <= 100:
        rows = rows.where(F.col("row_key").isin(few))
    return rows.join(broadcast_if_small(keys), ["table_name", "row_key"], "left_semi")


def merge_keyed(spark: SparkSession, folders: list[str], target: str, files: int | None = None, group_bytes: int = GROUP_BYTES) -> None:
    """One folder in key order of several; entries stay as they are, equal ones too."""
    rows = spark.read.schema(ENTRY_DDL).parquet(*[f"{f.rstrip('/')}/data" for f in folders])
    held = keyed_index(spark, folders[0])
    for f in folders[1:]:
        held = held.unionByName(keyed_index(spark, f))
    held = held.groupBy("table_name").agg(F.sum("rows").alias("rows"))
    _write_keyed(rows.select(*ENTRY_KEY, "ts", "value"), held, target, files, group_bytes)
