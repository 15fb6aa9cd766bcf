"""Directory trees listed by tasks, and the difference of two listings.

A round hands folders to tasks; a task walks its folders' trees on until it has
listed ``budget`` entries and then hands the folders still to be listed on to the next
round, dealt anew over all tasks.  So a small tree takes one round with one
task, a large one is spread over the cluster within a few rounds, and what a round
found is written to a table: no list of files or folders is held by the driver.
Names starting with ``_`` or ``.`` are files like others here (``hidden``).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intake.session import scratch_dir
from intake.sources import storage

BUDGET = 10_000                 # entries a task lists before it hands folders on
_ROWS = "path string, name string, is_dir boolean, length long, mtime long"
LISTING = "path string, name string, length long, mtime long"


def is_hidden(name: str) -> bool:
    """What Spark's own listings leave out."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def walk(spark: SparkSession, root: str, recursive: bool = True, hidden: bool = True, budget: int = BUDGET) -> DataFrame:
    """(path, name, length, mtime in microseconds since 1970) of every file below ``root``, empty ones included.

    Links to files are files, links to folders are not followed; what vanishes
    while it is listed is left out.  The result is a written table."""
    if not storage.openable(root):
        raise ValueError(f"tasks cannot list {root}")

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        listed, rows = 0, []

        def batch():
            return pd.DataFrame(rows, columns=["path", "name", "is_dir", "length", "mtime"])

        for pdf in batches:
            todo = list(pdf["path"])[::-1]
            while todo:
                folder = todo.pop()
                if listed >= budget:
                    rows.append((folder, "", True, 0, 0))
                else:
                    try:
                        for name, path, is_dir, length, mtime in storage.entries(folder):
                            listed += 1
                            if is_dir and recursive and (hidden or not is_hidden(name)):
                                todo.append(path)
                            elif not is_dir and (hidden or not is_hidden(name)):
                                rows.append((path, name, False, length, mtime))
                                if len(rows) >= 4096:
                                    yield batch()
                                    rows.clear()
                    except FileNotFoundError:
                        pass
        if rows:
            yield batch()

    out = scratch_dir(spark, "listing")
    todo, round_ = spark.createDataFrame([(root.rstrip("/") or "/",)], "path string").coalesce(1), 0
    while True:
        todo.mapInPandas(step, _ROWS).write.parquet(f"{out}/round={round_}")
        found = spark.read.schema(_ROWS).parquet(f"{out}/round={round_}").where("is_dir").select("path")
        if found.isEmpty():
            break
        # dealt by hash: neighbours in the tree go to different tasks
        todo, round_ = found.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path"), round_ + 1
    return spark.read.schema(_ROWS).parquet(*[f"{out}/round={r}" for r in range(round_ + 1)]).where("not is_dir").drop("is_dir")


def listing_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """(path, status, length, mtime, old_length, old_mtime) for two listings (``path, length, mtime``; a path once
    in each): ``new``, ``changed`` (other length or time), ``gone`` or ``same``."""
    old = before.select("path", F.col("length").alias("old_length"), F.col("mtime").alias("old_mtime"), F.lit(True).alias("_old"))
    now = after.select("path", "length", "mtime", F.lit(True).alias("_now"))
    same = F.col("length").eqNullSafe(F.col("old_length")) & F.col("mtime").eqNullSafe(F.col("old_mtime"))
    status = (F.when(F.col("_old").isNull(), "new").when(F.col("_now").isNull(), "gone")
              .when(same, "same").otherwise("changed"))
    return now.join(old, "path", "full").select("path", status.alias("status"), "length", "mtime", "old_length", "old_mtime")
