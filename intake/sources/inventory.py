"""File inventory of a landing folder.

Tasks list the tree themselves (:mod:`intake.sources.walk`).  In a store that only
Spark reads, the ``binaryFile`` source lists it without its ``content`` column, so
Catalyst prunes the read schema to path / length / modificationTime and no file
body is opened; that listing is Spark's file index, which the driver holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intake.functions.paths import file_name, parent_dir
from intake.sources import storage
from intake.sources.walk import walk


def _dir_status(spark: SparkSession, path: str) -> tuple[bool, str]:
    """(is a directory, fully qualified form) of ``path`` via the Hadoop API."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getFileStatus(hpath).isDirectory(), fs.makeQualified(hpath).toString()


def _norm_uri(p: str) -> str:
    # the file index spells local files "file:///x", the scan "file:/x"
    return "file:/" + p[len("file:///"):] if p.startswith("file:///") else p


def _zero_length_files(spark: SparkSession, raw: DataFrame, listed: DataFrame) -> DataFrame | None:
    """Spark's file scans skip zero-length files, its file index does not.
    Only when the two counts differ are the missing ones found — an anti join
    between the index's path list (kept on the JVM, never copied into Python)
    and the scan — and stat'ed; their number is that of the empty files."""
    jfiles = raw._jdf.inputFiles()
    if len(jfiles) == listed.count():
        return None
    jvm = spark.sparkContext._jvm
    seq = jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(jfiles)
    jds = spark._jsparkSession.createDataset(seq, jvm.org.apache.spark.sql.Encoders.STRING())
    every = DataFrame(jds.toDF(), spark).select(
        F.regexp_replace("value", "^file:///", "file:/").alias("path"))
    empty = [r["path"] for r in every.join(listed.select("path"), "path", "left_anti").collect()]
    if not empty:
        return None
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    rows = []
    for p in empty:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        st = hp.getFileSystem(conf).getFileStatus(hp)
        rows.append((p, int(st.getLen()), int(st.getModificationTime())))
    return (spark.createDataFrame(rows, "path string, length long, ms long")
            .select("path", "length", F.timestamp_millis("ms").alias("modificationTime")))


def landing_inventory(spark: SparkSession, path: str, recursive: bool = False,
                      feed: str | None = None, path_glob: str | None = None,
                      include_empty: bool = True, hidden: bool = False) -> DataFrame:
    """``feed, path, name, length, mtime`` of every file below ``path``, as it is now (a written table).

    A path that is not a directory is an error, as in the reference.  Names
    starting with ``_`` or ``.`` are listed with ``hidden`` (the reference lists
    them; a store that only Spark reads never does), zero-length files unless
    ``include_empty`` is off.  ``mtime`` is the modification time in milliseconds as
    ``timestamp_ntz`` in the session time zone.
    """
    is_dir, qualified = _dir_status(spark, path)
    if not is_dir:
        raise ValueError(f"input dir is not a directory: {path}")
    if storage.openable(qualified) and not path_glob:
        files = walk(spark, qualified, recursive, hidden)
        return files.where(F.lit(include_empty) | (F.col("length") > 0)).select(
            F.lit(feed).cast("string").alias("feed"), "path", "name", "length",
            F.timestamp_millis(F.floor(F.col("mtime") / 1000)).cast("timestamp_ntz").alias("mtime"))
    # Spark always lists leaf files of sub-folders; recursiveFileLookup turns
    # off partition inference, and the non-recursive case keeps top-level files.
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    raw = reader.load(path)
    listed = raw.select("path", "length", "modificationTime")
    if include_empty:
        empty = _zero_length_files(spark, raw, listed)
        if empty is not None:
            listed = listed.unionByName(empty)
    if not recursive:
        listed = listed.where(parent_dir(F.col("path")) == F.lit(_norm_uri(qualified).rstrip("/")))
    return listed.select(
        F.lit(feed).cast("string").alias("feed"),
        F.col("path"),
        file_name(F.col("path")).alias("name"),
        F.col("length"),
        F.col("modificationTime").cast("timestamp_ntz").alias("mtime"),
    )


def feed_inventories(spark: SparkSession, feeds: dict[str, str], recursive: bool = False,
                     include_empty: bool = True) -> DataFrame:
    """One inventory over several feeds, one folder each (``{feed: folder}``):
    each folder is listed by its own file index, then the listings are
    stacked."""
    frames = [landing_inventory(spark, folder, recursive, feed, include_empty=include_empty)
              for feed, folder in sorted(feeds.items())]
    if not frames:
        raise ValueError("no feeds given")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
