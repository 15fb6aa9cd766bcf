"""Files read by bounded groups: the ``DataSource`` behind formats of our own.

The files to read are a table, not a list: it is cut into groups of bounded bytes
and number of files (large files that can be split into parts of bounded
bytes), written below the session's shared folder with a folder per group, and a
task per group opens its own.  The driver only ever sees the groups' numbers.

A file that cannot be read gives one row that says so (``reject``); what it gave
before stays unless :func:`whole_files` drops it.
"""

from __future__ import annotations

import contextlib
import gzip
import time
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from intake.operators.joins import broadcast_if_small
from intake.operators.prefix import running_totals
from intake.session import scratch_dir
from intake.sources import storage
from intake.sources.formats import FORMATS, FileFormat, Part

GROUP_BYTES, GROUP_FILES = 128 << 20, 1000
FILE, REJECT, STAT = "source_path", "reject", "file_stat"   # columns added to the records
STAT_TYPE = T.StructType([T.StructField(c, T.LongType()) for c in ("records", "bytes", "micros")])
PARTS = "path string, start long, end long"


def file_groups(files: DataFrame, fmt: FileFormat, group_bytes: int = GROUP_BYTES, group_files: int = GROUP_FILES) -> DataFrame:
    """(group, path, start, end) of ``files`` (path, length; rows repeated once read once): parts of
    at most ``group_bytes`` where the format can be split, and consecutive groups that
    hold at most that many bytes beyond their last part and at most ``group_files`` parts."""
    length = F.coalesce(F.col("length"), F.lit(0))
    split = F.lit(fmt.splits)
    for ending in fmt.packed:
        split = split & ~F.col("path").endswith(ending)
    starts = F.when(split & (length > group_bytes), F.sequence(F.lit(0).cast("long"), length - 1, F.lit(group_bytes).cast("long")))
    parts = (files.select("path", length.alias("length")).dropDuplicates(["path"])
             .select("path", "length", F.explode(F.coalesce(starts, F.array(F.lit(0).cast("long")))).alias("start"), starts.isNotNull().alias("cut"))
             .select("path", "start", F.when(F.col("cut"), F.least(F.col("start") + group_bytes, F.col("length"))).alias("end"),
                     F.greatest(F.least(F.col("length") - F.col("start"), F.when(F.col("cut"), group_bytes).otherwise(F.col("length"))),
                                F.lit(-(-group_bytes // group_files))).alias("weight"))
             .withColumn("_all", F.lit(0)))
    if (parts.agg(F.sum("weight")).first()[0] or 0) <= group_bytes:      # one group: nothing to place
        return parts.select(F.lit(0).cast("long").alias("group"), "path", "start", "end")
    placed = running_totals(parts, ["_all"], ["path", "start"], ["weight"])
    return placed.select(F.floor(F.col("weight_before") / group_bytes).cast("long").alias("group"), "path", "start", "end")


class _Group(InputPartition):
    def __init__(self, folder: str):
        super().__init__(folder)


class _Reader(DataSourceReader):
    def __init__(self, fmt: FileFormat, schema: T.StructType, options: Mapping[str, str]):
        self.fmt, self.schema, self.options = fmt, schema, dict(options)

    def partitions(self):
        """A partition per group folder."""
        return [_Group(path) for name, path, is_dir, _, _ in storage.entries(self.options["path"]) if is_dir and name.startswith("group=")]

    def read(self, partition: _Group) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        whole = to_arrow_schema(self.schema, timestamp_utc=False)
        own = pa.schema([f for f in whole if f.name not in (FILE, REJECT, STAT)])
        timed = STAT in whole.names

        def row(batch, path, reason=None, stat=None):
            n = batch.num_rows if batch is not None else 1
            given = {FILE: pa.array([path] * n, pa.string()), REJECT: pa.array([reason] * n, pa.string())}
            if timed:
                given[STAT] = pa.array([stat] * n, whole.field(STAT).type)
            return pa.RecordBatch.from_arrays(
                [given[f.name] if f.name in given else pa.nulls(n, f.type) if batch is None else batch.column(f.name) for f in whole],
                schema=whole)

        for path, part in _parts_of(partition.value):
            reason, records, size, busy = None, 0, 0, 0
            begun = time.perf_counter_ns()
            try:
                with storage.open_input(path) as raw:
                    size = (raw.seek(0, 2) if part.end is None else part.end) - part.start
                    raw.seek(0)
                    with _plain(raw, path) as stream:
                        for batch in self.fmt.batches(stream, part, own, self.options):
                            records += batch.num_rows
                            busy += time.perf_counter_ns() - begun
                            yield row(batch, path)
                            begun = time.perf_counter_ns()     # not the time others take for the batch
            except Exception as e:  # noqa: BLE001 - whatever a file holds, the others are read on
                reason = f"{type(e).__name__}: {e}"[:500]
            busy += time.perf_counter_ns() - begun
            if reason is not None or timed:
                yield row(None, path, reason, {"records": records, "bytes": size, "micros": busy // 1000})


@contextlib.contextmanager
def _plain(raw, path: str):
    if not path.endswith(".gz"):
        yield raw
        return
    with gzip.open(raw) as stream:
        yield stream


def _parts_of(folder: str) -> Iterator[tuple[str, Part]]:
    import pyarrow.parquet as pq

    for name, path, is_dir, _, _ in sorted(storage.entries(folder)):
        if not is_dir and name.endswith(".parquet"):
            with storage.open_input(path) as f:
                table = pq.read_table(pa.BufferReader(f.read()), columns=["path", "start", "end"])
            for r in table.to_pylist():
                yield r["path"], Part(r["start"], r["end"])


def _source(fmt: FileFormat) -> type[DataSource]:
    """A data source of one format; the format travels with the class."""
    class GroupedFiles(DataSource):
        @classmethod
        def name(cls):
            return f"grouped_{fmt.name}"

        def reader(self, schema):
            return _Reader(fmt, schema, self.options)

    return GroupedFiles


def read_groups(spark: SparkSession, files: DataFrame, fmt: str | FileFormat, schema: T.StructType | str,
                options: Mapping[str, str] | None = None, group_bytes: int = GROUP_BYTES, group_files: int = GROUP_FILES,
                stats: bool = False) -> DataFrame:
    """Records of ``files`` (path, length) read with a format of ``intake.sources.formats``: the columns of
    ``schema``, ``source_path`` and ``reject``.  A row with ``reject`` is no record but a file that could not be
    read to its end, and why.  A file that is gone is one of those; no files give no rows.

    With ``stats`` every part of a file has one more row that is no record: ``file_stat`` with its records,
    bytes and the time the task took to read it (see :func:`file_stats`)."""
    fmt = FORMATS[fmt] if isinstance(fmt, str) else fmt
    own = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    if {FILE, REJECT, STAT} & set(own.names):
        raise ValueError(f"columns {FILE}, {REJECT} and {STAT} are added by the reader")
    added = [FILE, REJECT, *([STAT] if stats else [])]
    folder = scratch_dir(spark, f"groups-{fmt.name}")
    groups = file_groups(files, fmt, group_bytes, group_files)
    # AQE splits and packs; a group may get several files, all of them its own
    groups.hint("rebalance", "group").write.partitionBy("group").parquet(folder)
    spark.dataSource.register(_source(fmt))
    lines = fmt.name in ("csv", "json", "text") and type(fmt).__name__ == "Lines"
    read = T.StructType([T.StructField("value", T.StringType())]) if lines else T.StructType(
        [T.StructField(f.name, f.dataType, True) for f in own])
    read = read.add(FILE, T.StringType()).add(REJECT, T.StringType())
    if stats:
        read = read.add(STAT, STAT_TYPE)
    rows = spark.read.format(f"grouped_{fmt.name}").schema(read).options(**dict(options or {})).load(folder)
    if not lines or fmt.name == "text":
        return rows
    parse = F.from_csv if fmt.name == "csv" else F.from_json
    plain = {k: v for k, v in (options or {}).items() if k != "header"}
    parsed = parse(F.col("value"), own.simpleString() if fmt.name == "json" else ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in own), plain)
    record = F.col(REJECT).isNull() & (F.col(STAT).isNull() if stats else F.lit(True))
    return rows.select(F.when(record, parsed).alias("_r"), *added).select("_r.*", *added)


def rejected_files(records: DataFrame) -> DataFrame:
    """(source_path, reason), one row per file that could not be read to its end."""
    return records.where(F.col(REJECT).isNotNull()).groupBy(FILE).agg(F.min(REJECT).alias("reason"))


def file_stats(records: DataFrame) -> DataFrame:
    """(source_path, n_records, n_bytes, duration_ms) per file, from rows read with ``stats``: what was read of it
    and the time its parts took together."""
    return (records.where(F.col(STAT).isNotNull()).groupBy(FILE)
            .agg(F.sum(f"{STAT}.records").alias("n_records"), F.sum(f"{STAT}.bytes").alias("n_bytes"),
                 (F.sum(f"{STAT}.micros") / 1000).alias("duration_ms")))


def whole_files(records: DataFrame) -> DataFrame:
    """The records of the files that could be read to their end, without ``reject`` and ``file_stat``.  Reads
    ``records`` twice: give it a written table."""
    bad = broadcast_if_small(rejected_files(records).select(FILE))
    rows = records.where(F.col(REJECT).isNull())
    if STAT in records.columns:
        rows = rows.where(F.col(STAT).isNull()).drop(STAT)
    return rows.drop(REJECT).join(bad, FILE, "left_anti")
