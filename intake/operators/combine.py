"""Writer chain of the ingest step: dedupe -> aggregate, plus key order and
per-table counters.

Each step is a plain ``groupBy`` / ``dropDuplicates``: Spark runs a partial
aggregate before the shuffle (map-side combine), so a key that holds a third
of all entries is collapsed inside every map task and crosses the network as
one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intake.schemas import ENTRY_COLUMNS, ENTRY_KEY


def dedupe_entries(entries: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Drop exact duplicates (same key, ts and value): a redelivered file.
    ``scope`` columns (e.g. ``work_id`` in bulk mode, where each input file
    has its own writer chain) are part of the identity and kept."""
    return entries.dropDuplicates([*scope, *ENTRY_COLUMNS])


def key_hash() -> Column:
    """The entry key as one number.  The newest value of a key is a text, so aggregates of it sort their rows; with
    this column in front of the grouping the sorts compare numbers, not texts that mostly begin alike."""
    return F.xxhash64(*ENTRY_KEY).alias("_hash")


def aggregate_entries(entries: DataFrame, sum_tables: Sequence[str] = (),
                      sum_type: str = "decimal(28,9)", scope: Sequence[str] = ()) -> DataFrame:
    """Combine entries of equal key.

    Tables in ``sum_tables`` are counters: values are summed as ``sum_type``
    (wide enough to lose no digit of a count or an amount) and written without
    trailing zeros; values that are no number are left out and counted in
    ``n_rejected``.
    Every other table keeps the newest value (latest ``ts``; equal ``ts``
    resolved by the greater value, so the result never depends on row order).
    ``n_combined`` counts the entries folded into each output row.  ``scope``
    columns are grouped on as well and kept (per work item combining).
    """
    sums = list(sum_tables)
    is_sum = F.col("table_name").isin(sums) if sums else F.lit(False)
    number = F.col("value").try_cast(sum_type)
    agg = entries.groupBy(key_hash(), *scope, *ENTRY_KEY).agg(
        F.max("ts").alias("ts"),
        F.sum(F.when(is_sum, number)).alias("_sum"),
        F.max_by("value", F.struct("ts", "value")).alias("_newest"),
        F.count(F.lit(1)).alias("n_combined"),
        F.count_if(is_sum & number.isNull()).alias("n_rejected"),
    )
    value = F.when(is_sum, plain_number(F.col("_sum"))).otherwise(F.col("_newest"))
    return agg.select(*scope, *ENTRY_KEY, "ts", value.alias("value"), "n_combined", "n_rejected")


def combine_entries(entries: DataFrame, sum_tables: Sequence[str] = (), scope: Sequence[str] = (),
                    record: Sequence[str] = ()) -> DataFrame:
    """Dedupe and aggregate in one chain: ``scope``, the entry columns and ``n_rejected``.

    The rows of :func:`aggregate_entries` over :func:`dedupe_entries`, with less
    moved: the newest value of a key is the same with duplicates or without, so
    tables outside ``sum_tables`` are collapsed to one row a key by the first
    (partially aggregated) shuffle, the only one if there are no counters.
    Counters first drop duplicates, told apart by the ``record`` columns too:
    two events of one type and time count twice, one event delivered twice once."""
    keep = [*scope, *ENTRY_COLUMNS, "n_rejected"]
    if not sum_tables:
        return aggregate_entries(entries, scope=scope).select(*keep)
    is_sum = F.col("table_name").isin(list(sum_tables))
    identity = [F.when(is_sum, F.col(c)).alias(f"_own_{c}") for c in ("ts", "value", *record)]
    once = entries.groupBy(key_hash(), *scope, *ENTRY_KEY, *identity).agg(
        F.max("ts").alias("ts"), F.max_by("value", F.struct("ts", "value")).alias("value"))
    return aggregate_entries(once, sum_tables, scope=scope).select(*keep)


def plain_number(total: Column) -> Column:
    """A decimal sum as text without trailing zeros; no number at all: ``0``."""
    text = F.coalesce(total.cast("decimal(38,9)"), F.lit(0).cast("decimal(38,9)")).cast("string")
    return F.regexp_replace(text, r"\.?0*$", "")


def sort_entries(entries: DataFrame, partitions: int | None = None, tables: Sequence[str] | None = None) -> DataFrame:
    """Key order for a sorted store: range partitions on the full key (so one
    row key holding a third of the entries still spans many partitions), each
    sorted within.  Partition i holds keys below those of partition i+1.

    ``tables``, all table names that occur in their order (at most 200), lets the sort compare row keys first:
    the table's number is a character in front of them."""
    n = partitions or int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*ENTRY_KEY, "ts", "value"]
    dealt = entries.repartitionByRange(n, *order)
    if not tables:
        return dealt.sortWithinPartitions(*order)
    number = F.coalesce(F.array_position(F.array(*[F.lit(t) for t in tables]), F.col("table_name")), F.lit(0))
    near = F.concat(F.char(number + 1), F.coalesce("row_key", F.lit("")))
    return dealt.withColumn("_near", near).sortWithinPartitions("_near", *order).drop("_near")


def table_counters(entries: DataFrame) -> DataFrame:
    """Entries per output table."""
    return entries.groupBy("table_name").agg(F.count(F.lit(1)).alias("n_entries"))
