"""Skew-safe running totals per group.

A plain ``Window.partitionBy(feed).orderBy(...)`` puts a whole feed into one
task; a feed holding a third of all files would then be one long task that
must buffer all its rows.  Instead:

1. range-partition on (group, order) into ``chunks`` slices, sorted within — a
   hot group is cut into many consecutive slices, each its own task; this is
   the only time a row is shuffled;
2. running totals inside each slice, batch by batch with the last total carried
   on (a window would shuffle the rows once more to find its groups);
3. freeze the slices with ``checkpoint()`` (reliable storage under
   ``spark.checkpoint.dir``), so a lost executor cannot re-slice the data;
4. per (group, slice) totals — at most ``chunks + groups`` rows — get their
   offsets from a window over that small table, which is broadcast if its
   counted rows allow it;
5. each row's total = slice offset + running total inside its slice.

The ``order`` columns must be a total order inside a group (e.g. end with a
unique path), otherwise ties make the totals arbitrary.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from intake.operators.joins import broadcast_if_small
from intake.session import checkpoint_dir


def _slice_totals(by: list[str], cols: list[str]):
    """For ``mapInArrow`` over sorted slices: per column of ``cols`` its sum over
    the group's earlier rows in the slice.  Holds one batch and one row's totals."""
    def new_group(batch, last):
        """Where a row's group differs from the row before (nulls are equal)."""
        out = np.zeros(batch.num_rows, bool)
        for c in by:
            col = batch.column(batch.schema.get_field_index(c))
            here, before = col.slice(1), col.slice(0, len(col) - 1)
            differs = pc.or_(pc.fill_null(pc.not_equal(here, before), False), pc.xor(pc.is_null(here), pc.is_null(before)))
            out[1:] |= differs.to_numpy(zero_copy_only=False)
        out[0] = last is not None and last != [batch.column(batch.schema.get_field_index(c))[0].as_py() for c in by]
        return out

    def run(batches):
        last, carry = None, [0] * len(cols)
        for batch in batches:
            if not batch.num_rows:
                continue
            starts = new_group(batch, last)
            group = np.cumsum(starts)
            first = np.flatnonzero(np.r_[True, starts[1:]])
            first = first[group - group[0]]
            arrays = list(batch.columns)
            for k, c in enumerate(cols):
                v = pc.fill_null(batch.column(batch.schema.get_field_index(c)).cast(pa.int64()), 0).to_numpy(zero_copy_only=False)
                before = np.cumsum(v) - v
                local = before - before[first]
                if not starts[0]:
                    local = local + np.where(group == 0, carry[k], 0)
                carry[k] = int(local[-1] + v[-1])
                arrays.append(pa.array(local, pa.int64()))
            last = [batch.column(batch.schema.get_field_index(c))[-1].as_py() for c in by]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, *[f"_loc{c}" for c in cols]])

    return run


def running_totals(df: DataFrame, by: Sequence[str], order: Sequence[str],
                   sums: Sequence[str] = (), chunks: int | None = None,
                   seq_col: str = "seq") -> DataFrame:
    """Add ``seq_col`` (1-based position in group) and, per column ``c`` of
    ``sums`` (whole numbers), ``c_before``: the sum of ``c`` over earlier rows
    of the group."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = chunks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    by, order, sums = list(by), list(order), list(sums)
    cols = ["_one", *sums]
    ranged = (df.withColumn("_one", F.lit(1).cast("long"))
              .repartitionByRange(n, *by, *order).sortWithinPartitions(*by, *order)
              .withColumn("_chunk", F.spark_partition_id()))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in ranged.schema]
                          + [T.StructField(f"_loc{c}", T.LongType()) for c in cols])
    local = ranged.mapInArrow(_slice_totals(by, cols), schema).checkpoint(eager=True)

    totals = local.groupBy(*by, "_chunk").agg(*[F.sum(c).alias(c) for c in cols])
    before_chunk = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by, "_chunk",
        *[F.coalesce(F.sum(c).over(before_chunk), F.lit(0)).alias(f"_off{c}") for c in cols]).checkpoint()
    return _attach(local, offsets, by, cols, seq_col)


def _attach(local: DataFrame, offsets: DataFrame, by: Sequence[str], cols: Sequence[str],
            seq_col: str) -> DataFrame:
    off = offsets.select(*[F.col(c).alias(f"_k_{c}") for c in [*by, "_chunk"]],
                         *[F.col(f"_off{c}") for c in cols])
    cond = reduce(lambda a, b: a & b,
                  [local[c].eqNullSafe(off[f"_k_{c}"]) for c in [*by, "_chunk"]])
    j = local.join(broadcast_if_small(off), cond, "inner")
    out = j.withColumn(seq_col, F.col("_off_one") + F.col("_loc_one") + 1)
    for c in cols[1:]:
        out = out.withColumn(f"{c}_before", F.col(f"_off{c}") + F.col(f"_loc{c}"))
    drop = ([f"_k_{c}" for c in [*by, "_chunk"]] + [f"_off{c}" for c in cols]
            + [f"_loc{c}" for c in cols] + ["_one", "_chunk"])
    return out.drop(*drop)
