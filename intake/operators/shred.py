"""Record mapping: records -> key/value entries, and per-field metadata.

The reference hands every record to an outside mapper that may emit any number
of entries for any number of tables; the entry layout here is ours (see
``intake.schemas``).  Only built-in expressions are used: one ``inline`` over
an array of structs per record, so the whole map stays inside codegen.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intake.schemas import ENTRY_COLUMNS


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _entry(table, row_key, family, qualifier, ts, value) -> Column:
    return F.struct(
        table.alias("table_name"), row_key.alias("row_key"), family.alias("family"),
        qualifier.alias("qualifier"), ts.alias("ts"), value.alias("value"))


def shred_entries(records: DataFrame, data_type: str, row_key, fields: Mapping[str, object],
                  ts, index_fields: Sequence[str] = (), table: str = "event",
                  index_table: str = "index", carry: Sequence[str] = (),
                  extra: Sequence[Column] = (), reject_table: str | None = "rejected") -> DataFrame:
    """One entry per (record, field) in ``table``; for ``index_fields`` also an
    inverted entry in ``index_table`` (row = value, qualifier = record row).

    ``fields`` maps a qualifier name to a column or expression; its text form is
    the entry value, so the caller picks the formatting (e.g. a fixed-scale
    decimal for money).  Null values make no entry.  ``carry`` columns (e.g.
    ``work_id``) are kept beside every entry; ``extra`` entry structs (e.g.
    counters) are emitted from the same pass over the records.  A record without
    a row key makes one entry of ``reject_table`` (row = md5 of the record,
    family = data type, qualifier ``null_key``, value = the record as JSON)
    instead of vanishing; ``None`` drops it.
    """
    unknown = set(index_fields) - set(fields)
    if unknown:
        raise ValueError(f"index fields not among fields: {sorted(unknown)}")
    rk = _col(row_key).cast("string")
    t = _col(ts).cast("timestamp_ntz")
    dt = F.lit(data_type)
    items = []
    for name, expr in fields.items():
        v = _col(expr).cast("string")
        items.append(_entry(F.lit(table), rk, dt, F.lit(name), t, v))
        if name in index_fields:
            items.append(_entry(F.lit(index_table), v, F.lit(name), rk, t, dt))
    out = (records.select(*carry, F.inline(F.array(*items, *extra)))
           .where(F.col("row_key").isNotNull() & F.col("value").isNotNull()))
    if reject_table is not None:
        # only here are all columns read, and only where the key is null: a test that scans push down
        whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in records.columns]))
        lost = records.where(_col(row_key).isNull()).select(*carry, F.inline(F.array(
            _entry(F.lit(reject_table), F.md5(whole), dt, F.lit("null_key"), t, whole))))
        out = out.unionByName(lost)
    return out.select(*ENTRY_COLUMNS, *carry)


def metadata_updates(entries: DataFrame, table: str = "event",
                     metadata_table: str = "metadata") -> DataFrame:
    """Per (data type, field) of ``table``: how many entries, first and last ts,
    as entries of ``metadata_table`` (row = data type, qualifier = field,
    value = count, ts = last ts) plus a ``first_ts`` column."""
    agg = (entries.where(F.col("table_name") == table)
           .groupBy("family", "qualifier")
           .agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"),
                F.max("ts").alias("last_ts")))
    return agg.select(
        F.lit(metadata_table).alias("table_name"), F.col("family").alias("row_key"),
        F.lit("field").alias("family"), F.col("qualifier"), F.col("last_ts").alias("ts"),
        F.col("n").cast("string").alias("value"), F.col("first_ts"))
