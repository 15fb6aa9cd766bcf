"""Read written key/value entries back (bulk outputs or bundles)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from intake.schemas import ENTRY_DDL

BULK_COLUMNS = "work_id string, batch_id string, bucket int"


def read_entries(spark: SparkSession, path: str | list[str],
                 extra: str | None = BULK_COLUMNS) -> DataFrame:
    """Entries with the fixed schema plus ``extra`` columns (a DDL list: the
    bulk layout's ``work_id`` and partition folders, or ``bundle_id``), never
    inferred."""
    schema = ENTRY_DDL + (f", {extra}" if extra else "")
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.schema(schema).parquet(*paths)
