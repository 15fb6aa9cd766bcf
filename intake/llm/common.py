"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from intake.session import checkpoint_dir, scratch_dir

# white space of every word rule here: space, tab, line feed, vertical tab, form feed, carriage return
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and text of the whole ``documents`` table."""
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def small_batches(df: DataFrame, rows: int = 1000) -> DataFrame:
    """``df``, with texts going to Python workers in batches of few rows: a worker
    holds a batch of whole texts at a time, and texts may be long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(key)) <= rows:
        conf.set(key, str(rows))
    return df


def cut(df: DataFrame) -> DataFrame:
    """Evaluate a narrow table once and cut its lineage: a reliable checkpoint
    in the session's shared folder, so it survives lost executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def frozen(df: DataFrame, name: str) -> DataFrame:
    """Evaluate a larger table once into Parquet below the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z, nothing else; texts of ASCII only take the faster way."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def words(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a text; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def n_words(text: Column) -> Column:
    """Their number."""
    return F.size(words(text)).cast("long")
