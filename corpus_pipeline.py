"""From ``documents`` to a mixed, tokenised corpus in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs: toxic documents go, lines
shared by many documents go, one document of each near-duplicate group stays,
sources are mixed to target weights (documents repeat as the mix takes them),
and the texts are encoded.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intake.llm import line_dedup, mixing, sentencepiece_bpe, simhash, toxicity
from intake.llm.common import frozen, n_words, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows scoring under 0.5 by a lexicon learnt from the labelled rows among them."""
    return toxicity.reject(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 20 characters or more that 3 documents hold stay in the largest doc_id only."""
    out = line_dedup.dedup_lines(docs, min_docs=3, min_chars=20, n_lines="__lines", n_dropped="__dropped")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 3 or fewer of 64 bits over 3-word shingles."""
    return simhash.keep_one(docs, words=3, max_bits=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    size = n_words(F.col("text"))
    return mixing.repeat_rows(docs, mixing.mix(docs, size, F.array("source")), size)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text of every row."""
    return sentencepiece_bpe.digest_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_shared_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

#: Toxicity scores, fingerprints and the encoder are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = frozen(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
