"""SimHash near-dedup by meet-in-the-middle ball hashing.

A fingerprint has 64 bits: bit i is set when it is set in more than half of
the XXH64 values of the document's word shingles.  Two fingerprints link when
they differ in at most ``max_bits`` bits, and links are closed to components.

Every fingerprint emits the variants in the ball of half the distance around
it; two fingerprints within the distance share a variant.  The ball is emitted
in two steps so that few rows cross the network: of a linked pair, one 32-bit
half differs in at most ``max_bits // 2`` bits, so a fingerprint is shuffled
once per half under that half's few variants, and the variants of the other
half are generated after the shuffle, only where a half-variant is shared.
At a shared full variant the emitter with the fewest flips is the centre of a
star to the others: flips of both add up to at most ``max_bits``, so every edge
is a true link (it is verified on the fingerprints), all links are covered,
and a group of n near copies makes edges in proportion to n, not to its square.

Equal fingerprints are one node, so exact copies cost one row.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from intake.llm.common import cut, frozen, small_batches
from intake.llm.graph import connected_components

SEED = 42
CHUNK = 1 << 16


def fingerprint(text: str | None, words: int = 3) -> int:
    """Fingerprint of one text as an unsigned integer; no word: zero."""
    import xxhash

    found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not found:
        return 0
    if len(found) < words:
        shingles = [b" ".join(found)]
    else:
        shingles = map(b" ".join, zip(*(found[i:] for i in range(words))))
    digest = xxhash.xxh64_digest
    hashes = np.frombuffer(b"".join([digest(s, SEED) for s in shingles]), np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        ones += np.unpackbits(hashes[at:at + CHUNK], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): one row per input row, fp as a signed long."""
    @F.pandas_udf("long")
    def fp(text: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, words) for t in text], np.uint64).view(np.int64))

    return small_batches(docs).select(F.col(id_col).alias("doc_id"), fp(F.col(text_col)).alias("fp"))


def _masks(bits: int, most: int) -> list[int]:
    """All masks of at most ``most`` of ``bits`` bits."""
    return [sum(1 << i for i in c) for k in range(most + 1) for c in combinations(range(bits), k)]


def _array(masks: list[int]):
    return F.array(*[F.lit(m).cast("long") for m in masks])


def star_edges(fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """Distinct fingerprints (fp) -> (a, b) links whose closure has every pair within ``max_bits``."""
    if not 0 <= max_bits <= 5:
        raise ValueError("max_bits must be from 0 to 5: the ball grows with the power of half of it")
    low, most = max_bits // 2, -(-max_bits // 2)
    half = 0xFFFFFFFF
    # the half's own value and its variants, tagged with the half in bit 32
    hi, lo = F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(F.lit(half))
    tag = 1 << 32
    sent = fps.select("fp", F.explode(_array(
        [m for m in _masks(32, low)] + [m | tag for m in _masks(32, low)])).alias("m")).select(
        F.when(F.col("m") < tag, hi.bitwiseXOR(F.col("m"))).otherwise(lo.bitwiseXOR(F.col("m"))).alias("k"), "fp")
    # flips already made (r) and the other half follow from the row
    own = F.when(F.col("k") < tag, hi).otherwise(lo)
    rest = F.when(F.col("k") < tag, lo).otherwise(hi)
    by_key = Window.partitionBy("k")
    shared = (sent.withColumn("r", F.bit_count(own.bitwiseXOR(F.col("k").bitwiseAND(F.lit(half)))))
              .withColumn("n", F.count(F.lit(1)).over(by_key))
              .withColumn("least", F.min("r").over(by_key))
              .where("n > 1 and least = 0"))
    ball = F.lit(None)
    for r in range(low, -1, -1):
        ball = F.when(F.col("r") == r, _array(_masks(32, most - r))).otherwise(ball)
    variants = (shared.select("k", "fp", "r", rest.alias("o"), F.explode(ball).alias("m"))
                .select("k", "fp", F.col("o").bitwiseXOR(F.col("m")).alias("v"),
                        (F.col("r") + F.bit_count("m")).alias("flips")))
    centre = F.min(F.struct("flips", "fp")).over(Window.partitionBy("k", "v"))
    return (variants.withColumn("c", centre)
            .where(F.col("c.fp") != F.col("fp"))
            .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("c.fp"))) <= max_bits)
            .select(F.col("fp").alias("a"), F.col("c.fp").alias("b")).distinct())


def simhash_components(docs: DataFrame, words: int = 3, max_bits: int = 3,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id), one row per input row.

    component_id is the smallest id reachable over links, the row's own id
    included.  Null and wordless texts have fingerprint zero and link like any
    other.  Rows with a null id take part; a component of null ids only has a
    null component_id.  Repeated rows are repeated in the result.  Other input
    columns are not read, whatever their names."""
    prints = frozen(fingerprints(docs, words, id_col, text_col), "simhash")
    nodes = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    found = connected_components(star_edges(nodes.select("fp"), max_bits))
    linked = cut(found.join(nodes, found["node"] == nodes["fp"]).select("fp", "component", "first"))
    least = cut(linked.groupBy("component").agg(F.min("first").alias("linked_id")))
    linked = linked.join(least, "component").select("fp", "linked_id")
    named = cut(nodes.join(linked, "fp", "left").select(
        "fp", F.coalesce("linked_id", "first").alias("component_id")))
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, words: int = 3, max_bits: int = 3,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` with one document of each component: the one with the smallest id.

    Repeated rows of that id are one document: of different ones the first by a hash of
    its text, then of the whole row.  Rows with a null id stay only where their
    component has no id at all, one of each."""
    found = simhash_components(docs, words, max_bits, id_col, text_col)
    ids = cut(found.where("doc_id is not null and doc_id = component_id").select("doc_id").distinct())
    order = F.struct(F.xxhash64(text_col), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    kept = (docs.join(ids, docs[id_col] == ids["doc_id"], "left_semi").groupBy(id_col)
            .agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), order).alias("__row")).select("__row.*"))
    # ids are null in a component without any id: as a rule there is none
    bare = docs.where(F.col(id_col).isNull())
    if bare.isEmpty():
        return kept
    lone = found.where("component_id is null").select("fp").distinct()
    marked = _lone_rows(bare, lone, words, text_col)
    return kept.unionByName(marked)


def _lone_rows(bare: DataFrame, lone: DataFrame, words: int, text_col: str) -> DataFrame:
    """One row for each fingerprint that only rows without id have."""
    @F.pandas_udf("long")
    def fp(text: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, words) for t in text], np.uint64).view(np.int64))

    return (small_batches(bare).withColumn("__fp", fp(F.col(text_col))).join(lone.withColumnRenamed("fp", "__fp"), "__fp", "left_semi")
            .dropDuplicates(["__fp"]).drop("__fp"))
