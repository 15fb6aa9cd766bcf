"""Token ids in patched frame-of-reference blocks.

File format: a folder of Parquet files, one per output partition, partitions in
ascending doc_id order.  A row is a segment of whole documents:

    part int            position of the file
    seq long            position of the segment in its file
    doc_ids, lengths    its documents and their numbers of ids
    bare int            how many of its first documents have no id (0 in doc_ids)
    first long          ids in the file before the segment
    block_at array      byte offset of each block in ``blocks`` (the index)
    blocks binary       the blocks, one after the other

A block holds up to ``BLOCK`` ids: header ``<IIHBx`` (number of ids, minimum,
number of exceptions, width), the ids less the block's minimum packed at ``width`` bits
(little-endian bit order; the width holds ``PERCENTILE`` percent of them), then
the exceptions: their positions (``<u2``) and differences (``<u4``).

Documents are range-partitioned by doc_id before encoding, so each text crosses
the network once and every task writes its own file; the only thing gathered is
one total per output file.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intake.llm.common import small_batches
from intake.session import scratch_dir

BLOCK, PERCENTILE, SEGMENT = 4096, 90, 1 << 19
END_ID = 2
CACHE = 600_000                # words a worker remembers
_HEAD = struct.Struct("<IIHBx")
SEGMENTS = ("part int, seq long, doc_ids array<long>, bare int, lengths array<long>, first long, "
            "block_at array<int>, blocks binary")
KEPT = ("doc_ids", "bare", "lengths", "first", "block_at", "blocks")
# the tokenizer drops white space, so no id spans one of these
_WORD = re.compile(r"[^ \t-\r]+")
# in lower-cased Latin-1 text, its own split: contractions, letters, one digit, other signs
_LATIN = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^\t-\r \x85\xa0a-zªµºß-öø-ÿ0-9²³¹¼½¾]+")


# fixed values: the split and the normalisers that ``split_words`` stands for
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = ["NFC", "Replace", "Lowercase"]


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for letters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def split_words(text: str) -> tuple[list[str], bool]:
    """Parts of a text that are encoded on their own, each to the ids it has in the
    whole, and whether they are the tokenizer's own words.

    Lower-casing and normalising change nothing else in Latin-1, so there the
    parts are the tokenizer's own words; other texts, and those that may hold a
    special token, are split at ASCII white space only."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return _WORD.findall(text), False
    return (_WORD.findall(text), False) if "<|" in text else (_LATIN.findall(text.lower()), True)


def pack(ids: np.ndarray) -> bytes:
    """One block."""
    low = int(ids.min()) if len(ids) else 0
    rest = ids.astype(np.uint32) - np.uint32(low)
    at = min(len(ids) - 1, len(ids) * PERCENTILE // 100)
    width = int(np.partition(rest, at)[at]).bit_length() if len(ids) else 0
    out = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.empty(0, np.int64)
    bits = ((rest[:, None] >> np.arange(width, dtype=np.uint32)) & np.uint32(1)).astype(np.uint8)
    return (_HEAD.pack(len(ids), low, len(out), width) + np.packbits(bits.ravel(), bitorder="little").tobytes()
            + out.astype("<u2").tobytes() + rest[out].astype("<u4").tobytes())


def unpack(blob: bytes, at: int = 0) -> np.ndarray:
    """The ids of the block that starts at a byte offset."""
    n, low, patched, width = _HEAD.unpack_from(blob, at)
    at += _HEAD.size
    size = (n * width + 7) // 8
    bits = np.unpackbits(np.frombuffer(blob, np.uint8, size, at), count=n * width, bitorder="little").reshape(n, width)
    ids = np.zeros(n, np.uint32)
    for k in range(width):
        ids |= bits[:, k].astype(np.uint32) << np.uint32(k)
    at += size
    where = np.frombuffer(blob, "<u2", patched, at)
    ids[where] = np.frombuffer(blob, "<u4", patched, at + 2 * patched)
    return ids + np.uint32(low)


def pack_all(ids: np.ndarray) -> tuple[list[int], bytes]:
    """Block offsets and blocks of any number of ids."""
    at, blocks, size = [], [], 0
    for k in range(0, len(ids), BLOCK):
        blocks.append(pack(ids[k:k + BLOCK]))
        at.append(size)
        size += len(blocks[-1])
    return at, b"".join(blocks)


class Encoder:
    """Whole texts to ids through a tokenizers file; equal words are encoded once a worker."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        made = json.loads(self.tokenizer.to_str())
        normal = [n["type"] for n in (made["normalizer"] or {}).get("normalizers", [])]
        first = (made["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0]
        known = normal == NORMALIZERS and first.get("pattern", {}).get("Regex") == PATTERN and first.get("invert")
        self.split = split_words if known else (lambda text: ([text] if text else [], False))  # other tokenizers: whole texts
        self.letters = byte_letters()
        self.seen: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def learn(self, words: list[str], own: bool) -> dict[str, bytes]:
        if own:  # past normalising and splitting: straight to the merges
            merge, letters = self.tokenizer.model.tokenize, self.letters
            made = [[t.id for t in merge(w if w.isascii() and w.isalpha() else "".join([letters[b] for b in w.encode()]))]
                    for w in words]
            return {w: struct.pack(f"<{len(ids)}I", *ids) for w, ids in zip(words, made)}
        made = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return {w: struct.pack(f"<{len(ids)}I", *ids) for w, ids in zip(words, [e.ids for e in made])}

    def encode(self, text: str, extra: bytes) -> bytes:
        """Ids as little-endian unsigned 32-bit integers, with ``extra`` at the end."""
        words, own = self.split(text)
        found = list(map(self.seen.get, words))
        if None in found:
            new = list({w for w, f in zip(words, found) if f is None})
            known = {w: b for w, b in zip(new, map(self.older.get, new)) if b is not None}
            missing = [w for w in new if w not in known]
            for k in range(0, len(missing), 4096):
                known |= self.learn(missing[k:k + 4096], own)
            found = [known[w] if f is None else f for w, f in zip(words, found)]
            if len(self.seen) + len(known) > CACHE // 2:  # two generations: what is in use stays
                self.older, self.seen = self.seen, {}
            if len(known) <= CACHE // 2:
                self.seen.update(known)
        found.append(extra)
        return b"".join(found)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def write(docs: DataFrame, folder: str, path: str | None = None, end_id: int | None = END_ID,
          id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text and write ids in ascending doc_id order (null ids
    first; rows of one id by text).  Null texts are empty texts: the end id only."""
    where = path or default_tokenizer()
    end = b"" if end_id is None else struct.pack("<I", end_id)

    def segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = encoder(where)
        part, seq, first = TaskContext.get().partitionId(), 0, 0
        ids: list[bytes] = []
        names: list[int] = []
        size = bare = 0

        def flush() -> pd.DataFrame:
            nonlocal seq, first, ids, names, size, bare
            at, blob = pack_all(np.frombuffer(b"".join(ids), "<u4"))
            row = pd.DataFrame({"part": [part], "seq": [seq], "doc_ids": [names], "bare": [bare], "lengths": [[len(i) // 4 for i in ids]],
                                "first": [first], "block_at": [at], "blocks": [blob]})
            seq, first, ids, names, size, bare = seq + 1, first + size, [], [], 0, 0
            return row

        for pdf in batches:
            for doc_id, lacks, text in zip(pdf["id"].tolist(), pdf["lacks"].tolist(), pdf["text"]):
                own = e.encode(text or "", end)
                if ids and size + len(own) // 4 > SEGMENT:
                    yield flush()
                ids.append(own)
                names.append(doc_id)
                bare += lacks
                size += len(own) // 4
        if ids:
            yield flush()

    (small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
     .repartitionByRange(F.col("doc_id")).sortWithinPartitions("doc_id", "text")
     .select(F.coalesce("doc_id", F.lit(0).cast("long")).alias("id"), F.col("doc_id").isNull().alias("lacks"), "text")
     .mapInPandas(segments, SEGMENTS).write.parquet(folder))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids as little-endian binary) of every document, from the files.
    start counts the ids of all documents before it."""
    seg = spark.read.schema(SEGMENTS).parquet(folder)
    # one row per file, however many documents: small enough for the driver
    totals = seg.groupBy("part").agg(F.max(F.col("first") + F.aggregate(
        "lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n")).orderBy("part").collect()
    before, offsets = 0, []
    for r in totals:
        offsets.append((r["part"], before))
        before += r["n"]
    offsets = spark.createDataFrame(offsets, "part int, before long")

    def docs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for names, bare, lengths, start, at, blob in zip(*(pdf[c] for c in KEPT)):
                lengths = np.asarray(lengths, np.int64)
                ids = (np.concatenate([unpack(blob, int(a)) for a in at]) if len(at) else np.empty(0, np.uint32)).astype("<u4")
                ends = np.cumsum(lengths)
                yield pd.DataFrame({
                    "doc_id": pd.arrays.IntegerArray(np.asarray(names, np.int64), np.arange(len(names)) < bare),
                    "start": start + ends - lengths, "n_tokens": lengths,
                    "ids": [ids[b - n:b].tobytes() for b, n in zip(ends, lengths)]})

    return (seg.join(F.broadcast(offsets), "part")
            .withColumn("first", F.col("before") + F.col("first")).select(*KEPT)
            .mapInPandas(docs, "doc_id long, start long, n_tokens long, ids binary"))


def round_trip(docs: DataFrame, path: str | None = None, folder: str | None = None, **cols) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32), one row per input row, from files just written.

    An empty table writes no segment and gives no row; other columns are not read."""
    spark = docs.sparkSession
    folder = folder or scratch_dir(spark, "token-blocks")
    write(docs, folder, path, **cols)
    return read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
