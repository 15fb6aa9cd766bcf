"""Packing of documents into training sequences: bounded-space online packing.

A task reads its documents once and keeps a fixed number of open windows.  Of a
document, whole sequences are cut off first; the rest goes into the window with
the least room that holds it.  Where none does, a new window opens; with all of
them open, the fullest is topped up with the head of the document and emitted,
and the rest of the document is placed again.  So every sequence that a task
emits is full, and a document is cut only at a sequence's end.

The windows still open at a task's end are merged in rounds: those of ``FAN``
tasks are packed again as one group, which emits what fills up and leaves as many
windows as one task, so the last round has one group of bounded size whatever the
input.  What it leaves is cut at ``limit``, its tail into powers of two.

Files: a folder of Parquet files, a row per sequence (or per window left open by
a round):

    part int, seq long      its task or group, and its number there
    sequence_id long        the same and the round, in one number
    doc_ids, starts, lengths, offsets, doc_tokens    arrays: its pieces in order
    bare array<boolean>     whether a piece's document has no id (0 in doc_ids)
    ids binary              its ids, little-endian unsigned 32-bit; null if left open
    left binary             the ids of a window left open, else null

Every round is a table of its own, written before the next one reads it; only
the first touches texts, and a lost executor repeats nothing but its own tasks.
"""

from __future__ import annotations

import struct
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intake.llm.common import small_batches
from intake.llm.token_blocks import END_ID, default_tokenizer, encoder
from intake.session import scratch_dir

LIMIT, WINDOWS, FAN = 4096, 32, 16
BATCH = 256                     # sequences handed on at once
SEQUENCES = ("part int, seq long, sequence_id long, doc_ids array<long>, bare array<boolean>, starts array<long>, "
             "lengths array<int>, offsets array<int>, doc_tokens array<long>, ids binary, left binary")
# a piece: (doc_id, bare, start, doc_tokens, ids)


class Packer:
    """Windows of one task; ``done`` collects full sequences, each a list of pieces."""

    def __init__(self, limit: int = LIMIT, windows: int = WINDOWS):
        self.limit, self.windows = limit, windows
        self.rooms: list[tuple[int, int]] = []        # (room, serial), ascending
        self.held: dict[int, list[tuple]] = {}
        self.serial = 0
        self.done: list[list[tuple]] = []

    def _take(self, at: int, piece: tuple) -> None:
        room, serial = self.rooms.pop(at)
        self.held[serial].append(piece)
        room -= len(piece[4]) // 4
        if room:
            insort(self.rooms, (room, serial))
        else:
            self.done.append(self.held.pop(serial))

    def place(self, doc_id: int, bare: bool, start: int, doc_tokens: int, ids: bytes) -> None:
        """Give a place to all ids of a piece."""
        whole = 4 * self.limit
        while ids:
            size = min(len(ids), whole)
            piece = (doc_id, bare, start, doc_tokens, ids[:size])
            at = bisect_left(self.rooms, (size // 4, -1))
            if size == whole:
                self.done.append([piece])
            elif at < len(self.rooms):
                self._take(at, piece)
            elif len(self.rooms) < self.windows:
                self.held[self.serial] = [piece]
                insort(self.rooms, (self.limit - size // 4, self.serial))
                self.serial += 1
            else:                                     # the fullest is topped up and goes
                size = 4 * self.rooms[0][0]
                self._take(0, (doc_id, bare, start, doc_tokens, ids[:size]))
            start, ids = start + size // 4, ids[size:]

    def leave(self) -> list[list[tuple]]:
        """The windows still open, fullest first."""
        out = [self.held[serial] for _, serial in self.rooms]
        self.rooms, self.held = [], {}
        return out


def cut_rest(windows: list[list[tuple]], limit: int) -> list[list[tuple]]:
    """The last open windows as sequences of ``limit`` ids and, for the tail, of falling powers of two."""
    left = sum(len(p[4]) // 4 for w in windows for p in w)
    out, room = [], 0
    for doc_id, bare, start, doc_tokens, ids in (p for w in windows for p in w):
        while ids:
            if not room:
                room = limit if left >= limit else 1 << (left.bit_length() - 1)
                out.append([])
                left -= room
            size = min(len(ids) // 4, room)
            out[-1].append((doc_id, bare, start, doc_tokens, ids[:4 * size]))
            start, ids, room = start + size, ids[4 * size:], room - size
    return out


def _rows(done: list[list[tuple]], part: int, seq: int, round_: int, left: bool = False) -> pd.DataFrame:
    lengths = [[len(p[4]) // 4 for p in w] for w in done]
    blobs = [b"".join(p[4] for p in w) for w in done]
    none = [None] * len(done)
    return pd.DataFrame({
        "part": part, "seq": range(seq, seq + len(done)),
        "sequence_id": [round_ << 56 | part << 30 | k for k in range(seq, seq + len(done))],
        "doc_ids": [[p[0] for p in w] for w in done], "bare": [[p[1] for p in w] for w in done],
        "starts": [[p[2] for p in w] for w in done], "lengths": lengths, "offsets": [[0, *accumulate(n[:-1])] for n in lengths],
        "doc_tokens": [[p[3] for p in w] for w in done],
        "ids": none if left else blobs, "left": blobs if left else none}, dtype=None if done else object)


def write(docs: DataFrame, folder: str, limit: int = LIMIT, windows: int = WINDOWS, path: str | None = None,
          end_id: int | None = END_ID, id_col: str = "doc_id", text_col: str = "text") -> int:
    """Pack all documents into sequences below ``folder`` (one subfolder a round); returns the number of rounds.

    A document is its whole text's ids and the end id; null texts are empty
    texts, the end id only.  Rows of one id are documents of their own.  Other
    columns are not read; an empty table gives no sequence."""
    if limit < 1 or limit & (limit - 1) or windows < 1:
        raise ValueError("limit must be a power of two and windows at least 1")
    where = path or default_tokenizer()
    end = b"" if end_id is None else struct.pack("<I", end_id)

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e, packer, part, seq = encoder(where), Packer(limit, windows), TaskContext.get().partitionId(), 0
        for pdf in batches:
            for doc_id, lacks, text in zip(pdf["id"].tolist(), pdf["lacks"].tolist(), pdf["text"]):
                ids = e.encode(text or "", end)
                packer.place(doc_id, lacks, 0, len(ids) // 4, ids)
                if len(packer.done) >= BATCH:
                    for k in range(0, len(packer.done), BATCH):
                        out = packer.done[k:k + BATCH]
                        yield _rows(out, part, seq, 0)
                        seq += len(out)
                    packer.done = []
        yield _rows(packer.done, part, seq, 0)
        yield _rows(packer.leave(), part, seq + len(packer.done), 0, left=True)

    def again(round_: int, last: bool):
        def group(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            packer, part = Packer(limit, windows), int(key[0])
            for row in pdf.sort_values(["part", "seq"]).itertuples():
                at = 0
                for doc_id, bare, start, n, doc_tokens in zip(row.doc_ids, row.bare, row.starts, row.lengths, row.doc_tokens):
                    packer.place(int(doc_id), bool(bare), int(start), int(doc_tokens), row.left[4 * at:4 * (at + int(n))])
                    at += int(n)
            left = packer.leave()
            if last:
                packer.done, left = packer.done + cut_rest(left, limit), []
            return pd.concat([_rows(packer.done, part, 0, round_), _rows(left, part, len(packer.done), round_, left=True)])
        return group

    spark = docs.sparkSession
    i = F.col(id_col).cast("long")
    (small_batches(docs).select(F.coalesce(i, F.lit(0).cast("long")).alias("id"), i.isNull().alias("lacks"),
                                F.col(text_col).alias("text"))
     .mapInPandas(first, SEQUENCES).write.parquet(f"{folder}/round=0"))
    round_ = 0
    while True:
        # of the rows left open only: ids of full sequences are a column of their own and not read
        left = spark.read.schema(SEQUENCES).parquet(f"{folder}/round={round_}").where("left is not null").drop("ids", "sequence_id")
        parts = left.agg(F.max("part")).first()[0]
        round_ += 1
        if parts is None:
            return round_
        (left.groupBy((F.col("part") / FAN).cast("int").alias("group")).applyInPandas(again(round_, parts < FAN), SEQUENCES)
         .write.parquet(f"{folder}/round={round_}"))


def read(spark: SparkSession, folder: str, rounds: int) -> DataFrame:
    """The sequences: (sequence_id, ids, pieces), pieces an array of (doc_id, start, length, doc_tokens, offset)."""
    seqs = spark.read.schema(SEQUENCES).parquet(*[f"{folder}/round={r}" for r in range(rounds)]).where("ids is not null")
    zipped = F.arrays_zip("doc_ids", "bare", "starts", "lengths", "doc_tokens", "offsets")
    return seqs.select("sequence_id", "ids", F.transform(zipped, lambda p: F.struct(
        F.when(~p["bare"], p["doc_ids"]).alias("doc_id"), p["starts"].alias("start"), p["lengths"].cast("long").alias("length"),
        p["doc_tokens"].alias("doc_tokens"), p["offsets"].cast("long").alias("offset"))).alias("pieces"))


def pack(docs: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """The sequences of all documents, from files just written."""
    folder = folder or scratch_dir(docs.sparkSession, "packed")
    return read(docs.sparkSession, folder, write(docs, folder, **options))


def pieces(sequences: DataFrame) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one row per piece."""
    one = F.transform("pieces", lambda p: F.struct(
        p["doc_id"].alias("doc_id"), p["start"].alias("start"), p["length"].alias("length"),
        F.crc32(F.substring(F.col("ids"), (4 * p["offset"] + 1).cast("int"), (4 * p["length"]).cast("int"))).alias("ids_crc32"),
        p["doc_tokens"].alias("doc_tokens"), F.col("sequence_id").alias("sequence_id"), p["offset"].alias("offset")))
    return sequences.select(F.inline(one))
