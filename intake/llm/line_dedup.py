"""Reversible line dedup: sharded cuckoo filters over exact reference counts.

State (two tables):

* ``refs``: exact (k1, k2, doc_id, n) reference counts, a row for each line key
  and document (k1, k2: two independently seeded XXH64 of the key, 128 bits);
* ``filters``: one chain of cuckoo filters per shard, holding the keys that at
  least ``min_docs`` documents refer to.

``insert`` adds documents, ``delete`` takes documents out; both update the
counts exactly and move only the keys that crossed the threshold in or out of
their shard's filter, so a deletion undoes an insertion.  ``drops`` probes
lines against the filters and settles every hit with the exact counts, so a
filter's false positive never drops a line.  Lines are never gathered by key:
a line that a third of all documents hold is counted with partial aggregation
and probed in salted groups of bounded size.

Rows without doc_id own no line: they are not counted and keep all lines.
Repeated rows of a doc_id count as one document.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intake.llm.common import SPACES, ascii_lower, cut, frozen

MIN_CHARS, MIN_DOCS = 20, 3
SHARD_KEYS = 50_000     # keys of one shard's first filter, about
GROUP_ROWS = 200_000    # rows probed by one group, about
REFS = "k1 long, k2 long, doc_id long, n long"
FILTERS = "shard int, blob binary"


class CuckooFilter:
    """Partial-key cuckoo filter: 4 slots a bucket, 16-bit fingerprints, and a
    stash for what finds no slot.  Equal fingerprints may be stored repeatedly,
    so removal takes out one copy."""

    SLOTS, KICKS = 4, 200

    def __init__(self, capacity: int):
        need = max(2, int(capacity / (self.SLOTS * 0.9)) + 1)
        self.slots = np.zeros((1 << (need - 1).bit_length(), self.SLOTS), np.uint16)
        self.stash: list[tuple[int, int]] = []

    def places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h = h.astype(np.uint64)
        mask = np.uint64(len(self.slots) - 1)
        tags = (h >> np.uint64(48)).astype(np.uint16)
        tags[tags == 0] = 1
        first = h & mask
        return tags, first.astype(np.int64), (first ^ (self.spread(tags) & mask)).astype(np.int64)

    @staticmethod
    def spread(tags) -> np.ndarray:
        return (np.asarray(tags, np.uint64) * np.uint64(0x5BD1E995)) ^ (np.asarray(tags, np.uint64) << np.uint64(7))

    def contains(self, h: np.ndarray) -> np.ndarray:
        tags, one, two = self.places(h)
        found = (self.slots[one] == tags[:, None]).any(1) | (self.slots[two] == tags[:, None]).any(1)
        if self.stash:
            kept = set(self.stash)
            found |= np.array([(int(t), min(a, b)) in kept for t, a, b in zip(tags, one.tolist(), two.tolist())], bool)
        return found

    def add(self, h: np.ndarray) -> None:
        mask = len(self.slots) - 1
        for tag, one, two in zip(*(x.tolist() for x in self.places(h))):
            at, held = one, tag
            for kick in range(self.KICKS):
                for place in (at, at ^ (int(self.spread(held)) & mask)) if kick else (one, two):
                    free = np.flatnonzero(self.slots[place] == 0)
                    if len(free):
                        self.slots[place, free[0]] = held
                        break
                else:
                    place = at ^ (int(self.spread(held)) & mask)
                    slot = kick % self.SLOTS
                    held, self.slots[place, slot] = int(self.slots[place, slot]), held
                    at = place
                    continue
                break
            else:
                self.stash.append((held, min(at, at ^ (int(self.spread(held)) & mask))))

    def remove(self, h: np.ndarray) -> np.ndarray:
        """Takes out one copy of each; False where there was none."""
        done = []
        for tag, one, two in zip(*(x.tolist() for x in self.places(h))):
            for place in (one, two):
                held = np.flatnonzero(self.slots[place] == tag)
                if len(held):
                    self.slots[place, held[0]] = 0
                    done.append(True)
                    break
            else:
                entry = (tag, min(one, two))
                done.append(entry in self.stash)
                if done[-1]:
                    self.stash.remove(entry)
        return np.array(done, bool)

    def load(self) -> float:
        return (np.count_nonzero(self.slots) + len(self.stash)) / self.slots.size


class Chain:
    """Filters of one shard; a full one is followed by one for the keys at hand."""

    def __init__(self, blob: bytes | None = None):
        self.filters: list[CuckooFilter] = []
        at = 0
        while blob and at < len(blob):
            buckets, stashed = struct.unpack_from("<II", blob, at)
            at += 8
            f = CuckooFilter(1)
            size = buckets * CuckooFilter.SLOTS
            f.slots = np.frombuffer(blob, "<u2", size, at).reshape(buckets, -1).copy()
            at += 2 * size
            pairs = np.frombuffer(blob, "<u4", 2 * stashed, at).reshape(-1, 2)
            f.stash = [(int(a), int(b)) for a, b in pairs]
            at += 8 * stashed
            self.filters.append(f)

    def blob(self) -> bytes:
        return b"".join(struct.pack("<II", len(f.slots), len(f.stash)) + f.slots.astype("<u2").tobytes()
                        + np.array(f.stash, "<u4").reshape(-1).tobytes() for f in self.filters)

    def contains(self, h: np.ndarray) -> np.ndarray:
        found = np.zeros(len(h), bool)
        for f in self.filters:
            found |= f.contains(h)
        return found

    def add(self, h: np.ndarray) -> None:
        while len(h):
            if not self.filters or self.filters[-1].load() >= 0.9:
                self.filters.append(CuckooFilter(max(len(h), 64)))
            last = self.filters[-1]
            room = max(1, int(last.slots.size * 0.9) - int(np.count_nonzero(last.slots)))
            last.add(h[:room])
            h = h[room:]

    def remove(self, h: np.ndarray) -> None:
        """The largest filter first: keys that cannot be told apart there cannot be in a
        smaller one, so where another key's copy is taken, the one left serves that key."""
        for f in sorted(self.filters, key=lambda f: -len(f.slots)):
            if len(h):
                h = h[~f.remove(h)]


@dataclass
class LineIndex:
    refs: DataFrame
    filters: DataFrame
    shards: int
    min_docs: int = MIN_DOCS
    min_chars: int = MIN_CHARS


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("k1"), F.xxhash64(F.lit(1), key).alias("k2")]


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_refs(docs: DataFrame, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Exact reference counts of the keys of at least ``min_chars`` code points."""
    return (docs.where(F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("doc_id"), F.explode(_lines(F.col(text_col))).alias("line"))
            .select("doc_id", line_key(F.col("line")).alias("key"))
            .where(F.length("key") >= min_chars)
            .select("doc_id", *_hashes(F.col("key")))
            .groupBy("k1", "k2", "doc_id").agg(F.count(F.lit(1)).alias("n")).select("k1", "k2", "doc_id", "n"))


def common_keys(refs: DataFrame, min_docs: int) -> DataFrame:
    """Keys that at least ``min_docs`` documents refer to, and the largest of these documents."""
    return (refs.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("top"))
            .where(F.col("docs") >= min_docs))


def _shard(shards: int) -> Column:
    return F.pmod(F.col("k2"), F.lit(shards)).cast("int").alias("shard")


def _move(old: DataFrame, moved: DataFrame) -> DataFrame:
    """Shards' filters after keys (shard, k1, up) went in or out."""
    def update(key: tuple, blobs: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
        chain = Chain(bytes(blobs["blob"].iloc[0]) if len(blobs) else None)
        h = keys["k1"].to_numpy(np.int64).view(np.uint64)
        up = keys["up"].to_numpy(bool)
        order = np.argsort(h, kind="stable")  # a rerun builds the same filter
        chain.remove(h[order][~up[order]])
        chain.add(h[order][up[order]])
        return pd.DataFrame({"shard": [key[0]], "blob": [chain.blob()]})

    return old.groupBy("shard").cogroup(moved.groupBy("shard")).applyInPandas(update, FILTERS)


def empty_index(spark, shards: int = 16, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> LineIndex:
    return LineIndex(spark.createDataFrame([], REFS), spark.createDataFrame([], FILTERS), shards, min_docs, min_chars)


def build(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, **cols) -> LineIndex:
    """Index of a first batch; the shards follow the number of keys to hold."""
    refs = frozen(line_refs(docs, min_chars, **cols), "line-refs")
    shared = cut(common_keys(refs, min_docs))
    shards = max(1, -(-shared.count() // SHARD_KEYS))
    index = empty_index(docs.sparkSession, shards, min_docs, min_chars)
    moved = shared.select(_shard(shards), "k1", F.lit(True).alias("up"))
    index.refs, index.filters = refs, cut(_move(index.filters, moved))
    return index


def _changed(index: LineIndex, refs: DataFrame, touched: DataFrame) -> LineIndex:
    """The index with other refs, of which only the touched keys differ."""
    was = common_keys(index.refs.join(touched, ["k1", "k2"], "left_semi"), index.min_docs).select("k1", "k2")
    now = common_keys(refs.join(touched, ["k1", "k2"], "left_semi"), index.min_docs).select("k1", "k2")
    moved = (now.join(was, ["k1", "k2"], "left_anti").withColumn("up", F.lit(True))
             .unionByName(was.join(now, ["k1", "k2"], "left_anti").withColumn("up", F.lit(False)))
             .select(_shard(index.shards), "k1", "up"))
    return LineIndex(refs, cut(_move(index.filters, moved)), index.shards, index.min_docs, index.min_chars)


def insert(index: LineIndex, docs: DataFrame, **cols) -> LineIndex:
    """The index with more documents; lines of a doc_id already there add to its counts."""
    new = cut(line_refs(docs, index.min_chars, **cols))
    refs = frozen(index.refs.unionByName(new).groupBy("k1", "k2", "doc_id").agg(F.sum("n").alias("n"))
                  .select("k1", "k2", "doc_id", "n"), "line-refs")
    return _changed(index, refs, new.select("k1", "k2").distinct())


def delete(index: LineIndex, ids: DataFrame) -> LineIndex:
    """The index without the documents of ``ids`` (doc_id)."""
    ids = ids.select(F.col("doc_id").cast("long")).distinct()
    gone = cut(index.refs.join(ids, "doc_id", "left_semi").select("k1", "k2").distinct())
    refs = frozen(index.refs.join(ids, "doc_id", "left_anti").select("k1", "k2", "doc_id", "n"), "line-refs")
    return _changed(index, refs, gone)


def salted(pairs: DataFrame, shards: int) -> tuple[DataFrame, DataFrame]:
    """(shard, salt, k1, k2, doc_id), about ``GROUP_ROWS`` of them a shard and salt, and
    (shard, salts), from each shard's own rows: one may hold a line of most documents."""
    pairs = pairs.select(_shard(shards), "k1", "k2", "doc_id")
    salts = cut(pairs.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / GROUP_ROWS).cast("int").alias("salts")))
    salt = F.pmod(F.xxhash64("doc_id"), F.col("salts")).cast("int").alias("salt")
    # a row for each of the shards, of which there is one per SHARD_KEYS keys
    return pairs.join(F.broadcast(salts), "shard").select("shard", salt, "k1", "k2", "doc_id"), salts


def drops(index: LineIndex, pairs: DataFrame) -> DataFrame:
    """(doc_id, drop): the sorted keys, as (k1, k2) structs, whose lines each document loses.

    pairs: (k1, k2, doc_id) of the documents to clean."""
    lines, salts = salted(pairs, index.shards)
    blobs = index.filters.join(salts, "shard").select(
        "shard", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "blob")

    def probe(keys: pd.DataFrame, blobs: pd.DataFrame) -> pd.DataFrame:
        if not len(blobs) or not len(keys):
            return keys.iloc[:0][["k1", "k2", "doc_id"]]
        chain = Chain(bytes(blobs["blob"].iloc[0]))
        return keys.loc[chain.contains(keys["k1"].to_numpy(np.int64).view(np.uint64)), ["k1", "k2", "doc_id"]]

    hits = (lines.groupBy("shard", "salt").cogroup(blobs.groupBy("shard", "salt"))
            .applyInPandas(probe, "k1 long, k2 long, doc_id long"))
    shared = cut(common_keys(index.refs, index.min_docs))
    lost = hits.join(shared, ["k1", "k2"]).where("doc_id <> top")
    return lost.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("k1", "k2"))).alias("drop"))


def _among(key: Column, ordered: Column) -> Column:
    """Is ``key`` in a sorted array: halving steps, so a very long text whose lines
    are all shared costs lines x log(lines), not their square."""
    steps = F.sequence(F.lit(1), F.length(F.bin(F.size(ordered))))
    start = F.struct(F.lit(0).alias("lo"), F.size(ordered).alias("hi"))

    def halve(a: Column, _: Column) -> Column:
        mid = F.shiftright(a["lo"] + a["hi"], 1)
        below = F.get(ordered, mid) < key
        return F.when(a["lo"] >= a["hi"], a).when(below, F.struct((mid + 1).alias("lo"), a["hi"].alias("hi"))).otherwise(
            F.struct(a["lo"].alias("lo"), mid.alias("hi")))

    return F.aggregate(steps, start, halve, lambda a: F.coalesce(F.get(ordered, a["lo"]) == key, F.lit(False)))


def clean(index: LineIndex, docs: DataFrame, pairs: DataFrame | None = None, id_col: str = "doc_id",
          text_col: str = "text", n_lines: str = "n_lines", n_dropped: str = "n_dropped") -> DataFrame:
    """``docs`` with the text's remaining lines joined by a line feed, plus the
    numbers of lines before and of lines dropped.  Null texts are one empty
    line and become empty; other columns stay as they are."""
    if pairs is None:
        pairs = line_refs(docs, index.min_chars, id_col, text_col)
    lost = drops(index, pairs).select(F.col("doc_id").alias("__doc"), F.col("drop").alias("__drop"))
    lines = _lines(F.col(text_col))
    # arrays of one bind a line's key and its hashes: each is made once
    hashed = lambda k: F.exists(F.array(F.struct(*_hashes(k))), lambda h: _among(h, F.col("__drop")))
    kept = F.filter(lines, lambda x: ~F.exists(
        F.array(line_key(x)), lambda k: (F.length(k) >= index.min_chars) & hashed(k)))
    out = docs.join(lost, docs[id_col].cast("long") == lost["__doc"], "left")
    out = out.withColumn("__kept", F.when(F.col("__drop").isNull(), lines).otherwise(kept))
    own = [F.array_join("__kept", "\n").alias(c) if c == text_col else docs[c] for c in docs.columns]
    return out.select(*own, F.size(lines).cast("long").alias(n_lines),
                      (F.size(lines) - F.size("__kept")).cast("long").alias(n_dropped))


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, id_col: str = "doc_id",
                text_col: str = "text", n_lines: str = "n_lines", n_dropped: str = "n_dropped") -> DataFrame:
    """Line dedup of one batch: builds the index and cleans the same documents with it.

    A key of at least ``min_chars`` code points that at least ``min_docs``
    documents hold loses all lines but those in the largest doc_id."""
    index = build(docs, min_docs, min_chars, id_col=id_col, text_col=text_col)
    return clean(index, docs, index.refs.select("k1", "k2", "doc_id"), id_col, text_col, n_lines, n_dropped)
