"""SentencePiece BPE encoding and decoding by backtracking over merge types.

The encoder gives exactly the ids of merging pair after pair, without doing the
merges: an Aho-Corasick automaton over the pieces lists the matches of a chunk,
the longest match at each position is tried first, a piece may follow another
only if re-merging the two leaves them as they are (neither had merged across
the border before), and positions from which no way led on are marked in a
bitfield, so each is tried once.  When a piece does not fit, its longest proper
prefix that is a piece is tried next; when none is left, the last piece is
taken back.

A piece never goes on after a space mark that follows another character, and
the signs of the model never share a piece with letters or digits.  Both are
read off the pieces.  So a text is split before every run of space marks and
between signs and the rest, and equal chunks are encoded once a worker (bounded
cache).  Pieces of equal score (runs of space marks) merge
leftmost first, which adjacent pairs do not settle: chunks with such runs are
merged pair by pair with a heap instead.
"""

from __future__ import annotations

import hashlib
import re
import string
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from intake.llm.common import small_batches

MARK = "▁"
CACHE, PAIRS = 450_000, 300_000   # chunks and pairs of pieces a worker remembers
CACHE_CHARS = 40         # longer chunks are not remembered
_HARD = MARK * 2
RESULT = "n_tokens long, ids_sha256 string, decoded_sha256 string"


class Codec:
    """Ids of a SentencePiece BPE model with byte fallback, identity
    normalisation and a leading space mark (checked when it is made)."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        if sp.encode(f"{MARK}  a") != sp.encode("   a") or sp.id_to_piece(sp.encode("a")[0]) != f"{MARK}a":
            raise ValueError("the model must keep spaces, add a leading one and normalise nothing else")
        n = sp.get_piece_size()
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.text = [sp.id_to_piece(i) for i in range(n)]
        self.bytes = {bytes([int(self.text[i][3:5], 16)]): i for i in range(n) if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.silent = {i for i in range(n) if sp.is_control(i)}
        self.unknown = sp.unk_id()
        self.ids = {self.text[i]: i for i in plain}
        self.rank = {self.text[i]: (-sp.get_score(i)) for i in plain}
        self.letters = {p for p in self.ids if len(p) == 1}
        self.plain = {i: self.text[i].replace(MARK, " ") for i in plain}
        self.chunk = self.chunk_pattern()
        self.split: dict[str, tuple[str, str] | None] = {}
        for piece in sorted(self.ids, key=len):
            merged = self.merge(piece, piece)
            if len(merged) == 1:
                self.split[piece] = None
            elif len(merged) == 2:
                self.split[piece] = tuple(merged)
        self.auto = ahocorasick.Automaton()
        for piece in self.split:
            self.auto.add_word(piece, (len(piece) - 1, piece))
        self.auto.make_automaton()
        self.prefix = {p: next((p[:k] for k in range(len(p) - 1, 0, -1) if p[:k] in self.split), None) for p in self.split}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.seen: dict[str, tuple[int, str, str]] = {}
        self.older: dict[str, tuple[int, str, str]] = {}

    def chunk_pattern(self) -> re.Pattern:
        """Chunks that no piece reaches across: runs of signs and runs of other
        characters, each with the spaces before it.

        Signs are the punctuation marks that share pieces, directly or through
        other characters, with no ASCII letter or digit, and those characters."""
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            return re.compile(r"(?s).+")  # pieces go on after a space: no split at all
        share: dict[str, set[str]] = {}
        for p in self.ids:
            for c in (own := set(p) - {MARK}):
                share.setdefault(c, set()).update(own)
        signs: set[str] = set()
        for mark in string.punctuation:
            found, todo = {mark}, [mark]
            while todo:
                new = share.get(todo.pop(), set()) - found
                found |= new
                todo += new
            if not any(c.isascii() and c.isalnum() for c in found):
                signs |= found
        inside = "".join(map(re.escape, sorted(signs)))
        return re.compile(f" *[^ {inside}]+| *[{inside}]+| +" if signs else " *[^ ]+| +")

    def merge(self, text: str, stop: str | None = None) -> list[str]:
        """Pieces by merging the best pair (highest score, then leftmost) until none is
        left; with ``stop``, the two parts that would make this whole text last."""
        parts: list[str | None] = list(text)
        n, rank = len(parts), self.rank
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(rank[text[i:i + 2]], i, text[i:i + 2]) for i in range(n - 1) if text[i:i + 2] in rank]
        heapify(heap)
        while heap:
            _, i, made = heappop(heap)
            j = right[i] if parts[i] is not None else n
            if j >= n or parts[i] + parts[j] != made:
                continue
            if made == stop and i == 0 and j + len(parts[j]) == n:
                return [parts[0], parts[j]]
            parts[i], parts[j] = made, None
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
            for a, b in ((left[i], i), (i, right[i])):
                if a >= 0 and b < n and (pair := parts[a] + parts[b]) in rank:
                    heappush(heap, (rank[pair], a, pair))
        out = [p for p in parts if p is not None]
        return out if stop is None or len(out) == 1 else out + [""]  # never two: not reached by merging

    def fits(self, a: str, b: str) -> bool:
        """Whether re-merging a + b leaves a and b: walk back through their last
        merges along the border and look for a merge across it that came first."""
        key = (a, b)
        known = self.pairs.get(key)
        if known is not None:
            return known
        rank, split = self.rank, self.split
        x, y, by_x, by_y, good = a, b, float("inf"), float("inf"), True
        while True:
            across = rank.get(x + y)
            if across is not None and across < by_x and across <= by_y:  # equal scores: the left pair first
                good = False
                break
            sx, sy = split[x], split[y]
            if sx is None and sy is None:
                break
            if sy is None or (sx is not None and rank[x] >= rank[y]):
                by_x, x = rank[x], sx[1]
            else:
                by_y, y = rank[y], sy[0]
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        self.pairs[key] = good
        return good

    def backtrack(self, text: str) -> list[str]:
        """Pieces of a text all of whose characters are pieces."""
        n = len(text)
        longest: list[str | None] = [None] * n
        for last, (k, piece) in self.auto.iter(text):
            longest[last - k] = piece  # ends ascend: the last match from a start is the longest
        failed, out, at, piece = bytearray(n + 1), [], 0, longest[0]
        prefix, fits, known = self.prefix, self.fits, self.pairs.get
        while True:
            if piece is None:
                if not out:
                    raise AssertionError("no way through the text")
                failed[at] = 1
                piece = out.pop()
                at -= len(piece)
                piece = prefix[piece]
                continue
            end = at + len(piece)
            if failed[end]:
                piece = prefix[piece]
                continue
            if out:
                good = known((out[-1], piece))
                if not (fits(out[-1], piece) if good is None else good):
                    piece = prefix[piece]
                    continue
            out.append(piece)
            if end == n:
                return out
            at, piece = end, longest[end]

    def pieces(self, text: str) -> list[str]:
        return self.merge(text) if _HARD in text else self.backtrack(text)

    def chunk_ids(self, chunk: str) -> list[int]:
        ids, chunk = self.ids, chunk.replace(" ", MARK)
        if self.letters.issuperset(chunk):
            return [ids[p] for p in self.pieces(chunk)]
        out = []
        for known, run in groupby(chunk, self.letters.__contains__):
            text = "".join(run)
            if known:
                out.extend(ids[p] for p in self.pieces(text))
            elif self.bytes:  # characters that are no piece stand alone, as their bytes
                out.extend(self.bytes[bytes([b])] for b in text.encode("utf-8", "replace"))
            else:
                out.extend([self.unknown] * len(text))
        return out

    def chunks(self, text: str) -> list[str]:
        """Parts with the added leading space; a space mark in the text is a space."""
        if not text:
            return []
        return self.chunk.findall(" " + (text.replace(MARK, " ") if MARK in text else text))

    def encode(self, text: str) -> list[int]:
        return [i for c in self.chunks(text) for i in self.chunk_ids(c)]

    def surface(self, ids: list[int]) -> str:
        """Text of ids without the rule for the leading space."""
        parts = [self.plain.get(i) for i in ids]
        if None not in parts:
            return "".join(parts)
        out, raw = [], b""
        for i in ids:
            if i in self.byte_of:
                raw += self.byte_of[i]
                continue
            if raw:
                out.append(utf8(raw))
                raw = b""
            if i not in self.silent:
                out.append(" ⁇ " if i == self.unknown else self.text[i].replace(MARK, " "))
        if raw:
            out.append(utf8(raw))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        text = self.surface(ids)
        first = next((i for i in ids if i not in self.silent), None)
        return text[1:] if first is not None and first not in self.byte_of and self.text[first].startswith(MARK) else text

    def known(self, chunk: str) -> tuple[int, str, str]:
        """Number of ids, ids as text and decoded text of a chunk."""
        hit = self.seen.get(chunk) or self.older.get(chunk)
        if hit is None:
            ids = self.chunk_ids(chunk)
            text = self.surface(ids)
            hit = (len(ids), ",".join(map(str, ids)), chunk if text == chunk else text)
        if len(chunk) <= CACHE_CHARS:
            if len(self.seen) >= CACHE // 2:  # two generations: what is in use stays
                self.older, self.seen = self.seen, {}
            self.seen[chunk] = hit
        return hit

    def digest(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the ids and of the decoded text of a whole text."""
        known = self.known
        chunks = self.chunks(text or "")
        found = [hit or known(c) for c, hit in zip(chunks, map(self.seen.get, chunks))]
        decoded = "".join([f[2] for f in found])[1:]  # every text starts with the added space mark
        return (sum([f[0] for f in found]), hashlib.sha256(",".join([f[1] for f in found]).encode()).hexdigest(),
                hashlib.sha256(decoded.encode("utf-8", "replace")).hexdigest())


def utf8(raw: bytes) -> str:
    """A run of byte pieces as text; each byte that is no valid UTF-8 becomes U+FFFD."""
    out, at = [], 0
    while at < len(raw):
        for k in (1, 2, 3, 4):
            try:
                out.append(raw[at:at + k].decode("utf-8"))
                at += k
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode_documents(docs: DataFrame, path: str | None = None, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` plus an array of ids; null texts have none."""
    where = path or default_model()

    @F.pandas_udf("array<int>")
    def run(texts: pd.Series) -> pd.Series:
        c = codec(where)
        return pd.Series([c.encode(t or "") for t in texts])

    return small_batches(docs).withColumn(out, run(F.col(text_col)))


def decode_documents(docs: DataFrame, path: str | None = None, ids_col: str = "ids", out: str = "text") -> DataFrame:
    """``docs`` plus the text of an id array; a null array gives an empty text."""
    where = path or default_model()

    @F.pandas_udf("string")
    def run(ids: pd.Series) -> pd.Series:
        c = codec(where)
        return pd.Series([c.decode([] if x is None else [int(i) for i in x]) for x in ids])

    return small_batches(docs).withColumn(out, run(F.col(ids_col)))


def digest_documents(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), one row per input row.

    Every whole text is encoded and its ids decoded again.  Null texts are empty
    texts: no ids.  Repeated rows and null ids are rows like any other; other
    columns are not read."""
    where = path or default_model()

    @F.pandas_udf(RESULT)
    def run(texts: pd.Series) -> pd.DataFrame:
        c = codec(where)
        return pd.DataFrame([c.digest(t) for t in texts], columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return small_batches(docs).select(F.col(id_col).alias("doc_id"), run(F.col(text_col)).alias("r")).select("doc_id", "r.*")
