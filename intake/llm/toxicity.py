"""Toxicity by a weighted lexicon matched with Aho-Corasick.

Texts and terms are folded alike: lower case, homoglyphs (Cyrillic, Greek and
full-width letters) to Latin letters, digits and signs that stand for letters
inside a word to these letters.  Term weights, word beginnings included, are
learnt from labelled rows as smoothed log-odds of document frequencies;
neighbour phrases that occur in clean rows only as exceptions are learnt the
same way and join the given ones: a term inside an exception phrase counts
nothing.  The sum of the weights, alone and per square root of the number of
words, gives the score through a logistic curve fitted on the same rows.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intake.llm.common import small_batches

# fixed values: letters that look like Latin ones
HOMOGLYPHS = dict(zip("абвгеёзіїјкмнорсѕтухһԁԛԝɡɩαβγεηικνορτυχω", "abbreeziijkmhopcstyxhdqwgiabyenikvoptuxw"))
# fixed values: digits and signs that stand for letters
DIGITS = dict(zip("013457@$", "oieastas"))
# fixed values: harmless phrases with words that are often abusive
EXCEPTIONS = ("trash can", "trash bag", "trash bin", "idiot proof", "idiot light", "clown fish", "class clown",
              "pond scum", "soap scum", "sore loser", "worthless check", "pathetic fallacy")

TRAIN_ROWS = 3_000       # labelled rows of each class that the lexicon is learnt from, at most
TRAIN_CHARS = 20_000     # longer texts are no training rows (they are scored whole like any other)
TERMS = 2_000            # terms of the lexicon, at most
MIN_ROWS, MIN_ODDS = 6, 2.5
PREFIX = range(4, 9)     # letters of a word's beginning that may be a term

_TABLE = {ord(a): b for a, b in HOMOGLYPHS.items()} | {ord(a.upper()): b for a, b in HOMOGLYPHS.items()}
_SIGN = re.compile(r"(?<=\w)[013457@$](?=[^\W\d_])|(?<![\w@$])[013457@$](?=[^\W\d_]{2})")
_SIGNS = re.compile(r"[013457@$]")
_WORD = re.compile(r"[^\W\d_]+")


def fold(text: str) -> str:
    """Lower case, look-alikes to Latin, digits and signs inside a word to letters."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text).translate(_TABLE)
    text = text.lower()
    if _SIGNS.search(text):
        for _ in range(3):  # signs side by side follow each other
            text = _SIGN.sub(lambda m: DIGITS[m[0]], text)
    return text


@dataclass
class Lexicon:
    """words and beginnings: term -> weight; curve: of the sum, of the sum by length, constant."""
    words: dict[str, float] = field(default_factory=dict)
    beginnings: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = EXCEPTIONS
    curve: tuple[float, float, float] = (1.0, 1.0, -2.0)


class Matcher:
    """Aho-Corasick automaton over terms and exception phrases; made once a worker."""

    def __init__(self, lexicon: Lexicon):
        import ahocorasick

        self.lexicon, self.auto = lexicon, ahocorasick.Automaton()
        terms = set(lexicon.words) | set(lexicon.beginnings) | {fold(x) for x in lexicon.exceptions}
        self.exceptions = {fold(x) for x in lexicon.exceptions}
        for t in terms:
            self.auto.add_word(t, t)
        if terms:
            self.auto.make_automaton()

    def hits(self, folded: str) -> list[tuple[int, int, float]]:
        """(start, end, weight) of the best term of each word, outside exception phrases."""
        if not len(self.auto):
            return []
        best: dict[int, tuple[int, float]] = {}
        spared: list[tuple[int, int]] = []
        n = len(folded)
        for last, term in self.auto.iter(folded):
            start, end = last + 1 - len(term), last + 1
            if start and folded[start - 1].isalpha():
                continue
            closed = end == n or not folded[end].isalpha()
            if closed and term in self.exceptions:
                spared.append((start, end))
            weight = max(self.lexicon.beginnings.get(term, 0.0), self.lexicon.words.get(term, 0.0) if closed else 0.0)
            if weight > best.get(start, (0, 0.0))[1]:
                best[start] = (end, weight)
        out, k = [], 0
        spared.sort()
        for start in sorted(best):
            while k < len(spared) and spared[k][1] <= start:
                k += 1
            if not any(a <= start < b for a, b in spared[k:k + 4]):
                out.append((start, *best[start]))
        return out

    def features(self, text: str | None) -> tuple[float, float]:
        folded = fold(text or "")
        total = sum(w for _, _, w in self.hits(folded))
        if not total:
            return 0.0, 0.0
        return math.log1p(total), total / math.sqrt(1 + folded.count(" ") + folded.count("\n"))

    def score(self, text: str | None) -> float:
        a, b = self.features(text)
        x = self.lexicon.curve
        z = x[0] * a + x[1] * b + x[2]
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _odds(pos: Counter, neg: Counter, n_pos: int, n_neg: int) -> dict[str, float]:
    return {t: math.log((pos[t] + 0.5) / (n_pos + 1)) - math.log((neg[t] + 0.5) / (n_neg + 1)) for t in pos}


def learn(rows: list[tuple[str | None, int]], exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    """Lexicon and curve from (text, toxic) rows; no rows or one class only: an
    empty lexicon whose constant is the (smoothed) share of toxic rows."""
    folded = [(fold(t or ""), int(y)) for t, y in rows]
    n = Counter(y for _, y in folded)
    share = (n[1] + 0.5) / (n[0] + n[1] + 1)
    lexicon = Lexicon(exceptions=tuple(exceptions), curve=(0.0, 0.0, math.log(share / (1 - share)) if n[1] or n[0] else -2.0))
    if not n[1] or not n[0]:
        return lexicon
    counts = {(kind, y): Counter() for kind in "wbp" for y in (0, 1)}
    for text, y in folded:
        found = _WORD.findall(text)
        own = set(found)
        counts["w", y].update(own)
        counts["b", y].update({w[:k] for w in own for k in PREFIX if len(w) > k})
    words = {t: o for t, o in _odds(counts["w", 1], counts["w", 0], n[1], n[0]).items()
             if counts["w", 1][t] >= MIN_ROWS and o >= MIN_ODDS}
    starts = {t: o for t, o in _odds(counts["b", 1], counts["b", 0], n[1], n[0]).items()
              if counts["b", 1][t] >= 2 * MIN_ROWS and o >= MIN_ODDS + 0.5}
    # the shortest beginning speaks for the longer ones
    starts = {t: o for t, o in starts.items() if not any(t[:k] in starts and starts[t[:k]] >= o - 0.7 for k in range(4, len(t)))}
    starts = {t: o for t, o in starts.items() if t not in words and not any(w.startswith(t) for w in words)}
    rank = sorted([(-o, t, 0) for t, o in words.items()] + [(-o, t, 1) for t, o in starts.items()])[:TERMS]
    lexicon.words = {t: -o for o, t, k in rank if not k}
    lexicon.beginnings = {t: -o for o, t, k in rank if k}
    # exception phrases: neighbours of a term in several clean rows and in no toxic row
    for text, y in folded:
        found = _WORD.findall(text)
        counts["p", y].update({f"{a} {b}" for a, b in zip(found, found[1:]) if a in lexicon.words or b in lexicon.words})
    spared = [p for p, c in counts["p", 0].items() if c >= 3 and not counts["p", 1][p]]
    lexicon.exceptions = tuple(exceptions) + tuple(sorted(spared)[:TERMS])
    m = Matcher(lexicon)
    x = np.array([(*m.features(t), 1.0) for t, _ in folded])
    y = np.array([y for _, y in folded], float)
    w = np.zeros(3)
    for _ in range(50):  # Newton steps of a logistic regression with a small ridge
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        ridge = np.diag([1e-2, 1e-2, 1e-4]) * len(y) / 100
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge + 1e-9 * np.eye(3), x.T @ (p - y) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    lexicon.curve = tuple(float(v) for v in w)
    return lexicon


def held_out(doc_id: Column) -> Column:
    """Rows that no lexicon is learnt from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS) -> Lexicon:
    """Lexicon from a bounded sample of labelled rows outside the held-out fifth.

    The sample takes the ``rows`` first rows of each class by a hash of doc_id
    and leaves out texts above ``chars`` characters, so at most ``2 * rows *
    chars`` characters reach the driver, however large the tables are.  Null
    ids, null labels and null texts teach nothing."""
    usable = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(
        F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).distinct()
    order = F.xxhash64("doc_id")
    picked = [usable.where(F.col("toxic") == y).orderBy(order, "doc_id").limit(rows) for y in (0, 1)]
    sample = F.broadcast(picked[0].unionByName(picked[1]))  # at most 2 * rows rows
    found = (docs.select("doc_id", "text").join(sample, "doc_id")
             .where(F.col("text").isNotNull() & (F.length("text") <= chars))
             .dropDuplicates(["doc_id", "toxic"]).orderBy(order, "doc_id", "toxic").limit(2 * rows).select("text", "toxic"))
    return learn([(r["text"], r["toxic"]) for r in found.collect()])


def score(text: Column, lexicon: Lexicon) -> Column:
    """Score column of a whole text, 0 to 1; null and empty texts score like texts without a term."""
    made: list[Matcher] = []

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        if not made:
            made.append(Matcher(lexicon))
        return pd.Series([made[0].score(t) for t in texts], dtype="float64")

    return run(text)


def score_documents(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per input row, repeated rows included.
    A null id is not held out.  Other columns are not read."""
    out = small_batches(docs).select(F.col(id_col).alias("doc_id"), score(F.col(text_col), lexicon).alias("score"))
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def reject(docs: DataFrame, lexicon: Lexicon, text_col: str = "text") -> DataFrame:
    """Rows whose text scores under 0.5, all columns as they were."""
    return small_batches(docs).withColumn("__toxic", score(F.col(text_col), lexicon)).where("__toxic < 0.5").drop("__toxic")
