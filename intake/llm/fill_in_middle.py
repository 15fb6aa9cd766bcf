"""Fill-in-the-middle transformation of documents.

A text is cut into units, runs of ASCII letters or single other characters.
One ``fullmatch`` of ``(unit)*`` with the regex library keeps every repetition
of its group, so ``match.ends(1)`` alone gives the number of units and the
offset behind each of them: both cuts are looked up there, nothing is
iterated.  A task sends back three numbers a text; the parts are cut, put in
order and put together again by DataFrame functions.

The draws of a document depend on its id only, so every run cuts it alike.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intake.llm.common import small_batches

UNIT = "[A-Za-z]+|[^A-Za-z]"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM, SPM_BELOW = 90, 20        # percent: plain from here on, spm below
SEED = 1
# The library's stack ends at about four million repetitions (115 bytes each); longer
# texts are matched in parts of whole units of about this many characters.
PART = 1_000_000


@lru_cache(maxsize=None)
def _patterns():
    import regex

    # a unit is atomic: no way back into it is kept
    return regex.compile(f"(?>({UNIT}))*"), regex.compile("[A-Za-z]*+")


def unit_ends(text: str, part: int = PART) -> np.ndarray:
    """Offset behind every unit, in characters; as many as there are units."""
    units, letters = _patterns()
    at, found = 0, []
    while True:
        # a part ends behind a whole run of letters
        stop = letters.match(text, at + part).end() if at + part < len(text) else len(text)
        found.append(np.array(units.fullmatch(text, at, stop).ends(1), np.int64))
        if stop == len(text):
            return found[0] if len(found) == 1 else np.concatenate(found)
        at = stop


def draw(id_col: Column, k: int, seed: int = SEED) -> Column:
    """The k-th (from 1) 8-digit group of sha256 of ``seed:id``, as an unsigned number; a null id is no digits."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("long").cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * k - 7, 8), 16, 10).cast("long")


def _cuts(text: pd.Series, h1: pd.Series, h2: pd.Series) -> pd.DataFrame:
    rows = []
    for t, a, b in zip(text, h1.tolist(), h2.tolist()):
        ends = unit_ends(t)
        n = len(ends)
        a, b = sorted((a % (n + 1), b % (n + 1)))
        rows.append((n, int(ends[a - 1]) if a else 0, int(ends[b - 1]) if b else 0))
    return pd.DataFrame(rows, columns=["n", "prefix_end", "middle_end"])


def restore(output: Column, form: Column) -> Column:
    """The text that a transformed one was made of.

    A transformed text holds each mark once (texts with marks stay plain), so
    the first of each is the border."""
    p, s, m = len(PREFIX), len(SUFFIX), len(MIDDLE)
    at_p, at_s, at_m = (F.locate(mark, output) for mark in (PREFIX, SUFFIX, MIDDLE))
    rest = F.length(output)
    piece = lambda start, end: F.substring(output, start, end - start)
    psm = F.concat(piece(at_p + p, at_s), F.substring(output, at_m + m, rest), piece(at_s + s, at_m))
    spm = F.concat(piece(at_p + p, at_m), F.substring(output, at_m + m, rest), piece(at_s + s, at_p))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def transform(docs: DataFrame, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output), one row per input row.

    Null texts are empty texts.  Empty texts, those with a mark and a tenth of
    the others are plain: they come out as they are, with null lengths.  Rows of
    one id and text come out alike; rows without id share one draw.  Other
    columns are not read; an empty table gives no rows."""
    text, i = F.coalesce(F.col(text_col), F.lit("")), F.col(id_col).cast("long")
    cuts = F.pandas_udf(_cuts, "n long, prefix_end long, middle_end long")
    at = small_batches(docs).select(i.alias("doc_id"), text.alias("text")).withColumn(
        "at", cuts("text", draw(F.col("doc_id"), 1, seed), draw(F.col("doc_id"), 2, seed)))
    marked = F.col("text").contains(PREFIX) | F.col("text").contains(SUFFIX) | F.col("text").contains(MIDDLE)
    plain = (F.col("text") == "") | marked | (draw(F.col("doc_id"), 3, seed) % 100 >= PLAIN_FROM)
    form = F.when(plain, "plain").when(draw(F.col("doc_id"), 4, seed) % 100 < SPM_BELOW, "spm").otherwise("psm")
    a, b = F.col("at.prefix_end").cast("int"), F.col("at.middle_end").cast("int")
    prefix, middle = F.substring("text", F.lit(1), a), F.substring("text", a + 1, b - a)
    suffix = F.substring("text", b + 1, F.length("text"))
    marks = [F.lit(x) for x in (PREFIX, SUFFIX, MIDDLE)]
    return at.withColumn("form", form).select(
        "doc_id", "at.n", "form",
        F.when(F.col("form") != "plain", F.col("at.prefix_end")).alias("prefix_chars"),
        F.when(F.col("form") != "plain", F.col("at.middle_end") - F.col("at.prefix_end")).alias("middle_chars"),
        F.when(F.col("form") == "plain", F.col("text"))
        .when(F.col("form") == "psm", F.concat(marks[0], prefix, marks[1], suffix, marks[2], middle))
        .otherwise(F.concat(marks[1], suffix, marks[0], prefix, marks[2], middle)).alias("output"))


def digests(docs: DataFrame, **cols) -> DataFrame:
    """The transformed documents with digests of the output and of the text rebuilt from it in place of the output."""
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return transform(docs, **cols).withColumn("restored", restore(F.col("output"), F.col("form"))).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        sha(F.col("output")).alias("output_sha256"), sha(F.col("restored")).alias("restored_sha256"))
