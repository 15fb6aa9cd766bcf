"""Line-first quality rules, in DataFrame functions only.

Every line is judged on its own (punctuation, navigation, boilerplate); failing
lines are removed; a document that loses more than ``MAX_LOST`` of its
characters is rejected.  Documents that are too short or repeat themselves are
rejected before that.  Everything is computed within a row: no shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intake.llm.common import SPACES, words

WINDOW = 8
MIN_WORDS, MAX_REPEAT = 20, 30      # words; percent of the words
MAX_LOST = 50                       # percent of the characters of all lines
SYMBOLS = "#*$%&|<>"
# runs of signs that stand in no sentence
SIGN_RUNS = r"[#*$%&<>^~=]{2,}|[!?]{2,}"
SIGN_SHARE = 10                     # percent of a line's characters
# a long line without any of these is no prose
SENTENCE_END, LONG_LINE = r"[.!?:;…。]", 12
SEPARATORS = "|»«›•·"
MENU = (r"(?i)^(home|about|about us|contact|contact us|log ?in|log ?out|sign ?in|sign ?up|register|search|menu|next|"
        r"previous|back|top|share|print|help|faq|sitemap|news|blog|products|services|support|read more|more)"
        r"([ /,>-]+(home|about|about us|contact|contact us|log ?in|log ?out|sign ?in|sign ?up|register|search|menu|next|"
        r"previous|back|top|share|print|help|faq|sitemap|news|blog|products|services|support|read more|more))*[.]?$")
BOILERPLATE = ("all rights reserved", "cookie policy", "use of cookies", "privacy policy", "terms of use",
               "terms of service", "terms and conditions", "lorem ipsum", "enable javascript", "click here",
               "subscribe to our", "licensed under", "released under the")


def _only(c: Column, others: str) -> Column:
    """Number of characters of ``c`` outside a regular character class given as its negation."""
    return F.length(F.regexp_replace(c, others, ""))


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACES))


def _breaks(line: Column) -> Column:
    """White-space characters between a line's first and last word."""
    return _only(_trimmed(line), r"[^\x20\x09-\x0D]+")


def punctuation_fails(line: Column) -> Column:
    """Runs of signs take a tenth of the line, or a long line has no sentence mark."""
    signs = F.length(line) - F.length(F.regexp_replace(line, SIGN_RUNS, ""))
    # the cheap test first: few lines go on to be counted
    return (line.rlike(SIGN_RUNS) & (signs * 100 >= F.length(line) * SIGN_SHARE)) \
        | (~line.rlike(SENTENCE_END) & (_breaks(line) >= LONG_LINE))


def navigation_fails(line: Column) -> Column:
    """Several separators, one for four words or more, or nothing but menu words."""
    found = _only(line, f"[^{SEPARATORS}]+")
    return (line.rlike(f"[{SEPARATORS}][^{SEPARATORS}]*[{SEPARATORS}]") & (found * 4 >= _breaks(line) + 1 - found)) \
        | _trimmed(line).rlike(MENU)


def boilerplate_fails(line: Column) -> Column:
    # an array of one binds the lower-cased line: it is made once, not once a phrase
    return F.exists(F.array(F.lower(line)), lambda low: reduce(lambda a, b: a | b, [low.contains(x) for x in BOILERPLATE]))


def line_fails(line: Column) -> Column:
    """Blank lines pass: they lose no text."""
    return (F.length(_trimmed(line)) > 0) & (
        navigation_fails(line) | punctuation_fails(line) | boilerplate_fails(line))


def _repeats(w: str) -> Column:
    """Words of array column ``w`` in windows of 8 words found twice or more."""
    window = lambda i: F.slice(F.col(w), i, WINDOW)
    starts = F.sequence(F.lit(1), F.size(w) - (WINDOW - 1))
    return F.transform(starts, lambda i: F.xxhash64(window(i)))


def assess(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, n_lines_removed, chars_lost, cleaned.

    Null and empty texts have no words and fail.  Repeated rows and null ids are
    rows like any other; other columns are not read.  Equal windows are told by
    96 bits of hash within one text."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    d = d.withColumn("w", words(F.col("text"))).withColumn("lines", F.split("text", "\n", -1))
    d = d.withColumn("n_words", F.size("w").cast("long"))
    d = d.withColumn("h", F.when(F.col("n_words") > WINDOW, _repeats("w")))
    # most texts have no two equal windows: only the others are sorted
    d = d.withColumn("p", F.when(F.size(F.array_distinct("h")) < F.size("h"), F.array_sort(F.transform(
        "h", lambda x, i: F.struct(x.alias("h"), F.hash(F.slice(F.col("w"), i + 1, WINDOW)).alias("g"), i.alias("i"))))))
    same = lambda a, b: F.coalesce((a["h"] == b["h"]) & (a["g"] == b["g"]), F.lit(False))
    starts = F.array_sort(F.filter(F.transform("p", lambda x, i: F.when(
        same(x, F.get("p", i - 1)) | same(x, F.get("p", i + 1)), x["i"])), lambda i: i.isNotNull()))
    d = d.withColumn("s", starts)
    covered = F.aggregate("s", F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), lambda a, i: F.struct(
        (i + WINDOW).alias("end"), (a["n"] + i + WINDOW - F.greatest(a["end"], i)).alias("n")), lambda a: a["n"])
    full = F.filter("lines", lambda x: F.length(_trimmed(x)) > 0)
    d = d.withColumn("full", full).withColumn("clean", F.filter("lines", lambda x: ~line_fails(x)))
    chars = lambda c: F.aggregate(c, F.lit(0), lambda a, x: a + F.length(x))
    d = d.select(
        "doc_id", "n_words",
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        _only(F.col("text"), f"[^{SYMBOLS}]+").cast("long").alias("n_symbols"),
        (F.size("full") - F.size(F.array_distinct("full"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        (F.size("lines") - F.size("clean")).cast("long").alias("n_lines_removed"),
        (chars("lines") - chars("clean")).cast("long").alias("chars_lost"),
        chars("lines").cast("long").alias("chars"),
        F.array_join("clean", "\n").alias("cleaned"))
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT)
    lost = F.col("chars_lost") * 100 > F.col("chars") * MAX_LOST
    return d.withColumn("base_failed", failed).withColumn("kept", ~(failed | lost))
