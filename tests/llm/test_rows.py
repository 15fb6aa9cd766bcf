"""Nulls, empty and long texts, repeated rows, empty tables and clashing column
names: every operator gives one row per input row and the defined values."""

import hashlib

import pytest

from intake.llm import line_dedup, mixing, pii, quality, secrets, sentencepiece_bpe, simhash, token_blocks, toxicity
from intake.llm.common import n_words
from pyspark.sql import functions as F

from .conftest import rows

EMPTY = hashlib.sha256(b"").hexdigest()
LEX = toxicity.Lexicon(words={"idiot": 5.0}, curve=(2.0, 2.0, -3.0))
RUNS = {
    "quality": lambda d: quality.assess(d),
    "simhash": lambda d: simhash.simhash_components(d),
    "toxicity": lambda d: toxicity.score_documents(d, LEX),
    "line_dedup": lambda d: line_dedup.dedup_lines(d, n_lines="__n", n_dropped="__d"),
    "token_blocks": lambda d: token_blocks.round_trip(d),
    "mixing": lambda d: mixing.mix(d, n_words(F.col("text")), F.array("source")),
    "pii": lambda d: pii.scan(d, {}),
    "secrets": lambda d: secrets.scan(d),
    "sentencepiece": lambda d: sentencepiece_bpe.digest_documents(d),
}


@pytest.mark.parametrize("name", sorted(RUNS))
def test_one_row_per_row(edge, name):
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in RUNS[name](edge).select("doc_id").collect())
    assert got == sorted((d is not None, d or 0) for d, _, _ in rows())


@pytest.mark.parametrize("name", sorted(RUNS))
def test_empty_table(nothing, name):
    assert RUNS[name](nothing).count() == 0


def test_empty_texts(edge):
    by = lambda df: {r["doc_id"]: r for r in df.where("doc_id in (1, 2, 3)").collect()}
    for r in by(quality.assess(edge)).values():
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"], r["base_failed"], r["kept"]) == (0, 0, 0, True, False)
    for r in by(simhash.simhash_components(edge)).values():
        assert (r["fp"], r["component_id"]) == (0, 1)
    for r in by(toxicity.score_documents(edge, LEX)).values():
        assert 0 <= r["score"] < 0.5 and r["predicted"] == 0
    lines = by(line_dedup.dedup_lines(edge, n_lines="__n", n_dropped="__d"))
    assert [(lines[k]["__n"], lines[k]["__d"], lines[k]["text"]) for k in (1, 2, 3)] == [(1, 0, ""), (1, 0, ""), (2, 0, " \t\r\n\x0b\x0c ")]
    for r in by(token_blocks.round_trip(edge)).values():
        assert r["n_tokens"] == 1
    for r in by(mixing.mix(edge, n_words(F.col("text")), F.array("source"))).values():
        assert (r["size"], r["taken"]) == (0, 0)
    for out in (pii.scan(edge, {}), secrets.scan(edge)):
        for r in by(out).values():
            assert (r["base_sha256"], r["spans"]) == (EMPTY, "")
    got = by(sentencepiece_bpe.digest_documents(edge))
    assert (got[1]["n_tokens"], got[1]["decoded_sha256"]) == (0, EMPTY) == (got[2]["n_tokens"], got[2]["ids_sha256"])


def test_no_collect_of_text_for_rows_without_id(edge):
    """Lines of rows without id are neither counted nor dropped."""
    out = {(r["doc_id"], r["text"]) for r in line_dedup.dedup_lines(edge, n_lines="__n", n_dropped="__d").collect()}
    assert (None, "No id here, A line that several documents share, word for word.") in out
    assert (5, "First.") in out and (6, "Second.") in out
    assert (7, "A line that several documents share, word for word.\n" * 2) not in out
    assert any(d == 7 and t.count("\n") == 1 for d, t in out)


def test_simhash_keep_one(edge):
    kept = simhash.keep_one(edge)
    assert kept.columns == edge.columns
    ids = sorted(r["doc_id"] for r in kept.select("doc_id").collect() if r["doc_id"] is not None)
    assert ids.count(7) == 1 and 1 in ids and 2 not in ids and 10 in ids and 11 not in ids


def test_simhash_keep_one_keeps_the_same_row(spark):
    """Different texts under one id, whatever the order of rows."""
    rows = [(1, f"text number {i} of one id", f"s{i}") for i in range(6)] + [(1, "text number 0 of one id", "other"), (2, "quite another text", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = [sorted(map(tuple, simhash.keep_one(docs.repartition(n).orderBy(F.rand(n))).collect())) for n in (1, 3, 7)]
    assert kept[0] == kept[1] == kept[2] and [r[0] for r in kept[0]] == [1, 2]
