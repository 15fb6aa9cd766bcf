"""Fill-in-the-middle: units, cuts and the way back, against a plain statement of the rules."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from intake.llm import fill_in_middle as M
from intake.llm import queries as Q

from .conftest import SF, rows
from .test_codecs import odd_texts


def plainly(doc_id, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k:k + 8], 16) for k in (0, 8, 16, 24))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_unit_ends():
    for t in odd_texts(3000, 5) + ["", "a", "a" * 40, "\n\n", "Zz9é z"]:
        ends = [m.end() for m in re.finditer("[A-Za-z]+|[^A-Za-z]", t, re.S)]
        for part in (1_000_000, 7, 1):
            assert M.unit_ends(t, part).tolist() == ends


def test_very_long_texts():
    """Beyond the library's stack: ten million units, and one unit of ten million letters."""
    assert len(M.unit_ends("ab " * 5_000_000)) == 10_000_000
    assert M.unit_ends("a" * 10_000_000).tolist() == [10_000_000]
    assert M.unit_ends("é" * 1_500_000).tolist() == list(range(1, 1_500_001))


def test_transform_and_restore(spark, edge):
    texts = odd_texts(400, 6) + ["<P>", "a<S>b", "x <M", "<S", "P><S", "a<P", "S>", "b <M> c", "<<S><"]
    own = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for df in (own, edge.select("doc_id", "text")):
        out = M.transform(df).withColumn("back", M.restore(F.col("output"), F.col("form"))).collect()
        want = sorted((plainly(r["doc_id"], r["text"]) + (r["text"] or "",) for r in df.collect()), key=repr)
        got = sorted(((r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["back"]) for r in out), key=repr)
        assert got == want
    assert {r["form"] for r in M.transform(own).collect()} == {"plain", "psm", "spm"}


def test_edges(edge, nothing):
    assert M.digests(edge).count() == len(rows())
    assert M.digests(nothing).count() == 0
    for r in M.transform(edge.where("doc_id in (1, 2)")).collect():
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == (0, "plain", None, None, "")


def test_query_restores_every_text(spark, small):
    want = {r["doc_id"]: hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in small.collect()}
    got = Q.op12_fill_in_middle(spark, SF).collect()
    assert len(got) == small.count() and all(want[r["doc_id"]] == r["restored_sha256"] for r in got)
    assert sum(r["output_sha256"] != r["restored_sha256"] for r in got) > len(got) / 2


@pytest.mark.parametrize("seed", [1, 2])
def test_draws(spark, seed):
    r = spark.range(5, 6).select(*[M.draw(F.col("id"), k, seed).alias(str(k)) for k in (1, 2, 3, 4)]).first()
    digest = hashlib.sha256(f"{seed}:5".encode()).hexdigest()
    assert list(r) == [int(digest[k:k + 8], 16) for k in (0, 8, 16, 24)]
