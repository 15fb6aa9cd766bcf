"""Registered queries against their SQL, and the pipeline stage by stage."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from intake.llm import queries as Q
from intake.llm import toxicity
from intake.llm.simhash import fingerprint
from oracle_check import compare, duck

from .conftest import SF, Sets, texts
from .test_lines import brute


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_query_matches_sql(spark, name):
    res = compare(spark, name, Q.queries()[name], Q.SQL[name], SF, duck(SF))
    assert res["status"] == "OK", res


def test_all_are_registered():
    names = entry.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11)) and "pipeline" in names


def test_stages(spark, small, tmp_path):
    docs, columns = small, small.columns
    kept = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / str(k)))
        out = spark.read.parquet(str(tmp_path / str(k)))
        if k < 4:
            assert out.columns == columns
        kept.append((docs, out))
        docs = out
    before, after = kept[0]
    matcher = toxicity.Matcher(toxicity.train(before, spark.read.parquet(f"{SF}/labels.parquet")))
    assert texts(after) == {d: t for d, t in texts(before).items() if matcher.score(t) < 0.5}
    before, after = kept[1]
    assert texts(after) == brute(texts(before))
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect())
    before, after = kept[2]
    prints = {d: fingerprint(t) for d, t in texts(before).items()}
    sets = Sets()
    for a in prints:
        sets.find(a)
        for b in prints:
            if bin(prints[a] ^ prints[b]).count("1") <= 3:
                sets.join(a, b)
    assert texts(after) == {d: t for d, t in texts(before).items() if sets.find(d) == d}
    before, after = kept[3]
    times, whole = {}, texts(before)
    for r in after.collect():
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
        assert r["text"] == whole[r["doc_id"]]
    assert max(times.values()) <= 2
    sizes = {d: len(t.split()) for d, t in whole.items()}
    total = sum(sizes.values())
    assert abs(sum(n * sizes[d] for d, n in times.items()) - 1.5 * total) <= 0.02 * total
    assert kept[4][1].count() == after.count()


def test_run_is_the_stages(spark, small):
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
