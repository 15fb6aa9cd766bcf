"""The registered queries ``opN_<name>`` (whole tables, production parameters)
and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intake.llm import (embedding_join, fill_in_middle, line_dedup, mixing, packing, pii, quality, secrets,
                        sentencepiece_bpe, simhash, token_blocks, toxicity, whitening)
from intake.llm.common import documents, n_words, table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines_removed", "chars_lost")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(documents(spark, sf_dir), words=3, max_bits=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    lexicon = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, lexicon)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(documents(spark, sf_dir), min_docs=3, min_chars=20)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op5_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_join.near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.93)


def op6_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_blocks.round_trip(documents(spark, sf_dir))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs, n_words(F.col("text")), F.array("source")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return pii.scan(docs, pii.fit(docs))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(documents(spark, sf_dir))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.digest_documents(documents(spark, sf_dir))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(documents(spark, sf_dir))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pieces(packing.pack(documents(spark, sf_dir)))


def queries() -> dict:
    import corpus_pipeline

    own = (op1_quality, op2_simhash, op3_toxicity, op4_line_dedup, op5_embedding, op6_token_blocks, op7_mixing,
           op8_pii, op9_secrets, op10_sentencepiece, op11_whitening, op12_fill_in_middle, op13_packing)
    return {f.__name__: f for f in own} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    known = dict(SQL)
    if corpus_pipeline.ORACLE_SQL:
        known["pipeline"] = corpus_pipeline.ORACLE_SQL
    return known


_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _quality_sql() -> str:
    q = quality
    text = lambda s: "'" + s.replace("'", "''") + "'"
    signs = f"length(line) - length(regexp_replace(line, {text(q.SIGN_RUNS)}, '', 'g'))"
    cut = f"trim(line, {_BLANKS})"
    blanks = f"(length({cut}) - length(translate({cut}, {_BLANKS}, '')))"
    seps = f"(length(line) - length(translate(line, {text(q.SEPARATORS)}, '')))"
    boiler = " OR ".join(f"contains(lower(line), {text(x)})" for x in q.BOILERPLATE)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM d),
win AS (SELECT r, unnest(range(1, len(w) - {q.WINDOW - 2})) AS i, w FROM w WHERE len(w) > {q.WINDOW}),
win2 AS (SELECT r, i, array_to_string(w[i:i + {q.WINDOW - 1}], ' ') AS x FROM win),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM (SELECT r, i FROM win2 QUALIFY count(*) OVER (PARTITION BY r, x) > 1) t,
        range({q.WINDOW}) ks(k) GROUP BY r),
l AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
f AS (SELECT r, line, length(translate(line, {_BLANKS}, '')) > 0 AS has,
             ({seps} >= 2 AND {seps} * 4 >= {blanks} + 1 - {seps}) OR regexp_matches({cut}, {text(q.MENU)})
             OR ({signs}) * 100 >= length(line) * {q.SIGN_SHARE}
             OR ({blanks} >= {q.LONG_LINE} AND NOT regexp_matches(line, {text(q.SENTENCE_END)}))
             OR {boiler} AS fails FROM l),
a AS (SELECT r, count(*) FILTER (WHERE has) - count(DISTINCT CASE WHEN has THEN line END) AS dup,
             count(*) FILTER (WHERE has AND fails) AS removed,
             coalesce(sum(length(line)) FILTER (WHERE has AND fails), 0) AS lost, sum(length(line)) AS chars FROM f GROUP BY r),
o AS (SELECT d.doc_id, len(w.w)::BIGINT AS n_words, length(translate(d.text, {_BLANKS}, ''))::BIGINT AS word_chars,
             (length(d.text) - length(translate(d.text, {text(q.SYMBOLS)}, '')))::BIGINT AS n_symbols,
             a.dup::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
             a.removed::BIGINT AS n_lines_removed, a.lost::BIGINT AS chars_lost, a.chars
      FROM d JOIN w USING (r) JOIN a USING (r) LEFT JOIN rep USING (r))
SELECT * EXCLUDE (chars), n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT} * n_words AS base_failed,
       NOT (n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT} * n_words OR chars_lost * 100 > chars * {q.MAX_LOST}) AS kept
FROM o
"""


SQL: dict[str, str] = {
    "op12_fill_in_middle": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS u FROM d),
c AS (SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS c1, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS c2,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                       OR ('0x' || h[17:24])::BIGINT % 100 >= 90 THEN 'plain'
                  WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(u[1:least(c1, c2)], '') AS p, array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
             array_to_string(u[greatest(c1, c2) + 1:], '') AS s FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
""",
    "op5_embedding": """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
      ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.93),
reach(vec_id, root) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT p.b, r.root FROM reach r JOIN p ON p.a = r.vec_id),
c AS (SELECT vec_id, min(root) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n FROM p GROUP BY a)
SELECT c.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.component_id, c.vec_id = c.component_id AS kept
FROM c LEFT JOIN n USING (vec_id)
""",
    "op1_quality": _quality_sql(),
    "op4_line_dedup": r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, r, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 20 AND doc_id IS NOT NULL
      GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, coalesce(k.doc_id <> c.top, FALSE) AS lost FROM k LEFT JOIN c ON k.key = c.key)
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE lost))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM m GROUP BY r
""",
}
