"""The registered query of every training-data operator, and oracle SQL where SQL can express it."""

from __future__ import annotations

from . import ballmeans, embdedup, langid, minhash, packing, pii, piece, quality, runs, suffix, topk, toxicity, urlfilter
from .common import table


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op2_topk(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op3_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs))


def op4_url_filter(spark, sf_dir):
    return urlfilter.filter_urls(table(spark, sf_dir, "pages"))


def op5_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op6_embedding_dedup(spark, sf_dir):
    return embdedup.link_vectors(table(spark, sf_dir, "embeddings"))


def op7_pii(spark, sf_dir):
    return pii.find_entities(table(spark, sf_dir, "documents"))


def op8_minhash(spark, sf_dir):
    return minhash.link_documents(table(spark, sf_dir, "documents"))


def op9_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


def op10_sentencepiece(spark, sf_dir):
    return piece.encode_texts(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op11_periodic_runs(spark, sf_dir):
    return runs.digest(runs.find_runs(runs.planted(table(spark, sf_dir, "documents"))))


def op12_ball_kmeans(spark, sf_dir):
    return ballmeans.cluster_vectors(table(spark, sf_dir, "embeddings"))


def op13_suffix_dedup(spark, sf_dir):
    return suffix.remove_repeats(table(spark, sf_dir, "documents"), texts_too=False).drop("spans")


def queries():
    found = (op1_toxicity, op2_topk, op3_quality, op4_url_filter, op5_packing, op6_embedding_dedup, op7_pii, op8_minhash, op9_language_id, op10_sentencepiece, op11_periodic_runs, op12_ball_kmeans, op13_suffix_dedup)
    return {f.__name__: f for f in found}


OP2_SQL = """
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS own, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.own, a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.own <> b.own AND len(a.q) = len(b.q)),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id, own ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""

OP6_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.x, b.x) >= 0.93),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
c AS (SELECT a, min(b) AS m FROM reach GROUP BY a), n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, least(e.vec_id, coalesce(c.m, e.vec_id)) AS component_id, e.vec_id = least(e.vec_id, coalesce(c.m, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN c ON c.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id"""

OP8_SQL = """
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS MATERIALIZED (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) END) AS sh FROM w),
x AS (SELECT doc_id, unnest(sh) AS h FROM s), sz AS (SELECT doc_id, len(sh) AS n FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM x a JOIN x b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT p.a, p.b FROM p JOIN sz u ON u.doc_id = p.a JOIN sz v ON v.doc_id = p.b WHERE 100 * k >= 85 * (u.n + v.n - k)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
c AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT sz.doc_id, sz.n AS n_shingles, least(sz.doc_id, coalesce(c.m, sz.doc_id)) AS component_id, sz.doc_id = least(sz.doc_id, coalesce(c.m, sz.doc_id)) AS kept FROM sz LEFT JOIN c ON c.a = sz.doc_id"""


OP12_SQL = """
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS own, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
           WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || vec_id), x) - 1 AS INTEGER) AS k, x FROM v WHERE vec_id IS NOT NULL QUALIFY k < 16)""" + "".join(
    f""",
a{r} AS MATERIALIZED (SELECT own, any_value(vec_id) AS vec_id, any_value(x) AS x, CAST(arg_min(k, d * 16 + k) AS INTEGER) AS k, min(d) AS d FROM (SELECT own, vec_id, v.x AS x, k,
           CAST(list_dot_product(v.x, v.x) + list_dot_product(c.x, c.x) - 2 * list_dot_product(v.x, c.x) AS BIGINT) AS d FROM v, c{r} c) GROUP BY own)""" + (f""",
s{r} AS (SELECT k, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (SELECT k, unnest(x) AS x, unnest(range(64)) AS i FROM a{r}) GROUP BY k, i),
c{r + 1} AS MATERIALIZED (SELECT c.k, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN (SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM s{r} GROUP BY k) m USING (k))""" if r < 3 else "")
    for r in range(4)
) + """
SELECT vec_id, k AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
 sha256(array_to_string(c3.x, ',')) AS centroid_sha256 FROM a3 JOIN c3 USING (k)"""


def oracle_sql():
    return {"op2_topk": OP2_SQL, "op4_url_filter": urlfilter.oracle(), "op6_embedding_dedup": OP6_SQL, "op8_minhash": OP8_SQL, "op12_ball_kmeans": OP12_SQL}
