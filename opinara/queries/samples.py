"""Splits, samples and balancing."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinara.functions.lexicons import SENTIMENTS
from opinara.operators import oversample as OV
from opinara.operators import sampling as SM
from opinara.queries.registry import query
from opinara.queries.relational import _BUCKET, _RATED, labelled
from opinara.queries.sqltext import draw, split_ctes

_ORD = f"ord AS (SELECT o_orderkey, {_BUCKET} AS score FROM ({_RATED}))"


@query("stratified_split", f"WITH {_ORD}, {split_ctes('ord', 'o_orderkey', 'score')} SELECT o_orderkey, score, part FROM sp")
def stratified_split(t):
    return SM.stratified_split(labelled(t).select("o_orderkey", "score"), "o_orderkey", "score")


@query("stratified_split_3way", f"""
WITH {_ORD}, cnt AS (SELECT score c, count(*) n FROM ord GROUP BY 1),
siz AS (SELECT CAST(sum(n) AS BIGINT) total, CAST(ceil(sum(n)::DOUBLE * 0.15::DOUBLE) AS BIGINT) want FROM cnt),
quo AS (SELECT c, n, (n * want) // total q, (n * want) % total rem, want FROM cnt, siz),
f1 AS (SELECT c, n, CAST(q + CASE WHEN row_number() OVER (ORDER BY rem DESC, c) <= want - sum(q) OVER () THEN 1 ELSE 0 END AS BIGINT) t FROM quo),
siz2 AS (SELECT CAST(sum(n - t) AS BIGINT) total, CAST(ceil(sum(n - t)::DOUBLE * 0.177::DOUBLE) AS BIGINT) want FROM f1),
quo2 AS (SELECT c, t, ((n - t) * want) // total q, ((n - t) * want) % total rem, want FROM f1, siz2),
f2 AS (SELECT c, t, q + CASE WHEN row_number() OVER (ORDER BY rem DESC, c) <= want - sum(q) OVER () THEN 1 ELSE 0 END d FROM quo2),
rnk AS (SELECT *, row_number() OVER (PARTITION BY score ORDER BY md5('42:' || o_orderkey), o_orderkey) rn FROM ord)
SELECT o_orderkey, score, CASE WHEN rn <= t THEN 'test' WHEN rn <= t + d THEN 'dev' ELSE 'train' END AS part FROM rnk JOIN f2 ON score = c""")
def stratified_split_3way(t):
    return SM.stratified_split_3way(labelled(t).select("o_orderkey", "score"), "o_orderkey", "score")


@query("undersample", f"""
WITH {_ORD}, rnk AS (SELECT *, row_number() OVER (PARTITION BY score ORDER BY md5('42:' || o_orderkey), o_orderkey) rn FROM ord),
least_ AS (SELECT min(n) m FROM (SELECT count(*) n FROM ord GROUP BY score))
SELECT o_orderkey, score FROM rnk, least_ WHERE rn <= m""")
def undersample(t):
    return SM.undersample(labelled(t).select("o_orderkey", "score"), "o_orderkey", "score")


@query("undersample_ratio", """
WITH rnk AS (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY md5('42:' || doc_id), doc_id) rn FROM labels),
n AS (SELECT quality, count(*) n FROM labels GROUP BY 1)
SELECT doc_id, rnk.quality FROM rnk JOIN n ON rnk.quality = n.quality, (SELECT min(n) least_, max(n) most FROM n) m
WHERE n.n < m.most OR rn <= CAST(floor(m.least_ / 0.4::DOUBLE) AS BIGINT)""")
def undersample_ratio(t):
    return SM.undersample(t.labels, "doc_id", "quality", 0.4).select("doc_id", "quality")


@query("one_per_class", """
SELECT doc_id, lang, source FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id), doc_id) rn FROM documents) WHERE rn = 1""")
def one_per_class(t):
    return SM.one_per_class(t.documents.select("doc_id", "lang", "source"), "doc_id", "lang")


_PICK = f"""
pool AS (SELECT doc_id, source, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) - 1 pos FROM documents WHERE lang = 'es'),
sz AS (SELECT count(*) n FROM pool),
d AS (SELECT c_custkey, {draw(42, 'c_custkey', '0')} % n a, {draw(42, 'c_custkey', '1')} % (n - 1) b0, {draw(42, 'c_custkey', '2')} % (n - 2) c0 FROM customer, sz),
e AS (SELECT c_custkey, a, b0 + CASE WHEN b0 >= a THEN 1 ELSE 0 END b, c0 FROM d),
g AS (SELECT c_custkey, a, b, c0 + CASE WHEN c0 >= least(a, b) THEN 1 ELSE 0 END c1 FROM e),
h AS (SELECT c_custkey, unnest([a, b, c1 + CASE WHEN c1 >= greatest(a, b) THEN 1 ELSE 0 END]) pos FROM g)""".strip()


@query("k_examples_per_request", f"WITH {_PICK} SELECT c_custkey, doc_id, source FROM h JOIN pool USING (pos)")
def k_examples_per_request(t):
    pool = t.documents.filter(F.col("lang") == "es").select("doc_id", "source")
    return SM.examples_per_request(t.customer, "c_custkey", pool, "doc_id")


@query("first_n", "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 25")
def first_n(t):
    return SM.first_n(t.documents, "doc_id", 25).select("doc_id", "lang")


@query("smote", f"""
WITH v AS (SELECT vec_id, label, embedding::DOUBLE[] e FROM embeddings),
cnt AS (SELECT label, count(*) n FROM v GROUP BY 1), most AS (SELECT max(n) m FROM cnt),
need AS (SELECT label, n, m - n miss FROM cnt, most WHERE n < m),
dr AS (SELECT label, n, unnest(range(miss)) draw FROM need),
d2 AS (SELECT label, draw, {draw(42, "'base'", 'label', 'draw')} % n pos, {draw(42, "'near'", 'label', 'draw')} % least(5, n - 1) + 1 nth,
       {draw(42, "'gap'", 'label', 'draw')}::DOUBLE / 1152921504606846976.0::DOUBLE u FROM dr),
pos AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || vec_id), vec_id) - 1 pos FROM v),
nn AS (SELECT a.vec_id, b.vec_id neighbor, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.e, b.e), b.vec_id) nth
       FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id),
made AS (SELECT p.vec_id source_key, nn.neighbor, d2.label, p.e, o.e oe, u FROM d2 JOIN pos p ON d2.label = p.label AND d2.pos = p.pos
         JOIN nn ON nn.vec_id = p.vec_id AND nn.nth = d2.nth JOIN v o ON o.vec_id = nn.neighbor)
SELECT source_key, neighbor, label, true AS synthetic, round(e[1] + u * (oe[1] - e[1]), 6) AS x0, round(e[64] + u * (oe[64] - e[64]), 6) AS x63,
       round(list_sum(list_transform(range(1, len(e) + 1), lambda i: e[i] + u * (oe[i] - e[i]))), 6) AS total FROM made
UNION ALL SELECT vec_id, NULL, label, false, round(e[1], 6), round(e[64], 6), round(list_sum(e), 6) FROM v""")
def smote(t):
    made = OV.smote(t.embeddings, "vec_id", "embedding", "label")
    return made.select("source_key", "neighbor", "label", "synthetic",
                       F.round(F.col("embedding")[0], 6).alias("x0"), F.round(F.col("embedding")[63], 6).alias("x63"),
                       F.round(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x), 6).alias("total"))
