"""Clusters, topics and coherence."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinara.functions import cleaning
from opinara.operators import clusters as C
from opinara.operators import coherence as CO
from opinara.operators import features as FT
from opinara.operators import topics as TP
from opinara.operators import vectorize as V
from opinara.queries.registry import query
from opinara.queries.sqltext import count_ctes, tfidf_ctes, token_ctes
from opinara.session import materialize

_BASE = f"{token_ctes(extra=', lang')}, {count_ctes()}, {tfidf_ctes()}, asg AS (SELECT doc_id, lang cluster_id FROM cl)"
_CEN = (f"{_BASE}, sz AS (SELECT cluster_id, count(*) n FROM asg GROUP BY 1),\n"
        "cen AS (SELECT cluster_id, term, n, sum(weight) / n weight FROM w JOIN asg USING (doc_id) JOIN sz USING (cluster_id) GROUP BY cluster_id, term, n)")


def tokens():
    return cleaning.clean_tokens(F.col("text"))


def weighed(t):
    """Documents as TF-IDF rows, and their language as a stand-in cluster."""
    fitted = V.fit_text(t.texts, "doc_id", tokens())
    return fitted, t.documents.select("doc_id", F.col("lang").alias("cluster_id"))


@query("cluster_sizes", "SELECT label AS cluster_id, count(*) AS n_instancias FROM embeddings GROUP BY 1")
def cluster_sizes(t):
    return C.cluster_sizes(t.embeddings.withColumnRenamed("label", "cluster_id"))


@query("cluster_centroids", f"WITH {_CEN} SELECT cluster_id, term, n AS n_instancias, round(weight, 8) AS weight FROM cen")
def cluster_centroids(t):
    fitted, assigned = weighed(t)
    return (C.cluster_centroids(assigned, fitted.fitted(), "doc_id")
            .withColumn("weight", F.round("weight", 8)))


@query("cluster_keywords", f"""
WITH {_CEN} SELECT cluster_id, n AS n_instancias, CAST(rank AS INTEGER) AS rank, term AS palabra, round(weight, 5) AS peso_medio
FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY weight DESC, term) rank FROM cen) WHERE rank <= 10""")
def cluster_keywords(t):
    fitted, assigned = weighed(t)
    return C.cluster_keywords(C.cluster_centroids(assigned, fitted.fitted(), "doc_id"))


@query("inertia", """
WITH x AS (SELECT label, generate_subscripts(embedding, 1) d, unnest(embedding::DOUBLE[]) x FROM embeddings),
m AS (SELECT label, d, avg(x) m FROM x GROUP BY 1, 2)
SELECT round(sum((x - m) * (x - m)), 6) AS inercia FROM x JOIN m USING (label, d)""")
def inertia(t):
    return C.inertia(t.embeddings, "embedding", "label").withColumn("inercia", F.round("inercia", 6))


@query("kmeans_assign", """
WITH c AS (SELECT vec_id - 1 i, embedding::DOUBLE[] c FROM embeddings WHERE vec_id BETWEEN 1 AND 5)
SELECT vec_id, CAST(arg_min(i, list_distance(embedding::DOUBLE[], c)) AS INTEGER) AS cluster_id FROM embeddings, c GROUP BY vec_id""")
def kmeans_assign(t):
    centers = [r["embedding"] for r in t.embeddings.filter(F.col("vec_id").between(1, 5)).orderBy("vec_id").collect()]
    return C.assign_nearest(t.embeddings, "embedding", centers).select("vec_id", "cluster_id")


# The shipped configuration: ten starts, k from 2 to 7; ten passes, 2 to 10 topics.
_STARTS, _ELBOW, _PASSES, _TOPICS = 10, list(range(2, 8)), 10, list(range(2, 11))


def embedding_vectors(t):
    return FT.array_vectors(t.embeddings, "embedding").select("vec_id", "features").persist()


@query("kmeans_fit")
def kmeans_fit(t):
    data = embedding_vectors(t)
    model, _ = C.kmeans_fit(data, 5, n_init=_STARTS)
    return model.transform(data).select("vec_id", "cluster_id")


@query("kmeans_elbow")
def kmeans_elbow(t):
    return C.kmeans_elbow(embedding_vectors(t), _ELBOW, n_init=_STARTS)[0]


# --- topics: given mixes are exact, learnt ones are not ---------------------------------------------


@query("dominant_topic", "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS cluster_id FROM embeddings")
def dominant_topic(t):
    return t.embeddings.select("vec_id", TP.dominant_topic(F.col("embedding")).alias("cluster_id"))


def document_vectors(t):
    fitted = V.fit_text(t.texts, "doc_id", tokens())
    return fitted, FT.long_vectors(t.documents.select("doc_id"), fitted.packed(), fitted.numbered.count(), "doc_id")


@query("lda_fit")
def lda_fit(t):
    fitted, vectors = document_vectors(t)
    model = TP.lda_fit(vectors, 4, passes=_PASSES)
    return TP.topic_words(model, V.number_terms(fitted.vocab), 20)


@query("lda_doc_topics")
def lda_doc_topics(t):
    _, vectors = document_vectors(t)
    return TP.topic_mix(TP.lda_fit(vectors, 3, passes=_PASSES), vectors).drop("features", "topic_mix")


@query("lda_topic_words")
def lda_topic_words(t):
    fitted, vectors = document_vectors(t)
    model = TP.lda_fit(vectors, 3, passes=_PASSES)
    return TP.topic_report(TP.topic_words(model, V.number_terms(fitted.vocab)), TP.topic_mix(model, vectors))


@query("lda_coherence_curve")
def lda_coherence_curve(t):
    fitted, vectors = document_vectors(t)
    texts = materialize(V.presence_texts(fitted.fitted(), "doc_id"), "texts")
    return TP.coherence_curve(vectors, V.number_terms(fitted.vocab), texts, _TOPICS, "c_v", passes=_PASSES)


# --- coherence of given topics: the 20 heaviest words of each language ------------------------------

_TOP = f"""{_CEN},
top AS (SELECT * FROM (SELECT cluster_id topic, term, row_number() OVER (PARTITION BY cluster_id ORDER BY weight DESC, term) rank FROM cen) WHERE rank <= 20),
ps AS (SELECT doc_id, term, row_number() OVER (PARTITION BY doc_id ORDER BY term) pos, count(*) OVER (PARTITION BY doc_id) len FROM w),
h AS (SELECT doc_id, topic, rank, pos, len FROM ps JOIN top USING (term)),
pr AS (SELECT a.topic, a.rank i, b.rank j, a.pos pa, b.pos pb, a.len FROM h a JOIN h b ON a.doc_id = b.doc_id AND a.topic = b.topic AND a.rank <= b.rank),
grid AS (SELECT a.topic, a.rank i, b.rank j FROM top a JOIN top b ON a.topic = b.topic AND a.rank <= b.rank)"""


def _prob_sql(window: int | None) -> str:
    if window is None:
        total, n = "count(*)", "count(*)"
    else:
        total = f"sum(greatest(len - {window} + 1, 1))"
        n = (f"sum(CASE WHEN len <= {window} THEN 1 ELSE greatest(0, least(least(pa, pb), len - {window} + 1) "
             f"- greatest(1, greatest(pa, pb) - {window} + 1) + 1) END)")
    return f"""{_TOP},
tt AS (SELECT {total}::DOUBLE total FROM (SELECT DISTINCT doc_id, len FROM ps)),
ct AS (SELECT topic, i, j, {n}::DOUBLE / (SELECT total FROM tt) p FROM pr GROUP BY 1, 2, 3),
pb AS (SELECT g.topic, g.i, g.j, coalesce(c.p, 0) p, a.p pi_, b.p pj_ FROM grid g LEFT JOIN ct c USING (topic, i, j)
       JOIN ct a ON a.topic = g.topic AND a.i = g.i AND a.j = g.i JOIN ct b ON b.topic = g.topic AND b.i = g.j AND b.j = g.j)"""


@query("term_cooccurrence", f"""
WITH {_TOP} SELECT topic, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, count(*) AS n FROM pr GROUP BY 1, 2, 3""")
def term_cooccurrence(t):
    texts, topics = given_topics(t)
    return CO.topic_pairs(texts, topics, None)


def given_topics(t):
    fitted, assigned = weighed(t)
    weights = materialize(fitted.fitted(), "weights")
    ranked = C.cluster_keywords(C.cluster_centroids(assigned, weights, "doc_id"), CO.TOP_WORDS)
    topics = materialize(ranked.select(F.col("cluster_id").alias("topic"), "rank", F.col("palabra").alias("term")), "topics")
    return materialize(V.presence_texts(weights, "doc_id"), "texts"), topics


def coherence(t, metric):
    texts, topics = given_topics(t)
    return CO.topic_coherence(texts, topics, metric).withColumn("coherence", F.round("coherence", 6))


@query("coherence_umass", f"WITH {_prob_sql(None)} SELECT topic, round(avg(ln((p + 1e-12) / pi_)), 6) AS coherence FROM pb WHERE i < j GROUP BY 1")
def coherence_umass(t):
    return coherence(t, "u_mass")


@query("coherence_uci", f"WITH {_prob_sql(10)} SELECT topic, round(avg(ln((p + 1e-12) / (pi_ * pj_))), 6) AS coherence FROM pb WHERE i < j GROUP BY 1")
def coherence_uci(t):
    return coherence(t, "c_uci")


@query("coherence_cv", f"""
WITH {_prob_sql(110)},
np AS (SELECT topic, i, j, ln((p + 1e-12) / (pi_ * pj_)) / -ln(p + 1e-12) v FROM pb),
mx AS (SELECT * FROM np UNION ALL SELECT topic, j, i, v FROM np WHERE i < j),
wh AS (SELECT topic, j, sum(v) s FROM mx GROUP BY 1, 2),
cs AS (SELECT topic, i, sum(v * s) / sqrt(sum(v * v)) / sqrt(sum(s * s)) c FROM mx JOIN wh USING (topic, j) GROUP BY 1, 2)
SELECT topic, round(avg(c), 6) AS coherence FROM cs GROUP BY 1""")
def coherence_cv(t):
    return coherence(t, "c_v")
