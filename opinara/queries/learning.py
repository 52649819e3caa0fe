"""Nearest neighbours, naive Bayes and the MLlib learners."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinara.functions import cleaning, distance
from opinara.operators import bayes as B
from opinara.operators import features as FT
from opinara.operators import learners as LR
from opinara.operators import metrics as M
from opinara.operators import neighbors as NN
from opinara.operators import numeric as N
from opinara.operators import sampling as SM
from opinara.operators import sparse_neighbors as SN
from opinara.operators import vectorize as V
from opinara.queries.registry import query
from opinara.queries.relational import prf_sql, rounded
from opinara.queries.sqltext import count_ctes, draw, split_ctes, tfidf_ctes, token_ctes
from opinara.session import materialize, scratch_path

# --- nearest neighbours over the embedding table -------------------------------------------------

_EMB = "emb AS (SELECT vec_id, embedding::DOUBLE[] e, label FROM embeddings)"
_D = {2: "list_distance(a.e, b.e)",
      1: "list_sum(list_transform(range(1, 65), lambda i: abs(a.e[i] - b.e[i])))"}


def _near_sql(p: int, k: int) -> str:
    return (f"SELECT * FROM (SELECT a.vec_id, b.vec_id neighbor, b.label, {p} AS p, {_D[p]} distance, "
            f"row_number() OVER (PARTITION BY a.vec_id ORDER BY {_D[p]}, b.vec_id) rank "
            f"FROM sp a JOIN sp b ON a.part = 'dev' AND b.part = 'train') WHERE rank <= {k}")


_SPLIT = f"{_EMB}, {split_ctes('emb', 'vec_id', 'label')}"


def parts(t):
    split = SM.stratified_split(t.embeddings, "vec_id", "label")
    return SM.part(split, "train"), SM.part(split, "dev")


def near(t, k, p=2, **options):
    train, dev = parts(t)
    return NN.knn_join(dev, train, k, p=p, query_key="vec_id", train_key="vec_id", query_vec="embedding",
                       train_vec="embedding", payload=["label"], **options)


@query("minkowski_distance", f"""
WITH {_EMB} SELECT a.vec_id, round({_D[1]}, 6) AS d1, round({_D[2]}, 6) AS d2 FROM emb a JOIN emb b ON b.vec_id = a.vec_id + 1""")
def minkowski_distance(t):
    a, b = t.embeddings.select("vec_id", "embedding"), t.embeddings.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return a.join(b, "vec_id").select("vec_id", *[F.round(distance.minkowski(F.col("embedding"), F.col("other"), p), 6).alias(f"d{p}") for p in (1, 2)])


@query("knn_join", f"""
WITH {_EMB} SELECT vec_id, neighbor, CAST(rank AS INTEGER) AS rank, round(distance, 6) AS distance FROM (
 SELECT a.vec_id, b.vec_id neighbor, {_D[2]} distance, row_number() OVER (PARTITION BY a.vec_id ORDER BY {_D[2]}, b.vec_id) rank
 FROM emb a JOIN emb b ON a.vec_id <> b.vec_id) WHERE rank <= 3""")
def knn_join(t):
    found = NN.knn_join(t.embeddings, t.embeddings, 3, query_key="vec_id", train_key="vec_id", query_vec="embedding",
                        train_vec="embedding", exclude_self=True, cell_rows=100, block_rows=200)
    return found.select("vec_id", "neighbor", "rank", F.round("distance", 6).alias("distance"))


@query("knn_topk", f"WITH {_SPLIT}, nn AS ({_near_sql(1, 5)}) SELECT vec_id, neighbor, label, CAST(rank AS INTEGER) AS rank, round(distance, 6) AS distance FROM nn")
def knn_topk(t):
    return near(t, 5, p=1).select("vec_id", "neighbor", "label", "rank", F.round("distance", 6).alias("distance"))


_W = ("nw AS (SELECT *, min(distance) OVER (PARTITION BY vec_id, p) m FROM nn), "
      "nv AS (SELECT *, 1.0::DOUBLE wu, CASE WHEN m = 0 THEN CAST(distance = 0 AS DOUBLE) ELSE 1.0 / distance END wd FROM nw)")


def _vote_sql(weight: str) -> str:
    return f"""
WITH {_SPLIT}, nn AS ({_near_sql(2, 5)}), {_W},
vt AS (SELECT vec_id, label, sum({weight}) v FROM nv GROUP BY 1, 2)
SELECT vec_id, label AS prediction FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY v DESC, label) r FROM vt) WHERE r = 1"""


@query("knn_classify_uniform", _vote_sql("wu"))
def knn_classify_uniform(t):
    return NN.knn_classify(near(t, 5), "vec_id", "label", "uniform")


@query("knn_classify_distance", _vote_sql("wd"))
def knn_classify_distance(t):
    return NN.knn_classify(near(t, 5), "vec_id", "label", "distance")


# The full grid of 20 trials: k = 1, 3, .. 9; both metrics; both weightings.
_GRID = NN.knn_trials(list(range(1, 11, 2)), [1, 2], ["uniform", "distance"])


@query("knn_grid", f"""
WITH {_SPLIT}, nn AS ({_near_sql(1, 9)} UNION ALL {_near_sql(2, 9)}), {_W},
tr(trial_id, k, p, w) AS (VALUES {", ".join(f"({i}, {k}, {p}, '{w}')" for i, k, p, w in _GRID)}),
vt AS (SELECT trial_id, vec_id, label, sum(CASE WHEN w = 'uniform' THEN wu ELSE wd END) v FROM nv JOIN tr ON nv.p = tr.p AND nv.rank <= tr.k GROUP BY 1, 2, 3),
pr AS (SELECT trial_id, vec_id, label pred FROM (SELECT *, row_number() OVER (PARTITION BY trial_id, vec_id ORDER BY v DESC, label) r FROM vt) WHERE r = 1),
{prf_sql("SELECT trial_id, sp.label real, pred FROM pr JOIN sp USING (vec_id)", "macro", by="trial_id")}""")
def knn_grid(t):
    train, dev = parts(t)
    args = dict(query_key="vec_id", train_key="vec_id", query_vec="embedding", train_vec="embedding", payload=["label"])
    most = max(k for _, k, _, _ in _GRID)
    found = [NN.knn_join(dev, train, most, p=p, **args).withColumn("p", F.lit(p)) for p in (1, 2)]
    voted = NN.knn_grid(found[0].unionByName(found[1]), "vec_id", "label", _GRID)
    real = dev.select("vec_id", F.col("label").alias("real"))
    counts = M.confusion_counts(voted.join(real, "vec_id"), "real", "prediction", ["trial_id"])
    return rounded(M.prf(counts, "macro", ["trial_id"]))


# --- naive Bayes over labelled documents ----------------------------------------------------------

_DOCS = f"doc AS (SELECT doc_id, text, quality FROM documents JOIN labels USING (doc_id)), {split_ctes('doc', 'doc_id', 'quality')}"
_TOK = f"{_DOCS}, {token_ctes('sp', extra=', quality, part')}"


def tokens():
    return cleaning.clean_tokens(F.col("text"))


def labelled_docs(t):
    docs = t.texts.join(t.labels, "doc_id").select("doc_id", "text", "quality")
    split = SM.stratified_split(docs, "doc_id", "quality")
    return SM.part(split, "train"), SM.part(split, "dev")


def _nb_ctes(kind: str, alphas: str, weights: str = "tfw AS (SELECT doc_id, term, tf::DOUBLE weight FROM tf JOIN voc USING (term))") -> str:
    mass = "tc" if kind == "multinomial" else "tt - tc"
    norm = "cm" if kind == "multinomial" else "am - cm"
    sign = "prior + " if kind == "multinomial" else "-1 * "
    return f"""{weights},
lab AS (SELECT doc_id, quality, part FROM cl),
cls AS (SELECT quality c, ln(count(*)::DOUBLE / sum(count(*)) OVER ()) prior FROM lab WHERE part = 'train' GROUP BY 1),
tct AS (SELECT term, quality c, sum(weight) tc FROM tfw JOIN lab USING (doc_id) WHERE part = 'train' GROUP BY 1, 2),
tot AS (SELECT term, sum(tc) tt FROM tct GROUP BY 1),
full_ AS (SELECT term, tt, c, prior, coalesce(tc, 0) tc FROM tot CROSS JOIN cls LEFT JOIN tct USING (term, c)),
cms AS (SELECT c, sum(tc) cm, count(*) nv FROM full_ GROUP BY 1), amt AS (SELECT sum(tt) am FROM tot),
al AS ({alphas}),
lp AS (SELECT alpha, term, c, prior, ln({mass} + alpha) - ln({norm} + alpha * nv) lp FROM full_ JOIN cms USING (c), amt, al),
sc AS (SELECT alpha, doc_id, c, any_value(prior) prior, sum(weight * lp) s FROM tfw JOIN lp USING (term) WHERE doc_id IN (SELECT doc_id FROM lab WHERE part = 'dev') GROUP BY 1, 2, 3),
bs AS (SELECT alpha, doc_id, c prediction, {sign}s score, row_number() OVER (PARTITION BY alpha, doc_id ORDER BY {sign}s DESC, c) r FROM sc),
pr AS (SELECT alpha, lab.doc_id, lab.quality real, coalesce(bs.prediction, {"(SELECT c FROM cls ORDER BY prior DESC, c LIMIT 1)" if kind == "multinomial" else "(SELECT min(c) FROM cls)"}) prediction
       FROM lab LEFT JOIN bs ON lab.doc_id = bs.doc_id AND r = 1 WHERE lab.part = 'dev')"""


_COUNTS = count_ctes(min_df=1, fit="part = 'train'")
_TFIDF = count_ctes(min_df=3, fit="part = 'train'") + ",\n" + tfidf_ctes()
_TFIDF_W = "tfw AS (SELECT doc_id, term, weight FROM w)"


def bayes_model(t, kind, method):
    train, dev = labelled_docs(t)
    vectors = V.fit_text(train, "doc_id", tokens(), method)
    model = B.fit_term_bayes(train, vectors.fitted(), "doc_id", "quality", kind)
    return model, dev, vectors.transform(dev, tokens())


def term_bayes(t, kind, method, alphas):
    model, dev, weights = bayes_model(t, kind, method)
    return dev, model.predict(dev, weights, alphas)


@query("nb_multinomial", f"WITH {_TOK}, {_COUNTS}, {_nb_ctes('multinomial', 'SELECT 1.0::DOUBLE alpha')} SELECT doc_id, real, prediction FROM pr")
def nb_multinomial(t):
    dev, out = term_bayes(t, "multinomial", "frequency", [1.0])
    return out.join(dev, "doc_id").select("doc_id", F.col("quality").alias("real"), "prediction")


@query("nb_complement", f"WITH {_TOK}, {_TFIDF}, {_nb_ctes('complement', 'SELECT 0.5::DOUBLE alpha', _TFIDF_W)} SELECT doc_id, real, prediction FROM pr")
def nb_complement(t):
    dev, out = term_bayes(t, "complement", "tf-idf", [0.5])
    return out.join(dev, "doc_id").select("doc_id", F.col("quality").alias("real"), "prediction")


def _scored(t, alphas):
    dev, out = term_bayes(t, "multinomial", "tf-idf", alphas)
    real = dev.select("doc_id", F.col("quality").alias("real"))
    return M.confusion_counts(out.join(real, "doc_id"), "real", "prediction", ["alpha"])


@query("nb_alpha_sweep", f"""
WITH {_TOK}, {_TFIDF}, {_nb_ctes('multinomial', "SELECT round(0.01::DOUBLE + i * 0.005::DOUBLE, 4) alpha FROM (SELECT unnest(range(199)) i)", _TFIDF_W)},
{prf_sql("SELECT alpha, real, prediction pred FROM pr", "macro", by="alpha")}""")
def nb_alpha_sweep(t):
    return rounded(M.prf(_scored(t, B.alpha_grid(0.01, 1.0, 0.005)), "macro", ["alpha"]))


@query("prf_macro", f"""
WITH {_TOK}, {_TFIDF}, {_nb_ctes('multinomial', 'SELECT 0.1::DOUBLE alpha', _TFIDF_W)},
{prf_sql("SELECT real, prediction pred FROM pr", "macro")}""")
def prf_macro(t):
    return rounded(M.prf(_scored(t, [0.1]), "macro", ["alpha"]).drop("alpha"))


_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_LI = """
li AS (SELECT l_orderkey || ':' || l_partkey || ':' || l_suppkey || ':' || l_linenumber k, l_returnflag, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)""".strip()
_LIS = f"{_LI}, {split_ctes('li', 'k', 'l_returnflag')}"


def numeric_parts(t):
    key = F.concat_ws(":", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    data = t.lineitem.select(key.alias("k"), "l_returnflag", *_NUM)
    split = SM.stratified_split(data, "k", "l_returnflag")
    return SM.part(split, "train"), SM.part(split, "dev")


@query("nb_gaussian", f"""
WITH {_LIS}, tr AS (SELECT * FROM sp WHERE part = 'train'),
eps AS (SELECT 1e-9::DOUBLE * greatest({", ".join(f"var_pop({c})" for c in _NUM)}) e FROM tr),
st AS (SELECT l_returnflag c, ln(count(*)::DOUBLE / (SELECT count(*) FROM tr)) prior, {", ".join(f"avg({c}) m_{c}, var_pop({c}) + any_value(e) v_{c}" for c in _NUM)} FROM tr, eps GROUP BY 1),
sc AS (SELECT k, c, prior + {" + ".join(f"(-0.5::DOUBLE * ln(2 * pi() * v_{c}) - ({c} - m_{c}) * ({c} - m_{c}) / (2 * v_{c}))" for c in _NUM)} s FROM sp, st WHERE part = 'dev')
SELECT k, prediction FROM (SELECT k, c prediction, row_number() OVER (PARTITION BY k ORDER BY s DESC, c) r FROM sc) WHERE r = 1""")
def nb_gaussian(t):
    train, dev = numeric_parts(t)
    return B.fit_gaussian(train, _NUM, "l_returnflag").predict(dev).select("k", "prediction")


@query("nb_categorical", f"""
WITH {_LIS}, tr AS (SELECT * FROM sp WHERE part = 'train'),
ed AS (SELECT {", ".join(f"min({c}) lo_{c}, max({c}) hi_{c}" for c in _NUM)} FROM tr),
bn AS (SELECT k, l_returnflag, part, {", ".join(f"len(list_filter(range(1, 5), lambda j: {c} >= j * ((hi_{c} - lo_{c}) / 5) + lo_{c})) {c}" for c in _NUM)} FROM sp, ed),
un AS (UNPIVOT bn ON {", ".join(_NUM)} INTO NAME f VALUE b),
nc AS (SELECT l_returnflag c, count(*) n FROM tr GROUP BY 1),
sz AS (SELECT f, max(b) + 1 s FROM un WHERE part = 'train' GROUP BY 1),
ct AS (SELECT l_returnflag c, f, b, count(*) m FROM un WHERE part = 'train' GROUP BY 1, 2, 3),
sc AS (SELECT k, nc.c, ln(any_value(nc.n)::DOUBLE / (SELECT count(*) FROM tr)) + sum(ln(coalesce(m, 0) + 1.0::DOUBLE) - ln(nc.n + 1.0::DOUBLE * s)) v
       FROM (SELECT * FROM un WHERE part = 'dev') u CROSS JOIN nc JOIN sz USING (f) LEFT JOIN ct ON ct.c = nc.c AND ct.f = u.f AND ct.b = u.b GROUP BY 1, 2)
SELECT k, prediction FROM (SELECT k, c prediction, row_number() OVER (PARTITION BY k ORDER BY v DESC, c) r FROM sc) WHERE r = 1""")
def nb_categorical(t):
    train, dev = numeric_parts(t)
    bins = N.fit_discretize(train, _NUM, 5)
    codes = [f"{c}_disc" for c in _NUM]
    model = B.fit_categorical(bins.transform(train), codes, "l_returnflag")
    return model.predict(bins.transform(dev)).select("k", "prediction")


# --- the same over text: every term a feature, zeros implied ---------------------------------------

_ALL = """
lab AS (SELECT doc_id, quality, part FROM cl),
cls AS (SELECT quality c, count(*) n, ln(count(*)::DOUBLE / sum(count(*)) OVER ()) prior FROM lab WHERE part = 'train' GROUP BY 1),
x AS (SELECT lab.doc_id, lab.quality, lab.part, voc.term, coalesce(v.weight, 0) x FROM lab CROSS JOIN voc
      LEFT JOIN val v ON v.doc_id = lab.doc_id AND v.term = voc.term)""".strip()


@query("nb_gaussian_text", f"""
WITH {_TOK}, {_TFIDF}, val AS (SELECT doc_id, term, weight FROM w), {_ALL},
eps AS (SELECT 1e-9::DOUBLE * max(v) e FROM (SELECT var_pop(x) v FROM x WHERE part = 'train' GROUP BY term)),
st AS (SELECT term, quality c, avg(x) m, var_pop(x) + any_value(e) v FROM x, eps WHERE part = 'train' GROUP BY 1, 2),
sc AS (SELECT doc_id, quality, cls.c, any_value(prior) + sum(-0.5::DOUBLE * ln(2 * pi() * v) - (x - m) * (x - m) / (2 * v)) s
       FROM x JOIN st USING (term) JOIN cls ON cls.c = st.c WHERE part = 'dev' GROUP BY 1, 2, 3)
SELECT doc_id, quality AS real, c AS prediction FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, c) r FROM sc) WHERE r = 1""")
def nb_gaussian_text(t):
    train, dev = labelled_docs(t)
    vectors = V.fit_text(train, "doc_id", tokens())
    model = B.fit_long_gaussian(train, vectors.fitted(), "doc_id", "quality")
    return model.predict(dev, vectors.transform(dev, tokens())).join(dev, "doc_id").select(
        "doc_id", F.col("quality").alias("real"), "prediction")


_CODE_ALPHAS = [0.1, 1.0]


@query("nb_categorical_text", f"""
WITH {_TOK}, {count_ctes(min_df=3, fit="part = 'train'")}, val AS (SELECT doc_id, term, tf weight FROM tf JOIN voc USING (term)), {_ALL},
sz AS (SELECT term, max(x) + 1 s FROM x WHERE part = 'train' GROUP BY 1),
ct AS (SELECT term, quality c, x, count(*) m FROM x WHERE part = 'train' GROUP BY 1, 2, 3),
al AS (SELECT unnest([{", ".join(f"{a}::DOUBLE" for a in _CODE_ALPHAS)}]) alpha),
sc AS (SELECT alpha, u.doc_id, u.quality, cls.c, any_value(prior) + sum(ln(coalesce(m, 0) + alpha) - ln(n + alpha * s)) v
       FROM (SELECT * FROM x WHERE part = 'dev') u CROSS JOIN cls CROSS JOIN al JOIN sz USING (term)
       LEFT JOIN ct ON ct.c = cls.c AND ct.term = u.term AND ct.x = u.x GROUP BY 1, 2, 3, 4)
SELECT alpha, doc_id, quality AS real, c AS prediction FROM (SELECT *, row_number() OVER (PARTITION BY alpha, doc_id ORDER BY v DESC, c) r FROM sc) WHERE r = 1""")
def nb_categorical_text(t):
    train, dev = labelled_docs(t)
    vectors = V.fit_text(train, "doc_id", tokens(), "frequency", min_df=3)
    model = B.fit_long_categorical(train, vectors.fitted(), "doc_id", "quality")
    return model.predict(dev, vectors.transform(dev, tokens()), _CODE_ALPHAS).join(dev, "doc_id").select(
        "alpha", "doc_id", F.col("quality").alias("real"), "prediction")


# --- neighbours and oversampling over text, one to two words a term ---------------------------------


def _pairs_sql(p: int, a: str, b: str) -> str:
    """CTE ``gp{p}``: sums of |x - y|^p, to nine decimals, of rows of ``sz`` under conditions on both."""
    like = "a.weight * b.weight" if p == 2 else "least(a.weight, b.weight)"
    return f"""sh{p} AS (SELECT a.doc_id, b.doc_id nb, sum({like}) s FROM wq a JOIN wq b USING (term) WHERE {a} AND {b} GROUP BY 1, 2),
gp{p} AS (SELECT a.doc_id, b.doc_id nb, b.quality, {p} p, round(greatest(a.n{p} + b.n{p} - 2 * coalesce(s, 0), 0), 9) gap
          FROM sz a JOIN sz b ON {a} AND {b} LEFT JOIN sh{p} ON sh{p}.doc_id = a.doc_id AND sh{p}.nb = b.doc_id)"""


_GRAMS = (f"{_TOK}, " + "{counts}" + f""",
{tfidf_ctes()},
wq AS (SELECT w.*, cl.part, cl.quality FROM w JOIN cl USING (doc_id)),
sz AS (SELECT cl.doc_id, part, quality, coalesce(sum(weight), 0) n1, coalesce(sum(weight * weight), 0) n2 FROM cl LEFT JOIN w USING (doc_id) GROUP BY 1, 2, 3)""")
_NEAR_TEXT = 5


@query("knn_text", f"""
WITH {_GRAMS.replace("{counts}", count_ctes(min_df=3, bigrams=True, fit="part = 'train'"))},
{_pairs_sql(1, "a.part = 'dev'", "b.part = 'train'")}, {_pairs_sql(2, "a.part = 'dev'", "b.part = 'train'")},
rk AS (SELECT *, row_number() OVER (PARTITION BY p, doc_id ORDER BY gap, nb) r FROM (SELECT * FROM gp1 UNION ALL SELECT * FROM gp2))
SELECT p, doc_id, nb AS neighbor, quality, CAST(r AS INTEGER) AS rank, round(CASE WHEN p = 2 THEN sqrt(gap) ELSE gap END, 6) AS distance
FROM rk WHERE r <= {_NEAR_TEXT}""")
def knn_text(t):
    train, dev = labelled_docs(t)
    vectors = V.fit_text(train, "doc_id", tokens(), up_to=2)
    known = materialize(vectors.fitted().select("doc_id", "term", "weight"), "text-train")
    asked = materialize(vectors.transform(dev, tokens()).select("doc_id", "term", "weight"), "text-dev")
    found = [SN.sparse_knn(dev, asked, train, known, _NEAR_TEXT, p=p, query_key="doc_id", train_key="doc_id", payload=["quality"])
             .withColumn("p", F.lit(p)) for p in (1, 2)]
    d = F.col("distance")
    shown = F.when(F.col("p") == 2, F.sqrt(F.round(d * d, 9))).otherwise(F.round(d, 9))
    return found[0].unionByName(found[1]).select("p", "doc_id", "neighbor", "quality", "rank", F.round(shown, 6).alias("distance"))


@query("smote_text", f"""
WITH {_GRAMS.replace("{counts}", count_ctes(min_df=3, bigrams=True))},
nq AS (SELECT quality, count(*) n FROM sz GROUP BY 1),
need AS (SELECT quality, n, (SELECT max(n) FROM nq) - n miss FROM nq WHERE n < (SELECT max(n) FROM nq)),
dr AS (SELECT quality, n, unnest(range(miss)) draw FROM need),
d2 AS (SELECT quality, draw, {draw(42, "'base'", 'quality', 'draw')} % n pos, {draw(42, "'near'", 'quality', 'draw')} % least(5, n - 1) + 1 nth,
       {draw(42, "'gap'", 'quality', 'draw')}::DOUBLE / 1152921504606846976.0::DOUBLE u FROM dr),
ps AS (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY md5('42:' || doc_id), doc_id) - 1 pos FROM sz),
{_pairs_sql(2, "a.quality IN (SELECT quality FROM need)", "a.quality = b.quality AND a.doc_id <> b.doc_id")},
nn AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY gap, nb) nth FROM gp2),
md AS (SELECT 'synthetic:' || d2.quality || ':' || draw row_key, ps.doc_id, nb, d2.quality, u FROM d2
       JOIN ps ON ps.quality = d2.quality AND ps.pos = d2.pos JOIN nn ON nn.doc_id = ps.doc_id AND nn.nth = d2.nth),
lg AS (SELECT row_key, term, sum(x) x FROM (SELECT row_key, term, weight * (1 - u) x FROM md JOIN w ON w.doc_id = md.doc_id
       UNION ALL SELECT row_key, term, weight * u FROM md JOIN w ON w.doc_id = nb) GROUP BY 1, 2)
SELECT row_key, md.doc_id AS source_key, nb AS neighbor, quality, count(term) AS n_terms, round(coalesce(sum(x), 0), 6) AS total,
       round(coalesce(sum(x * x), 0), 6) AS squares FROM md LEFT JOIN lg USING (row_key) GROUP BY 1, 2, 3, 4""")
def smote_text(t):
    docs = t.texts.join(t.labels, "doc_id").select("doc_id", "text", "quality")
    vectors = V.fit_text(docs, "doc_id", tokens(), up_to=2)
    made, weights = SN.sparse_smote(docs, materialize(vectors.fitted(), "text-rows"), "doc_id", "quality")
    sums = weights.groupBy("row_key").agg(F.count("*").alias("n_terms"), F.sum("weight").alias("total"),
                                          F.sum(F.col("weight") * F.col("weight")).alias("squares"))
    return made.join(sums, "row_key", "left").select(
        "row_key", "source_key", "neighbor", "quality", F.coalesce("n_terms", F.lit(0)).alias("n_terms"),
        *[F.round(F.coalesce(c, F.lit(0.0)), 6).alias(c) for c in ("total", "squares")])


# --- MLlib learners: results are learnt, so only their shape can be checked ------------------------


def vector_parts(t):
    """Labelled documents as sparse TF-IDF vectors, written once for all trials."""
    train, dev = labelled_docs(t)
    vectors = V.fit_text(train, "doc_id", tokens())
    size = vectors.numbered.count()
    asked = vectors.packed(V.term_counts(dev, "doc_id", tokens()))
    return tuple(FT.long_vectors(df.select("doc_id", "quality"), packed, size, "doc_id")
                 for df, packed in ((train, vectors.packed()), (dev, asked)))


def grid(t, trials):
    train, dev = vector_parts(t)
    scores, _ = LR.run_grid(trials(train), train, dev, "quality")
    return scores


# The shipped configuration: depths 1 to 40 (MLlib fits those beyond 30 as 30, once), both criteria, 200 trees.
_DEPTHS, _CRITERIA, _TREES = list(range(1, 41)), ["gini", "entropy"], 200


@query("decision_tree")
def decision_tree(t):
    return grid(t, lambda train: LR.tree_trials([5], 5, 5, "gini"))


@query("tree_grid")
def tree_grid(t):
    return M.trial_log(grid(t, lambda train: LR.tree_trials(_DEPTHS, 5, 5, _CRITERIA)), "Combinacion")


@query("random_forest")
def random_forest(t):
    return grid(t, lambda train: LR.tree_trials([5], 5, 5, "gini", n_trees=_TREES))


@query("forest_grid")
def forest_grid(t):
    return M.trial_log(grid(t, lambda train: LR.tree_trials(_DEPTHS, 5, 5, _CRITERIA, n_trees=_TREES)), "Combinacion")


@query("logistic_regression")
def logistic_regression(t):
    return grid(t, lambda train: LR.logistic_trials(train.count(), [1.0], ["l2"], ["lbfgs"]))


@query("logreg_grid")
def logreg_grid(t):
    return M.trial_log(grid(t, lambda train: LR.logistic_trials(
        train.count(), [0.5, 0.8, 1.0, 2.0, 3.0, 5.0, 10.0], ["l2"], ["lbfgs"])), "Combinacion")


def saved_package(t):
    train, dev = vector_parts(t)
    scores, fitted = LR.run_grid(LR.tree_trials([3], 5, 5, ["gini"]), train, dev, "quality")
    winner = fitted[M.best_trial(scores).first()["trial_id"]]
    path = scratch_path(t.spark, "package")
    LR.Package(winner.model, [], {"name": winner.trial.name, **winner.trial.params}).save(path)
    return LR.Package.load(t.spark, path), dev


@query("model_reload_scores")
def model_reload_scores(t):
    package, dev = saved_package(t)
    return package.model.transform(dev).select("doc_id", F.col("quality").cast("string").alias("real"),
                                               F.col("predicted_label").alias("prediction"))


@query("evaluate_saved_model")
def evaluate_saved_model(t):
    package, dev = saved_package(t)
    counts = M.confusion_counts(package.model.transform(dev), "quality", "predicted_label")
    scores = M.prf(counts, "macro").withColumn("model", F.lit(package.params["name"]))
    return rounded(scores)
