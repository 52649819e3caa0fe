import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinara.operators import bayes, clusters, coherence, learners, prompts, topics
from opinara.plans import generation, grouping, training
from opinara.plans.config import JobConfig
from opinara.streaming.stateless import clean_stream


@pytest.mark.parametrize("size", [1, 2, 3, 5, 9])
def test_window_counts_match_brute_force(spark, size):
    cases = [(n, a, b) for n in range(1, 10) for a in range(1, n + 1) for b in range(a, n + 1)]
    df = spark.createDataFrame(cases, "n int, a int, b int")
    got = df.select("n", "a", "b", coherence.windows_holding(F.col("a"), F.col("b"), F.col("n"), size).alias("w"),
                    coherence.window_total(F.col("n"), size).alias("t")).collect()
    for r in got:
        windows = [range(s, min(s + size, r["n"] + 1)) for s in range(1, max(1, r["n"] - size + 1) + 1)]
        assert r["w"] == sum(r["a"] in w and r["b"] in w for w in windows)
        assert r["t"] == len(windows)


def test_umass_by_hand(spark):
    texts = spark.createDataFrame([(1, ["a", "b"]), (2, ["a"]), (3, ["a", "c"])], "k int, terms array<string>")
    given = spark.createDataFrame([("t", 1, "a"), ("t", 2, "b"), ("t", 3, "c")], "topic string, rank int, term string")
    got = coherence.topic_coherence(texts, given, "nonsense").first()["coherence"]
    e = 1e-12
    want = (math.log((1 / 3 + e) / 1) + math.log((1 / 3 + e) / 1) + math.log((0 + e) / (1 / 3))) / 3
    assert got == pytest.approx(want)


def test_alpha_grid_includes_the_end():
    grid = bayes.alpha_grid(0.01, 1, 0.005)
    assert len(grid) == 199 and grid[0] == 0.01 and grid[-1] == 1.0
    assert len(bayes.alpha_grid(0.01, 1, 0.01)) == 100


def test_categorical_bayes_meets_unseen_codes(spark):
    train = spark.createDataFrame([(0, 0, "a"), (0, 1, "a"), (1, 1, "b")], "f int, g int, c string")
    model = bayes.fit_categorical(train, ["f", "g"], "c")
    dev = spark.createDataFrame([(0, 0), (1, 7), (None, 1)], "f int, g int")
    assert [r["prediction"] for r in model.predict(dev, 1.0).collect()] == ["a", "b", "a"]


def test_first_topic_and_first_center_win_ties(spark):
    df = spark.createDataFrame([(1, [0.4, 0.4, 0.2]), (2, [0.1, 0.2, 0.7])], "k int, v array<double>")
    assert [r[0] for r in df.select(topics.dominant_topic(F.col("v"))).collect()] == [0, 2]
    at = clusters.assign_nearest(df, "v", [[0.0, 0.0, 0.0], [0.8, 0.8, 0.4]])
    assert [r["cluster_id"] for r in at.orderBy("k").collect()] == [0, 0]


def test_node_floor():
    assert learners.node_floor(5, 5) == 5 and learners.node_floor(20, 5) == 10
    assert learners.decision_tree(40).getMaxDepth() == 30


WORDS = {"POSITIVO": "great lovely superb app photos friends", "NEGATIVO": "awful crash slow bugs ads account",
         "NEUTRO": "okay average fine usual update version"}


def reviews(spark, n=150):
    rows = []
    for i in range(n):
        label = ["POSITIVO", "NEGATIVO", "NEUTRO"][i % 3]
        w = WORDS[label].split()
        text = f"The {w[i % 6]} thing is {w[(i + 1) % 6]}, {w[(i * 5 + 2) % 6]}!" if i % 25 else None
        rows.append((i, f"id{i}", text, float(i % 7) if i % 9 else None, {"POSITIVO": 5, "NEGATIVO": 1, "NEUTRO": 3}[label]))
    return spark.createDataFrame(rows, "k int, reviewId string, content string, likes double, rating int").withColumn(
        "score", F.when(F.col("rating") == 5, "POSITIVO").when(F.col("rating") == 1, "NEGATIVO").otherwise("NEUTRO")).drop("rating")


def config(algorithm, **prep):
    base = {"drop_features": ["reviewId", "likes"], "categorical_features_convert": ["content"],
            "missing_values": "impute", "text_preprocess": "tf-idf", "ngramas_tfidf": 2}
    return JobConfig({
        "proyecto": True, "algorithm": algorithm, "preprocessing": {**base, **prep},
        "hyperparametersKNN": {"k_min": 1, "k_max": 3, "w": ["uniform", "distance"]},
        "hyperparametersDecisionTree": {"min_depth": 2, "max_depth": 3, "criterion": ["gini"]},
        "hyperparametersRandomForest": {"n_estimators": 5},
        "hyperparametersNaiveBayes": {"type": prep.get("nb", "multinomial"), "min_alpha": 0.5, "max_alpha": 1, "step_alpha": 0.5},
        "hyperparametersLogisticRegression": {"C": [1.0, 10.0]},
        "hyperparametersKMeans": {"k_min": 2, "k_max": 3, "n_inicios": 2},
        "hyperparametersLDA": {"k_min": 2, "k_max": 2, "passes": 3, "coherencia_metrica": "c_v"}})


@pytest.mark.parametrize("algorithm, prep, trials", [
    ("NaiveBayes", {}, 2), ("NaiveBayes", {"nb": "complement", "sampling": "undersampling"}, 2),
    ("KNN", {"text_preprocess": "frequency", "sampling": "oversampling"}, 4),
    ("LogisticRegression", {"drop_features": ["reviewId"], "scaling": "max-min"}, 2),
    ("DecisionTree", {"text_preprocess": "one-hot"}, 2),
])
def test_train_save_evaluate(spark, tmp_path, algorithm, prep, trials):
    outcome = training.split_and_train(config(algorithm, **prep), reviews(spark), "k", "score")
    assert outcome.log.count() == trials
    assert outcome.log.columns == ["Combinacion", "Accuracy", "Precision", "Recall", "F_score"]
    path = str(tmp_path / "package")
    outcome.save(path)
    report = training.evaluate(spark, path, outcome.test)
    assert report["predictions"].count() == outcome.test.count() == 23
    assert report["scores"].first()["f1"] > 0.5 and report["name"]
    direct = {r["k"]: r["prediction"] for r in outcome.model.predict(outcome.preprocessor, outcome.test).collect()}
    assert direct == {r["k"]: r["prediction"] for r in report["predictions"].collect()}


@pytest.mark.parametrize("kind", ["categorical", "gaussian"])
def test_numeric_bayes_jobs(spark, tmp_path, kind):
    data = spark.range(200).select(F.col("id").alias("k"), (F.col("id") % 10).cast("double").alias("x"),
                                   F.when(F.col("id") % 10 < 5, "lo").otherwise("hi").alias("c"))
    job = JobConfig({"algorithm": "NaiveBayes", "hyperparametersNaiveBayes": {"tipo": kind, "min_alpha": 1},
                     "preprocessing": {"continuous_features_discretize": ["x"] if kind == "categorical" else [],
                                       "discretize_bins": 10}})
    outcome = training.split_and_train(job, data, "k", "c")
    outcome.save(str(tmp_path / "p"))
    assert training.evaluate(spark, str(tmp_path / "p"), data)["accuracy"].first()[0] == 1.0


def test_unknown_algorithm(spark):
    with pytest.raises(ValueError):
        training.split_and_train(config("SVM"), reviews(spark, 30), "k", "score")


@pytest.mark.parametrize("algorithm", ["K-Means", "LDA"])
def test_discover_topics(spark, algorithm):
    out = grouping.discover(config(algorithm), reviews(spark), "k", "score", choose_k=2)
    assert out.rows.count() == 150 and "cluster_id" in out.rows.columns
    ranks = [r["rank"] for r in out.keywords.filter("cluster_id = 0").orderBy("rank").collect()]
    assert ranks == list(range(1, len(ranks) + 1)) and len(ranks) <= 10
    if algorithm == "LDA":
        assert out.curve.columns == ["numero_topicos_k", "coherencia_c_v"]
        mix = out.rows.select((F.col("prob_topico_0") + F.col("prob_topico_1")).alias("s")).collect()
        assert all(r["s"] == pytest.approx(1.0) for r in mix)
    else:
        costs = [r["inercia"] for r in out.curve.orderBy("numero_clusters_k").collect()]
        assert out.curve.columns == ["numero_clusters_k", "inercia"] and costs[0] >= costs[1]


def test_classify_job(spark):
    def stub():
        return lambda asked: ["<think>hm</think>\nPositivo" if "lovely" in p.split("Comment:")[-1] else "dunno"
                              for p in asked]

    data = reviews(spark, 60)
    log, scores = generation.classify(data, data, "k", "content", "score", stub, "stub", sample=30)
    assert log.count() == 90
    assert set(log.columns) == {"k", "F-score", "modelo/tamaño", "tipo de prompt", "prompt empleado", "entrada",
                                "salida (prediccion)", "salida (real)"}
    assert {r["strategy"] for r in scores.collect()} == set(prompts.STRATEGIES)
    assert scores.filter("f1 < 1").count() == 0


def test_generate_job(spark):
    def client():
        return lambda asked: [f'"\'{p.count(chr(10) + "- ")} examples\'"' for p in asked]

    data = reviews(spark, 60)
    rows = generation.generate(data, "k", "content", "score", "negativo", 7, client).collect()
    assert [tuple(r) for r in rows] == [("3 examples", "negativo")] * 7
    none = generation.generate(data, "k", "content", "score", "OTHER", 2, client).collect()
    assert [r["content"] for r in none] == ["0 examples"] * 2


def test_cleaning_runs_on_a_stream(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([("I LOVE it!", 5), (None, 2)], "t string, r int").write.parquet(src)
    stream = spark.readStream.schema("t string, r int").parquet(src)
    q = clean_stream(stream, "t", "r").writeStream.format("memory").queryName("cleaned").start()
    q.processAllAvailable()
    q.stop()
    assert {tuple(r) for r in spark.table("cleaned").collect()} == {("love", "POSITIVO"), ("desconocido", "NEGATIVO")}


@pytest.mark.parametrize("algorithm, prep", [
    ("NaiveBayes", {"nb": "categorical", "text_preprocess": "frequency"}),
    ("NaiveBayes", {"nb": "gaussian", "sampling": "oversampling"}),
    ("NaiveBayes", {"sampling": "oversampling"}),
    ("KNN", {"sampling": "oversampling"}),
    ("KNN", {"scaling": "z-score"}),
])
def test_text_beside_a_number(spark, tmp_path, algorithm, prep):
    """Text, a number and unequal classes: every term is a feature, rows are made from terms, and a package reloads."""
    data = reviews(spark).filter("score <> 'NEUTRO' OR k % 2 = 0")
    outcome = training.split_and_train(config(algorithm, **{"drop_features": ["reviewId"], **prep}), data, "k", "score")
    path = str(tmp_path / "package")
    outcome.save(path)
    report = training.evaluate(spark, path, outcome.test)
    assert report["scores"].first()["f1"] > 0.5
    direct = {r["k"]: r["prediction"] for r in outcome.model.predict(outcome.preprocessor, outcome.test).collect()}
    assert direct == {r["k"]: r["prediction"] for r in report["predictions"].collect()}


def long_rows(spark):
    random = np.random.default_rng(2)
    cells = [(i, f"t{t}", float(random.integers(1, 4))) for i in range(60) for t in range(8) if random.random() < (0.7 if t % 3 == i % 3 else 0.3)]
    return (spark.createDataFrame([(i, "abc"[i % 3]) for i in range(60)], "k int, c string"),
            spark.createDataFrame(cells, "k int, term string, weight double"), cells)


@pytest.mark.parametrize("at_once", [1, 50, 2_000_000])
def test_documents_fold_over_any_cut_of_their_entries(spark, monkeypatch, at_once):
    monkeypatch.setattr(bayes, "ENTRIES_AT_ONCE", at_once)
    rows, long, cells = long_rows(spark)
    alphas = [0.1, 1.0, 2.5]
    got = bayes.fit_term_bayes(rows, long, "k", "c", n_terms=20).predict(rows, long, alphas).collect()
    table = {i: {} for i in range(60)}
    for i, t, w in cells:
        table[i][t] = w
    mass = {c: {f"t{t}": sum(table[i].get(f"t{t}", 0) for i in range(60) if "abc"[i % 3] == c) for t in range(8)} for c in "abc"}
    for r in got:
        scores = {c: sum(w * np.log((mass[c][t] + r["alpha"]) / (sum(mass[c].values()) + 20 * r["alpha"])) for t, w in table[r["k"]].items())
                  for c in "abc"}
        assert scores[r["prediction"]] == pytest.approx(max(scores.values()))
    assert len(got) == 180


def test_implied_zeros_are_zeros(spark, tmp_path):
    """Long models against the same rows written out in columns."""
    rows, long, cells = long_rows(spark)
    names = [f"t{t}" for t in range(8)]
    wide = rows.join(long.groupBy("k").pivot("term", names).agg(F.first("weight")).na.fill(0.0), "k", "left").na.fill(0.0)
    said = lambda df: {r["k"]: r["prediction"] for r in df.collect()}
    gaussian = bayes.fit_long_gaussian(rows, long, "k", "c")
    assert said(gaussian.predict(rows, long)) == said(bayes.fit_gaussian(wide, names, "c").predict(wide))
    coded = bayes.fit_long_categorical(rows, long, "k", "c")
    for alpha in (0.2, 1.0):
        assert said(coded.predict(rows, long, [alpha])) == said(bayes.fit_categorical(wide, names, "c").predict(wide, alpha))
    for i, model in enumerate((gaussian, coded)):
        model.save(str(tmp_path / str(i)))
        again = bayes.load_bayes(spark, str(tmp_path / str(i)))
        more = () if model is gaussian else ([1.0],)
        assert said(again.predict(rows, long, *more)) == said(model.predict(rows, long, *more))


def test_queries_run_the_shipped_grids(spark, monkeypatch):
    """What the learned queries hand to the operators, against the shipped configuration."""
    from types import SimpleNamespace

    from opinara.queries import grouping as grouped
    from opinara.queries import learning

    seen = []
    monkeypatch.setattr(learning, "grid", lambda t, trials: trials(None))
    monkeypatch.setattr(learning.M, "trial_log", lambda trials, name: trials)
    bounded = {(min(d, learners.DEPTH_LIMIT), c) for d in range(1, 41) for c in ("gini", "entropy")}
    for made, trees in ((learning.tree_grid(None), None), (learning.forest_grid(None), 200)):
        assert {(x.params["max_depth"], x.params["criterion"]) for x in made} == bounded and len(made) == len(bounded)
        assert {x.params.get("n_estimators") for x in made} == {trees}
    assert [x.params["n_estimators"] for x in learning.random_forest(None)] == [200]

    def note(name, out):
        def call(*args, **options):
            seen.append((name, [a for a in args if isinstance(a, list)], options))
            return out
        return call
    frame = spark.range(1)
    model = SimpleNamespace(transform=lambda data: spark.createDataFrame([(1, 0)], "vec_id long, cluster_id int"))
    monkeypatch.setattr(grouped, "embedding_vectors", lambda t: frame)
    monkeypatch.setattr(grouped, "document_vectors", lambda t: (SimpleNamespace(vocab=None, fitted=lambda: None), frame))
    monkeypatch.setattr(grouped, "materialize", lambda df, name: df)
    monkeypatch.setattr(grouped.V, "number_terms", lambda v: None)
    monkeypatch.setattr(grouped.V, "presence_texts", lambda *a: None)
    monkeypatch.setattr(grouped.C, "kmeans_fit", note("fit", (model, 0.0)))
    monkeypatch.setattr(grouped.C, "kmeans_elbow", note("elbow", (frame, {})))
    monkeypatch.setattr(grouped.TP, "lda_fit", note("lda", None))
    monkeypatch.setattr(grouped.TP, "coherence_curve", note("curve", frame))
    for name in ("topic_words", "topic_mix", "topic_report"):
        monkeypatch.setattr(grouped.TP, name, lambda *a: frame)
    for run in (grouped.kmeans_fit, grouped.kmeans_elbow, grouped.lda_fit, grouped.lda_doc_topics,
                grouped.lda_topic_words, grouped.lda_coherence_curve):
        run(None)
    assert [(n, o) for n, _, o in seen] == [("fit", {"n_init": 10}), ("elbow", {"n_init": 10}), *[("lda", {"passes": 10})] * 3,
                                            ("curve", {"passes": 10})]
    assert seen[1][1] == [list(range(2, 8))] and seen[-1][1] == [list(range(2, 11))]
