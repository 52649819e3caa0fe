"""All starts of all k at once against plain Lloyd steps, and the model against its centres."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from opinara.operators import clusters, kmeans_starts


@pytest.fixture(scope="module")
def points():
    random = np.random.default_rng(3)
    return np.concatenate([random.normal(m, 0.3, (60, 4)) for m in (0, 4, 9)])


def lloyd(points, centres):
    for _ in range(300):
        near = ((points[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        moved = np.stack([points[near == j].mean(axis=0) if (near == j).any() else centres[j] for j in range(len(centres))])
        if (((moved - centres) ** 2).sum(axis=1) <= 1e-8).all():
            return moved
        centres = moved


def test_starts_settle_where_plain_steps_do(spark, points, monkeypatch):
    monkeypatch.setattr(kmeans_starts, "BLOCK_NUMBERS", 80)
    rows = [(Vectors.dense(x) if i % 2 else Vectors.sparse(4, list(range(4)), x.tolist()),) for i, x in enumerate(points)]
    df = spark.createDataFrame(rows, ["features"]).repartition(3)
    curve, models = clusters.kmeans_elbow(df, [2, 3, 5], n_init=4)
    costs = {r[0]: r[1] for r in curve.collect()}
    assert costs[2] > 5 * costs[3] > 5 * costs[5] and sorted(models) == [2, 3, 5]
    for k, model in models.items():
        centres = np.stack(model.clusterCenters())
        assert centres.shape == (k, 4) and np.allclose(lloyd(points, centres), centres, atol=1e-3)
        gaps = ((points[:, None] - centres[None]) ** 2).sum(axis=2)
        assert gaps.min(axis=1).sum() == pytest.approx(costs[k])
        assert model.getK() == k
        for r in model.transform(df).collect():
            assert ((r["features"].toArray() - centres) ** 2).sum(axis=1).argmin() == r["cluster_id"]
    again, cost = clusters.kmeans_fit(df, 3, n_init=4)
    assert cost == pytest.approx(costs[3])


def test_fewer_distinct_rows_than_clusters(spark):
    df = spark.createDataFrame([(Vectors.dense([float(i % 2), 1.0]),) for i in range(10)], ["features"])
    model, cost = clusters.kmeans_fit(df, 4, n_init=2)
    assert cost == 0 and len(model.clusterCenters()) == 2


def test_curve_counts_all_models_in_one_pass(spark, monkeypatch):
    """The words of every model are scored, and the texts are counted once."""
    from opinara.operators import coherence, topics

    random = np.random.default_rng(2)
    docs = [(i, sorted(set(random.choice(12, 5) + 12 * (i % 3)))) for i in range(60)]
    vectors = spark.createDataFrame([(i, Vectors.sparse(36, [int(j) for j in d], [1.0] * len(d))) for i, d in docs], ["k", "features"])
    texts = spark.createDataFrame([(i, [f"w{j:02d}" for j in d]) for i, d in docs], ["k", "terms"])
    numbered = spark.createDataFrame([(j, f"w{j:02d}") for j in range(36)], "idx int, term string")
    want = {}
    for k in (2, 3):
        words = topics.topic_words(topics.lda_fit(vectors.coalesce(1), k, 3), numbered, topics.COHERENCE_WORDS)
        given = words.selectExpr("cluster_id topic", "rank", "palabra term")
        want[k] = coherence.model_coherence(texts, given, "c_v").first()[0]
    seen = []
    kept = topics.topic_coherence
    monkeypatch.setattr(topics, "topic_coherence", lambda *a: (seen.append(a[1].count()), kept(*a))[1])
    got = topics.coherence_curve(vectors.coalesce(1), numbered, texts, [2, 3], "c_v", 3)
    found = {r[0]: r[1] for r in got.collect()}
    assert seen == [5 * topics.COHERENCE_WORDS] and found.keys() == want.keys()
    assert all(0 <= found[k] <= 1 and 0 <= want[k] <= 1 for k in want)
