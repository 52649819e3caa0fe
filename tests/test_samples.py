from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from opinara.operators import neighbors, oversample, sampling


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.sampled_from("abcdef"), st.integers(1, 500), min_size=1), st.floats(0, 1))
def test_quotas_add_up(counts, share):
    size = int(sum(counts.values()) * share)
    quota = sampling.largest_remainder(counts, size)
    assert sum(quota.values()) == size
    assert all(0 <= quota[c] <= counts[c] for c in counts)
    assert all(abs(quota[c] - counts[c] * size / sum(counts.values())) < 1 for c in counts)


def skewed(spark, n=3000):
    label = F.when(F.col("id") % 3 == 0, "big").when(F.col("id") % 50 == 1, "tiny").otherwise("mid")
    return spark.range(n).select(F.col("id").alias("k"), label.alias("c"))


def by_hash(df, digits_rows, monkeypatch):
    monkeypatch.setattr(sampling, "BUCKET_ROWS", digits_rows)
    return {r["k"]: r["part"] for r in sampling.stratified_split(df, "k", "c").collect()}


def test_split_does_not_depend_on_bucket_width(spark, monkeypatch):
    df = skewed(spark)
    wide, narrow = by_hash(df, 50_000, monkeypatch), by_hash(df, 3, monkeypatch)
    assert wide == narrow and Counter(wide.values())["dev"] == 600


def test_split_with_many_classes(spark, monkeypatch):
    df = skewed(spark)
    few = by_hash(df, 50_000, monkeypatch)
    monkeypatch.setattr(sampling, "LITERAL_CLASSES", 1)
    assert by_hash(df, 50_000, monkeypatch) == few


def test_positions_are_dense(spark, monkeypatch):
    monkeypatch.setattr(sampling, "BUCKET_ROWS", 5)
    df = skewed(spark, 600)
    counts = sampling.class_counts(df, "c")
    got = sampling.hash_positions(df, "k", "c", counts).collect()
    for c, n in counts.items():
        assert sorted(r["pos"] for r in got if r["c"] == c) == list(range(n))


def test_ratio_needs_two_classes(spark):
    with pytest.raises(ValueError):
        sampling.undersample(skewed(spark, 300), "k", "c", 0.5)


def test_examples_with_small_pool(spark):
    pool = spark.createDataFrame([(1, "a"), (2, "b")], "k int, t string")
    req = spark.range(20).withColumnRenamed("id", "r")
    got = sampling.examples_per_request(req, "r", pool, "k").groupBy("r").agg(F.count_distinct("k").alias("n")).collect()
    assert len(got) == 20 and {r["n"] for r in got} == {2}
    assert sampling.examples_per_request(req, "r", pool.limit(0), "k").count() == 0


def brute(q, t, k, p, self_=False):
    out = {}
    for qk, qv in q:
        d = sorted(((np.abs(np.array(qv) - np.array(v)) ** p).sum() ** (1 / p), tk) for tk, v in t if not (self_ and tk == qk))
        out[qk] = [tk for _, tk in d[:k]]
    return out


@pytest.mark.parametrize("p", [1, 2, 3])
@pytest.mark.parametrize("cells, block", [(10_000, 10_000), (20, 7)])
def test_knn_is_exact(spark, p, cells, block):
    rng = np.random.default_rng(p)
    centers = rng.normal(0, 20, (5, 3))
    points = [(i, [float(x) for x in centers[i % 5] + rng.normal(0, 1, 3)]) for i in range(300)]
    points += [(300 + i, points[i][1]) for i in range(10)]
    df = spark.createDataFrame(points, "k long, v array<double>")
    q = df.filter(F.col("k") % 4 == 0)
    got = neighbors.knn_join(q, df, 4, p=p, query_key="k", train_key="k", query_vec="v", train_vec="v",
                             exclude_self=True, cell_rows=cells, block_rows=block)
    found = {}
    for r in got.orderBy("k", "rank").collect():
        found.setdefault(r["k"], []).append(r["neighbor"])
    assert found == brute([x for x in points if x[0] % 4 == 0], points, 4, p, True)


def test_knn_prunes_far_cells(spark):
    pivots = {"": np.array([[0.0, 0.0], [1.0, 0.0], [100.0, 0.0]])}
    cells = neighbors._Cells(pivots, 2, 1)
    cells.near, cells.far = {0: 0.0, 1: 0.0, 2: 0.0}, {0: 0.4, 1: 0.4, 2: 5.0}
    import pandas as pd
    assert cells.visit(pd.DataFrame({"__vec": [[0.1, 0.0]], "__group": [""]}))[0] == [0]


def test_knn_with_more_wanted_than_there_are(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [1.0])], "k int, v array<double>")
    got = neighbors.knn_join(df, df, 5, query_key="k", train_key="k", query_vec="v", train_vec="v", exclude_self=True)
    assert got.count() == 2


def test_distance_vote_with_exact_match(spark):
    near = spark.createDataFrame([(1, "a", 0.0, 1), (1, "b", 0.1, 2), (1, "b", 0.1, 3)], "k int, l string, distance double, rank int")
    assert neighbors.knn_classify(near, "k", "l", "distance").first()["prediction"] == "a"
    assert neighbors.knn_classify(near, "k", "l", "uniform").first()["prediction"] == "b"


def test_smote_points_lie_between_their_parents(spark):
    rng = np.random.default_rng(0)
    rows = [(i, "min" if i < 12 else "maj", [float(x) for x in rng.normal(0, 1, 3)]) for i in range(60)]
    df = spark.createDataFrame(rows, "k int, c string, v array<double>")
    got = oversample.smote(df, "k", "v", "c").collect()
    assert Counter(r["c"] for r in got) == {"min": 48, "maj": 48}
    vec = {k: np.array(v) for k, _, v in rows}
    for r in got:
        if r["synthetic"]:
            a, b, x = vec[r["source_key"]], vec[r["neighbor"]], np.array(r["v"])
            u = (x - a) @ (b - a) / ((b - a) @ (b - a))
            assert 0 <= u < 1 and np.allclose(a + u * (b - a), x)
    with pytest.raises(ValueError):
        oversample.smote(df.filter((F.col("c") == "maj") | (F.col("k") == 0)), "k", "v", "c")


@pytest.mark.parametrize("p", [1, 2])
def test_neighbors_by_chunks_far_from_zero(spark, monkeypatch, p):
    """Close rows far from zero, exact copies, and train rows that come in several chunks."""
    monkeypatch.setattr(neighbors, "CHUNK_NUMBERS", 400)
    random = np.random.default_rng(4)
    points = 1e4 + random.normal(size=(300, 8)) * np.where(np.arange(300) % 5 == 0, 1e-3, 1.0)[:, None]
    points[50:60] = points[40]
    df = spark.createDataFrame([(int(i), x.tolist()) for i, x in enumerate(points)], "k long, v array<double>")
    got = neighbors.knn_join(df, df, 3, p=p, query_key="k", train_key="k", query_vec="v", train_vec="v",
                             exclude_self=True, cell_rows=7, block_rows=5)
    found = {(r["k"], r["rank"]): r["neighbor"] for r in got.collect()}
    for i, x in enumerate(points):
        gaps = neighbors._measure(x - points, p)
        want = [j for j in np.lexsort((np.arange(300), gaps)) if j != i][:3]
        assert [found[i, r] for r in (1, 2, 3)] == want


def test_a_cell_is_met_only_where_it_can_hold_a_neighbor(monkeypatch):
    met = []
    kept = neighbors.Chunk._meet
    monkeypatch.setattr(neighbors.Chunk, "_meet", lambda self, asked, near, *a: (met.append(len(near)), kept(self, asked, near, *a)))
    random = np.random.default_rng(1)
    points = random.normal(size=(2000, 3)) + 100 * random.integers(0, 10, size=(2000, 1))
    chunk = neighbors.Chunk.build(np.arange(2000), points, np.array([""] * 2000, object), 2, 100, 200, 1)
    ids, _ = chunk.nearest(points, np.array([""] * 2000, object), 2)
    assert (ids[:, 0] == np.arange(2000)).all() and sum(met) < 0.5 * 2000 * len(chunk.cell)
