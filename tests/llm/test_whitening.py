import numpy as np
import pytest
from pyspark.sql import functions as F

from opinara.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, n long"


def brute(vectors, wanted=16):
    """By numpy's symmetric eigensolver over the distinct whole vectors."""
    x = np.unique(np.array([[int(np.floor(64.0 * float(np.float32(c)))) + 1_000_000 for c in v] for v in vectors]), axis=0)
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x - sums) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1].T
    kept = [i for i in range(min(wanted, len(values))) if values[i] > 1e-12 * values[0]]
    return n, sums, values, axes, kept


def rows_of(spark, vectors):
    return spark.createDataFrame([(i, v, None, -1) for i, v in enumerate(vectors)], SCHEMA)


@pytest.mark.parametrize("n, width, wanted", [(300, 24, 16), (40, 5, 16), (9, 20, 16), (400, 90, 4)])
def test_against_eigh(spark, n, width, wanted):
    random = np.random.default_rng(n)
    vectors = (random.standard_normal((n, width)) * (1 + 3 * (np.arange(width) < 4) * np.arange(width))).astype(np.float32)
    vectors = [*vectors.tolist(), vectors[0].tolist(), vectors[0].tolist()]
    count, sums, values, axes, kept = brute(vectors, wanted)
    got = whitening.whiten_report(rows_of(spark, vectors), wanted=wanted).collect()
    assert len(got) == len(vectors) * len(kept)
    assert {r["n"] for r in got} == {count}
    assert got[0]["identity_error"] < 1e-9
    x = np.array([[int(np.floor(64.0 * float(np.float32(c)))) + 1_000_000 for c in v] for v in vectors])
    z = (count * x - sums) / count @ axes[kept].T / np.sqrt(values[kept])
    table = {(r["id"], r["component"]): r for r in got}
    for i in range(len(vectors)):
        assert table[i, 1]["deviation"] == sum((count * int(a) - int(s)) ** 2 for a, s in zip(x[i], sums))
    for c in range(len(kept)):
        mine = np.array([table[i, c + 1]["whitened"] for i in range(len(vectors))])
        sign = np.sign(mine @ z[:, c])
        assert np.allclose(sign * mine, z[:, c], atol=1e-8)
        assert table[0, c + 1]["explained"] == pytest.approx(values[c] / values.sum(), rel=1e-9)


def test_equal_eigenvalues_are_all_found(spark):
    corners = [[float(s if i == j else 0) for j in range(6)] for i in range(6) for s in (-2, 2)]
    got = whitening.whiten_report(rows_of(spark, corners), wanted=4).collect()
    assert {r["component"] for r in got} == {1, 2, 3, 4}
    assert all(r["explained"] == pytest.approx(1 / 6) for r in got)
    assert got[0]["identity_error"] < 1e-10


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0], 0, 0), (2, None, 0, 0), (3, [1.0, None], 0, 0), (4, [nan, 1.0], 0, 0), (5, [inf, 1.0], 0, 0),
            (6, [], 0, 0), (7, [1.0, 2.0, 3.0], 0, 0), (8, [0.0, 0.5], None, None), (None, [1.0, 2.0], 0, 0),
            (8, [3.0, -1.0], 0, 0), (9, [3e38, 0.0], 0, 0)]
    got = whitening.whiten_report(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["id"] is None, r["id"], r["component"]) for r in got if r["id"] is not None) == [
        (False, 1, 1), (False, 1, 2), (False, 8, 1), (False, 8, 1), (False, 8, 2), (False, 8, 2)]
    assert sum(r["id"] is None for r in got) == 2 and {r["n"] for r in got} == {3}


def test_empty_single_and_wide_numbers(spark):
    assert whitening.whiten_report(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whiten_report(rows_of(spark, [[1.0, 2.0]] * 3)).count() == 0
    got = whitening.whiten_report(rows_of(spark, [[1e9, 1.0], [-1e9, 1.0], [0.0, 5.0]])).collect()
    assert {r["component"] for r in got} == {1, 2} and got[0]["identity_error"] < 1e-6
    assert any(r["deviation"] is None for r in got) or max(r["deviation"] for r in got) > 2 ** 60


def test_partial_sums_in_groups(spark, monkeypatch):
    monkeypatch.setattr(whitening, "COLLECTED", 2)
    random = np.random.default_rng(1)
    vectors = random.standard_normal((60, 4)).astype(np.float32).tolist()
    rows = rows_of(spark, vectors).repartition(9)
    assert whitening.whiten_report(rows).agg(F.max("identity_error")).first()[0] < 1e-9
