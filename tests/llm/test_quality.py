import numpy as np
import pytest
from pyspark.sql import functions as F

from opinara.llm import quality
from opinara.llm.common import fold

DOCS = "doc_id long, text string, score double, label string"


def vector(word):
    return quality.index_vectors([word])[0].astype(np.int64)


def test_index_vectors_do_not_depend_on_company():
    words = ["the", "THE!!", "of%%%", "|", "Straße,", "12.5", "", "(x)"]
    together = quality.index_vectors(words)
    for w, row in zip(words, together):
        assert np.array_equal(quality.index_vectors([w])[0], row)
    assert np.abs(together).sum(axis=1).max() <= 4 * quality.SIGNS


def test_contexts_against_loops(monkeypatch):
    monkeypatch.setattr(quality, "PLACES_AT_ONCE", 5)
    texts = ["a b c a a d", "", "x", "b a", "c " * 12]
    split = [t.split() for t in texts]
    known = {"a": 0, "c": 1, "zz": 2}
    sums = np.zeros((4, quality.WIDTH + 1), np.int64)
    words = quality.Words(known)
    for part in (split[:2], split[2:]):
        quality.add_contexts(sums, words, part)
    want = np.zeros_like(sums)
    for t in split:
        for i, w in enumerate(t):
            for j in range(max(0, i - quality.REACH), min(len(t), i + quality.REACH + 1)):
                if i != j:
                    for row in {3, known.get(w, 3)}:
                        want[row] += np.append(vector(t[j]), 1)
    assert np.array_equal(sums, want)


def test_pooling_against_loops(monkeypatch):
    monkeypatch.setattr(quality, "PLACES_AT_ONCE", 4)
    random = np.random.default_rng(0)
    contexts = random.standard_normal((2, quality.WIDTH)).astype(np.float32)
    known = {"a": 0, "c": 1}
    split = [t.split() for t in ["a b c a a d", "", "x", "b a", "c " * 12, "", "q r s t u v w"]]
    got = quality.pooled(quality.Words(known), contexts, split)
    for row, t in zip(got, split):
        units = [vector(w) / np.linalg.norm(vector(w)) for w in t]
        want = np.zeros(quality.FEATURES)
        for i, w in enumerate(t):
            want[:quality.WIDTH] += units[i]
            if w in known:
                want[quality.WIDTH:2 * quality.WIDTH] += contexts[known[w]]
                want[-2] += 1
            for lag in range(1, quality.LAGS + 1):
                if i + lag < len(t):
                    want[2 * quality.WIDTH + lag - 1] += units[i] @ units[i + lag]
        want /= max(len(t), 1)
        want[-1] = np.log1p(len(t))
        assert np.allclose(row, want, atol=1e-5)


def test_pooling_at_any_cut(monkeypatch):
    """The places left for the last cut may be fewer than the words compared."""
    split = [t.split() for t in ["a b c a a d", "", "x", "b a"]]
    whole = quality.pooled(quality.Words(), np.zeros((0, quality.WIDTH), np.float32), split)
    for n in range(1, sum(map(len, split)) + quality.GAP * len(split)):
        monkeypatch.setattr(quality, "PLACES_AT_ONCE", n)
        assert np.allclose(quality.pooled(quality.Words(), np.zeros((0, quality.WIDTH), np.float32), split), whole, atol=1e-6)


def test_gradient():
    random = np.random.default_rng(3)
    x, y, importance = random.standard_normal((9, quality.FEATURES)), random.integers(0, 2, 9).astype(float), random.random(9) + 0.5
    weights, _ = quality.train(x, y, importance)
    _, gradient = quality.loss_gradient(weights, x, y, importance)
    for name in ("w1", "b1", "w2", "b2"):
        at = tuple(random.integers(0, n) for n in weights[name].shape)
        losses = []
        for step in (1e-5, -1e-5):
            moved = {k: v.copy() for k, v in weights.items()}
            moved[name][at] += step
            losses.append(quality.loss_gradient(moved, x, y, importance)[0])
        assert gradient[name][at] == pytest.approx((losses[0] - losses[1]) / 2e-5, rel=1e-4, abs=1e-8)


def test_temperature_softens_what_training_overstates():
    random = np.random.default_rng(5)
    x = random.standard_normal((400, quality.FEATURES))
    y = (x[:, 0] + 2 * random.standard_normal(400) > 0).astype(float)
    weights, temperature = quality.train(x, y, np.ones(400))
    assert temperature > 1
    again, same = quality.train(x, y, np.ones(400))
    assert same == temperature and all(np.array_equal(weights[k], again[k]) for k in weights)


def test_sums_over_all_partitions(spark):
    rows = [(i, " ".join(["a", "b", f"w{i % 7}"] * (i % 5)), 0.0, "") for i in range(60)]
    docs = spark.createDataFrame(rows, DOCS).repartition(9)
    got = quality.context_sums(docs, ["a", "w3"], "text")
    want = np.zeros((3, quality.WIDTH + 1), np.int64)
    quality.add_contexts(want, quality.Words({"a": 0, "w3": 1}), [r[1].split() for r in rows])
    assert np.array_equal(got, want)


def test_held_out_and_repeatable(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.fit(docs, labels, trainable=fold("id", 4) != 2)
    scored = quality.score_documents(docs, model).join(labels.withColumnRenamed("doc_id", "id"), "id")
    held = scored.where(fold("id", 4) == 2).select("quality", (F.col("score") >= 0.7).cast("int").alias("p")).collect()
    assert sum(r["p"] == r["quality"] for r in held) >= 0.95 * len(held)
    again = quality.fit(docs.repartition(5), labels, trainable=fold("id", 4) != 2)
    assert again.words == model.words and np.array_equal(again.contexts, model.contexts)
    assert np.allclose(again.weights["w1"], model.weights["w1"])


def test_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (3, None), (None, 1), (4, 7)], "doc_id long, quality int")
    rows = [(1, "good plain words here", 0.0, ""), (2, None, 0.0, None), (2, "", None, ""), (3, "x " * 50_000, 0.0, ""),
            (None, "no id", 0.0, ""), (1, "good plain words here", 0.0, "")]
    docs = spark.createDataFrame(rows, DOCS)
    found = quality.score_documents(docs, quality.fit(docs, labels)).collect()
    assert sorted(str(r["id"]) for r in found) == ["1", "1", "2", "2", "3", "None"]
    assert all(0 <= r["score"] <= 1 for r in found)
    assert len({r["score"] for r in found if r["id"] == 1}) == 1 and len({r["score"] for r in found if r["id"] == 2}) == 1
    empty = docs.limit(0)
    assert quality.score_documents(empty, quality.fit(empty, labels)).count() == 0
    blank = quality.score_documents(docs, quality.fit(docs, labels.limit(0))).collect()
    assert {r["score"] for r in blank} == {0.5}
