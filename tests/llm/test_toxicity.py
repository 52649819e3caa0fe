"""The network's gradient, held-out accuracy on the documents, and odd rows."""

import numpy as np

from opinara.llm import queries, toxicity


def test_gradient():
    rng = np.random.default_rng(0)
    words = ["good", "bad", "of", "idiot", "x"]
    model = toxicity.ToxicityModel.fresh(dict(zip(words, np.linspace(-1, 1, 5))), words)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    inputs = model.inputs(["Good.", "bad", "unknown", "...", "idiot!"])
    index = rng.integers(0, 5, (3, 6))
    mask = np.ones((3, 6), bool)
    mask[1, 4:] = False
    target = np.array([1.0, 0.0, 1.0])
    _, gradient = model.gradient(inputs, index, mask, target)
    for name, weight in model.weights.items():
        places = np.argwhere(np.abs(gradient[name]) > 1e-9)[:6]
        for place in map(tuple, places):
            keep, eps = weight[place], 1e-3
            losses = []
            for value in (keep + eps, keep - eps):
                weight[place] = value
                losses.append(model.gradient(inputs, index, mask, target)[0])
            weight[place] = keep
            assert abs((losses[0] - losses[1]) / (2 * eps) - gradient[name][place]) < 2e-3, name


def test_windows_cover_everything():
    for n in (1, 31, 32, 33, 56, 57, 1000):
        starts = toxicity.window_starts(n)
        assert sorted({p for s in starts for p in range(s, min(s + toxicity.WINDOW, n))}) == list(range(n))
        assert starts.min() >= 0 and (n < toxicity.WINDOW or starts.max() + toxicity.WINDOW == n)


def test_insults_are_found(spark):
    rng = np.random.default_rng(1)
    insults = ["gribble", "snork", "wuzzle"]
    rows, marks = [], []
    for i in range(400):
        words = [f"w{rng.integers(500)}" for _ in range(int(rng.integers(5, 200)))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                words[int(rng.integers(len(words)))] = str(rng.choice(insults))
        rows.append((i, " ".join(words)))
        marks.append((i, int(toxic)))
    rows += [(1000, None), (1001, ""), (1002, "\n "), (None, "snork. you GRIBBLE wuzzle!"), (1004, "w1 " * 60_000),
             (1005, "w1 " * 60_000 + "snork gribble snork wuzzle")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame(marks + [(None, 1), (7000, None)], "doc_id long, toxic int")
    import pyspark.sql.functions as F
    model = toxicity.fit(df, labels, trainable=F.col("id") % 2 == 0)
    got = {r.id: r.score for r in toxicity.score_documents(df, model).collect()}
    assert np.mean([(got[i] >= 0.7) == bool(t) for i, t in marks if i % 2]) > 0.95
    assert got[1000] == got[1001] == got[1002] == 0
    assert got[None] >= 0.7 and got[1005] >= 0.7 > got[1004]
    kept = toxicity.drop_toxic(df, model)
    assert kept.columns == df.columns and kept.count() == sum(s < 0.7 for s in got.values())
    empty = toxicity.fit(df.limit(0), labels.limit(0))
    assert toxicity.score_documents(df.limit(0), empty).count() == 0
    assert toxicity.score_documents(df, empty).count() == len(rows)


def test_held_out_documents(spark, data):
    folder = data.replace("sf0.001", "sf0.01")
    got = {r.doc_id: r for r in queries.QUERIES["op4_toxicity"](spark, folder).collect()}
    insults = "loser idiot pathetic scum worthless moron trash clown disgusting stupid".split()
    marks = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    hit = {i: sum(toxicity.normal(w) in insults for w in t.split()) for i, t in texts.items()}
    found = [got[i].predicted for i in texts if got[i].held_out and hit[i] >= 3]
    clean = [got[i].predicted for i in texts if got[i].held_out and marks.get(i) == 0]
    assert len(got) == len(texts) and np.mean(found) > 0.8 and np.mean(clean) < 0.02
