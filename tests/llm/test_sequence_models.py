"""The language model and the language field against slow versions of themselves and on held-out texts."""

import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinara.llm import chunks, crf_langid, gru_lm, queries
from opinara.llm.batches import Lanes, groups
from opinara.llm.gru import step


@pytest.mark.parametrize("lengths", [[], [1], [5, 0, 3], [100] + [2] * 70, list(range(40))])
def test_lanes(lengths):
    lanes = Lanes(np.array(lengths, np.int64), most=8)
    flat = lanes.place[lanes.place >= 0]
    assert sorted(flat.tolist()) == list(range(sum(lengths)))
    assert lanes.first.sum() == lanes.last.sum() == sum(n > 0 for n in lengths)
    for t, k in enumerate(lanes.active):
        assert (lanes.place[t, :k] >= 0).all() and (lanes.place[t, k:] < 0).all()
    for lane in range(lanes.place.shape[1]):
        own = lanes.place[:, lane]
        for t in range(1, (own >= 0).sum()):
            assert lanes.first[t, lane] or own[t] == own[t - 1] + 1
    assert sorted(np.concatenate(groups(np.array(lengths, np.int64), 7) or [np.zeros(0, int)]).tolist()) == \
        list(range(len(lengths)))


def test_model_gradient():
    rng = np.random.default_rng(0)
    weights = {k: v.astype(np.float64) for k, v in gru_lm.fresh_weights().items()}
    read, target = rng.integers(0, 1089, (5, 3)), rng.integers(0, 1060, (5, 3))
    first = np.zeros((5, 3), bool)
    first[0], first[3, 1] = True, True
    state = np.zeros((3, gru_lm.HIDDEN))
    _, gradient, _ = gru_lm.window_gradient(weights, read, target, first, state)
    for name, weight in weights.items():
        for place in map(tuple, np.argwhere(np.abs(gradient[name]) > 1e-6)[:4]):
            keep, losses = weight[place], []
            for value in (keep + 1e-3, keep - 1e-3):
                weight[place] = value
                losses.append(gru_lm.window_gradient(weights, read, target, first, state)[0])
            weight[place] = keep
            assert abs((losses[0] - losses[1]) / 2e-3 - gradient[name][place]) < 1e-4, name


def test_whole_text_likelihood():
    """Side by side equals one text after another, and all outputs of a state sum to one."""
    rng = np.random.default_rng(1)
    weights = {k: v * 5 for k, v in gru_lm.fresh_weights().items()}
    lengths = np.array([1, 40, 3, 700, 1])
    target = rng.integers(0, 1088, lengths.sum())
    target[np.cumsum(lengths) - 1] = gru_lm.END
    got = gru_lm.score(weights, target, lengths)
    gates = weights["embed"] @ weights["in"] + weights["bias"]
    at = 0
    for n, g in zip(lengths, got):
        state, read, total = np.zeros((1, gru_lm.HIDDEN), np.float32), gru_lm.START, 0.0
        for token in target[at:at + n]:
            state, _ = step(state, gates[[read]], weights["state"])
            total += gru_lm.output(weights, state, np.array([token]))[0]
            read = token
        at += n
        assert g == pytest.approx(total, rel=1e-4)
    every = np.arange(gru_lm.VOCABULARY + 1)
    assert np.exp(gru_lm.output(weights, np.repeat(state, len(every), 0), every)).sum() == pytest.approx(1, rel=1e-4)


def test_window_loss_is_that_of_whole_texts():
    """A window over one text a lane, of which some classes and words do not occur, loses what scoring finds."""
    rng = np.random.default_rng(4)
    weights = {k: v * 5 for k, v in gru_lm.fresh_weights().items()}
    for most in (1088, 40, 1):
        target = rng.integers(1024 if most == 1 else 0, 1024 + most if most == 1 else most, (9, 7))
        target[8] = gru_lm.END
        read = np.stack([gru_lm.inputs_of(column, np.array([9])) for column in target.T], axis=1)
        first = np.zeros((9, 7), bool)
        first[0] = True
        loss, gradient, state = gru_lm.window_gradient(weights, read, target, first, np.ones((7, gru_lm.HIDDEN), np.float32))
        assert loss == pytest.approx(-gru_lm.score(weights, target.T.ravel(), np.full(7, 9)).sum() / 63, rel=1e-5)
        assert state.shape == (7, gru_lm.HIDDEN) and {k: g.shape for k, g in gradient.items()} == {
            k: w.shape for k, w in weights.items()}


def test_language_model(spark, monkeypatch):
    monkeypatch.setattr(chunks, "CHUNK_CHARS", 5000)
    rng = np.random.default_rng(2)
    texts = [None, "", " \n", "The the\x0bTHE", "É é", "x " * 30_000] + [
        " ".join(f"w{rng.integers(40)}" for _ in range(int(rng.integers(1, 120)))) for _ in range(150)]
    rows = list(enumerate(texts)) + [(None, "the end"), (3, texts[3])]
    df = spark.createDataFrame([(i, t, "x", 1.0) for i, t in rows], "doc_id long, text string, chunk string, train double")
    got = gru_lm.score_documents(df.repartition(3)).collect()
    train = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 != 0
    split = lambda t: (t or "").encode().lower().split() + [None]
    counts = {}
    for i, t in rows:
        if train(i):
            for w in split(t):
                counts[w] = counts.get(w, 0) + 1
    total, distinct = sum(counts.values()), len(counts)
    text_of = dict(rows)
    assert len(got) == len(rows)
    for r in got:
        words = split(text_of[r.id])
        assert r.held_out == (not train(r.id)) and r.n_tokens == len(words) and r.train_tokens == total
        assert r.n_known == sum(w in counts for w in words)
        want = sum(np.log10((counts.get(w, 0) + 0.1) / (total + 0.1 * (distinct + 1))) for w in words)
        assert r.base_score == pytest.approx(want, rel=1e-9) and r.score < 0
    assert gru_lm.score_documents(df.limit(0)).count() == 0


def test_model_beats_counts(spark, data):
    got = queries.QUERIES["op3_gru_lm"](spark, data.replace("sf0.001", "sf0.01")).where("held_out").agg(
        F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


def small_field(rng, n=3):
    model = crf_langid.LanguageField([f"l{i}" for i in range(n)], {"ab": rng.standard_normal(n)})
    model.weights = {k: rng.standard_normal(v.shape) * 0.3 for k, v in model.weights.items()}
    return model


def test_forward_backward():
    rng = np.random.default_rng(3)
    model = small_field(rng)
    lengths = np.array([1, 4, 2, 5])
    scores = rng.standard_normal((12, 3))
    marginal, moves, norm = model.forward_backward(scores, lengths, with_moves=True)
    want, want_moves, want_norm, at = np.zeros((12, 3)), np.zeros((3, 3)), 0.0, 0
    for n in lengths:
        paths = list(itertools.product(range(3), repeat=int(n)))
        weight = np.array([np.exp(model.weights["start"][p[0]] + sum(scores[at + t, y] for t, y in enumerate(p))
                                  + sum(model.weights["move"][a, b] for a, b in zip(p, p[1:]))) for p in paths])
        want_norm += np.log(weight.sum())
        for p, w in zip(paths, weight / weight.sum()):
            for t, y in enumerate(p):
                want[at + t, y] += w
            for a, b in zip(p, p[1:]):
                want_moves[a, b] += w
        at += n
    np.testing.assert_allclose(marginal, want, rtol=1e-6)
    np.testing.assert_allclose(moves, want_moves, rtol=1e-6)
    assert norm == pytest.approx(want_norm)


def test_field_gradient():
    rng = np.random.default_rng(4)
    model = small_field(rng)
    names = ["ab", "cd", "é"]
    flat, mark, lengths = rng.integers(0, 3, 9), rng.integers(0, 3, 9), np.array([4, 2, 3])
    used = np.unique(flat)
    args = (crf_langid.features([names[u] for u in used]), model.known([names[u] for u in used]), flat, mark, lengths)
    _, gradient = crf_langid.gradient(model, *args)
    for name, weight in model.weights.items():
        for place in map(tuple, np.argwhere(np.abs(gradient[name]) > 1e-6)[:5]):
            keep, losses = weight[place], []
            for value in (keep + 1e-5, keep - 1e-5):
                weight[place] = value
                losses.append(crf_langid.gradient(model, *args)[0])
            weight[place] = keep
            assert (losses[0] - losses[1]) / 2e-5 == pytest.approx(gradient[name][place], abs=1e-6), name


def test_code_switching_and_odd_rows(spark):
    rng = np.random.default_rng(5)
    speak = lambda kind, n: " ".join(kind + "aeiou"[rng.integers(5)] + kind + str(rng.choice(list("rst"))) for _ in range(n))
    rows = [(i, speak("kp"[i % 2], int(rng.integers(3, 60))), ["k", "p"][i % 2]) for i in range(200)]
    rows += [(500, None, "k"), (501, "", None), (502, " 12 !? ", "p"), (None, speak("k", 9), None),
             (504, speak("p", 50_000), None), (505, speak("k", 30) + " " + speak("p", 40), None), (7, rows[7][1], "p")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, lang string, id string, label int")
    model = crf_langid.fit(df, F.col("id").isNull() | (F.col("id") % 3 != 0))
    got = crf_langid.identify(df, model).collect()
    by = {r.id: r for r in got}
    assert len(got) == len(rows)
    assert all(by[i].lang_pred == lang for i, _, lang in rows[:200])
    for i in (500, 501, 502):
        assert (by[i].lang_pred, by[i].score, by[i].span_langs) == ("und", 0.0, [])
    assert by[None].lang_pred == "k" and by[504].lang_pred == "p" and sum(by[504].span_words) == 50_000
    assert by[505].span_langs == ["k", "p"] and abs(by[505].span_words[0] - 30) <= 1
    assert all(0 <= r.score <= 1 for r in got)
    empty = crf_langid.fit(df.limit(0))
    assert crf_langid.identify(df.limit(0), model).count() == 0
    assert {r.lang_pred for r in crf_langid.identify(df, empty).collect()} == {"und"}


def test_held_out_languages(spark, data):
    folder = data.replace("sf0.001", "sf0.01")
    got = queries.QUERIES["op1_crf_langid"](spark, folder).where("held_out and lang_pred <> 'und'")
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    right = got.join(truth, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97


def test_network_learns_from_every_training_text(spark):
    """The weights against training each chunk's copy here, on all its training texts, over all chunks."""
    texts = {i: " ".join(f"w{(i * j) % 23}" for j in range(5 + i % 7)) for i in range(60)}
    rows = spark.createDataFrame([(i, texts[i], i % 5 != 0) for i in texts], "n long, text string, train boolean").coalesce(1)
    made = chunks.chunk_texts(rows.select(F.struct(F.col("n").alias("id"), "train").alias("id"), "text"), "id", "text",
                              lambda: gru_lm.words_of, 400)
    vocabulary = {f"w{i}".encode(): i for i in range(23)}
    weights = gru_lm.fresh_weights()
    got = gru_lm.train_network(made, vocabulary, weights)
    parts = [[x.id for x in r.ids if x.train] for r in made.select("ids").collect()]
    assert len(parts) > 2 and sum(map(len, parts)) == 48
    for _ in range(gru_lm.ROUNDS):
        total, tokens = 0.0, 0
        for part in filter(None, parts):
            ids = [[vocabulary[w] for w in gru_lm.words_of(texts[i])] + [gru_lm.END] for i in part]
            target, lengths = np.concatenate(ids), np.array([len(x) for x in ids])
            total = total + gru_lm.flatten(gru_lm.learn(weights, target, lengths)).astype(np.float64) * len(target)
            tokens += len(target)
        weights = gru_lm.unflatten(total / tokens)
    assert np.allclose(gru_lm.flatten(got), gru_lm.flatten(weights), atol=1e-5)
