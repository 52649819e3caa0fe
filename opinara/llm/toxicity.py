"""Toxicity: a bidirectional gated recurrent network with attention pooling over word and character inputs.

Every text is read in overlapping windows of words; a document scores what its
worst window scores. The network is trained in numpy on a bounded sample of
labelled documents: a toxic document teaches by its highest-scoring windows, a
clean one by its highest-scoring and some random ones.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.batches import Codes
from opinara.llm.common import seeded, text_or_empty
from opinara.llm.gru import Adam, sigmoid, step, step_back

#: Words in a window, and between the starts of two windows.
WINDOW, STRIDE = 32, 24
HIDDEN, WORD_WIDTH, CHAR_WIDTH, CHAR_BUCKETS, ATTENTION = 8, 4, 4, 1 << 11, 8
#: Documents a word needs for an embedding of its own, and the weight of the base rate in its toxic share.
OWN_DOCUMENTS, SMOOTHING = 20, 5
#: The bound of the training sample: documents by label, and characters in one of them.
SAMPLE_ROWS, SAMPLE_CHARS = {0: 1500, 1: 600}, 50_000
#: Weight updates in all, and between two searches for the highest windows.
UPDATES, SEARCH_EVERY, BATCH, RATE, SEED = 240, 60, 64, 0.02, 42
THRESHOLD = 0.7
#: Words scored at once in a task, and distinct words whose inputs a task remembers.
WORDS_AT_ONCE, REMEMBERED = 300_000, 400_000
WINDOWS_AT_ONCE = 2048
_EDGES = ".,;:!?\"'()[]{}<>*#$%&|-_~`/\\"


def normal(word: str) -> str:
    return word.lower().strip(_EDGES)


def window_starts(n: int) -> np.ndarray:
    """Starts that cover n words; the last window ends with the text."""
    starts = np.arange(0, max(n - WINDOW, 0) + 1, STRIDE)
    return starts if starts[-1] + WINDOW >= n else np.append(starts, n - WINDOW)


class ToxicityModel:
    """Weights, the log-odds of words seen in training, and the common words with an embedding of their own.

    A word's input is its log-odds, its own embedding (zero for all but common
    words) and the mean embedding of its character trigrams.
    """

    def __init__(self, log_odds: dict[str, float], words: Sequence[str], weights: dict[str, np.ndarray]):
        self.log_odds, self.words, self.weights = log_odds, {w: i + 1 for i, w in enumerate(words)}, weights
        self._forget()

    def _forget(self) -> None:
        self._codes, self._gates = Codes(), [np.zeros((0, 3 * HIDDEN), np.float32)] * 2

    def __getstate__(self):
        return {"log_odds": self.log_odds, "words": self.words, "weights": self.weights}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._forget()

    @classmethod
    def fresh(cls, log_odds: dict[str, float], words: Sequence[str]) -> ToxicityModel:
        random = np.random.default_rng(SEED)
        small = lambda *shape: (random.standard_normal(shape) * 0.3).astype(np.float32)
        return cls(log_odds, words, {
            "word": np.zeros((len(words) + 1, WORD_WIDTH), np.float32), "char": small(CHAR_BUCKETS, CHAR_WIDTH) * 0.1,
            "in": small(2, 1 + WORD_WIDTH + CHAR_WIDTH, 3 * HIDDEN), "bias": np.zeros((2, 3 * HIDDEN), np.float32),
            "state": small(2, HIDDEN, 3 * HIDDEN), "look": small(2 * HIDDEN, ATTENTION),
            "focus": small(ATTENTION), "out": small(2 * HIDDEN), "offset": np.full(1, -2.0, np.float32)})

    def inputs(self, words: Sequence[str]):
        """Per word its log-odds and embedding row, and the buckets of its character trigrams (flat, with counts)."""
        known = [normal(w) for w in words]
        odds = np.fromiter((self.log_odds.get(w, 0.0) for w in known), np.float32, len(known))
        rows = np.fromiter((self.words.get(w, 0) for w in known), np.int64, len(known))
        marked = [f"<{w}>".encode() for w in known]
        marked = [m if len(m) > 2 else b"<.>" for m in marked]
        lengths = np.fromiter(map(len, marked), np.int64, len(marked))
        data = np.frombuffer(b"".join(marked) + b"..", np.uint8).astype(np.uint32)
        grams = (data[:-2] | data[1:-1] << np.uint32(8) | data[2:] << np.uint32(16)) * np.uint32(2654435761)
        inside = np.arange(len(grams)) < np.repeat(np.cumsum(lengths) - 2, lengths)
        return odds, rows, (grams >> np.uint32(16)).astype(np.int64)[inside] % CHAR_BUCKETS, lengths - 2

    def embed(self, inputs) -> np.ndarray:
        odds, rows, flat, counts = inputs
        if not len(rows):
            return np.zeros((0, 1 + WORD_WIDTH + CHAR_WIDTH), np.float32)
        begins = np.cumsum(counts) - counts
        chars = np.add.reduceat(self.weights["char"][flat], begins, axis=0) / counts[:, None].astype(np.float32)
        return np.concatenate((odds[:, None], self.weights["word"][rows], chars), axis=1)

    def known_gates(self, texts: Sequence[Sequence[str]]) -> tuple[list[np.ndarray], np.ndarray]:
        """Gate inputs of the words a task remembers, and the place of every word of the texts among them."""
        if len(self._codes) > REMEMBERED:
            self._forget()
        before = len(self._codes)
        flat = self._codes.of(texts)
        if len(self._codes) > before:
            gates = self.gates(self.embed(self.inputs(list(islice(self._codes, before, None)))))
            self._gates = [np.concatenate(g) for g in zip(self._gates, gates)]
        return self._gates, flat

    def forward(self, gates, index: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Window scores (before the sigmoid). ``gates[d][word]``; ``index``, ``mask``: windows x positions."""
        n, length = index.shape
        states = np.empty((length, n, 2 * HIDDEN), np.float32)
        kept = [[None] * length for _ in (0, 1)]
        full = mask.all()
        for d in (0, 1):
            h = np.zeros((n, HIDDEN), np.float32)
            for t in (range(length) if d == 0 else reversed(range(length))):
                new, kept_t = step(h, gates[d][index[:, t]], self.weights["state"][d])
                h = new if full else np.where(mask[:, t, None], new, h)
                states[t, :, d * HIDDEN:(d + 1) * HIDDEN] = h
                if keep:
                    kept[d][t] = kept_t
        look = np.tanh(states @ self.weights["look"])
        weight = look @ self.weights["focus"]
        if not full:
            weight[~mask.T] = -1e9
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", weight, states)
        logits = pooled @ self.weights["out"] + self.weights["offset"][0]
        return logits, (states, kept, look, weight, pooled)

    def gates(self, embedded: np.ndarray) -> list[np.ndarray]:
        return [embedded @ self.weights["in"][d] + self.weights["bias"][d] for d in (0, 1)]

    def gradient(self, inputs, index: np.ndarray, mask: np.ndarray, target: np.ndarray):
        """Mean cross entropy of the windows and its gradient."""
        w = self.weights
        embedded = self.embed(inputs)
        gates = self.gates(embedded)
        logits, (states, kept, look, weight, pooled) = self.forward(gates, index, mask, keep=True)
        p = sigmoid(logits)
        loss = -np.mean(target * np.log(p + 1e-9) + (1 - target) * np.log(1 - p + 1e-9))
        dlogit = (p - target) / len(target)
        g = {k: np.zeros_like(v) for k, v in w.items()}
        g["out"], g["offset"][0] = pooled.T @ dlogit, dlogit.sum()
        dpooled = dlogit[:, None] * w["out"]
        dstates = weight[:, :, None] * dpooled
        dweight = np.einsum("nh,tnh->tn", dpooled, states)
        dweight = weight * (dweight - (weight * dweight).sum(axis=0))
        g["focus"] = np.einsum("tna,tn->a", look, dweight)
        dlook = dweight[:, :, None] * w["focus"] * (1 - look * look)
        g["look"] = np.einsum("tnh,tna->ha", states, dlook)
        dstates += dlook @ w["look"].T
        dembedded = np.zeros_like(embedded)
        n, length = index.shape
        for d in (0, 1):
            dgates = np.zeros_like(gates[d])
            dh = np.zeros((n, HIDDEN), np.float32)
            for t in (reversed(range(length)) if d == 0 else range(length)):
                dh = dh + dstates[t, :, d * HIDDEN:(d + 1) * HIDDEN]
                m = mask[:, t, None]
                back, dgate, du = step_back(np.where(m, dh, 0), kept[d][t], w["state"][d])
                g["state"][d] += du
                np.add.at(dgates, index[:, t], dgate)
                dh = back + np.where(m, 0, dh)
            g["in"][d], g["bias"][d] = embedded.T @ dgates, dgates.sum(axis=0)
            dembedded += dgates @ w["in"][d].T
        _, rows, flat, counts = inputs
        np.add.at(g["word"], rows, dembedded[:, 1:1 + WORD_WIDTH])
        g["word"][0] = 0
        np.add.at(g["char"], flat, np.repeat(dembedded[:, 1 + WORD_WIDTH:] / counts[:, None], counts, axis=0))
        return loss, g

    @staticmethod
    def windows(lengths: np.ndarray, flat: np.ndarray):
        """Per window its words as codes, its mask and its text, for texts that follow one another in ``flat``."""
        starts = [window_starts(n) for n in lengths.tolist()]
        owner = np.repeat(np.arange(len(lengths)), [len(s) for s in starts])
        begin = np.cumsum(lengths) - lengths
        offset = np.concatenate(starts)[:, None] + np.arange(WINDOW)
        mask = offset < lengths[owner][:, None]
        index = flat[np.minimum(offset + begin[owner][:, None], len(flat) - 1)]
        return index, mask, owner

    def score_words(self, texts: Sequence[Sequence[str]]) -> np.ndarray:
        """Per text with words the largest probability of its windows."""
        gates, flat = self.known_gates(texts)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        index, mask, owner = self.windows(lengths, flat)
        best = np.full(len(texts), -np.inf)
        full = mask[:, -1]  # short texts apart: full windows need no mask
        for part in (np.flatnonzero(full), np.flatnonzero(~full)):
            for at in range(0, len(part), WINDOWS_AT_ONCE):
                some = part[at:at + WINDOWS_AT_ONCE]
                logits, _ = self.forward(gates, index[some], mask[some])
                np.maximum.at(best, owner[some], logits)
        return sigmoid(best)

    def score(self, texts: Iterator[str]) -> np.ndarray:
        """A probability for every text; 0 for a text without a word."""
        scores, group, places, words = [], [], [], 0

        def flush():
            if group:
                for place, s in zip(places, self.score_words(group)):
                    scores[place] = float(s)

        for text in texts:
            split = text.split()
            scores.append(0.0)
            if split:
                group.append(split)
                places.append(len(scores) - 1)
                words += len(split)
            if words > WORDS_AT_ONCE:
                flush()
                group, places, words = [], [], 0
        flush()
        return np.array(scores)


def train(texts: Sequence[str], labels: Sequence[int]) -> ToxicityModel:
    """A network fitted to labelled texts; the same texts in the same order give the same network."""
    split = [t.split() for t in texts]
    labels = np.array([y for y, s in zip(labels, split) if s], np.float32)
    split = [s for s in split if s]
    random = np.random.default_rng(SEED)
    in_all, in_toxic = Counter(), Counter()
    for words, y in zip(split, labels):
        own = {normal(w) for w in words}
        in_all.update(own)
        if y:
            in_toxic.update(own)
    base = min(max(float(labels.mean()) if len(labels) else 0.5, 0.01), 0.99)

    def log_odds(toxic, total):
        share = (toxic + SMOOTHING * base) / (total + SMOOTHING)
        return np.log(share / (1 - share)) - np.log(base / (1 - base))

    seen = sorted(w for w, n in in_all.items() if n > 1)
    model = ToxicityModel.fresh({w: float(log_odds(in_toxic[w], in_all[w])) for w in seen},
                                [w for w in seen if in_all[w] >= OWN_DOCUMENTS])
    if not len(labels):
        return model
    codes = Codes()
    flat_codes = codes.of(split)
    names = list(codes)
    index, mask, owner = model.windows(np.array([len(t) for t in split]), flat_codes)
    # A text's own label must not speak through its words: their log-odds leave that text out,
    # so every word has one version for clean and one for toxic texts.
    toxic = labels[owner] > 0
    own = [normal(w) for w in names]
    total = np.array([in_all[w] for w in own], np.float64)
    bad = np.array([in_toxic[w] for w in own], np.float64)
    _, rows, flat, counts = model.inputs(names)
    odds = [np.where(total > 1, log_odds(np.maximum(bad - y, 0), np.maximum(total - 1, 0)), 0) for y in (0, 1)]
    inputs = (np.concatenate(odds).astype(np.float32), np.tile(rows, 2), np.tile(flat, 2), np.tile(counts, 2))
    index = index + len(names) * toxic[:, None]
    score = np.where(mask, inputs[0][index], -np.inf).max(axis=1)
    adam = Adam(model.weights, RATE)
    clean = np.flatnonzero(~toxic)
    for round_ in range(UPDATES // SEARCH_EVERY):
        # The highest window of each text, ties by a draw, and as many other clean ones.
        order = np.lexsort((random.random(len(score)), -score, owner))
        rank = np.arange(len(order)) - np.searchsorted(owner[order], owner[order])
        chosen = order[rank < 1]
        chosen = np.concatenate((chosen, random.choice(clean, len(chosen)) if len(clean) else chosen))
        for _ in range(SEARCH_EVERY):
            part = random.choice(chosen, min(BATCH, len(chosen)), replace=False)
            used, where = np.unique(index[part], return_inverse=True)
            sub = _subset(inputs, used)
            _, gradient = model.gradient(sub, where.reshape(len(part), -1), mask[part], labels[owner[part]])
            adam.update(gradient)
        gates = model.gates(model.embed(inputs))
        score = np.concatenate([model.forward(gates, index[a:a + WINDOWS_AT_ONCE], mask[a:a + WINDOWS_AT_ONCE])[0]
                                for a in range(0, len(index), WINDOWS_AT_ONCE)])
    return model


def _subset(inputs, used: np.ndarray):
    odds, rows, flat, counts = inputs
    begins = np.cumsum(counts) - counts
    n = counts[used]
    at = np.repeat(begins[used] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    return odds[used], rows[used], flat[at], n


def labelled_sample(docs: DataFrame, labels: DataFrame, trainable: Column, id_column: str = "doc_id",
                    text_column: str = "text", label_column: str = "toxic") -> DataFrame:
    """``id, text, label`` of about ``SAMPLE_ROWS`` texts per label by a seeded hash of the id, of at most ``SAMPLE_CHARS`` characters."""
    known = labels.select(F.col(id_column).alias("id"), F.col(label_column).cast("int").alias("label"))
    known = known.where(trainable & F.col("id").isNotNull() & F.col("label").isin(list(SAMPLE_ROWS)))
    known = known.groupBy("id").agg(F.max("label").alias("label"))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    limit = F.lit(0.0)
    for label, n in counts.items():
        limit = F.when(F.col("label") == label, min(1.0, SAMPLE_ROWS[label] / n)).otherwise(limit)
    # Drawn by a threshold, so the sample has its expected size give or take a few per cent: small enough to broadcast.
    drawn = known.where(seeded(SEED, F.col("id")).cast("double") / 2.0 ** 63 < limit)
    texts = docs.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("text"))
    return texts.join(F.broadcast(drawn), "id").where(F.length("text") <= SAMPLE_CHARS).select("id", "text", "label")


def score_column(model: ToxicityModel, text_column: str, spark) -> Column:
    """The score of a text column, null as empty; the network (bounded by its sample) is broadcast."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(shared.value.score(texts))

    return score(text_or_empty(text_column))


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
        label_column: str = "toxic", trainable: Column | None = None) -> ToxicityModel:
    """A model from labelled rows whose ``id`` satisfies ``trainable`` (all by default)."""
    sample = labelled_sample(docs, labels, F.lit(True) if trainable is None else trainable,
                             id_column, text_column, label_column)

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([pd.DataFrame({"id": [], "text": [], "label": []}), *batches]).sort_values(["id", "text"])
        model = train(rows["text"].tolist(), rows["label"].tolist())
        yield pd.DataFrame({"model": [pickle.dumps(model.__getstate__())]})

    # The bounded sample is learned from in one task; only the network reaches the driver.
    model = ToxicityModel.__new__(ToxicityModel)
    row = sample.repartition(1).mapInPandas(learn, "model binary").first()
    if row is None:  # nothing to learn from
        return train([], [])
    model.__setstate__(pickle.loads(row["model"]))
    return model


def score_documents(docs: DataFrame, model: ToxicityModel, id_column: str = "doc_id",
                    text_column: str = "text") -> DataFrame:
    """``id, score`` per row. A text without words, null included, scores 0. Repeated rows score alike,
    null ids are kept, no rows give none, other columns are ignored."""
    return docs.select(F.col(id_column).alias("id"), score_column(model, text_column, docs.sparkSession).alias("score"))


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_column: str = "text",
               threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score below the threshold, with all their columns."""
    name = "__toxicity"
    while name in docs.columns:
        name = f"_{name}"
    return docs.withColumn(name, score_column(model, text_column, docs.sparkSession)).where(F.col(name) < threshold).drop(name)
