"""Quality classifier: random-indexing word vectors pooled per document, and a two-layer network with a temperature.

A word's index vector adds sparse signs drawn by hash for its letters, its edge
marks and its case. Its context vector adds the index vectors around all its
places in the corpus, less what any word would have there; words of the
labelled sample have one. A document is the mean of both over its words, with
the mean likeness of near words, its length and the share of known words.
Every sum runs over whole texts; what a task holds is bounded by the table.
"""

from __future__ import annotations

import math
import pickle
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import chain, count, islice

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.llm.common import seeded, text_or_empty
from opinara.llm.gru import Adam, sigmoid
from opinara.session import materialize

#: Entries of an index vector, signs drawn for a feature of a word, words of context on each side, near words compared.
WIDTH, SIGNS, REACH, LAGS = 32, 4, 2, 3
GAP = max(REACH, LAGS)
#: The bound of the training sample (documents by label) and of the table of words with context vectors.
SAMPLE_ROWS, TABLE_WORDS, TABLE_DOCUMENTS = {0: 3000, 1: 5000}, 32_768, 3
HIDDEN, UPDATES, BATCH, RATE, DECAY, SEED = 16, 600, 256, 0.01, 1e-3, 42
#: Every so many sampled documents one is kept from training for the temperature, which stays in these bounds.
CALIBRATED, TEMPERATURES = 5, (0.25, 8.0)
THRESHOLD = 0.7
#: Words of which a task remembers the index vector, words gathered before they are pooled, places pooled at once.
REMEMBERED, WORDS_AT_ONCE, PLACES_AT_ONCE = 200_000, 300_000, 20_000
#: Words in a block of context sums.
BLOCK = 256
FEATURES = 2 * WIDTH + LAGS + 2
_EDGES = ".,;:!?\"'()[]{}<>*#$%&|-_~`/\\+=@^"


def parts_of(word: str) -> tuple[str, tuple[str, str, str]]:
    """What a word's index vector is drawn from: its letters; marks in front, marks behind and case."""
    if word.isalpha():
        front, core, back = "", word, ""
    else:
        bare = word.lstrip(_EDGES)
        core = bare.rstrip(_EDGES)
        front, back = word[:len(word) - len(bare)], bare[len(core):]
    if core.islower():
        return core, (front, back, "lower")
    case = "upper" if core.isupper() and len(core) > 1 else "title" if core[:1].isupper() else "digit" if core.isdigit() else "lower"
    return core.lower(), (front, back, case)


def signs(features: Sequence[str]) -> np.ndarray:
    """A row of ``WIDTH`` entries per feature, ``SIGNS`` times a one with a sign added at places drawn by hash."""
    drawn = np.fromiter((xxhash.xxh64_intdigest(f, SEED) for f in features), np.uint64, len(features))
    table = np.zeros(len(features) * WIDTH, np.float32)
    bits = int(math.log2(WIDTH)) + 1
    for i in range(SIGNS):
        part = (drawn >> np.uint64(bits * i)).astype(np.int64)
        np.add.at(table, np.arange(len(features)) * WIDTH + (part & (WIDTH - 1)),
                  (1 - 2 * ((part >> (bits - 1)) & 1)).astype(np.float32))
    return table.reshape(-1, WIDTH)


def index_vectors(words: Sequence[str]) -> np.ndarray:
    """One row of ``WIDTH`` whole numbers per word: the signs of its letters, marks and case added up."""
    parts = [parts_of(w) for w in words]
    shapes: dict = defaultdict(count().__next__)
    places = np.fromiter((shapes[p[1]] for p in parts), np.int64, len(parts))
    named = [signs([mark + s[i] for s in shapes]) for i, mark in enumerate("fbc")]
    return signs(["w" + p[0] for p in parts]) + sum(named[1:], named[0])[places]


class Words:
    """Numbers and index vectors of the words a task has met; forgets them when they are too many.

    ``vectors`` and ``units`` (of length one) have a row per number, ``rows`` says the place in the table, or -1. Number 0 is no
    word: it stands ``GAP`` times behind each text, has zero vectors, and keeps texts apart.
    """

    def __init__(self, known: dict[str, int] | None = None):
        self.known = known or {}
        self.forget()

    def forget(self) -> None:
        self.codes = defaultdict(count(1).__next__, {None: 0})
        self.vectors = np.zeros((1, WIDTH + 1), np.float32)
        self.units = np.zeros((1, WIDTH), np.float32)
        self.rows = np.full(1, -1)

    def flat(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all words of the texts with the gaps behind them, and where each text starts."""
        if len(self.codes) > REMEMBERED:
            self.forget()
        n = len(self.codes)
        gap = [None] * GAP
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + GAP
        words = chain.from_iterable(chain(t, gap) for t in texts)
        flat = np.fromiter(map(self.codes.__getitem__, words), np.int64, int(sizes.sum()))
        if len(self.codes) > n:
            new = list(islice(self.codes, n, None))
            vectors = index_vectors(new)
            units = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
            # The last entry counts words.
            self.vectors = np.concatenate((self.vectors, np.column_stack((vectors, np.ones(len(new), np.float32)))))
            self.units = np.concatenate((self.units, units))
            self.rows = np.concatenate((self.rows, np.fromiter((self.known.get(w, -1) for w in new), np.int64, len(new))))
        return flat, np.cumsum(sizes) - sizes


def _grouped(texts: Iterator[str]) -> Iterator[list[list[str]]]:
    """Split texts in groups of about ``WORDS_AT_ONCE`` words."""
    group, words = [], 0
    for text in texts:
        group.append(text.split())
        words += len(group[-1]) + GAP
        if words > WORDS_AT_ONCE:
            yield group
            group, words = [], 0
    if group:
        yield group


def add_contexts(sums: np.ndarray, words: Words, texts: list[list[str]]) -> None:
    """Add to ``sums`` (a row per table word, and a last one for all words) index vectors around each place and their number."""
    flat, _ = words.flat(texts)
    for at in range(0, len(flat), PLACES_AT_ONCE):
        end = min(at + PLACES_AT_ONCE, len(flat))
        codes = np.zeros(end - at + 2 * REACH, np.int64)
        low, high = max(at - REACH, 0), min(end + REACH, len(flat))
        codes[low - at + REACH:high - at + REACH] = flat[low:high]
        index, n = words.vectors[codes], end - at
        around = index[:n].copy()
        for shift in range(1, 2 * REACH + 1):
            if shift != REACH:
                around += index[shift:shift + n]
        codes = codes[REACH:REACH + n]
        # All entries are whole and small, so these sums are exact in any order.
        sums[-1] += around[codes > 0].sum(axis=0, dtype=np.float64).astype(np.int64)
        row = words.rows[codes]
        in_table = np.flatnonzero(row >= 0)
        if len(in_table):
            order = in_table[np.argsort(row[in_table], kind="stable")]
            found, first = np.unique(row[order], return_index=True)
            sums[found] += np.add.reduceat(around[order], first, axis=0).astype(np.int64)


def context_table(sums: np.ndarray) -> np.ndarray:
    """Unit context vectors of the table words from their sums: what lies around the word beyond what lies around any."""
    mean = sums[-1, :WIDTH] / max(int(sums[-1, WIDTH]), 1)
    table = sums[:-1, :WIDTH] - sums[:-1, WIDTH:] * mean
    return (table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(words: Words, contexts: np.ndarray, texts: list[list[str]]) -> np.ndarray:
    """``FEATURES`` per text; zeros for one without words."""
    flat, starts = words.flat(texts)
    padded = np.concatenate((contexts, np.zeros((1, WIDTH), np.float32)))
    total = np.zeros((len(texts), FEATURES))
    for at in range(0, len(flat), PLACES_AT_ONCE):
        n = min(PLACES_AT_ONCE, len(flat) - at)
        codes = flat[at:at + n + LAGS]
        index, row = words.units[codes], words.rows[codes[:n]]
        part = np.zeros((n, FEATURES), np.float32)
        part[:, :WIDTH] = index[:n]
        part[:, WIDTH:2 * WIDTH] = padded[row]
        for lag in range(1, LAGS + 1):
            m = max(0, min(n, len(codes) - lag))  # the last places may be fewer than the lag
            part[:m, 2 * WIDTH + lag - 1] = np.einsum("ij,ij->i", index[:m], index[lag:lag + m])
        part[:, -2] = row >= 0
        first = np.searchsorted(starts, at, side="right") - 1
        here = starts[first:np.searchsorted(starts, at + n)]
        total[first:first + len(here)] += np.add.reduceat(part, np.maximum(here - at, 0), axis=0)
    sizes = np.diff(np.append(starts, len(flat))) - GAP
    total /= np.maximum(sizes, 1)[:, None]
    total[:, -1] = np.log1p(sizes)
    return total


@dataclass
class QualityModel:
    """Table words with their context vectors, the network, and the temperature of its logits."""

    words: list[str]
    contexts: np.ndarray
    weights: dict[str, np.ndarray] = field(default_factory=dict)
    temperature: float = 1.0

    def probability(self, features: np.ndarray) -> np.ndarray:
        return sigmoid(logits(self.weights, features)[0] / self.temperature)


def logits(weights: dict[str, np.ndarray], features: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x = (features - weights["mean"]) / weights["scale"]
    hidden = np.tanh(x @ weights["w1"] + weights["b1"])
    return hidden @ weights["w2"] + weights["b2"], hidden, x


def loss_gradient(weights, features, labels, importance) -> tuple[float, dict[str, np.ndarray]]:
    """Weighted cross-entropy with decay of the two matrices, and its gradient."""
    z, hidden, x = logits(weights, features)
    share = importance / importance.sum()
    loss = float((share * (np.logaddexp(0, z) - labels * z)).sum())
    loss += DECAY / 2 * float((weights["w1"] ** 2).sum() + (weights["w2"] ** 2).sum())
    dz = share * (sigmoid(z) - labels)
    dh = np.outer(dz, weights["w2"]) * (1 - hidden ** 2)
    return loss, {"w1": x.T @ dh + DECAY * weights["w1"], "b1": dh.sum(axis=0),
                  "w2": hidden.T @ dz + DECAY * weights["w2"], "b2": np.array([dz.sum()])}


def train(features: np.ndarray, labels: np.ndarray, importance: np.ndarray) -> tuple[dict[str, np.ndarray], float]:
    """Weights and temperature; the same rows in the same order give the same. Without rows every probability is a half."""
    random = np.random.default_rng(SEED)
    n = len(labels)
    held = random.permutation(n) % CALIBRATED == 0 if n >= 10 * CALIBRATED else np.zeros(n, bool)
    used = ~held
    mean = features[used].mean(axis=0) if n else np.zeros(FEATURES)
    scale = features[used].std(axis=0) + 0.01 if n else np.ones(FEATURES)
    learned = {"w1": random.standard_normal((FEATURES, HIDDEN)) / math.sqrt(FEATURES), "b1": np.zeros(HIDDEN),
               "w2": random.standard_normal(HIDDEN) / math.sqrt(HIDDEN) if n else np.zeros(HIDDEN), "b2": np.zeros(1)}
    fixed = {"mean": mean, "scale": scale}
    if not n:
        return learned | fixed, 1.0
    adam, rows = Adam(learned, RATE), np.flatnonzero(used)
    for _ in range(UPDATES):
        part = random.choice(rows, min(BATCH, len(rows)), replace=False)
        adam.update(loss_gradient(learned | fixed, features[part], labels[part], importance[part])[1])
    if not held.any():
        return learned | fixed, 1.0
    z, y, w = logits(learned | fixed, features[held])[0], labels[held], importance[held]
    steps = np.geomspace(*TEMPERATURES, 141)
    losses = [(w * (np.logaddexp(0, z / t) - y * z / t)).sum() for t in steps]
    return learned | fixed, float(steps[int(np.argmin(losses))])


def labelled_sample(docs: DataFrame, labels: DataFrame, trainable: Column, id_column: str, text_column: str,
                    label_column: str) -> DataFrame:
    """``id, text, label, importance``: about ``SAMPLE_ROWS`` whole texts per label by a seeded hash of the id.

    ``importance`` is how many labelled rows one drawn row stands for. A
    repeated label row counts once, with its largest label.
    """
    known = labels.select(F.col(id_column).alias("id"), F.col(label_column).cast("int").alias("label"))
    known = known.where(trainable & F.col("id").isNotNull() & F.col("label").isin(list(SAMPLE_ROWS)))
    known = known.groupBy("id").agg(F.max("label").alias("label"))
    limit, weight = F.lit(0.0), F.lit(1.0)
    for row in known.groupBy("label").count().collect():
        share = min(1.0, SAMPLE_ROWS[row["label"]] / row["count"])
        limit = F.when(F.col("label") == row["label"], share).otherwise(limit)
        weight = F.when(F.col("label") == row["label"], 1 / share).otherwise(weight)
    # Drawn by a threshold: the expected size give or take a few per cent, small enough to broadcast.
    drawn = known.where(seeded(SEED, F.col("id")).cast("double") / 2.0 ** 63 < limit).withColumn("importance", weight)
    texts = docs.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("text"))
    return materialize(texts.join(F.broadcast(drawn), "id"), "quality-sample")


def _table_words(sample: DataFrame) -> list[str]:
    """Words of ``TABLE_DOCUMENTS`` sampled texts or more, the ``TABLE_WORDS`` in most texts at the most."""
    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0):
                words = list(set(text.as_py().split()))
                if words:
                    yield pa.RecordBatch.from_arrays([pa.array(words)], ["word"])

    counts = sample.select("text").mapInArrow(distinct, "word string").groupBy("word").count()
    rows = counts.where(F.col("count") >= TABLE_DOCUMENTS).orderBy(F.desc("count"), "word").limit(TABLE_WORDS).collect()
    return [r["word"] for r in rows]


def context_sums(docs: DataFrame, words: list[str], text_column: str) -> np.ndarray:
    """Sums around every place of the table words in all texts, added up block by block in two rounds."""
    spark, n = docs.sparkSession, len(words)
    shared = spark.sparkContext.broadcast({w: i for i, w in enumerate(words)})
    texts = docs.select(text_or_empty(text_column).alias("text"))
    salts = max(1, math.isqrt(texts.rdd.getNumPartitions()))
    schema = "block int, salt int, data binary"
    size = lambda b: min(BLOCK, n + 1 - b * BLOCK)

    def rows(blocks: dict[int, np.ndarray], salt: int) -> Iterator[pa.RecordBatch]:
        for b, data in blocks.items():
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([salt], pa.int32()),
                                              pa.array([zstandard.compress(data.tobytes(), 3)], pa.binary())],
                                             ["block", "salt", "data"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, seen = np.zeros((n + 1, WIDTH + 1), np.int64), Words(shared.value)
        for group in _grouped(text.as_py() for batch in batches for text in batch.column(0)):
            add_contexts(sums, seen, group)
        yield from rows({b: part for b in range(-(-(n + 1) // BLOCK)) if (part := sums[b * BLOCK:(b + 1) * BLOCK]).any()},
                        TaskContext.get().partitionId() % salts)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, data in zip(batch.column(0).to_pylist(), batch.column(2)):
                part = np.frombuffer(zstandard.decompress(data.as_py()), np.int64).reshape(size(b), WIDTH + 1)
                blocks[b] = blocks[b] + part if b in blocks else part
        yield from rows(blocks, 0)

    parts = texts.mapInArrow(gather, schema).repartition("block", "salt").mapInArrow(add, schema)
    found = np.zeros((n + 1, WIDTH + 1), np.int64)
    # At most TABLE_WORDS + 1 rows reach the driver.
    for row in parts.repartition("block").mapInArrow(add, schema).collect():
        at = row["block"] * BLOCK
        found[at:at + size(row["block"])] += np.frombuffer(zstandard.decompress(row["data"]), np.int64).reshape(-1, WIDTH + 1)
    return found


def _featured(rows: DataFrame, model: QualityModel, finish, schema: T.StructType | str) -> DataFrame:
    """``finish(batch, features)`` for every batch, the text being its last column."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        words = Words({w: i for i, w in enumerate(model.words)})
        for batch in batches:
            texts = (t.as_py() for t in batch.column(batch.num_columns - 1))
            parts = [pooled(words, model.contexts, g) for g in _grouped(texts)]
            yield finish(model, batch, np.concatenate([np.zeros((0, FEATURES)), *parts]))

    return rows.mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
        label_column: str = "quality", trainable: Column | None = None) -> QualityModel:
    """Context vectors from all texts, and a network from labelled rows whose ``id`` satisfies ``trainable`` (all by default).

    Labels other than 0 and 1, null ones and null ids teach nothing; without
    labelled texts every score is a half. A null text counts as empty.
    """
    sample = labelled_sample(docs, labels, F.lit(True) if trainable is None else trainable, id_column, text_column, label_column)
    words = _table_words(sample)
    model = QualityModel(words, context_table(context_sums(docs, words, text_column)))

    def keep(model, batch, features):
        flat = pa.ListArray.from_arrays(pa.array(np.arange(len(features) + 1, dtype=np.int32) * FEATURES), pa.array(features.ravel()))
        return pa.RecordBatch.from_arrays([*batch.columns[:3], flat], ["id", "label", "importance", "features"])

    schema = T.StructType([sample.schema["id"], sample.schema["label"], T.StructField("importance", T.DoubleType()),
                           T.StructField("features", T.ArrayType(T.DoubleType()))])
    featured = _featured(sample.select("id", "label", "importance", "text"), model, keep, schema)

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [b for b in batches if len(b)]
        if rows:
            rows = pd.concat(rows)
            rows = rows.assign(order=rows["features"].map(tuple)).sort_values(["id", "order"])
            learned = train(np.stack(rows["features"]), rows["label"].to_numpy(np.float64), rows["importance"].to_numpy())
            yield pd.DataFrame({"model": [pickle.dumps(learned)]})

    # The bounded sample, now a few numbers a row, is learned from in one task; only the network reaches the driver.
    row = featured.repartition(1).mapInPandas(learn, "model binary").first()
    model.weights, model.temperature = pickle.loads(row["model"]) if row else train(np.zeros((0, FEATURES)), np.zeros(0), np.zeros(0))
    return model


def score_documents(docs: DataFrame, model: QualityModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, score`` per row, the probability of label 1. Null and empty texts score alike, as texts of no words.

    Texts of any length count in whole, pooled some places at a time. Repeated rows score alike, null ids are kept, no rows
    give none, other columns are ignored.
    """
    rows = docs.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("text"))

    def finish(model, batch, features):
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.probability(features))], ["id", "score"])

    return _featured(rows, model, finish, T.StructType([rows.schema["id"], T.StructField("score", T.DoubleType())]))
