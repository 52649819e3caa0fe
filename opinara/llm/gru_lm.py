"""A gated recurrent language model with a class-factored softmax.

Counts, vocabulary and unseen mass come from every training text: a chunk's
distinct words are shuffled once to be counted and once back. The network then
learns by truncated backpropagation on every training text of every chunk;
each chunk trains its own copy and the copies are averaged, so training grows
with the corpus and only one set of weights reaches the driver. Scoring carries
the state over the whole of every document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opinara.llm.batches import Lanes, groups
from opinara.llm.chunks import chunk_texts, indexes_of, unpack_tokens, with_values
from opinara.llm.common import fold
from opinara.llm.gru import Adam, step
from opinara.session import materialize

#: Words with an output of their own, in classes of equal size; the end of a text is one of them.
VOCABULARY, CLASS_SIZE = 1024, 32
CLASSES = VOCABULARY // CLASS_SIZE
END = VOCABULARY - 1
#: Inputs: the vocabulary, then buckets of rarer words, then the start of a text.
RARE_BUCKETS = 64
START = VOCABULARY + RARE_BUCKETS
EMBEDDING, HIDDEN = 16, 16
#: Steps of truncated backpropagation, lanes, and rounds of averaging.
WINDOW, LANES, ROUNDS, RATE, SEED = 32, 64, 2, 0.01, 42
#: Tokens that are laid side by side for scoring, and tokens whose outputs are made at once, few enough for a core's cache.
TOKENS_AT_ONCE, OUTPUTS_AT_ONCE = 400_000, 8192
SMOOTH = 0.1


def words_of(text: str) -> list[bytes]:
    """Lower-case A-Z only; cut at the six spaces."""
    return text.encode().lower().split()


def fresh_weights() -> dict[str, np.ndarray]:
    random = np.random.default_rng(SEED)
    small = lambda *shape: (random.standard_normal(shape) * 0.1).astype(np.float32)
    return {"embed": small(START + 1, EMBEDDING), "in": small(EMBEDDING, 3 * HIDDEN),
            "bias": np.zeros(3 * HIDDEN, np.float32), "state": small(HIDDEN, 3 * HIDDEN),
            "class": small(HIDDEN, CLASSES + 1), "class_bias": np.zeros(CLASSES + 1, np.float32),
            "word": small(CLASSES, HIDDEN, CLASS_SIZE), "word_bias": np.zeros((CLASSES, CLASS_SIZE), np.float32)}


def start_from_counts(weights: dict[str, np.ndarray], counts: np.ndarray, rare: int) -> dict[str, np.ndarray]:
    """The outputs' biases set so that an untrained network gives the words' plain frequencies."""
    grid = np.asarray(counts, np.float64).reshape(CLASSES, CLASS_SIZE) + SMOOTH
    mass = np.append(grid.sum(axis=1), rare + SMOOTH)
    return {**weights, "class_bias": np.log(mass / mass.sum()).astype(np.float32),
            "word_bias": np.log(grid / grid.sum(axis=1, keepdims=True)).astype(np.float32)}


def flatten(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[k].ravel() for k in sorted(weights)])


def unflatten(flat: np.ndarray) -> dict[str, np.ndarray]:
    like, out, at = fresh_weights(), {}, 0
    for k in sorted(like):
        out[k] = flat[at:at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def normalise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per column: exponentials of the entries less their largest, the sum of these, and the log of the sum of exponentials."""
    most = x.max(axis=0)
    e = np.exp(x - most)
    total = e.sum(axis=0)
    return e, total, np.log(total) + most


def output(weights: dict[str, np.ndarray], states: np.ndarray, target: np.ndarray, back: bool = False):
    """Natural log of P(class) P(word | class) per token; a rare word stops at its class. With ``back``, the
    gradient of the mean negative log-likelihood too."""
    cls = np.minimum(target // CLASS_SIZE, CLASSES)  # every id from VOCABULARY on is rare
    # In order of class, so that each class is one slice and all but its products is done at once; tokens are columns.
    order = np.argsort(cls.astype(np.uint8), kind="stable")
    cls, states = cls[order], states.T[:, order]
    cuts = np.searchsorted(cls, np.arange(CLASSES + 1)).tolist()
    mine = [(c, slice(x, y)) for c, (x, y) in enumerate(zip(cuts, cuts[1:])) if x < y]
    n, n_words = len(cls), cuts[-1]
    at, own = np.arange(n), cls[:n_words]
    word = target[order[:n_words]] - own * CLASS_SIZE
    x_class = weights["class"].T @ states
    x_class += weights["class_bias"][:, None]
    e_class, total_class, norm = normalise(x_class)
    found = (x_class[cls, at] - norm).astype(np.float64)
    x_word = np.empty((CLASS_SIZE, n_words), x_class.dtype)
    for c, part in mine:
        x = np.matmul(weights["word"][c].T, states[:, part], out=x_word[:, part])
        x += weights["word_bias"][c][:, None]
    e_word, total_word, norm = normalise(x_word)
    found[:n_words] += x_word[word, at[:n_words]] - norm
    logp = np.empty(n)
    logp[order] = found
    if not back:
        return logp
    g = {k: np.zeros_like(weights[k]) for k in ("word", "word_bias")}
    d = e_class
    d /= total_class * n
    d[cls, at] -= 1 / n
    g["class"], g["class_bias"] = states @ d.T, d.sum(axis=1)
    sorted_back = weights["class"] @ d
    d = e_word
    d /= total_word * n
    d[word, at[:n_words]] -= 1 / n
    for c, part in mine:
        np.matmul(states[:, part], d[:, part].T, out=g["word"][c])
        sorted_back[:, part] += weights["word"][c] @ d[:, part]
    if mine:
        g["word_bias"][[c for c, _ in mine]] = np.add.reduceat(d, [part.start for _, part in mine], axis=1).T
    dstates = np.empty_like(sorted_back)
    dstates[:, order] = sorted_back
    return logp, dstates.T, g


def inputs_of(target: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """What the network reads before each token: the token before it, or the start."""
    before = np.empty_like(target)
    before[1:] = target[:-1]
    before[(np.cumsum(lengths) - lengths)[lengths > 0]] = START
    return before


def window_gradient(weights, read: np.ndarray, target: np.ndarray, first: np.ndarray, state: np.ndarray):
    """Loss, gradient and last state of one window (steps x lanes); nothing flows back beyond it.

    Inside, units come before lanes, so that a gate is one run of memory, and
    what does not wait for the step before is done for all steps at once.
    """
    (steps, lanes), kind, width = read.shape, weights["state"].dtype, HIDDEN
    gates = weights["embed"] @ weights["in"] + weights["bias"]
    # A sigmoid is half a tanh of half its argument, and a half; halves are exact.
    half = np.repeat(np.array([0.5, 1], kind), [2 * width, width])
    u, starts, keep = np.ascontiguousarray((weights["state"] * half).T), first.any(axis=1), (~first).astype(kind)
    read_gates = np.ascontiguousarray((gates * half)[read].transpose(0, 2, 1))
    sums, zr, c = np.empty_like(read_gates), np.empty((steps, 2 * width, lanes), kind), np.empty((steps, width, lanes), kind)
    after, move = np.empty((steps + 1, width, lanes), kind), np.empty((width, lanes), kind)
    after[0] = state.T
    for t in range(steps):
        h, a, both, now = after[t], sums[t], zr[t], c[t]
        if starts[t]:
            h = h * keep[t]
        np.matmul(u, h, out=a)
        np.add(read_gates[t, :2 * width], a[:2 * width], out=both)
        np.tanh(both, out=both)
        both *= 0.5
        both += 0.5
        np.multiply(both[width:], a[2 * width:], out=now)
        now += read_gates[t, 2 * width:]
        np.tanh(now, out=now)
        np.subtract(h, now, out=move)
        move *= both[:width]
        np.add(now, move, out=after[t + 1])
    by_unit = lambda x: x.transpose(1, 0, 2).reshape(x.shape[1], -1)
    logp, dstates, g = output(weights, by_unit(after[1:]).T, target.ravel(), back=True)
    dstates = np.ascontiguousarray(dstates.T.reshape(width, steps, lanes).transpose(1, 0, 2))
    before, last = after[:-1], after[-1].T.copy()
    before[starts] *= keep[starts][:, None]
    z, r, q = zr[:, :width], zr[:, width:], sums[:, 2 * width:]
    # What a state's gradient is multiplied by: for candidate, update, reset and recurrent candidate, and for the state before.
    factor = np.empty((steps, 5, width, lanes), kind)
    factor[:, 4] = z
    rest = 1 - z
    np.multiply(rest, 1 - c * c, out=factor[:, 0])
    rest *= z
    np.multiply(before - c, rest, out=factor[:, 1])
    np.multiply(factor[:, 0], r, out=factor[:, 3])
    np.multiply(factor[:, 3], q * (1 - r), out=factor[:, 2])
    dh, flat = np.zeros((width, lanes), kind), factor.reshape(steps, 5 * width, lanes)
    for t in reversed(range(steps)):
        dh += dstates[t]
        factor[t] *= dh
        np.matmul(weights["state"], flat[t, width:4 * width], out=dh)
        dh += factor[t, 4]
        if starts[t]:
            dh *= keep[t]
    flat = by_unit(flat[:, :4 * width])
    g["state"] = by_unit(before) @ flat[width:].T
    # The gradients of the places that read the same word are added up in one pass.
    order = np.argsort(read.ravel().astype(np.uint16), kind="stable")
    words = read.ravel()[order]
    cuts = np.flatnonzero(np.append(True, words[1:] != words[:-1]))
    dgates = np.zeros_like(gates)
    dgates[words[cuts]] = np.add.reduceat(np.ascontiguousarray(np.roll(flat[:3 * width], -width, axis=0).T)[order], cuts, axis=0)
    g["in"], g["bias"] = weights["embed"].T @ dgates, dgates.sum(axis=0)
    g["embed"] = dgates @ weights["in"].T
    return -logp.mean(), g, last


def learn(weights: dict[str, np.ndarray], target: np.ndarray, lengths: np.ndarray) -> dict[str, np.ndarray]:
    """One pass of truncated backpropagation over texts; the state is carried from window to window."""
    weights = {k: v.copy() for k, v in weights.items()}
    adam = Adam(weights, RATE)
    read = inputs_of(target, lengths)
    first = np.zeros(len(target), bool)
    first[(np.cumsum(lengths) - lengths)[lengths > 0]] = True
    steps = -(-len(target) // LANES)
    # The stream is cut into lanes; the tail is filled with its own beginning.
    at = np.resize(np.arange(len(target)), steps * LANES).reshape(LANES, steps).T
    state = np.zeros((LANES, HIDDEN), np.float32)
    for t in range(0, steps, WINDOW):
        part = at[t:t + WINDOW]
        _, g, state = window_gradient(weights, read[part], target[part], first[part], state)
        adam.update(g)
    return weights


def score(weights: dict[str, np.ndarray], target: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Natural log-likelihood of every text (its tokens end with END), the state carried over all of it."""
    out = np.zeros(len(lengths))
    begin = np.cumsum(lengths) - lengths
    gates = weights["embed"] @ weights["in"] + weights["bias"]
    for group in groups(lengths, TOKENS_AT_ONCE):
        n = lengths[group]
        flat = np.repeat(begin[group] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        own = target[flat]
        read = inputs_of(own, n)
        lanes = Lanes(n)
        states = np.empty((len(own), HIDDEN), np.float32)
        state = np.zeros((lanes.place.shape[1], HIDDEN), np.float32)
        for t, k in enumerate(lanes.active):
            place = lanes.place[t, :k]
            state = np.where(lanes.first[t, :k, None], np.float32(0), state[:k])
            state, _ = step(state, gates[read[place]], weights["state"])
            states[place] = state
        logp = np.concatenate([output(weights, states[a:a + OUTPUTS_AT_ONCE], own[a:a + OUTPUTS_AT_ONCE])
                               for a in range(0, len(own), OUTPUTS_AT_ONCE)])
        out[group] = np.add.reduceat(logp, np.cumsum(n) - n)
    return out


def _model_ids(tokens: list[bytes], vocabulary: dict[bytes, int]) -> np.ndarray:
    return np.fromiter((vocabulary.get(t, VOCABULARY + sum(t[-3:]) % RARE_BUCKETS) for t in tokens), np.int64, len(tokens))


def _texts(indexes: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Model ids of all texts, each with its end, and their lengths."""
    lengths = sizes + 1
    out = np.full(int(lengths.sum()), END, np.int64)
    inner = np.ones(len(out), bool)
    inner[np.cumsum(lengths) - 1] = False
    out[inner] = ids[indexes]
    return out, lengths


def _row(batch: pa.RecordBatch, i: int):
    get = lambda name: batch.column(batch.schema.get_field_index(name))[i]
    ids = get("ids").values
    train = ids.field("train").to_numpy(zero_copy_only=False).astype(bool)
    sizes = get("sizes").values.to_numpy(zero_copy_only=False).astype(np.int64)
    tokens = [t for block in get("blocks").as_py() for t in unpack_tokens(block)]
    return ids.field("id"), train, sizes, indexes_of(get("indexes").as_py(), get("buckets").as_py()), tokens


def training_counts(chunks: DataFrame) -> DataFrame:
    """``chunk, at, token, n``: how often the chunk's training texts have each of its tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                _, train, sizes, indexes, tokens = _row(batch, i)
                n = np.bincount(indexes[np.repeat(train, sizes)], minlength=len(tokens))
                chunk = np.full(len(tokens), batch.column(0)[i].as_py(), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(chunk), pa.array(np.arange(len(tokens), dtype=np.int32)),
                     pa.array(tokens, pa.binary()), pa.array(n.astype(np.int64))], ["chunk", "at", "token", "n"])

    return chunks.mapInArrow(run, "chunk long, at int, token binary, n long")


def train_network(chunks: DataFrame, vocabulary: dict[bytes, int],
                  weights: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Rounds of local training on all training texts of each chunk, averaged by their tokens."""
    spark = chunks.sparkSession
    words = spark.sparkContext.broadcast(vocabulary)
    for _ in range(ROUNDS):
        shared = spark.sparkContext.broadcast(weights)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    _, train, sizes, indexes, tokens = _row(batch, i)
                    target, lengths = _texts(indexes, sizes, _model_ids(tokens, words.value))
                    target, lengths = target[np.repeat(train, lengths)], lengths[train]
                    if not len(target):
                        continue
                    flat = flatten(learn(shared.value, target, lengths)).astype(np.float64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat * len(target)),
                         pa.array(np.full(len(flat), float(len(target))))], ["at", "weight", "tokens"])

        # Every round reads the written chunks again: learning is repeatable, so a lost task only repeats its own.
        rows = (chunks.repartition(F.col("chunk")).mapInArrow(run, "at int, weight double, tokens double").groupBy("at")
                .agg((F.sum("weight") / F.sum("tokens")).alias("w")).collect())
        if rows:
            flat = np.zeros(len(rows))
            flat[[r["at"] for r in rows]] = [r["w"] for r in rows]
            weights = unflatten(flat)
    return weights


def score_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", folds: int = 10,
                    held_out_fold: int = 0) -> DataFrame:
    """``id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per row.

    ``score`` and ``base_score`` are log10 probabilities of the whole text, its
    end included, by the network and by smoothed counts; both learn from rows
    that are not held out. A rare word counts with its class's probability times
    its smoothed share of the rare words. A null text is an empty one: just an
    end. Repeated rows, null ids (fold 0) and very long texts come out as they
    went in; no rows give none; other columns are ignored.
    """
    spark = docs.sparkSession
    held = fold(id_column, folds) == held_out_fold
    rows = docs.select(F.struct(F.col(id_column).alias("id"), (~held).alias("train")).alias("id"),
                       F.col(text_column).alias("text"))
    chunks = chunk_texts(rows, "id", "text", lambda: words_of)
    same = W.partitionBy("token").orderBy("chunk", "at")
    # A token has at most one row per chunk, so no group grows with the texts.
    counted = materialize(training_counts(chunks).select(
        "chunk", "at", F.sum("n").over(W.partitionBy("token")).alias("value"),
        F.when(F.row_number().over(same) == 1, F.col("token")).alias("token")), "token-counts")
    known = counted.where("token is not null and value > 0")
    seen = known.agg(F.count("token").alias("distinct"), F.coalesce(F.sum("value"), F.lit(0)).alias("total")).first()
    texts = rows.where("id.train").count()
    total, distinct = seen["total"] + texts, seen["distinct"] + (texts > 0)
    top = known.orderBy(F.desc("value"), "token").limit(END).select("token", "value").collect()
    vocabulary = {bytes(r["token"]): i for i, r in enumerate(top)}
    rare_total = seen["total"] - sum(r["value"] for r in top)
    rare_distinct = seen["distinct"] - len(top)
    frequency = np.zeros(VOCABULARY)
    frequency[:len(top)] = [r["value"] for r in top]
    frequency[END] = texts
    weights = start_from_counts(fresh_weights(), frequency, rare_total)
    shared = spark.sparkContext.broadcast((vocabulary, train_network(chunks, vocabulary, weights)))
    id_type = docs.select(F.col(id_column)).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, weights = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                doc_ids, train, sizes, indexes, tokens = _row(batch, i)
                values = batch.column(batch.schema.get_field_index("values"))[i].values
                count = values.to_numpy(zero_copy_only=False).astype(np.float64) if len(tokens) else np.zeros(0)
                ids = _model_ids(tokens, vocabulary)
                target, lengths = _texts(indexes, sizes, ids)
                edge = np.concatenate(([0], np.cumsum(sizes)))
                per_text = lambda v: np.diff(np.concatenate(([0.0], np.cumsum(v[indexes])))[edge])
                norm = total + SMOOTH * (distinct + 1)
                base = per_text(np.log10((count + SMOOTH) / norm)) + np.log10((texts + SMOOTH) / norm)
                rare = np.where(ids >= VOCABULARY, np.log10((count + SMOOTH) / (rare_total + SMOOTH * (rare_distinct + 1))), 0)
                model = score(weights, target, lengths) / np.log(10) + per_text(rare)
                n_known = np.rint(per_text((count > 0).astype(np.float64))).astype(np.int64) + (texts > 0)
                yield pa.RecordBatch.from_arrays(
                    [doc_ids, pa.array(~train), pa.array(lengths), pa.array(n_known),
                     pa.array(np.full(len(sizes), total, np.int64)), pa.array(base), pa.array(model)],
                    ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return with_values(chunks, counted.select("chunk", "at", "value")).mapInArrow(
        run, f"id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
             "score double")
