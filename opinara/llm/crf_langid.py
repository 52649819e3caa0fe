"""Language identification by a linear-chain conditional random field over words.

Every word has affix and n-gram features (of the word between two marks, so a
leading or trailing n-gram is an affix), and a lexicon feature. Transitions
between the labels of neighbouring words are learned, and forward-backward gives
every word of a text its label, also where the text switches its language. A
document's language is the one with the largest mean marginal.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.batches import Codes, Lanes, groups
from opinara.llm.common import seeded, text_or_empty
from opinara.llm.gru import Adam

GRAMS, BUCKETS = (2, 3, 4, 5), 1 << 15
#: The bound of the training sample: documents of each language, and characters in one of them.
SAMPLE_PER_LANGUAGE, SAMPLE_CHARS, MAX_LANGUAGES = 250, 100_000, 1000
#: Words in a training sequence; every other one switches its language at a random place.
SEQUENCE, EPOCHS, BATCH, RATE, DECAY, SEED = 64, 6, 128, 0.02, 1e-4, 42
#: Documents that make a word known to the lexicon.
LEXICON_DOCUMENTS = 3
#: Words labelled at once in a task, and distinct words whose scores a task remembers.
WORDS_AT_ONCE, REMEMBERED = 300_000, 500_000
UNDETERMINED = "und"
_EDGES = ".,;:!?\"'()[]{}<>*#$%&|-_~`/\\0123456789"


def normal(word: str) -> str:
    return word.lower().strip(_EDGES)


def features(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words' marked n-grams, and which word each belongs to."""
    marked = [b"\x02" + w.encode() + b"\x03" for w in words]
    lengths = np.fromiter(map(len, marked), np.int64, len(marked))
    data = np.frombuffer(b"".join(marked) + bytes(max(GRAMS)), np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(marked)), lengths)
    end = np.repeat(np.cumsum(lengths), lengths)
    at = np.arange(len(owner))
    buckets, owners = [], []
    for n in GRAMS:
        value = np.full(len(owner), n, np.uint64)
        for k in range(n):
            value = value * np.uint64(257) + data[k:k + len(owner)]
        inside = at + n <= end
        value = (value[inside] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 15)
        buckets.append(value.astype(np.int64) % BUCKETS)
        owners.append(owner[inside])
    return np.concatenate(buckets), np.concatenate(owners)


class LanguageField:
    """Feature weights, transitions and the lexicon for a fixed list of languages."""

    def __init__(self, languages: Sequence[str], lexicon: dict[str, np.ndarray]):
        n = len(languages)
        self.languages, self.lexicon = list(languages), lexicon
        self.weights = {"grams": np.zeros((BUCKETS, n)), "lexicon": np.full(1, 0.3), "bias": np.zeros(n),
                        "move": np.zeros((n, n)), "start": np.zeros(n)}
        self._forget()

    def _forget(self) -> None:
        self._codes, self._scores = Codes(), np.zeros((0, len(self.languages)), np.float32)

    def __getstate__(self):
        return {"languages": self.languages, "lexicon": self.lexicon, "weights": self.weights}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._forget()

    def known(self, words: Sequence[str]) -> np.ndarray:
        """Lexicon features of normal words, zero for those it does not know."""
        out = np.zeros((len(words), len(self.languages)))
        for i, w in enumerate(words):
            if (row := self.lexicon.get(w)) is not None:
                out[i] = row
        return out

    def emissions(self, grams, known: np.ndarray) -> np.ndarray:
        """Per word its score for every language."""
        buckets, owner = grams
        n = len(self.languages)
        out = np.stack([np.bincount(owner, self.weights["grams"][buckets, l], len(known)) for l in range(n)], axis=1)
        return out + self.weights["lexicon"][0] * known + self.weights["bias"]

    def score_words(self, texts: Sequence[Sequence[str]]) -> np.ndarray:
        """Scores of all words of the texts, one after the other."""
        if len(self._codes) > REMEMBERED:
            self._forget()
        before = len(self._codes)
        flat = self._codes.of(texts)
        if len(self._codes) > before:
            new = list(map(normal, islice(self._codes, before, None)))
            scores = self.emissions(features(new), self.known(new)).astype(np.float32)
            self._scores = np.concatenate((self._scores, scores))
        return self._scores[flat]

    def forward_backward(self, scores: np.ndarray, lengths: np.ndarray, with_moves: bool = False):
        """Marginals of every word's label; with the expected moves between labels and the log-likelihood's part.

        States are scaled at every step. Sequences run side by side in lanes.
        """
        n = len(self.languages)
        lanes = Lanes(lengths)
        top = scores.max(axis=1, keepdims=True) if len(scores) else scores
        emit = np.exp(scores - top)[lanes.place] if len(scores) else np.zeros((0, 1, n))
        move, start = np.exp(self.weights["move"]).astype(emit.dtype), np.exp(self.weights["start"]).astype(emit.dtype)
        steps, width = lanes.place.shape
        ahead, scale = np.empty((steps, width, n), emit.dtype), np.ones((steps, width), emit.dtype)
        state = np.zeros((width, n), emit.dtype)
        for t in range(steps):
            k = lanes.active[t]
            state = np.where(lanes.first[t, :k, None], start, state[:k] @ move) * emit[t, :k]
            scale[t, :k] = state.sum(axis=1)
            state = state / scale[t, :k, None]
            ahead[t, :k] = state
        marginal = np.empty((len(scores), n), emit.dtype)
        moves = np.zeros((n, n))
        after = np.ones((width, n), emit.dtype)
        for t in reversed(range(steps)):
            k = lanes.active[t]
            back = np.where(lanes.last[t, :k, None], emit.dtype.type(1), after[:k])
            both = ahead[t, :k] * back
            marginal[lanes.place[t, :k]] = both / both.sum(axis=1, keepdims=True)
            weighted = back * emit[t, :k] / scale[t, :k, None]
            if with_moves and t:
                inner = ~lanes.first[t, :k]
                moves += (ahead[t - 1, :k][inner].T @ weighted[inner]) * move
            after[:k] = weighted @ move.T
        if with_moves:
            return marginal, moves, float(np.log(scale).sum() + (top.sum() if len(scores) else 0))
        return marginal

    def label(self, texts: Sequence[Sequence[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Marginals of all words of the texts, one after the other, and the texts' lengths."""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        return self.forward_backward(self.score_words(texts), lengths), lengths


def sequences(texts: Sequence[np.ndarray], labels: Sequence[int], random) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Training sequences of words and labels: pieces of texts, half of them joined from two texts."""
    pieces = [(t[a:a + SEQUENCE], y) for t, y in zip(texts, labels) for a in range(0, len(t), SEQUENCE)]
    order = random.permutation(len(pieces))
    words, marks, lengths = [], [], []
    for i, p in enumerate(order):
        piece, y = pieces[p]
        mark = np.full(len(piece), y)
        if i % 2:
            other, z = pieces[order[random.integers(len(order))]]
            cut = int(random.integers(1, SEQUENCE))
            piece = np.concatenate((piece[:cut], other[:SEQUENCE - cut]))
            mark = np.concatenate((mark[:cut], np.full(len(piece) - len(mark[:cut]), z)))
        words.append(piece)
        marks.append(mark)
        lengths.append(len(piece))
    return words, marks, np.array(lengths, np.int64)


def gradient(model: LanguageField, grams, known, flat: np.ndarray, mark: np.ndarray, lengths: np.ndarray):
    """Mean negative log-likelihood per word of labelled sequences, and its gradient."""
    w, n = model.weights, len(model.languages)
    used, where = np.unique(flat, return_inverse=True)
    scores = model.emissions(grams, known)
    marginal, moves, norm = model.forward_backward(scores[where], lengths, with_moves=True)
    begin = np.cumsum(lengths) - lengths
    inner = np.ones(len(flat), bool)
    inner[begin] = False
    seen = np.zeros((n, n))
    np.add.at(seen, (mark[np.flatnonzero(inner) - 1], mark[inner]), 1)
    starts = np.bincount(mark[begin], minlength=n)
    likelihood = scores[where, mark].sum() + (seen * w["move"]).sum() + (starts * w["start"]).sum() - norm
    diff = marginal.copy()
    diff[np.arange(len(flat)), mark] -= 1
    by_word = np.stack([np.bincount(where, diff[:, l], len(used)) for l in range(n)], axis=1)
    buckets, owner = grams
    size = len(flat)
    return -likelihood / size, {
        "grams": np.stack([np.bincount(buckets, by_word[owner, l], BUCKETS) for l in range(n)], axis=1) / size,
        "lexicon": np.array([(by_word * known).sum()]) / size, "bias": by_word.sum(axis=0) / size,
        "move": (moves - seen) / size, "start": (marginal[begin].sum(axis=0) - starts) / size}


def train(texts: Sequence[str], labels: Sequence[str]) -> LanguageField:
    """A field fitted to texts of known language; the same texts in the same order give the same field."""
    rows = [(t.split(), y) for t, y in zip(texts, labels)]
    rows = [(t, y) for t, y in rows if t]
    languages = sorted({y for _, y in rows})
    number = {y: i for i, y in enumerate(languages)}
    in_documents, in_language = Counter(), Counter()
    for words, y in rows:
        own = {normal(w) for w in words}
        in_documents.update(own)
        in_language.update((w, y) for w in own)
    per_language = Counter(y for _, y in rows)
    lexicon = {}
    for w, n in in_documents.items():
        if n >= LEXICON_DOCUMENTS and w:
            share = np.log(np.array([(in_language[w, y] + 0.5) / (per_language[y] + 1) for y in languages]))
            lexicon[w] = share - share.mean()
    model = LanguageField(languages, lexicon)
    if not rows:
        return model
    random = np.random.default_rng(SEED)
    codes = Codes()
    flat = codes.of([t for t, _ in rows])
    cuts = np.cumsum([len(t) for t, _ in rows])[:-1]
    names = [normal(w) for w in codes]
    known = model.known(names)
    adam = Adam(model.weights, RATE)
    for _ in range(EPOCHS):
        words, marks, lengths = sequences(np.split(flat, cuts), [number[y] for _, y in rows], random)
        for at in range(0, len(words), BATCH):
            some = slice(at, at + BATCH)
            part = np.concatenate(words[some])
            used = np.unique(part)
            _, g = gradient(model, features([names[u] for u in used]), known[used], part,
                            np.concatenate(marks[some]), lengths[some])
            g = {k: v + DECAY * model.weights[k] for k, v in g.items()}
            adam.update(g)
    return model


def labelled_sample(docs: DataFrame, trainable: Column, id_column: str = "doc_id", text_column: str = "text",
                    label_column: str = "lang") -> tuple[list[str], list[str]]:
    """About ``SAMPLE_PER_LANGUAGE`` texts of each language, drawn by a seeded hash of the id."""
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"),
                       F.col(label_column).cast("string").alias("label"))
    rows = rows.where(trainable & F.col("label").isNotNull())
    # Counted without the texts; the draw is a threshold, so the sample keeps about its expected size.
    counts = rows.groupBy("label").count().limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    limit = F.lit(0.0)
    for r in counts:
        limit = F.when(F.col("label") == r["label"], min(1.0, SAMPLE_PER_LANGUAGE / r["count"])).otherwise(limit)
    drawn = rows.where((seeded(SEED, F.col("id").cast("string")).cast("double") / 2.0 ** 63 < limit)
                       & F.col("text").isNotNull() & (F.length("text") <= SAMPLE_CHARS)).collect()
    drawn.sort(key=lambda r: (r["id"] is not None, r["id"], r["text"]))
    return [r["text"] for r in drawn], [r["label"] for r in drawn]


def fit(docs: DataFrame, trainable: Column | None = None, id_column: str = "doc_id", text_column: str = "text",
        label_column: str = "lang") -> LanguageField:
    """A field from rows with a language whose ``id`` satisfies ``trainable`` (all by default)."""
    return train(*labelled_sample(docs, F.lit(True) if trainable is None else trainable, id_column, text_column,
                                  label_column))


def identify(docs: DataFrame, model: LanguageField, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, lang_pred, score, span_langs, span_words`` per row.

    ``score`` is the mean marginal of the predicted language; the spans are runs
    of words with one label, in order. A text that is null or has no letter is
    ``und`` with score 0 and no spans. Rows are judged one by one: repeated rows,
    null ids and very long texts come out as they went in; no rows give none;
    other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text = text_or_empty(text_column)
    rows = docs.select(F.col(id_column).alias("id"), F.when(text.rlike(r"\p{L}"), text).otherwise("").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for batch in batches:
            n = batch.num_rows
            best, score = [UNDETERMINED] * n, np.zeros(n)
            langs: list[list[str]] = [[] for _ in range(n)]
            counts: list[list[int]] = [[] for _ in range(n)]
            texts = batch.column(1)
            sizes = np.array([len(t.as_py()) for t in texts], np.int64)
            for group in groups(sizes, WORDS_AT_ONCE * 6):
                split = [(i, texts[i].as_py().split()) for i in group.tolist() if sizes[i]]
                if not split or not field.languages:
                    continue
                marginal, lengths = field.label([t for _, t in split])
                begin = np.cumsum(lengths) - lengths
                means = np.add.reduceat(marginal, begin, axis=0, dtype=np.float64) / lengths[:, None]
                label = marginal.argmax(axis=1)
                change = np.concatenate(([True], label[1:] != label[:-1]))
                change[begin] = True
                runs = np.flatnonzero(change)
                run_words = np.diff(np.append(runs, len(label))).tolist()
                run_label = [field.languages[l] for l in label[runs]]
                edge = np.searchsorted(runs, np.append(begin, len(label)))
                for j, (i, _) in enumerate(split):
                    best[i], score[i] = field.languages[int(means[j].argmax())], min(1.0, means[j].max())
                    langs[i], counts[i] = run_label[edge[j]:edge[j + 1]], run_words[edge[j]:edge[j + 1]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(best), pa.array(score), pa.array(langs, pa.list_(pa.string())),
                 pa.array(counts, pa.list_(pa.int64()))], ["id", "lang_pred", "score", "span_langs", "span_words"])

    return rows.mapInArrow(run, f"id {id_type}, lang_pred string, score double, span_langs array<string>, "
                                "span_words array<long>")
