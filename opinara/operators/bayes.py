"""Naive Bayes from sufficient statistics.

Training is one grouped sum. Multinomial and complement models keep a table
with one row per term and one column per class, so a vocabulary of any size
stays distributed; so do Gaussian and categorical models of a long table,
where a zero is an entry that is not there. Over a few named columns these two
are some numbers per (feature, class) and become literals of a projection.
"""

from __future__ import annotations

import json
import math
import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.operators.lookup import lookup_join
from opinara.operators.sampling import class_counts
from opinara.session import materialize, small_table

VAR_SMOOTHING = 1e-9
# Numbers in a term table that may be broadcast, and values of entries held at once in a task.
BROADCAST_NUMBERS = 4_000_000
ENTRIES_AT_ONCE = 2_000_000


def alpha_grid(low: float = 0.01, high: float = 1.0, step: float = 0.01) -> list[float]:
    """Evenly spaced values from ``low`` up to and including ``high``."""
    n = math.ceil((high + step / 2 - low) / step)
    return [round(low + i * step, 4) for i in range(n)]


def pick_label(df: DataFrame, scores: list[Column], labels: list, prediction: str) -> DataFrame:
    """Add the label of the highest score; the first one wins a tie.

    The scores become a column of their own first, so each is computed once.
    """
    return pick_scored(df.withColumn("__scores", F.array(*scores)), labels, prediction)


def pick_scored(df: DataFrame, labels: list, prediction: str) -> DataFrame:
    """The label of the highest of ``__scores``, which go."""
    best = F.array_position("__scores", F.array_max("__scores")).cast("int")
    return df.withColumn(prediction, F.element_at(F.array(*[F.lit(c) for c in labels]), best)).drop("__scores")


@dataclass
class TermBayes:
    """Multinomial or complement naive Bayes over a long ``(key, term, weight)`` table."""

    kind: str
    key: str
    labels: list
    rows: dict
    terms: DataFrame
    n_terms: int
    totals: dict

    @property
    def priors(self) -> dict:
        n = sum(self.rows.values())
        return {c: math.log(self.rows[c] / n) for c in self.labels}

    def predict(self, keys: DataFrame, weights: DataFrame, alphas: list[float]) -> DataFrame:
        """``(key, alpha, prediction)`` for every row of ``keys`` and every alpha.

        Every alpha scores in the same pass and no row is repeated for it: an
        entry becomes an array of log masses (class x alpha), and a document is
        the sum of its arrays. Rows without any known term get the prior
        (multinomial) or the first label (complement).
        """
        labels = range(len(self.labels))
        masses = [self._mass(i).alias(f"m{i}") for i in labels]
        known = lookup_join(weights.select(self.key, "term", "weight"), self.terms.select("term", "total", *masses), "term", "total")
        mass = np.array([self.totals[c] for c in self.labels], float)
        mass = mass if self.kind == "multinomial" else mass.sum() - mass
        norm = np.log(mass[:, None] + np.array(alphas) * self.n_terms)
        sign = 1.0 if self.kind == "multinomial" else -1.0
        prior = np.array([self.priors[c] for c in self.labels])
        prior = prior if self.kind == "multinomial" or len(self.labels) == 1 else np.zeros(len(prior))

        def entry(columns, grid):
            return columns[0][:, None, None] * np.log(np.stack(columns[1:], axis=1)[:, :, None] + grid)

        def score(sums, length):
            return prior[:, None] + sign * (sums - length[:, None, None] * norm)
        return fold_alphas(keys, known, self.key, self.labels, alphas, ["weight", *[f"m{i}" for i in labels]], entry, score)

    def save(self, path: str) -> None:
        _save_state(path, {"kind": self.kind, "key": self.key, "labels": self.labels,
                           "rows": list(self.rows.items()), "n_terms": self.n_terms,
                           "totals": list(self.totals.items())})
        self.terms.write.mode("overwrite").parquet(os.path.join(path, "terms"))

    def _mass(self, i: int) -> Column:
        own = F.col(f"c{i}")
        return own if self.kind == "multinomial" else F.col("total") - own


def fold_alphas(keys: DataFrame, facts: DataFrame, key: str, labels: list, alphas: list[float], columns: list[str],
                entry: Callable, score: Callable) -> DataFrame:
    """``(key, alpha, prediction)`` for every row of ``keys``, each fact crossing once whatever the number of alphas.

    Facts are sorted by key; ``entry`` makes (fact x class x alpha) values from
    their ``columns``, the first of which is also summed to a length, and ``score(sums, length)`` the scores of a key.
    A key without facts has sums of zero.
    """
    grid, n_labels = np.array(alphas, float), len(labels)
    kind = facts.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), T.StructField("__best", T.ArrayType(T.IntegerType()))])
    at_once = max(1, ENTRIES_AT_ONCE // (n_labels * len(alphas)))

    def best(sums: np.ndarray, length: np.ndarray) -> np.ndarray:
        return score(sums, length).argmax(axis=1).astype(np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sums, length = None, None, None  # the key that the next batch may go on with

        def done(names, sums, length):
            chosen = best(sums, length)
            ends = np.arange(len(chosen) + 1, dtype=np.int32) * len(grid)
            return pa.RecordBatch.from_arrays([names, pa.ListArray.from_arrays(pa.array(ends), pa.array(chosen.ravel()))], [key, "__best"])

        for batch in batches:
            for start in range(0, batch.num_rows, at_once):
                part = batch.slice(start, at_once)
                names = part.column(0)
                values = [c.to_numpy(zero_copy_only=False).astype(float) for c in part.columns[1:]]
                changes = pc.not_equal(names.slice(1), names.slice(0, len(names) - 1)).to_numpy(zero_copy_only=False)
                first = np.concatenate(([0], np.flatnonzero(changes) + 1))
                found = np.add.reduceat(entry(values, grid), first, axis=0)
                lengths = np.add.reduceat(values[0], first)
                if last is not None and names[0].as_py() == last[0].as_py():
                    found[0] += sums[0]
                    lengths[0] += length[0]
                elif last is not None:
                    yield done(last, sums, length)
                if len(first) > 1:
                    yield done(names.take(pa.array(first[:-1])), found[:-1], lengths[:-1])
                last, sums, length = names.slice(int(first[-1]), 1), found[-1:], lengths[-1:]
        if last is not None:
            yield done(last, sums, length)

    sorted_facts = facts.filter(F.col(key).isNotNull()).select(key, *columns).repartition(key).sortWithinPartitions(key)
    chosen = sorted_facts.mapInArrow(run, schema)
    without = best(np.zeros((1, n_labels, len(alphas))), np.zeros(1))[0].tolist()
    rows = keys.select(key).join(chosen, key, "left").select(
        key, F.posexplode(F.coalesce("__best", F.array(*map(F.lit, without)))).alias("__at", "__label"))
    pick = lambda values, at: F.element_at(F.array(*map(F.lit, values)), at + 1)
    return rows.select(key, pick([float(a) for a in alphas], F.col("__at")).alias("alpha"), pick(labels, F.col("__label")).alias("prediction"))


def fit_term_bayes(labelled: DataFrame, weights: DataFrame, key: str, target: str,
                   kind: str = "multinomial", n_terms: int | None = None) -> TermBayes:
    """Sum the weights per (term, class); ``labelled`` is ``(key, target)``.

    ``n_terms`` is the size of the vocabulary the weights were made with, where
    it may hold terms that none of these rows has (balanced rows); by default
    the terms found are counted.
    """
    if kind not in ("multinomial", "complement"):
        raise ValueError(f"unknown naive Bayes kind {kind!r}")
    rows = class_counts(labelled, target)
    labels = sorted(rows)
    facts = weights.select(key, "term", "weight").join(labelled.select(key, target), key)
    terms = materialize(facts.groupBy("term").agg(
        F.sum("weight").alias("total"),
        *[F.sum(F.when(F.col(target) == F.lit(c), F.col("weight")).otherwise(0.0)).alias(f"c{i}")
          for i, c in enumerate(labels)]), "term-classes")
    sums = terms.agg(F.count("*").alias("n"), *[F.sum(f"c{i}").alias(f"c{i}") for i in range(len(labels))]).first()
    return TermBayes(kind, key, labels, rows, terms, sums["n"] if n_terms is None else n_terms,
                     {c: sums[f"c{i}"] or 0.0 for i, c in enumerate(labels)})


@dataclass
class GaussianBayes:
    labels: list
    features: list[str]
    rows: dict
    mean: dict
    var: dict

    def predict(self, df: DataFrame, prediction: str = "prediction") -> DataFrame:
        n = sum(self.rows.values())
        scores = []
        for c in self.labels:
            score = F.lit(math.log(self.rows[c] / n))
            for f in self.features:
                m, v = self.mean[c, f], self.var[c, f]
                gap = F.col(f).cast("double") - F.lit(m)
                score = score - F.lit(0.5 * math.log(2 * math.pi * v)) - gap * gap / F.lit(2 * v)
            scores.append(score)
        return pick_label(df, scores, self.labels, prediction)

    def save(self, path: str) -> None:
        _save_state(path, {"kind": "gaussian", "labels": self.labels, "features": self.features,
                           "rows": list(self.rows.items()),
                           "stats": [[c, f, m, self.var[c, f]] for (c, f), m in self.mean.items()]})


@dataclass
class LongGaussian:
    """Gaussian naive Bayes over a long table: every (row, term) not listed is a zero, and none is ever written.

    ``terms`` has ``m{i}`` and ``v{i}``, mean and smoothed variance of each
    class; ``base`` is the score of a row of zeros.
    """

    key: str
    labels: list
    rows: dict
    terms: DataFrame
    base: list[float]

    def predict(self, keys: DataFrame, weights: DataFrame, prediction: str = "prediction") -> DataFrame:
        """``(key, prediction)`` for every row of ``keys``: what its entries change in the score of a row of zeros."""
        n = sum(self.rows.values())
        known = lookup_join(weights.select(self.key, "term", "weight"), self.terms, "term", "uses", BROADCAST_NUMBERS // (2 * len(self.labels) + 1))
        x = F.col("weight")
        moved = [F.sum(x * (2 * F.col(f"m{i}") - x) / (2 * F.col(f"v{i}"))).alias(f"s{i}") for i in range(len(self.labels))]
        folded = keys.select(self.key).join(known.groupBy(self.key).agg(*moved), self.key, "left")
        scores = [F.lit(math.log(self.rows[c] / n) + self.base[i]) + F.coalesce(F.col(f"s{i}"), F.lit(0.0))
                  for i, c in enumerate(self.labels)]
        return pick_label(folded, scores, self.labels, prediction).select(self.key, prediction)

    def save(self, path: str) -> None:
        _save_state(path, {"kind": "long-gaussian", "key": self.key, "labels": self.labels, "rows": list(self.rows.items()), "base": self.base})
        self.terms.write.mode("overwrite").parquet(os.path.join(path, "terms"))


def _facts(labelled: DataFrame, weights: DataFrame, key: str, target: str) -> DataFrame:
    return weights.select(key, "term", "weight").join(labelled.select(key, target), key)


def fit_long_gaussian(labelled: DataFrame, weights: DataFrame, key: str, target: str) -> LongGaussian:
    """Moments per (term, class) with the zeros added from the class sizes.

    Variances come from a second pass around the means, so a narrow spread far
    from zero keeps its digits; they are smoothed by the widest term.
    """
    rows = class_counts(labelled, target)
    labels, n = sorted(rows), sum(rows.values())
    facts = materialize(_facts(labelled, weights, key, target), "bayes-facts")
    own = [F.col(target) == F.lit(c) for c in labels]
    sums = materialize(facts.groupBy("term").agg(F.count("*").alias("uses"), *[
        f for i, is_own in enumerate(own) for f in (F.count_if(is_own).alias(f"n{i}"),
                                                    (F.sum(F.when(is_own, F.col("weight")).otherwise(0.0)) / float(rows[labels[i]])).alias(f"m{i}"))]),
        "bayes-means")
    near = lookup_join(facts, sums, "term", "uses", BROADCAST_NUMBERS // (2 * len(labels) + 1))
    squares = near.groupBy("term").agg(*[F.sum(F.when(is_own, (F.col("weight") - F.col(f"m{i}")) ** 2).otherwise(0.0)).alias(f"q{i}")
                                         for i, is_own in enumerate(own)])
    spread = [(F.col(f"q{i}") + (rows[c] - F.col(f"n{i}")) * F.col(f"m{i}") ** 2) / float(rows[c]) for i, c in enumerate(labels)]
    mean = sum(F.col(f"m{i}") * float(rows[c]) for i, c in enumerate(labels)) / float(n)
    overall = sum((spread[i] + (F.col(f"m{i}") - mean) ** 2) * float(rows[c]) for i, c in enumerate(labels)) / float(n)
    raw = materialize(sums.join(squares, "term").select("term", "uses", *[f"m{i}" for i in range(len(labels))],
                                                        *[spread[i].alias(f"v{i}") for i in range(len(labels))], overall.alias("all")), "bayes-raw")
    extra = VAR_SMOOTHING * (raw.agg(F.max("all")).first()[0] or 0.0)
    terms = raw.drop("all").withColumns({f"v{i}": F.col(f"v{i}") + F.lit(extra) for i in range(len(labels))})
    zero = [F.sum(-0.5 * F.log(2 * math.pi * F.col(f"v{i}")) - F.col(f"m{i}") ** 2 / (2 * F.col(f"v{i}"))) for i in range(len(labels))]
    base = terms.agg(*[z.alias(f"b{i}") for i, z in enumerate(zero)]).first()
    return LongGaussian(key, labels, rows, terms, [base[i] or 0.0 for i in range(len(labels))])


@dataclass
class LongCategorical:
    """Categorical naive Bayes over a long table whose weights, rounded down, are codes; an entry not listed has code 0.

    ``terms`` has ``z{i}``, rows of class i with code 0, ``size``, the number of
    codes, and the counts of the codes found: ``codes`` and, in the same order,
    ``c{i}``.
    """

    key: str
    labels: list
    rows: dict
    terms: DataFrame

    def predict(self, keys: DataFrame, weights: DataFrame, alphas: list[float]) -> DataFrame:
        """``(key, alpha, prediction)`` for every row and alpha; a code not seen in training has a count of zero."""
        labels, n = range(len(self.labels)), sum(self.rows.values())
        coded = _coded(weights.select(self.key, "term", "weight"))
        known = lookup_join(coded, self.terms, "term", "uses", BROADCAST_NUMBERS // (8 * len(self.labels)))
        at = F.array_position("codes", F.col("weight").cast("int"))
        seen = known.select(self.key, "weight", *[F.coalesce(F.get(f"c{i}", (at - 1).cast("int")), F.lit(0)).alias(f"k{i}") for i in labels],
                            *[f"z{i}" for i in labels])
        base = np.array([math.log(self.rows[c] / n) for c in self.labels])[:, None] + self._zeros(alphas)

        # A row of zeros first; every entry then replaces the count of its zero. The denominators are the same.
        def entry(columns, grid):
            counts, zeros = np.stack(columns[1:], axis=1).reshape(len(columns[0]), 2, -1, 1).swapaxes(0, 1)
            return np.log(counts + grid) - np.log(zeros + grid)

        def score(sums, length):
            return base + sums
        names = ["weight", *[f"k{i}" for i in labels], *[f"z{i}" for i in labels]]
        return fold_alphas(keys, seen, self.key, self.labels, alphas, names, entry, score)

    def _zeros(self, alphas: list[float]) -> np.ndarray:
        """(class x alpha): the log probability of a row of zeros, summed in the tasks."""
        grid, rows = np.array(alphas, float), np.array([self.rows[c] for c in self.labels], float)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((len(rows), len(grid)))
            for batch in batches:
                size, *zeros = [c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]
                for z in range(len(zeros)):
                    for j, alpha in enumerate(grid):
                        total[z, j] += (np.log(zeros[z] + alpha) - np.log(rows[z] + alpha * size)).sum()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["at", "total"])

        parts = self.terms.select("size", *[f"z{i}" for i in range(len(rows))]).mapInArrow(run, "at long, total double")
        found = np.zeros(len(rows) * len(grid))
        for row in parts.groupBy("at").agg(F.sum("total").alias("total")).collect():
            found[row["at"]] = row["total"]
        return found.reshape(len(rows), len(grid))

    def save(self, path: str) -> None:
        _save_state(path, {"kind": "long-categorical", "key": self.key, "labels": self.labels, "rows": list(self.rows.items())})
        self.terms.write.mode("overwrite").parquet(os.path.join(path, "terms"))


def _coded(weights: DataFrame) -> DataFrame:
    return weights.withColumn("weight", F.floor("weight").cast("double")).filter(F.col("weight") > 0)


def fit_long_categorical(labelled: DataFrame, weights: DataFrame, key: str, target: str) -> LongCategorical:
    """Counts per (term, class, code); those of code 0 are what is left of the class."""
    rows = class_counts(labelled, target)
    labels = sorted(rows)
    # Terms of which all weights round down to 0 are features too, with one code.
    known = weights.select("term").distinct()
    facts = _coded(_facts(labelled, weights, key, target))
    cells = facts.groupBy("term", F.col("weight").cast("int").alias("code")).agg(
        *[F.count_if(F.col(target) == F.lit(c)).alias(f"c{i}") for i, c in enumerate(labels)], F.count("*").alias("n"))
    listed = cells.groupBy("term").agg(F.array_sort(F.collect_list(F.struct("code", *[f"c{i}" for i in range(len(labels))]))).alias("e"),
                                       F.sum("n").alias("uses"), F.max("code").alias("most"),
                                       *[F.sum(f"c{i}").alias(f"t{i}") for i in range(len(labels))])
    zero = [(F.lit(rows[c]) - F.coalesce(F.col(f"t{i}"), F.lit(0))).alias(f"z{i}") for i, c in enumerate(labels)]
    counts = [F.coalesce(F.col(f"e.c{i}"), F.array().cast("array<bigint>")).alias(f"c{i}") for i in range(len(labels))]
    terms = known.join(listed, "term", "left").select(
        "term", F.coalesce("uses", F.lit(0)).alias("uses"), (F.coalesce("most", F.lit(0)) + 1).alias("size"), *zero,
        F.coalesce("e.code", F.array().cast("array<int>")).alias("codes"), *counts)
    return LongCategorical(key, labels, rows, materialize(terms, "bayes-codes"))


def _save_state(path: str, state: dict) -> None:
    small_table(SparkSession.active(), [(json.dumps(state),)], "state string").write.mode("overwrite").parquet(
        os.path.join(path, "state"))


def load_bayes(spark: SparkSession, path: str) -> TermBayes | GaussianBayes | CategoricalBayes | LongGaussian | LongCategorical:
    """Read back whichever model was saved."""
    state = json.loads(spark.read.parquet(os.path.join(path, "state")).first()["state"])
    rows = {c: n for c, n in state["rows"]}
    if state["kind"] == "gaussian":
        mean = {(c, f): m for c, f, m, _ in state["stats"]}
        var = {(c, f): v for c, f, _, v in state["stats"]}
        return GaussianBayes(state["labels"], state["features"], rows, mean, var)
    if state["kind"] == "long-gaussian":
        return LongGaussian(state["key"], state["labels"], rows, spark.read.parquet(os.path.join(path, "terms")), state["base"])
    if state["kind"] == "long-categorical":
        return LongCategorical(state["key"], state["labels"], rows, spark.read.parquet(os.path.join(path, "terms")))
    if state["kind"] == "categorical":
        counts = {(c, f, b): n for c, f, b, n in state["counts"]}
        return CategoricalBayes(state["labels"], state["features"], rows, counts, state["sizes"])
    return TermBayes(state["kind"], state["key"], state["labels"], rows,
                     spark.read.parquet(os.path.join(path, "terms")), state["n_terms"],
                     {c: v for c, v in state["totals"]})


def fit_gaussian(df: DataFrame, features: list[str], target: str) -> GaussianBayes:
    """Mean and population variance per (class, feature), smoothed by the widest feature."""
    rows = class_counts(df, target)
    stats = df.filter(F.col(target).isNotNull()).groupBy(target).agg(
        *[F.avg(F.col(f).cast("double")).alias(f"m_{f}") for f in features],
        *[F.var_pop(F.col(f).cast("double")).alias(f"v_{f}") for f in features]).collect()
    widest = df.filter(F.col(target).isNotNull()).agg(
        F.greatest(*[F.var_pop(F.col(f).cast("double")) for f in features], F.lit(0.0))).first()[0]
    extra = VAR_SMOOTHING * widest
    mean = {(r[target], f): r[f"m_{f}"] for r in stats for f in features}
    var = {(r[target], f): r[f"v_{f}"] + extra for r in stats for f in features}
    return GaussianBayes(sorted(rows), features, rows, mean, var)


@dataclass
class CategoricalBayes:
    labels: list
    features: list[str]
    rows: dict
    counts: dict
    sizes: dict

    def predict(self, df: DataFrame, alpha: float = 1.0, prediction: str = "prediction") -> DataFrame:
        return self.predict_many(df, [alpha], prediction).drop("alpha")

    def predict_many(self, df: DataFrame, alphas: list[float], prediction: str = "prediction") -> DataFrame:
        """The rows once per alpha, with ``alpha`` and the prediction, in one scan."""
        alpha = F.col("alpha")
        n = sum(self.rows.values())
        scores = []
        for c in self.labels:
            score = F.lit(math.log(self.rows[c] / n))
            for f in self.features:
                table = [float(self.counts.get((c, f, b), 0)) for b in range(self.sizes[f])]
                seen = F.get(F.expr("array(" + ", ".join(f"{x}D" for x in table) + ")"), F.col(f).cast("int"))
                score = score + F.log(F.coalesce(seen, F.lit(0.0)) + alpha) - F.log(
                    F.lit(float(self.rows[c])) + alpha * F.lit(float(self.sizes[f])))
            scores.append(score)
        grid = F.explode(F.array(*[F.lit(float(a)) for a in alphas])).alias("alpha")
        return pick_label(df.select("*", grid), scores, self.labels, prediction)

    def save(self, path: str) -> None:
        _save_state(path, {"kind": "categorical", "labels": self.labels, "features": self.features,
                           "rows": list(self.rows.items()), "sizes": self.sizes,
                           "counts": [[*k, n] for k, n in self.counts.items()]})


# Codes of one categorical feature; a learnt table is a literal of the plan.
MAX_CODES = 10_000


def fit_categorical(df: DataFrame, features: list[str], target: str) -> CategoricalBayes:
    """Counts per (class, feature, code); codes run from 0 to the largest seen."""
    rows = class_counts(df, target)
    top = df.agg(*[F.max(F.col(f).cast("int")).alias(f) for f in features]).first()
    sizes = {f: (top[f] if top[f] is not None else -1) + 1 for f in features}
    if max(sizes.values()) > MAX_CODES:
        raise ValueError("a feature has too many codes for categorical naive Bayes; bin it first")
    pairs = F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).cast("int").alias("b")) for f in features])
    found = (df.filter(F.col(target).isNotNull()).select(target, F.explode(pairs).alias("p"))
             .groupBy(target, "p.f", "p.b").agg(F.count("*").alias("n")).collect())
    return CategoricalBayes(sorted(rows), features, rows,
                            {(r[target], r["f"], r["b"]): r["n"] for r in found if r["b"] is not None}, sizes)
