"""Training, model choice, saving and blind evaluation."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.operators import bayes, learners, metrics, neighbors, sampling
from opinara.operators.sparse_neighbors import sparse_knn, sparse_smote
from opinara.plans.config import JobConfig
from opinara.plans.preprocess import Preprocessor, balance, dense, fit_preprocessor
from opinara.session import materialize, small_table


@dataclass
class Model:
    """The winner of a grid: an algorithm, its parameters, and what it learnt."""

    algorithm: str
    name: str
    params: dict
    state: object

    def predict(self, pre: Preprocessor, raw: DataFrame) -> DataFrame:
        """``(key, prediction)`` for raw rows."""
        return _KINDS[self.algorithm].predict(self, pre, raw)

    def save(self, path: str) -> None:
        about = {"algorithm": self.algorithm, "name": self.name, "params": self.params}
        spark = SparkSession.active()
        small_table(spark, [(json.dumps(about),)], "about string").write.mode("overwrite").parquet(os.path.join(path, "about"))
        _KINDS[self.algorithm].save(self, os.path.join(path, "state"))

    @staticmethod
    def load(spark: SparkSession, path: str) -> Model:
        about = json.loads(spark.read.parquet(os.path.join(path, "about")).first()["about"])
        model = Model(about["algorithm"], about["name"], about["params"], None)
        model.state = _KINDS[model.algorithm].load(spark, model, os.path.join(path, "state"))
        return model


@dataclass
class Outcome:
    """A finished grid: the trial table, the winner, and the rows held back."""

    trials: DataFrame
    model: Model
    preprocessor: Preprocessor
    test: DataFrame | None = None

    @property
    def log(self) -> DataFrame:
        return metrics.trial_log(self.trials, "Combinacion")

    def save(self, path: str) -> None:
        self.preprocessor.save(os.path.join(path, "preprocessing"))
        self.model.save(os.path.join(path, "model"))


@dataclass
class _Job:
    """What a grid works on."""

    config: JobConfig
    pre: Preprocessor
    train_raw: DataFrame
    dev_raw: DataFrame

    def __post_init__(self):
        self.key, self.target = self.pre.key, self.pre.target

    def vectors(self) -> tuple[DataFrame, DataFrame]:
        train = balance(self.config, self.pre.transform(self.train_raw), self.key, self.target)
        return train, self.pre.transform(self.dev_raw)

    def score(self, predictions: DataFrame, by: list[str]) -> DataFrame:
        real = self.dev_raw.select(self.key, F.col(self.target).alias("real"))
        counts = metrics.confusion_counts(predictions.join(real, self.key), "real", "prediction", by)
        return metrics.trial_scores(counts, by, self.config.average, self.config.positive)

    def undersampled(self) -> DataFrame:
        """Raw train rows, balanced where the job undersamples."""
        prep = self.config.prep
        if prep.get("sampling") == "undersampling":
            return materialize(sampling.undersample(self.train_raw, self.key, self.target, prep.get("balance", "auto")), "under")
        return self.train_raw

    @property
    def oversampled(self) -> bool:
        return self.config.prep.get("sampling") == "oversampling"

    def long_train(self) -> tuple[DataFrame, DataFrame]:
        """Balanced train rows ``(key, target)`` and their long table; keys are strings where rows were made."""
        raw = self.undersampled()
        rows, long = raw.select(self.key, self.target), self.pre.long_rows(raw)
        if not self.oversampled:
            return rows, long
        made, made_long = sparse_smote(rows, long, self.key, self.target, self.config.prep.get("balance", "auto"))
        name = F.col(self.key).cast("string").alias(self.key)
        rows = rows.select(name, self.target).unionByName(made.select(F.col("row_key").alias(self.key), self.target))
        long = long.select(name, "term", "weight").unionByName(made_long.withColumnRenamed("row_key", self.key))
        return materialize(rows, "balanced-rows"), materialize(long, "balanced-long")

    def n_terms(self) -> int:
        """Features of the fitted preprocessing, whether or not the balanced rows still have them."""
        return len(self.pre.columns) + sum(t.vectors.vocab.count() for t in self.pre.texts)


def _names(trials: DataFrame, names: dict) -> DataFrame:
    table = small_table(trials.sparkSession, list(names.items()), "trial_id int, Combinacion string")
    return trials.join(table, "trial_id")


def _winner(trials: DataFrame) -> tuple[DataFrame, dict]:
    kept = materialize(trials, "trials")
    return kept, metrics.best_trial(kept).first().asDict()


class _Neighbors:
    """Over text the long tables are compared, whatever the number of terms; otherwise, and where
    a column has negative values (sparse bounds need none), dense rows."""

    @staticmethod
    def _sparse(pre: Preprocessor, *longs: DataFrame) -> bool:
        return bool(pre.texts) and not any(pre.columns and long.filter(F.col("weight") < 0).limit(1).count() for long in longs)

    @staticmethod
    def _near(dev, train, key, target, k, p):
        if isinstance(train, tuple):
            (rows, long), (asked, asked_long) = train, dev
            found = sparse_knn(asked, asked_long, rows, long, k, p=p, query_key=key, train_key=key, payload=[target])
        else:
            found = neighbors.knn_join(dense(dev), dense(train), k, p=p, query_key=key, train_key=key, query_vec="vec",
                                       train_vec="vec", payload=[target])
        return found.withColumn("p", F.lit(p))

    @staticmethod
    def _sides(job: _Job):
        if job.pre.texts:
            dev = job.dev_raw.select(job.key), job.pre.long_rows(job.dev_raw)
            plain = job.pre.long_rows(job.train_raw) if job.pre.columns else dev[1]
            if _Neighbors._sparse(job.pre, dev[1], plain):
                return job.long_train(), dev
        return job.vectors()

    @staticmethod
    def run(job: _Job) -> tuple[DataFrame, Model]:
        options = job.config.knn()
        grid = neighbors.knn_trials(options["ks"], options["ps"], options["weights"])
        train, dev = _Neighbors._sides(job)
        near = None
        for p in options["ps"]:
            found = _Neighbors._near(dev, train, job.key, job.target, max(options["ks"]), p)
            near = found if near is None else near.unionByName(found)
        voted = neighbors.knn_grid(near, job.key, job.target, grid)
        scores = _names(job.score(voted, ["trial_id"]), {i: f"k={k}, p={p}, {w}" for i, k, p, w in grid})
        trials, best = _winner(scores)
        _, k, p, w = grid[best["trial_id"]]
        params = {"k": k, "p": p, "weights": w, "key": job.key, "target": job.target, "sparse": isinstance(train, tuple)}
        return trials, Model("KNN", best["Combinacion"], params, train)

    @staticmethod
    def predict(model: Model, pre: Preprocessor, raw: DataFrame) -> DataFrame:
        o = model.params
        asked = (raw.select(pre.key), pre.long_rows(raw)) if o["sparse"] else pre.transform(raw)
        near = _Neighbors._near(asked, model.state, pre.key, pre.target, o["k"], o["p"])
        return neighbors.knn_classify(near, pre.key, pre.target, o["weights"])

    @staticmethod
    def save(model: Model, path: str) -> None:
        if model.params["sparse"]:
            for name, part in zip(("rows", "long"), model.state):
                part.write.mode("overwrite").parquet(os.path.join(path, name))
        else:
            model.state.select(model.params["key"], "features", model.params["target"]).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark, model: Model, path: str):
        if model.params["sparse"]:
            return tuple(spark.read.parquet(os.path.join(path, name)) for name in ("rows", "long"))
        return spark.read.parquet(path)


class _Bayes:
    """Term models work on the long table; so do the others where there is text or rows are made."""

    @staticmethod
    def run(job: _Job) -> tuple[DataFrame, Model]:
        options = job.config.bayes()
        kind, long = options["kind"], bool(job.pre.texts) or job.oversampled
        alphas = [None] if kind == "gaussian" else bayes.alpha_grid(options["low"], options["high"], options["step"])
        if kind in ("multinomial", "complement"):
            rows, weights = job.long_train()
            fitted = bayes.fit_term_bayes(rows, weights, job.key, job.target, kind, job.n_terms())
            out = fitted.predict(job.dev_raw, job.pre.long_rows(job.dev_raw), alphas)
        elif long:
            fit = bayes.fit_long_categorical if kind == "categorical" else bayes.fit_long_gaussian
            fitted = fit(*job.long_train(), job.key, job.target)
            out = _Bayes._long(fitted, kind, job.dev_raw, job.pre.long_rows(job.dev_raw), alphas)
        elif kind == "categorical":
            fitted = bayes.fit_categorical(job.pre._numbers(job.undersampled()), job.pre.columns, job.target)
            out = fitted.predict_many(job.pre._numbers(job.dev_raw), alphas).select(job.key, "alpha", "prediction")
        else:
            fitted = bayes.fit_gaussian(job.pre._numbers(job.undersampled()), job.pre.columns, job.target)
            out = fitted.predict(job.pre._numbers(job.dev_raw)).select(job.key, "prediction")
        if kind == "gaussian":
            scores = _names(job.score(out.withColumn("trial_id", F.lit(0)), ["trial_id"]), {0: f"No tiene alpha: {kind}"})
        else:
            scores = _names(_number(job.score(out, ["alpha"]), alphas), {i: f"alpha:{a}" for i, a in enumerate(alphas)})
        trials, best = _winner(scores)
        params = {"kind": kind, "alpha": alphas[best["trial_id"]], "long": long}
        return trials, Model("NaiveBayes", best["Combinacion"], params, fitted)

    @staticmethod
    def _long(fitted, kind: str, raw: DataFrame, weights: DataFrame, alphas: list) -> DataFrame:
        return fitted.predict(raw, weights) if kind == "gaussian" else fitted.predict(raw, weights, alphas)

    @staticmethod
    def predict(model: Model, pre: Preprocessor, raw: DataFrame) -> DataFrame:
        kind, alpha = model.params["kind"], model.params["alpha"]
        if kind in ("multinomial", "complement"):
            return model.state.predict(raw, pre.long_rows(raw), [alpha]).select(pre.key, "prediction")
        if model.params["long"]:
            return _Bayes._long(model.state, kind, raw, pre.long_rows(raw), [alpha]).select(pre.key, "prediction")
        ready = pre._numbers(raw)
        out = model.state.predict(ready, alpha) if kind == "categorical" else model.state.predict(ready)
        return out.select(pre.key, "prediction")

    @staticmethod
    def save(model: Model, path: str) -> None:
        model.state.save(path)

    @staticmethod
    def load(spark, model: Model, path: str):
        return bayes.load_bayes(spark, path)


def _number(scores: DataFrame, alphas: list[float]) -> DataFrame:
    table = small_table(scores.sparkSession, list(enumerate(alphas)), "trial_id int, alpha double")
    return scores.join(table, "alpha").drop("alpha")


class _Mllib:
    @staticmethod
    def run(job: _Job) -> tuple[DataFrame, Model]:
        config = job.config
        train, dev = job.vectors()
        if config.algorithm == "LogisticRegression":
            o = config.logistic()
            grid = learners.logistic_trials(train.count(), o["cs"], o["penalties"], o["solvers"])
        else:
            o = config.forest() if config.algorithm == "RandomForest" else config.tree()
            grid = learners.tree_trials(o["depths"], o["min_split"], o["min_leaf"], o["criteria"], o.get("n_trees"))
        scores, fitted = learners.run_grid(grid, train, dev, job.target, config.average, config.positive)
        trials, best = _winner(scores)
        win = fitted[best["trial_id"]]
        return trials, Model(config.algorithm, win.trial.name, win.trial.params, win.model)

    @staticmethod
    def predict(model: Model, pre: Preprocessor, raw: DataFrame) -> DataFrame:
        return (model.state.transform(pre.transform(raw)).select(pre.key, F.col("predicted_label").alias("prediction")))

    @staticmethod
    def save(model: Model, path: str) -> None:
        model.state.write().overwrite().save(path)

    @staticmethod
    def load(spark, model: Model, path: str):
        return PipelineModel.load(path)


_KINDS = {"KNN": _Neighbors, "NaiveBayes": _Bayes, "DecisionTree": _Mllib, "RandomForest": _Mllib,
          "LogisticRegression": _Mllib}


def train_model(config: JobConfig, train: DataFrame, dev: DataFrame, key: str, target: str,
                lexicon: DataFrame | None = None) -> Outcome:
    """Run the configured grid on a given train and dev table."""
    if config.algorithm not in _KINDS:
        raise ValueError(f"unknown algorithm {config.algorithm!r}; expected one of {sorted(_KINDS)}")
    pre = fit_preprocessor(config, train, key, target, lexicon)
    trials, model = _KINDS[config.algorithm].run(_Job(config, pre, train, dev))
    return Outcome(trials, model, pre)


def split_and_train(config: JobConfig, data: DataFrame, key: str, target: str,
                    lexicon: DataFrame | None = None) -> Outcome:
    """Split by class (project jobs also hold back a test part), then train."""
    known = data.filter(F.col(target).isNotNull())
    if config.project:
        parts = sampling.stratified_split_3way(known, key, target)
    else:
        parts = sampling.stratified_split(known, key, target)
    outcome = train_model(config, sampling.part(parts, "train"), sampling.part(parts, "dev"), key, target, lexicon)
    outcome.test = sampling.part(parts, "test") if config.project else None
    return outcome


def evaluate(spark: SparkSession, path: str, test: DataFrame) -> dict:
    """Score a saved package on unseen rows.

    Returns the predictions, the confusion matrix, the scores and the winning
    parameters.
    """
    pre = Preprocessor.load(spark, os.path.join(path, "preprocessing"))
    model = Model.load(spark, os.path.join(path, "model"))
    real = test.select(pre.key, F.col(pre.target).alias("real"))
    predictions = materialize(real.join(model.predict(pre, test), pre.key), "predictions")
    counts = metrics.confusion_counts(predictions, "real", "prediction")
    return {"predictions": predictions, "matrix": metrics.confusion_matrix(counts),
            "scores": metrics.prf(counts, pre.config.average, positive=pre.config.positive),
            "accuracy": metrics.accuracy(counts), "algorithm": model.algorithm, "name": model.name,
            "params": model.params}
