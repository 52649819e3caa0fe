"""Job parameters: one nested dictionary (usually a JSON file) with defaults."""

from __future__ import annotations

import json
from dataclasses import dataclass, field


def as_list(value) -> list:
    return list(value) if isinstance(value, (list, tuple)) else [value]


@dataclass
class JobConfig:
    """Reads the sections and option names of the job file; absent ones get defaults."""

    options: dict = field(default_factory=dict)

    @staticmethod
    def read(path: str) -> JobConfig:
        with open(path, encoding="utf-8") as handle:
            return JobConfig(json.load(handle))

    def section(self, name: str) -> dict:
        return self.options.get(name) or {}

    @property
    def prep(self) -> dict:
        return self.section("preprocessing")

    @property
    def algorithm(self) -> str:
        return self.options.get("algorithm", "KNN")

    @property
    def language(self) -> str:
        return self.options.get("dataset_language", "english")

    @property
    def project(self) -> bool:
        return bool(self.options.get("proyecto", False))

    @property
    def average(self) -> str:
        return self.options.get("metric_to_evaluate", "macro")

    @property
    def positive(self) -> str:
        return str(self.options.get("positive_label", "1"))

    @property
    def separator(self) -> str:
        return self.prep.get("separator", ",")

    @property
    def group_sentiment(self) -> bool:
        return bool(self.prep.get("agrupar_sentimiento_proyecto", False))

    def knn(self) -> dict:
        h = self.section("hyperparametersKNN")
        return {"ks": list(range(h.get("k_min", 3), h.get("k_max", 3) + 1, h.get("step", 2))),
                "ps": list(range(h.get("p_min", 2), h.get("p_max", 2) + 1)),
                "weights": as_list(h.get("w", ["uniform"]))}

    def tree(self) -> dict:
        h = self.section("hyperparametersDecisionTree")
        return {"depths": list(range(h.get("min_depth", 1), h.get("max_depth", 10) + 1)),
                "min_split": h.get("min_samples_split", 5), "min_leaf": h.get("min_samples_leaf", 5),
                "criteria": as_list(h.get("criterion", "gini"))}

    def forest(self) -> dict:
        return {**self.tree(), "n_trees": self.section("hyperparametersRandomForest").get("n_estimators", 100)}

    def bayes(self) -> dict:
        h = self.section("hyperparametersNaiveBayes")
        return {"kind": h.get("type", h.get("tipo", "multinomial")), "low": h.get("min_alpha", 0.01),
                "high": h.get("max_alpha", 1), "step": h.get("step_alpha", 0.01)}

    def logistic(self) -> dict:
        h = self.section("hyperparametersLogisticRegression")
        return {"cs": as_list(h.get("C", [0.01, 0.1, 1, 10])), "penalties": as_list(h.get("penalty", ["l2"])),
                "solvers": as_list(h.get("solver", ["lbfgs"]))}

    def kmeans(self) -> dict:
        h = self.section("hyperparametersKMeans")
        return {"ks": list(range(h.get("k_min", 3), h.get("k_max", 3) + 1, h.get("step", 1))),
                "n_init": h.get("n_inicios", 10)}

    def lda(self) -> dict:
        h = self.section("hyperparametersLDA")
        return {"ks": list(range(h.get("k_min", 2), h.get("k_max", 10) + 1, h.get("step", 1))),
                "passes": h.get("passes", 10), "alpha": h.get("alpha", "auto"), "eta": h.get("eta", "auto"),
                "metric": h.get("coherencia_metrica", "u_mass")}
