"""Topic discovery inside one class: K-Means or LDA with keyword tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.operators import clusters, topics
from opinara.operators import vectorize as V
from opinara.plans.config import JobConfig
from opinara.plans.preprocess import fit_preprocessor
from opinara.session import materialize


@dataclass
class Grouping:
    """The curve over k, the rows with their cluster, and the keywords."""

    curve: DataFrame
    rows: DataFrame
    keywords: DataFrame


def discover(config: JobConfig, data: DataFrame, key: str, target: str, choose_k,
             lexicon: DataFrame | None = None) -> Grouping:
    """Explore k, then group with the k that ``choose_k(curve)`` returns (or a plain number)."""
    if config.algorithm not in ("K-Means", "LDA"):
        raise ValueError(f"unknown grouping algorithm {config.algorithm!r}; expected K-Means or LDA")
    pre = fit_preprocessor(config, data, key, target, lexicon)
    prepared = pre.transform(data).select(key, "features").persist()
    pick = choose_k if callable(choose_k) else lambda curve: choose_k
    tool = pre.texts[0] if pre.texts else None
    try:
        if config.algorithm == "K-Means":
            o = config.kmeans()
            curve, models = clusters.kmeans_elbow(prepared, o["ks"], o["n_init"])
            k = pick(curve)
            model = models.get(k) or clusters.kmeans_fit(prepared, k, o["n_init"])[0]
            assigned = model.transform(prepared).select(key, "cluster_id")
            words = None
            if tool:
                centroids = clusters.cluster_centroids(assigned, tool.vectors.fitted(), key)
                words = clusters.cluster_keywords(centroids)
            return Grouping(curve, data.join(assigned, key), words)
        if tool is None:
            raise ValueError("LDA needs a converted text column")
        o = config.lda()
        numbered = V.number_terms(tool.vectors.vocab)
        texts = materialize(V.presence_texts(tool.vectors.fitted(), key), "texts")
        curve = topics.coherence_curve(prepared, numbered, texts, o["ks"], o["metric"], o["passes"], o["alpha"], o["eta"])
        model = topics.lda_fit(prepared, pick(curve), o["passes"], o["alpha"], o["eta"])
        mixed = topics.topic_mix(model, prepared).drop("features", "topic_mix")
        report = topics.topic_report(topics.topic_words(model, numbered), mixed)
        return Grouping(curve, data.join(mixed, key), report)
    finally:
        prepared.unpersist()
