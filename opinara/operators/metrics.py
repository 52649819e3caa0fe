"""Classification scores from confusion counts.

Predictions collapse to one row per (trial, real, predicted) before anything
else happens, so scoring costs one small shuffle whatever the row count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from opinara.session import small_table

DECIMALS = 4


def confusion_counts(df: DataFrame, real: str, pred: str, by: list[str] | None = None) -> DataFrame:
    """Long confusion matrix: ``(by..., real, pred, n)``."""
    return (df.groupBy(*(by or []), F.col(real).cast("string").alias("real"),
                       F.col(pred).cast("string").alias("pred"))
            .agg(F.count("*").alias("n")))


def union_labels(counts: DataFrame) -> list[str]:
    """Every label seen as real or predicted, sorted; a null is no label."""
    found = counts.select(F.explode(F.array("real", "pred")).alias("label")).where("label is not null").distinct()
    return sorted(r["label"] for r in found.collect())


def confusion_matrix(counts: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """Wide confusion matrix: one row per real label, one column per predicted one.

    Without ``labels`` the matrix spans the labels of both sides; with them it
    has exactly those rows and columns, zeros included.
    """
    labels = union_labels(counts) if labels is None else labels
    rows = small_table(counts.sparkSession, [(x,) for x in labels], "real string")
    wide = (counts.filter(F.col("real").isin(labels)).groupBy("real")
            .agg(*[F.sum(F.when(F.col("pred") == x, F.col("n")).otherwise(0)).alias(f"pred_{x}")
                   for x in labels]))
    return rows.join(wide, "real", "left").na.fill(0)


def label_scores(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``(by..., label, tp, fp, fn)`` over the labels of both sides."""
    same = F.col("real").eqNullSafe(F.col("pred"))
    zero = F.lit(0).cast("bigint")
    n = F.col("n")
    sides = F.array(
        F.struct(F.col("real").alias("label"), F.when(same, n).otherwise(zero).alias("tp"),
                 zero.alias("fp"), F.when(same, zero).otherwise(n).alias("fn")),
        F.struct(F.col("pred").alias("label"), zero.alias("tp"),
                 F.when(same, zero).otherwise(n).alias("fp"), zero.alias("fn")))
    return (counts.select(*(by or []), F.explode(sides).alias("s")).select(*(by or []), "s.*")
            .where("label is not null")
            .groupBy(*(by or []), "label")
            .agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn")))


def _ratio(top, bottom):
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def prf(counts: DataFrame, average: str = "macro", by: list[str] | None = None,
        positive: str = "1") -> DataFrame:
    """Precision, recall and F1 (``macro``, ``micro`` or ``binary``); 0/0 counts as 0."""
    by = by or []
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    scores = [_ratio(tp, tp + fp).alias("precision"), _ratio(tp, tp + fn).alias("recall"),
              _ratio(2 * tp, 2 * tp + fp + fn).alias("f1")]
    per_label = label_scores(counts, by)
    if average == "macro":
        return (per_label.select(*by, *scores).groupBy(*by)
                .agg(*[F.avg(c).alias(c) for c in ("precision", "recall", "f1")]))
    if average == "binary":
        per_label = per_label.filter(F.col("label") == positive)
    elif average != "micro":
        raise ValueError(f"unknown average {average!r}; expected macro, micro or binary")
    total = per_label.groupBy(*by).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tp", "fp", "fn")])
    return total.select(*by, *scores)


def accuracy(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    hit = F.sum(F.when(F.col("real") == F.col("pred"), F.col("n")).otherwise(0))
    return counts.groupBy(*(by or [])).agg((hit / F.sum("n")).alias("accuracy"))


def trial_scores(counts: DataFrame, by: list[str], average: str = "macro",
                 positive: str = "1") -> DataFrame:
    """``(by..., accuracy, precision, recall, f1)``, one row per trial."""
    return accuracy(counts, by).join(prf(counts, average, by, positive), by)


def trial_log(scores: DataFrame, combination: str) -> DataFrame:
    """The trial table as it is reported, scores rounded to four digits."""
    return scores.select(F.col(combination).alias("Combinacion"),
                         *[F.round(src, DECIMALS).alias(dst) for src, dst in (
                             ("accuracy", "Accuracy"), ("precision", "Precision"),
                             ("recall", "Recall"), ("f1", "F_score"))])


def best_trial(scores: DataFrame, trial: str = "trial_id") -> DataFrame:
    """The trial with the highest F1; the earliest one wins a tie."""
    return scores.orderBy(F.desc("f1"), trial).limit(1)
