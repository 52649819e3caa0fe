"""Column and row selection, relabelling, unions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions.labels import sentiment_bucket
from opinara.functions.lexicons import DAY_FIRST_FORMATS, SENTIMENTS


def target_last(df: DataFrame, target: str) -> DataFrame:
    """Same columns, the target at the end."""
    if target not in df.columns:
        raise ValueError(f"target column {target!r} not found; check the separator")
    return df.select(*[c for c in df.columns if c != target], target)


def drop_features(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop the listed columns; absent ones are ignored."""
    return df.drop(*columns)


def relabel(df: DataFrame, target: str, group_sentiment: bool = False) -> DataFrame:
    return df.withColumn(target, sentiment_bucket(F.col(target))) if group_sentiment else df


def day_first_date(text: Column) -> Column:
    """Day-first date text in any of several layouts; unreadable text is null."""
    value = F.trim(text)
    return F.coalesce(*[F.try_to_timestamp(value, F.lit(f)).cast("date") for f in DAY_FIRST_FORMATS])


def filter_class_years(df: DataFrame, target: str, label: str, date_col: str, first: int,
                       last: int) -> DataFrame:
    """Rows of one class whose day-first date lies in a range of years."""
    return df.filter((F.col(target) == label)
                     & F.year(day_first_date(F.col(date_col))).between(first, last))


def filter_class(df: DataFrame, target: str, label: str) -> DataFrame:
    """Rows of one class, ignoring case and outer blanks."""
    return df.filter(F.upper(F.trim(F.col(target).cast("string"))) == label.upper())


def label_isin(df: DataFrame, target: str, labels: list[str] | None = None) -> DataFrame:
    return df.filter(F.col(target).isin(labels or SENTIMENTS))


def valid_predictions(df: DataFrame, prediction: str, labels: list[str] | None = None) -> DataFrame:
    """Rows whose prediction is one of the valid labels."""
    return label_isin(df, prediction, labels)


def distinct_labels(df: DataFrame, target: str) -> DataFrame:
    return df.select(target).distinct()


def class_distribution(df: DataFrame, target: str) -> DataFrame:
    return df.groupBy(target).agg(F.count("*").alias("n"))


def union_synthetic(real: DataFrame, synthetic: DataFrame) -> DataFrame:
    """Real and synthetic rows together; columns missing on a side are null."""
    return real.unionByName(synthetic, allowMissingColumns=True)


def balanced_class_weights(df: DataFrame, target: str) -> DataFrame:
    """``(target, n, weight)`` with weight = rows / (classes * rows of the class)."""
    counts = class_distribution(df, target)
    totals = counts.agg(F.sum("n").alias("rows"), F.count("*").alias("classes")).first()
    return counts.withColumn("weight", F.lit(float(totals["rows"] or 0))
                             / (F.lit(float(totals["classes"])) * F.col("n")))
