"""The row-wise steps on a stream: no state, no watermark, no join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.functions import cleaning
from opinara.functions.labels import sentiment_bucket


def clean_stream(reviews: DataFrame, text: str, rating: str | None = None,
                 language: str = "english") -> DataFrame:
    """Clean text and relabel ratings of a stream (or of a batch) row by row."""
    out = reviews.withColumn(text, cleaning.clean_text(F.col(text), language))
    return out.withColumn(rating, sentiment_bucket(F.col(rating))) if rating else out
