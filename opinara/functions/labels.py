"""Class-label normalisation as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opinara.functions.lexicons import RATING_LABELS
from opinara.functions.replies import strip_space


def sentiment_bucket(rating: Column) -> Column:
    """Star rating 1-5 to its sentiment label; anything else stays as it is."""
    text = rating.cast("string")
    out = text
    number = text.try_cast("double")
    for star, label in RATING_LABELS.items():
        out = F.when(number == F.lit(float(star)), F.lit(label)).otherwise(out)
    return out


def sentiment_normalize(value: Column) -> Column:
    """Trimmed text ``'1'``..``'5'`` to its label, any other text to upper case."""
    text = strip_space(value.cast("string"))
    out = F.upper(text)
    for star, label in RATING_LABELS.items():
        out = F.when(text == F.lit(str(star)), F.lit(label)).otherwise(out)
    return out
