"""Cleaning of language-model replies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opinara.functions.lexicons import WHITESPACE

REASONING_BLOCK = r"(?is)<think>.*?</think>"


def strip_space(text: Column) -> Column:
    """Trim every kind of whitespace, not only blanks."""
    return F.regexp_replace(text, rf"^{WHITESPACE}+|{WHITESPACE}+\z", "")


def strip_reasoning(reply: Column) -> Column:
    """Drop reasoning blocks and trim."""
    return strip_space(F.regexp_replace(reply, REASONING_BLOCK, ""))


def reply_label(reply: Column) -> Column:
    return F.upper(strip_reasoning(reply))


def strip_quotes(text: Column) -> Column:
    """Strip outer double quotes, then outer single quotes."""
    return F.btrim(F.btrim(text, F.lit('"')), F.lit("'"))
