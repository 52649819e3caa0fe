"""Joins against a dictionary-like table whose keys are skewed in the big side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A counted table up to this many rows is broadcast.
BROADCAST_ROWS = 250_000
# Beyond it: how many of the heaviest keys are salted, and into how many parts.
HOT_KEYS = 1_000
SALTS = 64


def lookup_join(facts: DataFrame, entries: DataFrame, on: str, weight: str,
                broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Inner join ``facts`` with a table of unique ``on`` keys.

    ``weight`` says how often a key occurs among the facts. ``entries`` is
    counted first and should be cheap to read (a written table). Small, it is
    broadcast. Large, the heaviest keys are salted: their rows spread over
    ``SALTS`` shuffle groups and their entry is repeated for each, so a word
    found in a third of all documents never lands in one task; any other key
    holds at most a ``1/HOT_KEYS`` share.
    """
    payload = [c for c in entries.columns if c != on]
    if entries.limit(broadcast_rows + 1).count() <= broadcast_rows:
        return facts.join(F.broadcast(entries), on).select(*facts.columns, *payload)
    hot = F.broadcast(entries.orderBy(F.desc(weight), on).limit(HOT_KEYS)
                      .select(on, F.lit(True).alias("__hot")))
    part = F.pmod(F.xxhash64(*facts.columns), F.lit(SALTS)).cast("int")
    salted = facts.join(hot, on, "left").withColumn("__salt", F.when(F.col("__hot"), part).otherwise(0))
    repeats = F.sequence(F.lit(0), F.when(F.col("__hot"), F.lit(SALTS - 1)).otherwise(0))
    repeated = entries.join(hot, on, "left").select(*entries.columns, F.explode(repeats).alias("__salt"))
    return salted.join(repeated, [on, "__salt"]).select(*facts.columns, *payload)
