"""Exact duplicates by a tree of merges over sorted digest runs. DataFrame functions only.

Every input partition is a run of ``(digest, proof, length)`` entries. In each
round ``FAN_IN`` neighbouring runs exchange entries by digest and merge: the
aggregate is sort-based, so both sides of the exchange are sorted runs. Entries
merge only if SHA-256 and length agree besides the 64-bit digest, and the
identifier that stays and the group's size are kept at every level. A text with
any number of copies thus puts at most ``FAN_IN`` entries into one merge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import look_up, text_or_empty
from opinara.session import materialize

#: Runs merged at once; a power of two.
FAN_BITS = 3
FAN_IN = 1 << FAN_BITS
KEY = ["digest", "proof", "n_bytes"]


def leaf_runs(docs: DataFrame, id_column: str, text_column: str, row: Column) -> DataFrame:
    """One written entry per row: the only pass over the texts."""
    text = text_or_empty(text_column)
    return materialize(docs.select(
        F.col(id_column).alias("id"), row.alias("row"), F.spark_partition_id().alias("run"),
        F.xxhash64(text).alias("digest"), F.unhex(F.sha2(text, 256)).alias("proof"),
        F.octet_length(text).alias("n_bytes")), "digest-runs")


def merge_runs(leaves: DataFrame, keep: str) -> DataFrame:
    """The root of the merge tree: each digest with its keeper and its number of rows."""
    largest = keep == "largest"
    # Null identifiers stay only where the group has no other; ties of an identifier go to one row.
    order = F.struct(F.col("id").isNotNull() if largest else F.col("id").isNull(), F.col("id"), F.col("row"))
    pick = F.max if largest else F.min
    last = leaves.agg(F.max("run")).first()[0] or 0
    level = leaves.select("run", *KEY, order.alias("best"), F.lit(1).cast("long").alias("n"))
    while True:
        level = level.withColumn("run", F.shiftright("run", FAN_BITS))
        level = materialize(level.groupBy("run", *KEY).agg(pick("best").alias("best"), F.sum("n").alias("n")),
                            "merged-runs")
        last >>= FAN_BITS
        if not last:
            return level.drop("run")


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: str = "largest",
                 row: Column | None = None) -> DataFrame:
    """``id, row, keep_id, group_size, kept, sha256`` for every row, dropped ones too.

    ``keep`` names the identifier that stays, "largest" or "smallest". A null
    text is an empty one. A null identifier stays only if its whole group has
    none; of repeated rows with the same identifier and text exactly one is
    kept. No rows give no rows. Other columns are ignored.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep must be 'largest' or 'smallest', not {keep!r}")
    leaves = leaf_runs(docs, id_column, text_column, F.monotonically_increasing_id() if row is None else row)
    root = merge_runs(leaves, keep)
    copies = root.where("n > 1").select(*KEY, F.col("best.id").alias("keep_id"), F.col("best.row").alias("keep_row"), "n")
    joined = look_up(leaves, copies, KEY, "n", leaves.count())
    single = F.col("n").isNull()
    return joined.select(
        "id", "row", F.when(single, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (single | (F.col("row") == F.col("keep_row"))).alias("kept"), F.lower(F.hex("proof")).alias("sha256"))


def drop_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                keep: str = "largest") -> DataFrame:
    """The rows that stay, with all their columns."""
    row = "__row"
    while row in docs.columns:
        row = f"_{row}"
    tagged = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "tagged-rows")
    dropped = exact_groups(tagged, id_column, text_column, keep, F.col(row)).where("not kept")
    return tagged.join(dropped.select(F.col("row").alias(row)), row, "left_anti").drop(row)
