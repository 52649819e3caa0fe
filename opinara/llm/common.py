"""What the corpus operators share: the word rule, held-out folds, hot-key look-ups and components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.session import materialize

#: A word is a run of characters outside these; the same six that ``bytes.split()`` splits on.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
#: A key with more than this share of all rows is hot, so at most ``HOT_SHARE`` keys are.
HOT_SHARE = 1000


def read_documents(spark: SparkSession, folder: str, name: str = "documents") -> DataFrame:
    """One table of the data folder, by Spark's own reader."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_or_empty(column: str) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fold(column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text (fold 0)."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def seeded(seed: int, *columns: Column) -> Column:
    """A repeatable 63-bit number from a seed and columns."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 1)


def look_up(rows: DataFrame, table: DataFrame, keys: list[str], count: str, total: int) -> DataFrame:
    """Left join to a table unique in ``keys`` whose ``count`` says how many rows each key has.

    Keys with more than 1/1000 of ``total`` rows number fewer than 1000, whatever
    the data, so those alone are broadcast; all others shuffle evenly.
    """
    is_hot = F.col(count) * HOT_SHARE > F.lit(total)
    hot, cold = F.broadcast(table.where(is_hot)), table.where(~is_hot)
    return (rows.join(hot, keys, "inner")
            .unionByName(rows.join(F.broadcast(table.where(is_hot).select(keys)), keys, "left_anti")
                         .join(cold, keys, "left")))


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """``node, root`` for every node of the links ``a, b`` (same type); root is the smallest node reachable.

    Alternating large-star and small-star steps: each keeps at most one row per
    input row, and a hub is read through a grouped minimum, combined before the
    shuffle, so no neighbour list is ever gathered. Each step is a written table.
    """
    edges = materialize(links.select("a", "b").where("a <> b").distinct(), label)
    while True:
        # Large star: every neighbour that is larger than a node hangs below the least of the node and its neighbours.
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select("b", "a"))
        least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"), F.count("v").alias("n"))
        total = 2 * edges.count()
        if not total:
            break
        large = (look_up(both, least, ["u"], "n", total).where("v > u and v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = materialize(large.distinct(), label)
        # Small star: a node and its smaller neighbours hang below the least of these.
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("v").alias("n"))
        total = large.count()
        joined = look_up(large, least, ["u"], "n", total)
        small = (joined.where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
                 .unionAll(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).where("a <> b").distinct())
        small = materialize(small, label)
        done = not (small.exceptAll(edges.select("a", "b")).take(1) or edges.select("a", "b").exceptAll(small).take(1))
        edges = small
        if done:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
