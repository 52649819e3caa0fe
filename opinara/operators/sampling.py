"""Seeded splits and samples with exact class quotas.

A plain ``row_number`` per class would sort a dominant class in one task.
Here rows are ordered by a uniform hash of their key. Counting the hash's
leading digits per class finds the narrow bucket that holds the quota
boundary; only that bucket is ranked, and the split itself is a comparison
with one boundary row per class. No full row is ever shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opinara.functions.hashing import draw_int, order_hash
from opinara.session import small_table

SEED = 42
# Rows to rank at most (on average) inside one hash bucket.
BUCKET_ROWS = 50_000
# Class tables live on the driver; more labels than this is not a class column.
MAX_CLASSES = 100_000
# Up to this many, class boundaries are written into the plan.
LITERAL_CLASSES = 64


def class_counts(df: DataFrame, by: str) -> dict:
    """Rows per non-null class; the number of classes is checked."""
    rows = (df.filter(F.col(by).isNotNull()).groupBy(by).agg(F.count("*").alias("n"))
            .limit(MAX_CLASSES + 1).collect())
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{by!r} has more than {MAX_CLASSES} classes")
    return {r[by]: r["n"] for r in sorted(rows, key=lambda r: str(r[by]))}


def largest_remainder(counts: Mapping, size: int) -> dict:
    """Split ``size`` over the classes in proportion; leftovers by largest remainder."""
    total = sum(counts.values())
    exact = {c: n * size / total for c, n in counts.items()}
    quota = {c: int(math.floor(x)) for c, x in exact.items()}
    left = size - sum(quota.values())
    order = sorted(counts, key=lambda c: (-(counts[c] * size % total), str(c)))
    for c in order[:left]:
        quota[c] += 1
    return quota


def _digits(rows: int) -> int:
    return min(5, max(1, math.ceil(math.log(max(rows, 1) / BUCKET_ROWS, 16)) if rows > BUCKET_ROWS else 1))


def _bucketed(df: DataFrame, key: str, by: str, seed: int, digits: int) -> tuple[DataFrame, DataFrame]:
    ordered = (df.filter(F.col(by).isNotNull())
               .select(by, F.col(key).alias("__key"), order_hash(seed, key).alias("__hash"))
               .withColumn("__bucket", F.substring("__hash", 1, digits)))
    up_to = W.partitionBy(by).orderBy("__bucket")
    sizes = (ordered.groupBy(by, "__bucket").agg(F.count("*").alias("__n"))
             .withColumn("__before", F.sum("__n").over(up_to) - F.col("__n")))
    return ordered, sizes


def boundaries(df: DataFrame, key: str, by: str, quotas: Mapping[str, Mapping],
               counts: Mapping, seed: int = SEED) -> DataFrame:
    """One row per class with, for each named quota q, the q-th row in hash order.

    Columns ``<name>`` are structs (hash, key), null where the quota is 0.
    """
    spark = df.sparkSession
    ordered, sizes = _bucketed(df, key, by, seed, _digits(max(counts.values(), default=1)))
    wanted = [(c, name, int(min(q[c], counts[c]))) for name, q in quotas.items() for c in counts
              if q.get(c, 0) > 0]
    schema = f"`{by}` {df.schema[by].dataType.simpleString()}, __name string, __quota bigint"
    targets = F.broadcast(small_table(spark, wanted, schema))
    edge = (sizes.join(targets, by)
            .filter((F.col("__before") < F.col("__quota"))
                    & (F.col("__quota") <= F.col("__before") + F.col("__n")))
            .select(by, "__bucket", "__name", (F.col("__quota") - F.col("__before")).alias("__need")))
    place = F.row_number().over(W.partitionBy(by, "__name").orderBy("__hash", "__key"))
    found = (ordered.join(F.broadcast(edge), [by, "__bucket"])
             .withColumn("__place", place).filter(F.col("__place") == F.col("__need")))
    return (found.groupBy(by)
            .agg(*[F.max(F.when(F.col("__name") == name, F.struct("__hash", "__key"))).alias(name)
                   for name in quotas]))


def with_parts(df: DataFrame, key: str, by: str, cuts: Mapping[str, Mapping], counts: Mapping,
               rest: str, seed: int = SEED, part_col: str = "part") -> DataFrame:
    """Label every row with the first cut its hash position falls under, else ``rest``.

    ``cuts`` maps part name to cumulative quota per class. Rows without a class
    belong to no part and are left out.
    """
    edges = boundaries(df, key, by, cuts, counts, seed).collect()
    here = F.struct(order_hash(seed, key).alias("__hash"), F.col(key).alias("__key"))
    key_type = df.schema[key].dataType.simpleString()
    edge_type = f"struct<__hash:string,__key:{key_type}>"
    named = {name: {r[by]: r[name] for r in edges if r[name] is not None} for name in cuts}
    known = df.filter(F.col(by).isNotNull())
    if len(counts) <= LITERAL_CLASSES:
        # A few classes: the boundaries are literals of a projection.
        def limit(name):
            cells = [x for c, e in named[name].items()
                     for x in (F.lit(c), F.struct(F.lit(e[0]).alias("__hash"), F.lit(e[1]).alias("__key")).cast(edge_type))]
            return (F.try_element_at(F.create_map(*cells), F.col(by)) if cells
                    else F.lit(None).cast(edge_type))
        limits = {name: limit(name) for name in cuts}
    else:
        # Many classes (their number is checked): one broadcast row each.
        rows = [(c, *[(named[n][c][0], named[n][c][1]) if c in named[n] else None for n in cuts]) for c in counts]
        schema = f"`{by}` {df.schema[by].dataType.simpleString()}, " + ", ".join(
            f"`{name}` {edge_type}" for name in cuts)
        table = df.sparkSession.createDataFrame(rows, schema)
        known = known.join(F.broadcast(table), by, "left")
        limits = {name: F.col(name) for name in cuts}
    part: Column = F.lit(rest)
    for name in reversed(list(cuts)):
        part = F.when(here <= limits[name], F.lit(name)).otherwise(part)
    return known.withColumn(part_col, part).select(*df.columns, part_col)


def stratified_split(df: DataFrame, key: str, by: str, test_size: float = 0.2, seed: int = SEED,
                     part_col: str = "part") -> DataFrame:
    """Label rows ``dev`` (``ceil(n*test_size)`` rows, class shares kept) or ``train``."""
    counts = class_counts(df, by)
    size = math.ceil(sum(counts.values()) * test_size)
    return with_parts(df, key, by, {"dev": largest_remainder(counts, size)}, counts, "train", seed,
                      part_col)


def stratified_split_3way(df: DataFrame, key: str, by: str, test_size: float = 0.15,
                          dev_size: float = 0.177, seed: int = SEED,
                          part_col: str = "part") -> DataFrame:
    """``test`` first, then ``dev`` as a share of what is left, the rest ``train``."""
    counts = class_counts(df, by)
    test = largest_remainder(counts, math.ceil(sum(counts.values()) * test_size))
    left = {c: n - test[c] for c, n in counts.items()}
    dev = largest_remainder(left, math.ceil(sum(left.values()) * dev_size))
    both = {c: test[c] + dev[c] for c in counts}
    return with_parts(df, key, by, {"test": test, "dev": both}, counts, "train", seed, part_col)


def part(df: DataFrame, name: str, part_col: str = "part") -> DataFrame:
    return df.filter(F.col(part_col) == name).drop(part_col)


def undersample(df: DataFrame, key: str, by: str, ratio: str | float = "auto",
                seed: int = SEED) -> DataFrame:
    """Drop rows of larger classes.

    ``auto`` cuts every class to the smallest one; a number is the wanted
    minority/majority ratio of a two-class table.
    """
    counts = class_counts(df, by)
    quota = under_targets(counts, ratio)
    kept = with_parts(df, key, by, {"keep": quota}, counts, "drop", seed, "__part")
    return part(kept, "keep", "__part")


def under_targets(counts: Mapping, ratio: str | float = "auto") -> dict:
    least = min(counts.values())
    if ratio == "auto":
        return {c: least for c in counts}
    return _two_class_target(counts, max, int(least / float(ratio)))


def over_targets(counts: Mapping, ratio: str | float = "auto") -> dict:
    most = max(counts.values())
    if ratio == "auto":
        return {c: most for c in counts}
    return _two_class_target(counts, min, int(most * float(ratio)))


def _two_class_target(counts: Mapping, pick, target: int) -> dict:
    if len(counts) != 2:
        raise ValueError("a numeric balance ratio needs exactly two classes; use 'auto'")
    chosen = pick(counts, key=lambda c: (counts[c], str(c)))
    if (pick is max and target > counts[chosen]) or (pick is min and target < counts[chosen]):
        raise ValueError("the balance ratio asks for the opposite kind of resampling")
    return {c: (target if c == chosen else n) for c, n in counts.items()}


def hash_positions(df: DataFrame, key: str, by: str, counts: Mapping, seed: int = SEED) -> DataFrame:
    """``(by, key, pos)``: exact 0-based position of each row in its class's hash order."""
    ordered, sizes = _bucketed(df, key, by, seed, _digits(max(counts.values(), default=1)))
    local = F.row_number().over(W.partitionBy(by, "__bucket").orderBy("__hash", "__key"))
    return (ordered.withColumn("__local", local)
            .join(sizes.select(by, "__bucket", "__before"), [by, "__bucket"])
            .select(by, F.col("__key").alias(key),
                    (F.col("__before") + F.col("__local") - 1).cast("bigint").alias("pos")))


def one_per_class(df: DataFrame, key: str, by: str | None = None, seed: int = SEED) -> DataFrame:
    """One random row per class, or one of all rows when ``by`` is None."""
    whole = "__all"
    source = df if by else df.withColumn(whole, F.lit("all"))
    group = by or whole
    counts = class_counts(source, group)
    picked = with_parts(source, key, group, {"keep": {c: 1 for c in counts}}, counts, "drop", seed,
                        "__part")
    return part(picked, "keep", "__part").select(*df.columns)


def first_n(df: DataFrame, key: str, n: int = -1) -> DataFrame:
    """The first ``n`` rows by key; -1 means all."""
    return df if n < 0 else df.orderBy(key).limit(n)


def example_positions(requests: DataFrame, request: str, pool_size: int, k: int = 3,
                      seed: int = SEED) -> DataFrame:
    """``(request, pos)``: up to ``k`` distinct random positions below ``pool_size``.

    Draw i picks among the positions not taken yet, so every subset is equally
    likely, and no request meets the whole pool.
    """
    k = min(k, pool_size)
    taken = F.array().cast("array<bigint>")
    staged = requests.select(request, taken.alias("__taken"))
    for i in range(k):
        draw = F.pmod(draw_int(seed, F.col(request), F.lit(i)), F.lit(pool_size - i))
        shifted = F.aggregate(F.array_sort("__taken"), draw,
                              lambda acc, t: F.when(acc >= t, acc + 1).otherwise(acc))
        staged = staged.select(request, F.concat("__taken", F.array(shifted)).alias("__taken"))
    return staged.select(request, F.explode("__taken").alias("pos"))


def examples_per_request(requests: DataFrame, request: str, pool: DataFrame, key: str,
                         k: int = 3, seed: int = SEED) -> DataFrame:
    """``(request, <pool columns>)``: ``min(k, n)`` distinct pool rows per request."""
    one_class = pool.withColumn("__class", F.lit("pool"))
    size = pool.count()
    if size == 0:
        return requests.select(request).join(pool, F.lit(False), "inner")
    places = hash_positions(one_class, key, "__class", {"pool": size}, seed).select(key, "pos")
    chosen = example_positions(requests, request, size, k, seed)
    return chosen.join(places, "pos").drop("pos").join(pool, key).select(request, *pool.columns)
