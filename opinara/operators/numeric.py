"""Leak-free numeric transforms: learn on train, apply anywhere.

``fit_*`` runs one aggregate and keeps a handful of numbers on the driver;
``transform`` is then a plain projection, with no join and no shuffle.
"""

from __future__ import annotations

import json
import struct
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.session import materialize, small_table


def numeric_columns(df: DataFrame, exclude: list[str] | None = None) -> list[str]:
    """Names of the numeric columns, in table order."""
    skip = set(exclude or [])
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def existing(df: DataFrame, columns: list[str]) -> list[str]:
    """The wanted columns that the table has."""
    return [c for c in columns if c in df.columns]


def _value(column: Column) -> Column:
    return column.cast("double")


_STATS = {
    "mean": F.avg,
    "min": F.min,
    "max": F.max,
    "maxabs": lambda c: F.max(F.abs(c)),
    "std": F.stddev_pop,
}
STATS = (*_STATS, "median", "mode")

# The digits of a median's bits, highest first.
DIGIT_BITS = 16
DIGIT_SHIFTS = (48, 32, 16, 0)


def learn_stats(df: DataFrame, columns: list[str], stats: list[str]) -> dict[str, dict[str, float]]:
    """``{column: {stat: value}}``; plain statistics share one pass."""
    if not columns:
        return {}
    plain = [s for s in stats if s in _STATS]
    out: dict[str, dict[str, float]] = {c: {} for c in columns}
    if plain:
        row = df.agg(*[_STATS[s](_value(F.col(c))).alias(f"{c}_{s}")
                       for c in columns for s in plain]).first()
        out = {c: {s: row[f"{c}_{s}"] for s in plain} for c in columns}
    for name, learn in (("median", lambda: exact_medians(df, columns)),
                        ("mode", lambda: smallest_modes(df, columns))):
        if name in stats:
            for c, v in learn().items():
                out[c][name] = v
    return {c: {s: out[c][s] for s in stats} for c in columns}


def smallest_modes(df: DataFrame, columns: list[str]) -> dict[str, float]:
    """Most frequent value per column, the smallest on a tie.

    Counting is an ordinary grouped shuffle, so many distinct values are fine.
    """
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), _value(F.col(c)).alias("x"))
                                for c in columns])).alias("s")
    counted = (df.select(cells).select("s.*").filter(F.col("x").isNotNull())
               .groupBy("c", "x").agg(F.count("*").alias("n")))
    best = counted.groupBy("c").agg(
        F.min_by("x", F.struct((-F.col("n")).alias("n"), F.col("x").alias("x"))).alias("x")).collect()
    found = {r["c"]: r["x"] for r in best}
    return {c: found.get(c) for c in columns}


def ordered_bits(column: Column) -> Column:
    """A long in the order of the doubles: -0.0 as 0.0, NaN after all others."""
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), _value(column) + F.lit(0.0)).cast("long")
    return F.when(column.isNotNull(), F.when(bits < 0, bits.bitwiseXOR(F.lit(2 ** 63 - 1))).otherwise(bits))


def _double(key: int) -> float:
    return struct.unpack("<d", struct.pack("<q", key if key >= 0 else key ^ (2 ** 63 - 1)))[0]


def exact_medians(df: DataFrame, columns: list[str]) -> dict[str, float]:
    """Exact medians by digits: four grouped counts of 16 bits each find the value at a rank.

    Every column takes part in each count, and a count has at most 65,536 rows
    a rank, whatever the table; only the row that holds the rank comes back.
    """
    keys = materialize(df.select(*[ordered_bits(F.col(c)).alias(f"k{i}") for i, c in enumerate(columns)]), "median-keys")
    counts = keys.agg(*[F.count(f"k{i}").alias(f"k{i}") for i in range(len(columns))]).first()
    # (column, middle place) -> leading bits found so far, rank among the values that have them.
    found = {(i, r): (None, r) for i in range(len(columns)) if counts[f"k{i}"]
             for r in ((counts[f"k{i}"] - 1) // 2, counts[f"k{i}"] // 2)}
    for shift in DIGIT_SHIFTS if found else ():
        targets = list(found)
        cells = []
        for at, target in enumerate(targets):
            key, (prefix, _) = F.col(f"k{target[0]}"), found[target]
            inside = key.isNotNull() if prefix is None else F.shiftright(key, shift + DIGIT_BITS) == F.lit(prefix)
            cells.append(F.when(inside, F.struct(F.lit(at).alias("at"), F.shiftright(key, shift).alias("lead"))))
        histogram = (keys.select(F.explode(F.array_compact(F.array(*cells))).alias("c")).groupBy("c.at", "c.lead")
                     .agg(F.count("*").alias("n")))
        before = F.sum("n").over(W.partitionBy("at").orderBy("lead").rowsBetween(W.unboundedPreceding, -1))
        rank = F.element_at(F.array(*[F.lit(found[t][1]) for t in targets]), F.col("at") + 1)
        hit = (histogram.withColumn("before", F.coalesce(before, F.lit(0)))
               .filter((F.col("before") <= rank) & (rank < F.col("before") + F.col("n"))))
        for row in hit.collect():
            target = targets[row["at"]]
            found[target] = (row["lead"], found[target][1] - row["before"])
    middle: dict[int, list[float]] = {}
    for (i, _), (key, _) in sorted(found.items()):
        middle.setdefault(i, []).append(_double(key))
    return {c: sum(middle[i]) / len(middle[i]) if i in middle else None for i, c in enumerate(columns)}


def column_stats(df: DataFrame, columns: list[str], stats: list[str]) -> DataFrame:
    """``(column, <stat>...)``, one row per column."""
    learnt = learn_stats(df, columns, stats)
    rows = [(c, *[learnt[c][s] for s in stats]) for c in columns]
    schema = ", ".join(["column string"] + [f"`{s}` double" for s in stats])
    return small_table(df.sparkSession, rows, schema)


@dataclass
class NumericModel:
    """Learnt numbers per column plus the rule that uses them."""

    kind: str
    params: dict[str, dict[str, float]]
    options: dict = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        here = {c: p for c, p in self.params.items() if c in df.columns}
        if not here:
            return df
        if self.kind == "discretize":
            bins, kept = self.options["bins"], [c for c in df.columns if c not in here]
            # The guess is a column of its own, as settling it needs it several times.
            guessed = df.withColumns({f"{c}_disc": _guess_bin(F.col(c), p, bins) for c, p in here.items()})
            return guessed.select(*kept, *[_settle_bin(F.col(c), F.col(f"{c}_disc"), p, bins).alias(f"{c}_disc")
                                           for c, p in here.items()])
        rule = _RULES[self.kind]
        return df.withColumns({c: rule(_value(F.col(c)), p) for c, p in here.items()})

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> NumericModel:
        return NumericModel(**json.loads(text))


def _impute(x: Column, p: dict) -> Column:
    fill = p["fill"]
    return x if fill is None else F.coalesce(x, F.lit(float(fill)))


def _scaled(x: Column, shift: float, width: float) -> Column:
    """``(x - shift) / width``; a constant column is only shifted."""
    moved = x - F.lit(float(shift)) if shift else x
    return moved / F.lit(float(width)) if width else moved


_RULES = {
    "impute": _impute,
    "max-min": lambda x, p: _scaled(x, p["min"], p["max"] - p["min"]),
    "max": lambda x, p: _scaled(x, 0.0, p["maxabs"]),
    "standard": lambda x, p: _scaled(x, p["mean"], p["std"]),
}


def _guess_bin(column: Column, p: dict, bins: int) -> Column:
    x, low, width = _value(column), float(p["min"]), float(p["max"] - p["min"])
    if not width:
        return F.when(x.isNotNull(), F.lit(0)).cast("bigint")
    at = F.floor((x - F.lit(low)) / F.lit(width / bins))
    return F.when(x.isNotNull(), F.least(F.greatest(at, F.lit(0)), F.lit(bins - 1)))


def _settle_bin(column: Column, guess: Column, p: dict, bins: int) -> Column:
    """Check the guessed bin against its exact edges, as a division may round across one."""
    x, low, width = _value(column), float(p["min"]), float(p["max"] - p["min"])
    if not width:
        return guess.cast("double")
    edge = lambda i: i * F.lit(width / bins) + F.lit(low)
    settled = (F.when((guess < bins - 1) & (x >= edge(guess + 1)), guess + 1)
               .when((guess > 0) & (x < edge(guess)), guess - 1).otherwise(guess))
    return settled.cast("double")


IMPUTE_STATS = {"mean": "mean", "median": "median", "most_frequent": "mode"}


def fit_impute(df: DataFrame, columns: list[str], strategy: str = "mean") -> NumericModel:
    """Fill numeric nulls with the train mean, exact median or smallest mode."""
    if strategy not in IMPUTE_STATS:
        raise ValueError(f"unknown impute strategy {strategy!r}; expected {sorted(IMPUTE_STATS)}")
    stat = IMPUTE_STATS[strategy]
    learnt = learn_stats(df, existing(df, columns), [stat])
    return NumericModel("impute", {c: {"fill": p[stat]} for c, p in learnt.items()},
                        {"strategy": strategy})


SCALE_STATS = {"max-min": ["min", "max"], "max": ["maxabs"], "standard": ["mean", "std"]}


def fit_scale(df: DataFrame, columns: list[str], method: str) -> NumericModel:
    """``max-min``, ``max`` (by largest magnitude) or ``standard``/``z-score``."""
    method = "standard" if method == "z-score" else method
    if method not in SCALE_STATS:
        raise ValueError(f"unknown scaling {method!r}")
    learnt = learn_stats(df, existing(df, columns), SCALE_STATS[method])
    return NumericModel(method, {c: p for c, p in learnt.items() if None not in p.values()})


def fit_discretize(df: DataFrame, columns: list[str], bins: int = 5) -> NumericModel:
    """Equal-width ordinal bins; values beyond the train range join the end bins."""
    learnt = learn_stats(df, existing(df, columns), ["min", "max"])
    return NumericModel("discretize", {c: p for c, p in learnt.items() if None not in p.values()},
                        {"bins": bins})


def save_models(spark: SparkSession, models: list[NumericModel], path: str) -> None:
    """Keep fitted transforms, in order, as a small table."""
    rows = [(i, m.to_json()) for i, m in enumerate(models)]
    small_table(spark, rows, "step int, model string").coalesce(1).write.mode("overwrite").parquet(path)


def load_models(spark: SparkSession, path: str) -> list[NumericModel]:
    return [NumericModel.from_json(r["model"])
            for r in spark.read.parquet(path).orderBy("step").collect()]


def apply_models(df: DataFrame, models: list[NumericModel]) -> DataFrame:
    for model in models:
        df = model.transform(df)
    return df
