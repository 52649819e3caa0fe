"""Numeric transforms learnt on one part and applied to all rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinara.operators import numeric as N
from opinara.queries.registry import query
from opinara.session import scratch_path

KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
KEY_SQL = ", ".join(KEY)
COLS = ["l_quantity", "l_extendedprice", "l_discount"]
_SRC = f"""
src AS (SELECT {KEY_SQL}, l_linestatus, nullif(l_quantity, 7.0) l_quantity, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_extendedprice END l_extendedprice,
        nullif(l_discount, 0.05) l_discount FROM lineitem),
tr AS (SELECT * FROM src WHERE l_linestatus = 'F')""".strip()


def source(t):
    return t.lineitem.select(*KEY, "l_linestatus", F.nullif("l_quantity", F.lit(7.0)).alias("l_quantity"),
                             F.when(F.col("l_linenumber") != 3, F.col("l_extendedprice")).alias("l_extendedprice"),
                             F.nullif("l_discount", F.lit(0.05)).alias("l_discount"))


def train(t):
    return source(t).filter(F.col("l_linestatus") == "F")


def shown(df, cols=COLS, digits=6):
    # Adding zero turns a negative zero into a plain one.
    return df.select(*KEY, *[(F.round(c, digits) + 0.0).alias(c) for c in cols])


def _impute_sql(stat: str) -> str:
    fills = ", ".join(f"{stat.format(c)} f{i}" for i, c in enumerate(COLS))
    out = ", ".join(f"round(coalesce({c}, f{i}), 6) AS {c}" for i, c in enumerate(COLS))
    return f"WITH {_SRC}, p AS (SELECT {fills} FROM tr) SELECT {KEY_SQL}, {out} FROM src, p"


def _mode_sql() -> str:
    fills = ", ".join(f"(SELECT {c} FROM tr WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) f{i}"
                      for i, c in enumerate(COLS))
    out = ", ".join(f"round(coalesce({c}, f{i}), 6) AS {c}" for i, c in enumerate(COLS))
    return f"WITH {_SRC}, p AS (SELECT {fills}) SELECT {KEY_SQL}, {out} FROM src, p"


@query("impute_mean", _impute_sql("avg({0})"))
def impute_mean(t):
    return shown(N.fit_impute(train(t), COLS, "mean").transform(source(t)))


@query("impute_median", _impute_sql("median({0})"))
def impute_median(t):
    return shown(N.fit_impute(train(t), COLS, "median").transform(source(t)))


@query("impute_mode", _mode_sql())
def impute_mode(t):
    return shown(N.fit_impute(train(t), COLS, "most_frequent").transform(source(t)))


def _stats_sql(parts: str, out: str) -> str:
    stats = ", ".join(parts.format(c=c, i=i) for i, c in enumerate(COLS))
    cols = ", ".join(out.format(c=c, i=i) for i, c in enumerate(COLS))
    return f"WITH {_SRC}, p AS (SELECT {stats} FROM tr) SELECT {KEY_SQL}, {cols} FROM src, p"


@query("discretize_uniform", _stats_sql(
    "min({c}) lo{i}, max({c}) hi{i}",
    "CAST(CASE WHEN {c} IS NOT NULL THEN len(list_filter(range(1, 10), lambda j: {c} >= j * ((hi{i} - lo{i}) / 10) + lo{i})) END AS DOUBLE) AS {c}_disc"))
def discretize_uniform(t):
    model = N.fit_discretize(train(t), COLS, 10)
    return model.transform(source(t)).select(*KEY, *[f"{c}_disc" for c in COLS])


@query("scale_minmax", _stats_sql("min({c}) lo{i}, max({c}) hi{i}", "round(({c} - lo{i}) / (hi{i} - lo{i}), 6) AS {c}"))
def scale_minmax(t):
    return shown(N.fit_scale(train(t), COLS, "max-min").transform(source(t)))


@query("scale_maxabs", _stats_sql("max(abs({c})) m{i}", "round({c} / m{i}, 6) AS {c}"))
def scale_maxabs(t):
    return shown(N.fit_scale(train(t), COLS, "max").transform(source(t)))


@query("scale_standard", _stats_sql("avg({c}) m{i}, stddev_pop({c}) s{i}", "round(({c} - m{i}) / s{i}, 6) + 0.0 AS {c}"))
def scale_standard(t):
    return shown(N.fit_scale(train(t), COLS, "z-score").transform(source(t)))


@query("apply_fitted_transforms", f"""
WITH {_SRC}, p AS (SELECT avg(l_quantity) f0, avg(l_extendedprice) f1, avg(l_discount) f2 FROM tr),
im AS (SELECT {KEY_SQL}, l_linestatus, coalesce(l_quantity, f0) q, coalesce(l_extendedprice, f1) e, coalesce(l_discount, f2) d FROM src, p),
b AS (SELECT min(q) lo, max(q) hi, avg(e) me, stddev_pop(e) se FROM im WHERE l_linestatus = 'F')
SELECT {KEY_SQL}, CAST(len(list_filter(range(1, 5), lambda j: q >= j * ((hi - lo) / 5) + lo)) AS DOUBLE) AS l_quantity_disc,
 round((e - me) / se, 6) + 0.0 AS l_extendedprice, round(d, 6) AS l_discount FROM im, b WHERE l_linestatus = 'O'""")
def apply_fitted_transforms(t):
    impute = N.fit_impute(train(t), COLS)
    ready = impute.transform(train(t))
    bins, scale = N.fit_discretize(ready, ["l_quantity"]), N.fit_scale(ready, ["l_extendedprice"], "standard")
    path = scratch_path(t.spark, "tools")
    N.save_models(t.spark, [impute, bins, scale], path)
    unseen = source(t).filter(F.col("l_linestatus") == "O")
    return shown(N.apply_models(unseen, N.load_models(t.spark, path)),
                 ["l_quantity_disc", "l_extendedprice", "l_discount"])


@query("column_stats", f"""
WITH {_SRC} """ + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(avg({c}), 5) AS mean, median({c}) AS median, "
    f"(SELECT {c} FROM src WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS mode, "
    f"min({c}) AS min, max({c}) AS max, max(abs({c})) AS maxabs, round(stddev_pop({c}), 5) AS std FROM src" for c in COLS))
def column_stats(t):
    stats = N.column_stats(source(t), COLS, ["mean", "median", "mode", "min", "max", "maxabs", "std"])
    return stats.withColumns({"mean": F.round("mean", 5), "std": F.round("std", 5)})
