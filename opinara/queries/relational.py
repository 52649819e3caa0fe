"""Sources, sinks, row selection, relabelling and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinara.functions import labels as LB
from opinara.functions import replies as RP
from opinara.operators import metrics as M
from opinara.operators import rows as R
from opinara.queries.registry import query
from opinara.session import scratch_path
from opinara.sources import tables as S

_RATED = "SELECT o_orderkey, o_totalprice, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) rating, o_orderdate FROM orders"
_BUCKET = ("CASE WHEN rating IN (1, 2) THEN 'NEGATIVO' WHEN rating = 3 THEN 'NEUTRO' "
           "WHEN rating IN (4, 5) THEN 'POSITIVO' ELSE CAST(rating AS VARCHAR) END")


def rated(t):
    return t.orders.select("o_orderkey", "o_totalprice",
                           F.substring("o_orderpriority", 1, 1).cast("int").alias("rating"), "o_orderdate")


def labelled(t):
    return rated(t).withColumn("score", LB.sentiment_bucket(F.col("rating"))).drop("rating")


@query("csv_scan", "SELECT doc_id, text || '\n\"quoted\", ' || source AS text, lang FROM documents")
def csv_scan(t):
    path = scratch_path(t.spark, "csv")
    S.write_csv(t.documents.select("doc_id", F.concat("text", F.lit('\n"quoted", '), "source").alias("text"), "lang"), path)
    return S.read_csv(t.spark, path, "doc_id bigint, text string, lang string")


@query("sink_roundtrip", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_returnflag FROM lineitem")
def sink_roundtrip(t):
    path = scratch_path(t.spark, "sink")
    cols = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag"]
    S.write_csv(t.lineitem.select(*cols), path, separator="\t")
    return S.read_csv(t.spark, path, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                                     "l_quantity double, l_returnflag string", separator="\t")


@query("split_by_class", f"""
SELECT {_BUCKET} AS class_part, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM ({_RATED.replace(" FROM", ", o_orderstatus FROM")}) WHERE o_orderstatus <> 'P' GROUP BY 1""")
def split_by_class(t):
    path = scratch_path(t.spark, "classes")
    rating = F.substring("o_orderpriority", 1, 1).cast("int")
    # Pending orders have no class yet and so no folder.
    data = t.orders.select("o_orderkey", "o_totalprice", F.when(
        F.col("o_orderstatus") != "P", LB.sentiment_bucket(rating)).alias("score"))
    S.split_by_class(data, "score", path)
    return (t.spark.read.parquet(path).groupBy("class_part")
            .agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")))


@query("scan_class_partition", f"SELECT o_orderkey, {_BUCKET} AS score FROM ({_RATED}) WHERE rating <= 2")
def scan_class_partition(t):
    path = scratch_path(t.spark, "classes")
    S.split_by_class(labelled(t), "score", path)
    return S.read_class(t.spark, path, "negativo").select("o_orderkey", "score")


@query("target_last", "SELECT doc_id, text, lang, n_chars, source FROM documents")
def target_last(t):
    return R.target_last(t.documents, "source")


@query("drop_features", "SELECT doc_id, text, lang FROM documents")
def drop_features(t):
    return R.drop_features(t.documents, ["source", "n_chars", "gender"])


_DAY = ("CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%d/%m/%Y') WHEN 1 THEN strftime(o_orderdate, '%d-%m-%Y') "
        "WHEN 2 THEN 'garbage' ELSE strftime(o_orderdate, '%d.%m.%Y') END")


@query("filter_class_years", f"""
SELECT o_orderkey, score, date FROM (SELECT o_orderkey, {_BUCKET} AS score, {_DAY} AS date, o_orderdate FROM ({_RATED}))
WHERE score = 'NEGATIVO' AND date <> 'garbage' AND year(o_orderdate) BETWEEN 1996 AND 1998""")
def filter_class_years(t):
    pick = F.col("o_orderkey") % 4
    text = (F.when(pick == 0, F.date_format("o_orderdate", "dd/MM/yyyy"))
            .when(pick == 1, F.date_format("o_orderdate", "dd-MM-yyyy")).when(pick == 2, F.lit("garbage"))
            .otherwise(F.date_format("o_orderdate", "dd.MM.yyyy")))
    data = labelled(t).withColumn("date", text).drop("o_orderdate")
    return R.filter_class_years(data, "score", "NEGATIVO", "date", 1996, 1998).select("o_orderkey", "score", "date")


@query("label_isin", "SELECT conv_id, turn, role FROM conversations WHERE role IN ('user', 'system')")
def label_isin(t):
    return R.label_isin(t.conversations, "role", ["user", "system"]).select("conv_id", "turn", "role")


@query("filter_class_ci", """
SELECT conv_id, turn FROM conversations WHERE upper(trim(CASE WHEN turn % 2 = 0 THEN '  ' || upper(role) ELSE role END)) = 'USER'""")
def filter_class_ci(t):
    noisy = t.conversations.withColumn("role", F.when(F.col("turn") % 2 == 0, F.concat(F.lit("  "), F.upper("role"))).otherwise(F.col("role")))
    return R.filter_class(noisy, "role", "user").select("conv_id", "turn")


_PRED = "CASE o_orderkey % 7 WHEN 0 THEN 'POSITIVO' WHEN 1 THEN 'NEUTRO' WHEN 2 THEN 'BOH' ELSE score END"
_SCORED = f"SELECT o_orderkey, score AS real, {_PRED} AS pred FROM (SELECT o_orderkey, {_BUCKET} AS score FROM ({_RATED}))"


def predicted(t):
    pick = F.col("o_orderkey") % 7
    pred = (F.when(pick == 0, F.lit("POSITIVO")).when(pick == 1, F.lit("NEUTRO")).when(pick == 2, F.lit("BOH"))
            .otherwise(F.col("score")))
    return labelled(t).select("o_orderkey", F.col("score").alias("real"), pred.alias("pred"))


def counts(t):
    return M.confusion_counts(predicted(t), "real", "pred")


@query("valid_predictions", f"""
SELECT count(*) AS kept, (SELECT count(*) FROM ({_SCORED}) WHERE pred = 'BOH') AS dropped FROM ({_SCORED}) WHERE pred <> 'BOH'""")
def valid_predictions(t):
    scored = predicted(t)
    kept = R.valid_predictions(scored, "pred").agg(F.count("*").alias("kept"))
    return kept.withColumn("dropped", F.lit(scored.count()) - F.col("kept"))


@query("sentiment_bucket", f"SELECT o_orderkey, {_BUCKET} AS score FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 7 ELSE rating END rating FROM ({_RATED}))")
def sentiment_bucket(t):
    rating = F.when(F.col("o_orderkey") % 11 == 0, F.lit(7)).otherwise(F.col("rating"))
    return rated(t).select("o_orderkey", LB.sentiment_bucket(rating).alias("score"))


@query("sentiment_normalize", f"""
SELECT o_orderkey, CASE WHEN r IN ('1', '2') THEN 'NEGATIVO' WHEN r = '3' THEN 'NEUTRO' WHEN r IN ('4', '5') THEN 'POSITIVO' ELSE upper(r) END AS score
FROM (SELECT o_orderkey, trim(CASE o_orderkey % 3 WHEN 0 THEN '  ' || rating || ' ' WHEN 1 THEN rating || '.0' ELSE 'positivo' END) r FROM ({_RATED}))""")
def sentiment_normalize(t):
    pick = F.col("o_orderkey") % 3
    text = (F.when(pick == 0, F.concat(F.lit("  "), "rating", F.lit(" "))).when(pick == 1, F.concat("rating", F.lit(".0")))
            .otherwise(F.lit("positivo")))
    return rated(t).select("o_orderkey", LB.sentiment_normalize(text).alias("score"))


@query("class_distribution", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def class_distribution(t):
    return R.class_distribution(t.events, "event_type")


@query("distinct_labels", "SELECT DISTINCT lang FROM documents")
def distinct_labels(t):
    return R.distinct_labels(t.documents, "lang")


@query("balanced_class_weights", """
SELECT quality, n, round(sum(n) OVER () / (count(*) OVER () * n), 6) AS weight FROM (SELECT quality, count(*) n FROM labels GROUP BY 1)""")
def balanced_class_weights(t):
    return R.balanced_class_weights(t.labels, "quality").withColumn("weight", F.round("weight", 6))


@query("union_synthetic", """
SELECT text, lang, source FROM documents UNION ALL SELECT text, role, NULL FROM conversations""")
def union_synthetic(t):
    made = t.conversations.select("text", F.col("role").alias("lang"))
    return R.union_synthetic(t.documents.select("text", "lang", "source"), made)


@query("confusion_matrix", f"""
SELECT l AS real, count(*) FILTER (WHERE pred = 'BOH') AS "pred_BOH", count(*) FILTER (WHERE pred = 'NEGATIVO') AS "pred_NEGATIVO",
 count(*) FILTER (WHERE pred = 'NEUTRO') AS "pred_NEUTRO", count(*) FILTER (WHERE pred = 'POSITIVO') AS "pred_POSITIVO"
FROM (SELECT unnest(['BOH', 'NEGATIVO', 'NEUTRO', 'POSITIVO']) l) LEFT JOIN ({_SCORED}) ON real = l GROUP BY 1""")
def confusion_matrix(t):
    return M.confusion_matrix(counts(t))


# Every row, over a fixed list with a label that none of them has.
_FIXED = ["MIXTO", "NEGATIVO", "NEUTRO", "POSITIVO"]


@query("confusion_matrix_fixed", f"""
SELECT l AS real, {", ".join(f"count(*) FILTER (WHERE pred = '{c}') AS pred_{c}" for c in _FIXED)}
FROM (SELECT unnest({_FIXED}) l) LEFT JOIN ({_SCORED}) ON real = l GROUP BY 1""")
def confusion_matrix_fixed(t):
    return M.confusion_matrix(counts(t), _FIXED)


def prf_sql(scored: str, average: str, positive: str = "1", by: str = "") -> str:
    """SQL of the scores over ``scored(real, pred)``."""
    b = f"{by}, " if by else ""
    per = f"""lbl AS (SELECT {b}real l, CAST(real = pred AS INT) tp, 0 fp, CAST(real <> pred AS INT) fn FROM scored
  UNION ALL SELECT {b}pred, 0, CAST(real <> pred AS INT), 0 FROM scored),
per AS (SELECT {b}l, sum(tp) tp, sum(fp) fp, sum(fn) fn FROM lbl GROUP BY {b}l)"""
    p, r, f = ("CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END", "CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END",
               "CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END")
    group = f"GROUP BY {by}" if by else ""
    if average == "macro":
        body = f"SELECT {b}round(avg({p}), 6) AS precision, round(avg({r}), 6) AS recall, round(avg({f}), 6) AS f1 FROM per {group}"
    else:
        where = f"WHERE l = '{positive}'" if average == "binary" else ""
        body = (f"SELECT {b}round({p}, 6) AS precision, round({r}, 6) AS recall, round({f}, 6) AS f1 FROM "
                f"(SELECT {b}sum(tp) tp, sum(fp) fp, sum(fn) fn FROM per {where} {group})")
    return f"scored AS ({scored}),\n{per}\n{body}"


def rounded(df, cols=("precision", "recall", "f1")):
    return df.withColumns({c: F.round(c, 6) for c in cols})


@query("prf_micro", f"WITH {prf_sql(_SCORED, 'micro')}")
def prf_micro(t):
    return rounded(M.prf(counts(t), "micro"))


@query("prf_binary", f"WITH {prf_sql(_SCORED, 'binary', 'NEGATIVO')}")
def prf_binary(t):
    return rounded(M.prf(counts(t), "binary", positive="NEGATIVO"))


@query("accuracy", f"SELECT round(avg(CAST(real = pred AS DOUBLE)), 6) AS accuracy FROM ({_SCORED})")
def accuracy(t):
    return rounded(M.accuracy(counts(t)), ["accuracy"])


_TRIALS = f"SELECT trial_id, real, CASE WHEN (o_orderkey + trial_id) % 5 < trial_id % 3 THEN 'NEUTRO' ELSE real END pred FROM ({_SCORED}), (SELECT unnest(range(6)) trial_id)"


def trials(t):
    each = predicted(t).withColumn("trial_id", F.explode(F.sequence(F.lit(0), F.lit(5))))
    wrong = (F.col("o_orderkey") + F.col("trial_id")) % 5 < F.col("trial_id") % 3
    pred = F.when(wrong, F.lit("NEUTRO")).otherwise(F.col("real"))
    return M.trial_scores(M.confusion_counts(each.withColumn("pred", pred), "real", "pred", ["trial_id"]), ["trial_id"])


@query("trial_log", f"""
WITH s AS (WITH {prf_sql(_TRIALS, 'macro', by='trial_id')}), a AS (SELECT trial_id, avg(CAST(real = pred AS DOUBLE)) a FROM ({_TRIALS}) GROUP BY 1)
SELECT 'trial ' || trial_id AS "Combinacion", round(a, 4) AS "Accuracy", round(precision, 4) AS "Precision", round(recall, 4) AS "Recall", round(f1, 4) AS "F_score"
FROM s JOIN a USING (trial_id)""")
def trial_log(t):
    path = scratch_path(t.spark, "trials")
    scores = trials(t).withColumn("name", F.concat(F.lit("trial "), F.col("trial_id").cast("string")))
    # A run that is repeated replaces its own rows.
    for _ in range(2):
        S.write_run(M.trial_log(scores, "name"), path, "grid")
    return S.read_runs(t.spark, path).drop(S.RUN)


@query("best_trial", f"""
WITH s AS (WITH {prf_sql(_TRIALS, 'macro', by='trial_id')})
SELECT CAST(trial_id AS INTEGER) AS trial_id, f1 FROM s ORDER BY f1 DESC, trial_id LIMIT 1""")
def best_trial(t):
    return rounded(M.best_trial(trials(t)), ["f1"]).select("trial_id", "f1")


_REPLY = "CASE doc_id % 3 WHEN 0 THEN '<THINK>a' || chr(10) || 'b</think> positivo ' || chr(10) WHEN 1 THEN '<think>x</think>neutro<think>y</think>' ELSE '<think>why</think> ' || text END"


def reply_text():
    pick = F.col("doc_id") % 3
    return (F.when(pick == 0, F.lit("<THINK>a\nb</think> positivo \n"))
            .when(pick == 1, F.lit("<think>x</think>neutro<think>y</think>")).otherwise(F.concat(F.lit("<think>why</think> "), "text")))


_WS = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"


@query("strip_reasoning", rf"""
SELECT doc_id, upper(regexp_replace(regexp_replace(replace({_REPLY}, 'ß', 'ss'), '(?is)<think>.*?</think>', '', 'g'), '^{_WS}+|{_WS}+\z', '', 'g')) AS label FROM documents""")
def strip_reasoning(t):
    return t.documents.select("doc_id", RP.reply_label(reply_text()).alias("label"))


@query("strip_quotes", """
SELECT doc_id, trim(trim(CASE WHEN doc_id % 2 = 0 THEN '"''' || lang || '''"' ELSE '""' || lang || '"x' END, '"'), '''') AS text FROM documents""")
def strip_quotes(t):
    text = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit('"\''), "lang", F.lit('\'"'))).otherwise(
        F.concat(F.lit('""'), "lang", F.lit('"x')))
    return t.documents.select("doc_id", RP.strip_quotes(text).alias("text"))
