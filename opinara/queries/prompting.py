"""Prompt tables, injected replies and their log."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinara.functions.lexicons import SENTIMENTS
from opinara.operators import prompts as P
from opinara.queries.registry import query
from opinara.queries.samples import _PICK
from opinara.queries.sqltext import quote, words
from opinara.session import materialize, scratch_path
from opinara.sources.tables import read_runs, write_run


def sized_answers():
    """A deterministic stand-in for a language model: the label follows the prompt length."""
    def answer(prompts: list[str]) -> list[str]:
        labels = ["POSITIVO", "NEGATIVO", "NEUTRO", "no lo sé"]
        return [f"<think>{len(p)}</think> {labels[len(p) % 4].lower()}\n" for p in prompts]
    return answer


_RATE = "CAST(doc_id % 5 + 1 AS VARCHAR)"
_REAL = f"CASE WHEN {_RATE} IN ('1', '2') THEN 'NEGATIVO' WHEN {_RATE} = '3' THEN 'NEUTRO' ELSE 'POSITIVO' END"
# Shown examples: the first row in hash order, over all rows and per label.
_EX = f"""
src AS (SELECT doc_id, text, {_REAL} AS real FROM documents),
ex AS (SELECT *, '- Comment: "' || text || '" -> Label: ' || real line, row_number() OVER (PARTITION BY real ORDER BY md5('42:' || doc_id), doc_id) rc,
       row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) ra FROM src),
tpl AS (SELECT '0-shot' strategy, {quote(P.TASK)} || chr(10) || chr(10) || 'Comment: {{text}}' || chr(10) || 'Label:' AS template
 UNION ALL SELECT '1-shot', {quote(P.TASK)} || chr(10) || chr(10) || 'Example:' || chr(10) || (SELECT line FROM ex WHERE ra = 1) || chr(10) || chr(10) || 'Comment: {{text}}' || chr(10) || 'Label:'
 UNION ALL SELECT 'few-shot', {quote(P.TASK)} || chr(10) || chr(10) || 'Examples:' || chr(10) || (SELECT string_agg(line, chr(10) ORDER BY list_position([{words(P.EXAMPLE_ORDER)}], real)) FROM ex WHERE rc = 1) || chr(10) || chr(10) || 'Comment: {{text}}' || chr(10) || 'Label:'),
pm AS (SELECT doc_id, strategy, template, text entrada, real, replace(template, '{{text}}', text) prompt FROM src, tpl)""".strip()


def prompts(t):
    rated = t.documents.withColumn("score", (F.col("doc_id") % 5 + 1).cast("string"))
    templates = P.classify_templates(rated, "doc_id", "text", "score")
    return P.prompt_rows(rated, "doc_id", "text", templates, "score")


@query("prompt_classify", f"WITH {_EX} SELECT doc_id, strategy, real, md5(prompt) AS prompt_md5, length(prompt) AS n FROM pm")
def prompt_classify(t):
    return prompts(t).select("doc_id", "strategy", "real", F.md5("prompt").alias("prompt_md5"), F.length("prompt").cast("bigint").alias("n"))


@query("prompt_rows", f"WITH {_EX} SELECT strategy, count(*) AS n, count(DISTINCT template) AS templates FROM pm GROUP BY 1")
def prompt_rows(t):
    return prompts(t).groupBy("strategy").agg(F.count("*").alias("n"), F.count_distinct("template").alias("templates"))


_PRED = "['POSITIVO', 'NEGATIVO', 'NEUTRO', 'NO LO SÉ'][(length(prompt) % 4) + 1]"


@query("prompt_infer", f"WITH {_EX} SELECT doc_id, strategy, {_PRED} AS pred FROM pm")
def prompt_infer(t):
    answered = P.read_replies(P.infer(prompts(t).select("doc_id", "strategy", "prompt"), sized_answers))
    return answered.select("doc_id", "strategy", "pred")


_LOG_SQL = f"""
WITH {_EX}, an AS (SELECT *, {_PRED} pred FROM pm), ok AS (SELECT * FROM an WHERE pred IN ({words(SENTIMENTS)})),
lab AS (SELECT strategy, real l, CAST(real = pred AS INT) tp, CAST(real <> pred AS INT) er FROM ok UNION ALL SELECT strategy, pred, 0, CAST(real <> pred AS INT) FROM ok),
per AS (SELECT strategy, l, sum(tp) tp, sum(er) er FROM lab GROUP BY 1, 2),
f AS (SELECT strategy, round(avg(CASE WHEN 2 * tp + er > 0 THEN 2 * tp / (2 * tp + er) ELSE 0 END), 4) f1 FROM per GROUP BY 1)
SELECT doc_id, f1 AS "F-score", 'stub' AS "modelo/tamaño", strategy AS "tipo de prompt", length(template) AS n_template, md5(entrada) AS entrada,
 lower(pred) AS "salida (prediccion)", real AS "salida (real)" FROM an JOIN f USING (strategy)"""


def shown_log(log):
    return (log.withColumn("n_template", F.length("prompt empleado").cast("bigint")).withColumn("entrada", F.md5("entrada"))
            .drop("prompt empleado"))


@query("prompt_log", _LOG_SQL)
def prompt_log(t):
    answered = materialize(P.read_replies(P.infer(prompts(t), sized_answers)), "replies")
    return shown_log(P.prompt_log(answered, "stub", "doc_id"))


@query("prompt_log_sink", f"SELECT *, 'few' AS run_id FROM ({_LOG_SQL.strip()}) UNION ALL SELECT *, 'again' FROM ({_LOG_SQL.strip()})")
def prompt_log_sink(t):
    """Two runs, one of them written twice: its second writing replaces the first."""
    answered = materialize(P.read_replies(P.infer(prompts(t), sized_answers)), "replies")
    log, path = P.prompt_log(answered, "stub", "doc_id"), scratch_path(t.spark, "prompt-log")
    for run in ("few", "again", "few"):
        write_run(log, path, run)
    return shown_log(read_runs(t.spark, path))


_GEN = P.GENERATION.replace("{label}", "POSITIVO")


@query("prompt_generate", f"""
WITH {_PICK.replace("doc_id, source,", "doc_id, text,")},
ex AS (SELECT c_custkey, string_agg('- ' || text, chr(10) ORDER BY doc_id) examples FROM h JOIN pool USING (pos) GROUP BY 1)
SELECT c_custkey, md5(replace({quote(_GEN)}, '{{examples}}', examples)) AS prompt_md5 FROM ex""")
def prompt_generate(t):
    pool = t.documents.filter(F.col("lang") == "es")
    made = P.generation_prompts(t.customer, "c_custkey", pool, "doc_id", "text", "POSITIVO")
    return made.select("c_custkey", F.md5("prompt").alias("prompt_md5"))


@query("synthetic_rows", f"""
WITH {_PICK.replace("doc_id, source,", "doc_id, text,")},
ex AS (SELECT c_custkey, string_agg('- ' || text, chr(10) ORDER BY doc_id) examples FROM h JOIN pool USING (pos) GROUP BY 1)
SELECT lower(['POSITIVO', 'NEGATIVO', 'NEUTRO', 'NO LO SÉ'][(length(replace({quote(_GEN)}, '{{examples}}', examples)) % 4) + 1]) AS content, 'POSITIVO' AS score FROM ex""")
def synthetic_rows(t):
    pool = t.documents.filter(F.col("lang") == "es")
    made = P.generation_prompts(t.customer, "c_custkey", pool, "doc_id", "text", "POSITIVO")
    return P.synthetic_rows(P.infer(made.select("c_custkey", "prompt"), sized_answers), "content", "score", "POSITIVO")
