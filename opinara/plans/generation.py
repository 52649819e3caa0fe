"""Prompt jobs: label reviews under three strategies, or write synthetic ones."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.operators import prompts
from opinara.operators.rows import filter_class
from opinara.operators.sampling import first_n
from opinara.functions.labels import sentiment_normalize
from opinara.session import materialize
from opinara.sources.tables import write_run


def classify(data: DataFrame, train: DataFrame, key: str, text_col: str, target: str,
             client: Callable, model: str, sample: int = -1, average: str = "macro",
             templates: dict[str, str] | None = None, log_path: str | None = None,
             run: str = "classify") -> tuple[DataFrame, DataFrame]:
    """``(log, scores)`` of one labelling experiment per prompt strategy.

    Replies are written before they are scored, so no prompt is sent twice. With
    ``log_path`` the log is kept there as ``run``, in place of an earlier run of that name.
    """
    templates = templates or prompts.classify_templates(train, key, text_col, target)
    rows = prompts.prompt_rows(first_n(data, key, sample), key, text_col, templates, target)
    answered = materialize(prompts.read_replies(prompts.infer(rows, client)), "replies")
    log = prompts.prompt_log(answered, model, key, average)
    if log_path:
        write_run(log, log_path, run)
    return log, prompts.strategy_scores(answered, average)


def generate(data: DataFrame, key: str, text_col: str, target: str, label: str, count: int,
             client: Callable, template: str = prompts.GENERATION) -> DataFrame:
    """``count`` synthetic ``(text, label)`` rows with examples of the class in each prompt."""
    named = data.withColumn(target, sentiment_normalize(F.col(target)))
    pool = filter_class(named, target, label).select(key, text_col).filter(F.col(text_col).isNotNull())
    requests = data.sparkSession.range(count).withColumnRenamed("id", "request")
    asked = prompts.generation_prompts(requests, "request", pool, key, text_col, label, template=template)
    answered = materialize(prompts.infer(asked.select("request", "prompt"), client), "replies")
    return prompts.synthetic_rows(answered, text_col, target, label)
