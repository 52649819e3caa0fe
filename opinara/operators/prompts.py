"""Prompt tables for labelling and for synthetic reviews, and their evaluation.

The model itself is a callable the caller injects. It runs inside
``mapInPandas``, one call per Arrow batch, so prompts spread over all
executors instead of going out one by one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions.labels import sentiment_normalize
from opinara.functions.lexicons import SENTIMENTS
from opinara.functions.replies import reply_label, strip_quotes, strip_reasoning
from opinara.operators import metrics
from opinara.operators.sampling import SEED, examples_per_request, one_per_class

STRATEGIES = ["0-shot", "1-shot", "few-shot"]
# Order in which few-shot examples are shown.
EXAMPLE_ORDER = ["POSITIVO", "NEGATIVO", "NEUTRO"]
NO_EXAMPLES = "No hay ejemplos disponibles."
EXAMPLE_COUNT = 3
EXAMPLE_TITLES = {"1-shot": "Example:", "few-shot": "Examples:"}

TASK = ("You label the sentiment of a comment. Answer with exactly one of POSITIVO, NEGATIVO or "
        "NEUTRO and nothing else: no reasoning, no explanation.")
GENERATION = ("You write training data. Write one new, natural English user review of the app that "
              "clearly has a {label} sentiment, in the style and length of the examples.\n\n"
              "Examples with {label} sentiment:\n{examples}\n\n"
              "Without examples, write it freely. Answer with the review only and use no commas.")


def example_line(text: Column, label: Column) -> Column:
    return F.concat(F.lit('- Comment: "'), text, F.lit('" -> Label: '), label)


def classify_templates(train: DataFrame, key: str, text_col: str, target: str, seed: int = SEED,
                       task: str = TASK) -> dict[str, str]:
    """One template per strategy, with ``{text}`` where the comment goes.

    At most one example per label is fetched, so nothing but four rows
    reaches the driver.
    """
    pool = train.select(key, F.col(text_col).alias("text"),
                        sentiment_normalize(F.col(target)).alias("label")).filter(F.col("label").isin(SENTIMENTS))
    line = example_line(F.coalesce(F.col("text"), F.lit("nan")), F.col("label")).alias("line")
    per_class = {r["label"]: r["line"] for r in one_per_class(pool, key, "label", seed).select("label", line).collect()}
    single = [r["line"] for r in one_per_class(pool, key, None, seed).select(line).collect()]
    shown = {"0-shot": [], "1-shot": single, "few-shot": [per_class[c] for c in EXAMPLE_ORDER if c in per_class]}
    out = {}
    for strategy in STRATEGIES:
        parts = [task]
        if strategy in EXAMPLE_TITLES:
            parts.append(EXAMPLE_TITLES[strategy] + "\n" + "\n".join(shown[strategy]))
        parts.append("Comment: {text}\nLabel:")
        out[strategy] = "\n\n".join(parts)
    return out


def prompt_rows(df: DataFrame, key: str, text_col: str, templates: dict[str, str],
                target: str | None = None) -> DataFrame:
    """``(key, strategy, template, entrada, [real], prompt)``: every row under every strategy."""
    choices = F.explode(F.array(*[F.struct(F.lit(s).alias("strategy"), F.lit(t).alias("template"))
                                  for s, t in templates.items()])).alias("__c")
    real = [sentiment_normalize(F.col(target)).alias("real")] if target else []
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("nan")).alias("entrada")
    staged = df.select(key, text, *real, choices)
    return staged.select(key, "__c.strategy", "__c.template", "entrada", *(["real"] if target else []),
                         F.replace(F.col("__c.template"), F.lit("{text}"), F.col("entrada")).alias("prompt"))


def generation_prompts(requests: DataFrame, request: str, pool: DataFrame, key: str, text_col: str,
                       label: str, seed: int = SEED, template: str = GENERATION) -> DataFrame:
    """``(request, examples, prompt)`` with up to three pool rows as bullets."""
    shown = (examples_per_request(requests, request, pool.select(key, text_col), key, EXAMPLE_COUNT, seed)
             .groupBy(request)
             .agg(F.array_join(F.transform(
                 F.array_sort(F.collect_list(F.struct(key, F.concat(F.lit("- "), F.col(text_col)).alias("l")))),
                 lambda s: s["l"]), "\n").alias("examples")))
    joined = requests.select(request).join(shown, request, "left").withColumn(
        "examples", F.coalesce("examples", F.lit(NO_EXAMPLES)))
    filled = F.replace(F.replace(F.lit(template), F.lit("{label}"), F.lit(label)),
                       F.lit("{examples}"), F.col("examples"))
    return joined.select(request, "examples", filled.alias("prompt"))


def infer(prompts: DataFrame, client: Callable[[], Callable[[list[str]], list[str]]],
          prompt_col: str = "prompt", reply_col: str = "reply") -> DataFrame:
    """Add the model's reply to every prompt.

    ``client`` builds the model once per task; what it returns answers a list
    of prompts.
    """
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in prompts.schema)}, `{reply_col}` string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        answer = client()
        for batch in batches:
            yield batch.assign(**{reply_col: answer(batch[prompt_col].tolist())})

    return prompts.mapInPandas(run, schema)


def read_replies(replies: DataFrame, reply_col: str = "reply") -> DataFrame:
    """Add ``salida`` (reasoning removed) and ``pred`` (its label form)."""
    return (replies.withColumn("salida", strip_reasoning(F.col(reply_col)))
            .withColumn("pred", reply_label(F.col(reply_col))))


def strategy_scores(answered: DataFrame, average: str = "macro") -> DataFrame:
    """Precision, recall and F1 per strategy over the valid answers only."""
    valid = answered.filter(F.col("pred").isin(SENTIMENTS))
    return metrics.prf(metrics.confusion_counts(valid, "real", "pred", ["strategy"]), average, ["strategy"])


def prompt_log(answered: DataFrame, model: str, key: str, average: str = "macro") -> DataFrame:
    """The experiment log: every answer with its strategy's F-score."""
    scores = strategy_scores(answered, average).select("strategy", F.round("f1", 4).alias("F-score"))
    return (answered.join(F.broadcast(scores), "strategy", "left")
            .select(key, F.coalesce("F-score", F.lit(0.0)).alias("F-score"), F.lit(model).alias("modelo/tamaño"),
                    F.col("strategy").alias("tipo de prompt"), F.trim("template").alias("prompt empleado"),
                    "entrada", F.col("salida").alias("salida (prediccion)"),
                    F.col("real").alias("salida (real)")))


def synthetic_rows(replies: DataFrame, text_col: str, target: str, label: str,
                   reply_col: str = "reply") -> DataFrame:
    """``(text_col, target)`` rows from generation replies."""
    return replies.select(strip_quotes(strip_reasoning(F.col(reply_col))).alias(text_col),
                          F.lit(label).alias(target))
