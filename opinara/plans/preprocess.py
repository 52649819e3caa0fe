"""The preprocessing chain: learnt on train, applied blindly to anything else.

Order: drop columns, impute, discretise, text to vectors, scale. Balancing is
for the train rows only and comes last.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.functions import cleaning
from opinara.operators import features as FT
from opinara.operators import numeric as N
from opinara.operators import oversample, sampling
from opinara.operators import vectorize as V
from opinara.operators import words
from opinara.plans.config import JobConfig
from opinara.session import materialize, small_table

# Dense vectors are needed to interpolate rows and to measure distances.
MAX_DENSE = 20_000


@dataclass
class TextTool:
    """What a text column needs: its dictionary words, vocabulary and vectoriser."""

    column: str
    lexicon: DataFrame | None
    vectors: V.TextVectors
    model: PipelineModel


@dataclass
class Preprocessor:
    config: JobConfig
    key: str
    target: str
    numeric: list[N.NumericModel] = field(default_factory=list)
    texts: list[TextTool] = field(default_factory=list)
    columns: list[str] = field(default_factory=list)

    def _clean(self, df: DataFrame, column: str, lexicon: DataFrame | None) -> DataFrame:
        return words.clean_corpus(df, self.key, column, self.config.language, self.config.project,
                                  self.config.algorithm, lexicon)

    def _numbers(self, df: DataFrame) -> DataFrame:
        return N.apply_models(df.drop(*self.config.prep.get("drop_features", [])), self.numeric)

    def transform(self, df: DataFrame) -> DataFrame:
        """``(key, <numeric columns>, features, target)``, written once."""
        ready = self._numbers(df)
        inputs = []
        for tool in self.texts:
            tokens = self._clean(df.select(self.key, tool.column), tool.column, tool.lexicon)
            grams = V.gram_column(tokens, F.col("tokens"), tool.vectors.up_to)
            out = f"{tool.column}_vector"
            ready = ready.join(tool.model.transform(grams).select(self.key, F.col("features").alias(out)), self.key)
            inputs.append(out)
        if len(inputs) == 1 and not self.columns:
            ready = ready.withColumnRenamed(inputs[0], "features")
        else:
            ready = FT.column_assembler(self.columns + inputs).transform(ready)
        keep = [c for c in (self.key, *self.columns, "features", self.target) if c in ready.columns]
        return materialize(ready.select(*keep), "prepared")

    def long_rows(self, df: DataFrame) -> DataFrame:
        """``(key, term, weight)``: text weights and numeric columns as one long table."""
        out = None
        for tool in self.texts:
            tokens = self._clean(df.select(self.key, tool.column), tool.column, tool.lexicon)
            weights = tool.vectors.transform(tokens, F.col("tokens"))
            named = weights.select(self.key, F.concat_ws("_", F.lit(tool.column), F.lit(V.METHODS[tool.vectors.method]),
                                                         "term").alias("term"), "weight")
            out = named if out is None else out.unionByName(named)
        if self.columns:
            cells = F.explode(F.array(*[F.struct(F.lit(c).alias("term"), F.col(c).cast("double").alias("weight"))
                                        for c in self.columns])).alias("c")
            values = self._numbers(df).select(self.key, cells).select(self.key, "c.*").filter(F.col("weight") != 0)
            out = values if out is None else out.unionByName(values)
        return materialize(out, "long-rows")

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        N.save_models(spark, self.numeric, os.path.join(path, "numeric"))
        about = {"config": self.config.options, "key": self.key, "target": self.target, "columns": self.columns,
                 "texts": [{"column": t.column, "method": t.vectors.method, "up_to": t.vectors.up_to,
                            "n_docs": t.vectors.n_docs, "lexicon": t.lexicon is not None} for t in self.texts]}
        small_table(spark, [(json.dumps(about),)], "about string").write.mode("overwrite").parquet(os.path.join(path, "about"))
        for i, tool in enumerate(self.texts):
            base = os.path.join(path, f"text-{i}")
            tool.vectors.vocab.write.mode("overwrite").parquet(os.path.join(base, "vocabulary"))
            tool.model.write().overwrite().save(os.path.join(base, "model"))
            if tool.lexicon is not None:
                tool.lexicon.write.mode("overwrite").parquet(os.path.join(base, "lexicon"))

    @staticmethod
    def load(spark: SparkSession, path: str) -> Preprocessor:
        about = json.loads(spark.read.parquet(os.path.join(path, "about")).first()["about"])
        tools = []
        for i, t in enumerate(about["texts"]):
            base = os.path.join(path, f"text-{i}")
            vocab = spark.read.parquet(os.path.join(base, "vocabulary"))
            vectors = V.TextVectors(about["key"], t["method"], t["up_to"], vocab, t["n_docs"], None)
            lexicon = spark.read.parquet(os.path.join(base, "lexicon")) if t["lexicon"] else None
            tools.append(TextTool(t["column"], lexicon, vectors, PipelineModel.load(os.path.join(base, "model"))))
        return Preprocessor(JobConfig(about["config"]), about["key"], about["target"],
                            N.load_models(spark, os.path.join(path, "numeric")), tools, about["columns"])


def fit_preprocessor(config: JobConfig, train: DataFrame, key: str, target: str,
                     lexicon: DataFrame | None = None) -> Preprocessor:
    """Learn every step from ``train``.

    ``lexicon(word)`` lists the base forms English lemmas may take; by default
    these are the words of the train texts.
    """
    prep = config.prep
    pre = Preprocessor(config, key, target)
    skip = [key, target]
    data = train.drop(*prep.get("drop_features", []))

    def learn(model: N.NumericModel) -> None:
        nonlocal data
        pre.numeric.append(model)
        data = model.transform(data)

    if prep.get("missing_values") == "impute":
        learn(N.fit_impute(data, N.numeric_columns(data, skip), prep.get("impute_strategy", "mean")))
    binned = N.existing(data, prep.get("continuous_features_discretize", []))
    if binned:
        learn(N.fit_discretize(data, binned, prep.get("discretize_bins", 5)))
    method = prep.get("text_preprocess")
    if method in V.METHODS:
        for column in N.existing(data, prep.get("categorical_features_convert", [])):
            pre.texts.append(_fit_text(pre, train, column, method, lexicon))
    if prep.get("scaling") in ("max-min", "max", "z-score", "standard"):
        wanted = prep.get("features_scale") or N.numeric_columns(data, skip)
        learn(N.fit_scale(data, N.existing(data, wanted), prep["scaling"]))
    pre.columns = N.numeric_columns(data, skip)
    if not pre.columns and not pre.texts:
        raise ValueError("no numeric column and no converted text column: nothing to learn from")
    return pre


def _fit_text(pre: Preprocessor, train: DataFrame, column: str, method: str, lexicon: DataFrame | None) -> TextTool:
    config = pre.config
    texts = train.select(pre.key, column)
    if config.language == "english" and lexicon is None:
        stop = cleaning.stopwords(config.language, config.project, config.algorithm)
        rows = words.token_rows(texts, pre.key, cleaning.clean_tokens(F.col(column), config.language, stop))
        lexicon = materialize(rows.select("word").distinct(), "lexicon")
    tokens = pre._clean(texts, column, lexicon)
    vectors = V.fit_text(tokens, pre.key, F.col("tokens"), method, config.prep.get("ngramas_tfidf", 1))
    return TextTool(column, lexicon, vectors, FT.text_stages(vectors).model())


def dense(df: DataFrame, vec: str = "vec") -> DataFrame:
    """Add the features as an array; very wide vectors are refused."""
    width = df.select(F.array_size(vector_to_array("features")).alias("n")).first()
    if width and width["n"] > MAX_DENSE:
        raise ValueError(f"{width['n']} features are too many for dense rows; raise min_df or drop columns")
    return df.withColumn(vec, vector_to_array("features"))


def balance(config: JobConfig, train: DataFrame, key: str, target: str) -> DataFrame:
    """Balance prepared train rows: ``(key, features, target)`` with string keys if rows were made."""
    method, ratio = config.prep.get("sampling"), config.prep.get("balance", "auto")
    if method == "undersampling":
        return sampling.undersample(train, key, target, ratio)
    if method == "oversampling":
        made = oversample.smote(dense(train), key, "vec", target, ratio)
        # A synthetic row is named after its parents and its place among their children.
        nth = F.row_number().over(sampling.W.partitionBy("source_key", "neighbor").orderBy("vec"))
        name = F.when(F.col("synthetic"), F.concat_ws(":", "source_key", "neighbor", nth)).otherwise(
            F.col("source_key").cast("string"))
        return materialize(made.select(name.alias(key), array_to_vector("vec").alias("features"), target), "balanced")
    return train
