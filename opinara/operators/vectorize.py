"""Text vectorisation as a long table ``(key, term, tf, weight)``.

The long form keeps only the non-zeros, so a vocabulary of any size fits;
``to_sparse`` turns it into MLlib vectors where a learner needs them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opinara.functions import cleaning
from opinara.operators.lookup import lookup_join
from opinara.session import materialize

METHODS = {"tf-idf": "tfidf", "frequency": "frequency", "one-hot": "onehot"}


def gram_column(df: DataFrame, tokens: Column, up_to: int = 1, grams: str = "grams") -> DataFrame:
    """Add the array of n-grams a vocabulary counts."""
    staged = df.withColumn("__words", cleaning.content_words(tokens))
    return staged.withColumn(grams, cleaning.ngrams(F.col("__words"), up_to)).drop("__words")


def term_counts(df: DataFrame, key: str, tokens: Column, up_to: int = 1) -> DataFrame:
    """``(key, term, tf)``: one row per distinct n-gram of a document.

    The count is combined before the shuffle, in the task that exploded the
    document, so a long document ships each word once.
    """
    grams = gram_column(df, tokens, up_to)
    return (grams.select(key, F.explode("grams").alias("term")).groupBy(key, "term")
            .agg(F.count("*").alias("tf")))


def vocabulary(counts: DataFrame, min_df: int = 1) -> DataFrame:
    """``(term, df, total)`` of the terms found in at least ``min_df`` documents."""
    return (counts.groupBy("term")
            .agg(F.count("*").alias("df"), F.sum("tf").alias("total"))
            .filter(F.col("df") >= min_df))


def number_terms(vocab: DataFrame) -> DataFrame:
    """Add ``idx``: the position of each term in sorted order, from 0.

    Terms are numbered inside buckets of equal leading characters and shifted
    by the size of the buckets before, so no task sorts the whole vocabulary.
    """
    lead = F.substring("term", 1, 3)
    buckets = (vocab.groupBy(lead.alias("__lead")).agg(F.count("*").alias("__n"))
               .withColumn("__offset", F.coalesce(F.sum("__n").over(
                   W.orderBy("__lead").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))))
    local = F.row_number().over(W.partitionBy("__lead").orderBy("term"))
    return (vocab.withColumn("__lead", lead).withColumn("__local", local)
            .join(buckets.select("__lead", "__offset"), "__lead")
            .withColumn("idx", (F.col("__offset") + F.col("__local") - 1).cast("int"))
            .drop("__lead", "__local", "__offset"))


def name_features(vocab: DataFrame, column: str, method: str) -> DataFrame:
    """Add the wide-table name ``<column>_<prefix>_<term>`` of each term."""
    return vocab.withColumn("feature", F.concat_ws("_", F.lit(column), F.lit(METHODS[method]), "term"))


@dataclass
class TextVectors:
    """A vocabulary learnt from one table, applied to any."""

    key: str
    method: str
    up_to: int
    vocab: DataFrame
    n_docs: int
    counts: DataFrame

    def weigh(self, counts: DataFrame) -> DataFrame:
        """``(key, term, tf, weight)``; terms outside the vocabulary are dropped."""
        known = lookup_join(counts, self.vocab, "term", "df")
        if self.method == "one-hot":
            return known.select(self.key, "term", "tf", F.lit(1.0).alias("weight"))
        if self.method == "frequency":
            return known.select(self.key, "term", "tf", F.col("tf").cast("double").alias("weight"))
        idf = F.log(F.lit(1.0 + self.n_docs) / (F.col("df") + 1.0)) + 1.0
        raw = known.select(self.key, "term", "tf", (F.col("tf") * idf).alias("raw"))
        norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(W.partitionBy(self.key)))
        return raw.select(self.key, "term", "tf", (F.col("raw") / norm).alias("weight"))

    @cached_property
    def numbered(self) -> DataFrame:
        """``(term, df, idx)``, written once."""
        return materialize(number_terms(self.vocab).select("term", "df", "idx"), "numbered-terms")

    def packed(self, counts: DataFrame | None = None) -> DataFrame:
        """``(key, indices, values)``: the weights of ``weigh`` by term number, one row per document with known terms.

        The counts (those of the fitted table unless given) meet the vocabulary
        once, and from there on only numbers are shuffled.
        """
        known = lookup_join(self.counts if counts is None else counts, self.numbered, "term", "df")
        if self.method == "one-hot":
            raw = F.lit(1.0)
        elif self.method == "frequency":
            raw = F.col("tf").cast("double")
        else:
            raw = F.col("tf") * (F.log(F.lit(1.0 + self.n_docs) / (F.col("df") + 1.0)) + 1.0)
        lists = (known.select(self.key, "idx", raw.alias("raw")).groupBy(self.key)
                 .agg(F.array_sort(F.collect_list(F.struct("idx", "raw"))).alias("__e")))
        values = F.col("__e.raw")
        if self.method == "tf-idf":
            norm = F.sqrt(F.aggregate("__e", F.lit(0.0), lambda s, e: s + e["raw"] * e["raw"]))
            # As a lambda's variable the norm is computed once a row, not once an entry.
            values = F.element_at(F.transform(F.array(norm), lambda n: F.transform("__e", lambda e: e["raw"] / n)), 1)
        return lists.select(self.key, F.col("__e.idx").alias("indices"), values.alias("values"))

    def fitted(self) -> DataFrame:
        """The table the vocabulary was learnt from, weighed."""
        return self.weigh(self.counts)

    def transform(self, df: DataFrame, tokens: Column) -> DataFrame:
        """Another table, weighed with the learnt vocabulary."""
        return self.weigh(term_counts(df, self.key, tokens, self.up_to))


def fit_text(df: DataFrame, key: str, tokens: Column, method: str = "tf-idf", up_to: int = 1,
             min_df: int | None = None) -> TextVectors:
    """Learn the vocabulary. TF-IDF needs 3 documents per term unless told otherwise.

    Term and one-hot counts use single words, whatever ``up_to`` says. Cleaning
    is the costly part, so the counts are written once to the shared folder and
    every later step (vocabulary, weights, learners) reads them from there.
    """
    if method not in METHODS:
        raise ValueError(f"unknown text method {method!r}; expected one of {sorted(METHODS)}")
    if method != "tf-idf":
        up_to = 1
    floor = min_df if min_df is not None else (3 if method == "tf-idf" else 1)
    counts = materialize(term_counts(df, key, tokens, up_to), "term-counts")
    vocab = materialize(vocabulary(counts, floor), "vocabulary")
    return TextVectors(key, method, up_to, vocab, df.count(), counts)


def presence_texts(weights: DataFrame, key: str) -> DataFrame:
    """Each document as its sorted, repeat-free vocabulary terms."""
    return (weights.filter(F.col("weight") > 0).groupBy(key)
            .agg(F.array_sort(F.collect_set("term")).alias("terms")))


def bow_corpus(weights: DataFrame, numbered: DataFrame, key: str) -> DataFrame:
    """Each document as ``array<struct<idx, weight>>`` ordered by term index."""
    entries = materialize(numbered.select("term", "df", "idx"), "numbered-terms")
    indexed = lookup_join(weights.filter(F.col("weight") > 0), entries, "term", "df")
    return (indexed.groupBy(key)
            .agg(F.array_sort(F.collect_list(F.struct("idx", "weight"))).alias("bow")))


def corpus_stats(weights: DataFrame, n_docs: int) -> DataFrame:
    """Documents, total weight and non-zero entries of a long table."""
    return weights.agg(F.lit(n_docs).cast("bigint").alias("num_docs"),
                       F.sum("weight").alias("total_weight"),
                       F.count_if(F.col("weight") > 0).alias("num_nnz"))
