"""Dictionary work on tokens: stop lists, look-ups, lemmas, stems.

Everything is decided once per distinct word and then brought back to the
tokens, frequent words by broadcast (see ``lookup_join``); lemmas and stems
travel as small maps, one for each piece of a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions import cleaning, lexicons
from opinara.functions.stemming import add_stem
from opinara.operators.lookup import lookup_join
from opinara.session import materialize


def token_rows(df: DataFrame, key: str, tokens: Column) -> DataFrame:
    """``(key, pos, word)``, one row per token.

    The token arrays are written once: counting the distinct words and joining
    them back both read them, and neither should clean the text again.
    """
    kept = materialize(df.select(key, tokens.alias("tokens")), "tokens")
    return kept.select(key, F.posexplode("tokens").alias("pos", "word"))


def word_counts(tokens: DataFrame) -> DataFrame:
    return tokens.groupBy("word").agg(F.count("*").alias("n"))


def drop_listed(tokens: DataFrame, listed: DataFrame) -> DataFrame:
    """Token rows whose word is not in ``listed(word)``, however long that list is."""
    kept = word_counts(tokens).join(listed.select("word").distinct(), "word", "left_anti")
    return lookup_join(tokens, materialize(kept, "kept-words"), "word", "n").drop("n")


def replace_words(tokens: DataFrame, mapping: DataFrame, out: str) -> DataFrame:
    """Add ``out`` from ``mapping(word, out, n)``, which covers every word."""
    table = materialize(mapping.select("word", out, "n"), "word-map")
    return lookup_join(tokens, table, "word", "n").drop("n")


def lexicon_join(tokens: DataFrame, lexicon: DataFrame, out: str = "replacement") -> DataFrame:
    """Look every word up in ``lexicon(word, out)``; unknown words stay as they are."""
    mapping = (word_counts(tokens).join(lexicon.select("word", out).dropDuplicates(["word"]), "word", "left")
               .withColumn(out, F.coalesce(out, "word")))
    return replace_words(tokens, mapping, out)


def noun_candidates(word: Column) -> Column:
    """The word itself and what each noun ending rule makes of it."""
    made = [F.when(F.endswith(word, F.lit(end)) & (F.length(word) > len(end)),
                   F.concat(F.substring(word, 1, F.length(word) - len(end)), F.lit(new)))
            for end, new in lexicons.NOUN_ENDINGS]
    return F.array(word, *made)


def lemma_map(words: DataFrame, lexicon: DataFrame | None = None,
              exceptions: DataFrame | None = None) -> DataFrame:
    """``(word, lemma, n)``: the shortest candidate the lexicon knows, else the word.

    ``words`` is ``(word, n)``; ``lexicon(word)`` defaults to those words;
    ``exceptions(word, lemma)`` lists irregular forms, tried before the rules.
    """
    known = (words if lexicon is None else lexicon).select(F.col("word").alias("candidate")).distinct()
    offered = F.filter(noun_candidates(F.col("word")), lambda c: c.isNotNull())
    pool = words.select("word", offered.alias("offered"))
    if exceptions is not None:
        irregular = exceptions.select("word", F.col("lemma").alias("irregular")).dropDuplicates(["word"])
        pool = (pool.join(irregular, "word", "left")
                .select("word", F.when(F.col("irregular").isNotNull(), F.array("word", "irregular"))
                        .otherwise(F.col("offered")).alias("offered")))
    tried = pool.select("word", F.posexplode("offered").alias("at", "candidate"))
    best = (tried.join(known, "candidate").groupBy("word")
            .agg(F.min_by("candidate", F.struct(F.length("candidate").alias("l"), "at")).alias("lemma")))
    return words.join(best, "word", "left").select("word", F.coalesce("lemma", "word").alias("lemma"), "n")


def stem_map(words: DataFrame, language: str) -> DataFrame:
    """``(word, stem, n)``."""
    return add_stem(words.select("word", "n"), "word", language)


#: Tokens whose changes share one map, so that a very long text is no long search per token.
PIECE = 512


def rewrite_tokens(kept: DataFrame, key: str, mapping: DataFrame, out: str) -> DataFrame:
    """The written table ``kept(key, tokens, ...)`` with every token as ``mapping(word, out, n)`` has it.

    Only words that change are looked up, once for each piece of a text they
    stand in; a text gets its changes as small maps and its array never leaves
    its row, so no token position is shuffled.
    """
    # Written before it is filtered: a filter moved below the steps of a stem would repeat each step in the next, without bound.
    changed = materialize(mapping.select("word", out, "n"), "word-map").where(F.col(out) != F.col("word"))
    pieces = F.transform(F.sequence(F.lit(0), F.floor((F.size("tokens") - 1) / PIECE).cast("int")),
                         lambda i: F.array_distinct(F.slice("tokens", i * PIECE + 1, PIECE)))
    found = (kept.where(F.size("tokens") > 0).select(key, F.posexplode(pieces).alias("piece", "words"))
             .select(key, "piece", F.explode("words").alias("word")))
    by_piece = (lookup_join(found, changed, "word", "n").groupBy(key, "piece")
                .agg(F.map_from_entries(F.collect_set(F.struct("word", out))).alias("changes")))
    by_text = by_piece.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("piece", "changes"))).alias("changes"))

    def rewritten(i: Column) -> Column:
        part = F.slice("tokens", i * PIECE + 1, PIECE)
        return F.flatten(F.transform(F.array(F.try_element_at("changes", i)), lambda found: F.when(found.isNull(), part)
                         .otherwise(F.transform(part, lambda w: F.coalesce(F.try_element_at(found, w), w)))))

    whole = F.flatten(F.transform(F.sequence(F.lit(0), F.floor((F.size("tokens") - 1) / PIECE).cast("int")), rewritten))
    return kept.join(by_text, key, "left").withColumn(
        "tokens", F.when(F.col("changes").isNull(), F.col("tokens")).otherwise(whole)).drop("changes")


def root_tokens(df: DataFrame, key: str, tokens: Column, language: str = "english", lexicon: DataFrame | None = None,
                exceptions: DataFrame | None = None, **more: Column) -> DataFrame:
    """``(key, tokens, more...)`` with every token as its lemma (English) or stem (other languages).

    Texts are cleaned once into a written table; ``more`` are columns kept beside the tokens.
    """
    kept = materialize(df.select(key, F.coalesce(tokens, F.array().cast("array<string>")).alias("tokens"),
                                 *[c.alias(name) for name, c in more.items()]), "tokens")
    words = word_counts(kept.select(F.explode("tokens").alias("word")))
    if language == "english":
        return rewrite_tokens(kept, key, lemma_map(words, lexicon, exceptions), "lemma")
    return rewrite_tokens(kept, key, stem_map(words, language), "stem")


def clean_corpus(df: DataFrame, key: str, text: str, language: str = "english", project: bool = False,
                 algorithm: str = "KNN", lexicon: DataFrame | None = None,
                 exceptions: DataFrame | None = None) -> DataFrame:
    """``(key, tokens)``: the whole cleaning chain, null and blank text as its own word."""
    words = cleaning.stopwords(language, project, algorithm)
    tokens = cleaning.clean_tokens(F.col(text), language, words)
    rooted = root_tokens(df, key, tokens, language, lexicon, exceptions, __blank=cleaning.is_blank(F.col(text)))
    missing = F.array(F.lit(lexicons.MISSING_TEXT))
    return rooted.select(key, F.when(F.col("__blank") | (F.size("tokens") == 0), missing)
                         .otherwise(F.col("tokens")).alias("tokens"))
