"""Quality rules: a threshold table compiled into one projection. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import SPACE_CLASS, SPACES, text_or_empty


class Rule(NamedTuple):
    """``low * denominator <= numerator <= high * denominator``, else the document fails; None is no bound."""

    name: str
    numerator: str
    denominator: str | None
    low: float | None
    high: float | None


#: Length, symbol, stop-word and line ratios.
RULES = [
    Rule("word_length", "word_chars", "n_words", 2.0, 15.0),
    Rule("symbols", "n_symbols", "n_words", None, 0.3),
    Rule("stop_words", "n_stop_words", None, 2.0, None),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 0.3),
]
STOP_WORDS = ("the of and to in is that with for are der die und das von mit den ist für des "
              "le la de et les des que en une est el los las un del por con para y a").split()
SYMBOLS = r"[#*$%&|<>]"
#: The base rule: at least so many words, at most such a percentage of them in repeated windows.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
POSITION_BITS = 31


def repeated_positions(words: Column) -> list[tuple[str, Column]]:
    """Steps that end in ``repeats``: start positions (from 0) of three-word windows found twice or more.

    Each window becomes one long, 32 bits of hash above its position, so one
    primitive sort puts equal windows side by side. Neighbours that agree in the
    hash are only candidates: these are sorted once more by their whole text.
    """
    mask = (1 << POSITION_BITS) - 1
    same = lambda a, b: F.shiftrightunsigned(a.bitwiseXOR(b), POSITION_BITS) == 0
    tail = lambda c: F.slice(c, 2, F.greatest(F.size(c) - 1, F.lit(0)))
    low = lambda v: v.bitwiseAND(F.lit(mask)).cast("int")

    keyed = F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))),
        lambda w, i: F.shiftleft(F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))
                                 .bitwiseAND(F.lit(0xFFFFFFFF)), POSITION_BITS).bitwiseOR(i.cast("long")))
    sorted_keys = F.col("__keys")
    neighbours = F.zip_with(sorted_keys, tail(sorted_keys), lambda a, b: F.when(same(a, b), F.array(low(a), low(b))))
    candidates = F.array_distinct(F.flatten(F.array_compact(neighbours)))
    windows = F.sort_array(F.transform(F.col("__candidates"), lambda p: F.struct(
        F.concat_ws(" ", F.get(words, p), F.get(words, p + 1), F.get(words, p + 2)).alias("w"), p.alias("p"))))
    sorted_windows = F.col("__windows")
    equal = F.zip_with(sorted_windows, tail(sorted_windows),
                       lambda a, b: F.when(a["w"] == b["w"], F.array(a["p"], b["p"])))
    return [("__keys", F.sort_array(keyed)), ("__candidates", candidates), ("__windows", windows),
            ("__repeats", F.array_distinct(F.flatten(F.array_compact(equal))))]


def compile_rules(rules: Sequence[Rule]) -> list[tuple[str, Column]]:
    """A boolean expression per rule: true if the document breaks it."""
    def breaks(rule: Rule) -> Column:
        value = F.col(rule.numerator).cast("double")
        scale = F.col(rule.denominator).cast("double") if rule.denominator else F.lit(1.0)
        bounds = [value < F.lit(rule.low) * scale] if rule.low is not None else []
        bounds += [value > F.lit(rule.high) * scale] if rule.high is not None else []
        return reduce(Column.__or__, bounds, F.lit(False))
    return [(r.name, breaks(r)) for r in rules]


def measure(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
            stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """``id`` and the counts that rules may use, one row per row, without a shuffle."""
    text, words = F.col("__text"), F.col("__words")
    has_word = lambda line: line.rlike(SPACE_CLASS.replace("[", "[^"))
    # Bound step by step: an expression used twice stays in the projection that makes it.
    out = docs.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("__text"))
    trimmed = F.btrim(text, F.lit(SPACES))
    out = out.withColumn("__words", F.when(trimmed == "", F.array().cast("array<string>"))
                         .otherwise(F.split(trimmed, SPACE_CLASS + "+")))
    out = out.withColumn("__lines", F.filter(F.split(text, "\n"), has_word))
    for name, step in repeated_positions(words):
        out = out.withColumn(name, step)
    covered = F.array_distinct(F.flatten(F.transform("__repeats", lambda p: F.array(p, p + 1, p + 2))))
    whole = lambda c: c.cast("long")
    return out.select(
        "id", whole(F.size(words)).alias("n_words"),
        whole(F.length(F.array_join(words, ""))).alias("word_chars"),
        whole(F.regexp_count(text, F.lit(SYMBOLS))).alias("n_symbols"),
        whole(F.size("__lines")).alias("n_lines"),
        whole(F.size("__lines") - F.size(F.array_distinct("__lines"))).alias("n_dup_lines"),
        whole(F.size(covered)).alias("n_repeat_words"),
        whole(F.size(F.array_intersect(words, F.array(*map(F.lit, stop_words))))).alias("n_stop_words"))


def apply_rules(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                rules: Sequence[Rule] = RULES, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """Counts, ``base_failed``, ``broken`` (names of broken rules) and ``kept`` for every row.

    A null text is an empty one: no words, so the base rule fails it. Rows are
    judged one by one, so repeated rows and null ids come out as they went in,
    and an empty table gives an empty result. Other columns are ignored.
    """
    base = ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    names = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in compile_rules(rules)]))
    return (measure(docs, id_column, text_column, stop_words)
            .select("*", base.alias("base_failed"), names.alias("broken"))
            .withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0)))
