"""Text cleaning as built-in column expressions.

Nothing here is a UDF: every step is a JVM expression, so a clean column can
be used in a batch scan, a join or a stream alike.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F

from opinara.functions import lexicons as L


def is_blank(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike(f"^{L.WHITESPACE}*$")


def null_sentinel(text: Column) -> Column:
    """Null or all-whitespace text becomes the missing-text word."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), rf"^{L.WHITESPACE}*\z",
                            L.MISSING_TEXT)


def _emoji_pattern(symbols) -> str:
    """A regex whose group 1 is the longest known symbol at a place; styling and joining marks after it go along."""
    points = lambda symbol: [rf"\x{{{ord(c):X}}}" for c in symbol]
    longer = sorted((s for s in symbols if len(s) > 1), key=lambda s: (-len(s), s))
    chains = [r"\x{FE0F}?".join(points(s)) for s in longer]
    single = "".join(points(s)[0] for s in symbols if len(s) == 1)
    flag = f"[{L.REGIONAL_LETTERS[0]}-{L.REGIONAL_LETTERS[-1]}]{{2}}"
    keycap = rf"[0-9#*]\x{{FE0F}}?{L.KEYCAP}"
    return f"({'|'.join([*chains, flag, keycap, f'[{L.EMOJI_CLASS}{single}]'])})[{L.EMOJI_JOINERS}]*"


def emoji_to_words(text: Column, names: dict[str, str] | None = None) -> Column:
    """Spell emoji out, then turn ``:`` ``_`` ``-`` into spaces.

    Names come from ``names`` (default: the built-in table), whose symbols may
    have several code points; at each place the longest one is taken, in one
    pass from left to right. A flag outside the table becomes ``flag`` and its
    region letters, a keycap ``keycap`` and its sign, any other pictograph its
    Unicode character name. A text in ASCII costs one regex scan.
    """
    names = {symbol.replace("️", ""): name for symbol, name in (L.EMOJI_NAMES if names is None else names).items()}
    table = _literal_map({symbol: _quoted(name) for symbol, name in names.items()})
    pattern = F.lit(_emoji_pattern(names))

    def name(symbol: Column) -> Column:
        known = F.try_element_at(table, symbol)
        first = F.substring(symbol, 1, 1)
        made = (F.when(F.contains(F.lit(L.REGIONAL_LETTERS), first), F.concat(
                    F.lit("flag "), F.translate(symbol, L.REGIONAL_LETTERS, "abcdefghijklmnopqrstuvwxyz")))
                .when(F.endswith(symbol, F.lit(L.KEYCAP)), F.concat(F.lit("keycap "), first))
                .otherwise(F.call_function("java_method", F.lit("java.lang.Character"), F.lit("getName"), F.ascii(symbol))))
        return F.concat(F.lit(" "), F.lower(F.coalesce(known, made)), F.lit(" "))

    def spelled(t: Column) -> Column:
        found = F.transform(F.regexp_extract_all(t, pattern, F.lit(1)),
                            lambda s: _let(F.replace(s, F.lit("️"), F.lit("")), name))
        between = F.split(t, _emoji_pattern(names), -1)
        joined = F.zip_with(between, F.concat(found, F.array(F.lit(""))), lambda gap, word: F.concat(gap, word))
        return F.replace(F.array_join(joined, ""), F.lit("️"), F.lit(""))

    # A caller's table may hold plain ASCII signs; only then is every text searched.
    plain = any(symbol.isascii() for symbol in names)
    out = _let(text, lambda t: F.when(F.lit(True) if plain else F.rlike(t, F.lit(r"[^\x00-\x7F]")), spelled(t)).otherwise(t))
    return reduce(lambda acc, mark: F.replace(acc, F.lit(mark), F.lit(" ")), ":_-", out)


def expand_contractions(text: Column) -> Column:
    """``don't`` to ``do not`` and so on (straight apostrophe, lower case).

    Literal replacements are byte searches, far cheaper than one regex.
    """
    return _let(text, lambda t: F.when(F.contains(t, F.lit("n't")), reduce(
        lambda acc, form: F.replace(acc, F.lit(form[0]), F.lit(form[1])), L.CONTRACTIONS.items(), t)).otherwise(t))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _literal_map(entries: dict[str, str]) -> Column:
    """A map literal from text keys to SQL values, parsed in one go."""
    return F.expr("map(" + ", ".join(f"{_quoted(k)}, {v}" for k, v in entries.items()) + ")")


def _java(template: str) -> str:
    return template.replace("{", "$").replace("}", "")


def _split_word(word: Column) -> Column:
    """The tokens of one whitespace-free word that holds punctuation."""
    padded = word
    for pattern, template in L.TOKEN_RULES:
        padded = F.regexp_replace(padded, pattern, _java(template))
    # Double the gaps so that neighbouring tokens never share a space.
    padded = F.concat(F.lit(" "), F.replace(padded, F.lit(" "), F.lit("  ")), F.lit(" "))
    for word_, pair in L.TOKEN_PAIRS.items():
        padded = F.replace(padded, F.lit(f" {word_} "), F.lit(f" {pair} "))
    return F.filter(F.split(padded, " +"), lambda t: t != "")


def _tokens(text: Column, mixed=lambda ws: ws) -> Column:
    """Split on whitespace, then split words that hold punctuation; ``mixed`` filters those.

    Most words are plain, so the punctuation rules run on a small share of them.
    """
    pairs = {w: p for w, p in L.TOKEN_PAIRS.items() if w.isalnum()}
    table = _literal_map({w: "array(" + ", ".join(map(_quoted, p.split())) + ")" for w, p in pairs.items()})
    trimmed = F.regexp_replace(F.trim(text), f"^{L.WHITESPACE}+|{L.WHITESPACE}+$", "")

    def split(w: Column) -> Column:
        stem = F.left(w, F.length(w) - 1)
        return (F.when(w.isin(list(pairs)), F.element_at(table, w))
                .when(w.rlike(L.ALNUM_TOKEN), F.array(w))
                # The commonest mixed shape, a word and one closing mark, needs no rule.
                .when(w.rlike(r"^[\p{L}\p{N}]+[.,:;!?]$") & ~stem.isin(list(pairs)),
                      mixed(F.array(stem, F.right(w, F.lit(1)))))
                .otherwise(mixed(_split_word(w))))

    return F.flatten(F.transform(F.split(trimmed, f"{L.WHITESPACE}+"), split))


def tokenize(text: Column) -> Column:
    """Treebank-style token array."""
    return F.filter(_tokens(text), lambda t: t != "")


def stopwords(language: str = "english", project: bool = False, algorithm: str = "KNN") -> list[str]:
    """Stop words of a language; classifiers of a sentiment project keep negations."""
    if language == "english":
        words = list(L.ENGLISH_STOPWORDS)
        if project and algorithm in L.CLASSIFIERS_KEEPING_SENTIMENT:
            words = [w for w in words if w not in L.SENTIMENT_STOPWORDS_KEPT]
        return words
    return StopWordsRemover.loadDefaultStopWords(language)


def drop_stopwords(tokens: Column, words: list[str]) -> Column:
    return F.filter(tokens, lambda t: ~t.isin(words))


def alnum_only(tokens: Column) -> Column:
    """Keep tokens made of letters and digits only."""
    return F.filter(tokens, lambda t: t.rlike(L.ALNUM_TOKEN))


def prepare(text: Column, language: str = "english") -> Column:
    """Everything before tokenising: sentinel, lower case, emoji, contractions."""
    lowered = F.lower(null_sentinel(text))
    return expand_contractions(emoji_to_words(lowered)) if language == "english" else lowered


def clean_tokens(text: Column, language: str = "english", words: list[str] | None = None) -> Column:
    """Tokens left after stop words and punctuation are gone."""
    words = stopwords(language) if words is None else words
    return drop_stopwords(_tokens(prepare(text, language), alnum_only), words)


def join_tokens(tokens: Column) -> Column:
    return F.regexp_replace(F.array_join(tokens, " "), r"^\z", L.MISSING_TEXT)


def clean_text(text: Column, language: str = "english", words: list[str] | None = None) -> Column:
    """Clean text before lemmas or stems are looked up."""
    return join_tokens(clean_tokens(text, language, words))


def content_words(tokens: Column) -> Column:
    """Words of two characters or more, the ones a vocabulary counts."""
    return F.filter(tokens, lambda t: F.length(t) >= 2)


def ngrams(words: Column, up_to: int = 1) -> Column:
    """All n-grams for n = 1..up_to; pass a plain column, it is used several times."""
    grams, longer = words, words
    for n in range(2, up_to + 1):
        count = F.greatest(F.size(words) - (n - 1), F.lit(0))
        longer = F.zip_with(F.slice(longer, F.lit(1), count), F.slice(words, F.lit(n), count),
                            lambda a, b: F.concat(a, F.lit(" "), b))
        grams = F.concat(grams, longer)
    return grams
