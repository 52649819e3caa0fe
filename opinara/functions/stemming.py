"""Suffix stemming of single words, the Snowball way, as staged columns.

A language is described by its endings; the steps below cut the longest ending
that lies in the right region of the word. Input is a table of distinct words,
so the cost follows the vocabulary, not the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the Spanish stemmer (public Snowball definition).
VOWELS = "aeiouáéíóúü"
PRONOUNS = "selas selos sela selo las les los nos me se la le lo".split()
GERUNDS = "iéndo ándo iendo ando ár ér ír ar er ir".split()
# Noun and adjective endings: ending group -> (replacement, endings also cut when they follow).
NOUN_ENDINGS = [
    ("anza anzas ico ica icos icas ismo ismos able ables ible ibles ista istas oso osa osos osas "
     "amiento amientos imiento imientos", "", ""),
    ("adora ador ación adoras adores acion aciones ante antes ancia ancias", "", "ic"),
    ("logía logías", "log", ""),
    ("ución uciones", "u", ""),
    ("encia encias", "ente", ""),
    ("mente", "", "ante able ible"),
    ("idad idades", "", "abil ic iv"),
    ("iva ivo ivas ivos", "", "at"),
]
# "-amente" needs only the first region, and may uncover one of these.
ADVERB_FOLLOWERS = "iv os ic ad"
Y_VERB_ENDINGS = "yeron yendo yamos yais yan yen yas yes ya ye yo yó".split()
GU_VERB_ENDINGS = "en es éis emos".split()
VERB_ENDINGS = """
aríamos eríamos iríamos iéramos iésemos aríais aremos eríais eremos iríais iremos ierais ieseis asteis
isteis ábamos áramos ásemos arían arías aréis erían erías eréis irían irías iréis ieran iesen ieron iendo
ieras ieses abais arais aseis éamos arán arás aría erán erás ería irán irás iría iera iese aste iste aban
aran asen aron ando abas adas idas aras ases íais ados idos amos imos ará aré erá eré irá iré aba ada ida
ara ase ían ado ido ías áis ía ad ed id an ió ar er ir as ís
""".split()
RESIDUAL_ENDINGS = "os a o á í ó".split()
RESIDUAL_GU_ENDINGS = "e é".split()

LANGUAGES = ["spanish"]


def _longest(endings: list[str]) -> str:
    """Matches the longest of the endings: the prefix is lazy, so it is the shortest."""
    return f"^(.*?)({'|'.join(endings)})$"


def _ending(word: Column, endings: list[str]) -> Column:
    """The longest of the endings the word has, or an empty text."""
    return F.regexp_extract(word, _longest(endings), 2)


def _from(word: Column, start: Column) -> Column:
    """The region of the word from a 0-based start."""
    return F.substring(word, start + 1, F.length(word))


def _cut(word: Column, ending: Column) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - F.length(ending))


def _regions(df: DataFrame) -> DataFrame:
    """Add ``r1``, ``r2`` and ``rv``: where the regions of ``w`` start."""
    v, c = f"[{VOWELS}]", f"[^{VOWELS}]"
    after = f"^.*?{v}{c}"
    size = F.length("w")

    def start(pattern: str, text: Column) -> Column:
        hit = F.length(F.regexp_extract(text, pattern, 0))
        return F.when(hit > 0, hit)

    rv = (F.when(F.col("w").rlike(f"^.{c}"), start(f"^.{c}.*?{v}", F.col("w")))
          .when(F.col("w").rlike(f"^{v}{v}"), start(f"^{v}{v}.*?{c}", F.col("w")))
          .when(size >= 3, F.lit(3)))
    staged = df.withColumn("r1", F.coalesce(start(after, F.col("w")), size))
    staged = staged.withColumn("r2", F.coalesce(F.col("r1") + start(after, _from(F.col("w"), F.col("r1"))), size))
    return staged.withColumn("rv", F.coalesce(rv, size))


def _inside(region: str, ending: str) -> Column:
    """Whether an ending column lies wholly in a region of ``w``."""
    return (F.length(ending) > 0) & (F.length("w") - F.length(ending) >= F.col(region))


def _plain(word: Column) -> Column:
    return F.translate(word, "áéíóú", "aeiou")


def _drop_pronoun(df: DataFrame) -> DataFrame:
    staged = df.withColumn("e", _ending(F.col("w"), PRONOUNS)).withColumn("b", _cut(F.col("w"), F.col("e")))
    stem = _from(F.col("b"), F.col("rv"))
    joined = stem.rlike(f"({'|'.join(GERUNDS)})$") | (stem.rlike("yendo$") & F.col("b").rlike("uyendo$"))
    return staged.withColumn("w", F.when(_inside("rv", "e") & joined, _plain(F.col("b"))).otherwise(F.col("w")))


def _follow(word: Column, endings: str, region: str = "r2") -> Column:
    """Cut an ending uncovered by the last cut, if it lies in the region."""
    if not endings:
        return word
    found = _ending(word, endings.split())
    return F.when((F.length(found) > 0) & (F.length(word) - F.length(found) >= F.col(region)),
                  _cut(word, found)).otherwise(word)


def _noun_step(df: DataFrame) -> DataFrame:
    every = [e for group, _, _ in NOUN_ENDINGS for e in group.split()] + ["amente"]
    staged = df.withColumn("e", _ending(F.col("w"), every)).withColumn("b", _cut(F.col("w"), F.col("e")))
    out, done = F.col("w"), F.lit(False)
    for group, new, followers in NOUN_ENDINGS:
        hit = F.col("e").isin(group.split()) & _inside("r2", "e")
        once = _follow(F.col("b"), followers)
        # "-ativa" may in turn uncover "-ic".
        twice = F.when(once != F.col("b"), _follow(once, "ic")).otherwise(once) if followers == "at" else once
        out = F.when(hit, F.concat(twice, F.lit(new))).otherwise(out)
        done = done | hit
    adverb = (F.col("e") == "amente") & _inside("r1", "e")
    bare = _follow(F.col("b"), ADVERB_FOLLOWERS)
    deeper = F.when(F.col("b").rlike("iv$") & (bare != F.col("b")), _follow(bare, "at")).otherwise(bare)
    return (staged.withColumn("n", F.when(adverb, deeper).otherwise(out)).withColumn("done", adverb | done)
            .withColumn("w", F.col("n")))


def _verb_step(df: DataFrame) -> DataFrame:
    region = _from(F.col("w"), F.col("rv"))
    staged = (df.withColumn("e", _ending(region, Y_VERB_ENDINGS))
              .withColumn("b", _cut(F.col("w"), F.col("e")))
              .withColumn("y", ~F.col("done") & (F.col("e") != "") & F.col("b").endswith("u"))
              .withColumn("w", F.when(F.col("y"), F.col("b")).otherwise(F.col("w"))))
    region = _from(F.col("w"), F.col("rv"))
    staged = (staged.withColumn("e", _ending(region, VERB_ENDINGS + GU_VERB_ENDINGS))
              .withColumn("b", _cut(F.col("w"), F.col("e"))))
    soft = F.col("e").isin(GU_VERB_ENDINGS) & F.col("b").endswith("gu")
    cut = F.when(soft, _cut(F.col("b"), F.lit("u"))).otherwise(F.col("b"))
    return staged.withColumn("w", F.when(~F.col("done") & ~F.col("y") & (F.col("e") != ""), cut).otherwise(F.col("w")))


def _residual_step(df: DataFrame) -> DataFrame:
    region = _from(F.col("w"), F.col("rv"))
    staged = (df.withColumn("e", _ending(region, RESIDUAL_ENDINGS + RESIDUAL_GU_ENDINGS))
              .withColumn("b", _cut(F.col("w"), F.col("e"))))
    soft = (F.col("e").isin(RESIDUAL_GU_ENDINGS) & F.col("b").endswith("gu")
            & (F.length("b") - 1 >= F.col("rv")))
    return staged.withColumn("w", F.when(soft, _cut(F.col("b"), F.lit("u"))).otherwise(F.col("b")))


def add_stem(df: DataFrame, word: str, language: str, out: str = "stem") -> DataFrame:
    """Add the stem of each (lower-case) word."""
    if language not in LANGUAGES:
        raise ValueError(f"no stemmer for {language!r}; expected one of {LANGUAGES}")
    staged = _regions(df.select(F.struct(*df.columns).alias("__row"), F.col(word).alias("w")))
    for step in (_drop_pronoun, _noun_step, _verb_step, _residual_step):
        staged = step(staged)
    return staged.select("__row.*", _plain(F.col("w")).alias(out))
