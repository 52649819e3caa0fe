import pytest
from pyspark.sql import functions as F

from opinara.functions import cleaning, lexicons, replies
from opinara.functions.stemming import add_stem
from opinara.operators import lookup, vectorize, words


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "t string").select(expr(F.col("t")).alias("o")).first()["o"]


@pytest.mark.parametrize("raw, want", [
    (None, "desconocido"), ("", "desconocido"), (" \n\t ", "desconocido"), ("?!...", "desconocido"),
    ("I don't like it", "like"), ("He said: GOOD-bad", "said good bad"),
    ("user_id: 1,000 app/website end.", "user id end"), ("can't cannot won't", "desconocido"),
    ("étude café", "étude café"), ("Loved it 😍!", "loved smiling face heart eyes"),
])
def test_clean_text(spark, raw, want):
    assert one(spark, raw, cleaning.clean_text) == want


@pytest.mark.parametrize("raw, want", [
    ("a, b: c", ["a", ",", "b", ":", "c"]), ("at 3:30, 1,000", ["at", "3:30", ",", "1,000"]),
    ("good.bad end.", ["good.bad", "end", "."]), ("he's they'll don't", ["he", "'s", "they", "'ll", "do", "n't"]),
    ("wait... (x)", ["wait", "...", "(", "x", ")"]), ("cannot gonna", ["can", "not", "gon", "na"]),
    ("“q” a--b", ["“", "q", "”", "a", "--", "b"]), ("  ", []),
])
def test_tokenize(spark, raw, want):
    assert one(spark, raw, cleaning.tokenize) == want


def test_sentiment_words_survive_only_for_classifiers(spark):
    assert "not" in cleaning.stopwords("english")
    kept = cleaning.stopwords("english", True, "NaiveBayes")
    assert "not" not in kept and "the" in kept
    assert "not" in cleaning.stopwords("english", True, "LDA")


def test_unknown_emoji_uses_its_character_name(spark):
    assert "unicorn face" in one(spark, "a 🦄 b", cleaning.emoji_to_words)


@pytest.mark.parametrize("text, names, expected", [
    ("⭐", None, "star"), ("⏰", None, "alarm clock"), ("👍🏽👍", None, "thumbs up medium skin tone thumbs up"),
    ("a🇪🇸🇺🇸b", None, "a flag es flag us b"), ("🇸🇺 🇪🇸🇺🇸", None, "flag su flag es flag us"),
    ("1️⃣ 2 #⃣", None, "keycap 1 2 keycap #"), ("❤️‍🔥", None, "red heart fire"), ("plain text 12", None, "plain text 12"), ("", None, ""),
    ("❤️‍🔥 ❤️ 🇪🇸", {"❤️‍🔥": "heart on fire", "❤️": "red heart", "🇪🇸": "Spain"}, "heart on fire red heart spain"),
    ("fine (c) :)", {":)": "smile", "(c)": "c in brackets"}, "fine c in brackets smile"),
])
def test_emoji_longest_first(spark, text, names, expected):
    assert " ".join(one(spark, text, lambda c: cleaning.emoji_to_words(c, names)).split()) == expected


def test_every_emoji_of_the_table(spark):
    rows = [(symbol, name) for symbol, name in lexicons.EMOJI_NAMES.items()]
    df = spark.createDataFrame(rows, "symbol string, name string")
    for r in df.withColumn("got", cleaning.emoji_to_words(F.concat(F.lit("x"), "symbol", "symbol"))).collect():
        assert r["got"].split() == ["x", *(r["name"].lower().replace("-", " ").split() * 2)]
    assert df.select(cleaning.emoji_to_words(F.lit(None).cast("string")).alias("v")).first()["v"] is None


def test_ngrams(spark):
    df = spark.createDataFrame([(1, ["aa", "b", "cc", "dd"]), (2, ["aa"]), (3, [])], "k int, t array<string>")
    got = {r["k"]: r["grams"] for r in vectorize.gram_column(df, F.col("t"), 3).collect()}
    assert got[1] == ["aa", "cc", "dd", "aa cc", "cc dd", "aa cc dd"]
    assert got[2] == ["aa"] and got[3] == []


def test_lemmas(spark):
    df = spark.createDataFrame([(1, "classes boxes men parties party class box man glass buses"), (2, None)], "k int, t string")
    got = {r["k"]: r["tokens"] for r in words.clean_corpus(df, "k", "t").collect()}
    assert got[1] == ["class", "box", "men", "party", "party", "class", "box", "man", "glass", "buses"]
    assert got[2] == ["desconocido"]


def test_rewriting_in_pieces(spark):
    """Texts of no, one and several pieces, repeated and null tokens' texts, and a repeated key."""
    long = [f"w{i % 700}" for i in range(3 * words.PIECE + 5)]
    rows = [(1, long), (2, []), (3, ["w1", "stay", "w1"]), (4, ["stay"]), (3, ["w2"])]
    kept = spark.createDataFrame(rows, "k int, tokens array<string>")
    mapping = spark.createDataFrame([(f"w{i}", f"v{i}" if i % 2 else f"w{i}", 1) for i in range(700)] + [("stay", "stay", 1)],
                                    "word string, lemma string, n long")
    new = lambda w: "v" + w[1:] if w[0] == "w" and int(w[1:]) % 2 else w
    got = sorted((r["k"], r["tokens"]) for r in words.rewrite_tokens(kept, "k", mapping, "lemma").collect())
    assert got == sorted((k, [new(w) for w in t]) for k, t in rows)


def test_lemma_exceptions_and_lexicon(spark):
    df = spark.createDataFrame([("feet", 1), ("dogs", 1), ("cats", 1)], "word string, n long")
    lexicon = spark.createDataFrame([("dog",), ("foot",)], "word string")
    irregular = spark.createDataFrame([("feet", "foot")], "word string, lemma string")
    got = {r["word"]: r["lemma"] for r in words.lemma_map(df, lexicon, irregular).collect()}
    assert got == {"feet": "foot", "dogs": "dog", "cats": "cats"}


def test_large_dictionary_takes_the_salted_way(spark):
    facts = spark.range(2000).select("id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
        F.concat(F.lit("w"), (F.col("id") % 50).cast("string"))).alias("word"))
    entries = facts.groupBy("word").agg(F.count("*").alias("n"))
    small = lookup.lookup_join(facts, entries, "word", "n")
    large = lookup.lookup_join(facts, entries, "word", "n", broadcast_rows=3)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect()))


def test_tfidf_by_hand(spark):
    df = spark.createDataFrame([(1, ["aa", "aa", "bb"]), (2, ["aa"]), (3, ["bb", "cc"])], "k int, t array<string>")
    fitted = vectorize.fit_text(df, "k", F.col("t"), min_df=2)
    rows = {(r["k"], r["term"]): r["weight"] for r in fitted.fitted().collect()}
    assert set(rows) == {(1, "aa"), (1, "bb"), (2, "aa"), (3, "bb")}
    assert rows[1, "aa"] == pytest.approx(2 / 5 ** 0.5) and rows[3, "bb"] == pytest.approx(1.0)


def test_numbered_terms_follow_sorted_order(spark):
    vocab = spark.createDataFrame([(w, 1) for w in ("b", "abc", "abcd", "zz", "a", "é", "ab")], "term string, df int")
    got = [r["term"] for r in vectorize.number_terms(vocab).orderBy("idx").collect()]
    assert got == sorted(["b", "abc", "abcd", "zz", "a", "é", "ab"])


@pytest.mark.parametrize("raw, want", [
    ("<THINK>a\nb</think> positivo ", "POSITIVO"), ("x<think>1</think>y<think>2</think>", "XY"), (" neutro\n", "NEUTRO"),
])
def test_reply_label(spark, raw, want):
    assert one(spark, raw, replies.reply_label) == want


def test_strip_quotes(spark):
    assert one(spark, "\"'quoted'\"", replies.strip_quotes) == "quoted"


# Sample words of the public Spanish stemmer vocabulary.
STEMS = {
    "che": "che", "checa": "chec", "chequeo": "cheque", "chicas": "chic", "chicharrones": "chicharron",
    "chico": "chic", "chihuahua": "chihuahu", "torácico": "torac", "toreado": "tor", "toreándolo": "tor",
    "torneo": "torne", "torres": "torr", "torturado": "tortur", "corriendo": "corr", "rápidamente": "rapid",
    "nacionalidad": "nacional", "construyendo": "constru", "paguen": "pag", "canciones": "cancion",
    "biologías": "biolog", "competencia": "competent",
}


def test_spanish_stems(spark):
    df = spark.createDataFrame([(w,) for w in STEMS], "word string")
    assert {r["word"]: r["stem"] for r in add_stem(df, "word", "spanish").collect()} == STEMS


def test_no_stemmer(spark):
    with pytest.raises(ValueError):
        add_stem(spark.createDataFrame([("a",)], "word string"), "word", "klingon")


def test_spanish_corpus(spark):
    df = spark.createDataFrame([(1, "Las canciones: rápidamente."), (2, " ")], "k int, t string")
    got = {r["k"]: r["tokens"] for r in words.clean_corpus(df, "k", "t", "spanish").collect()}
    assert got == {1: ["cancion", "rapid"], 2: ["desconocido"]}
