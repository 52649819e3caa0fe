"""Cleaning and vectorising whole documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinara.functions import cleaning, lexicons
from opinara.operators import vectorize as V
from opinara.operators import words as W
from opinara.queries.registry import query
from opinara.queries.sqltext import (contracted, count_ctes, prepared, quote, tfidf_ctes, token_ctes,
                                     words)
from opinara.session import small_table

def tokens():
    return cleaning.clean_tokens(F.col("text"))

JOINED = "array_to_string({0}, ' ')"


@query("clean_null_sentinel", rf"""
SELECT doc_id, regexp_replace(coalesce(CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 5 = 1 THEN chr(9) || '  ' ELSE text END, ''),
       '^{lexicons.WHITESPACE}*\z', 'desconocido') AS clean FROM documents""")
def clean_null_sentinel(t):
    text = F.when(F.col("doc_id") % 5 == 0, F.lit(None)).when(F.col("doc_id") % 5 == 1, F.lit("\t  ")).otherwise(F.col("text"))
    return t.texts.select("doc_id", cleaning.null_sentinel(text).alias("clean"))


# Every entry of the table, then toned, styled, flag and keycap forms; two neighbours of the list stand side by side.
_EMOJI = [*lexicons.EMOJI_NAMES, "👍🏽", "❤️", "🇪🇸", "🇺🇸", "🇸🇺", "1️⃣", "#⃣"]
_SPELLED = {"🇪🇸": "flag es", "🇺🇸": "flag us", "🇸🇺": "flag su", "1️⃣": "keycap 1", "#⃣": "keycap #"}


def _emoji_sql() -> str:
    symbols = f"[{words(_EMOJI)}]"
    end = [f"{symbols}[(doc_id + {i}) % {len(_EMOJI)} + 1]" for i in (0, 1)]
    for symbol, name in _SPELLED.items():
        end = [f"replace({e}, {quote(symbol)}, {quote(f' {name} ')})" for e in end]
    return prepared(f"text || ' user_id ' || {end[0]} || {end[1]}", emoji=True)


@query("emoji_to_words", f"SELECT doc_id, {_emoji_sql()} AS clean FROM documents")
def emoji_to_words(t):
    symbols = F.array(*[F.lit(e) for e in _EMOJI])
    end = [F.element_at(symbols, ((F.col("doc_id") + i) % len(_EMOJI) + 1).cast("int")) for i in (0, 1)]
    return t.texts.select("doc_id", cleaning.prepare(F.concat("text", F.lit(" user_id "), *end)).alias("clean"))


@query("expand_contractions", f"""
SELECT doc_id, {contracted("replace(lower(text), 'the ', 'isn''t won''t ')")} AS clean FROM documents""")
def expand_contractions(t):
    text = F.replace(F.lower("text"), F.lit("the "), F.lit("isn't won't "))
    return t.texts.select("doc_id", cleaning.expand_contractions(text).alias("clean"))


@query("tokenize", f"""
WITH {token_ctes(text='text', prepare=False)}
SELECT doc_id, len(toks) AS n_tokens, array_to_string(toks, ' ') AS tokens FROM tok""")
def tokenize(t):
    staged = t.texts.select("doc_id", cleaning.tokenize(F.col("text")).alias("toks"))
    return staged.select("doc_id", F.size("toks").cast("bigint").alias("n_tokens"), F.array_join("toks", " ").alias("tokens"))


@query("remove_stopwords", f"""
WITH {token_ctes()}
SELECT doc_id, array_to_string(list_filter(toks, lambda t: NOT list_contains([{words(w for w in lexicons.ENGLISH_STOPWORDS if w not in lexicons.SENTIMENT_STOPWORDS_KEPT)}], t)), ' ') AS kept
FROM tok""")
def remove_stopwords(t):
    stop = cleaning.stopwords("english", project=True, algorithm="NaiveBayes")
    tokens = cleaning.tokenize(cleaning.prepare(F.col("text")))
    return t.texts.select("doc_id", F.array_join(cleaning.drop_stopwords(tokens, stop), " ").alias("kept"))


@query("alnum_tokens", f"""
WITH {token_ctes()}
SELECT doc_id, array_to_string(list_filter(toks, lambda t: regexp_matches(t, {quote(lexicons.ALNUM_TOKEN)})), ' ') AS kept FROM tok""")
def alnum_tokens(t):
    tokens = cleaning.tokenize(cleaning.prepare(F.col("text")))
    return t.texts.select("doc_id", F.array_join(cleaning.alnum_only(tokens), " ").alias("kept"))


_CLEAN = "coalesce(nullif(array_to_string(toks, ' '), ''), 'desconocido')"


@query("clean_text", f"WITH {token_ctes()} SELECT doc_id, {_CLEAN} AS clean FROM cl")
def clean_text(t):
    return t.texts.select("doc_id", cleaning.clean_text(F.col("text")).alias("clean"))


@query("stopword_anti_join", f"""
WITH {token_ctes()}, x AS (SELECT doc_id, unnest(toks) word FROM tok)
SELECT word, count(*) AS n FROM x WHERE word NOT IN ({words(lexicons.ENGLISH_STOPWORDS)}) GROUP BY word""")
def stopword_anti_join(t):
    rows = W.token_rows(t.texts, "doc_id", cleaning.tokenize(cleaning.prepare(F.col("text"))))
    listed = small_table(t.spark, [(w,) for w in lexicons.ENGLISH_STOPWORDS], "word string")
    return W.word_counts(W.drop_listed(rows, listed))


@query("lexicon_join", f"""
WITH {token_ctes()}, x AS (SELECT doc_id, unnest(toks) word FROM cl),
lex AS (SELECT DISTINCT lower(n_name) word, 'nation' replacement FROM nation
        UNION SELECT DISTINCT lower(p) , 'part' FROM (SELECT unnest(string_split(p_name, ' ')) p FROM part)
        UNION SELECT unnest(['leaux', 'tion', 'ing']), 'piece')
SELECT coalesce(lex.replacement, x.word) AS replacement, count(*) AS n
FROM x LEFT JOIN lex USING (word) GROUP BY 1""")
def lexicon_join(t):
    rows = W.token_rows(t.texts, "doc_id", tokens())
    lexicon = (t.nation.select(F.lower("n_name").alias("word"), F.lit("nation").alias("replacement"))
               .unionByName(t.part.select(F.explode(F.split(F.lower("p_name"), " ")).alias("word"))
                            .withColumn("replacement", F.lit("part")))
               .unionByName(small_table(t.spark, [(w, "piece") for w in ("leaux", "tion", "ing")], "word string, replacement string")))
    return W.lexicon_join(rows, lexicon).groupBy("replacement").agg(F.count("*").alias("n"))


def _noun_sql() -> str:
    made = [f"CASE WHEN word LIKE '%{end}' AND length(word) > {len(end)} "
            f"THEN substr(word, 1, length(word) - {len(end)}) || '{new}' END"
            for end, new in lexicons.NOUN_ENDINGS]
    return "[word, " + ", ".join(made) + "]"


@query("lemmatize_nouns", f"""
WITH {token_ctes()},
x AS (SELECT doc_id, unnest(toks) word, generate_subscripts(toks, 1) pos FROM cl),
wd AS (SELECT DISTINCT word FROM x),
cand AS (SELECT word, unnest({_noun_sql()}) c, generate_subscripts({_noun_sql()}, 1) nth FROM wd),
best AS (SELECT word, arg_min(c, length(c) * 100 + nth) lemma FROM cand WHERE c IN (SELECT word FROM wd) GROUP BY word),
j AS (SELECT doc_id, string_agg(lemma, ' ' ORDER BY pos) s FROM x JOIN best USING (word) GROUP BY doc_id)
SELECT doc_id, coalesce(s, 'desconocido') AS clean FROM documents LEFT JOIN j USING (doc_id)""")
def lemmatize_nouns(t):
    done = W.clean_corpus(t.texts, "doc_id", "text")
    return done.select("doc_id", cleaning.join_tokens(F.col("tokens")).alias("clean"))


@query("stem_tokens")
def stem_tokens(t):
    rows = W.token_rows(t.texts, "doc_id", cleaning.clean_tokens(F.col("text"), "spanish"))
    return W.stem_map(W.word_counts(rows), "spanish").groupBy("stem").agg(
        F.sum("n").alias("n"), F.count("*").alias("words"))


@query("bow_counts", f"WITH {token_ctes()}, {count_ctes(min_df=1)} SELECT doc_id, term, tf FROM tf")
def bow_counts(t):
    return V.term_counts(t.texts, "doc_id", tokens())


@query("onehot_terms", f"WITH {token_ctes()}, {count_ctes(min_df=1)} SELECT doc_id, term, 1.0::DOUBLE AS weight FROM tf")
def onehot_terms(t):
    fitted = V.fit_text(t.texts, "doc_id", tokens(), "one-hot")
    return fitted.fitted().select("doc_id", "term", "weight")


@query("tfidf", f"""
WITH {token_ctes()}, {count_ctes()}, {tfidf_ctes()}
SELECT doc_id, term, round(weight, 6) AS weight FROM w""")
def tfidf(t):
    fitted = V.fit_text(t.texts, "doc_id", tokens())
    return fitted.fitted().select("doc_id", "term", F.round("weight", 6).alias("weight"))


@query("ngrams", f"""
WITH {token_ctes()}, {count_ctes(min_df=1, bigrams=True)}
SELECT doc_id, term, tf FROM tf""")
def ngrams(t):
    return V.term_counts(t.texts, "doc_id", tokens(), 2)


@query("vocab_min_df", f"""
WITH {token_ctes()}, {count_ctes()}
SELECT term, df, total, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx, 'text_tfidf_' || term AS feature FROM voc""")
def vocab_min_df(t):
    vocab = V.fit_text(t.texts, "doc_id", tokens()).vocab
    return V.name_features(V.number_terms(vocab), "text", "tf-idf").select("term", "df", "total", "idx", "feature")


@query("transform_with_vocab", f"""
WITH {token_ctes(extra=', source')}, {count_ctes(fit="source <> 'src0'")}, {tfidf_ctes()}
SELECT doc_id, term, round(weight, 6) AS weight FROM w WHERE doc_id IN (SELECT doc_id FROM documents WHERE source = 'src0')""")
def transform_with_vocab(t):
    train, dev = (t.texts.filter(F.col("source") != "src0"), t.texts.filter(F.col("source") == "src0"))
    fitted = V.fit_text(train, "doc_id", tokens())
    return fitted.transform(dev, tokens()).select("doc_id", "term", F.round("weight", 6).alias("weight"))


@query("presence_texts", f"""
WITH {token_ctes()}, {count_ctes()}
SELECT doc_id, array_to_string(list_sort(list(term)), ' ') AS terms FROM tf JOIN voc USING (term) GROUP BY doc_id""")
def presence_texts(t):
    weights = V.fit_text(t.texts, "doc_id", tokens()).fitted()
    return V.presence_texts(weights, "doc_id").select("doc_id", F.array_join("terms", " ").alias("terms"))


@query("bow_corpus", f"""
WITH {token_ctes()}, {count_ctes()}, {tfidf_ctes()},
ix AS (SELECT term, row_number() OVER (ORDER BY term) - 1 idx FROM voc)
SELECT doc_id, count(*) AS n, string_agg(CAST(idx AS VARCHAR), ',' ORDER BY idx) AS ids, round(sum(weight), 5) AS total
FROM w JOIN ix USING (term) GROUP BY doc_id""")
def bow_corpus(t):
    fitted = V.fit_text(t.texts, "doc_id", tokens())
    bow = fitted.packed().select("doc_id", F.arrays_zip(F.col("indices").alias("idx"), F.col("values").alias("weight")).alias("bow"))
    return bow.select("doc_id", F.size("bow").cast("bigint").alias("n"),
                      F.array_join(F.transform("bow", lambda b: b["idx"].cast("string")), ",").alias("ids"),
                      F.round(F.aggregate("bow", F.lit(0.0), lambda a, b: a + b["weight"]), 5).alias("total"))


@query("corpus_stats", f"""
WITH {token_ctes()}, {count_ctes()}, {tfidf_ctes()}
SELECT (SELECT n FROM nd) AS num_docs, round(sum(weight), 4) AS total_weight, count(*) FILTER (WHERE weight > 0) AS num_nnz FROM w""")
def corpus_stats(t):
    fitted = V.fit_text(t.texts, "doc_id", tokens())
    return (V.corpus_stats(fitted.fitted(), fitted.n_docs)
            .withColumn("total_weight", F.round("total_weight", 4)))
