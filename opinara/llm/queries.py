"""One query per corpus operator, over its whole table with production parameters, and the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.llm import (alignment, bpe, crf_langid, exact_dedup, gru_lm, line_dedup, mixing, quality, quality_rules, simhash,
                         toxicity, url_filters, whitening)
from opinara.llm.common import fold, read_documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(job: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = job
        if sql is not None:
            ORACLES[name] = sql.strip()
        return job
    return register


@query("op2_exact_dedup", """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
""")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    groups = exact_dedup.exact_groups(read_documents(spark, folder), keep="largest")
    return groups.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
                         F.col("sha256").alias("text_sha256"))


@query("op7_url_filters", r"""
WITH parts AS (
  SELECT page_id, CASE WHEN url IS NULL OR position('://' IN url) = 0 THEN ''
                       ELSE substr(url, position('://' IN url) + 3) END AS rest FROM pages),
split AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw_host FROM parts),
named AS (
  SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path FROM split),
rules(rule_host, rule_path, act) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
best AS (
  SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(act, length(rule_host || rule_path)) AS act
  FROM named JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id)
SELECT n.page_id, host, path, rule, coalesce(act, CASE
         WHEN host || path LIKE '%cheap-pills%' OR host || path LIKE '%free-bets%' OR host || path LIKE '%spam-farm%'
           OR host || path LIKE '%ads-track%' OR host || path LIKE '%/casino/%'
           OR regexp_matches(host || path, '(?s)^[^/]*/.*\.exe$') THEN 'block' ELSE 'allow' END) AS verdict
FROM named n LEFT JOIN best b ON n.page_id = b.page_id
""")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    judged = url_filters.judge_urls(read_documents(spark, folder, "pages"))
    return judged.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


_STOP_LIST = ", ".join(f"'{w}'" for w in quality_rules.STOP_WORDS)


@query("op9_quality_rules", rf"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM base)),
repeated AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM repeated) GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM base)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
counts AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         coalesce(n_dup, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
         len(list_filter(list_distinct(w), lambda x: list_contains([{_STOP_LIST}], x))) AS n_stop
  FROM base LEFT JOIN lines USING (doc_id) LEFT JOIN covered c USING (doc_id)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars BETWEEN CAST(2 AS DOUBLE) * n_words AND CAST(15 AS DOUBLE) * n_words
       AND n_symbols <= CAST(0.3 AS DOUBLE) * n_words AND n_stop >= 2
       AND n_dup_lines <= CAST(0.3 AS DOUBLE) * n_lines AS kept
FROM judged
""")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.apply_rules(read_documents(spark, folder))
    return judged.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept")


@query("op4_toxicity")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_documents(spark, folder)
    model = toxicity.fit(docs, read_documents(spark, folder, "labels"), trainable=fold("id", 3) != 1)
    scored = toxicity.score_documents(docs, model).withColumnRenamed("id", "doc_id")
    return scored.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score",
                         (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@query("op5_mixing")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix_report(read_documents(spark, folder))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "copies")


@query("op6_byte_bpe")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    coded = bpe.encode(spark, read_documents(spark, folder), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                       public_tokenizers.PATTERN, with_ids=False)
    return coded.withColumnRenamed("id", "doc_id")


@query("op8_simhash")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    groups = simhash.simhash_groups(read_documents(spark, folder))
    return groups.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                         "component_id")


@query("op1_crf_langid")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_documents(spark, folder)
    model = crf_langid.fit(docs, fold("id", 4) != 2)
    found = crf_langid.identify(docs, model).withColumnRenamed("id", "doc_id")
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score",
                        F.size("span_langs").cast("long").alias("n_spans"))


@query("op3_gru_lm")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return gru_lm.score_documents(read_documents(spark, folder)).withColumnRenamed("id", "doc_id")


@query("op10_line_dedup")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    found = line_dedup.fuzzy_lines(read_documents(spark, folder))
    return found.select(F.col("id").alias("doc_id"), "n_lines", "n_kept", "dropped")


@query("op12_whitening")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten_report(read_documents(spark, folder, "embeddings")).withColumnRenamed("id", "vec_id")


@query("op13_alignment")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    aligned = alignment.align(read_documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json"),
                              public_tokenizers.path("piece_bpe_32k.model"))
    return aligned.withColumnRenamed("id", "doc_id")


@query("op11_quality")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_documents(spark, folder)
    model = quality.fit(docs, read_documents(spark, folder, "labels"), trainable=fold("id", 4) != 2)
    scored = quality.score_documents(docs, model).withColumnRenamed("id", "doc_id")
    return scored.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score",
                         (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))
