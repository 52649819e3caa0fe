"""SQL fragments shared by the checks, built from the same fixed values."""

from __future__ import annotations

from opinara.functions import lexicons as L


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def words(items) -> str:
    return ", ".join(quote(w) for w in items)


def _re2(template: str) -> str:
    return template.replace("{", "\\").replace("}", "")


def prepared(text: str, emoji: bool = False) -> str:
    """Sentinel, lower case, emoji, contractions."""
    s = f"lower(regexp_replace(coalesce({text}, ''), {quote(f'^{L.WHITESPACE}*' + chr(92) + 'z')}, {quote(L.MISSING_TEXT)}))"
    if emoji:
        for symbol, name in L.EMOJI_NAMES.items():
            s = f"replace({s}, {quote(symbol)}, {quote(f' {name.lower()} ')})"
    s = f"translate({s}, ':_-️', '   ')"
    return contracted(s)


def contracted(s: str) -> str:
    for word, full in L.CONTRACTIONS.items():
        s = f"replace({s}, {quote(word)}, {quote(full)})"
    return s


def token_ctes(source: str = "documents", key: str = "doc_id", text: str = "text",
               extra: str = "", prepare: bool = True, prefix: str = "") -> str:
    """CTEs ``tok(key, toks)`` and ``cl(key, toks)`` (stop words and punctuation gone)."""
    start = prepared(text) if prepare else text
    ws = quote(L.WHITESPACE + "+")
    steps = [f"{prefix}p0 AS (SELECT {key}{extra}, trim(regexp_replace({start}, {ws}, ' ', 'g')) s FROM {source})"]
    n = 0
    for pattern, template in L.TOKEN_RULES:
        n += 1
        steps.append(f"{prefix}p{n} AS (SELECT * REPLACE (regexp_replace(s, {quote(pattern)}, "
                     f"{quote(_re2(template))}, 'g') AS s) FROM {prefix}p{n - 1})")
    s = "' ' || regexp_replace(s, ' +', '  ', 'g') || ' '"
    for word, pair in L.TOKEN_PAIRS.items():
        s = f"replace({s}, {quote(f' {word} ')}, {quote(f' {pair} ')})"
    steps.append(f"{prefix}tok AS (SELECT * EXCLUDE (s), list_filter(string_split({s}, ' '), "
                 f"lambda t: t <> '') toks FROM {prefix}p{n})")
    steps.append(f"{prefix}cl AS (SELECT * REPLACE (list_filter(toks, lambda t: regexp_matches(t, {quote(L.ALNUM_TOKEN)}) "
                 f"AND NOT list_contains([{words(L.ENGLISH_STOPWORDS)}], t)) AS toks) FROM {prefix}tok)")
    return ",\n".join(steps)


def count_ctes(key: str = "doc_id", min_df: int = 3, bigrams: bool = False, source: str = "cl",
               fit: str = "") -> str:
    """CTEs ``tf(key, term, tf)``, ``voc(term, df, total)`` and ``nd(n)``.

    ``fit`` is a filter on the rows of ``source`` the vocabulary is learnt from.
    """
    if bigrams:
        grams = (f"SELECT {key}, unnest(list_concat(w, list_transform(range(1, len(w)), "
                 f"lambda i: w[i] || ' ' || w[i + 1]))) term FROM (SELECT {key}, "
                 f"list_filter(toks, lambda t: length(t) >= 2) w FROM {source})")
    else:
        grams = f"SELECT {key}, term FROM (SELECT {key}, unnest(toks) term FROM {source}) WHERE length(term) >= 2"
    where = f"WHERE {key} IN (SELECT {key} FROM {source} WHERE {fit})" if fit else ""
    return (f"tf AS (SELECT {key}, term, count(*) tf FROM ({grams}) GROUP BY ALL),\n"
            f"voc AS (SELECT term, count(*) df, CAST(sum(tf) AS BIGINT) total FROM tf {where} GROUP BY term "
            f"HAVING count(*) >= {min_df}),\n"
            f"nd AS (SELECT count(*) n FROM {source} {('WHERE ' + fit) if fit else ''})")


def tfidf_ctes(key: str = "doc_id") -> str:
    """CTEs ``raw`` and ``w(key, term, tf, weight)`` on top of ``count_ctes``."""
    return (f"raw AS (SELECT tf.{key}, tf.term, tf.tf, tf.tf * (ln((1.0::DOUBLE + nd.n) / (1.0::DOUBLE + voc.df)) + 1.0::DOUBLE) r "
            f"FROM tf JOIN voc USING (term), nd),\n"
            f"w AS (SELECT {key}, term, tf, r / sqrt(sum(r * r) OVER (PARTITION BY {key})) weight FROM raw)")


def split_ctes(source: str, key: str, by: str, share: float = 0.2, seed: int = 42) -> str:
    """CTE ``sp(<source>.*, part)`` with the stratified dev/train split."""
    return f"""
cnt AS (SELECT {by} c, count(*) n FROM {source} GROUP BY 1),
siz AS (SELECT CAST(sum(n) AS BIGINT) total, CAST(ceil(sum(n)::DOUBLE * {share}::DOUBLE) AS BIGINT) want FROM cnt),
quo AS (SELECT c, n, (n * want) // total q, (n * want) % total rem, want FROM cnt, siz),
fin AS (SELECT c, q + CASE WHEN row_number() OVER (ORDER BY rem DESC, CAST(c AS VARCHAR)) <= want - sum(q) OVER () THEN 1 ELSE 0 END quota FROM quo),
rnk AS (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY md5('{seed}:' || {key}), {key}) rn FROM {source}),
sp AS (SELECT rnk.* EXCLUDE (rn), CASE WHEN rn <= quota THEN 'dev' ELSE 'train' END part FROM rnk JOIN fin ON rnk.{by} = fin.c)""".strip()


def draw(seed: int, *parts: str) -> str:
    """60-bit integer drawn from the parts (SQL expressions)."""
    joined = " || ':' || ".join([f"'{seed}'", *[f"CAST({p} AS VARCHAR)" for p in parts]])
    return f"CAST('0x' || substr(md5({joined}), 1, 15) AS BIGINT)"
