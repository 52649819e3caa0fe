"""Exact duplicates, URL filters and quality rules against brute force on hand-made rows."""

import fnmatch
import hashlib
import random
import re

import pytest

from opinara.llm import exact_dedup, quality_rules, url_filters

DOCS = "doc_id long, text string, id string, row string, n long"


def docs(spark, rows):
    """Documents with extra columns whose names clash with internal ones."""
    return spark.createDataFrame([(i, t, "x", None, 7) for i, t in rows], DOCS)


AWKWARD = [(1, None), (2, ""), (3, "a b"), (4, "a b"), (5, "a  b"), (None, "a b"), (7, "z" * 50_000),
           (8, "z" * 50_000), (3, "a b"), (None, "only null"), (None, "only null"), (12, "É é")]


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_groups(spark, keep):
    rows = AWKWARD + [(100 + i, f"copy {i % 3}") for i in range(200)]
    got = exact_dedup.exact_groups(docs(spark, rows).repartition(20), keep=keep).collect()
    assert len(got) == len(rows)
    groups = {}
    for i, t in rows:
        groups.setdefault(hashlib.sha256((t or "").encode()).hexdigest(), []).append(i)
    kept = {}
    for r in got:
        ids = [i for i in groups[r.sha256] if i is not None]
        assert r.group_size == len(groups[r.sha256])
        assert r.keep_id == ((max if keep == "largest" else min)(ids) if ids else None)
        kept[r.sha256] = kept.get(r.sha256, 0) + r.kept
        assert not r.kept or r.id == r.keep_id
    assert set(kept) == set(groups) and set(kept.values()) == {1}


def test_exact_empty_and_drop(spark):
    none = docs(spark, [])
    assert exact_dedup.exact_groups(none).count() == 0
    assert exact_dedup.drop_copies(none).count() == 0
    kept = exact_dedup.drop_copies(docs(spark, AWKWARD))
    assert kept.columns == ["doc_id", "text", "id", "row", "n"]
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(["2", "4", "5", "8", "None", "12"])


def test_automaton_equals_regex():
    random.seed(1)
    globs = ["a*b", "**", "**ab**", "?b/**", "*", "", "abc", "a**c*", "*/b?"] + [
        "".join(random.choice(["a", "b", "/", "*", "**", "?"]) for _ in range(random.randint(1, 25))) for _ in range(60)]
    urls = ["", "abc", "a" * 3000 + "b"] + ["".join(random.choice("ab/c") for _ in range(random.randint(0, 12)))
                                            for _ in range(300)]
    got = url_filters.GlobAutomaton(globs).matches([u.encode() for u in urls])
    for g, glob in enumerate(globs):
        pattern = re.escape(glob).replace(r"\*\*", ".*").replace(r"\*", "[^/]*").replace(r"\?", "[^/]")
        want = [bool(re.fullmatch(pattern, u, re.S)) for u in urls]
        assert got[:, g].tolist() == want, glob
    assert fnmatch.fnmatchcase("a", "*")


def test_judged_urls(spark):
    cases = [
        ("https://WWW.Example.com/en/1?x#y", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
        ("http://m.example.com/en/", "m.example.com", "/en/", "example.com/en/", "block"),
        ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
        ("http://a.com", "a.com", "", None, "allow"),
        ("http://x.net/es/", "x.net", "/es/", "net/es/", "block"),
        ("http://x.net/ES/", "x.net", "/ES/", None, "allow"),
        ("http://org/z.example.com/en/", "org", "/z.example.com/en/", None, "allow"),
        ("http://free-bets.org/", "free-bets.org", "/", None, "block"),
        ("no scheme", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"),
        ("x://É.net/fr/" + "ü" * 20_000, "É.net", "/fr/" + "ü" * 20_000, "net/fr/", "block"),
        ("a://b://c/d", "b:", "//c/d", None, "allow"), ("http://h?q/x", "h", "", None, "allow"),
    ]
    df = spark.createDataFrame([(i, c[0], "clash") for i, c in enumerate(cases)], "page_id long, url string, host string")
    got = {r.id: r for r in url_filters.judge_urls(df).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(cases):
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, verdict), cases[i][0]
    assert url_filters.judge_urls(df.limit(0)).count() == 0


def by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = {}
    for w in windows:
        count[w] = count.get(w, 0) + 1
    covered = {p for i, w in enumerate(windows) if count[w] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(covered))


def test_quality_counts(spark):
    random.seed(2)
    texts = [None, "", " \n\t ", "a b c a b c", "x " * 3000, "a\na\n\n \n \nA", "#*$ %&|<>\x0b\x0cé", "\u00a0 nbsp\u2003word",
             "a b", "a b c", "w" * 100_000]
    texts += [" ".join(random.choice("abc") for _ in range(random.randint(1, 40))) for _ in range(60)]
    texts += ["\n".join(random.choice(["l 1", "l 2", " ", "the of and to"]) for _ in range(30)) for _ in range(20)]
    clean = " ".join(f"the word{i} of" for i in range(40))
    texts += [clean, clean, clean.replace(" ", "!! ").upper()]
    got = quality_rules.apply_rules(docs(spark, list(enumerate(texts)) + [(None, clean)])).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        if r.id is not None:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == by_hand(texts[r.id]), texts[r.id]
            assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
    kept = {r.id for r in got if r.kept}
    assert kept == {len(texts) - 3, len(texts) - 2, None}
    assert quality_rules.apply_rules(docs(spark, [])).count() == 0
