"""Fuzzy lines against brute force over all pairs."""

import glob
import os
import random
import re

from pyspark.sql import functions as F

from opinara.llm import line_dedup
from opinara.session import scratch_root


def cut(line):
    return {line[m.start():m.start() + 9] for m in re.finditer(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]", line)}


def test_lines(spark):
    random.seed(7)
    word = lambda: "".join(random.choice("abcdefgh") for _ in range(random.randint(2, 8)))
    base = [" ".join(word() for _ in range(40)) for _ in range(25)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(random.randint(1, 6)):
            words = random.choice(base).split()
            if random.random() < 0.6:
                words[random.randrange(40)] = word()
            lines.append(" ".join(words))
        rows.append((i, "\n".join(lines)))
    rows += [(100, None), (101, ""), (102, "\n \n\n"), (None, base[0]), (104, "one"), (105, "one\n\none"), (5, rows[5][1]),
             (106, "z" * 30_000 + "\n" + "y " * 20_000)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, row string, n long")
    got = line_dedup.fuzzy_lines(df).collect()
    assert len(got) == len(rows)
    distinct = sorted({x for _, t in rows for x in (t or "").split("\n") if x.strip()})
    sets, root = [cut(x) for x in distinct], list(range(len(distinct)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(distinct)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both >= 0.8 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    number = {x: find(i) for i, x in enumerate(distinct)}
    classes = len(set(number.values()))
    assert classes < len(distinct) / 2
    n_words = sum(bool(x.strip()) for _, t in rows for x in (t or "").split("\n"))
    dropped = sum(len(r.dropped) for r in got)
    assert all(r.n_kept + len(r.dropped) == r.n_lines for r in got)
    assert classes <= n_words - dropped <= classes + 2  # banding may miss a pair
    assert {tuple(r.dropped) for r in got if r.id in (100, 101, 102)} == {()}
    text = spark.createDataFrame([("a\nb\n\nc", [0, 3])], "t string, d array<int>")
    assert text.select(line_dedup.without_lines(F.col("t"), F.col("d"))).first()[0] == "b\n"
    assert line_dedup.fuzzy_lines(df.limit(0)).count() == 0


def whole(line):
    """All shingles of a line, at every place."""
    line = " ".join(re.findall(r"[^\x20\x09-\x0D]+", line))
    return {line[i:i + 9] for i in range(max(len(line) - 8, 1))}


def test_every_place_counts(spark):
    """URLs, long words and scripts without blanks against brute force over all shingles."""
    random.seed(8)
    signs = lambda a, b, n: "".join(chr(random.randint(a, b)) for _ in range(n))
    lines = ["Visit https://example.com/a", "Visit https://example.com/b/other/page", "short", "shore", "x  y", "x y"]
    for a, b in ((0x4E00, 0x9FA5), (0x3041, 0x3096), (0x0E01, 0x0E2E), (0x1F600, 0x1F640), (97, 122)):
        head = signs(a, b, 9)
        lines += [head + signs(a, b, 60) for _ in range(5)]
        same = head + signs(a, b, 400)
        lines += [same, same[:200] + signs(a, b, 2) + same[202:]]
    lines += ["https://example.com/" + signs(97, 122, 40) for _ in range(5)]
    long = signs(97, 122, 9000)
    lines += [long, long[:8999] + "!", long[:4500], signs(97, 122, 4104), signs(97, 122, 72)]
    got = spark.createDataFrame([(x,) for x in lines], "line string").select(
        "line", F.size(line_dedup.shingles(F.col("line"))).alias("n")).collect()
    sets = [whole(x) for x in lines]
    assert [r.n for r in got] == [len(whole(r.line)) for r in got]
    # In order of id: the first of every component stays.
    first = list(range(len(lines)))
    for i in range(len(lines)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) and first[i] == i:
                first[i] = first[j]
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    kept = {r.id for r in line_dedup.fuzzy_lines(df).collect() if r.n_kept}
    assert kept == set(first) and len(lines) - len(kept) == 7


def test_cutting_is_compiled_and_finds_pairs(spark):
    """No shingle is cut by an interpreted function ahead of the minima, and pairs at the limit share a bucket."""
    random.seed(9)
    signs = lambda n: "".join(chr(random.choice((97, 0xE0, 0x4E00)) + random.randrange(26)) for _ in range(n))
    lines = []
    for n in (40, 100, 400):
        for _ in range(100):
            text = signs(n)
            # Of a set's 0.9 in its first part 0.8 of the union are shared.
            lines += [text, text[:n * 8 // 9 + 1] + signs(n // 9 - 1)]
    rows = spark.createDataFrame(list(enumerate(lines)), "line_id long, line string")
    keyed = line_dedup.band_keys(rows)
    assert "lambda" not in keyed._jdf.queryExecution().executedPlan().toString()
    keys = {}
    for r in keyed.collect():
        keys.setdefault(r.line_id, set()).add(r.key)
    at_limit = [i for i in range(0, len(lines), 2) if len(whole(lines[i]) & whole(lines[i + 1])) * 100 >= 75 * len(
        whole(lines[i]) | whole(lines[i + 1]))]
    assert len(at_limit) == 300
    assert sum(bool(keys[i] & keys[i + 1]) for i in at_limit) >= 285
    long = signs(2 * line_dedup.PIECE + 20)
    same = spark.createDataFrame([(0, long), (1, long + "  ")], "line_id long, line string")
    assert line_dedup.band_keys(same).select("key").distinct().count() == line_dedup.BANDS


def test_unshared_text_is_not_written(spark):
    """Lines without a like leave digests and bands in the shared folder, not their text."""
    random.seed(10)
    rows = [(i, "".join(chr(random.randrange(0x4E00, 0x9FA5)) for _ in range(4000))) for i in range(100)]
    root = scratch_root(spark).removeprefix("file://")
    before = set(os.listdir(root))
    got = line_dedup.fuzzy_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.n_kept == 1 for r in got) and len(got) == 100
    written = sum(os.path.getsize(x) for name in set(os.listdir(root)) - before for x in glob.glob(f"{root}/{name}/*.parquet"))
    assert 0 < written < 0.3 * sum(len(t.encode()) for _, t in rows)


def test_further_links_join_roots(spark):
    roots = spark.createDataFrame([(1, 1), (4, 1), (2, 2), (9, 2), (5, 5), (6, 5)], "node long, root long")
    links = spark.createDataFrame([(9, 4), (7, 8), (3, 6)], "a long, b long")
    got = {r.node: r.root for r in line_dedup.joined(roots, links).collect()}
    assert got == {1: 1, 4: 1, 2: 1, 9: 1, 5: 3, 6: 3, 3: 3, 7: 7, 8: 7}
