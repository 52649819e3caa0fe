"""SimHash fingerprints, the bit-sliced search and its components against brute force."""

import random

import numpy as np
import pytest
import xxhash

from opinara.llm import common, simhash

DOCS = "doc_id long, text string, fp string, n long, root string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", 7, None) for i, t in rows], DOCS)


def brute_print(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    words = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in words]
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def brute_groups(prints, radius):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_fingerprints():
    random.seed(3)
    texts = ["", " \n", "one", "One TWO", "a b c", "É É x Y\x0bZ\x1cq", "x " * 5000] + [
        " ".join(random.choice(["aa", "b", "Cc", "é", "d\n"]) for _ in range(random.randint(1, 60))) for _ in range(50)]
    for t in texts:
        assert simhash.fingerprint(t) == brute_print(t), t


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_bucket_forest(radius):
    rng = np.random.default_rng(radius)
    centre = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    prints, bucket = [], []
    for k, c in enumerate(centre):
        own = {int(c)}
        for _ in range(rng.integers(0, 150)):
            own.add(int(c) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 6), replace=False)))
        prints += sorted(own)
        bucket += [k] * len(own)
    label = simhash.bucket_forest(np.array(prints, np.uint64), np.array(bucket), radius)
    for k in range(len(centre)):
        at = [i for i, b in enumerate(bucket) if b == k]
        want = brute_groups([prints[i] for i in at], radius)
        assert [label[i] - at[0] for i in at] == want


def test_groups(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HEAVY_BUCKET", 8)
    random.seed(5)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = [(1, None), (2, ""), (None, "\n"), (4, "solo"), (4, "solo"), (None, "alone with null id"), (7, "y" * 100_000)]
    for g in range(12):
        base = [random.choice(vocabulary) for _ in range(120)]
        for c in range(random.choice([1, 3, 25])):
            words = list(base)
            for _ in range(random.choice([0, 0, 1, 1, 2])):
                words[random.randrange(len(words))] = random.choice(vocabulary)
            rows.append((100 + 40 * g + c, " ".join(words)))
    random.shuffle(rows)
    prints = [brute_print(t) for _, t in rows]
    groups = brute_groups(prints, 2)
    least = {}
    for (i, _), g in zip(rows, groups):
        least[g] = min((x for x in (least.get(g), i) if x is not None), default=None)
    want = sorted((str(i), p - (1 << 64) if p >> 63 else p, str(least[g])) for (i, _), p, g in zip(rows, prints, groups))
    got = sorted((str(r.id), r.fp, str(r.component_id)) for r in simhash.simhash_groups(docs(spark, rows)).collect())
    assert got == want
    assert len(set(groups)) < 0.6 * len(rows)
    kept = simhash.drop_near_copies(docs(spark, rows))
    assert kept.columns == ["doc_id", "text", "fp", "n", "root"]
    assert kept.count() == len(set(groups))


def test_no_rows(spark):
    assert simhash.simhash_groups(docs(spark, [])).count() == 0


def test_components(spark):
    random.seed(6)
    links = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 40)] + [(200, 201), (201, 200), (5, 5)]
    links += [(random.randrange(300, 400), random.randrange(300, 400)) for _ in range(60)]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    near = {}
    for a, b in links:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    for node in near:
        seen, stack = {node}, [node]
        while stack:
            for m in near[stack.pop()] - seen:
                seen.add(m)
                stack.append(m)
        assert got[node] == min(seen)
    assert set(got) == set(near)
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0
