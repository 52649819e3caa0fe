"""Water filling, the flow against brute force, and what a mix takes."""

import itertools
import random

import pytest

from opinara.llm import mixing

DOCS = "doc_id long, text string, source string, size string, members string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", None) for i, t, s in rows], DOCS)


def test_water_fill():
    assert mixing.water_fill([], []) == []
    assert mixing.water_fill([10, 10], [1, 1]) == [10.0, 10.0]
    assert mixing.water_fill([1, 99], [5, 2]) == [3.0, 97.0]
    random.seed(1)
    for _ in range(200):
        sizes = [random.choice([0, 1, 7, 100, 5000]) for _ in range(random.randint(1, 8))]
        weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
        got = mixing.water_fill(sizes, weights)
        assert all(g <= 3 * s + 1e-9 for g, s in zip(got, sizes))
        assert sum(got) == pytest.approx(sum(sizes))
        rates = {round(g / w, 6) for g, w, s in zip(got, weights, sizes) if g < 3 * s - 1e-6}
        assert len(rates) <= 1 and all(3 * s / w <= max(rates) + 1e-5 for g, w, s in zip(got, weights, sizes)
                                       if rates and g >= 3 * s - 1e-6)


def test_flow_is_best():
    """Every split of the pattern's words over the sources, tried in turn."""
    random.seed(2)
    for _ in range(40):
        capacity = [random.randint(0, 2) for _ in range(3)]
        members = [random.sample(range(2), random.randint(1, 2)) for _ in capacity]
        quotas = [random.randint(0, 5) for _ in range(2)]
        flow = mixing.min_cost_flow(capacity, members, quotas)

        def cost(sent):
            return sum(sum(k * k * min(c, max(0, n - k * c)) for k in range(3)) for c, n in zip(capacity, sent))
        best = None
        arcs = [(p, s) for p, m in enumerate(members) for s in m]
        for amounts in itertools.product(*[range(3 * capacity[p] + 1) for p, _ in arcs]):
            sent, got = [0] * 3, [0] * 2
            for (p, s), n in zip(arcs, amounts):
                sent[p] += n
                got[s] += n
            if all(n <= 3 * c for n, c in zip(sent, capacity)) and all(g <= q for g, q in zip(got, quotas)):
                best = max(best, (sum(sent), -cost(sent))) if best else (sum(sent), -cost(sent))
        sent = [sum(f.values()) for f in flow]
        assert (sum(sent), -cost(sent)) == best
        assert all(sum(f.get(s, 0) for f in flow) <= quotas[s] for s in range(2))


def test_mix(spark):
    random.seed(3)
    rows = [(i, " ".join("w" * random.choice([0, 1, 5]) for _ in range(random.choice([0, 3, 40, 400]))),
             random.choice(["a", "b", "ü", "Z", None, "big", "big", "big"])) for i in range(400)]
    rows += [(None, None, "a"), (None, "x y", None), (5, rows[5][1], rows[5][2]), (900, "one", "tiny"),
             (901, "word " * 50_000, "long"), (902, "", "void")]
    got = mixing.mix_report(docs(spark, rows)).collect()
    again = mixing.mix_report(docs(spark, rows).repartition(7)).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, got)) == sorted(map(key, again)) and len(got) == len(rows)
    words = {}
    for _, t, s in rows:
        words[s] = words.get(s, 0) + len((t or "").split())
    order = sorted(words, key=lambda s: (s is None, s or ""))
    want = dict(zip(order, mixing.water_fill([words[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))])))
    for s in order:
        mine = [r for r in got if r.source == s]
        assert {r.source_size for r in mine} == {words[s]} and {r.target for r in mine} == {want[s]}
        assert all(r.taken in (0, r.size, 2 * r.size, 3 * r.size) for r in mine)
        if s not in ("long", "tiny"):
            assert abs(sum(r.taken for r in mine) - want[s]) <= max(5, 0.02 * want[s]), s
    mixed = mixing.mix_documents(docs(spark, rows))
    assert mixed.columns == ["doc_id", "text", "source", "size", "members"]
    assert mixed.count() == sum(r.copies for r in got)


def test_no_rows(spark):
    assert mixing.mix_report(docs(spark, [])).count() == 0
    assert mixing.mix_documents(docs(spark, [])).count() == 0


def test_one_very_long_document(spark):
    """Many short documents fill what a long one at the cut leaves open, whichever seed puts it there."""
    rows = [(i, "w " * random.Random(i).choice([1, 10, 19]), "b") for i in range(1000)]
    rows += [(5000, "w " * 10_000, "b"), (6000, "w " * 5_000, "a")]
    size = {i: len(t.split()) for i, t, _ in rows}
    short = sum(size[i] for i in range(1000))
    table = docs(spark, rows)
    for seed in range(3):
        got = mixing.mix_report(table, weights=(1, 2), seed=seed).where("source = 'b'").collect()
        target, taken = got[0].target, sum(r.taken for r in got)
        full = min(r.copies for r in got)
        left = target - taken
        assert left >= 0 and all(r.copies in (full, full + 1) for r in got)
        # No document that was left out fits any more, but those before the first cut, which all went in.
        assert left < min([r.size for r in got if r.copies == full], default=left + 1), seed
        assert left < 1 or short < target - 10_000 * max(r.copies for r in got if r.id == 5000)
    mixed = mixing.mix_documents(table, weights=(1, 2), seed=0).where("source = 'b'").count()
    assert mixed == sum(r.copies for r in mixing.mix_report(table, weights=(1, 2), seed=0).where("source = 'b'").collect())
