"""Mix overlapping sources to target weights by a minimum-cost flow.

Documents are added up by membership pattern (the set of sources they belong
to). Each pattern can send its words up to three times, each repetition dearer
than the one before, to the quotas of its sources; the cheapest flow says how
many words of every pattern are taken. Whole documents are then chosen by a
seeded hash whose cut per pattern is found from counts of its leading digits;
what the cut leaves open is filled by further cuts among later, smaller documents.
Only patterns and sources reach the driver, never documents.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opinara.llm.common import SPACE_CLASS, SPACES, seeded, text_or_empty
from opinara.session import materialize, small_table

WEIGHTS, MAX_REPEATS, SEED = (5, 2, 1), 3, 42
#: Patterns are named by whoever lays out the corpus; more than this is no source column, and an error.
MAX_PATTERNS = 100_000
#: The hash has 63 bits; its two leading digits have this many each.
DIGIT_BITS = 12
#: Past every draw.
END = (1 << 63) - 1


def water_fill(sizes: Sequence[int], weights: Sequence[float], repeats: int = MAX_REPEATS) -> list[float]:
    """Share all sizes by weight; no share above ``repeats`` times its own size, the excess shared again."""
    total, caps = float(sum(sizes)), [float(repeats * s) for s in sizes]
    capped: set[int] = set()
    while True:
        free = [i for i in range(len(sizes)) if i not in capped]
        left = total - sum(caps[i] for i in capped)
        weight = sum(weights[i] for i in free)
        shares = {i: left * weights[i] / weight for i in free}
        over = {i for i in free if shares[i] > caps[i]}
        if not over:
            return [shares.get(i, caps[i]) for i in range(len(sizes))]
        capped |= over


def min_cost_flow(capacity: Sequence[int], members: Sequence[Sequence[int]], quotas: Sequence[int],
                  repeats: int = MAX_REPEATS) -> list[dict[int, int]]:
    """Words each pattern sends to each of its sources: the largest flow of least cost.

    The k-th use of a pattern's words costs k squared, so a repetition is never
    bought while fresh words are left. Patterns without a common source are
    solved apart.
    """
    flow: list[dict[int, int]] = [{} for _ in capacity]
    holders = defaultdict(list)
    for p, sources in enumerate(members):
        for s in sources:
            holders[s].append(p)
    seen: set[int] = set()
    for first in range(len(capacity)):
        if first in seen:
            continue
        group, stack = [], [first]
        seen.add(first)
        while stack:
            p = stack.pop()
            group.append(p)
            for q in {q for s in members[p] for q in holders[s]} - seen:
                seen.add(q)
                stack.append(q)
        _solve(sorted(group), capacity, members, quotas, repeats, flow)
    return flow


def _solve(group, capacity, members, quotas, repeats, flow) -> None:
    """Successive cheapest paths with node prices (all prices start right: no cost is negative)."""
    sources = sorted({s for p in group for s in members[p]})
    name = {("p", p): i + 2 for i, p in enumerate(group)}
    name |= {("s", s): len(name) + 2 + i for i, s in enumerate(sources)}
    start, sink = 0, 1
    to, room, cost, arcs = [], [], [], [[] for _ in range(len(name) + 2)]

    def arc(a, b, c, w):
        for u, v, r, k in ((a, b, c, w), (b, a, 0, -w)):
            arcs[u].append(len(to))
            to.append(v), room.append(r), cost.append(k)

    routes = []
    for p in group:
        for k in range(repeats):
            arc(start, name["p", p], capacity[p], k * k)
        for s in members[p]:
            routes.append((p, s, len(to)))
            arc(name["p", p], name["s", s], repeats * capacity[p], 0)
    for s in sources:
        arc(name["s", s], sink, quotas[s], 0)
    price = [0] * len(arcs)
    while True:
        far, via, heap = {start: 0}, {}, [(0, start)]
        done = set()
        while heap:
            d, u = heapq.heappop(heap)
            if u in done:
                continue
            done.add(u)
            for e in arcs[u]:
                v, nd = to[e], d + cost[e] + price[u] - price[to[e]]
                if room[e] > 0 and nd < far.get(v, float("inf")):
                    far[v], via[v] = nd, e
                    heapq.heappush(heap, (nd, v))
        if sink not in far:
            break
        for u in range(len(arcs)):
            price[u] += min(far.get(u, far[sink]), far[sink])
        path, u = [], sink
        while u != start:
            path.append(via[u])
            u = to[via[u] ^ 1]
        push = min(room[e] for e in path)
        for e in path:
            room[e] -= push
            room[e ^ 1] += push
    for p, s, e in routes:
        if room[e ^ 1]:
            flow[p][s] = room[e ^ 1]


def word_count(column: str) -> Column:
    """Runs of characters other than the six spaces; null has none."""
    trimmed = F.btrim(text_or_empty(column), F.lit(SPACES))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, SPACE_CLASS + "+"))).cast("long")


class Mix:
    """The decision: per pattern how often its documents are taken, and which once more.

    Once more go those before ``cut``, those of ``fills`` (between two places of the
    seeded order, up to a size) and those of ``extra``.
    """

    def __init__(self, patterns: DataFrame, extra: DataFrame, sources: dict, seed: int):
        self.patterns, self.extra, self.sources, self.seed = patterns, extra, sources, seed

    def apply(self, rows: DataFrame, members: Column, draw: Column, size: Column, prefix: str = "") -> DataFrame:
        """``rows`` with ``{prefix}copies``: how often the mix takes each."""
        key, number, mark = f"{prefix}members", f"{prefix}draw", f"{prefix}extra"
        pattern = self.patterns.select(F.col("members").alias(key), F.col("pid").alias(f"{prefix}pid"),
                                       F.col("full").alias(f"{prefix}full"), F.col("cut").alias(f"{prefix}cut"),
                                       F.col("fills").alias(f"{prefix}fills"))
        extra = self.extra.select(F.col("pid").alias(f"{prefix}pid"), F.col("draw").alias(number),
                                  F.lit(True).alias(mark))
        # Both tables have a row or a few dozen numbers per pattern, and patterns are counted before.
        out = (rows.withColumns({key: members, number: draw})
               .join(F.broadcast(pattern), key, "left").join(F.broadcast(extra), [f"{prefix}pid", number], "left"))
        # Fills of a pattern do not overlap, so at most one holds the draw.
        most = F.get(F.filter(f"{prefix}fills", lambda x: (x["lo"] < F.col(number)) & (F.col(number) < x["hi"])), F.lit(0))["most"]
        more = ((F.col(number) < F.col(f"{prefix}cut")) | F.coalesce(F.col(mark), F.lit(False))
                | F.when(most.isNotNull(), (size > 0) & (size <= most)).otherwise(False))
        return (out.withColumn(f"{prefix}copies", F.coalesce(F.col(f"{prefix}full") + more.cast("int"), F.lit(0)))
                .drop(key, number, mark, f"{prefix}pid", f"{prefix}full", f"{prefix}cut", f"{prefix}fills"))


def _boundary(rows: DataFrame, by: list[str], digit: Column) -> DataFrame:
    """Per pattern the digit at which the running size passes ``gap``; ``gap`` less what lies below it."""
    sums = rows.groupBy(*by, "gap", digit.alias("digit")).agg(F.sum("size").alias("s"))
    run = F.sum("s").over(W.partitionBy(*by).orderBy("digit"))
    return (sums.withColumn("upto", run).where("upto > gap").groupBy(*by)
            .agg(F.min_by(F.struct("digit", (F.col("gap") - F.col("upto") + F.col("s")).alias("gap")), "digit").alias("b"))
            .select(*by, "b.digit", "b.gap"))


def _cuts(rows: DataFrame) -> dict:
    """Per ``pid`` where the seeded order passes ``gap``, and the words still missing there.

    Found from two digits of the hash, then the hash itself. A ``pid`` whose rows do not pass its gap is left out.
    """
    first = lambda c: F.shiftrightunsigned(c, 63 - DIGIT_BITS)
    second = lambda c: F.shiftrightunsigned(c, 63 - 2 * DIGIT_BITS)
    cut = None
    for digit in (first, second, lambda c: c):
        part = rows
        if cut is not None:
            previous, edge = cut
            part = (rows.drop("gap").join(F.broadcast(edge), "pid")
                    .where(previous(F.col("draw")) == F.col("digit")).drop("digit"))
        cut = digit, materialize(_boundary(part, ["pid"], digit(F.col("draw"))), "mix-edge")
    return {r["pid"]: (r["digit"], r["gap"]) for r in cut[1].collect()}


def _fill(rows: DataFrame, edges: dict) -> tuple[dict, list]:
    """``fills`` and ``extra`` for what the cuts ``edges`` leave open.

    A round takes documents of at most half the gap beyond the last cut, up to
    where they pass it, so the gap halves each time. Once they no longer
    pass it all of them are taken, and one document of over half that gap may fit.
    In the end no later document fits (documents repeated in id and text, which go together, apart).
    """
    spark, fills, last, extra = rows.sparkSession, defaultdict(list), {}, []
    rows = rows.select("pid", "draw", "size")
    open_ = {p: (lo, gap, gap // 2) for p, (lo, gap) in edges.items() if gap}
    columns = "pid int, lo long, gap long, most long"
    while open_:
        state = F.broadcast(small_table(spark, [(p, *x) for p, x in open_.items()], columns))
        fit = rows.join(state, "pid").where("draw > lo and size <= most")
        sums = {r["pid"]: r["s"] for r in fit.groupBy("pid").agg(F.sum("size").alias("s")).collect()}
        passing = any(s > open_[p][1] for p, s in sums.items())
        cuts = _cuts(fit.select("pid", "draw", "size", "gap")) if passing else {}
        left = {}
        for p, (lo, gap, most) in open_.items():
            if p in cuts:
                hi, rest = cuts[p]
                fills[p].append((lo, hi, most))
                if rest:
                    left[p] = hi, rest, min(rest, most) // 2
                continue
            if p in sums:
                fills[p].append((lo, END, most))
            if gap > sums.get(p, 0):
                last[p] = lo, gap - sums.get(p, 0), most
        open_ = left
    if last:
        state = F.broadcast(small_table(spark, [(p, *x) for p, x in last.items()], columns))
        whole = (rows.join(state, "pid").where("draw > lo and size > most and size <= gap")
                 .groupBy("pid", "draw").agg(F.sum("size").alias("s"), F.first("gap").alias("gap")).where("s <= gap"))
        extra = [(r["pid"], r["draw"]) for r in whole.groupBy("pid").agg(F.min("draw").alias("draw")).collect()]
    return fills, extra


def draw_of(seed: int, id_column: str, text_column: str) -> Column:
    """The place of a document in its pattern's seeded order."""
    return seeded(seed, F.col(id_column).cast("string"), F.col(text_column).cast("string"))


def plan_mix(sized: DataFrame, weights: Sequence[float] = WEIGHTS, repeats: int = MAX_REPEATS,
             seed: int = SEED) -> Mix:
    """Decide the mix for ``members, size, draw`` rows."""
    spark = sized.sparkSession
    sums = sized.groupBy("members").agg(F.sum("size").alias("size")).limit(MAX_PATTERNS + 1).collect()
    if len(sums) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    rank = lambda s: (s is None, s or "")
    sums.sort(key=lambda r: [rank(s) for s in r["members"]])
    sources = sorted({s for r in sums for s in r["members"]}, key=rank)
    place = {s: i for i, s in enumerate(sources)}
    size = [0] * len(sources)
    for r in sums:
        for s in r["members"]:
            size[place[s]] += r["size"]
    # Overlaps count once in the total: it is scaled so that patterns' words are shared out exactly once.
    total = sum(r["size"] for r in sums)
    scale = total / sum(size) if sum(size) else 1.0
    cycle = [weights[i % len(weights)] for i in range(len(sources))]
    targets = water_fill(size, cycle, repeats) if scale == 1.0 else [
        t * scale for t in water_fill(size, cycle, repeats)]
    flow = min_cost_flow([r["size"] for r in sums], [[place[s] for s in r["members"]] for r in sums],
                         [int(t) for t in targets], repeats)
    taken = [sum(f.values()) for f in flow]
    full = [t // r["size"] if r["size"] else 0 for t, r in zip(taken, sums)]
    plan = small_table(spark, [(i, list(r["members"]), f, t - f * r["size"]) for i, (r, f, t)
                               in enumerate(zip(sums, full, taken))], "pid int, members array<string>, full long, gap long")
    open_rows = materialize(sized.where("size > 0").join(F.broadcast(plan.where("gap > 0")), "members").select(
        "pid", "size", "draw", "gap"), "mix-open")
    edges = _cuts(open_rows)
    fills, extra = _fill(open_rows, edges)
    patterns = small_table(spark, [(i, list(r["members"]), f, edges.get(i, (0, 0))[0], fills.get(i, []))
                                   for i, (r, f) in enumerate(zip(sums, full))],
                           "pid int, members array<string>, full long, cut long, "
                           "fills array<struct<lo: long, hi: long, most: long>>")
    return Mix(patterns, small_table(spark, extra, "pid int, draw long"),
               {s: (z, t) for s, z, t in zip(sources, size, targets)}, seed)


def source_members(column: str) -> Column:
    """A source column as a membership pattern; an array column is a set of sources."""
    return F.array(F.col(column).cast("string"))


def mix_report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
               weights: Sequence[float] = WEIGHTS, repeats: int = MAX_REPEATS, seed: int = SEED) -> DataFrame:
    """``id, source, size, source_size, target, copies, taken`` for every row.

    Sources in code-point order, null (a source of its own) last, weigh
    ``weights`` in turn. A null text has no words. Rows that agree in id and text
    share a draw, so reruns and repeated rows agree. No rows give none; other
    columns are ignored.
    """
    sized = materialize(docs.select(
        F.col(id_column).alias("id"), F.col(source_column).cast("string").alias("source"),
        source_members(source_column).alias("members"), word_count(text_column).alias("size"),
        draw_of(seed, id_column, text_column).alias("draw")), "mix-sizes")
    mix = plan_mix(sized.select("members", "size", "draw"), weights, repeats, seed)
    shares = small_table(docs.sparkSession, [([s], z, t) for s, (z, t) in mix.sources.items()],
                         "members array<string>, source_size long, target double")
    out = mix.apply(sized.select("id", "source", "members", "size", "draw"), F.col("members"), F.col("draw"), F.col("size"),
                    "__")
    return (out.join(F.broadcast(shares), "members", "left")
            .select("id", "source", "size", "source_size", "target", F.col("__copies").alias("copies"),
                    (F.col("size") * F.col("__copies")).alias("taken")))


def mix_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                  source_column: str = "source", weights: Sequence[float] = WEIGHTS, repeats: int = MAX_REPEATS,
                  seed: int = SEED) -> DataFrame:
    """The mix itself: every row as often as it is taken, with its own columns."""
    members, draw = source_members(source_column), draw_of(seed, id_column, text_column)
    sized = materialize(docs.select(members.alias("members"), word_count(text_column).alias("size"),
                                    draw.alias("draw")), "mix-sizes")
    mix = plan_mix(sized, weights, repeats, seed)
    prefix = "__mix_"
    while any(c.startswith(prefix) for c in docs.columns):
        prefix = f"_{prefix}"
    taken = mix.apply(docs, members, draw, word_count(text_column), prefix).where(F.col(f"{prefix}copies") > 0)
    copies = F.explode(F.sequence(F.lit(1), F.col(f"{prefix}copies").cast("int")))
    return taken.withColumn(f"{prefix}copy", copies).select(*[F.col(f"`{c}`") for c in docs.columns])
