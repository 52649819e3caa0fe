"""SimHash near-duplicates: exact radius search by blocks, compared bit-sliced.

Distinct fingerprints are keyed by every choice of three of ``radius + 3`` bit
blocks; two fingerprints within the radius agree on at least one choice, so no
link is lost. A bucket with too many fingerprints is keyed once more by the
parts of its remaining bits, which bounds it by the number of values left, 2**17.
Inside a bucket the fingerprints are stored as vertical bit planes; carry-save
counters add up 64 distances at once, and words of lanes that all exceed the
radius are abandoned. A bucket yields a spanning forest, never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.llm.common import components, look_up, text_or_empty
from opinara.session import materialize

SHINGLE, SEED, RADIUS = 3, 42, 2
EQUAL_BLOCKS = 3
#: Buckets with more fingerprints than this are keyed again by their remaining bits.
HEAVY_BUCKET = 4096
#: (query, word of 64 lanes) pairs compared at once, and planes between two checks for abandoned words.
PAIRS_AT_ONCE, PLANES_PER_CHECK = 1 << 15, 8
_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str) -> int:
    """Majority bits of the hashes of all word shingles, repeats included; 0 without words."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined, n = b" ".join(words), len(words)
    if n <= SHINGLE:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    begins = np.concatenate(([0], ends[:-SHINGLE] + 1))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(begins.tolist(), ends[SHINGLE - 1:].tolist())], "<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


@F.pandas_udf(T.LongType())
def fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series(np.array([fingerprint(t) for t in batch], np.uint64).view(np.int64))


def _exceeds(counters: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose carry-save count is above the radius."""
    greater, equal = over.copy(), ~over
    for k in reversed(range(len(counters))):
        if radius >> k & 1:
            equal &= counters[k]
        else:
            greater |= equal & counters[k]
            equal &= ~counters[k]
    return greater


def near_lanes(planes: np.ndarray, query_bits: np.ndarray, word: np.ndarray, lanes: np.ndarray,
               radius: int) -> tuple[np.ndarray, np.ndarray]:
    """For pairs (query, word): which pairs keep lanes within the radius, and which lanes.

    ``planes[b, w]`` holds bit b of 64 fingerprints, ``query_bits[b, p]`` all ones
    or zeros for the bit of the pair's query, ``lanes`` the lanes that count.
    """
    pair = np.arange(len(word))
    counters = [np.zeros(len(word), np.uint64) for _ in range(max(1, radius.bit_length()))]
    over = np.zeros(len(word), np.uint64)
    for b in range(len(planes)):
        carry = planes[b, word[pair]] ^ query_bits[b, pair]
        for k, c in enumerate(counters):
            counters[k], carry = c ^ carry, c & carry
        over |= carry
        if b % PLANES_PER_CHECK == PLANES_PER_CHECK - 1 or b == len(planes) - 1:
            alive = (lanes[pair] & ~_exceeds(counters, over, radius)) != 0
            if not alive.all():
                pair, over = pair[alive], over[alive]
                counters = [c[alive] for c in counters]
            if not len(pair):
                break
    return pair, lanes[pair] & ~_exceeds(counters, over, radius)


def unite(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Give both ends of all pairs the same (smallest) label, in place."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def bucket_forest(prints: np.ndarray, bucket: np.ndarray, radius: int) -> np.ndarray:
    """Per position the first position it is linked to, directly or not, within its bucket.

    ``prints`` are sorted by ``bucket`` (equal numbers side by side), unique in each.
    """
    n = len(prints)
    label = np.arange(n)
    last = np.searchsorted(bucket, bucket, side="right")
    varying = [b for b in range(64) if ((prints >> np.uint64(b)) & np.uint64(1)).any()]
    bits = np.array([(prints >> np.uint64(b)) & np.uint64(1) for b in varying], np.uint8).reshape(len(varying), n)
    padded = np.zeros((len(varying), -(-n // 64) * 64), np.uint8)
    padded[:, :n] = bits
    planes = np.packbits(padded, axis=1, bitorder="little").view("<u8")
    # Query i is compared with the lanes i+1 .. last[i]-1 of its bucket.
    queries = np.flatnonzero(last - np.arange(n) > 1)
    first_word, end_word = (queries + 1) >> 6, ((last[queries] - 1) >> 6) + 1
    at = 0
    pairs_before = np.concatenate(([0], np.cumsum(end_word - first_word)))
    while at < len(queries):
        to = max(at + 1, int(np.searchsorted(pairs_before, pairs_before[at] + PAIRS_AT_ONCE, side="right")) - 1)
        count = end_word[at:to] - first_word[at:to]
        query = np.repeat(queries[at:to], count)
        word = np.arange(len(query)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first_word[at:to], count)
        low = np.clip(query + 1 - 64 * word, 0, 63).astype(np.uint64)
        high = np.clip(64 * (word + 1) - last[query], 0, 63).astype(np.uint64)
        lanes = (_ONES << low) & (_ONES >> high)
        pair, near = near_lanes(planes, np.where(bits[:, query] != 0, _ONES, np.uint64(0)), word, lanes, radius)
        hit, lane = np.nonzero(np.unpackbits(near.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        if len(hit):
            unite(label, query[pair[hit]], 64 * word[pair[hit]] + lane)
        at = to
    return label


def _masks(radius: int) -> tuple[list[int], list[list[int]]]:
    """Per choice of equal blocks its bit mask, and the masks of the ``radius + 1`` parts of its other bits."""
    edges = [64 * i // (radius + EQUAL_BLOCKS) for i in range(radius + EQUAL_BLOCKS + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    keys = [sum(c) for c in combinations(blocks, EQUAL_BLOCKS)]
    parts = []
    for key in keys:
        free = [1 << b for b in range(64) if not key >> b & 1]
        cut = [len(free) * i // (radius + 1) for i in range(radius + 2)]
        parts.append([sum(free[a:b]) for a, b in zip(cut, cut[1:])])
    return keys, parts


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def near_links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links ``a, b`` that connect all distinct values of column ``fp`` within the radius of each other."""
    keys, parts = _masks(radius)
    keyed = prints.select("fp", F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("k"))
        for t, m in enumerate(keys)])).alias("key")).select("key.t", "key.k", "fp")
    sizes = keyed.groupBy("t", "k").agg(F.count("fp").alias("n")).where("n > 1")
    shared = materialize(keyed.join(sizes, ["t", "k"]), "simhash-buckets")
    part = lambda s: F.element_at(F.array(*[F.lit(_signed(p[s])) for p in parts]), F.col("t") + 1)
    again = F.explode(F.array(*[F.struct(
        (F.col("t") + len(keys) * (s + 1)).alias("t"),
        F.col("k").bitwiseOR(F.col("fp").bitwiseAND(part(s))).alias("k")) for s in range(radius + 1)]))
    heavy = shared.where(F.col("n") > HEAVY_BUCKET).select("fp", again.alias("key")).select("key.t", "key.k", "fp")
    buckets = shared.where(F.col("n") <= HEAVY_BUCKET).select("t", "k", "fp").unionByName(heavy)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(t, k, fp):
            change = np.concatenate(([0], (np.diff(t) != 0) | (np.diff(k) != 0)))
            label = bucket_forest(fp.view(np.uint64), np.cumsum(change), radius)
            moved = np.flatnonzero(label != np.arange(len(fp)))
            return pa.RecordBatch.from_arrays([pa.array(fp[moved]), pa.array(fp[label[moved]])], ["a", "b"])

        left = tuple(np.empty(0, d) for d in (np.int32, np.int64, np.int64))
        for batch in batches:
            t, k, fp = (np.concatenate((x, batch.column(c).to_numpy(zero_copy_only=False)))
                        for c, x in enumerate(left))
            if not len(t):
                continue
            # The last bucket may go on in the next batch.
            begin = int(np.flatnonzero((t != t[-1]) | (k != k[-1])).max(initial=-1)) + 1
            if begin:
                yield links(t[:begin], k[:begin], fp[:begin])
            left = t[begin:], k[begin:], fp[begin:]
        if len(left[0]):
            yield links(*left)

    return buckets.repartition("t", "k").sortWithinPartitions("t", "k", "fp").mapInArrow(compare, "a long, b long")


def simhash_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                   radius: int = RADIUS) -> DataFrame:
    """``id, fp, component_id`` per row: the smallest id reachable over links of at most ``radius`` bits.

    A null text is an empty one, with fingerprint 0, linked like any other. Null
    ids never become a component's id unless it has no other. Repeated rows come
    out as they went in; no rows give none; other columns are ignored.
    """
    rows = materialize(docs.select(F.col(id_column).alias("id"), fingerprints(text_or_empty(text_column)).alias("fp")),
                       "fingerprints")
    prints = materialize(rows.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")), "prints")
    roots = components(near_links(prints, radius), "simhash-links")
    linked = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    known = materialize(linked.where("n > 1 or root <> fp").select("fp", "root", "n")
                        .unionByName(linked.join(roots.select(F.col("root").alias("fp")).distinct(), "fp", "left_semi")
                                     .select("fp", "root", "n"))
                        .distinct().join(least, "root").select("fp", "component_id", "n"), "print-components")
    out = look_up(rows, known, ["fp"], "n", rows.count())
    # Without an entry the row is alone with its fingerprint.
    return out.select("id", "fp", F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("component_id"))
                      .alias("component_id"))


def drop_near_copies(docs: DataFrame, text_column: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row of each group, with all its columns."""
    row = "__row"
    while row in docs.columns:
        row = f"_{row}"
    tagged = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "tagged-rows")
    dropped = simhash_groups(tagged, row, text_column, radius).where("id <> component_id")
    return tagged.join(dropped.select(F.col("id").alias(row)), row, "left_anti").drop(row)
