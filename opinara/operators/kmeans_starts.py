"""K-Means of many starts and many k at once.

Every pass over the rows serves all starts that have not settled: their
centres are one matrix, so a pass is a product of matrices a block. Rows are
packed once into blocks. The first centres are drawn as k-means++ draws them,
over all rows: a row's draw is a seeded number weighed by its squared distance,
and the best draw of all blocks is the next centre.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeansModel
from pyspark.mllib.common import _py2java
from pyspark.mllib.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.operators.sparse_trees import VECTOR
from opinara.session import materialize, scratch_path

# Numbers of a block of rows.
BLOCK_NUMBERS = 262_144


@dataclass
class Start:
    """One start: its k, its seed and what it has found."""

    k: int
    seed: int
    centres: np.ndarray
    settled: bool = False
    cost: float = float("inf")


def pack(vectors: DataFrame, features: str) -> DataFrame:
    """``(block, width, rows)``: the vectors as matrices of bounded size; ``block`` numbers them."""
    spark, path = vectors.sparkSession, scratch_path(vectors.sparkSession, "vectors")
    vectors.select(F.col(features).alias("v")).write.parquet(path)
    stored = spark.read.schema(f"v {VECTOR}").parquet(path)
    width = F.coalesce("v.size", F.size("v.values"))
    plain = stored.select(width.alias("width"), "v.type", "v.indices", "v.values")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            if not whole.num_rows:
                continue
            width = whole.column(0)[0].as_py()
            step = max(1, BLOCK_NUMBERS // max(1, width))
            for begin in range(0, whole.num_rows, step):
                batch = whole.slice(begin, step)
                out = np.zeros((batch.num_rows, width))
                sparse = batch.column(1).to_numpy(zero_copy_only=False) == 0
                for i, (index, value) in enumerate(zip(batch.column(2), batch.column(3))):
                    if sparse[i]:
                        out[i, index.values.to_numpy()] = value.values.to_numpy()
                    else:
                        out[i] = value.values.to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array([width], pa.int32()), pa.array([out.tobytes()], pa.binary())], names=["width", "rows"])

    blocks = plain.mapInArrow(run, "width int, rows binary")
    return materialize(blocks.withColumn("block", F.monotonically_increasing_id()), "packed-rows").select("block", "width", "rows")


def _each(blocks: DataFrame, run, schema: str, names: list[str]) -> DataFrame:
    """What ``run(block, matrix)`` gives for every block, as columns."""
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, width, data in zip(*[c.to_pylist() for c in batch.columns]):
                columns = run(block, np.frombuffer(data).reshape(-1, width))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)
    return blocks.mapInArrow(over, schema)


def _draw(blocks: DataFrame, starts: list[Start]) -> None:
    """One more centre for each of the starts; none where every row is a centre already."""
    shared = [(i, s.seed, s.centres) for i, s in enumerate(starts)]

    def run(block: int, rows: np.ndarray):
        out: list[list] = [[], [], []]
        for i, seed, centres in shared:
            chance = np.random.default_rng([seed, len(centres), block]).exponential(size=len(rows))
            if len(centres):
                least = np.full(len(rows), np.inf)
                for c in centres:
                    least = np.minimum(least, ((rows - c) ** 2).sum(axis=1))
                chance = np.divide(chance, least, out=np.full(len(rows), np.inf), where=least > 0)
            at = int(chance.argmin())
            if np.isfinite(chance[at]):
                for held, x in zip(out, (i, float(chance[at]), rows[at].tobytes())):
                    held.append(x)
        return [np.array(out[0], np.int32), np.array(out[1], float), pa.array(out[2], pa.binary())]

    found = _each(blocks, run, "start int, chance double, row binary", ["start", "chance", "row"])
    for r in found.groupBy("start").agg(F.min_by("row", "chance").alias("row")).collect():
        start = starts[r["start"]]
        start.centres = np.vstack((start.centres, np.frombuffer(bytes(r["row"])))) if len(start.centres) else np.frombuffer(bytes(r["row"]))[None, :]


def _pass(blocks: DataFrame, starts: list[Start], costs: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums and sizes of all clusters of all starts, and the cost of each start where asked for; starts are in order of their sizes."""
    lengths = np.array([len(s.centres) for s in starts])
    groups = [(int(k), int((lengths == k).sum())) for k in np.unique(lengths)]
    shared = blocks.sparkSession.sparkContext.broadcast(np.concatenate([s.centres for s in starts]))
    n_starts = len(starts)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = shared.value
        half = (centres * centres).sum(axis=1) / 2
        sums, sizes, cost = np.zeros(centres.shape), np.zeros(len(centres)), np.zeros(n_starts)
        for batch in batches:
            for _, width, data in zip(*[c.to_pylist() for c in batch.columns]):
                rows = np.frombuffer(data).reshape(-1, width)
                gap = half - rows @ centres.T
                member, at, number = np.zeros(gap.shape), 0, 0
                for k, n in groups:
                    best = gap[:, at:at + n * k].reshape(len(rows), n, k).argmin(axis=2) + at + np.arange(n) * k
                    np.put_along_axis(member, best, 1.0, axis=1)
                    if costs:
                        for i in range(n):
                            cost[number + i] += ((rows - centres[best[:, i]]) ** 2).sum()
                    at, number = at + n * k, number + n
                sums += member.T @ rows
                sizes += member.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in (sums, sizes, cost)], names=["sums", "sizes", "cost"])

    total = [np.zeros(shared.value.shape), np.zeros(len(shared.value)), np.zeros(n_starts)]
    # One row a task, of as many numbers as the centres have.
    for r in blocks.mapInArrow(over, "sums binary, sizes binary, cost binary").collect():
        for held, x in zip(total, r):
            held += np.frombuffer(bytes(x)).reshape(held.shape)
    shared.destroy()
    return tuple(total)


def fit_starts(blocks: DataFrame, ks: list[int], n_init: int, seed: int, max_iter: int, tol: float) -> dict[int, Start]:
    """For every k the start of least cost, the earlier one on a tie; a centre that moves no further than ``tol`` is settled."""
    starts = [Start(k, seed + i, np.zeros((0, 0))) for k in ks for i in range(n_init)]
    for _ in range(max(ks)):
        _draw(blocks, [s for s in starts if len(s.centres) < s.k])
    if not all(len(s.centres) for s in starts):
        raise ValueError("no rows to cluster")
    by_size = sorted(starts, key=lambda s: len(s.centres))
    for _ in range(max_iter):
        open_ = [s for s in by_size if not s.settled]
        if not open_:
            break
        sums, sizes, _ = _pass(blocks, open_)
        at = 0
        for s in open_:
            part = slice(at, at + len(s.centres))
            at = part.stop
            moved = np.where(sizes[part, None] > 0, sums[part] / np.maximum(sizes[part, None], 1), s.centres)
            s.settled = bool((((moved - s.centres) ** 2).sum(axis=1) <= tol * tol).all())
            s.centres = moved
    for s, cost in zip(by_size, _pass(blocks, by_size, True)[2]):
        s.cost = float(cost)
    return {k: min((s for s in starts if s.k == k), key=lambda s: s.cost) for k in ks}


def model_of(blocks: DataFrame, start: Start, features: str, prediction: str, max_iter: int, tol: float) -> KMeansModel:
    """The centres as an MLlib model."""
    context = blocks.sparkSession.sparkContext
    jvm = context._jvm
    centres = context._gateway.new_array(jvm.org.apache.spark.mllib.linalg.Vector, len(start.centres))
    for i, c in enumerate(start.centres):
        centres[i] = _py2java(context, Vectors.dense(c))
    inner = jvm.org.apache.spark.mllib.clustering.KMeansModel(centres)
    model = KMeansModel(jvm.org.apache.spark.ml.clustering.KMeansModel(f"kmeans-{start.k}-{start.seed}", inner))
    model._set(k=max(2, start.k), seed=start.seed, featuresCol=features, predictionCol=prediction, maxIter=max_iter, tol=tol)
    model._transfer_params_to_java()
    return model
