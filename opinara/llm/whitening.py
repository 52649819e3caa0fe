"""Embedding whitening: Golub-Kahan-Lanczos bidiagonalisation of the centred distinct vectors.

Vectors become whole numbers, so counts, sums and deviations are exact. The
distinct vectors X are written once in packed blocks; every step of the
bidiagonalisation is a product Xv and a product X'u over these blocks, summed
in the tasks. Only vectors of the embedding's width reach the driver: a left
vector u = Xw is kept as its w and made again inside the task, so no step has
state on an executor and a lost one costs a re-read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.session import materialize

#: Entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Entries from here on have no exact whole number in a double and count as not finite.
LARGEST = 2.0 ** 46
#: Partial sums are added up in groups of about the root of their number from this many on.
COLLECTED = 64
#: Singular values below this share of the norm of all rows are zero.
RANK_SHARE, CONVERGED, SEED = 1e-11, 1e-14, 42


@dataclass
class Whitening:
    """Unit components by falling eigenvalue of the covariance of the ``n`` distinct vectors with sums ``sums``."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float

    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """The mean as the nearest whole numbers and what is left of it."""
        nearest = [(2 * s + self.n) // (2 * self.n) for s in self.sums]
        return (np.array(nearest, np.int64),
                np.array([(s - self.n * m) / self.n for s, m in zip(self.sums, nearest)], np.float64))


def whole_vectors(rows: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``id, x`` of rows whose vector and entries are all there and finite, of the width that most of these have."""
    vector = F.col(vector_column).cast("array<double>")
    kept = (rows.select(F.col(id_column).alias("id"), vector.alias("v"))
            .where(F.col("v").isNotNull() & (F.size("v") > 0)
                   & F.forall("v", lambda c: c.isNotNull() & (F.abs(c) < LARGEST))))
    widths = kept.groupBy(F.size("v").alias("width")).count().orderBy(F.desc("count"), "width").first()
    width = widths["width"] if widths else 0
    whole = F.transform("v", lambda c: F.floor(c * SCALE).cast("long") + SHIFT)
    return kept.where(F.size("v") == width).select("id", whole.alias("x"))


def _matrix(column: pa.ListArray) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def packed(vectors: DataFrame) -> DataFrame:
    """``size, rows, data``: the distinct ``x`` as written blocks of whole numbers of the least size that holds them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(0)) - SHIFT
            most = int(np.abs(x).max())
            size = 2 if most < 2 ** 15 else 4 if most < 2 ** 31 else 8
            yield pa.RecordBatch.from_arrays([pa.array([size], pa.int32()), pa.array([len(x)], pa.int32()),
                                              pa.array([x.astype(f"<i{size}").tobytes()], pa.binary())],
                                             ["size", "rows", "data"])

    return materialize(vectors.select("x").distinct().mapInArrow(run, "size int, rows int, data binary"), "whitening")


class Blocks:
    """The packed blocks, and sums over all of them."""

    def __init__(self, table: DataFrame):
        self.table, self.parts = table, table.rdd.getNumPartitions()

    def total(self, measure: Callable[[np.ndarray], np.ndarray]) -> np.ndarray | None:
        """The sum of ``measure(x - SHIFT)`` over all blocks; None where there is no block."""
        def summed(arrays: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
            total = None
            for array in arrays:
                total = array if total is None else total + array
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([str(total.dtype)]), pa.array([total.tobytes()], pa.binary())],
                                                 ["kind", "sums"])

        def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return summed(measure(np.frombuffer(data.as_buffer(), f"<i{size.as_py()}").reshape(rows.as_py(), -1)
                                  .astype(np.int64))
                          for batch in batches for size, rows, data in zip(*batch.columns))

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return summed(np.frombuffer(sums, kind) for batch in batches
                          for kind, sums in zip(*(c.to_pylist() for c in batch.columns)))

        parts = self.table.mapInArrow(measured, "kind string, sums binary")
        if self.parts > COLLECTED:
            parts = parts.repartition(math.isqrt(self.parts)).mapInArrow(added, "kind string, sums binary")
        found = [np.frombuffer(row["sums"], row["kind"]) for row in parts.collect()]
        return sum(found[1:], found[0]) if found else None


def _whole_sums(x: np.ndarray) -> np.ndarray:
    """Row count, then sums of the upper and the lower 24 bits: no sum leaves 64 bits before 10^12 rows."""
    return np.concatenate(([len(x)], (x >> 24).sum(axis=0), (x & 0xFFFFFF).sum(axis=0)))


def _orthogonal(v: np.ndarray, to: list[np.ndarray]) -> np.ndarray:
    if to:
        basis = np.array(to)
        for _ in range(2):
            v = v - basis.T @ (basis @ v)
    return v


def bidiagonalise(blocks: Blocks, centred: Callable[[np.ndarray], np.ndarray], width: int, norm: float,
                  wanted: int) -> np.ndarray:
    """Right singular vectors of the centred rows, those of the ``wanted`` largest values first, as rows.

    Every step adds one right and one left vector, each made orthogonal to all
    before it, and an alpha and a beta of the bidiagonal matrix. It ends after
    ``width`` steps, or when the wanted values have converged and a fresh start
    among the directions not yet seen changes none of them in ``2 * wanted``
    steps (one start meets only one vector of a repeated value).
    """
    random = np.random.default_rng(SEED)
    least = RANK_SHARE * norm

    def fresh() -> np.ndarray:
        v = _orthogonal(random.standard_normal(width), right)
        return v / np.linalg.norm(v)

    right, left, back = [], [], []  # v; w with u = Xw; X'u
    entries: list[tuple[int, int, float]] = []
    v, beta, settled = fresh(), 0.0, None
    while True:
        k = len(right)
        right.append(v)
        if beta:
            entries.append((len(left) - 1, k, beta))
        made, w = np.array(left).reshape(len(left), width), v
        if left:
            def along(x, w=w, made=made):
                a = centred(x)
                return (a @ made.T).T @ (a @ w)
            w = w - made.T @ blocks.total(along)

        def again(x, w=w, made=made):
            a = centred(x)
            p = a @ w
            return np.concatenate(([p @ p], a.T @ p, (a @ made.T).T @ p))
        sums = blocks.total(again)
        square, product, rest = sums[0], sums[1:width + 1], sums[width + 1:]
        alpha = math.sqrt(max(square - rest @ rest, 0.0))
        residual = np.zeros(width)
        if alpha > least:
            w = (w - made.T @ rest) / alpha
            u_back = (product - np.array(back).reshape(len(back), width).T @ rest) / alpha
            entries.append((len(left), k, alpha))
            left.append(w)
            back.append(u_back)
            residual = _orthogonal(u_back - alpha * v, right)
        beta = float(np.linalg.norm(residual))
        b = np.zeros((max(len(left), 1), len(right)))
        for i, j, value in entries:
            b[i, j] = value
        p, s, q = np.linalg.svd(b)
        if len(right) == width:
            break
        if beta <= least:
            beta = 0.0
        if len(s) >= wanted and np.all(beta * np.abs(p[-1, :wanted]) <= CONVERGED * s[0]):
            same = settled is not None and np.allclose(settled[1], s[:wanted], rtol=1e-12, atol=0)
            if same and len(right) >= settled[0] + 2 * wanted:
                break
            if not same:
                settled, beta = (len(right), s[:wanted].copy()), 0.0
        v = residual / beta if beta else fresh()
    return q @ np.array(right)


def fit(rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", wanted: int = 16) -> Whitening:
    """The whitening of the distinct vectors, with up to ``wanted`` components (as many as have an eigenvalue above zero).

    A null vector, one with a null or non-finite entry (2^46 and more included),
    an empty one and one of another width than most have no part in it; repeated
    vectors count once. Without a vector, or with one only, there are no
    components. The written blocks grow with the distinct vectors, what the
    driver holds with the width alone.
    """
    return _fit_whole(whole_vectors(rows, id_column, vector_column), wanted)


def _fit_whole(vectors: DataFrame, wanted: int) -> Whitening:
    blocks = Blocks(packed(vectors))
    counted = blocks.total(_whole_sums)
    if counted is None:
        return Whitening(0, [], np.zeros((0, 0)), np.zeros(0), 0.0, 0.0)
    counted = [int(c) for c in counted]
    n, width = counted[0], (len(counted) - 1) // 2
    model = Whitening(n, [(high << 24) + low for high, low in zip(counted[1:width + 1], counted[width + 1:])],
                      np.zeros((0, width)), np.zeros(0), 0.0, 0.0)
    whole, rest = model.centre()

    def centred(x: np.ndarray) -> np.ndarray:
        return (x - whole).astype(np.float64) - rest

    squares = float(blocks.total(lambda x: np.array([np.square(centred(x)).sum()]))[0])
    model.sums = [s + n * SHIFT for s in model.sums]
    model.trace = squares / n
    if not squares:
        return model
    vectors_ = bidiagonalise(blocks, centred, width, math.sqrt(squares), min(wanted, width))[:wanted]
    vectors_ /= np.linalg.norm(vectors_, axis=1, keepdims=True)

    def moments(x: np.ndarray) -> np.ndarray:
        z = centred(x) @ vectors_.T
        return np.concatenate((z.sum(axis=0), np.square(z).sum(axis=0)))
    first, second = blocks.total(moments).reshape(2, -1)
    values = second / n - np.square(first / n)
    order = np.argsort(-values, kind="stable")
    order = order[values[order] * n > (RANK_SHARE ** 2) * squares]
    found, values, means = vectors_[order], values[order], (first / n)[order]
    signs = np.sign(found[np.arange(len(found)), np.abs(found).argmax(axis=1)])
    model.components, model.eigenvalues = found * signs[:, None], values

    def products(x: np.ndarray) -> np.ndarray:
        z = (centred(x) @ found.T - means) / np.sqrt(values)
        return (z.T @ z).ravel()
    covariance = blocks.total(products).reshape(len(found), -1) / n
    model.identity_error = float(np.abs(covariance - np.eye(len(found))).max())
    return model


def whiten(vectors: DataFrame, model: Whitening) -> DataFrame:
    """``id, deviation, whitened`` per row of ``whole_vectors``: the exact sum of (n*x - S)^2 over the dimensions (null
    where a long can't hold it) and one value per component."""
    schema = T.StructType([vectors.schema["id"], T.StructField("deviation", T.LongType()),
                           T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    if not model.n:
        return vectors.sparkSession.createDataFrame([], schema)
    whole, rest = model.centre()
    left_over = [s - model.n * int(m) for s, m in zip(model.sums, whole)]
    scaled = model.components.T / np.sqrt(model.eigenvalues)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            off = _matrix(batch.column(1)).reshape(batch.num_rows, -1) - whole
            most = max(int(np.abs(off).max(initial=0)), 1) * model.n + model.n
            # Beyond 64 bits by Python's whole numbers.
            exact = off if most * most * max(len(whole), 1) < 2 ** 63 else off.astype(object)
            deviation = np.square(exact * model.n - np.array(left_over, exact.dtype)).sum(axis=1)
            z = (off.astype(np.float64) - rest) @ scaled
            ends = np.arange(batch.num_rows + 1, dtype=np.int32) * z.shape[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([int(v) if v < 2 ** 63 else None for v in deviation.tolist()], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(z.ravel()))], ["id", "deviation", "whitened"])

    return vectors.mapInArrow(run, schema)


def whiten_report(rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
                  wanted: int = 16) -> DataFrame:
    """``id, component, n, deviation, whitened, explained, identity_error`` for every usable row and component.

    Rows left out and edge cases are those of ``fit``; null and repeated ids are
    kept as they are, other columns are ignored, and no usable row gives no rows.
    """
    vectors = whole_vectors(rows, id_column, vector_column)
    model = _fit_whole(vectors, wanted)
    share = [float(e / model.trace) for e in model.eigenvalues]
    found = whiten(vectors, model).select("id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    explained = F.element_at(F.array(*map(F.lit, share)) if share else F.array(F.lit(0.0)), F.col("at") + 1)
    return found.select("id", (F.col("at") + 1).cast("int").alias("component"),
                        F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"),
                        F.lit(model.identity_error).alias("identity_error"))
