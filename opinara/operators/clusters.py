"""K-Means, and cluster tables over sparse long vectors."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opinara.operators import kmeans_starts
from opinara.session import small_table

SEED = 42
KEYWORDS = 10
DECIMALS = 5
# Starts that run side by side on the same vectors.
PARALLEL_STARTS = 4
# Rows of more features stay sparse and are MLlib's, one fit a start.
DENSE_FEATURES = 1_000


def cluster_sizes(assigned: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    return assigned.groupBy(cluster).agg(F.count("*").alias("n_instancias"))


def cluster_centroids(assigned: DataFrame, weights: DataFrame, key: str,
                      cluster: str = "cluster_id") -> DataFrame:
    """``(cluster, term, n_instancias, weight)``: mean weight per cluster, absent terms as 0."""
    sums = (weights.join(assigned.select(key, cluster), key).groupBy(cluster, "term")
            .agg(F.sum("weight").alias("__sum")))
    return (sums.join(cluster_sizes(assigned, cluster), cluster)
            .select(cluster, "term", "n_instancias",
                    (F.col("__sum") / F.col("n_instancias")).alias("weight")))


def cluster_keywords(centroids: DataFrame, top: int = KEYWORDS,
                     cluster: str = "cluster_id") -> DataFrame:
    """The heaviest terms of every cluster, ranked on the exact weight."""
    rank = F.row_number().over(W.partitionBy(cluster).orderBy(F.desc("weight"), "term"))
    return (centroids.withColumn("rank", rank).filter(F.col("rank") <= top)
            .select(cluster, "n_instancias", "rank", F.col("term").alias("palabra"),
                    F.round("weight", DECIMALS).alias("peso_medio")))


def inertia(df: DataFrame, vec: str, cluster: str) -> DataFrame:
    """Sum of squared distances to the own cluster's mean, from per-dimension sums."""
    cells = df.select(cluster, F.posexplode(F.col(vec).cast("array<double>")).alias("dim", "x"))
    spread = (cells.groupBy(cluster, "dim")
              .agg((F.var_pop("x") * F.count("x")).alias("ss")))
    return spread.agg(F.sum("ss").alias("inercia"))


def assign_nearest(df: DataFrame, vec: str, centers: list[list[float]],
                   cluster: str = "cluster_id") -> DataFrame:
    """Add the number of the nearest given center; the first one wins a tie."""
    def squared(center):
        c = F.array(*[F.lit(float(v)) for v in center])
        gaps = F.zip_with(F.col(vec).cast("array<double>"), c, lambda x, y: (x - y) * (x - y))
        return F.aggregate(gaps, F.lit(0.0), lambda acc, g: acc + g)

    staged = df.withColumn("__d", F.array(*[squared(c) for c in centers]))
    return (staged.withColumn(cluster, (F.array_position("__d", F.array_min("__d")) - 1).cast("int"))
            .drop("__d"))


def _starts(vectors: DataFrame, ks: list[int], n_init: int, features: str, max_iter: int, tol: float) -> dict[int, tuple[KMeansModel, float]]:
    """The best of ``n_init`` starts for every k, with its inertia."""
    one = vectors.select(features).first()
    if one is not None and one[features].size <= DENSE_FEATURES:
        blocks = kmeans_starts.pack(vectors, features)
        found = kmeans_starts.fit_starts(blocks, ks, n_init, SEED, max_iter, tol)
        return {k: (kmeans_starts.model_of(blocks, s, features, "cluster_id", max_iter, tol), s.cost) for k, s in found.items()}

    def start(task: tuple[int, int]) -> tuple[KMeansModel, float]:
        model = KMeans(k=task[0], seed=SEED + task[1], featuresCol=features, predictionCol="cluster_id",
                       maxIter=max_iter, tol=tol).fit(vectors)
        return model, model.summary.trainingCost

    with ThreadPoolExecutor(PARALLEL_STARTS) as pool:
        return {k: min(pool.map(start, [(k, i) for i in range(n_init)]), key=lambda found: found[1]) for k in ks}


def kmeans_fit(vectors: DataFrame, k: int, n_init: int = 10, features: str = "features",
               max_iter: int = 300, tol: float = 1e-4) -> tuple[KMeansModel, float]:
    """The best of ``n_init`` seeded starts, with its inertia."""
    return _starts(vectors, [k], n_init, features, max_iter, tol)[k]


def kmeans_elbow(vectors: DataFrame, ks: list[int], n_init: int = 10,
                 features: str = "features") -> tuple[DataFrame, dict[int, KMeansModel]]:
    """``(numero_clusters_k, inercia)`` and the fitted model of every k; all starts of all k share their passes."""
    fits = _starts(vectors, ks, n_init, features, 300, 1e-4)
    rows = [(k, float(cost)) for k, (_, cost) in fits.items()]
    curve = small_table(vectors.sparkSession, rows, "numero_clusters_k int, inercia double")
    return curve, {k: model for k, (model, _) in fits.items()}
