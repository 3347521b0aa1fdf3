"""Centroid clustering: fit, assignment, cost and the sweep over cluster counts."""

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.functions.nearest import nearest_center
from flowlens.operators.sweep import SEED, Sweep, elbow_sweep, shared_sweep
from flowlens.schemas import KEYS


@dataclass(frozen=True)
class Clusters:
    """Centres by id, the training cost and, for a fit by Spark ML, its model."""

    centers: list[list[float]]
    cost: float | None = None
    model: KMeansModel | None = None


def centers_table(spark: SparkSession, centers: list[list[float]]) -> DataFrame:
    return spark.createDataFrame(
        [(i, [float(v) for v in c]) for i, c in enumerate(centers)],
        "prediction int, center array<double>")


def centers_from_table(table: DataFrame) -> list[list[float]]:
    rows = table.orderBy("prediction").collect()
    if [r["prediction"] for r in rows] != list(range(len(rows))):
        raise ValueError("centre ids must run from 0 without gaps")
    return [list(r["center"]) for r in rows]


def fit_clusters(table: DataFrame, k: int, column: str = "normalizedFeatures",
                 seed: int = SEED, max_iter: int = 100, init_steps: int = 5) -> Clusters:
    """Centroid clustering by Spark ML; may return fewer centres when there are fewer distinct rows.

    Give it a stored table rather than a cached one: Spark ML then keeps its own vectors
    and norms in memory (spilling to disk) for the iterations, and an executor lost on the
    way costs a re-read of its files, not the whole preparation.
    """
    return _fit(_vectors(table, column), k, seed, max_iter, init_steps)


def _vectors(table: DataFrame, column: str) -> DataFrame:
    return table.select(array_to_vector(F.col(column)).alias("vector"))


def _fit(vectors: DataFrame, k: int, seed: int, max_iter: int, init_steps: int) -> Clusters:
    model = KMeans(featuresCol="vector", k=k, seed=seed, maxIter=max_iter,
                   initSteps=init_steps).fit(vectors)
    centers = [[float(v) for v in c] for c in model.clusterCenters()]
    return Clusters(centers, model.summary.trainingCost, model)


def load_ml_centers(path: str) -> list[list[float]]:
    """Centres of a saved Spark ML model."""
    return [[float(v) for v in c] for c in KMeansModel.load(path).clusterCenters()]


def assign(table: DataFrame, centers: list[list[float]],
           column: str = "normalizedFeatures") -> DataFrame:
    """Add ``prediction`` and ``distance``; a narrow step, no shuffle."""
    found = table.withColumn("_nearest", nearest_center(F.col(column), centers))
    return found.select(*table.columns, "_nearest.prediction", "_nearest.distance")


def first_centers(table: DataFrame, k: int,
                  column: str = "normalizedFeatures") -> list[list[float]]:
    """The vectors of the first k rows in key order (a top-k per task, then a merge)."""
    keys = [c for c in KEYS if c in table.columns]
    return [list(r[0]) for r in
            table.orderBy(*keys).select(column, *keys).limit(k).collect()]


def refine_centers(table: DataFrame, centers: list[list[float]], steps: int,
                   column: str = "normalizedFeatures") -> list[list[float]]:
    """A fixed number of assign-and-average steps from given centres.

    Sums are combined in every task before the shuffle, so a step moves k rows per task
    however uneven the clusters are. A centre without rows stays where it is.
    """
    for _ in range(steps):
        width = len(centers[0])
        means = (assign(table.select(column), centers, column)
                 .groupBy("prediction")
                 .agg(*[F.expr(f"avg({column}[{i}]) AS c{i}") for i in range(width)]))
        moved = {r["prediction"]: [r[f"c{i}"] for i in range(width)] for r in means.collect()}
        centers = [moved.get(i, c) for i, c in enumerate(centers)]
    return centers


def clustering_cost(assigned: DataFrame) -> DataFrame:
    """Sum of squared distances to the nearest centre."""
    return assigned.agg(F.sum(F.col("distance") * F.col("distance")).alias("cost"))


def elbow_curve(table: DataFrame, ks: Iterable[int] = range(2, 61),
                column: str = "features", seed: int = SEED, max_iter: int = 20,
                init_steps: int = 5, parallelism: int = 4, method: str = "shared") -> DataFrame:
    """Cost per number of clusters, as rows (k, cost).

    The default column holds the raw counters; pass ``normalizedFeatures`` for a curve on
    the scale that training uses. ``shared`` moves the centres of all counts in the same
    scans (``elbow_sweep``). ``each`` is one fit by Spark ML a count, ``parallelism`` of
    them at a time over one persisted copy of the vectors; it reads the rows up to
    ``max_iter`` times a count.
    """
    ks = list(ks)
    if method == "shared":
        return elbow_sweep(table, ks, column, seed, max_iter).points(table.sparkSession)
    if method != "each":
        raise ValueError("method must be 'shared' or 'each'")
    vectors = _vectors(table, column).persist(StorageLevel.MEMORY_AND_DISK)

    @inheritable_thread_target(table.sparkSession)
    def cost(k: int) -> float:
        return _fit(vectors, k, seed, max_iter, init_steps).cost

    try:
        with ThreadPoolExecutor(max(1, parallelism)) as pool:
            costs = list(pool.map(cost, ks))
    finally:
        vectors.unpersist()
    return table.sparkSession.createDataFrame(list(zip(ks, costs)), "k int, cost double")


def pinned_sweep(table: DataFrame, ks: Iterable[int], steps: int,
                 column: str = "normalizedFeatures") -> Sweep:
    """The sweep from the first rows in key order, for repeatable results."""
    ks = list(ks)
    start = first_centers(table, max(ks), column)
    return shared_sweep(table, {k: start[:k] for k in ks}, steps, column, tolerance=None)


def elbow_curve_pinned(table: DataFrame, ks: Iterable[int], steps: int,
                       column: str = "normalizedFeatures") -> DataFrame:
    """The curve of ``pinned_sweep``, as rows (k, cost)."""
    return pinned_sweep(table, ks, steps, column).points(table.sparkSession)
