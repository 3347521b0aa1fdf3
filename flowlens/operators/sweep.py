"""The sweep over cluster counts with one scan of the rows for all counts at a time."""

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.functions.nearest import closest, squared_distance, vectors_of

SEED = 1234
#: Candidate starts of each round, as a multiple of the greatest count, and the rounds.
OVERSAMPLE, ROUNDS = 2, 5
Centers = dict[int, np.ndarray]


@dataclass(frozen=True)
class Moments:
    """Of every centre: rows, sum of their vectors, sum of their squared distances."""

    n: np.ndarray
    sums: np.ndarray
    cost: np.ndarray


@dataclass(frozen=True)
class Sweep:
    """Centres by number of clusters, their moments, and the scans that it took."""

    centers: Centers
    moments: dict[int, Moments]
    scans: int

    def points(self, spark: SparkSession) -> DataFrame:
        """(k, cost)."""
        rows = [(k, float(m.cost.sum())) for k, m in sorted(self.moments.items())]
        return spark.createDataFrame(rows, "k int, cost double")

    def clusters(self, spark: SparkSession) -> DataFrame:
        """(k, prediction, n_rows, cost, center) of every centre of every k."""
        rows = [(k, i, int(m.n[i]), float(m.cost[i]), self.centers[k][i].tolist())
                for k, m in sorted(self.moments.items()) for i in range(len(m.n))]
        return spark.createDataFrame(
            rows, "k int, prediction int, n_rows bigint, cost double, center array<double>")


def centers_of(clusters: DataFrame) -> Centers:
    """The centres of a stored ``Sweep.clusters`` table."""
    rows = clusters.select("k", "prediction", "center").orderBy("k", "prediction").collect()
    return {k: np.array([r["center"] for r in rows if r["k"] == k])
            for k in {r["k"] for r in rows}}


def scan(table: DataFrame, centers: Centers, column: str) -> dict[int, Moments]:
    """Moments of all centres of all counts, in one pass.

    A task adds up what its batches give and returns one row per centre, whatever its
    rows; those are added by a grouped sum. What reaches the driver is one row per centre,
    1,829 for the counts 2 to 60. Equal distances go to the lowest id; vectors with a NaN
    count nowhere.
    """
    width = next(iter(centers.values())).shape[1]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {k: np.zeros((len(c), width + 2)) for k, c in centers.items()}
        for batch in batches:
            points = vectors_of(batch.column(0), width)
            points = points[~np.isnan(points).any(axis=1)]
            for k, own in centers.items():
                label, squared = closest(points, own)
                parts = [np.ones(len(points)), squared, *points.T]
                for i, part in enumerate(parts):
                    total[k][:, i] += np.bincount(label, part, len(own))
        sums = np.concatenate(list(total.values()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(sums)), pa.int32()),
             pa.ListArray.from_arrays(np.arange(len(sums) + 1) * (width + 2), sums.ravel())],
            names=["place", "sums"])

    rows = table.select(column).mapInArrow(partial, "place int, sums array<double>")
    found = rows.groupBy("place").agg(F.array(
        *[F.sum(F.col("sums")[i]) for i in range(width + 2)]).alias("sums")).toArrow()
    sums = np.zeros((sum(map(len, centers.values())), width + 2))
    sums[found["place"].to_numpy()] = found["sums"].combine_chunks().flatten().to_numpy(
        ).reshape(-1, width + 2)
    moments, at = {}, 0
    for k, own in centers.items():
        part = sums[at:at + len(own)]
        moments[k] = Moments(part[:, 0].astype(np.int64), part[:, 2:], part[:, 1])
        at += len(own)
    return moments


def shared_sweep(table: DataFrame, starts: Centers, steps: int = 20,
                 column: str = "features", tolerance: float | None = 1e-4) -> Sweep:
    """Assign-and-average steps of all counts together, from given starts.

    One scan moves the centres of every count; a count whose centres all move by at most
    ``tolerance`` is left out of the later ones. With ``tolerance=None`` every count takes
    all ``steps``. A last scan gives the moments of the final centres. A centre without
    rows stays where it is. Fitting each count by itself reads the rows once a count and
    step.
    """
    centers = {k: np.asarray(c, np.float64) for k, c in starts.items()}
    moving, scans = dict(centers), 0
    for _ in range(steps):
        if not moving:
            break
        scans += 1
        for k, m in scan(table, moving, column).items():
            old, some = centers[k], m.n > 0
            new = old.copy()
            new[some] = m.sums[some] / m.n[some, None]
            centers[k] = moving[k] = new
            if tolerance is not None and ((new - old) ** 2).sum(axis=1).max() <= tolerance ** 2:
                del moving[k]
    return Sweep(centers, scan(table, centers, column), scans + 1)


def parallel_starts(table: DataFrame, ks: Iterable[int], column: str = "features",
                    seed: int = SEED, rounds: int = ROUNDS) -> Centers:
    """Starts for every count from one set of candidates, drawn as parallel k-means does.

    Each round draws rows with a chance proportional to the squared distance to the
    candidates so far: those with the smallest exponential times over that weight, a top-k
    per task. Two rows a round for each of the largest count's centres, so the set is
    bounded by the counts, not by the data. A scan weighs the candidates by the rows
    nearest to them, and each count's start is a weighted k-means of the candidates. With
    fewer distinct rows than a count, it gets fewer centres.
    """
    ks = list(ks)
    first = table.select(column).where(
        f"{column} IS NOT NULL AND NOT exists({column}, v -> isnan(v))").orderBy(
            F.rand(seed)).limit(1).collect()
    if not first:
        raise ValueError("cannot cluster an empty table")
    candidates = np.array([first[0][0]], np.float64)
    for i in range(rounds):
        weight = squared_distance(F.col(column), candidates)
        drawn = (table.select(column, weight.alias("weight")).where("weight > 0")
                 .orderBy(-F.log(1 - F.rand(seed + 1 + i)) / F.col("weight"))
                 .limit(OVERSAMPLE * max(ks)).collect())
        if not drawn:
            break
        candidates = np.unique(np.concatenate(
            [candidates, [r[column] for r in drawn]]), axis=0)
    weights = scan(table, {0: candidates}, column)[0].n
    random = np.random.default_rng(seed)
    return {k: weighted_means(candidates, weights, k, random) for k in ks}


def weighted_means(points: np.ndarray, weights: np.ndarray, k: int, random: np.random.Generator,
                   steps: int = 30) -> np.ndarray:
    """At most k centres of a few weighted points: spread starts, then means."""
    chosen = [int(random.choice(len(points), p=weights / weights.sum()))]
    near = ((points - points[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < k and (near * weights).sum() > 0:
        chance = near * weights
        chosen.append(int(random.choice(len(points), p=chance / chance.sum())))
        near = np.minimum(near, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    centers = points[chosen]
    for _ in range(steps):
        label, _ = closest(points, centers)
        size = np.bincount(label, weights, len(centers))
        sums = np.stack([np.bincount(label, weights * d, len(centers)) for d in points.T], axis=1)
        new = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centers)
        if (new == centers).all():
            break
        centers = new
    return centers


def elbow_sweep(table: DataFrame, ks: Iterable[int] = range(2, 61), column: str = "features",
                seed: int = SEED, max_iter: int = 20) -> Sweep:
    """Starts and steps over one persisted copy of the vectors.

    About 27 scans for any number of counts. The copy is in memory or on disk; partitions lost
    with an executor are read again from the table, which should be a stored one.
    """
    vectors = table.select(column).where(F.col(column).isNotNull()).persist(
        StorageLevel.MEMORY_AND_DISK)
    try:
        return shared_sweep(vectors, parallel_starts(vectors, ks, column, seed), max_iter, column)
    finally:
        vectors.unpersist()
