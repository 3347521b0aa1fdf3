"""Distance percentile per cluster."""

import math
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Quantiles that a round takes of an interval, and their accuracy.
BINS, ACCURACY = 200, 10_000
MAX_CLUSTERS = 10_000


def check_percentile(percentile: int) -> None:
    if not 1 <= percentile <= 99:
        raise ValueError("percentile must be from 1 to 99")


def cluster_boundaries(scored: DataFrame, percentile: int, method: str = "exact",
                       accuracy: int = 10_000, bins: int = BINS) -> DataFrame:
    """(prediction, boundary) from rows with ``prediction`` and ``distance``.

    ``exact`` interpolates between the two neighbouring distances. Spark's ``percentile``
    holds every distinct value of a group in one task; here the wanted ranks are closed in
    on, round by round, the same way for clusters of any size. ``approx`` is one pass with
    a sketch of bounded size. Null distances do not count; a cluster without any other has
    no row.
    """
    check_percentile(percentile)
    share = percentile / 100
    pairs = scored.select("prediction", "distance").where("distance IS NOT NULL")
    if method == "approx":
        return pairs.groupBy("prediction").agg(
            F.percentile_approx("distance", share, accuracy).alias("boundary"))
    if method != "exact":
        raise ValueError("method must be 'exact' or 'approx'")

    pairs = pairs.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sizes = pairs.groupBy("prediction").agg(
            F.count("distance").alias("n"), F.min("distance").alias("low"),
            F.max("distance").alias("high")).limit(MAX_CLUSTERS + 1).collect()
        if len(sizes) > MAX_CLUSTERS:
            raise ValueError(f"more than {MAX_CLUSTERS} clusters; is prediction a cluster id?")
        found = _select_ranks(pairs, sizes, share, bins)
    finally:
        pairs.unpersist()
    return scored.sparkSession.createDataFrame(found, "prediction int, boundary double")


@dataclass
class _Target:
    """One wanted rank of one cluster, counted inside the interval [low, high]."""

    prediction: int
    rank: int
    low: float
    high: float
    n: int


def _select_ranks(pairs: DataFrame, sizes: list, share: float,
                  bins: int) -> list[tuple[int, float]]:
    """Exact values at the two ranks around each cluster's percentile.

    A round cuts each interval around the wanted rank (see ``_narrow``) and goes on with
    the part that holds it, until its smallest and largest value are one. A round leaves
    about 3 / bins of the rows, or a single repeated value.
    """
    active, position, values = {}, {}, {}
    for r in sizes:
        position[r["prediction"]] = at = (r["n"] - 1) * share
        for rank in {math.floor(at), math.ceil(at)}:
            active[r["prediction"], rank] = _Target(r["prediction"], rank, r["low"], r["high"], r["n"])
    while active:
        values |= {key: t.low for key, t in active.items() if t.low == t.high}
        active = {key: t for key, t in active.items() if t.low != t.high}
        if active:
            active = _narrow(pairs, active, bins)

    result = []
    for prediction, at in position.items():
        lower = values[prediction, math.floor(at)]
        upper = values[prediction, math.ceil(at)]
        result.append((prediction, lower + (upper - lower) * (at - math.floor(at))))
    return result


INTERVAL = ["prediction", "low", "high"]


def _at(pairs: DataFrame, intervals: DataFrame) -> DataFrame:
    """Rows inside the intervals, at most two per cluster."""
    return pairs.join(F.broadcast(intervals), "prediction").where(
        F.col("distance").between(F.col("low"), F.col("high")))


def _edges(pairs: DataFrame, targets: dict, bins: int) -> DataFrame:
    """(interval, edges): approximate quantiles on either side of the wanted ranks."""
    spark = pairs.sparkSession
    wanted = sorted({(t.prediction, t.low, t.high) for t in targets.values()})
    intervals = spark.createDataFrame(wanted, "prediction int, low double, high double")
    shares = [i / bins for i in range(bins + 1)]
    sketches = {tuple(r[:3]): r[3] for r in _at(pairs, intervals).groupBy(*INTERVAL).agg(
        F.percentile_approx("distance", shares, ACCURACY)).collect()}
    chosen: dict[tuple, set] = {}
    for t in targets.values():
        key = (t.prediction, t.low, t.high)
        at = t.rank * bins // max(1, t.n - 1)
        chosen.setdefault(key, set()).update(sketches[key][max(0, at - 1):at + 3])
    return spark.createDataFrame([(*key, sorted(edges)) for key, edges in chosen.items()],
                                 "prediction int, low double, high double, edges array<double>")


def _narrow(pairs: DataFrame, targets: dict, bins: int) -> dict:
    """The part of each target's interval that holds its rank.

    Up to four edges cut an interval around a rank. Each edge is a part of its own, and so
    are the values between, below and above: a value that many rows share is an edge and
    ends the search. Counts are combined in every task.
    """
    placed = _at(pairs, _edges(pairs, targets, bins)).withColumn(
        "part", F.size(F.filter("edges", lambda e: e < F.col("distance"))) * 2
        + F.array_contains("edges", F.col("distance")).cast("int"))
    counts = placed.groupBy(*INTERVAL, "part").agg(
        F.count(F.lit(1)).alias("n"), F.min("distance").alias("part_low"),
        F.max("distance").alias("part_high"))
    before = (Window.partitionBy(*INTERVAL).orderBy("part_low")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    wanted = pairs.sparkSession.createDataFrame(
        [(t.prediction, t.low, t.high, t.rank, k[1]) for k, t in targets.items()],
        "prediction int, low double, high double, rank long, target long")
    found = (counts.withColumn("upto", F.sum("n").over(before))
             .join(F.broadcast(wanted), INTERVAL)
             .where((F.col("rank") < F.col("upto"))
                    & (F.col("rank") >= F.col("upto") - F.col("n")))
             .collect())
    return {(r["prediction"], r["target"]): _Target(
        r["prediction"], r["rank"] - (r["upto"] - r["n"]), r["part_low"], r["part_high"], r["n"])
        for r in found}
