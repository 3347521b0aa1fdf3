"""Facts about a fit from a random start that hold for every start, from its rows."""

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.operators.sweep import centers_of, scan


def fit_facts(scored: DataFrame, k: int, training_cost: float) -> DataFrame:
    """One row about rows with normalizedFeatures, prediction, distance and ``other``.

    ``other`` is the cluster that another implementation gives. The total sum of squares is
    the cost of one cluster at the mean, which standardized rows have at zero.
    """
    squares = F.aggregate("normalizedFeatures", F.lit(0.0), lambda s, v: s + v * v)
    facts = scored.agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(squares).alias("total"),
        F.sum(F.col("distance") * F.col("distance")).alias("cost"),
        F.bool_and(F.col("prediction") == F.col("other")).alias("all_nearest"))
    return facts.select(
        F.lit(k).alias("k"), "n_rows", F.round("total", 3).alias("total_squares"), "all_nearest",
        (F.col("cost") < F.col("total")).alias("cost_below_total"),
        (F.col("cost") <= training_cost * (1 + 1e-9)).alias("cost_at_most_training"))


def rank_facts(flagged: DataFrame, percentile: int) -> DataFrame:
    """One row about rows with prediction, distance and boundary.

    ``ranks_hold``: in every cluster the rows above the boundary are as many as its rank
    implies, up to rows equal to it.
    """
    n, share = F.col("n"), F.lit(percentile / 100)
    implied = n - 1 - F.floor((n - 1) * share)
    clusters = flagged.groupBy("prediction").agg(
        F.count("distance").alias("n"),
        F.count_if(F.col("distance") > F.col("boundary")).alias("above"),
        F.count_if(F.col("distance") >= F.col("boundary")).alias("from_it"))
    return clusters.agg(
        F.count(F.lit(1)).cast("int").alias("k"), F.sum("n").alias("n_rows"),
        F.bool_and((F.col("above") <= implied) & (implied <= F.col("from_it"))).alias("ranks_hold"))


def elbow_facts(clusters: DataFrame, table: DataFrame, column: str = "features") -> DataFrame:
    """One row per k of a stored sweep, from a second pass of the rows over its centres.

    ``n_rows`` have a nearest centre; ``cost_holds``: the stored costs are those of the
    centres; ``below_one``: their sum is below the cost of one cluster, from the data.
    """
    width = len(table.select(column).first()[0])
    row = table.agg(*[F.var_pop(F.col(column)[i]) for i in range(width)], F.count(F.lit(1))).first()
    one = math.fsum(row[:-1]) * row[-1]
    again = [(k, int(m.n.sum()), float(m.cost.sum()))
             for k, m in scan(table, centers_of(clusters), column).items()]
    found = table.sparkSession.createDataFrame(again, "k int, n_rows bigint, again double")
    stored = clusters.groupBy("k").agg(F.sum("cost").alias("cost"))
    return stored.join(found, "k").select(
        "k", "n_rows", (F.col("again") < one).alias("below_one"),
        (F.abs(F.col("cost") - F.col("again")) <= 1e-9 * one).alias("cost_holds"))
