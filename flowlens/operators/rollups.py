"""Connection features of longer buckets or fewer keys, from stored ones."""

from collections.abc import Iterable
from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.operators.connections import PORT_SKETCHES, SKETCHES, check_bucket, segment_text
from flowlens.schemas import FEATURES

PAIR = ("src_ip", "dst_ip")


def relative_error(lg_k: int) -> float:
    """Standard error of a merged sketch's estimate, as a share of the true count."""
    return 1.04 / sqrt(1 << lg_k)


def within(estimate: Column, count: Column, lg_k: int, sigmas: float = 3.0) -> Column:
    """Whether an estimate lies within so many standard errors of the count, or half a port."""
    return F.abs(estimate - count) <= F.greatest(
        F.lit(0.5), count * (sigmas * relative_error(lg_k)))


def rollup(table: DataFrame, bucket_seconds: int | None = 86400,
           keys: Iterable[str] = PAIR) -> DataFrame:
    """Sum features over longer buckets and, with fewer ``keys``, over addresses.

    ``table`` comes from ``connection_features`` with ``lg_k``, or from here. Eighteen
    counters are sums and stay exact. Distinct ports of several buckets cannot be summed;
    ``n_src_port`` and ``n_dst_port`` are estimates of the united sketches (exact up to some
    hundred ports for lg_k = 12, then within ``relative_error``), and the united sketches
    come along, so a result can be rolled up again. No event is read.

    A bucket must be a multiple of the stored one. ``bucket_seconds=None`` makes one row
    per key over all time. Sums and sketches are combined in every task before the
    shuffle, so a pair with most of the rows arrives as one row per task. Rows without a
    day keep a bucket of their own. No rows: no rows.
    """
    keys = list(keys)
    group = list(keys)
    if bucket_seconds is not None:
        check_bucket(bucket_seconds)
        second = ("CAST(substr(tsegm_inittime, 1, 2) AS INT) * 3600"
                  " + CAST(substr(tsegm_inittime, 4, 2) AS INT) * 60")
        table = table.withColumn("slot", F.expr(f"CAST(({second}) DIV {bucket_seconds} AS INT)"))
        group += ["day", "slot"]
    united = table.groupBy(*group).agg(
        *[F.sum(c).alias(c) for c in FEATURES if c not in PORT_SKETCHES],
        *[F.hll_union_agg(c).alias(c) for c in SKETCHES])
    united = united.withColumns({
        count: F.hll_sketch_estimate(sketch) for count, sketch in PORT_SKETCHES.items()})
    names = list(keys)
    if bucket_seconds is not None:
        united = united.withColumns({"tsegm_inittime": segment_text("slot", bucket_seconds),
                                     "week_day": F.date_format("day", "E")})
        names += ["day", "tsegm_inittime", "week_day"]
    return united.select(*names, *FEATURES, *SKETCHES)
