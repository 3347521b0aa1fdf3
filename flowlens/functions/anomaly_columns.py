"""Columns of an anomaly record."""

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Give another text where stored anomalies have one.
EVENT_TYPE = "CONNECTION_ANOMALY"
# The exclusive upper limits of the synthetic numbers.
PORT_LIMIT = 91234
PROTOCOL_LIMIT = 25


def vector_text(vector: Column) -> Column:
    """``[1.0,2.0,...]``."""
    return F.concat(F.lit("["), F.array_join(vector.cast("array<string>"), ","), F.lit("]"))


def timestamp_text() -> Column:
    return F.concat_ws(" ", F.col("day").cast("string"), F.col("tsegm_inittime"))


def is_anomaly() -> Column:
    """Strictly outside the boundary; false where the cluster has no boundary."""
    return F.coalesce(F.col("distance") > F.col("boundary"), F.lit(False))


def probability() -> Column:
    return 1 - F.col("boundary") / F.col("distance")


def record_id() -> Column:
    """Same row, same id, also when a task or batch runs again.

    ``features`` takes part, because late events can yield a second row for a pair and
    bucket.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(""))
             for c in ("src_ip", "dst_ip", "timestamp", "prediction", "features")]
    return F.md5(F.concat_ws("|", *parts))


def synthetic_number(first_digit: int, limit: int) -> Column:
    """Eight hex digits of ``id`` as a number below the limit; carries no measurement."""
    digits = F.substring("id", first_digit, 8)
    return (F.conv(digits, 16, 10).cast("bigint") % limit).cast("int")
