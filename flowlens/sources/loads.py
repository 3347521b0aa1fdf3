"""Which loads of a table by day and load count."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.workspace import exists

#: What the load id of a compaction begins with, and where a table lists its compactions.
COMPACTED = "compacted-"
COMPACTION_LIST = "_compactions"
COMPACTIONS = "day string, load_id string, replaces array<string>"
#: Listed loads that are broadcast; a longer list is joined by a shuffle.
LISTED_LOADS = 200_000


def current_loads(table: DataFrame, path: str) -> DataFrame:
    """The rows of the loads that count: listed compactions, and loads that none replaces.

    A load with a compaction's name that is not listed was not finished and does not
    count. Without any compaction the table stays as it is. The list has a row per
    compaction; it is joined on the partition columns, broadcast if it is short.
    """
    if "load_id" not in table.columns:
        return table
    listed_path = f"{path.rstrip('/')}/{COMPACTION_LIST}"
    spark = table.sparkSession
    unlisted = ~F.col("load_id").startswith(COMPACTED)
    if not exists(spark, listed_path):
        return table.where(unlisted)
    listed = spark.read.schema(COMPACTIONS).parquet(listed_path)
    replaced = listed.select(F.col("day").alias("_day"), F.explode("replaces").alias("_load"))
    known = listed.select(F.col("day").alias("_day"), F.col("load_id").alias("_load"),
                          F.lit(True).alias("_known"))
    few = replaced.count() <= LISTED_LOADS
    same = (F.col("day").cast("string") == F.col("_day")) & (F.col("load_id") == F.col("_load"))
    for rows, how in ((replaced.distinct(), "left_anti"), (known.distinct(), "left")):
        table = table.join(F.broadcast(rows) if few else rows, same, how)
    return table.where(unlisted | F.col("_known")).drop("_day", "_load", "_known")
