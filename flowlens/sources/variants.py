"""Lines as VARIANT: parsed once, with the fields that no schema declares."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.schemas import RAW_SCHEMA
from flowlens.sources.lines import NUMBERS, keep_netflow, once, whole_number


def variant_lines(lines: DataFrame) -> DataFrame:
    """(value, line): the line as VARIANT, null if it is no JSON; one parse a line."""
    return lines.select("value", once(F.try_parse_json("value")).alias("line"))


def variant_events(lines: DataFrame, extra: dict[str, str] | None = None) -> DataFrame:
    """Declared columns as ``parse_events`` gives them, and undeclared fields by name and type.

    An undeclared field that a line lacks, or holds in a form that cannot be read as its
    type, is null. Lines without a ``sensor_type`` of their own, or with an unreadable
    declared number, are no events. A line that names a field twice is no JSON here.
    """
    def text(name: str):
        return F.try_variant_get("line", f"$.{name}", "string").alias(name)

    extra = extra or {}
    rows = variant_lines(lines).where("line IS NOT NULL").select(
        *[text(f.name) for f in RAW_SCHEMA],
        *[F.try_variant_get("line", f"$.{name}", kind).alias(name) for name, kind in extra.items()])
    readable = F.lit(True)
    for name in NUMBERS:
        readable = readable & (F.col(name).isNull() | whole_number(name).isNotNull())
    return rows.where(F.col("sensor_type").isNotNull() & readable).select(
        *[(whole_number(f.name) if f.name in NUMBERS else F.col(f.name)).alias(f.name)
          for f in RAW_SCHEMA], *extra)


def _fields(lines: DataFrame) -> DataFrame:
    """(key, value) of every field of every marked line that is an object."""
    spark = lines.sparkSession
    parsed = variant_lines(keep_netflow(lines)).select("line")
    return parsed.lateralJoin(spark.tvf.variant_explode(F.col("line").outer())).where(
        "key IS NOT NULL").select("key", "value")


def _declared():
    return F.col("field").isin(*RAW_SCHEMA.names)


def field_types(lines: DataFrame) -> DataFrame:
    """(field, type, n_lines, declared): one row per field, with the type that fits all its values.

    VARIANT stands for values that share none. Types and counts are combined in every task,
    so what is shuffled is one row per field and task.
    """
    return (_fields(lines).groupBy(F.col("key").alias("field"))
            .agg(F.schema_of_variant_agg("value").alias("type"),
                 F.count(F.lit(1)).alias("n_lines"))
            .withColumn("declared", _declared()))


def field_values(lines: DataFrame) -> DataFrame:
    """(field, type, n_lines, declared): one row per field and type of value that occurs.

    Decimals count as one type whatever their digits.
    """
    kind = F.regexp_replace(F.schema_of_variant("value"), r"^DECIMAL\(.*\)$", "DECIMAL")
    return (_fields(lines).groupBy(F.col("key").alias("field"), kind.alias("type"))
            .agg(F.count(F.lit(1)).alias("n_lines")).withColumn("declared", _declared()))
