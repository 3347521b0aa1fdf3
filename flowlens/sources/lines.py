"""Flow events as text lines: message queue, files, prefilter and JSON parsing."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.schemas import RAW_SCHEMA

# Fixed value: the text that marks a flow line.
NETFLOW_MARK = '"sensor_type":"netflow"'

BROKEN = "_broken"
#: All fields as text, whatever JSON type they have, and the line itself if it is no JSON.
TEXT_SCHEMA = T.StructType(
    [T.StructField(f.name, T.StringType()) for f in [*RAW_SCHEMA, T.StructField(BROKEN, T.StringType())]])
NUMBERS = [f.name for f in RAW_SCHEMA if isinstance(f.dataType, T.LongType)]


def kafka_options(brokers: str, topics: str, starting_offsets: str = "latest",
                  max_offsets_per_trigger: int | None = None) -> dict[str, str]:
    """Reader options for a comma-separated topic list."""
    names = [t.strip() for t in topics.split(",") if t.strip()]
    if not names:
        raise ValueError("no topic given")
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": ",".join(dict.fromkeys(names)),
        "startingOffsets": starting_offsets,
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def kafka_lines(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Stream of message values (needs the Spark Kafka package on the class path)."""
    stream = spark.readStream.format("kafka").options(**options).load()
    return stream.select(F.col("value").cast("string").alias("value"))


def file_lines(spark: SparkSession, path: str, stream: bool = False,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Text lines from files, at rest or as a stream over arriving files."""
    if not stream:
        return spark.read.text(path)
    reader = spark.readStream
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)


def keep_netflow(lines: DataFrame) -> DataFrame:
    """Drop other sensors' lines by substring, before any JSON is parsed."""
    return lines.where(F.col("value").contains(NETFLOW_MARK))


def whole_number(name: str) -> Column:
    """A number given as JSON number or text, with or without a zero fraction.

    Nearly all are plain digits; only the others are read as decimals, which is far slower.
    """
    decimal = f"try_cast({name} AS DECIMAL(38, 10))"
    return F.expr(f"CASE WHEN {name} IS NOT NULL THEN coalesce(try_cast({name} AS BIGINT),"
                  f" CASE WHEN {decimal} % 1 = 0 THEN try_cast({decimal} AS BIGINT) END) END")


def unreadable() -> Column:
    """Why a parsed line is no event: null, 'line' (no JSON), or the field's name."""
    reason = F.when(F.col(BROKEN).isNotNull(), "line")
    for name in NUMBERS:
        reason = reason.when(F.col(name).isNotNull() & whole_number(name).isNull(), name)
    return reason


def once(value: Column) -> Column:
    """A column that Spark computes once a row, however often it is used afterwards.

    A filter on fields of a parsed line would otherwise be moved below the parsing, with
    a parse of its own for every field. No filter is moved below a generator's output.
    """
    return F.explode(F.array(value))


def parsed(lines: DataFrame) -> DataFrame:
    options = {"columnNameOfCorruptRecord": BROKEN}
    return lines.select("value", once(F.from_json("value", TEXT_SCHEMA, options)).alias("event"))


def parse_events(lines: DataFrame, strict: bool = False) -> DataFrame:
    """Lines to columns; absent fields are null. Each line is parsed once.

    Numbers may stand as text or with a zero fraction. A line that is no JSON, or with a
    number that cannot be read, is no event; ``rejected_lines`` gives those. The substring
    test also passes lines that only quote the mark; ``strict`` keeps the lines whose
    parsed ``sensor_type`` is ``netflow``.
    """
    events = parsed(lines).select("event.*").where(unreadable().isNull())
    events = events.select(*[(whole_number(f.name) if f.name in NUMBERS else F.col(f.name))
                             .alias(f.name) for f in RAW_SCHEMA])
    return events.where(F.col("sensor_type") == "netflow") if strict else events


def netflow_events(lines: DataFrame, strict: bool = False) -> DataFrame:
    return parse_events(keep_netflow(lines), strict)


def rejected_lines(lines: DataFrame) -> DataFrame:
    """(value, reason) of the marked lines that ``netflow_events`` leaves out as unreadable."""
    rows = parsed(keep_netflow(lines)).select("value", "event.*")
    return rows.select("value", unreadable().alias("reason")).where("reason IS NOT NULL")
