"""Small helpers shared by the text operators."""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.sinks.tables import write_table
from flowlens.workspace import work_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written below the shared work folder and read back.

    Cuts the lineage: what comes after a lost executor starts from these files.
    """
    return write_table(rows, work_path(rows.sparkSession, name))


def unused(name: str, table: DataFrame) -> str:
    """``name``, lengthened until no column of ``table`` is called so."""
    taken = {c.lower() for c in table.columns}
    while name.lower() in taken:
        name += "_"
    return name


def utf8(texts: pa.Array) -> list[bytes | None]:
    """The texts as bytes, without decoding them."""
    large = pa.types.is_large_string(texts.type)
    return texts.cast(pa.large_binary() if large else pa.binary()).to_pylist()


def sliced(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, for work that holds Python objects for each."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def once(function, column: Column) -> Column:
    """Apply an Arrow function so that Spark never evaluates it twice for a row."""
    return function.asNondeterministic()(column)


def hex64(value: Column) -> Column:
    """16 lower-case hex digits of a bigint read as unsigned."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))
