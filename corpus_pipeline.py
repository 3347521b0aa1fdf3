"""From raw documents to packed training sequences, in stages that are stored between.

All stages take nulls in any column, empty and very long texts, repeated rows, an empty
table and further columns, whatever their names; each says below what they give. No stage
reads more than ``doc_id`` and ``text``, and all but the last hand on every column of the
rows that they keep.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from flowlens.llm.decontamination import drop_contaminated
from flowlens.llm.packing import pack
from flowlens.llm.pii import TEST_KEY, pseudonymize_rows
from flowlens.llm.quality import keep_good
from flowlens.llm.queries import TOKENIZER, with_crc
from flowlens.llm.simhash import keep_one_each
from flowlens.llm.texts import stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the compression bands.

    Rows are judged one by one: repeated rows stay or go together. Null and empty texts have
    under 50 words and go. No rows: no rows.
    """
    return keep_good(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies.

    That with the smallest doc_id stays; of rows with the same id and fingerprint one. A
    null doc_id gives way to any other. Null and empty texts are copies of each other. No
    rows: no rows.
    """
    return keep_one_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark.

    Null and empty texts have none and stay; repeated rows stay or go together. Benchmark
    rows without an id count. An empty benchmark drops nothing. No rows: no rows.
    """
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pseudonym_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by pseudonyms.

    A null text stays null and an empty one empty; repeated rows stay alike. No rows: no
    rows.
    """
    return pseudonymize_rows(docs, TEST_KEY)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences.

    A null or empty text is one id, the end of a document. Repeated rows are packed each; a
    null doc_id stays null. A very long text is cut into several pieces. No rows: no rows.
    """
    return with_crc(pack(docs, TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("pseudonyms", pseudonym_stage),
    ("packing", packing_stage),
]

#: Compression, tokenization and SimHash components have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
