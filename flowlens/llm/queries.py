"""Registered queries: each operator over its whole table, with production settings."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.llm.decontamination import contamination
from flowlens.llm.factorization import classify, fit as fit_machine
from flowlens.llm.fill_middle import fill_in_middle, restored
from flowlens.llm.html_text import main_texts
from flowlens.llm.language import fit, identify_rows
from flowlens.llm.packing import pack
from flowlens.llm.periodic import periodic_runs
from flowlens.llm.pii import TEST_KEY, pseudonymize_rows
from flowlens.llm.quality import quality_rows
from flowlens.llm.simhash import near_duplicates
from flowlens.llm.substrings import repeated_spans
from flowlens.llm.texts import hex64, stored, table
from flowlens.llm.url_fixture import SPARK, captures_sql, feed_sql
from flowlens.llm.url_lists import filter_urls, host_of, path_of
from flowlens.llm.warc import read_archive, write_archive
from flowlens.workspace import work_path

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every place of every repeated passage."""
    return repeated_spans(table(spark, sf_dir, "documents"))


def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = spark.sql(captures_sql("{pages}"), pages=pages)
    host = host_of(F.col("url"))
    segment = F.element_at(F.filter(F.split(path_of(F.col("url")), "/"), lambda x: x != ""), 1)
    names = stored(pages.select(
        host.alias("host"), F.substring_index(host, ".", -2).alias("domain"),
        F.concat(host, F.lit("/"), segment).alias("path")).distinct(), "names")
    feed = stored(spark.sql(feed_sql("{names}", SPARK), names=names), "feed")
    return filter_urls(captures, feed)


def pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its pseudonymized text."""
    return pseudonymize_rows(table(spark, sf_dir, "documents").select("doc_id", "text"),
                             TEST_KEY)


def warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "warc")
    write_archive(table(spark, sf_dir, "pages"), path)
    return read_archive(spark, path).select(
        "page_id", F.length("payload").cast("bigint").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"), "record_type", "refers_to")


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rows(table(spark, sf_dir, "documents"))


def with_crc(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_crc(pack(table(spark, sf_dir, "documents"), TOKENIZER))


def simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex64(F.col("fp")).alias("fingerprint"), "component_id")


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned on three quarters of the documents, applied to all."""
    docs = table(spark, sf_dir, "documents")
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    model = fit(docs.where(part != 2))
    return identify_rows(docs, model).select(
        "doc_id", F.coalesce(part == 2, F.lit(False)).alias("held_out"),
        F.col("lang").alias("lang_pred"), "score", "rejected")


def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages")).withColumn(
        "n_chars", F.length("text").cast("bigint"))


def utf8_sha256(text):
    return F.sha2(text.cast("binary"), 256)


def fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document rearranged, and rebuilt from what came out."""
    made = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        utf8_sha256(F.col("output")).alias("output_sha256"),
        utf8_sha256(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in one of ten documents a word and all behind it repeat a stretch."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    planted = docs.select("doc_id", "text", h.alias("h"),
                          F.when(h % 10 == 0, words).alias("words"))
    planted = planted.withColumn("n", F.size("words")).withColumn("g", F.floor(F.col("h") / 10))
    planted = planted.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    planted = planted.withColumn(
        "p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    again = F.transform("words", lambda word, i: F.when(
        i >= F.col("a"), F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
        .otherwise(word))
    text = F.when(F.col("a").isNotNull(), F.array_join(again, " ")).otherwise(F.col("text"))
    return planted.select("doc_id", text.alias("text"))


def periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    # Runs come by start and period, so the first of the longest is the one asked for.
    longest = F.filter("runs", lambda r: r.length == F.array_max("runs.length"))
    best = F.when(F.size(longest) > 0, F.element_at(longest, 1))
    found = found.withColumn("best", best).withColumn(
        "lines", F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        utf8_sha256(F.col("lines")).alias("runs_sha256"),
        utf8_sha256(F.col("collapsed")).alias("collapsed_sha256"))


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from the labels of four fifths of the documents, applied to all."""
    docs = table(spark, sf_dir, "documents")
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    machine = fit_machine(docs, table(spark, sf_dir, "labels").where(part != 0),
                          metadata=("n_chars",))
    return classify(docs, machine, 0.3).select(
        "doc_id", F.coalesce(part == 0, F.lit(False)).alias("held_out"), "score", "predicted")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": substring_dedup,
    "op2_url_filters": url_filters,
    "op3_pseudonyms": pseudonyms,
    "op4_warc": warc,
    "op5_quality": quality_rules,
    "op6_packing": packing,
    "op7_simhash": simhash,
    "op8_decontamination": decontamination,
    "op9_language": language,
    "op10_html_text": html_text,
    "op11_fill_middle": fill_middle,
    "op12_periodic_runs": periodic,
    "op13_quality_classifier": quality_classifier,
}
