"""The registered queries: each operator with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import (
    best_fit_packing,
    collocations,
    decontamination,
    filter_audit,
    jaccard_join,
    license_scan,
    line_dedup,
    minhash_bbit,
    pii_crf,
    quality_rules,
    sql,
    suffix_dedup,
    token_counts,
    url_filter,
)
from starloom.llm.common import join_measured, read_table, show_library, written
from starloom.sources.workspace import new_workspace

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(oracle: str | None = None):
    """Register a function of session and input folder; ``oracle`` is the equal SQL."""

    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            show_library(spark)
            return function(spark, sf_dir)

        QUERIES[function.__name__] = run
        if oracle is not None:
            SQL[function.__name__] = oracle
        return function

    return register


@query(sql.DECONTAMINATION)
def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = decontamination.contamination(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )
    return checked.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query(sql.QUALITY)
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    rows = quality_rules.measured(docs, "text", "doc_id", "lang")
    rows = written(rows.drop("row"), "quality_metrics")
    known = quality_rules.known_quality(read_table(spark, sf_dir, "labels"))
    labelled = join_measured(rows, written(known, "quality_labels"), ["label_id"], "inner")
    return quality_rules.verdicts(rows, quality_rules.learn(labelled)).select(
        F.col("label_id").alias("doc_id"), *quality_rules.METRICS, "base_failed", "kept"
    )


@query(sql.LINE_DEDUP)
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.line_verdicts(docs).select(
        F.col("row.doc_id").alias("doc_id"),
        "n_lines",
        "n_dropped",
        F.sha2("kept_text", 256).alias("kept_sha256"),
    )


@query(sql.LICENSES)
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(
        read_table(spark, sf_dir, "documents"), license_scan.built_in(spark)
    )

@query()
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    cache = f"{new_workspace(spark)}/token_counts"
    counted = token_counts.count_tokens(docs, cache, "piece_bpe_32k.model")
    return counted.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > 4096).alias("over_limit"),
    )


@query()
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return best_fit_packing.pack(docs, "word_bpe_49k.json")


@query(sql.URLS)
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A page's outcome is the quality label of the document that its path names.
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    number = F.regexp_extract(url_filter.path_of(F.col("url")), r"^/[a-z]+/([0-9]+)", 1)
    labels = quality_rules.known_quality(read_table(spark, sf_dir, "labels"))
    labelled = pages.withColumn("label_id", number.try_cast("long")).join(
        labels, "label_id", "left"
    )
    judged = url_filter.judge(labelled, F.col("good"))
    return judged.select(F.col("row.page_id").alias("page_id"), "host", "path", "rule", "verdict")


@query()
def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii_crf.find_personal_data(docs)
    return found.withColumn("base_sha256", F.sha2("base_spans", 256)).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"
    )


@query()
def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs).select(
        F.col("row.doc_id").alias("doc_id"),
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query(sql.JACCARD)
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_join.link_documents(docs).select(
        F.col("row.doc_id").alias("doc_id"), "n_shingles", "component_id"
    )


@query(sql.FILTER_AUDIT)
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    )


@query(sql.NEAR_COPIES)
def op12_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash_bbit.near_copies(docs).select(
        F.col("row.doc_id").alias("doc_id"), "n_shingles", "component_id", "kept"
    )


@query(sql.COLLOCATIONS)
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents"))
