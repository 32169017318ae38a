"""Registered queries of the pipeline operators, with SQL where SQL can give their rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from msgloom.llm import (
    alignment,
    decontaminate,
    fingerprints,
    html_text,
    ngram_join,
    packing,
    quality,
    sql,
    suffix_dedup,
    token_counts,
    token_files,
    url_filter,
    warc,
    whitening,
)
from msgloom.llm.common import table
from msgloom.queries.registry import Query

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(text: str | None = None):
    """Register a query under its function name, with its SQL."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if text:
            ORACLES[fn.__name__] = text
        return fn

    return register


@query()
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents")).drop("ids")


@query(sql.NGRAM_JOIN)
def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_groups(table(spark, sf_dir, "documents"))


@query(sql.WARC)
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = warc.round_trip(table(spark, sf_dir, "pages"))
    return captures.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


@query()
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    pairs = decontaminate.find_items(docs, items, near=True)
    return pairs.drop("text_key", "score")


@query()
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"))


@query(sql.QUALITY)
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


@query()
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


@query()
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeats_report(table(spark, sf_dir, "documents"))


@query()
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"))
    return counted.withColumn("over_limit", counted["n_tokens"] > 1024)


@query()
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


@query()
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, fitted = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return whitening.components_of(rows, fitted)


@query()
def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.digests(table(spark, sf_dir, "documents"))
