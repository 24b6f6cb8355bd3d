"""Thin queries over the test tables: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from wickworks.llm import bpe, collocations, compression, decontam, langid, lexical, licences, pii, quality, simhash, templates, toxicity, urlfilter
from wickworks.llm.common import documents


def op2_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression.report(documents(spark, sf_dir))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(documents(spark, sf_dir))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(documents(spark, sf_dir))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return langid.identify(spark.read.parquet(f"{sf_dir}/pages.parquet"), docs, docs)


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(documents(spark, sf_dir))


def op10_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.report(documents(spark, sf_dir))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(documents(spark, sf_dir))


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.report(documents(spark, sf_dir))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    postings, _ = lexical.index(documents(spark, sf_dir))
    return lexical.search(postings, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality": op1_quality,
        "op2_compression_bands": op2_compression_bands,
        "op3_language": op3_language,
        "op4_bpe": op4_bpe,
        "op5_simhash": op5_simhash,
        "op6_toxicity": op6_toxicity,
        "op7_decontamination": op7_decontamination,
        "op8_url_filter": op8_url_filter,
        "op9_pii": op9_pii,
        "op10_line_templates": op10_line_templates,
        "op11_collocations": op11_collocations,
        "op12_licenses": op12_licenses,
        "op13_lexical_search": op13_lexical_search,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op7_decontamination": decontam.REPORT_SQL,
        "op8_url_filter": urlfilter.JUDGE_SQL,
        "op10_line_templates": templates.REPORT_SQL,
        "op11_collocations": collocations.MINE_SQL,
        "op12_licenses": licences.REPORT_SQL,
        "op13_lexical_search": lexical.SEARCH_SQL,
    }
