"""The corpus pipeline: documents in, the token ids of a clean, deduplicated, decontaminated corpus out.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame; run() writes each stage's rows as Parquet in the shared folder and hands
them to the next. All but the last return the columns of documents, with n_chars, where there is one, set anew if text changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickworks.llm import bpe, compression, decontam, simhash, templates
from wickworks.llm.common import documents, drop_table, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or the compression bands go."""
    return compression.keep(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of templates that recur across documents go, but for their first occurrence; every document stays."""
    out = templates.clean(docs).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the first document stays."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.keep(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids and the digests of the encoding and of what it decodes to."""
    return bpe.encoded(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("BPE encoding and decoding", tokens),
]

#: zstandard ratios, SimHash and BPE are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs, last = documents(spark, sf_dir), None
    for name, stage in STAGES:
        docs, at = table(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
        if last:
            drop_table(spark, last)
        last = at
    return docs
