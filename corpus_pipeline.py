"""A training corpus from documents: filtered, de-duplicated, decontaminated, mixed, and written as token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each stage's result as Parquet below the
shared folder and reads it back as the next stage's documents. All stages but the last return the columns of documents.

Edge cases, for every stage: an empty table gives an empty table; further columns pass through whatever their names, up to
the last stage, which reads doc_id and text only; long texts are read whole.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontaminate, mixing, near_duplicates, perplexity, sequences
from millrace.llm.common import materialize


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is inside their language's quantiles. Null and empty texts go; a null language is one
    language; repeated rows share one decision."""
    return perplexity.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the smallest id, null ids last. Null and empty texts are no
    duplicates of other ids; of repeated rows one stays."""
    return near_duplicates.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage. Null and empty texts stay; rows that agree in id and text share one
    decision."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them, twice at most. Null sources are one source; texts
    without a word are not taken; repeated rows share one decision."""
    return mixing.mixed_rows(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The index of the written token files: doc_id, start, n_tokens, ids_crc32. Null ids come first; every row has an
    entry."""
    return sequences.token_files(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("jaccard_join", jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("token_output", token_output),
]

#: No SQL expresses the classifier, the join or the tokenizer; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
