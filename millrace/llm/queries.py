"""The queries of this package: each operator, with production parameters, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, line_rules, mixing, near_duplicates, perplexity, secrets, sequences, suffix_dedup, token_counts, warc
from millrace.llm.common import work_path
from millrace.llm.oracles import ORACLES  # noqa: F401


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op2_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.classify(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(_documents(spark, sf_dir))


def op4_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return sequences.token_files(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeats(_documents(spark, sf_dir))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of one language are counted first and fill the cache; then all documents are joined to it, and the
    texts that it lacks are added. The result has every document."""
    import public_tokenizers

    docs, cache, model = _documents(spark, sf_dir), work_path(spark, "token-cache"), public_tokenizers.path("piece_bpe_32k.model")
    token_counts.fill_cache(docs.filter("lang = 'es'"), model, cache)
    return token_counts.count_tokens(docs, model, cache)


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.jaccard_join(_documents(spark, sf_dir))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_documents(spark, sf_dir))


def op9_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.line_rules(_documents(spark, sf_dir))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.withColumn("items", F.array_join(F.col("items").cast("array<string>"), ","))


QUERIES = {
    "op1_warc": op1_warc,
    "op2_perplexity": op2_perplexity,
    "op3_mixing": op3_mixing,
    "op4_sequences": op4_sequences,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_token_counts": op6_token_counts,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_secrets": op8_secrets,
    "op9_line_rules": op9_line_rules,
    "op10_decontaminate": op10_decontaminate,
}
