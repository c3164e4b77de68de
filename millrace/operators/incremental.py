"""Resumable work as set operations: what is left, what came back, what must be done again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.dedup import without


def remaining(source: DataFrame, *handled: DataFrame, key: str) -> DataFrame:
    """Source rows that no table of handled keys has."""
    return without(source, *handled, on=[key])


def unsubmitted(source: DataFrame, state: DataFrame, key: str, ids: str = "source_ids") -> DataFrame:
    """Source rows in no submitted chunk; state holds arrays of keys."""
    return without(source, state.select(F.explode(ids).alias(key)), on=[key])


def with_responses(source: DataFrame, responses: DataFrame, key: str, response_key: str = "custom_id") -> DataFrame:
    """Source rows with their response; unknown response ids are dropped."""
    return source.join(responses, F.col(key) == F.col(response_key)).drop(response_key)


def response_content(body: str = "response") -> Column:
    """The first choice's content of a nested batch response; null on errors and other status codes."""
    ok = (F.col(f"{body}.status_code") == 200) & F.col("error").isNull()
    return F.when(ok, F.try_element_at(F.col(f"{body}.body.choices"), F.lit(1))["message"]["content"])


def revalidated(done: DataFrame, source: DataFrame, key: str, passes) -> DataFrame:
    """Done rows with verdict: keep (passes, or unknown to the source) or redo. passes: a test over both tables' columns."""
    known = source.withColumn("__known", F.lit(True))
    joined = done.join(known, key, "left")
    return joined.withColumn("verdict", F.when(F.col("__known").isNull(), "keep").when(F.coalesce(passes, F.lit(False)), "keep").otherwise("redo")).drop("__known")


def in_source_order(done: DataFrame, source: DataFrame, key: str, position: str) -> DataFrame:
    """Done rows that the source knows, with the source's position, sorted by it."""
    return done.join(source.select(key, position), key).orderBy(position)
