"""First-wins de-duplication and the joins that keep splits apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_wins(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key. Spark limits each key's group before it sorts the shuffled rows."""
    ranked = rows.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("__rank = 1").drop("__rank")


def last_wins(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key, as one aggregation that combines before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    picked = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("__last"))
    return picked.select(*keys, "__last.*")


def without(rows: DataFrame, *seen: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key none of the others has."""
    for other in seen:
        rows = rows.join(other.select(*on).distinct(), on, "left_anti")
    return rows


def overlap(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """Keys that both have."""
    return a.select(*on).intersect(b.select(*on))


def symmetric_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(key, side): keys that only one of them has; side is left or right."""
    left, right = a.select(key).distinct(), b.select(F.col(key).alias("__key")).distinct()
    both = left.join(right, F.col(key) == F.col("__key"), "full_outer").filter(F.col(key).isNull() | F.col("__key").isNull())
    return both.select(F.coalesce(key, "__key").alias(key), F.when(F.col("__key").isNull(), "left").otherwise("right").alias("side"))


def duplicate_keys(rows: DataFrame, key: str) -> DataFrame:
    """(key, n) of keys that occur more than once."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
