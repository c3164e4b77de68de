"""Counts, fractions and breakdowns; each is one aggregation that combines before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counts(rows: DataFrame, by: str, name: str = "n") -> DataFrame:
    return rows.groupBy(by).agg(F.count(F.lit(1)).alias(name))


def first_seen(rows: DataFrame, value: str, order: str) -> DataFrame:
    """(value, first): the distinct values with where they came first; sort by first for their order."""
    return rows.groupBy(value).agg(F.min(order).alias("first"))


def fraction(part: Column, whole: Column, digits: int = 6) -> Column:
    """part / whole, with 1 for an empty whole."""
    return F.bround(part / F.greatest(F.lit(1), whole), digits)


def quality(rows: DataFrame, by: str, tests: dict[str, Column]) -> DataFrame:
    """Per group: rows, and for each test its count and fraction."""
    n = F.count(F.lit(1))
    columns = [c for name, test in tests.items() for c in (F.count_if(test).alias(name), fraction(F.count_if(test), n).alias(f"{name}_fraction"))]
    return rows.groupBy(by).agg(n.alias("n_rows"), *columns)


def breakdown(rows: DataFrame, value: str, *dimensions: str, digits: int = 3) -> DataFrame:
    """(dimension, key, n, mean): one independent grouping per dimension, in one pass by grouping sets."""
    grouped = rows.groupingSets([[F.col(d)] for d in dimensions], *dimensions).agg(*[F.grouping(d).alias(f"__{d}") for d in dimensions], F.count(F.lit(1)).alias("n"), F.bround(F.avg(value), digits).alias("mean"))
    name, key = F.lit(None).cast("string"), F.lit(None).cast("string")
    for d in dimensions:
        name = F.when(F.col(f"__{d}") == 0, d).otherwise(name)
        key = F.when(F.col(f"__{d}") == 0, F.col(d).cast("string")).otherwise(key)
    return grouped.select(name.alias("dimension"), key.alias("key"), "n", "mean")


def report(rows: DataFrame, score: str, failures: dict[str, Column], digits: int = 3) -> DataFrame:
    """One row: n, mean score, and how many rows fail each test."""
    return rows.agg(F.count(F.lit(1)).alias("n"), F.bround(F.avg(score), digits).alias("mean_score"), *[F.count_if(t).alias(name) for name, t in failures.items()])


def offenders(rows: DataFrame, test: Column, position: str, shown: int = 20) -> DataFrame:
    """One row: how many rows fail, and the first positions. Only `shown` of them reach the last task."""
    bad = rows.filter(test)
    first = bad.orderBy(position).limit(shown).agg(F.array_sort(F.collect_list(position)).alias("preview"))
    return bad.agg(F.count(F.lit(1)).alias("n_bad")).crossJoin(first)


def corpus(rows: DataFrame, by: str, tokens: str, limit: int) -> DataFrame:
    """Per group: rows, tokens kept under a limit a row, rows cut by it."""
    return rows.groupBy(by).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.least(F.col(tokens), F.lit(limit))).cast("long").alias("n_tokens"), F.count_if(F.col(tokens) > limit).alias("n_cut"))


def gate(rows: DataFrame, holds: Column, message: str) -> DataFrame:
    """rows, or an error when they are acted on and a condition over them doesn't hold."""
    checked = rows.agg(F.assert_true(holds, message).alias("__checked"))
    return rows.crossJoin(F.broadcast(checked)).filter(F.col("__checked").isNull()).drop("__checked")


def sampled_share(rows: DataFrame, test: Column, position: str, sample: int = 64) -> DataFrame:
    """One row: of the first rows by position, how many pass a test, and their part."""
    head = rows.withColumn("__test", test).orderBy(position).limit(sample)
    return head.agg(F.count(F.lit(1)).alias("sampled"), F.count_if("__test").alias("n"), fraction(F.count_if("__test"), F.count(F.lit(1))).alias("part"))


def all_ignored(labels: Column, ignored: int = -100) -> Column:
    """Whether a row has labels and all of them are ignored, or has none."""
    return labels.isNull() | ((F.size(labels) > 0) & F.forall(labels, lambda x: x == ignored))


def missing_fields(*names: str) -> Column:
    """Names of the fields that are null or blank."""
    return F.array_compact(F.array(*[F.when(F.trim(F.coalesce(F.col(n).cast("string"), F.lit(""))) == "", F.lit(n)) for n in names]))


def patched_tags(tags: Column, *, drop: tuple[str, ...] = (), first: tuple[str, ...] = (), last: tuple[str, ...] = ()) -> Column:
    """Tags without some, and with others in front or behind where they are missing."""
    out = F.filter(F.coalesce(tags, F.array().cast("array<string>")), lambda t: ~t.isin(*drop)) if drop else F.coalesce(tags, F.array().cast("array<string>"))
    for tag in first:
        out = F.when(F.array_contains(out, tag), out).otherwise(F.array_prepend(out, tag))
    for tag in last:
        out = F.when(F.array_contains(out, tag), out).otherwise(F.array_append(out, tag))
    return out


def card(rows: DataFrame, title: str, *by: str) -> DataFrame:
    """One row, markdown: a data set's card, with the rows by each of some columns (language and source). All their
    values are listed, from one aggregation that combines before the shuffle."""
    by = by or ("language", "source")
    line = lambda key, n: F.concat(F.lit("| "), key, F.lit(" | "), F.format_number(n, 0), F.lit(" |"))
    tables = breakdown(rows.withColumn("__one", F.lit(1)), "__one", *by)
    listed = tables.groupBy("dimension").agg(F.sum("n").alias("n"), F.array_sort(F.collect_list(F.struct(F.coalesce("key", F.lit("-")).alias("key"), "n"))).alias("lines"))
    shown = listed.select("dimension", "n", F.array_join(F.transform("lines", lambda x: line(x["key"], x["n"])), "\n").alias("lines"))
    part = lambda d: F.concat(F.lit(f"| {d} | rows |\n|---|---|\n"), F.coalesce(F.max(F.when(F.col("dimension") == d, F.col("lines"))), F.lit("")), F.lit("\n"))
    head = F.concat(F.lit(f"# {title}\n\n"), F.format_number(F.coalesce(F.max("n"), F.lit(0)), 0), F.lit(" rows\n\n"))
    return shown.agg(F.concat(head, *[c for k, d in enumerate(by) for c in (([F.lit("\n")] if k else []) + [part(d)])]).alias("markdown"))
