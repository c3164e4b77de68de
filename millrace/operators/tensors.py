"""Block quantisation of float arrays, inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 32


def half(x: Column) -> Column:
    """A number rounded to half precision, ties to even: Spark has no half type."""
    size = F.abs(x)
    step = F.pow(F.lit(2.0), F.greatest(F.floor(F.log2(size)), F.lit(-14)) - 10)
    return F.when(size == 0, F.lit(0.0)).when(size >= 65_520, F.signum(x) * F.lit(float("inf"))).otherwise(F.bround(x / step) * step)


def _blocks(values: Column, block: int, one) -> Column:
    starts = F.when(F.size(values) > 0, F.sequence(F.lit(0), F.floor((F.size(values) - 1) / block).cast("int"))).otherwise(F.array().cast("array<int>"))
    return F.when(values.isNotNull(), F.flatten(F.transform(starts, lambda k: one(F.slice(values, k * block + 1, block)))))


def _signed_most(part: Column) -> Column:
    """The element of largest size, the first of them."""
    size = F.transform(part, lambda x: F.abs(x))
    return F.element_at(part, F.array_position(size, F.array_max(size)).cast("int"))


def lattice(values: Column, block: int = BLOCK) -> Column:
    """The array after four-bit block quantisation and back; null stays null, empty stays empty.

    Per block: the scale is its element of largest size (the first of them), with its sign, divided by -8; codes are
    floor(x / scale + 8.5), 15 at most. The scale stays a double here; a half-precision scale is lattice_half.
    """

    def one(part: Column) -> Column:
        part = F.transform(part, lambda x: x.cast("double"))
        scale = _signed_most(part) / F.lit(-8.0)
        named = F.transform(F.array(F.struct(part.alias("part"), scale.alias("scale"))), lambda b: F.transform(b["part"], lambda x: F.when(b["scale"] == 0, 0.0).otherwise((F.least(F.lit(15), F.floor(x / b["scale"] + F.lit(8.5)).cast("int")) - 8) * b["scale"])))
        return F.get(named, F.lit(0))

    return _blocks(values, block, one)


def errors(values: Column, rounded: Column) -> tuple[Column, Column]:
    """Largest and mean absolute difference."""
    gaps = F.zip_with(values, rounded, lambda a, b: F.abs(a.cast("double") - b))
    return F.array_max(gaps), F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x) / F.size(gaps)


def lattice_half(values: Column, block: int = BLOCK) -> Column:
    """lattice in single precision, with codes from the single-precision scale and values from the half-precision one."""

    def one(part: Column) -> Column:
        part = F.transform(part, lambda x: x.cast("float"))
        scale = (_signed_most(part) / F.lit(-8.0)).cast("float")
        inverse = F.when(scale == 0, F.lit(0.0)).otherwise(F.lit(1.0) / scale).cast("float")
        stored = half(scale.cast("double")).cast("float")
        code = lambda x, b: F.least(F.lit(15.0), F.floor(x * b["inverse"] + F.lit(8.5).cast("float")).cast("double")) - F.lit(8.0)
        named = F.transform(F.array(F.struct(part.alias("part"), inverse.alias("inverse"), stored.alias("stored"))), lambda b: F.transform(b["part"], lambda x: (code(x, b).cast("float") * b["stored"])))
        return F.get(named, F.lit(0))

    return _blocks(values, block, one)


def counter_range(rows: DataFrame, name: str, values: str) -> DataFrame:
    """One row over tensors of counts: count_min and count_max over the finite ones, n_nonfinite, n_zero (least count
    not above 0). A tensor without values is left out."""
    per = rows.filter(F.size(values) > 0).select(name, F.array_min(values).cast("double").alias("least"), F.array_max(values).cast("double").alias("most"))
    odd = lambda c: F.isnan(c) | F.col(c).isin(float("inf"), float("-inf"))
    marked = per.withColumn("nonfinite", odd("least") | odd("most"))
    fine = ~F.col("nonfinite")
    return marked.agg(F.min(F.when(fine, F.col("least"))).alias("count_min"), F.max(F.when(fine, F.col("most"))).alias("count_max"), F.count_if("nonfinite").alias("n_nonfinite"), F.count_if(fine & (F.col("least") <= 0)).alias("n_zero"))


def patch_control_tokens(tokens: Column, controls: list[str]) -> Column:
    """Token entries (id, content, special) with the control tokens marked special."""
    return F.transform(tokens, lambda t: F.struct(t["id"].alias("id"), t["content"].alias("content"), (t["special"] | t["content"].isin(controls)).alias("special")))


def end_ids(tokens: Column, controls: list[str]) -> Column:
    """The sorted distinct ids of the given tokens."""
    return F.array_sort(F.array_distinct(F.transform(F.filter(tokens, lambda t: t["content"].isin(controls)), lambda t: t["id"])))


def block_index(name: Column) -> Column:
    """The block number in a tensor's name; null for other names."""
    return F.regexp_extract(name, r"^blk\.(\d+)\.", 1).try_cast("int")
