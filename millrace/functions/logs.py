"""Figures out of tool logs, as column expressions; null where a log lacks them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: How the tools print their figures.
MEAN_KLD = (r"(?i)Mean KLD[^0-9]*([0-9]+(?:\.[0-9]+)?)", r"(?i)mean kl divergence[^0-9]*([0-9]+(?:\.[0-9]+)?)")
KLD_WITH_ERROR = r"(?i)Mean\s+KLD:\s*([0-9.]+)\s*±\s*([0-9.]+)"
PERPLEXITY = r"Final estimate: PPL = ([0-9.]+)"
SAME_TOP = r"Same top p:\s*([0-9.]+)\s*±"
CHUNKS = r"calculating perplexity over (\d+) chunks"
RATE_CELL = r"(?m)([0-9]+(?:\.[0-9]+)?)\s*(?:±[^|\n]*)?\|[ \t]*$"


def _number(log: Column, pattern: str, group: int = 1, kind: str = "double") -> Column:
    return F.regexp_extract(log, pattern, group).try_cast(kind)


def mean_kld(log: Column) -> Column:
    """The mean divergence, in either spelling."""
    return F.coalesce(*[_number(log, p) for p in MEAN_KLD])


def kld_and_error(log: Column) -> tuple[Column, Column]:
    """The mean divergence and its error; without an error, the plain figure."""
    return F.coalesce(_number(log, KLD_WITH_ERROR), mean_kld(log)), _number(log, KLD_WITH_ERROR, 2)


def perplexity(log: Column) -> Column:
    return _number(log, PERPLEXITY)


def same_top(log: Column) -> Column:
    return _number(log, SAME_TOP)


def chunk_count(log: Column) -> Column:
    return _number(log, CHUNKS, kind="bigint")


def rates(log: Column) -> Column:
    """The last cells of all table rows."""
    return F.transform(F.regexp_extract_all(log, F.lit(RATE_CELL), F.lit(1)), lambda x: x.cast("double"))


def generation_rate(values: Column) -> Column:
    """The last rate, or 0."""
    return F.coalesce(F.try_element_at(values, F.lit(-1)), F.lit(0.0))


def prompt_and_generation(values: Column) -> tuple[Column, Column]:
    """First and last rate where there are two or more."""
    enough = F.size(values) >= 2
    return F.when(enough, F.try_element_at(values, F.lit(1))), F.when(enough, F.try_element_at(values, F.lit(-1)))


def mentions_flag(text: Column, flag: str) -> Column:
    """Whether a help text lists a flag."""
    return text.rlike(rf"(?:^|\s)\Q{flag}\E(?:\s|,|$)")


def peak_memory(log: Column) -> Column:
    """The number on the log's last line that is one."""
    lines = F.filter(F.split(log, "\n"), lambda x: F.trim(x).rlike(r"^[0-9]+(\.[0-9]+)?$"))
    return F.trim(F.try_element_at(lines, F.lit(-1))).try_cast("double")
