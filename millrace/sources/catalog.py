"""Which table a source key stands for: a local file that has rows, else a published folder at its pinned revision."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from millrace.sources import jsonl


@dataclass(frozen=True)
class Source:
    """A named source. local: JSON lines; published: a folder with a folder a split, below one a revision."""

    key: str
    language: str = "english"
    local: str | None = None
    published: str | None = None
    optional: bool = False


def _exists(spark: SparkSession, path: str | None) -> bool:
    if not path:
        return False
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there)


def resolve_revisions(sources: list[Source], pinned: dict[str, str]) -> dict[str, str]:
    """Key to revision: pinned, or "local"; optional sources without either are left out. One entry a published folder
    is looked up once."""
    by_folder: dict[str, str] = {}
    out = {}
    for s in sources:
        if s.published and s.key in pinned:
            out[s.key] = by_folder.setdefault(s.published, pinned[s.key])
        elif s.published and s.published in by_folder:
            out[s.key] = by_folder[s.published]
        elif s.local:
            out[s.key] = "local"
        elif not s.optional:
            raise LookupError(f"no revision for {s.key}")
    return out


def published_split(spark: SparkSession, folder: str, split: str = "train") -> DataFrame:
    """The rows of a split, or of the first split by name where that one is missing."""
    if _exists(spark, f"{folder}/split={split}"):
        return spark.read.parquet(f"{folder}/split={split}")
    rows = spark.read.parquet(folder)
    first = rows.selectExpr("min(split)").first()[0]
    return rows.filter(rows["split"] == first).drop("split")


def load(spark: SparkSession, source: Source, revisions: dict[str, str]) -> DataFrame | None:
    """Canonical rows of a source; None where an optional source has none."""
    if _exists(spark, source.local):
        rows = jsonl.chat_rows(jsonl.read_lines(spark, source.local), source.key, default_language=source.language)
        if rows.limit(1).count():
            return rows
    revision = revisions.get(source.key)
    if source.published and revision not in (None, "local"):
        return published_split(spark, f"{source.published}/{revision}")
    if source.optional:
        return None
    raise LookupError(f"no rows for {source.key}")
