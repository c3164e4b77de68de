"""File listings, digests, and the joins that compare a manifest with what is there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def listing(spark: SparkSession, folder: str, *, ignored_suffixes: tuple[str, ...] = (".tmp",), ignored_folders: tuple[str, ...] = ("__pycache__",), digest: bool = True) -> DataFrame:
    """(path, size, sha256) of the files below a folder. A file is hashed in one piece, so this is for small artifacts."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    skipped = F.lit(False)
    for suffix in ignored_suffixes:
        skipped = skipped | F.col("path").endswith(suffix)
    for name in ignored_folders:
        skipped = skipped | F.contains("path", F.lit(f"/{name}/"))
    columns = ["path", F.col("length").alias("size")] + ([F.sha2("content", 256).alias("sha256")] if digest else [])
    return files.filter(~skipped).select(*columns)


def in_order(files: DataFrame, path: str = "path") -> DataFrame:
    """Files with their place (from 1) in the order of their paths; one row a file, so that one task sorts them."""
    return files.withColumn("place", F.row_number().over(Window.orderBy(path)).cast("long"))


def totals(files: DataFrame) -> DataFrame:
    return files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))


def verify(manifest: DataFrame, files: DataFrame, key: str = "path", digest: str = "sha256") -> DataFrame:
    """(key, status): ok, missing or changed for every manifest entry."""
    there = files.select(F.col(key).alias("__key"), F.col(digest).alias("__digest"))
    joined = manifest.join(there, F.col(key) == F.col("__key"), "left")
    status = F.when(F.col("__key").isNull(), "missing").when(F.col(digest) == F.col("__digest"), "ok").otherwise("changed")
    return joined.select(key, status.alias("status"))


def coverage(expected: DataFrame, seen: DataFrame, key: str, family: str) -> DataFrame:
    """Per family: expected and covered entries, and the covered part."""
    marked = expected.join(seen.select(F.col(key).alias("__key")).distinct(), F.col(key) == F.col("__key"), "left")
    n, covered = F.count(F.lit(1)), F.count("__key")
    return marked.groupBy(family).agg(n.alias("expected"), covered.alias("covered"), F.bround(covered / n, 6).alias("ratio"))


def stale(artifacts: DataFrame, facts: DataFrame, key: str, checks: dict[str, tuple[str, str]]) -> DataFrame:
    """(key, reasons): artifacts whose facts are missing or differ. checks: reason to (artifact column, fact column)."""
    renamed = facts.select(F.col(key).alias("__key"), *[F.col(f).alias(f"__{f}") for f in dict.fromkeys(f for _, f in checks.values())])
    joined = artifacts.join(renamed, F.col(key) == F.col("__key"), "left")
    reasons = F.array_compact(F.array(F.when(F.col("__key").isNull(), "missing"), *[F.when(F.col("__key").isNotNull() & ~F.col(a).eqNullSafe(F.col(f"__{f}")), reason) for reason, (a, f) in checks.items()]))
    return joined.select(key, reasons.alias("reasons")).filter(F.size("reasons") > 0)


def paired(names: DataFrame, name: str, first: str, second: str) -> DataFrame:
    """(base, has_first, has_second): names with one of two suffixes (patterns), paired by what is before it."""
    marked = names.select(F.regexp_replace(name, rf"({first}|{second})$", "").alias("base"), F.col(name).rlike(rf"{first}$").alias("a"), F.col(name).rlike(rf"{second}$").alias("b")).filter("a or b")
    return marked.groupBy("base").agg(F.bool_or("a").alias("has_first"), F.bool_or("b").alias("has_second"))


def identical(a: DataFrame, b: DataFrame, key: str = "path", digest: str = "sha256") -> DataFrame:
    """(key, same): whether the files that both have are the same, byte for byte."""
    return a.select(key, F.col(digest).alias("__a")).join(b.select(key, F.col(digest).alias("__b")), key).select(key, (F.col("__a") == F.col("__b")).alias("same"))


def version_mismatch(wanted: DataFrame, installed: DataFrame, name: str = "name", version: str = "version") -> DataFrame:
    """(name, wanted, installed): packages that are missing or of another version, local suffixes apart."""
    plain = lambda c: F.substring_index(c, "+", 1)
    joined = wanted.select(name, F.col(version).alias("wanted")).join(installed.select(name, F.col(version).alias("installed")), name, "left")
    return joined.filter(~plain("wanted").eqNullSafe(plain("installed")))


def provenance(files: DataFrame, stage: str) -> DataFrame:
    """The files as entries of a provenance index."""
    return files.select(F.lit(stage).alias("stage"), "path", "size", "sha256")


#: Names of draft heads, and of the layers that share keys and values with lower ones.
DRAFT = r"(?i)(?:^|[._])(?:mtp|draft|nextn)(?:[._]|$)"
SHARED = {
    "module": r"\.layers\.(1[5-9]|2[0-9]|3[0-4])\.self_attn\.(k_proj|v_proj)(?:\.linear)?$",
    "adapter": r"\.layers\.(1[5-9]|2[0-9]|3[0-4])\.self_attn\.(k_proj|v_proj)",
    "state": r"\.layers\.(1[5-9]|2[0-9]|3[0-4])\..*\.(k_proj|v_proj|k_norm)\.",
    "key": r"\.layers\.(1[5-9]|2[0-9]|3[0-4])\.self_attn\.(k_proj|v_proj|k_norm)(?:\.|$)",
}


def draft_names(names: DataFrame, name: str) -> DataFrame:
    """The names of a model's draft heads."""
    return names.filter(F.col(name).rlike(DRAFT))


def shared_kinds(name: Column) -> Column:
    """As what a name belongs to a layer that shares keys and values: module, adapter, state, key; sorted."""
    return F.array_sort(F.array_compact(F.array(*[F.when(name.rlike(p), F.lit(kind)) for kind, p in SHARED.items()])))


def name_leaks(names: DataFrame, name: str, prefixes: tuple[str, ...] = ("v.", "a.", "audio.", "vision."), parts: tuple[str, ...] = ("mmproj",)) -> DataFrame:
    """The names of parts that a text-only model must not have."""
    leaks = F.lit(False)
    for prefix in prefixes:
        leaks = leaks | F.col(name).startswith(prefix)
    for part in parts:
        leaks = leaks | F.contains(F.lower(name), F.lit(part))
    return names.filter(leaks)
