"""Gates, rankings and verdicts over tables of candidates (one row each, with nullable figures)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def gate_failures(*, most: dict[str, float], least: dict[str, float], zero: tuple[str, ...] = ()) -> Column:
    """Names of the gates that a candidate fails. A null figure passes; a null count is 0."""
    tests = [(f"{c} above {v:g}", F.col(c) > v) for c, v in most.items()]
    tests += [(f"{c} below {v:g}", F.col(c) < v) for c, v in least.items()]
    tests += [(f"{c} not zero", F.coalesce(F.col(c), F.lit(0)) > 0) for c in zero]
    return F.array_compact(F.array(*[F.when(t, F.lit(n)) for n, t in tests]))


def is_control(name: Column, role: Column) -> Column:
    """Controls never win: by role, or by a name that ends in _ceiling."""
    return F.coalesce(role == "control", F.lit(False)) | name.endswith("_ceiling")


def ranked(rows: DataFrame, *order: Column) -> DataFrame:
    """Rows with their place (from 1). One row per candidate, so that one task sorts them."""
    return rows.withColumn("place", F.row_number().over(Window.orderBy(*order)))


def noise_aware(rows: DataFrame, *, name: str = "name", divergence: str = "mean_kld", error: str = "mean_kld_se", default: float = 0.002) -> DataFrame:
    """Passing candidates with tolerance, is_tied and place.

    The tolerance is twice the largest error, or the default without any. Candidates within it of the best are tied and
    ranked by hidden mean, speed, size and memory; the others follow by divergence, unknown ones last.
    """
    bounds = rows.agg(F.min(divergence).alias("best"), (F.max(F.nullif(F.col(error), F.lit(0.0))) * 2.0).alias("twice"))
    both = rows.crossJoin(F.broadcast(bounds)).withColumn("tolerance", F.coalesce("twice", F.lit(default)))
    tied = both.withColumn("is_tied", F.coalesce(F.col(divergence) <= F.col("best") + F.col("tolerance"), F.lit(False)))
    inside = lambda c: F.when(F.col("is_tied"), c)
    or_zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    order = [F.col("is_tied").desc(), inside(or_zero("hidden_mean")).desc(), inside(or_zero("cpu_generation_tps")).desc(), inside(F.col("size")).asc(), inside(or_zero("peak_rss_kb")).asc(), F.col(divergence).asc_nulls_last(), F.col(name)]
    return ranked(tied, *order).drop("best", "twice")


def pareto(rows: DataFrame, *, name: str, most: list[str], least: list[str], missing_least: float = 0.0) -> DataFrame:
    """Candidates that no other one dominates; missing figures count as 0 (missing_least sets it for those to minimise).

    Figures become numbers to maximise. Only distinct points matter, and a point that isn't the best of those that share
    all but one figure is dominated by that best; so an aggregation per figure thins the points before the anti join.
    """
    figures = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in most] + [-F.coalesce(F.col(c).cast("double"), F.lit(missing_least)) for c in least]
    names = [f"__f{k}" for k in range(len(figures))]
    scored = rows.select("*", *[f.alias(n) for f, n in zip(figures, names)])
    points = scored.select(*names).distinct()
    for n in names:
        rest = [x for x in names if x != n]
        points = points.groupBy(*rest).agg(F.max(n).alias(n))
    a, b = points.alias("a"), points.alias("b")
    no_worse = [F.col(f"b.{n}") >= F.col(f"a.{n}") for n in names]
    better = [F.col(f"b.{n}") > F.col(f"a.{n}") for n in names]
    dominated = no_worse[0]
    for c in no_worse[1:]:
        dominated = dominated & c
    some = better[0]
    for c in better[1:]:
        some = some | c
    front = a.join(b, dominated & some, "left_anti")
    return scored.join(front, names, "left_semi").drop(*names)


def deltas(rows: DataFrame, name: str, baseline: str, figures: dict[str, int]) -> DataFrame:
    """Rows with delta_<figure> to the named row, rounded to the given places."""
    base = rows.filter(F.col(name) == baseline).limit(1).select(*[F.col(c).alias(f"__{c}") for c in figures])
    return rows.crossJoin(F.broadcast(base)).select("*", *[F.bround(F.col(c) - F.col(f"__{c}"), d).alias(f"delta_{c}") for c, d in figures.items()]).drop(*[f"__{c}" for c in figures])


def baseline_verdict(mean: Column, good: float = 0.75) -> Column:
    """Whether a baseline is good enough to look further."""
    return F.when(mean.isNull(), "inconclusive").when(mean >= good, "acceptable").otherwise("poor")


def diagnosis(reference: Column, best_other: Column, good: float = 0.75, gap: float = 0.05) -> Column:
    """What a study says: the reference is poor, the others lose materially, or neither."""
    return F.when(reference.isNull(), "inconclusive").when(reference < good, "finetuning_or_template_issue").when(best_other < reference - gap, "quantization_issue").otherwise("mixed_or_acceptable")


def first_match(left: DataFrame, right: DataFrame, test: Column, *, order: list[str]) -> DataFrame:
    """Left rows with their first right row (by order) that passes a test of any kind; left rows without one stay, and
    so do repeated ones.

    An aggregation by the different left rows picks the first match, and a join gives it to each of them. The right side
    must be a small table, and is sent to all tasks by Spark's rule.
    """
    keys, rest = list(left.columns), list(right.columns)
    firsts = left.distinct().join(right, test).groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__first"))
    renamed = firsts.select(*[F.col(c).alias(f"__{k}") for k, c in enumerate(keys)], "__first")
    on = F.lit(True)
    for k, c in enumerate(keys):
        on = on & left[c].eqNullSafe(F.col(f"__{k}"))
    return left.join(renamed, on, "left").select(*[left[c] for c in keys], "__first.*")


def enriched(rows: DataFrame, candidates: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Ranked rows with columns of their candidates; rows without one stay, with nulls. candidates: one row a key."""
    there = candidates.select(F.col(key).alias("__key"), *columns)
    return rows.join(there, rows[key] == F.col("__key"), "left").drop("__key")


def resolve_files(recipes: DataFrame, files: DataFrame, folder: str = "folder") -> DataFrame:
    """Recipes with status and file: the named file, else the only one in its folder, else the only one of its size.

    recipes: folder, filename, size; files: folder, file, bytes.
    """
    joined = recipes.join(files, folder, "left")
    per = joined.groupBy(folder, "filename", "size").agg(
        F.max(F.when(F.col("file") == F.col("filename"), F.col("file"))).alias("named"),
        F.count("file").alias("n"),
        F.min("file").alias("any"),
        F.count_if(F.col("bytes") == F.col("size")).alias("n_sized"),
        F.min(F.when(F.col("bytes") == F.col("size"), F.col("file"))).alias("sized"),
    )
    file = F.coalesce("named", F.when(F.col("n") == 1, F.col("any")), F.when(F.col("n_sized") == 1, F.col("sized")))
    status = F.when(file.isNotNull(), "found").when(F.col("n") == 0, "missing").otherwise("ambiguous")
    return per.select(folder, "filename", "size", file.alias("file"), status.alias("status"))


def first_pattern(names: DataFrame, patterns: DataFrame, name: str = "name") -> DataFrame:
    """The names that match the first pattern that any name matches. patterns: rank, pattern (few rows)."""
    hits = names.join(patterns, F.regexp_like(F.col(name), F.col("pattern")))
    best = hits.agg(F.min("rank").alias("__best"))
    return hits.crossJoin(F.broadcast(best)).filter(F.col("rank") == F.col("__best")).select(*names.columns)


def dominant(rows: DataFrame, group: str, kind: str, share: float = 0.5) -> DataFrame:
    """(group, kind, n, total, dominant): the most frequent kind, and whether it has the share."""
    per = rows.groupBy(group, kind).agg(F.count(F.lit(1)).alias("n"))
    best = per.groupBy(group).agg(F.sum("n").alias("total"), F.max_by(kind, F.struct(F.col("n"), F.col(kind))).alias(kind), F.max("n").alias("n"))
    return best.select(group, kind, "n", "total", (F.col("n") >= F.col("total") * share).alias("dominant"))


def foreign_kinds(rows: DataFrame, group: str, kind: str, allowed: list[str]) -> DataFrame:
    """(group, foreign): kinds outside the allowed ones, sorted."""
    return rows.groupBy(group).agg(F.array_sort(F.array_except(F.collect_set(kind), F.array(*[F.lit(a) for a in allowed]))).alias("foreign"))


def leaderboard(rows: DataFrame, columns: list[str], order: str = "place") -> DataFrame:
    """One row, markdown: a table of ranked candidates. One line per candidate."""
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns]), F.lit(" |"))
    head = "| " + " | ".join(columns) + " |\n|" + "---|" * len(columns)
    listed = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("l")))), lambda x: x["l"])
    return rows.agg(F.concat(F.lit(head + "\n"), F.array_join(listed, "\n")).alias("markdown"))
