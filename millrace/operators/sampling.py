"""Seeded order, splits, samples, mixtures and token floors.

Order comes from SHA-256 over seed and key, so that it depends on neither partitions nor engine. Places in an order, of
all rows or inside a group, are taken in two steps: counts of the order's ranges, added up over the ranges, and a window
inside each range; so no task sorts all rows, or all of a frequent group. Where only the first rows of a group are
wanted, ranges behind them are dropped before any row is sorted. Only the tables of ranges go through one task a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def order_key(seed: int | Column, *parts: Column | str) -> Column:
    """The place of a row in the seeded order."""
    seed = F.lit(str(seed)) if isinstance(seed, int) else seed.cast("string")
    return F.sha2(F.concat_ws("|", seed, *[F.col(p).cast("string") if isinstance(p, str) else p.cast("string") for p in parts]), 256)


def running(rows: DataFrame, coarse: Column, order: list[Column], value: Column, name: str) -> DataFrame:
    """rows with the sum of value over all rows before each, in an order of which coarse is a prefix."""
    marked = rows.withColumn("__range", coarse).withColumn("__value", value)
    sums = marked.groupBy("__range").agg(F.sum("__value").alias("__sum"))
    offsets = sums.select(F.col("__range").alias("__r"), (F.sum("__sum").over(Window.orderBy("__range")) - F.col("__sum")).alias("__offset"))
    inside = F.coalesce(F.sum("__value").over(Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    joined = marked.withColumn("__inside", inside).join(offsets, F.col("__range").eqNullSafe(F.col("__r")))
    return joined.withColumn(name, (F.col("__inside") + F.col("__offset")).cast("long")).drop("__range", "__r", "__value", "__inside", "__offset")


def shuffled(rows: DataFrame, seed: int, *parts: str) -> DataFrame:
    """Rows with their place (from 1) in the seeded order."""
    key = order_key(seed, *parts)
    return running(rows, F.substring(key, 1, 3), [key], F.lit(1), "before").withColumn("place", F.col("before") + 1).drop("before")


def ranked_within(rows: DataFrame, group: str, seed: int | Column, *parts: str, most: Column | None = None) -> DataFrame:
    """Rows with their place (from 1) in the seeded order of their group; with most, at most so many of each group."""
    keyed = rows.withColumn("__key", order_key(seed, *parts)).withColumn("__range", F.substring("__key", 1, 3))
    before = Window.partitionBy("__g").orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    counts = keyed.groupBy(F.col(group).alias("__g"), F.col("__range").alias("__r")).agg(F.count(F.lit(1)).alias("__n"))
    counts = counts.select("__g", "__r", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    joined = keyed.join(counts, F.col(group).eqNullSafe(F.col("__g")) & (F.col("__range") == F.col("__r")))
    joined = joined if most is None else joined.filter(F.col("__before") < most)
    placed = joined.withColumn("place", F.col("__before") + F.row_number().over(Window.partitionBy(group, "__range").orderBy("__key")))
    placed = placed if most is None else placed.filter(F.col("place") <= most)
    return placed.drop("__key", "__range", "__g", "__r", "__before")


def test_size(count: Column, fraction: float) -> Column:
    """Rows to hold out: half-even rounded, one at least."""
    return F.greatest(F.lit(1), F.bround(count * F.lit(fraction))).cast("long")


def split(rows: DataFrame, group: str, fraction: float, seed: int, *parts: str) -> DataFrame:
    """Rows with is_test: the head of each group's seeded order."""
    ranked = ranked_within(rows, group, seed, *parts)
    counts = rows.groupBy(group).agg(F.count(F.lit(1)).alias("__n"))
    return ranked.join(counts, group).withColumn("is_test", F.col("place") <= test_size(F.col("__n"), fraction)).drop("__n")


def balanced(rows: DataFrame, group: str, per_group: int, seed: int, *parts: str) -> DataFrame:
    """per_group rows of each group."""
    return ranked_within(rows, group, seed, *parts, most=F.lit(per_group))


def mix_buckets(language: Column, source: Column, general: str, fallback: bool = True) -> Column:
    """The calibration bucket: general by source, else by language; english is everything else if fallback."""
    other = F.lit("english") if fallback else F.lit(None).cast("string")
    return F.when(source == general, "general").when(language == "swahili", "swahili").when(language == "english", "english").otherwise(other)


def mixture(pool: DataFrame, base_count: DataFrame, shares: DataFrame, seed: int, *parts: str) -> DataFrame:
    """Rows of each pool up to round(base * share). base_count: one row, base. shares: pool, share."""
    targets = shares.crossJoin(base_count).select(F.col("pool").alias("__pool"), F.bround(F.col("base") * F.col("share")).cast("long").alias("target"))
    wanted = pool.join(targets, F.col("pool") == F.col("__pool")).drop("__pool")
    return ranked_within(wanted, "pool", seed, *parts, most=F.col("target"))


def evaluation_caps(n_english: Column, n_swahili: Column, most: int = 500) -> Column:
    """Rows per group in the evaluation set."""
    return F.least(F.lit(most), F.greatest(F.lit(1), n_english), F.greatest(F.lit(1), F.when(F.coalesce(n_swahili, F.lit(0)) == 0, F.lit(1)).otherwise(n_swahili)))


def _turns(rows: DataFrame, group: str, turn: Column) -> Column:
    """The range of a turn: as many turns a range as make about 4,096 ranges of the largest group's rows, 100 at least."""
    largest = rows.groupBy(group).count().agg(F.max("count")).first()[0] or 0
    return F.floor(turn / max(100, largest // 4_096))


def by_value(rows: DataFrame, order: str, ranges: int = 256) -> Column:
    """The number of the range of a row's value, by quantiles of the values: ranges have about as many rows, however
    the values lie. The order's values are distinct; equal ones share a range."""
    cuts = rows.agg(F.percentile_approx(order, [k / ranges for k in range(1, ranges)], 10_000)).first()[0] or []
    cuts = sorted(set(cuts))

    def place(low: int, high: int) -> Column:
        """A tree of comparisons for the ranges low to high."""
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(F.col(order) <= cuts[middle], place(low, middle)).otherwise(place(middle + 1, high))

    return place(0, len(cuts))


def round_robin(rows: DataFrame, bucket: str, tokens: str, target: int, seed: int, *parts: str) -> DataFrame:
    """Rows taken in turns from the buckets until the tokens reach the target; the row that reaches it is the last."""
    ranked = ranked_within(rows, bucket, seed, *parts)
    summed = running(ranked, _turns(rows, bucket, F.col("place")), [F.col("place"), F.col(bucket)], F.col(tokens), "tokens_before")
    return summed.filter(F.col("tokens_before") < target)


def interleave(rows: DataFrame, kind: str, quota: dict[str, int], tokens: str, target: int, seed: int, *parts: str, least: int = 8) -> DataFrame:
    """Groups of quota rows of each kind (such as 3 raw and 1 chat) until the tokens reach the target.

    The floor is tested at the start of a group. Rows of fewer than `least` tokens use up their place and are dropped.
    """
    ranked = ranked_within(rows, kind, seed, *parts)
    per = F.create_map(*[x for k, n in quota.items() for x in (F.lit(k), F.lit(n))])
    grouped = ranked.withColumn("group_no", F.floor((F.col("place") - 1) / per[F.col(kind)])).withColumn("counted", F.when(F.col(tokens) >= least, F.col(tokens)).otherwise(0))
    sums = grouped.groupBy("group_no").agg(F.sum("counted").alias("__t"))
    before = running(sums, _turns(rows, kind, F.col("group_no")), [F.col("group_no")], F.col("__t"), "tokens_before").filter(F.col("tokens_before") < target).drop("__t")
    return grouped.join(before, "group_no").filter(F.col(tokens) >= least).drop("counted")


def chunks(rows: DataFrame, order: str, size: int = 1000) -> DataFrame:
    """Rows with the number of their chunk of a fixed size, by a numeric order."""
    placed = running(rows, by_value(rows, order), [F.col(order)], F.lit(1), "__before")
    return placed.withColumn("chunk_index", F.floor(F.col("__before") / size).cast("long")).drop("__before")


def head_holdout(rows: DataFrame, order: str, fraction: float = 0.1) -> DataFrame:
    """Rows with is_test for the first part by a numeric order, unshuffled."""
    total = rows.agg(F.count(F.lit(1)).alias("__n"))
    placed = running(rows, by_value(rows, order), [F.col(order)], F.lit(1), "__before").crossJoin(F.broadcast(total))
    return placed.withColumn("is_test", F.col("__before") < test_size(F.col("__n"), fraction)).drop("__before", "__n")


def chunk_need(tokens: Column, context: int, spare: int = 8) -> Column:
    """Chunks that a corpus fills, and some to spare."""
    return (F.ceil(tokens / context) + spare).cast("long")


def top_up(chosen: DataFrame, pool: DataFrame, key: str, floor_tokens: int, per_row: int = 600) -> DataFrame:
    """chosen, with the pool's other rows if chosen is estimated to be under the floor."""
    short = chosen.agg((F.count(F.lit(1)) * per_row < floor_tokens).alias("__short"))
    extra = pool.join(chosen.select(key), key, "left_anti").crossJoin(F.broadcast(short)).filter("__short").drop("__short")
    return chosen.unionByName(extra, allowMissingColumns=True)


def training_set(pools: DataFrame, shares: DataFrame, *, base: str, fractions: dict[str, float], seed: int, key: str = "source_id", legacy: bool = False, legacy_heldout: int = 250) -> DataFrame:
    """Rows with part: train, eval or heldout. pools: pool and key columns; shares: pool, share of the base pool.

    Each pool is split before it is mixed, and each pool's train rows are sampled to their share. Held-out rows come from
    the split; legacy leaves pools without a fraction unsplit and draws legacy_heldout rows of each from its training rows,
    as older runs did, which leaks.
    """
    fraction = F.lit(0.0)
    for pool, f in fractions.items():
        fraction = F.when(F.col("pool") == pool, f).otherwise(fraction)
    ranked = ranked_within(pools, "pool", seed, "pool", key)
    sizes = pools.groupBy("pool").agg(F.count(F.lit(1)).alias("__n")).withColumn("__test", F.when(fraction > 0, F.greatest(F.lit(1), F.bround(F.col("__n") * fraction))).otherwise(0).cast("long"))
    cut = ranked.join(sizes, "pool")
    train, test = cut.filter(F.col("place") > F.col("__test")), cut.filter(F.col("place") <= F.col("__test")).select(*pools.columns, F.lit("heldout").alias("part"))
    count = train.filter(F.col("pool") == base).agg(F.count(F.lit(1)).alias("base"))
    mixed = mixture(train.select(*pools.columns), count, shares, seed + 1, "pool", key).select(*pools.columns, F.lit("train").alias("part"))
    if not legacy:
        return mixed.unionByName(test)
    unsplit = mixed.filter(~F.col("pool").isin(*fractions)) if fractions else mixed
    leaked = ranked_within(unsplit, "pool", seed + 7, "pool", key, most=F.lit(legacy_heldout)).select(*pools.columns, F.lit("heldout").alias("part"))
    return mixed.unionByName(test).unionByName(leaked)
