"""Mixing sources to target weights by a splitting tree over blocks; DataFrame operations only.

Sources get word targets by weighted water-filling. Each source is dealt into blocks by a seeded hash, `least_blocks` or
more, so that a source has dozens at any scale. A target of r times the source asks for floor(r) copies of every block,
and for the rest of whole blocks in a permuted order. What is left is filled document by document, from the block in
which the rest ends and the `POOL` blocks behind it. Every copy of a block is a ticket, and a source's tickets are its
exact quota. A tree splits the quotas among the output shards: in a node, the tickets are the balls of an urn, which a
seeded hash ranks; the first ones, as many as the left half of the shards asks, go left. So the numbers that the sources
send left are a draw from the multivariate hypergeometric law with the node's exact quotas, and no block copy goes to two
shards. Each shard takes the documents of its tickets, in the order of another seeded hash; a document's taken words are
those that the shards took.

Edge cases: null and empty texts have size 0 and are taken 0 words; null sources form one source, last in order; rows
that agree in id, source and text (repeated rows) share one decision, and rows that agree in id alone don't; columns of
any name pass through; an empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import broadcast_if, materialize, spare, word_count

#: Ranks inside a group are found in this many hash ranges, so that no task sorts all of a group.
RANGES = 1024
#: Blocks behind the cut one from whose documents the last words of a source are filled, and the passes that do so.
POOL, PASSES = 7, 4


def before(rows: DataFrame, group: str, key: Column, ties: list[str], values: dict[str, Column]) -> DataFrame:
    """rows with the sums of values over the rows of their group before them, in the order of a hash."""
    keyed = rows.withColumn("key", key).withColumn("range", F.pmod(F.shiftrightunsigned("key", 40), F.lit(RANGES)))
    in_group = Window.partitionBy(group).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = keyed.groupBy(group, "range").agg(*[F.sum(v).alias(f"sum_{n}") for n, v in values.items()])
    sums = sums.select(group, "range", *[F.coalesce(F.sum(f"sum_{n}").over(in_group), F.lit(0)).alias(f"ahead_{n}") for n in values])
    in_range = Window.partitionBy(group, "range").orderBy("key", *ties).rowsBetween(Window.unboundedPreceding, -1)
    near = keyed.select("*", *[F.coalesce(F.sum(v).over(in_range), F.lit(0)).alias(f"near_{n}") for n, v in values.items()])
    return near.join(sums, [group, "range"]).select(*rows.columns, *[(F.col(f"ahead_{n}") + F.col(f"near_{n}")).alias(n) for n in values])


def source_targets(sized: DataFrame, weights: Sequence[int], share: float, cap: float) -> DataFrame:
    """(sid, source, n_docs, source_size, target): weighted shares of share * all words, none above cap * its own words.

    Sources are ordered by cap * size / weight. If the first i - 1 are full, the level of the rest is
    (total - their caps) / remaining weight; that level rises while sources still fill up and falls after, so its
    maximum is the level at which nothing is left over. The window has one row a source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    sources = sized.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size"))
    weighted = sources.withColumn("rank", F.row_number().over(by_name)).withColumn(
        "weight",
        F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int")),
    )
    everything = Window.orderBy(F.col("cap") / F.col("weight"), F.col("rank"))
    before = everything.rowsBetween(Window.unboundedPreceding, -1)
    whole = everything.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = weighted.withColumn("cap", F.col("source_size") * F.lit(float(cap))).select(
        "source",
        "n_docs",
        "source_size",
        "weight",
        "cap",
        ((F.sum("source_size").over(whole) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))).alias("level"),
        F.col("rank"),
    )
    best = level.withColumn("best", F.max("level").over(whole))
    return best.select(F.col("rank").cast("long").alias("sid"), "source", "n_docs", "source_size", F.least(F.col("cap"), F.col("best") * F.col("weight")).cast("double").alias("target"))


def split_tickets(tickets: DataFrame, shards: int, seed: int) -> DataFrame:
    """Add shard to tickets (source, block, copy, part): the tree, one level after another."""
    levels = max(0, (shards - 1).bit_length())
    out = tickets.select("source", "block", "copy", "part", F.lit(0).alias("lo"), F.lit(shards).alias("hi"))
    for level in range(levels):
        key = F.xxhash64(F.lit(seed), F.lit(level), F.col("lo"), F.col("source"), F.col("block"), F.col("copy"))
        totals = out.groupBy("lo").agg(F.count(F.lit(1)).alias("in_node"))
        ranked = before(out, "lo", key, ["source", "block", "copy"], {"place": F.lit(1)}).join(totals, "lo")
        half = F.floor((F.col("hi") - F.col("lo")) / 2).cast("int")
        left = F.round(F.col("in_node") * half / (F.col("hi") - F.col("lo"))).cast("long")
        single = (F.col("hi") - F.col("lo")) == 1
        goes_left = F.col("place") < left
        lo, hi = F.when(single | goes_left, F.col("lo")).otherwise(F.col("lo") + half), F.when(single | ~goes_left, F.col("hi")).otherwise(F.col("lo") + half)
        # written, as the next level reads it three times
        out = materialize(ranked.select("source", "block", "copy", "part", lo.alias("lo"), hi.alias("hi")), "mix-level")
    return out.select("source", "block", "copy", "part", F.col("lo").alias("shard"))


def filled(rows: DataFrame) -> DataFrame:
    """The rows that fill a gap of words best. rows: sid, gap, cut (whether the row is of the cut block), words, order.

    The first pass takes the cut block in its order as far as it fits, the others what still fits, longest first. At
    last the shortest row left is taken if the source is nearer to its target with it.
    """
    whole = Window.partitionBy("sid")
    out = rows.select("*", F.lit(False).alias("chosen"))
    for turn in range(PASSES):
        fits = ~F.col("chosen") & (F.col("words") <= F.col("gap")) & (F.col("cut") if turn == 0 else F.lit(True))
        order = ["order", "id", "key"] if turn == 0 else [F.col("words").desc(), "order", "id", "key"]
        out = out.withColumn("fits", fits).withColumn("end", F.sum(F.when(F.col("fits"), F.col("words"))).over(whole.orderBy(F.col("fits").desc(), *order).rowsBetween(Window.unboundedPreceding, 0)))
        out = out.withColumn("fits", F.col("fits") & (F.col("end") <= F.col("gap")))
        out = out.withColumn("gap", F.col("gap") - F.coalesce(F.sum(F.when(F.col("fits"), F.col("words"))).over(whole), F.lit(0))).withColumn("chosen", F.col("chosen") | F.col("fits"))
    last = F.row_number().over(whole.orderBy("chosen", "words", "order", "id", "key"))
    out = out.withColumn("last", last)
    return out.filter(F.col("chosen") | ((F.col("last") == 1) & (F.col("words") < 2 * F.col("gap"))))


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    cap: float = 2.0,
    shards: int = 8,
    block_words: int = 1_000_000,
    block_docs: int = 16_384,
    least_blocks: int = 48,
    seed: int = 20_240_917,
) -> tuple[DataFrame, DataFrame]:
    """(sized, picks). sized: a row per document with id, key, size, source_size, target. picks: a row for each time a
    shard takes a document, with id, key, size, copy, shard and order_key (the order inside the shard). key is a digest
    of source and text."""
    sized = docs.select(F.col(id_col).alias("id"), F.xxhash64(source_col, text_col).alias("key"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    sized = materialize(sized, "mix-sizes")
    targets = materialize(source_targets(sized, weights, share, cap), "mix-targets")
    blocks_of = F.greatest(F.ceil(F.col("source_size") / F.lit(block_words)), F.ceil(F.col("n_docs") / F.lit(block_docs)), F.lit(least_blocks)).cast("long")
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    plan = targets.select("sid", F.col("source").alias("p_source"), "source_size", "target", blocks_of.alias("n_blocks"), full.alias("full"), (F.col("target") - full * F.col("source_size")).alias("rest"))
    plan = broadcast_if(plan, targets.count(), 100_000)
    placed = sized.join(plan, F.col("source").eqNullSafe(F.col("p_source"))).filter("size > 0").groupBy("id", "key").agg(
        F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in ("size", "sid", "n_blocks", "full", "rest")]
    )  # repeated rows are one key that counts n times
    placed = placed.withColumn("order", F.xxhash64(F.lit(seed), "id", "key")).withColumn("block", F.pmod(F.xxhash64(F.lit(seed + 1), "order"), "n_blocks"))
    placed = materialize(placed.select("id", "key", "size", (F.col("size") * F.col("n")).alias("words"), "sid", "block", "order", "full", "rest"), "mix-blocks")

    blocks = placed.groupBy("sid", "block").agg(F.sum("words").alias("words"), F.first("full").alias("full"), F.first("rest").alias("rest"))
    blocks = before(blocks, "sid", F.xxhash64(F.lit(seed + 2), "sid", "block"), ["block"], {"words_before": F.col("words"), "place": F.lit(1)})
    blocks = materialize(blocks.withColumn("left", F.col("rest") - F.col("words_before")), "mix-plan")
    in_rest = F.col("left") >= F.col("words")
    copies = F.col("full") + in_rest.cast("int")
    tickets = blocks.filter(copies > 0).select(F.col("sid").alias("source"), "block", F.explode(F.sequence(F.lit(1), copies)).alias("copy"), F.lit(False).alias("part"))

    # one block of a source at most has the end of its rest in it
    cut = blocks.filter((F.col("left") > 0) & ~in_rest).select(F.col("sid").alias("c_sid"), F.col("place").alias("c_place"), F.col("left").cast("double").alias("gap"))
    pool = blocks.join(cut, F.col("sid") == F.col("c_sid")).filter((F.col("place") >= F.col("c_place")) & (F.col("place") <= F.col("c_place") + POOL))
    pool = pool.select(F.col("sid").alias("b_sid"), F.col("block").alias("b_block"), (F.col("place") == F.col("c_place")).alias("cut"), "gap")
    near = placed.join(pool, (F.col("sid") == F.col("b_sid")) & (F.col("block") == F.col("b_block")))
    partly = materialize(filled(near.select("id", "key", "size", "words", "sid", "block", "order", "full", "cut", "gap")).select("id", "key", "size", "sid", "block", "order", "full"), "mix-filled")
    parts = partly.groupBy("sid", "block").agg(F.first("full").alias("full")).select(F.col("sid").alias("source"), "block", (F.col("full") + 1).alias("copy"), F.lit(True).alias("part"))

    tickets = materialize(split_tickets(tickets.unionByName(parts), shards, seed), "mix-tickets")
    t = tickets.select(*[F.col(c).alias(f"t_{c}") for c in tickets.columns])
    on = (F.col("sid") == F.col("t_source")) & (F.col("block") == F.col("t_block"))
    columns = ["id", "key", "size", "sid", "block", "order"]
    taken = placed.select(*columns).join(t.filter("not t_part"), on).unionByName(partly.select(*columns).join(t.filter("t_part"), on))
    picks = taken.select("id", "key", "size", F.col("t_copy").alias("copy"), F.col("t_shard").alias("shard"), F.xxhash64(F.lit(seed + 3), "t_shard", "order", "t_copy").alias("order_key"))
    return sized.join(plan, F.col("source").eqNullSafe(F.col("p_source"))).select("id", "key", "size", "source_size", "target"), picks


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """A row per document: doc_id, size, source_size, target, taken (words the shards take, repeats counted), shards
    (their numbers, ascending)."""
    sized, picks = mix(docs, **options)
    copies = range(1, ceil(options.get("cap", 2.0)) + 1)
    in_copy = [F.max(F.when(F.col("copy") == k, F.col("shard"))).alias(f"shard_{k}") for k in copies]
    by_row = picks.groupBy(F.col("id").alias("t_id"), F.col("key").alias("t_key")).agg(F.sum("size").alias("words"), *in_copy)
    joined = sized.join(by_row, F.col("id").eqNullSafe(F.col("t_id")) & (F.col("key") == F.col("t_key")), "left")
    shards = F.array_join(F.array_sort(F.array_compact(F.array(*[F.col(f"shard_{k}") for k in copies]))), ",")
    return joined.select(F.col("id").alias("doc_id"), "size", "source_size", "target", F.coalesce("words", F.lit(0)).cast("long").alias("taken"), shards.alias("shards"))


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents with their own columns, each as many times as it is taken: shard after shard, and inside a
    shard in its seeded order. Partitions are ranges of that order, so that a shard is read from any number of them."""
    id_col, text_col, source_col = (options.get(k, v) for k, v in (("id_col", "doc_id"), ("text_col", "text"), ("source_col", "source")))
    _, picks = mix(docs, **options)
    own_id, own_key, shard, order = spare(docs, "pick_id", "pick_key", "pick_shard", "pick_order")
    p = materialize(picks.select(F.col("id").alias(own_id), F.col("key").alias(own_key), F.col("shard").alias(shard), F.col("order_key").alias(order)), "mix-picks")
    on = docs[id_col].eqNullSafe(F.col(own_id)) & (F.xxhash64(docs[source_col], docs[text_col]) == F.col(own_key))
    joined = docs.join(broadcast_if(p, p.count(), 500_000), on)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return joined.repartitionByRange(parts, shard, order).sortWithinPartitions(shard, order).drop(own_id, own_key, shard, order)
