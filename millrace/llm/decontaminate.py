"""Benchmark decontamination by spaced seeds; DataFrame functions only.

Texts become tokens: lower-cased runs of letters and digits, as 64-bit hashes. A mask such as 1101 keeps the tokens
under its ones and ignores those under its zeros, so a hash over the kept tokens still matches where an ignored one was
substituted. All windows of the benchmark and of the documents are hashed under every mask and joined. Hits of one
document and item on one diagonal (the shift between their positions) are one candidate. A candidate is verified on its
diagonal: some `overlap` aligned tokens in a row (all of an item that is shorter) must agree in at least `identity` of
their places.

The masks hit every overlap: whichever tokens the identity lets differ, some mask's window has none of them under its ones
(for overlap 13 and identity 0.75, and for whole items of 7 to 12 tokens). Items of under 7 tokens are too short for
substitutions: they must occur whole, and their seed is their whole token list.

The hashed benchmark windows are broadcast if they are counted to be at most `broadcast_rows`; beyond that the join
shuffles both sides. Documents are read again for verification only where they have hits.

Edge cases: null and empty texts, and items without a token, match nothing; documents that agree in id and text share one
decision and each keep a row; columns of any name pass through; an empty table on either side gives no contaminated
document. Texts are searched whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import broadcast_if, materialize, text_of, without

#: Masks of weight five that together survive any substitutions that the defaults allow.
MASKS = ("111011", "11001011", "11111", "101111", "11110001", "10100111", "11010101")
#: Items of fewer tokens are matched whole.
SHORT = 7
SEPARATORS = r"[^\p{L}\p{N}]+"


def tokens(text: Column) -> Column:
    """Hashes of a text's tokens; an empty string before the first or after the last separator counts as one more."""
    return F.transform(F.split(F.lower(text), SEPARATORS), lambda t: F.xxhash64(t))


def windows(rows: DataFrame, keys: list[str], masks: tuple[str, ...]) -> DataFrame:
    """keys, at, key: the hash of every window of rows' column h under every mask, with the window's first position."""
    shortest = min(map(len, masks))
    places = F.when(F.size("h") >= shortest, F.sequence(F.lit(0), F.size("h") - shortest)).otherwise(F.array().cast("array<int>"))
    at = rows.select(*keys, "h", F.explode(places).alias("at"))
    hashed = [F.when(F.col("at") + len(m) <= F.size("h"), F.xxhash64(F.lit(m), *[F.get("h", F.col("at") + o) for o, c in enumerate(m) if c == "1"])) for m in masks]
    return at.select(*keys, "at", F.explode(F.array(*hashed)).alias("key")).filter("key is not null")


def find_overlaps(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", masks: tuple[str, ...] = MASKS, overlap: int = 13, identity: float = 0.75, broadcast_rows: int = 2_000_000) -> DataFrame:
    """Verified overlaps, materialised: id, digest (of the text), item_id, shift, matched (agreeing tokens), length."""
    items = benchmark.select(F.col(item_col).alias("item_id"), F.filter(F.split(F.lower(text_of(item_text_col)), SEPARATORS), lambda t: t != "").alias("t"))
    items = materialize(items.select("item_id", F.transform("t", lambda t: F.xxhash64(t)).alias("h")), "benchmark-tokens")
    # at most SHORT - 1 lengths
    short = sorted(r[0] for r in items.select(F.size("h").alias("n")).filter(f"n between 1 and {SHORT - 1}").distinct().collect())
    seeds = windows(items.filter(F.size("h") >= SHORT), ["item_id"], masks)
    for n in short:
        seeds = seeds.unionByName(windows(items.filter(F.size("h") == n), ["item_id"], ("1" * n,)))
    seeds = materialize(seeds.distinct(), "benchmark-seeds").select(F.col("key").alias("seed"), "item_id", F.col("at").alias("item_at"))
    own = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("digest"), text_of(text_col).alias("text"))
    spread = windows(own.select("id", "digest", tokens(F.col("text")).alias("h")), ["id", "digest"], (*masks, *["1" * n for n in short if "1" * n not in masks]))
    hits = spread.join(broadcast_if(seeds, seeds.count(), broadcast_rows), F.col("key") == F.col("seed"))
    candidates = materialize(hits.select("id", "digest", "item_id", (F.col("at") - F.col("item_at")).alias("shift")).distinct(), "benchmark-hits")

    # candidates of one text and item are verified in one row
    grouped = candidates.groupBy("id", "digest", "item_id").agg(F.collect_list("shift").alias("shifts"))
    named = grouped.select(F.col("id").alias("c_id"), F.col("digest").alias("c_digest"), "item_id", "shifts")
    few_items = items.select(F.col("item_id").alias("i_id"), F.col("h").alias("ih"))
    with_items = materialize(named.join(broadcast_if(few_items, items.count(), broadcast_rows // 100), F.col("item_id").eqNullSafe(F.col("i_id"))), "benchmark-candidates")
    small = broadcast_if(with_items, with_items.count(), broadcast_rows // 100)
    joined = own.join(small, F.col("id").eqNullSafe(F.col("c_id")) & (F.col("digest") == F.col("c_digest")))
    compared = joined.select("id", "digest", "item_id", "shifts", "ih", tokens(F.col("text")).alias("h"))
    best = F.expr(
        f"""transform(shifts, shift -> named_struct('shift', shift, 'length', least({overlap}, size(ih)), 'matched',
            array_max(transform(array(transform(sequence(0, size(ih) - 1), k -> if(coalesce(get(h, k + shift) = get(ih, k), false), 1, 0))), e ->
                array_max(transform(sequence(0, size(e) - least({overlap}, size(e))), s -> aggregate(slice(e, s + 1, least({overlap}, size(e))), 0, (a, x) -> a + x)))))))"""
    )
    verified = compared.select("id", "digest", "item_id", F.explode(best).alias("b")).select("id", "digest", "item_id", "b.shift", "b.matched", "b.length")
    needed = F.when(F.col("length") < SHORT, F.col("length")).otherwise(F.lit(identity) * F.col("length"))
    return materialize(verified.filter(F.col("matched") >= needed).distinct(), "benchmark-overlaps")


def contaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """A row per document: doc_id, contaminated, items (sorted ids of the items it overlaps)."""
    found = find_overlaps(docs, benchmark, id_col=id_col, text_col=text_col, **options)
    by_text = found.groupBy(F.col("id").alias("f_id"), F.col("digest").alias("f_digest")).agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    keys = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("digest"))
    joined = keys.join(by_text, F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("digest") == F.col("f_digest")), "left")
    return joined.select("doc_id", F.col("items").isNotNull().alias("contaminated"), F.coalesce("items", F.array().cast("array<bigint>")).alias("items"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = 2_000_000, **options) -> DataFrame:
    """The documents that overlap no item, with their own columns."""
    found = find_overlaps(docs, benchmark, id_col=id_col, text_col=text_col, broadcast_rows=broadcast_rows, **options)
    return without(docs, found.select("id", "digest"), id_col, text_col, broadcast_rows)
