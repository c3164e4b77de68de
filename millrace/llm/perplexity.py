"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of character n-grams.

Model. Trusted texts (labelled good and not toxic) are counted in n-grams of `ORDER` symbols; a symbol is a lower-cased
character of 12 bits, with white space as one blank, digits as one symbol, and code points from 3072 up folded into 1023
symbols, so that an n-gram of five is one exact long. Continuation counts of the shorter orders, count-of-count
discounts, context totals and back-off weights are aggregations and joins of these count tables. Three models come from
two tables of n-gram counts: of the half of each language's trusted documents with the smallest hashes of their ids, of
the other half, and of all of them, whose counts are the sums. The model of all judges the other documents; a trusted one
is judged by the model of the half that it isn't in. So every trusted text is counted, and every one's score is that of a
text its model has not seen, which the quantiles need. `per_lang` bounds the counted ones for a caller who wants that: then
one model of these judges all, and the other trusted documents set the quantiles.

Scoring. Documents are dealt to blocks by a hash of id and text. Each block asks once for each distinct n-gram of its
documents; the requests are dealt to shards by the last two symbols of the context, which all the counts that an n-gram
needs share (unigram and bigram tables are small and go to every shard). Each shard joins its requests with its part of
the count tables and answers with log probabilities, and the block, joined with its answers, sums them per document.
So each block sends its n-gram types, not its tokens, and nothing is sent to all tasks. A larger model has more shards,
and with more blocks a shard's requests are split into more slices, each of which gets a copy of the shard. A block's
documents are judged by one model; each model has shards of its own.

Decision. The score is the mean negative log probability of a symbol, drawn towards the language's trusted mean by
`prior` symbols, so that a few words can't be far out. A second score sees short bad passages that the mean dilutes: the
largest mean over `passage` symbols in a row, a shorter text filled up with the trusted mean. A document is kept if its
score is between two quantiles of the trusted documents of its language, and its passage score is at most their upper
quantile. A quantile is the exact value at its place: a sketch only tells which values need to be counted. With `per_lang`
the lower quantile isn't asked of the counted documents, whose perplexity is low for having been counted.

Edge cases: null and empty texts have no score and are rejected; a null language is one language; languages with fewer
than `min_trusted` trusted documents use the quantiles of all; with no trusted text, or none in the second half, nothing
is scored against, and every document with text is kept; repeated rows each keep a row; labels given twice must agree to count as trusted;
an empty table gives an empty result; columns of any name pass through.
"""

from __future__ import annotations

import bisect
import functools
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import broadcast_if, materialize, release_memory, text_of, without

ORDER, BITS = 5, 12
#: Shards of a model of up to SHARDS * SHARD_ROWS rows; a larger one has a multiple of them.
SHARDS, SHARD_ROWS = 64, 32_768
BLOCK_CHARS = 2_000_000
#: Tables up to this many cells are indexed directly; beyond it by sorting.
DENSE = 1 << 23
#: Symbols of a passage.
PASSAGE = 80
#: Log probabilities travel as whole multiples of its inverse.
SCALE = 2_048
_table = None


def symbol_table() -> np.ndarray:
    """Symbols of the code points below 3072."""
    global _table
    if _table is None:
        _table = np.arange(3072, dtype=np.uint16)
        for code in range(3072):
            char = chr(code)
            if char.isspace() or code < 32:
                _table[code] = 32
            elif char.isdigit():
                _table[code] = 48
        _table[0] = 0
    return _table


def plain(text: str | None) -> str:
    """A text as it is counted; symbols() takes such texts."""
    return (text or "").lower().replace("\0", " ")


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as symbols, ORDER - 1 zeros before each; and each text's length."""
    gap = "\0" * (ORDER - 1)
    joined = gap + gap.join(texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    folded = np.where(codes < 3072, codes, 3072 + 1 + codes % 1022).astype(np.uint16)
    low = folded < 3072
    folded[low] = symbol_table()[folded[low]]
    return folded, np.array([len(t) for t in texts], np.int64)


def compact(index: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of index, ascending, and each element's place among them."""
    if size <= DENSE:
        present = np.zeros(size, bool)
        present[index] = True
        values = np.flatnonzero(present)
        place = np.zeros(size, np.int32)
        place[values] = np.arange(len(values), dtype=np.int32)
        return values, place[index]
    values, places = np.unique(index, return_inverse=True)
    return values, places.astype(np.int32)


def ngrams(stream: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams of a stream of symbols as longs, and for each of their positions its place among them and its
    index in the stream. The distinct n-grams depend on the set of texts, not on their order."""
    alphabet, ranks = compact(stream.astype(np.int64), 1 << BITS)
    at = np.flatnonzero(stream[ORDER - 1 :] != 0) + ORDER - 1
    base = len(alphabet)
    keys = alphabet.astype(np.int64)
    ids = ranks[at - ORDER + 1]
    for step in range(ORDER - 2, -1, -1):
        values, ids = compact(ids.astype(np.int64) * base + ranks[at - step], max(1, len(keys) * base))
        keys = (keys[values // base] << BITS) | alphabet[values % base]
    return keys, ids, at


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of n-grams, by the last two symbols of their context (24 bits, so that the product fits a long)."""
    context = (keys >> BITS) & ((1 << 2 * BITS) - 1)
    return ((context * 2_654_435_761) >> 20) % shards


def shard_column(context: str, shards: int) -> Column:
    """shard_of for a column with the last two symbols of a context."""
    return F.pmod(F.shiftright(F.col(context) * F.lit(2_654_435_761), 20), F.lit(shards)).cast("int")


def pack(values: np.ndarray) -> bytes:
    return zlib.compress(values.tobytes(), 1)


def unpack(data: bytes, dtype: str) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), dtype)


def ngram_counts(texts: DataFrame) -> DataFrame:
    """The n-grams of all given texts (column text): key, c."""

    def count(batches):
        for batch in batches:
            stream, _ = symbols([plain(t) for t in batch.column(0).to_pylist()])
            keys, ids, _ = ngrams(stream)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(np.bincount(ids, minlength=len(keys)), pa.int64())], names=["key", "c"])

    return materialize(texts.select("text").mapInArrow(count, "key long, c long").groupBy("key").agg(F.sum("c").alias("c")), "kn-ngrams")


def fit(texts: DataFrame) -> DataFrame:
    """The model of all given texts (column text)."""
    return estimated(ngram_counts(texts))


def counted(model: DataFrame) -> DataFrame:
    """The n-gram counts that a model was estimated from."""
    return model.filter((F.col("kind") == "a") & (F.col("order") == ORDER)).select("key", "c")


def estimated(ngrams_of: DataFrame) -> DataFrame:
    """The model of n-gram counts (key, c): order, key, value, c; kind a has the n-gram's own share of the probability and
    its count, kind g, for contexts, the share of the shorter order. Shards are set for both."""
    counts = ngrams_of.select(F.lit(ORDER).alias("order"), "key", "c")
    tables = [counts]
    for order in range(ORDER - 1, 0, -1):
        shorter = F.col("key").bitwiseAND(F.lit((1 << BITS * order) - 1))
        counts = materialize(counts.groupBy(shorter.alias("key")).agg(F.count(F.lit(1)).alias("c")).select(F.lit(order).alias("order"), "key", "c"), "kn-counts")
        tables.append(counts)
    everything = tables[0]
    for t in tables[1:]:
        everything = everything.unionByName(t)
    # four numbers an order: the count-of-counts that set its discounts
    spectrum = {r["order"]: [r[f"n{k}"] for k in range(1, 5)] for r in everything.groupBy("order").agg(*[F.count_if(F.col("c") == k).alias(f"n{k}") for k in range(1, 5)]).collect()}
    discount = F.lit(0.0)
    for order, n in spectrum.items():
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
        d = [min(max(k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else k * 0.5, 0.05), float(k)) for k in (1, 2, 3)]
        own = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
        discount = F.when(F.col("order") == order, own).otherwise(discount)
    entries = everything.withColumn("d", discount).withColumn("context", F.shiftright("key", BITS))
    contexts = entries.groupBy("order", "context").agg(F.sum("c").alias("total"), F.sum("d").alias("held"))
    alphas = entries.join(contexts.drop("held"), ["order", "context"]).select(F.lit("a").alias("kind"), "order", "key", ((F.col("c") - F.col("d")) / F.col("total")).alias("value"), "c")
    gammas = contexts.select(F.lit("g").alias("kind"), "order", F.col("context").alias("key"), (F.col("held") / F.col("total")).alias("value"), F.lit(None).cast("long").alias("c"))
    model = materialize(alphas.unionByName(gammas), "kn-model")
    last_two = F.when(F.col("kind") == "a", F.shiftright("key", BITS)).otherwise(F.col("key")).bitwiseAND(F.lit((1 << 2 * BITS) - 1))
    everywhere = F.col("order") <= 2
    count = SHARDS * max(1, -(-model.filter(~everywhere).count() // (SHARDS * SHARD_ROWS)))
    shards = F.when(everywhere, F.sequence(F.lit(0), F.lit(count - 1))).otherwise(F.array(shard_column("last_two", count)))
    return materialize(model.withColumn("last_two", last_two).select("kind", "order", "key", "value", "c", F.explode(shards).alias("shard")), "kn-shards")


def probabilities(keys: np.ndarray, model: pa.Table) -> np.ndarray:
    """Natural logarithms of the interpolated probabilities of n-grams, from their shard's part of the model."""
    kind, order, key, value = (model.column(c).to_numpy(zero_copy_only=False) for c in ("kind", "order", "key", "value"))

    def look(which: str, k: int, wanted: np.ndarray, missing: float) -> np.ndarray:
        own = (kind == which) & (order == k)
        ks, vs = key[own], value[own]
        if not len(ks):
            return np.full(len(wanted), missing)
        by = np.argsort(ks)
        ks, vs = ks[by], vs[by]
        at = np.minimum(np.searchsorted(ks, wanted), len(ks) - 1)
        return np.where(ks[at] == wanted, vs[at], missing)

    p = np.full(len(keys), 1.0 / (1 << BITS))
    for k in range(1, ORDER + 1):
        gram = keys & ((1 << BITS * k) - 1)
        share = look("g", k, gram >> BITS, 1.0)
        p = look("a", k, gram, 0.0) + share * p
    return np.log(p)


def peaks(summed: np.ndarray, starts: np.ndarray, lengths: np.ndarray, size: int) -> np.ndarray:
    """The largest summed negative log probability of size symbols in a row, of a shorter text that of all; summed has
    the log probabilities before each place of the stream."""
    padded = np.concatenate([summed, np.full(size + 1, summed[-1])])
    passages = padded[:-size] - padded[size:]
    stops = starts + np.maximum(lengths - size, 0) + 1
    largest = np.maximum.reduceat(passages, np.stack([starts, stops], 1).ravel())[::2]
    return np.where(lengths < size, summed[starts] - summed[starts + lengths], largest)


def scores(docs: DataFrame, *models: DataFrame, id_col: str, text_col: str, keep: tuple[str, ...] = (), passage: int = PASSAGE, by: Column | None = None) -> DataFrame:
    """A row per document: id, the kept columns, nll (summed negative log probability), peak (that of the
    passage where it is largest), n (symbols). by tells which of the models judges a document, 0 the first."""
    own = docs.select(F.col(id_col).alias("id"), *keep, text_of(text_col).alias("text"), (F.lit(0) if by is None else by).alias("model"))
    totals = {r["model"]: r["size"] or 0 for r in own.groupBy("model").agg(F.sum(F.octet_length("text")).alias("size")).collect()}
    # each model's blocks, shards, and slices of a shard; blocks and slots of a model follow those of the one before
    blocks = [max(1, -(-totals.get(m, 0) // BLOCK_CHARS)) for m in range(len(models))]
    # unigrams are in every shard, so that the last one has rows
    lasts = [model.agg(F.max("shard")).first()[0] for model in models]
    shards = [SHARDS if last is None else last + 1 for last in lasts]
    slices = [max(1, b * SHARDS // (256 * s)) for b, s in zip(blocks, shards)]
    first_block = [sum(blocks[:m]) for m in range(len(models))]
    first_slot = [sum(s * n for s, n in zip(shards[:m], slices[:m])) for m in range(len(models))]
    keep_fields = [f for f in own.schema.fields if f.name in keep]
    types = f"block long, id {own.schema['id'].dataType.simpleString()}, " + "".join(f"{f.name} {f.dataType.simpleString()}, " for f in keep_fields) + "data binary"

    def squeeze(batches):
        squeezed = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            data = pa.array((squeezed.compress(plain(t.as_py()).encode("utf-8", "surrogatepass")) for t in batch.column("text")), pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("block", "id", *keep)), data], names=["block", "id", *keep, "data"])
        release_memory()

    among = F.lit(None).cast("long")
    for m, (b, at) in enumerate(zip(blocks, first_block)):
        among = F.when(F.col("model") == m, F.pmod(F.xxhash64("id", "text"), F.lit(b)) + at).otherwise(among)
    blocked = own.withColumn("block", among)
    dealt = blocked.select("block", "id", *keep, "text").mapInArrow(squeeze, types)

    def texts_of(table: pa.Table) -> list[str]:
        return [zstandard.decompress(x.as_py()).decode("utf-8", "surrogatepass") for x in table.column("data")]

    def block_of(table: pa.Table) -> tuple[int, int]:
        """The block of a table's rows, and its model."""
        block = table.column("block")[0].as_py() if len(table) else 0
        return block, bisect.bisect_right(first_block, block) - 1

    def request(table: pa.Table) -> pa.Table:
        stream, _ = symbols(texts_of(table))
        keys, _, _ = ngrams(stream)
        block, m = block_of(table)
        shard = shard_of(keys, shards[m])
        found = [(block, int(s), first_slot[m] + int(s) * slices[m] + block % slices[m], pack(np.diff(np.sort(keys[shard == s]), prepend=0))) for s in np.unique(shard)]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*found) if found else [[]] * 4, (pa.int64(), pa.int32(), pa.int64(), pa.binary()))], names=["block", "shard", "slot", "keys"])

    def answer(asked: pa.Table, part: pa.Table) -> pa.Table:
        wanted = [np.cumsum(unpack(x, "<i8")) for x in asked.column("keys").to_pylist()]
        if not wanted:
            values: list[np.ndarray] = []
        else:
            distinct, places = np.unique(np.concatenate(wanted), return_inverse=True)
            scaled = np.round(probabilities(distinct, part) * -SCALE).clip(0, 65_535).astype("<u2")
            values = np.split(scaled[places], np.cumsum([len(w) for w in wanted])[:-1])
        return pa.table([asked.column("block"), asked.column("shard"), pa.array([pack(v) for v in values], pa.binary())], names=["block", "shard", "values"])

    def total_up(table: pa.Table, answers: pa.Table) -> pa.Table:
        stream, lengths = symbols(texts_of(table))
        keys, ids, at = ngrams(stream)
        shard, logs = shard_of(keys, shards[block_of(table)[1]]), np.zeros(len(keys))
        by_key = np.argsort(keys, kind="stable")
        for s, data in zip(answers.column("shard").to_pylist(), answers.column("values").to_pylist()):
            logs[by_key[shard[by_key] == s]] = unpack(data, "<u2") / -SCALE
        summed = np.zeros(len(stream) + 1)
        summed[at + 1] = logs[ids]
        summed = np.cumsum(summed)
        starts = np.cumsum(lengths + ORDER - 1) - lengths
        nll = summed[starts] - summed[starts + lengths]
        peak = peaks(summed, starts, lengths, passage)
        release_memory()
        return pa.table([table.column("id"), *[table.column(c) for c in keep], pa.array(nll), pa.array(peak), pa.array(lengths)], names=["id", *keep, "nll", "peak", "n"])

    asked = dealt.groupBy("block").applyInArrow(request, "block long, shard int, slot long, keys binary")
    slots = lambda n, at: F.sequence((F.col("shard") * n + at).cast("long"), (F.col("shard") * n + (at + n - 1)).cast("long"))
    copies = [model.select("kind", "order", "key", "value", F.explode(slots(n, at)).alias("slot")) for model, n, at in zip(models, slices, first_slot)]
    spread = functools.reduce(DataFrame.unionByName, copies)
    answers = asked.groupBy("slot").cogroup(spread.groupBy("slot")).applyInArrow(answer, "block long, shard int, values binary")
    out = f"id {own.schema['id'].dataType.simpleString()}, " + "".join(f"{f.name} {f.dataType.simpleString()}, " for f in keep_fields) + "nll double, peak double, n long"
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(total_up, out)


def counted_half(trusted: DataFrame, per_lang: int | None = None) -> DataFrame:
    """The rows (doc_id, lang) of the first half, or that the only model counts: the smaller hashes of each language, half of them, rounded up.
    Places come from counts of ranges of the hash and a window inside each range."""
    keyed = trusted.withColumn("hash", F.xxhash64("doc_id")).withColumn("range", F.shiftright("hash", 52))
    ranges = keyed.groupBy(F.col("lang").alias("r_lang"), F.col("range").alias("r_range")).agg(F.count(F.lit(1)).alias("rows"))
    of_lang = Window.partitionBy("r_lang")
    before = F.coalesce(F.sum("rows").over(of_lang.orderBy("r_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    half = F.ceil(F.sum("rows").over(of_lang) / 2)
    ranges = ranges.select("r_lang", "r_range", before.alias("before"), (half if per_lang is None else F.least(half, F.lit(per_lang))).alias("wanted"))
    joined = keyed.join(ranges, F.col("lang").eqNullSafe(F.col("r_lang")) & (F.col("range") == F.col("r_range"))).filter(F.col("before") < F.col("wanted"))
    inside = F.row_number().over(Window.partitionBy("lang", "range").orderBy("hash", "doc_id"))
    return joined.withColumn("place", F.col("before") + inside).filter(F.col("place") <= F.col("wanted")).select("doc_id", "lang")


def quantiles(rows: DataFrame, group: list[str], wanted: list[tuple[str, float, str]], same: list[str], margin: float = 0.001) -> DataFrame:
    """A row per group: the columns that are the same in its rows, and for each (column, quantile, name) the value at
    place ceil(quantile * rows), 1 at least, in ascending order. A sketch gives two values around the place; the rows
    below them are counted, and the values between them are ordered."""
    around = []
    for of, q, name in wanted:
        around.append((F.percentile_approx(of, F.lit(q - margin), 10_000) if q > margin else F.min(of)).alias(f"{name}_from"))
        around.append((F.percentile_approx(of, F.lit(q + margin), 10_000) if q + margin < 1 else F.max(of)).alias(f"{name}_to"))
    sketch = materialize(rows.groupBy(*group).agg(F.count(F.lit(1)).alias("rows"), *[F.first(c).alias(c) for c in same], *around), "sketch")
    key = [F.col(c).alias(f"k_{c}") for c in group]
    on = lambda: [F.col(c).eqNullSafe(F.col(f"k_{c}")) for c in group]
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), F.col(of).alias("value"), F.greatest(F.lit(1), F.ceil(F.lit(q) * F.col("rows"))).alias("place"), F.col(f"{name}_from").alias("from"), F.col(f"{name}_to").alias("to")) for of, q, name in wanted]))
    valued = rows.select(*group, *{of for of, _, _ in wanted}).join(sketch.select(*key, "rows", *[f"{n}_{e}" for _, _, n in wanted for e in ("from", "to")]), on()).select(*group, each.alias("x")).select(*group, "x.*").filter(F.col("value") <= F.col("to"))
    counts = valued.groupBy(*group, "name", "place", F.when(F.col("value") >= F.col("from"), F.col("value")).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    # the rows below the first value come first, as null
    up_to = F.sum("n").over(Window.partitionBy(*group, "name").orderBy(F.asc_nulls_first("value")))
    reached = counts.withColumn("up_to", up_to).filter((F.col("up_to") >= F.col("place")) & F.col("value").isNotNull())
    least = reached.groupBy(*key).agg(*[F.min(F.when(F.col("name") == name, F.col("value"))).alias(name) for _, _, name in wanted])
    return sketch.join(least, on()).select(*group, *same, *[name for _, _, name in wanted])


def classify(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int | None = None, low: float = 0.005, high: float = 0.995, prior: int = 100, min_trusted: int = 30, passage: int = PASSAGE, broadcast_rows: int = 3_000_000) -> DataFrame:
    """A row per document: doc_id, digest (of the text), perplexity (per symbol; null without text), score, passage
    (the score of the worst passage), kept."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.xxhash64(text_col).alias("digest"), F.col(text_col).alias("text"))
    good = labels.groupBy(F.col("doc_id").alias("l_id")).agg(F.min("quality").alias("q"), F.max("toxic").alias("t")).filter("q = 1 and t = 0").select("l_id")
    trusted = materialize(own.select("doc_id", "lang").join(good, F.col("doc_id") == F.col("l_id")).select("doc_id", "lang").distinct(), "trusted")
    sample = materialize(counted_half(trusted, per_lang).select(F.col("doc_id").alias("s_id")).distinct(), "trusted-counted")
    # half 0 is counted by the first model, half 1 by the second
    halves = trusted.select(F.col("doc_id").alias("t_id")).distinct().join(sample, F.col("t_id") == F.col("s_id"), "left")
    halves = materialize(halves.select("t_id", F.when(F.col("s_id").isNotNull(), 0).otherwise(1).alias("half")), "trusted-halves")
    n_of = {r["half"]: r["count"] for r in halves.groupBy("half").count().collect()}
    with_half = own.join(broadcast_if(halves, sum(n_of.values()), broadcast_rows), F.col("doc_id") == F.col("t_id"), "left").select(*own.columns, "half")
    models = [fit(with_half.filter("half = 0").select("text"))]
    crossed = per_lang is None and n_of.get(1, 0) > 0
    if crossed:
        rest = ngram_counts(with_half.filter("half = 1").select("text"))
        every_text = counted(models[0]).unionByName(rest).groupBy("key").agg(F.sum("c").alias("c"))
        models += [estimated(rest), estimated(materialize(every_text, "kn-ngrams"))]
    judge = F.coalesce(1 - F.col("half"), F.lit(2)) if crossed else F.lit(0)
    scored = materialize(scores(with_half, *models, id_col="doc_id", text_col="text", keep=("lang", "digest", "half"), passage=passage, by=judge), "perplexities")

    held = scored.filter("n > 0").filter("half is not null" if crossed else "half = 1")
    held = materialize(held.select("lang", "nll", "peak", "n"), "trusted-scores")
    means = held.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"), (F.sum("nll") / F.sum("n")).alias("mean"))
    every = held.agg(F.count(F.lit(1)).alias("docs"), (F.sum("nll") / F.sum("n")).alias("mean"))
    drawn = lambda mean: (F.col("nll") + prior * mean) / (F.col("n") + prior)
    filled = lambda mean: (F.col("peak") + F.greatest(F.lit(passage) - F.col("n"), F.lit(0)) * mean) / passage
    by_lang = held.join(means.withColumnRenamed("lang", "m_lang"), F.col("lang").eqNullSafe(F.col("m_lang"))).withColumn("all", F.lit(False))
    overall = held.crossJoin(F.broadcast(every)).withColumn("all", F.lit(True)).withColumn("lang", F.lit(None).cast(held.schema["lang"].dataType))
    both = by_lang.unionByName(overall, allowMissingColumns=True).select("all", "lang", "docs", "mean", drawn(F.col("mean")).alias("score"), filled(F.col("mean")).alias("passage"))
    found = materialize(quantiles(materialize(both, "trusted-both"), ["all", "lang"], [("score", low, "lo"), ("score", high, "hi"), ("passage", high, "worst")], ["docs", "mean"]), "quantiles")
    bounds = found.filter(~F.col("all") & (F.col("docs") >= min_trusted)).select(F.col("lang").alias("b_lang"), "mean", "lo", "hi", "worst")
    fallback = found.filter("all").first()
    either = lambda name: F.coalesce(F.col(name), F.lit(fallback[name] if fallback else None).cast("double"))
    joined = scored.join(bounds, F.col("lang").eqNullSafe(F.col("b_lang")), "left")
    fitted = F.lit(False) if crossed else F.coalesce(F.col("half") == 0, F.lit(False))
    joined = joined.select("id", "digest", "nll", "peak", "n", fitted.alias("fitted"), *[either(c).alias(c) for c in ("mean", "lo", "hi", "worst")])
    # without trusted texts there is no mean to draw to
    scores_of = (("score", drawn, F.col("nll") / F.col("n")), ("passage", filled, F.col("peak") / F.least("n", F.lit(passage))))
    joined = joined.select("*", *[F.when(F.col("n") > 0, F.coalesce(of(F.col("mean")), plainly)).alias(name) for name, of, plainly in scores_of])
    inside = (F.col("fitted") | (F.col("score") >= F.col("lo"))) & (F.col("score") <= F.col("hi")) & (F.col("passage") <= F.col("worst"))
    kept = (F.col("n") > 0) & F.coalesce(inside, F.lit(True))
    return joined.select(F.col("id").alias("doc_id"), "digest", F.when(F.col("n") > 0, F.exp(F.col("nll") / F.col("n"))).alias("perplexity"), "score", "passage", kept.alias("kept"))


def accepted(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = 1_000_000, **options) -> DataFrame:
    """The documents that the classifier keeps, with their own columns."""
    found = materialize(classify(docs, labels, id_col=id_col, text_col=text_col, **options), "decisions")
    return without(docs, found.filter("not kept").select(F.col("doc_id").alias("id"), "digest"), id_col, text_col, broadcast_rows)
