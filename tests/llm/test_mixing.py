import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from millrace.llm import mixing


def targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """Weighted shares with the excess dealt again until none is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    full, left, open_ = {}, share * sum(sizes.values()), set(order)
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > cap * sizes[s]}
        if not over:
            return full | {s: left * weight[s] / total for s in open_}
        for s in over:
            full[s] = cap * sizes[s]
        left -= sum(full[s] for s in over)
        open_ -= over
    return full


def test_targets_and_taken(spark, documents, plain_documents):
    rows = mixing.taken_words(documents, block_words=500).collect()
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t, _ in plain_documents}
    by_source = Counter()
    for i, _, s in plain_documents:
        by_source[s] += size[i]
    want = targets(by_source)
    taken = Counter()
    source = {i: s for i, _, s in plain_documents}
    for r in rows:
        s = source[r.doc_id]
        assert (r.size, r.source_size) == (size[r.doc_id], by_source[s])
        assert abs(r.target - want[s]) < 1e-6 * max(1, want[s])
        assert 0 <= r.taken <= 2 * r.size and r.taken % max(1, r.size) == 0
        assert r.taken == r.size * len([x for x in r.shards.split(",") if x])
        taken[s] += r.taken
    longest = max(size.values())
    assert len(rows) == len(size) and all(abs(taken[s] - want[s]) <= longest / 2 for s in want)
    again = mixing.taken_words(documents.repartition(7), block_words=500)
    assert {(r.doc_id, r.taken, r.shards) for r in again.collect()} == {(r.doc_id, r.taken, r.shards) for r in rows}


def test_no_block_copy_in_two_shards_and_even_shards(spark, documents):
    _, picks = mixing.mix(documents, block_words=200, shards=5)
    rows = picks.collect()
    assert len({(r.id, r.copy) for r in rows}) == len(rows)
    words = Counter()
    for r in rows:
        words[r.shard] += r.size
    assert set(words) == set(range(5)) and max(words.values()) < 3 * min(words.values())


def test_sources_come_near_their_targets(spark):
    """With production parameters: within a hundredth of the target, where short documents can fill the rest."""
    documents = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = mixing.taken_words(documents).join(documents.select("doc_id", "source"), "doc_id").groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r.taken - r.target) <= max(50, 0.001 * r.target) for r in rows), rows


def test_repeated_ids(spark, documents):
    """Rows that share an id and a size but not a text are mixed one by one, and repeated rows as one."""
    docs = documents.selectExpr("doc_id % 40 as doc_id", "text", "source").unionByName(documents.selectExpr("doc_id % 40 as doc_id", "reverse(text) as text", "source"))
    docs = docs.unionByName(docs.limit(25))
    rows = mixing.taken_words(docs).collect()
    assert len(rows) == docs.count()
    mixed = mixing.mixed_rows(docs)
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    want, got = Counter(), Counter()
    for r in rows:
        want[r.doc_id, r.size] += r.taken
    for r in mixed.collect():
        got[r.doc_id, count(r.text)] += count(r.text)
    assert got == Counter({k: n for k, n in want.items() if n})
    held, times, by_source = Counter(), Counter(), Counter()
    for r in docs.collect():
        times[r.doc_id, r.source, r.text] += 1
        by_source[r.source] += count(r.text)
    for r in mixed.collect():
        held[r.source] += count(r.text)
    longest = max(n * count(t) for (_, _, t), n in times.items())
    goal = targets(by_source)
    assert all(abs(held[s] - goal[s]) <= longest / 2 for s in goal), (held, goal)


def test_shards_share_the_quotas(spark):
    """Every shard's part of the blocks' copies differs from an even one by less than one per level of the tree."""
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    seen = []
    split = mixing.split_tickets

    def noted(tickets, shards, seed):
        seen.append(split(tickets, shards, seed))
        return seen[-1]

    mixing.split_tickets = noted
    try:
        mixing.mix(documents, shards=6)
    finally:
        mixing.split_tickets = split
    per = Counter(r.shard for r in seen[0].collect())
    total = sum(per.values())
    assert len(per) == 6 and all(abs(n - total / 6) < 3 for n in per.values())
    sources = seen[0].groupBy("source").agg(F.countDistinct("block").alias("blocks")).collect()
    assert all(r.blocks >= 12 for r in sources)


def test_split_is_hypergeometric(spark):
    """Over many seeds, the tickets that a source sends to a shard have the law's mean and variance."""
    tickets = spark.range(60).select(F.when(F.col("id") < 20, "a").otherwise("b").alias("source"), F.col("id").alias("block"), F.lit(1).alias("copy"), F.lit(False).alias("part")).cache()
    counts = []
    for seed in range(24):
        found = mixing.split_tickets(tickets, 2, seed).groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("source") == "a").alias("a")).collect()
        assert sorted(r.n for r in found) == [30, 30]
        counts.append(next(r.a for r in found if r.shard == 0))
    mean = sum(counts) / 24
    variance = sum((c - mean) ** 2 for c in counts) / 23
    assert abs(mean - 10) < 1.5 and 0.9 < variance < 9  # the law: 10 and 3.39


def test_odd_rows(spark, odd_docs, no_docs):
    rows = mixing.taken_words(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(r.taken == 0 and r.size == 0 for r in rows if r.size == 0)
    assert mixing.taken_words(no_docs).count() == 0
    mixed = mixing.mixed_rows(odd_docs)
    assert mixed.columns == odd_docs.columns and mixed.filter("text is null").count() == 0
    by = defaultdict(int)
    for r in rows:
        by[r.target] += r.taken
    assert all(total <= 2 * 60_100 for total in by.values())
