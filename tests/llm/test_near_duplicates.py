import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from millrace.llm import graph, near_duplicates

random.seed(8)
VOCABULARY = [f"w{k}" for k in range(2_000)]


def shingles(text):
    words = [w.decode() for w in (text or "").lower().encode().split()]
    return set(zip(*(words[k:] for k in range(5)))) if len(words) >= 5 else {tuple(words)} if words else set()


def brute(rows):
    """class_id and links of each row's place, from all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))
    links = [0] * len(rows)

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if n and n >= 0.8 * (len(sets[i]) + len(sets[j]) - n) - 1e-9:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    members = defaultdict(list)
    for k in range(len(rows)):
        members[find(k)].append(rows[k][0])
    return [(rows[k][0], min([m for m in members[find(k)] if m is not None], default=None), links[k]) for k in range(len(rows))]


def family(n, length=120, swaps=4):
    base = random.choices(VOCABULARY, k=length)
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(random.randrange(swaps + 1)):
            words[random.randrange(length)] = random.choice(VOCABULARY)
        out.append(" ".join(words))
    return out


def test_against_all_pairs(spark):
    texts = [t for n in (2, 3, 5, 12, 40) for t in family(n)] + ["a b", "A  b", "a b c", "", " ", "a b c d e f"] + [" ".join(random.choices(VOCABULARY, k=60)) for _ in range(60)]
    texts += texts[:10] * 3
    random.shuffle(texts)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as class", "2 as id", "3 as tree", "4 as key", "5 as task").repartition(4)
    found = [tuple(r) for r in near_duplicates.jaccard_join(df).orderBy("doc_id").collect()]
    assert found == brute(rows)
    kept = near_duplicates.one_of_each(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {c for _, c, _ in found}


def test_parts_of_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "MEMBERS", 7)
    rows = list(enumerate(family(60, swaps=6)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert [tuple(r) for r in near_duplicates.jaccard_join(df).orderBy("doc_id").collect()] == brute(rows)


def test_prefixes_are_shortened(spark):
    """With few trees the recall at full depth is low, and shorter prefixes find the rest."""
    rows = list(enumerate(t for _ in range(60) for t in family(2, length=100, swaps=3)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sum(n for _, _, n in brute(rows))
    one = sum(r.n_links for r in near_duplicates.jaccard_join(df, recall=0.0, trees=3).collect())
    all_ = sum(r.n_links for r in near_duplicates.jaccard_join(df, recall=0.99, trees=3).collect())
    assert one < want and all_ >= 0.98 * want
    with pytest.raises(ValueError):
        near_duplicates.jaccard_join(df, recall=0.9999, trees=3)


@pytest.mark.parametrize("parts", [1, 7, 60])
def test_tries_lose_no_neighbours(spark, parts):
    """Whatever the ranges and batches, classes with a common prefix come out of the tries."""
    draw, trees, depth = random.Random(5), 2, 2
    minima = [tuple(tuple(draw.randrange(3) for _ in range(near_duplicates.DEPTH)) for _ in range(trees)) for _ in range(80)]
    rows = [(bytes([k]) * 16, np.array(m, np.uint32).tobytes()) for k, m in enumerate(minima)]
    df = spark.createDataFrame(rows, "class binary, signature binary")
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        found = {(r["class"][0], r.tree) for r in near_duplicates.trie_runs(df, depth, trees).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    nodes = Counter((t, m[t][:depth]) for m in minima for t in range(trees))
    want = {(k, t) for k, m in enumerate(minima) for t in range(trees) if nodes[t, m[t][:depth]] > 1}
    assert want <= found and len(found - want) <= 2 * parts


def test_links_do_not_depend_on_other_rows(spark):
    """Pairs near the threshold, with and without a large group of nearer copies."""
    draw = random.Random(11)
    pairs = []
    for k in range(800):  # three words of 139 differ: 120 common shingles of 150
        words = draw.choices(VOCABULARY, k=139)
        pairs += [" ".join(words), " ".join(f"x{k}" if at in (30, 60, 90) else w for at, w in enumerate(words))]
    base = draw.choices(VOCABULARY, k=200)
    hot = [" ".join([*base[:k], "y", *base[k + 1 :]]) for k in range(200)]
    found = []
    for texts in (pairs, pairs + hot):
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        found.append([tuple(r) for r in near_duplicates.jaccard_join(df).filter(f"doc_id < {len(pairs)}").orderBy("doc_id").collect()])
    assert found[0] == found[1]


@pytest.mark.parametrize("trees", [16, 40])
def test_depth_finds_the_least_similar(trees):
    depth = near_duplicates.depth_of(0.8, 0.999, trees)
    assert near_duplicates.chance(0.8, depth, trees) >= 0.999
    assert depth == near_duplicates.DEPTH or near_duplicates.chance(0.8, depth + 1, trees) < 0.999


def test_documents(spark, documents, plain_documents):
    found = [tuple(r) for r in near_duplicates.jaccard_join(documents).orderBy("doc_id").collect()]
    assert found == brute([(i, t) for i, t, _ in plain_documents])


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    found = sorted((tuple(r) for r in near_duplicates.jaccard_join(odd_docs).collect()), key=str)
    want = [(i, c if shingles(t) else i, n) for (i, c, n), (_, t) in zip(brute(rows), rows)]
    assert found == sorted(want, key=str)
    assert near_duplicates.jaccard_join(no_docs).count() == 0
    ids = [r.doc_id for r in near_duplicates.one_of_each(odd_docs).collect()]
    assert ids.count(1) == 1 and 2 not in ids


@pytest.mark.parametrize("links", [[], [(1, 2)], [(k, k + 1) for k in range(40)], [(0, k) for k in range(1, 50)], [(3, 1), (1, 3), (2, 2), (9, 8), (8, 7), (5, 9)]])
def test_components(spark, links):
    df = spark.createDataFrame(links, "a long, b long")
    found = {r.node: r.label for r in graph.components(df).collect()}
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    assert found == {x: find(x) for x in root}
