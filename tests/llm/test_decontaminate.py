import itertools
import random
import re

import pytest

from millrace.llm import decontaminate

random.seed(3)
VOCABULARY = [f"w{k}" for k in range(3_000)]
ITEMS = [(k, " ".join(random.choices(VOCABULARY, k=random.randrange(15, 60))).capitalize() + ".") for k in range(25)]


def prose(n):
    return " ".join(random.choices(VOCABULARY, k=n))


def planted():
    """(doc_id, text, item or None): passages verbatim, in other case and marks, and with substitutions."""
    rows = []
    for k, (item, text) in enumerate(ITEMS):
        words = text.split()
        swapped = [("zz" if j % 6 == 3 else w) for j, w in enumerate(words)]
        rows += [(10 * k, f"{prose(30)} {text} {prose(20)}", item), (10 * k + 1, text, item), (10 * k + 2, f"{prose(9)}\n{' , '.join(words).upper()}!", item), (10 * k + 3, f"{prose(50)} {' '.join(swapped)}", item)]
        rows += [(10 * k + 4, prose(200), None), (10 * k + 5, f"{prose(20)} {' '.join(words[:7])} {prose(20)}", None), (10 * k + 6, " ".join(random.sample(words, len(words))), None)]
    return rows


def best_overlap(text, item, overlap=13):
    """The largest number of agreeing tokens in aligned windows, over all shifts."""
    split = lambda t: [w for w in re.split(r"[\W_]+", t.lower()) if w]
    a, b = split(text), split(item)
    n = min(overlap, len(b))
    best = 0
    for shift in range(-len(b), len(a)):
        same = [0 <= k + shift < len(a) and a[k + shift] == b[k] for k in range(len(b))]
        best = max([best, *(sum(same[s : s + n]) for s in range(len(b) - n + 1))])
    return best / n if n else 0


@pytest.mark.parametrize("broadcast_rows", [2_000_000, 0])
def test_planted(spark, broadcast_rows):
    rows = planted()
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").selectExpr("*", "1 as h", "2 as key", "3 as at", "4 as item_id").repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = {r.doc_id: r for r in decontaminate.contaminated(df, items, broadcast_rows=broadcast_rows).collect()}
    for i, text, item in rows:
        assert found[i].contaminated == (item is not None), (i, text)
        if item is not None:
            assert found[i]["items"] == [item]
    kept = decontaminate.decontaminated(df, items, broadcast_rows=broadcast_rows)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i, _, item in rows if item is None}


def allowed(n):
    """Every way to substitute as many of n aligned tokens as the identity allows."""
    need = next(k for k in range(n + 1) if k >= 0.75 * n)
    return itertools.combinations(range(n), n - need)


@pytest.mark.parametrize("n", range(7, 14))
def test_masks_hit_every_overlap(n):
    for gone in allowed(n):
        assert any(all(at + o not in gone for o, c in enumerate(m) if c == "1") for m in decontaminate.MASKS for at in range(n - len(m) + 1)), gone


def test_substitutions_and_short_items(spark):
    """All substitutions that the identity allows in items of 7 to 13 tokens are found; shorter items only whole."""
    items, rows, want = [], [], set()
    for n in range(1, 14):
        words = [f"n{n}w{k}" for k in range(n)]
        items.append((n, " ".join(words)))
        for gone in allowed(n) if n >= 7 else [(), (0,), (n - 1,)]:
            rows.append((len(rows), " ".join(["before", *("zz" if k in gone else w for k, w in enumerate(words)), "after"])))
            if n >= 7 or not gone:
                want.add((rows[-1][0], n))
    found = decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, i) for r in found.collect() for i in r["items"]} == want


def test_documents_against_all_alignments(spark, documents, plain_documents):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    found = {(r.doc_id, i) for r in decontaminate.contaminated(documents, benchmark).collect() for i in r["items"]}
    want = {(d, i) for d, t, _ in plain_documents[:60] for i, b in items if best_overlap(t, b) >= 0.75}
    assert {x for x in found if x[0] in {d for d, _, _ in plain_documents[:60]}} == want
    assert {(d, i) for d, t, _ in plain_documents for i, b in items if b in t} <= found


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog while nine old wizards"), (2, None), (3, ""), (None, "short one")], "item_id long, text string")
    found = decontaminate.contaminated(odd_docs, items)
    rows = found.collect()
    assert len(rows) == odd_docs.count() and sum(r.contaminated for r in rows) == 5
    assert decontaminate.contaminated(no_docs, items).count() == 0
    assert decontaminate.contaminated(odd_docs, items.limit(0)).filter("contaminated").count() == 0
