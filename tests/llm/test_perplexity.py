from collections import Counter, defaultdict
from math import log

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import perplexity

N = perplexity.ORDER


def grams(text):
    padded = [0] * (N - 1) + [ord(c) if c != "\n" else 32 for c in text.lower()]
    return [tuple(padded[k : k + N]) for k in range(len(padded) - N + 1)]


def kneser_ney(texts):
    """An interpolated modified Kneser-Ney model by dictionaries; a function from an n-gram to its probability."""
    counts = {N: Counter(g for t in texts for g in grams(t))}
    for k in range(N - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    alpha, gamma = {}, defaultdict(lambda: 1.0)
    for k, table in counts.items():
        n = [sum(c == j for c in table.values()) for j in range(1, 5)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
        d = [min(max(j - (j + 1) * y * n[j] / n[j - 1] if n[j - 1] else j * 0.5, 0.05), float(j)) for j in (1, 2, 3)]
        total, held = Counter(), Counter()
        for g, c in table.items():
            total[g[:-1]] += c
            held[g[:-1]] += d[min(c, 3) - 1]
        for g, c in table.items():
            alpha[g] = (c - d[min(c, 3) - 1]) / total[g[:-1]]
        gamma.update({(k, h): held[h] / total[h] for h in total})

    def probability(gram):
        p = 1 / 4096
        for k in range(1, N + 1):
            g = gram[-k:]
            p = alpha.get(g, 0.0) + gamma[k, g[:-1]] * p
        return p

    return probability


@pytest.fixture(scope="module")
def model_and_scores(spark):
    texts = ["abracadabra abra cadabra", "a banana bandana\nabracadabra", "", "cab cab cab dab", None]
    others = [(1, "abra banana"), (2, "zzz"), (3, ""), (4, None), (5, "cab\nabra"), (5, "a" * 3_000)]
    fitted = perplexity.fit(spark.createDataFrame([(t,) for t in texts], "text string").repartition(2))
    docs = spark.createDataFrame(others, "doc_id long, text string").repartition(3)
    found = perplexity.scores(docs, fitted, id_col="doc_id", text_col="text").collect()
    return kneser_ney([t or "" for t in texts]), others, found


def test_scores_equal_a_plain_model(model_and_scores):
    probability, others, found = model_and_scores
    got = sorted((r.id, r.n, r.nll) for r in found)
    want = sorted((i, len(t or ""), -sum(log(probability(g)) for g in grams(t or ""))) for i, t in others)
    for (i, n, a), (j, m, b) in zip(got, want):
        assert (i, n) == (j, m) and abs(a - b) <= 1e-3 * max(1, m)


def test_probabilities_sum_to_one(model_and_scores):
    probability, _, _ = model_and_scores
    for context in ((0, 0, 0, 0), tuple(map(ord, "abra")), tuple(map(ord, "zzzz"))):
        total = sum(probability((*context, c)) for c in range(1, 4096))
        assert abs(total + probability((*context, 0)) - 1) < 1e-9


def test_blocks_do_not_change_scores(spark, documents, monkeypatch):
    fitted = perplexity.fit(documents.limit(40).select("text"))
    one = {r.id: round(r.nll, 6) for r in perplexity.scores(documents, fitted, id_col="doc_id", text_col="text").collect()}
    monkeypatch.setattr(perplexity, "BLOCK_CHARS", 1_000)
    many = {r.id: round(r.nll, 6) for r in perplexity.scores(documents, fitted, id_col="doc_id", text_col="text").collect()}
    assert one == many


def test_wide_alphabets():
    rng = np.random.default_rng(2)
    texts = ["".join(map(chr, rng.integers(0x4E00, 0x9000, 900))) for _ in range(20)]
    stream, _ = perplexity.symbols(texts)
    keys, ids, at = perplexity.ngrams(stream)
    packed = sum(stream[at - N + 1 + k].astype(np.int64) << (12 * (N - 1 - k)) for k in range(N))
    assert (keys[ids] == packed).all() and (np.diff(keys) > 0).all()


def test_held_out_accuracy(spark):
    """Labelled junk goes, labelled clean texts stay."""
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    judged = perplexity.classify(docs, labels).join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    share = {r.quality: r.kept for r in judged}
    assert share[1] >= 0.97 and share[0] <= 0.35


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (2, 0, 0), (6, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    for given in (labels, labels.limit(0)):
        rows = perplexity.classify(odd_docs, given).collect()
        assert len(rows) == odd_docs.count()
        assert all(not r.kept and r.perplexity is None for r in rows if r.score is None)
    assert perplexity.classify(no_docs, labels).count() == 0
    assert perplexity.accepted(odd_docs, labels).columns == odd_docs.columns


def test_worst_passages(model_and_scores):
    probability, others, found = model_and_scores
    size = perplexity.PASSAGE
    want = []
    for i, t in others:
        each = [-log(probability(g)) for g in grams(t or "")]
        want.append((i, len(each), max((sum(each[k : k + size]) for k in range(max(1, len(each) - size + 1))), default=0.0)))
    for (i, n, a), (j, m, b) in zip(sorted((r.id, r.n, r.peak) for r in found), sorted(want)):
        assert (i, n) == (j, m) and abs(a - b) <= 1e-3 * size


def test_worst_passages_of_any_place():
    rng = np.random.default_rng(3)
    lengths = np.array([0, 5, perplexity.PASSAGE, perplexity.PASSAGE + 1, 0, 700, 3, 0])
    parts = [-rng.random(n) for n in lengths]
    logs = np.concatenate([np.concatenate([np.zeros(N - 1), p]) for p in parts])
    starts = np.cumsum(lengths + N - 1) - lengths
    size = perplexity.PASSAGE
    found = perplexity.peaks(np.concatenate([[0.0], np.cumsum(logs)]), starts, lengths, size)
    assert np.allclose(found, [max((-p[k : k + size].sum() for k in range(max(1, len(p) - size + 1))), default=0.0) for p in parts])


def test_toxic_passages(spark):
    """Most toxic texts of good quality go, clean ones stay."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    judged = perplexity.classify(docs, labels).join(labels.filter("quality = 1"), "doc_id").groupBy("toxic").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    share = {r.toxic: r.kept for r in judged}
    assert share[0] >= 0.98 and share[1] <= 0.5


def test_decisions_against_brute_force(spark):
    """Who is kept follows from the scores, the quantiles of the held-out trusted texts, and nothing else."""
    folder, low, high, prior, least = "/root/testdata/sf0.01", 0.02, 0.97, 100, 12
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 50 != 7, F.col("lang")))  # a language without enough texts
    rows = {r.doc_id: r for r in docs.select("doc_id", "lang", "text", F.xxhash64("doc_id").alias("hash")).collect()}
    found = {r.doc_id: r for r in perplexity.classify(docs, labels, per_lang=40, low=low, high=high, min_trusted=least).collect()}
    trusted = defaultdict(list)
    for r in labels.filter("quality = 1 and toxic = 0").collect():
        if r.doc_id in rows:
            trusted[rows[r.doc_id].lang].append(r.doc_id)
    fitted = set()
    for ids in trusted.values():
        ids.sort(key=lambda i: (rows[i].hash, i))
        fitted |= set(ids[: min(40, -(-len(ids) // 2))])
    size = {i: len(perplexity.plain(r.text)) for i, r in rows.items()}
    held = {lang: [i for i in ids if i not in fitted and size[i]] for lang, ids in trusted.items()}

    def bounds(ids):
        mean = sum(log(found[i].perplexity) * size[i] for i in ids) / sum(size[i] for i in ids)
        score = sorted((log(found[i].perplexity) * size[i] + prior * mean) / (size[i] + prior) for i in ids)
        return mean, [score[max(0, -int(-q * len(ids) // 1) - 1)] for q in (low, high)]

    means = {lang: bounds(ids) for lang, ids in held.items() if len(ids) >= least}
    everyone = bounds([i for ids in held.values() for i in ids])
    assert None not in means and len(means) >= 2
    # the passages' bound comes from the texts' own passage scores
    worst = {lang: sorted(found[i].passage for i in ids)[max(0, -int(-high * len(ids) // 1) - 1)] for lang, ids in held.items() if lang in means}
    checked = 0
    for i, r in rows.items():
        mean, (lo, hi) = means.get(r.lang, everyone)
        if not size[i]:
            assert not found[i].kept
            continue
        score = (log(found[i].perplexity) * size[i] + prior * mean) / (size[i] + prior)
        assert abs(score - found[i].score) < 1e-9
        if r.lang in means and min(abs(score - lo), abs(score - hi)) > 1e-9:
            inside = (i in fitted or score >= lo) and score <= hi and found[i].passage <= worst[r.lang]
            assert found[i].kept == inside, (i, score, lo, hi)
            checked += 1
    assert checked > 500 and 0.5 < sum(r.kept for r in found.values()) / len(found) < 0.95


def test_every_trusted_text_is_counted_or_held_out(spark, monkeypatch):
    """Of 3,201 trusted texts of a language 1,601 are counted, and the others, all of them, set the quantiles."""
    counted, real = [], perplexity.fit
    monkeypatch.setattr(perplexity, "fit", lambda texts: counted.append(texts.count()) or real(texts))
    docs = spark.range(3_201 + 7).selectExpr("id as doc_id", "concat('text ', id) as text", "if(id < 3201, 'en', null) as lang")
    labels = docs.selectExpr("doc_id", "1 as quality", "0 as toxic")
    assert perplexity.classify(docs, labels).count() == 3_208
    assert counted == [1_601 + 4]


def test_counted_half_by_brute_force(spark):
    rows = spark.range(900).selectExpr("id as doc_id", "if(id % 3 = 0, null, concat('l', id % 3)) as lang")
    by_lang = defaultdict(list)
    for r in rows.withColumn("hash", F.xxhash64("doc_id")).collect():
        by_lang[r.lang].append((r.hash, r.doc_id))
    for most in (None, 7):
        want = {(i, lang) for lang, ids in by_lang.items() for _, i in sorted(ids)[: most or 150]}
        assert {tuple(r) for r in perplexity.counted_half(rows, most).collect()} == want


def test_quantiles_are_the_values_at_their_places(spark):
    rng = np.random.default_rng(4)
    values = {"a": rng.normal(size=60_001), None: np.round(rng.normal(size=700), 1), "b": np.ones(1)}
    rows = spark.createDataFrame([(g, float(v), len(vs)) for g, vs in values.items() for v in vs], "g string, x double, n long")
    wanted = [("x", 0.005, "lo"), ("x", 0.7, "mid"), ("x", 0.995, "hi"), ("x", 0.9999, "top")]
    for r in perplexity.quantiles(rows, ["g"], wanted, ["n"]).collect():
        vs = np.sort(values[r.g])
        assert r.n == len(vs) and [r.lo, r.mid, r.hi, r.top] == [vs[max(0, -int(-q * len(vs) // 1) - 1)] for _, q, _ in wanted]


def test_every_trusted_text_is_counted_and_sets_the_quantiles(spark):
    """A trusted text is judged by the other half's model, any other text by the model of all trusted ones, and the
    quantiles are those of all trusted texts: against dictionaries."""
    rng, low, high = np.random.default_rng(5), 0.1, 0.9
    words = ["".join(rng.choice(list("abcdefg"), 4)) for _ in range(30)]
    texts = {i: " ".join(rng.choice(words, 25)) for i in range(60)}
    docs = spark.createDataFrame([(i, t, "en") for i, t in texts.items()], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(41)] + [(i, 0, 0) for i in range(41, 45)], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in perplexity.classify(docs, labels, low=low, high=high).collect()}
    ids = [r.doc_id for r in docs.filter("doc_id < 41").orderBy(F.xxhash64("doc_id"), "doc_id").collect()]
    halves = set(ids[:21]), set(ids[21:])
    models = [kneser_ney([texts[i] for i in sorted(h)]) for h in (*halves, ids)]
    for i, t in texts.items():
        judge = models[1] if i in halves[0] else models[0] if i in halves[1] else models[2]
        assert abs(log(found[i].perplexity) - sum(-log(judge(g)) for g in grams(t)) / len(t)) < 1e-3, i
    at = lambda values, q: sorted(values)[max(0, -int(-q * len(ids) // 1) - 1)]
    lo, hi = (at([found[i].score for i in ids], q) for q in (low, high))
    worst = at([found[i].passage for i in ids], high)
    for r in found.values():
        assert r.kept == (lo <= r.score <= hi and r.passage <= worst)


def test_counts_of_halves_add_up(spark, documents):
    """The model of added counts is the model of all texts."""
    texts = documents.select("doc_id", "text").limit(60)
    halves = [perplexity.counted(perplexity.fit(texts.filter(f"doc_id % 2 = {k}"))) for k in range(2)]
    added = perplexity.estimated(halves[0].unionByName(halves[1]).groupBy("key").agg(F.sum("c").alias("c")))
    row = lambda m: sorted((r.kind, r.order, r.key, r.shard, round(r.value, 9)) for r in m.collect())
    assert row(added) == row(perplexity.fit(texts))


def test_models_do_not_share_shards_or_blocks(spark, documents, monkeypatch):
    """Documents dealt to three models get the scores that each model alone gives them, with any number of blocks."""
    models = [perplexity.fit(documents.filter(f"doc_id % 5 = {k}").select("text")) for k in range(3)]
    alone = [{r.id: round(r.nll, 6) for r in perplexity.scores(documents, m, id_col="doc_id", text_col="text").collect()} for m in models]
    for size in (perplexity.BLOCK_CHARS, 1_000):
        monkeypatch.setattr(perplexity, "BLOCK_CHARS", size)
        found = perplexity.scores(documents, *models, id_col="doc_id", text_col="text", by=(F.col("doc_id") % 3).cast("int")).collect()
        assert len(found) == documents.count() and all(round(r.nll, 6) == alone[r.id % 3][r.id] for r in found)


def test_one_trusted_text(spark):
    """Nothing is left to score it or others against, and all texts stay."""
    docs = spark.createDataFrame([(1, "one text", "en"), (2, "another", "en"), (3, "", "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert {r.doc_id: r.kept for r in perplexity.classify(docs, labels).collect()} == {1: True, 2: True, 3: False}
