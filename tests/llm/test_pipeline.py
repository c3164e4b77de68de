"""The pipeline's stages, each held against what its operator says of its own input."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from millrace.llm import decontaminate, mixing, near_duplicates, perplexity
from millrace.llm.common import materialize

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], FOLDER), name))
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_columns_and_names(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "jaccard_join", "benchmark_decontamination", "source_mixing", "token_output"]
    assert all(s.columns == steps[0].columns for s in steps[1:-1])
    assert all(n > 0 for n in [s.count() for s in steps])


def test_decisions_take_effect(spark, steps):
    labels, benchmark = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("labels", "benchmark"))
    assert ids(steps[1]) == ids(perplexity.classify(steps[0], labels).filter("kept"))
    assert ids(steps[2]) == ids(near_duplicates.jaccard_join(steps[1]).filter("doc_id = class_id"))
    assert ids(steps[3]) == ids(decontaminate.contaminated(steps[2], benchmark).filter("not contaminated"))
    taken = mixing.taken_words(steps[3]).filter("taken > 0").select("doc_id", (F.col("taken") / F.col("size")).cast("int").alias("n"))
    assert ids(steps[4]) == sorted(r.doc_id for r in taken.collect() for _ in range(r.n))


def test_token_files_hold_the_mix(steps):
    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = sorted((r.doc_id, r.text) for r in steps[4].collect())
    found = [tuple(r)[:3] for r in steps[5].orderBy("start").select("doc_id", "start", "n_tokens").collect()]
    start = 0
    for (i, text), row in zip(rows, found, strict=True):
        n = len(model.encode(text, add_special_tokens=False).ids) + 1
        assert row == (i, start, n)
        start += n


def test_odd_inputs(spark, odd_docs, no_docs):
    """Each stage over nulls, empty and long texts, repeated rows and ids, clashing columns; and over no rows."""
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            found = stage(spark, docs, FOLDER)
            assert found.columns == docs.columns
            rows = found.count()
            assert rows <= 2 * docs.count() and (rows > 0) == (docs is odd_docs)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() == docs.count()


def test_run_and_registration(spark, steps):
    assert __spark_entry__.queries()["pipeline"].__wrapped__ is corpus_pipeline.run
    again = corpus_pipeline.run(spark, FOLDER)
    key = ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, again.select(key).collect())) == sorted(map(tuple, steps[-1].select(key).collect()))


def test_classifier_counts_half_of_the_trusted_texts(spark, monkeypatch, tmp_path):
    counted, real = [], perplexity.fit
    monkeypatch.setattr(perplexity, "fit", lambda texts: counted.append(texts.count()) or real(texts))
    docs = spark.range(3_400).selectExpr("id as doc_id", "concat('text ', id) as text", "'en' as lang", "'a' as source")
    docs.selectExpr("doc_id", "1 as quality", "0 as toxic").write.parquet(f"file://{tmp_path}/labels.parquet")
    found = corpus_pipeline.quality_classifier(spark, docs, f"file://{tmp_path}")
    assert counted == [1_700] and found.columns == docs.columns


def test_classifier_judges_by_the_counts_of_all_trusted_texts(spark, monkeypatch, tmp_path):
    """The model that judges other texts has every symbol of the 3,400 trusted texts, those of both halves."""
    sizes, real = [], perplexity.scores

    def scores(docs, *models, **options):
        sizes.extend(perplexity.counted(m).agg(F.sum("c")).first()[0] for m in models)
        return real(docs, *models, **options)

    monkeypatch.setattr(perplexity, "scores", scores)
    docs = spark.range(3_500).selectExpr("id as doc_id", "concat('text ', id) as text", "'en' as lang", "'a' as source")
    docs.filter("doc_id < 3400").selectExpr("doc_id", "1 as quality", "0 as toxic").write.parquet(f"file://{tmp_path}/labels.parquet")
    assert corpus_pipeline.quality_classifier(spark, docs, f"file://{tmp_path}").count() > 3_300
    assert sizes[-1] == docs.filter("doc_id < 3400").agg(F.sum(F.length("text"))).first()[0] == sum(sizes[:-1])
