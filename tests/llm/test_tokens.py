import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from millrace.llm import sequences, token_counts
from millrace.llm.common import work_path

PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "\n", "a b", "a  b", " a", "a ", "\na", "a\n\nb", "a \nb", "a\n b", "\r\n x", "tab\tx", "▁ mark", "</s> <s>", "<|endoftext|> A<|endoftext|>b", "Don't DON'T it's", "É à Ü ß İ Σας ΣΑΣ", "é ́x", "漢字 かな", "\x1c\x1d a\x1fb", "  \u0085 a", "x" * 300, "...,,,!?", "a,b.c", "end.", "1234 5,6", "\U0001f600\U0001f600", "\0nul"]


def texts():
    random.seed(5)
    alphabet = list("abcXYZ .,!?'\n\t0123éßÉ ▁Σ漢\U0001f600")
    return ODD + ["".join(random.choices(alphabet, k=random.randrange(40))) for _ in range(600)]


def test_counter_equals_library():
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    counter = token_counts.SentencePieceCounter(PIECES)
    assert counter.by_unit
    assert [counter.count(t) for t in texts()] == [len(model.encode(t)) for t in texts()]


def test_encoder_equals_library():
    model = Tokenizer.from_file(WORDS)
    encoder = sequences.Encoder(WORDS)
    assert encoder.by_unit
    for t in texts():
        assert np.frombuffer(encoder.encode(t), encoder.dtype).tolist() == model.encode(t, add_special_tokens=False).ids, repr(t)


def test_memo_generations(monkeypatch):
    monkeypatch.setattr(sequences, "MEMO_UNITS", 5)
    model, encoder = Tokenizer.from_file(WORDS), sequences.Encoder(WORDS)
    for t in texts()[-200:] * 2:
        assert np.frombuffer(encoder.encode(t), encoder.dtype).tolist() == model.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("broadcast_rows", [100_000, 0])
def test_counts_and_cache(spark, documents, plain_documents, broadcast_rows):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    path = work_path(spark, "cache")
    half = documents.filter("doc_id % 2 = 0")
    token_counts.count_tokens(half, PIECES, path).collect()
    n_half = spark.read.parquet(path).count()
    assert n_half == half.select("text").distinct().count()
    rows = {r.doc_id: r for r in token_counts.count_tokens(documents, PIECES, path, limit=300, broadcast_rows=broadcast_rows).collect()}
    assert spark.read.parquet(path).count() == documents.select("text").distinct().count()  # only the misses were added
    for i, t, _ in plain_documents:
        n = len(model.encode(t))
        assert (rows[i].n_tokens, rows[i].n_bytes, rows[i].over_limit) == (n, len(t.encode()), n > 300)


def test_stored_counts_are_used(spark, documents):
    path = work_path(spark, "cache")
    token_counts.count_tokens(documents, PIECES, path).collect()
    before = spark.read.parquet(path).selectExpr("content", "version", "n_tokens + 1000000 as n_tokens")
    other = work_path(spark, "cache")
    before.write.parquet(other)
    assert token_counts.count_tokens(documents, PIECES, other).filter("n_tokens < 1000000").count() == 0


def test_odd_counts(spark, odd_docs, no_docs):
    rows = token_counts.count_tokens(odd_docs, PIECES).collect()
    assert len(rows) == odd_docs.count() and {r.n_tokens for r in rows if r.n_bytes == 0} == {0}
    assert token_counts.count_tokens(no_docs, PIECES).count() == 0


def expected(rows):
    model, start, out = Tokenizer.from_file(WORDS), 0, []
    for i, t in rows:
        ids = model.encode(t or "", add_special_tokens=False).ids + [1]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_round_trip(spark, documents, plain_documents):
    want = expected([(i, t) for i, t, _ in plain_documents])
    path = work_path(spark, "sequences")
    found = sequences.token_files(documents.repartition(3), WORDS, path, file_ids=5_000, length=64)
    assert sorted(tuple(r) for r in found.collect()) == want
    files = sorted(r.path for r in spark.read.format("binaryFile").load(path).select("path").collect())
    assert len(files) > 4
    reader = sequences.open_sequences(files[0].removeprefix("file:"))
    batch = reader.get_batch(0)
    assert pa.types.is_fixed_size_list(batch.schema.field("ids").type) and batch.column("ids")[0].type.list_size == 64
    flat = batch.column("ids").flatten().to_numpy(zero_copy_only=True)  # read in place
    first = batch.column("docs")[0].as_py()[0]
    ids = Tokenizer.from_file(WORDS).encode(dict((i, t) for i, t, _ in plain_documents)[first["doc_id"]], add_special_tokens=False).ids + [1]
    n = min(len(ids), len(flat))
    assert flat[:n].tolist() == ids[:n]


def test_odd_files(spark, odd_docs, no_docs):
    rows = sorted((((r.doc_id is not None, r.doc_id or 0), r.text or "") for r in odd_docs.collect()), key=lambda x: (x[0], x[1].encode()))
    want = expected([(i if some else None, t) for (some, i), t in rows])
    found = [tuple(r) for r in sequences.token_files(odd_docs, WORDS).orderBy("start").collect()]
    assert found == want
    assert sequences.token_files(no_docs, WORDS).count() == 0
