"""Token counts through a digest cache.

Key of the cache: SHA-256 of the normalised content and SHA-256 of the tokenizer file. Digests of all documents are
joined to the stored counts; the texts behind digests that have none, one text a digest, are encoded and appended to the
cache; then every document gets its count by a join on the digest. Normalisation turns null into the
empty text and nothing else, since any other change of a text can change its count.

The worker encodes through a memo where that is exact: if a sentencepiece BPE model normalises nothing but blanks to
its blank mark, and no piece holds a line feed or a blank mark after another character, then no merge crosses the
place before a blank or around a line feed, so that a text's count is the sum over its blank-separated units. Texts
with leading, trailing or doubled blanks, blanks beside line feeds, or the blank mark itself are encoded whole.

Edge cases: null and empty texts have 0 tokens; repeated rows share one cache entry and each keep a row; other columns,
whatever their names, are not read; an empty table gives an empty result and appends nothing. Long texts are encoded whole, without truncation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import materialize, release_memory, small_batches, text_of, work_path

MARK = "▁"
#: Units that a worker's memo holds at most; it starts anew beyond them.
MEMO_UNITS = 250_000
CACHE_SCHEMA = "content binary, version binary, n_tokens long"
_counters: dict[str, object] = {}


class SentencePieceCounter(dict):
    """Counts of texts for one model; as a mapping, the memo of counts of single units."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        super().__init__()
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = proto.ModelProto()
        with open(path, "rb") as file:
            spec.ParseFromString(file.read())
        plain = not spec.normalizer_spec.precompiled_charsmap and spec.normalizer_spec.add_dummy_prefix and not spec.normalizer_spec.remove_extra_whitespaces and spec.normalizer_spec.escape_whitespaces
        bpe = spec.trainer_spec.model_type == spec.trainer_spec.BPE and not spec.trainer_spec.treat_whitespace_as_suffix
        pieces = [p.piece for p in spec.pieces]
        own = any(p.type == p.USER_DEFINED for p in spec.pieces)
        apart = not any(MARK in p.lstrip(MARK) or "\n" in p for p in pieces)
        mark_alone = MARK in pieces
        self.by_unit = bool(plain and bpe and apart and mark_alone and not own)

    def __missing__(self, unit: str) -> int:
        n = len(self.model.encode(unit))
        self[unit] = n
        return n

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not self.by_unit or text[0] == " " or text[-1] == " " or "  " in text or " \n" in text or "\n " in text or MARK in text:
            return len(self.model.encode(text))
        if len(self) > MEMO_UNITS:
            self.clear()
        # a unit after a line feed begins with it and, encoded alone, has the dummy mark as one token more
        lines = text.count("\n")
        units = (text.replace("\n", " \n") if text[0] != "\n" else "\n" + text[1:].replace("\n", " \n")).split(" ")
        return sum(map(self.__getitem__, units)) - (lines if text[0] != "\n" else lines - 1)


class JsonCounter:
    """Counts of texts by a tokenizers file."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()

    def count(self, text: str) -> int:
        return len(self.model.encode(text, add_special_tokens=False).ids)


def counter(path: str):
    """The worker's counter for a tokenizer file, made once in a Python process."""
    if path not in _counters:
        _counters[path] = SentencePieceCounter(path) if path.endswith(".model") else JsonCounter(path)
    return _counters[path]


def tokenizer_version(path: str) -> str:
    """Hex SHA-256 of the tokenizer file."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def _exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def fill_cache(docs: DataFrame, tokenizer_path: str, cache_path: str, *, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = 100_000) -> DataFrame:
    """Append the counts of the texts that the cache lacks. Returns a row per document: id, content (digest), n_bytes."""
    spark = docs.sparkSession
    version = F.unhex(F.lit(tokenizer_version(tokenizer_path)))
    content = F.unhex(F.sha2(text_of(text_col), 256))
    keyed = materialize(docs.select(F.col(id_col).alias("id"), content.alias("content"), F.octet_length(text_of(text_col)).cast("long").alias("n_bytes")), "token-digests")
    texts = docs.select(content.alias("content"), text_of(text_col).alias("text"))
    missing = keyed.select("content").distinct()
    if _exists(spark, cache_path):
        stored = spark.read.schema(CACHE_SCHEMA).parquet(cache_path).filter(F.col("version") == version)
        missing = missing.join(stored.select("content"), "content", "left_anti")
    missing = materialize(missing, "token-misses")
    few = missing.count() <= broadcast_rows
    # few misses: their texts alone are shuffled; else copies are reduced to one text before the misses are picked out
    texts = texts.join(F.broadcast(missing), "content", "left_semi") if few else texts
    distinct = texts.groupBy("content").agg(F.first("text").alias("text"))
    distinct = distinct if few else distinct.join(missing, "content", "left_semi")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(tokenizer_path)
        for batch in batches:
            counts = pa.array((tokens.count(x.as_py()) for x in batch.column("text")), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("content"), counts], names=["content", "n_tokens"])
        release_memory()

    counted = distinct.mapInArrow(encode, "content binary, n_tokens long")
    with small_batches(spark):
        counted.select("content", version.alias("version"), "n_tokens").write.mode("append").parquet(cache_path)
    return keyed


def count_tokens(docs: DataFrame, tokenizer_path: str, cache_path: str | None = None, *, limit: int = 4096, **options) -> DataFrame:
    """A row per document: doc_id, n_bytes, n_tokens, over_limit. cache_path: a Parquet folder that grows by the misses."""
    spark = docs.sparkSession
    cache_path = cache_path or work_path(spark, "token-cache")
    keyed = fill_cache(docs, tokenizer_path, cache_path, **options)
    version = F.unhex(F.lit(tokenizer_version(tokenizer_path)))
    counts = spark.read.schema(CACHE_SCHEMA).parquet(cache_path).filter(F.col("version") == version).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))
    # written, so that both sides are dealt for the join alone and Spark can split the copies of a frequent text
    counts = materialize(counts, "token-counts")
    return keyed.join(counts, "content").select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
