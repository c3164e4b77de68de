"""Queries over splits, samples, mixtures and floors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import sampling
from millrace.plans.registry import registry
from millrace.session import table

QUERIES, ORACLES, query = registry()


def _order(seed: int) -> str:
    return f"sha256(concat('{seed}|', source, '|', doc_id))"


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").drop("text")


@query(f"SELECT doc_id, row_number() OVER (ORDER BY {_order(7)}) AS place FROM documents")
def seeded_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.shuffled(_docs(spark, sf_dir).select("doc_id", "source"), 7, "source", "doc_id").select("doc_id", "place")


@query(f"SELECT doc_id, lang, place <= greatest(1, round_even(n * 0.05, 0)) AS is_test FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY {_order(1)}) AS place, count(*) OVER (PARTITION BY lang) AS n FROM documents)")
def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.split(_docs(spark, sf_dir), "lang", 0.05, 1, "source", "doc_id").select("doc_id", "lang", "is_test")


@query(f"SELECT doc_id, lang FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY {_order(2)}) AS place FROM documents) WHERE place <= 40")
def balanced_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.balanced(_docs(spark, sf_dir), "lang", 40, 2, "source", "doc_id").select("doc_id", "lang")


_BUCKET = "CASE WHEN source = 'src3' THEN 'general' WHEN lang = 'fr' THEN 'swahili' ELSE 'english' END"


@query(f"SELECT doc_id, bucket FROM (SELECT doc_id, {_BUCKET} AS bucket, row_number() OVER (PARTITION BY {_BUCKET} ORDER BY {_order(3)}) AS place FROM documents) WHERE place <= CASE bucket WHEN 'general' THEN 10 ELSE 30 END")
def mixcal(spark: SparkSession, sf_dir: str) -> DataFrame:
    tongue = F.when(F.col("lang") == "fr", "swahili").when(F.col("lang") == "en", "english").otherwise(F.col("lang"))
    rows = _docs(spark, sf_dir).withColumn("bucket", sampling.mix_buckets(tongue, F.col("source"), "src3"))
    most = F.when(F.col("bucket") == "general", 10).otherwise(30)
    return sampling.ranked_within(rows, "bucket", 3, "source", "doc_id", most=most).select("doc_id", "bucket")


_SHARES = (("es", 0.25), ("fr", 0.125), ("de", 0.0625))


@query(
    f"""SELECT doc_id, pool FROM (SELECT doc_id, lang AS pool, row_number() OVER (PARTITION BY lang ORDER BY {_order(4)}) AS place FROM documents) d
 JOIN (SELECT * FROM (VALUES ('en', 1.0), ('es', 0.25), ('fr', 0.125), ('de', 0.0625)) s(p, share)) ON pool = p WHERE place <= round_even(share * (SELECT count(*) FROM documents WHERE lang = 'en'), 0)"""
)
def mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir).withColumn("pool", F.col("lang"))
    base = docs.filter("lang = 'en'").agg(F.count(F.lit(1)).alias("base"))
    shares = spark.createDataFrame([("en", 1.0), *_SHARES], "pool string, share double")
    return sampling.mixture(docs, base, shares, 4, "source", "doc_id").select("doc_id", "pool")


@query("SELECT doc_id, row_number() OVER (ORDER BY doc_id) <= greatest(1, round_even(count(*) OVER () * 0.1, 0)) AS is_test FROM documents")
def head_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.head_holdout(_docs(spark, sf_dir).select("doc_id"), "doc_id").select("doc_id", "is_test")


@query(
    f"""SELECT doc_id, lang, CAST(before AS BIGINT) AS tokens_before FROM (SELECT doc_id, lang, coalesce(sum(n_chars) OVER (ORDER BY place, lang ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
 FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY {_order(5)}) AS place FROM documents)) WHERE before < 300000"""
)
def round_robin_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.round_robin(_docs(spark, sf_dir), "lang", "n_chars", 300_000, 5, "source", "doc_id").select("doc_id", "lang", "tokens_before")


_KIND = "CASE WHEN doc_id % 3 = 0 THEN 'chat' ELSE 'raw' END"


@query(
    f"""WITH r AS (SELECT *, floor((place - 1) / CASE kind WHEN 'raw' THEN 3 ELSE 1 END) AS g, CASE WHEN n_chars >= 60 THEN n_chars ELSE 0 END AS c FROM
 (SELECT doc_id, n_chars, {_KIND} AS kind, row_number() OVER (PARTITION BY {_KIND} ORDER BY {_order(6)}) AS place FROM documents)),
 s AS (SELECT g, coalesce(sum(t) OVER (ORDER BY g ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM (SELECT g, sum(c) AS t FROM r GROUP BY g))
 SELECT doc_id, kind, CAST(r.g AS BIGINT) AS group_no FROM r JOIN s ON r.g = s.g WHERE before < 200000 AND n_chars >= 60"""
)
def interleave_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _docs(spark, sf_dir).withColumn("kind", F.when(F.col("doc_id") % 3 == 0, "chat").otherwise("raw"))
    return sampling.interleave(rows, "kind", {"raw": 3, "chat": 1}, "n_chars", 200_000, 6, "source", "doc_id", least=60).select("doc_id", "kind", "group_no")


@query("SELECT doc_id, CAST(floor((row_number() OVER (ORDER BY doc_id) - 1) / 300) AS BIGINT) AS chunk_index FROM documents")
def chunk_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.chunks(_docs(spark, sf_dir).select("doc_id"), "doc_id", 300).select("doc_id", "chunk_index")


@query("SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 50")
def head_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", "lang").orderBy("doc_id").limit(50)


@query("SELECT lang, CAST(least(500, greatest(1, count(*)), greatest(1, count(*) FILTER (source = 'src1'))) AS BIGINT) AS cap, CAST(ceil(sum(n_chars) / 1024) + 8 AS BIGINT) AS chunks FROM documents GROUP BY lang")
def evaluation_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, own = F.count(F.lit(1)), F.count_if(F.col("source") == "src1")
    return _docs(spark, sf_dir).groupBy("lang").agg(sampling.evaluation_caps(n, own).cast("long").alias("cap"), sampling.chunk_need(F.sum("n_chars"), F.lit(1024)).alias("chunks"))


@query("SELECT doc_id FROM documents WHERE lang = 'fr' UNION ALL SELECT doc_id FROM documents WHERE source = 'src2' AND lang <> 'fr' AND (SELECT count(*) FROM documents WHERE lang = 'fr') * 600 < 100000000")
def top_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir).select("doc_id", "lang", "source")
    return sampling.top_up(docs.filter("lang = 'fr'"), docs.filter("source = 'src2'"), "doc_id", 100_000_000).select("doc_id")


_TRAINING = f"""WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY sha256(concat('8|', lang, '|', doc_id))) AS place, CASE lang WHEN 'de' THEN 0 ELSE greatest(1, round_even(count(*) OVER (PARTITION BY lang) * 0.1, 0)) END AS test FROM documents),
 t AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY sha256(concat('9|', lang, '|', doc_id))) AS k FROM r WHERE place > test), n AS (SELECT count(*) AS base FROM t WHERE lang = 'en'),
 m AS (SELECT doc_id, lang FROM t, n WHERE k <= round_even(base * CASE lang WHEN 'en' THEN 1.0 WHEN 'es' THEN 0.125 ELSE 0.25 END, 0))
 SELECT doc_id, lang AS pool, 'train' AS part FROM m UNION ALL SELECT doc_id, lang, 'heldout' FROM r WHERE place <= test"""


def _training(spark: SparkSession, sf_dir: str, legacy: bool) -> DataFrame:
    pools = _docs(spark, sf_dir).select("doc_id", F.col("lang").alias("pool"))
    shares = spark.createDataFrame([("en", 1.0), ("es", 0.125), ("fr", 0.25), ("de", 0.25)], "pool string, share double")
    return sampling.training_set(pools, shares, base="en", fractions={"en": 0.1, "es": 0.1, "fr": 0.1}, seed=8, key="doc_id", legacy=legacy).select("doc_id", "pool", "part")


@query(_TRAINING)
def training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _training(spark, sf_dir, legacy=False)


@query(f"WITH x AS ({_TRAINING}) SELECT * FROM x UNION ALL SELECT doc_id, pool, 'heldout' FROM (SELECT *, row_number() OVER (PARTITION BY pool ORDER BY sha256(concat('15|', pool, '|', doc_id))) AS k FROM x WHERE part = 'train' AND pool = 'de') WHERE k <= 250")
def training_set_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _training(spark, sf_dir, legacy=True)
