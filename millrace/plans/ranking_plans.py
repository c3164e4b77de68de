"""Queries over candidate tables, logs and tensors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import logs
from millrace.operators import ranking, tensors
from millrace.plans.registry import registry
from millrace.session import table

QUERIES, ORACLES, query = registry()


_CANDIDATES = """(SELECT p_brand AS name, CASE WHEN p_brand LIKE '%5' THEN 'control' ELSE 'quant' END AS role, CAST(sum(p_size) AS BIGINT) AS size, round_even(avg(p_size) / 1000, 4)::DOUBLE AS mean_kld,
 CASE WHEN p_brand LIKE '%3' THEN NULL ELSE round_even(count(*) / 100000, 5)::DOUBLE END AS mean_kld_se, round_even(count(*) FILTER (p_size > 25) / count(*), 4)::DOUBLE AS hidden_mean, round_even(max(p_retailprice) / 100, 2)::DOUBLE AS cpu_generation_tps,
 CAST(min(p_size) AS DOUBLE) AS peak_rss_kb, CAST(count(*) FILTER (p_size = 1) AS BIGINT) AS safety_failures FROM part GROUP BY p_brand)"""


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands as candidates, with figures from their parts."""
    n, size, name = F.count(F.lit(1)), F.col("p_size"), F.col("p_brand")
    return table(spark, sf_dir, "part").groupBy(name.alias("name")).agg(
        F.sum(size).cast("long").alias("size"),
        F.bround(F.avg(size) / 1000, 4).alias("mean_kld"),
        F.bround(n / 100000, 5).alias("se"),
        F.bround(F.count_if(size > 25) / n, 4).alias("hidden_mean"),
        F.bround(F.max("p_retailprice") / 100, 2).alias("cpu_generation_tps"),
        F.min(size).cast("double").alias("peak_rss_kb"),
        F.count_if(size == 1).alias("safety_failures"),
    ).select("name", F.when(F.col("name").endswith("5"), "control").otherwise("quant").alias("role"), "size", "mean_kld", F.when(~F.col("name").endswith("3"), F.col("se")).alias("mean_kld_se"), "hidden_mean", "cpu_generation_tps", "peak_rss_kb", "safety_failures")


@query(f"""SELECT name, array_to_string(list_filter([CASE WHEN mean_kld > 0.0255 THEN 'mean_kld above 0.0255' END, CASE WHEN hidden_mean < 0.45 THEN 'hidden_mean below 0.45' END, CASE WHEN safety_failures > 0 THEN 'safety_failures not zero' END], lambda x: x IS NOT NULL), ';') AS failures FROM {_CANDIDATES}""")
def gate_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    failures = ranking.gate_failures(most={"mean_kld": 0.0255}, least={"hidden_mean": 0.45}, zero=("safety_failures",))
    return candidates(spark, sf_dir).select("name", F.array_join(failures, ";").alias("failures"))


@query(f"SELECT name, row_number() OVER (ORDER BY hidden_mean DESC, coalesce(mean_kld_se, 1) ASC, size ASC, cpu_generation_tps DESC, name) AS place FROM {_CANDIDATES}")
def rank_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col("hidden_mean").desc(), F.coalesce("mean_kld_se", F.lit(1.0)).asc(), F.col("size").asc(), F.col("cpu_generation_tps").desc(), F.col("name")]
    return ranking.ranked(candidates(spark, sf_dir), *order).select("name", F.col("place").cast("long").alias("place"))


@query(
    f"""WITH p AS (SELECT * FROM {_CANDIDATES} WHERE role <> 'control'), t AS (SELECT min(mean_kld) AS best, coalesce(2.0 * max(mean_kld_se), 0.002) AS tol FROM p), m AS (SELECT p.*, mean_kld <= best + tol AS is_tied FROM p, t)
SELECT name, is_tied, row_number() OVER (ORDER BY is_tied DESC, CASE WHEN is_tied THEN hidden_mean END DESC NULLS LAST, CASE WHEN is_tied THEN cpu_generation_tps END DESC NULLS LAST, CASE WHEN is_tied THEN size END, CASE WHEN is_tied THEN peak_rss_kb END, mean_kld, name) AS place FROM m"""
)
def noise_aware_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    passing = candidates(spark, sf_dir).filter(~ranking.is_control(F.col("name"), F.col("role")))
    return ranking.noise_aware(passing).select("name", "is_tied", F.col("place").cast("long").alias("place"))


@query(f"WITH c AS {_CANDIDATES} SELECT c.name, round_even(c.hidden_mean - b.hidden_mean, 3)::DOUBLE AS delta_hidden_mean, round_even(c.mean_kld - b.mean_kld, 6)::DOUBLE AS delta_mean_kld FROM c, (SELECT * FROM c WHERE name = (SELECT min(name) FROM c)) b")
def delta_vs_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = candidates(spark, sf_dir)
    first = rows.agg(F.min("name").alias("first"))
    marked = rows.crossJoin(F.broadcast(first)).withColumn("key", F.when(F.col("name") == F.col("first"), "baseline").otherwise(F.col("name")))
    return ranking.deltas(marked, "key", "baseline", {"hidden_mean": 3, "mean_kld": 6}).select("name", "delta_hidden_mean", "delta_mean_kld")


@query(
    """WITH s AS (SELECT s_suppkey, s_acctbal AS score, s_nationkey AS size, s_acctbal * 7 % 13 AS tps FROM supplier) SELECT s_suppkey FROM s a WHERE NOT EXISTS (SELECT 1 FROM s b WHERE b.score >= a.score AND b.size <= a.size AND b.tps >= a.tps AND (b.score > a.score OR b.size < a.size OR b.tps > a.tps))"""
)
def pareto_front(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_acctbal").alias("score"), F.col("s_nationkey").alias("size"), (F.col("s_acctbal") * 7 % 13).alias("tps"))
    return ranking.pareto(rows, name="s_suppkey", most=["score", "tps"], least=["size"]).select("s_suppkey")


@query(f"""WITH c AS {_CANDIDATES}, k AS (SELECT k, CASE k WHEN 0 THEN NULL WHEN 1 THEN 0.5 WHEN 2 THEN 0.76 ELSE 0.9 END AS reference FROM (VALUES (0), (1), (2), (3)) v(k))
SELECT CAST(k AS BIGINT) AS k, CASE WHEN reference IS NULL THEN 'inconclusive' WHEN reference >= 0.75 THEN 'acceptable' ELSE 'poor' END AS baseline,
 CASE WHEN reference IS NULL THEN 'inconclusive' WHEN reference < 0.75 THEN 'finetuning_or_template_issue' WHEN (SELECT max(hidden_mean) + 0.2 FROM c) < reference - 0.05 THEN 'quantization_issue' ELSE 'mixed_or_acceptable' END AS diagnosis FROM k""")
def verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = candidates(spark, sf_dir).agg((F.max("hidden_mean") + 0.2).alias("best"))
    rows = spark.range(4).withColumnRenamed("id", "k").crossJoin(F.broadcast(best))
    reference = F.when(F.col("k") == 1, 0.5).when(F.col("k") == 2, 0.76).when(F.col("k") == 3, 0.9)
    return rows.select("k", ranking.baseline_verdict(reference).alias("baseline"), ranking.diagnosis(reference, F.col("best")).alias("diagnosis"))


@query("""SELECT p.p_name, (SELECT min(lower(q.p_type)) FROM part q WHERE p.p_name = lower(q.p_type) OR contains(p.p_name, lower(q.p_type))) AS p_type FROM part p""")
def first_match_theta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part with the first type that its name equals or has; many parts share a name, and each keeps its row."""
    parts = table(spark, sf_dir, "part")
    types = parts.select(F.lower("p_type").alias("p_type")).distinct()
    test = (F.col("p_name") == F.col("p_type")) | F.contains("p_name", F.col("p_type"))
    return ranking.first_match(parts.select("p_name"), types, test, order=["p_type"])


@query(f"WITH c AS {_CANDIDATES}, r AS (SELECT name, row_number() OVER (ORDER BY hidden_mean DESC, name) AS place FROM c UNION ALL SELECT 'unknown', 0) SELECT r.name, place, size, peak_rss_kb FROM r LEFT JOIN (SELECT * FROM c WHERE role <> 'control') k ON r.name = k.name")
def ranked_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ranking with figures of the candidates; controls and an unknown name have none."""
    rows = candidates(spark, sf_dir)
    ranks = ranking.ranked(rows, F.col("hidden_mean").desc(), F.col("name")).select("name", F.col("place").cast("long").alias("place"))
    ranks = ranks.unionByName(spark.range(1).select(F.lit("unknown").alias("name"), F.col("id").alias("place")))
    return ranking.enriched(ranks, rows.filter("role <> 'control'"), "name", ["size", "peak_rss_kb"])


@query("SELECT p_type, p_brand, CAST(n AS BIGINT) AS n, CAST(total AS BIGINT) AS total, n >= total * 0.05 AS dominant FROM (SELECT p_type, p_brand, count(*) AS n, sum(count(*)) OVER (PARTITION BY p_type) AS total, row_number() OVER (PARTITION BY p_type ORDER BY count(*) DESC, p_brand DESC) AS k FROM part GROUP BY p_type, p_brand) WHERE k = 1")
def dominant_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.dominant(table(spark, sf_dir, "part"), "p_type", "p_brand", 0.05)


@query("SELECT p_brand, coalesce(string_agg(DISTINCT p_type, ',' ORDER BY p_type) FILTER (p_type NOT IN ('SMALL', 'LARGE', 'ECONOMY')), '') AS foreign_types FROM part GROUP BY p_brand")
def foreign_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ranking.foreign_kinds(table(spark, sf_dir, "part"), "p_brand", "p_type", ["SMALL", "LARGE", "ECONOMY"])
    return found.select("p_brand", F.array_join("foreign", ",").alias("foreign_types"))


@query("""SELECT p_brand AS folder, 'p1' AS filename, CAST(1 AS BIGINT) AS size, CASE WHEN p_brand LIKE '%1' THEN 'p1' WHEN p_brand LIKE '%2' THEN 'only' WHEN p_brand LIKE '%3' THEN 'b' END AS file,
 CASE WHEN p_brand LIKE '%1' OR p_brand LIKE '%2' OR p_brand LIKE '%3' THEN 'found' WHEN p_brand LIKE '%4' THEN 'missing' ELSE 'ambiguous' END AS status FROM (SELECT DISTINCT p_brand FROM part)""")
def resolve_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    recipes = table(spark, sf_dir, "part").select(F.col("p_brand").alias("folder")).distinct().select("folder", F.lit("p1").alias("filename"), F.lit(1).cast("long").alias("size"))
    file = lambda name, size: F.struct(F.lit(name).alias("file"), F.lit(size).cast("long").alias("bytes"))
    last = F.right("folder", F.lit(1))
    held = F.when(last == "1", F.array(file("p1", 5), file("z", 1))).when(last == "2", F.array(file("only", 9))).when(last == "3", F.array(file("a", 2), file("b", 1))).when(last == "4", F.array().cast("array<struct<file:string,bytes:bigint>>")).otherwise(F.array(file("a", 1), file("b", 1)))
    files = recipes.select("folder", F.explode(held).alias("f")).select("folder", "f.file", "f.bytes")
    return ranking.resolve_files(recipes, files)


@query("SELECT p_name FROM (SELECT DISTINCT p_name FROM part) WHERE p_name LIKE '%ring%'")
def first_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    patterns = spark.createDataFrame([(0, "^nothing$"), (1, "ring"), (2, "small")], "rank int, pattern string")
    names = table(spark, sf_dir, "part").select("p_name").distinct()
    return ranking.first_pattern(names, patterns, "p_name")


@query(f"SELECT concat('| name | size |', chr(10), '|---|---|', chr(10), string_agg(concat('| ', name, ' | ', size, ' |'), chr(10) ORDER BY size DESC, name)) AS markdown FROM {_CANDIDATES}")
def leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.leaderboard(ranking.ranked(candidates(spark, sf_dir), F.col("size").desc(), F.col("name")), ["name", "size"])


@query(
    """SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_size / 1000.0 END::DOUBLE AS kld, CASE WHEN p_size % 3 = 1 THEN p_size / 100000.0 END::DOUBLE AS error, p_retailprice AS ppl, CASE WHEN p_size % 2 = 0 THEN 97.5 END::DOUBLE AS same_top, CAST(p_size AS BIGINT) AS chunks FROM part"""
)
def parse_kld(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_size")
    divergence = F.when(k % 3 == 1, F.format_string("Mean    KLD:   %.3f ± %.5f\n", k / 1000, k / 100000)).when(k % 3 == 2, F.format_string("mean kl divergence = %.3f\n", k / 1000)).otherwise("")
    log = F.concat(F.lit("calculating perplexity over "), k, F.lit(" chunks\n"), divergence, F.when(k % 2 == 0, "Same top p: 97.500 ± 0.1\n").otherwise(""), F.format_string("Final estimate: PPL = %.2f +/- 0.1\n", F.col("p_retailprice")))
    value, error = logs.kld_and_error(log)
    return table(spark, sf_dir, "part").select("p_partkey", value.alias("kld"), error.alias("error"), logs.perplexity(log).alias("ppl"), logs.same_top(log).alias("same_top"), logs.chunk_count(log).alias("chunks"))


@query(
    """SELECT p_partkey, concat_ws(',', CASE WHEN p_size % 2 = 0 THEN concat(p_size, '.5') END, concat(p_size, '.25')) AS rates, p_size + 0.25::DOUBLE AS generation, CASE WHEN p_size % 2 = 0 THEN p_size + 0.5 END::DOUBLE AS prompt, p_size * 1000.0::DOUBLE AS memory, p_size % 5 = 0 AS has_flag FROM part"""
)
def parse_bench(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_size")
    log = F.concat(F.lit("| model | test | t/s |\n| --- | --- | --- |\n"), F.when(k % 2 == 0, F.concat(F.lit("| m | pp512 | "), k, F.lit(".5 ± 0.10 |\n"))).otherwise(""), F.lit("| m | tg128 | "), k, F.lit(".25 |\n"))
    rates = logs.rates(log)
    prompt, _ = logs.prompt_and_generation(rates)
    usage = F.concat(F.lit("warming up\n"), k * 1000, F.lit("\nbye"))
    help_text = F.when(k % 5 == 0, "options: -fa, --flash-attn").otherwise("options: --flash-attention")
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(rates.cast("array<string>"), ",").alias("rates"), logs.generation_rate(rates).alias("generation"), prompt.alias("prompt"), logs.peak_memory(usage).alias("memory"), logs.mentions_flag(help_text, "--flash-attn").alias("has_flag"))


@query(
    """WITH e AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS i, unnest(embedding)::DOUBLE AS x FROM embeddings), b AS (SELECT vec_id, i // 32 AS k, arg_max(x, abs(x)) / -8.0 AS scale FROM (SELECT * FROM e ORDER BY vec_id, i) GROUP BY vec_id, k),
q AS (SELECT e.vec_id, x, CASE WHEN scale = 0 THEN 0.0 ELSE (least(15, floor(x / scale + 8.5)) - 8) * scale END AS y FROM e JOIN b ON e.vec_id = b.vec_id AND e.i // 32 = b.k)
SELECT vec_id, round_even(max(abs(x - y)), 6)::DOUBLE AS max_error, round_even(avg(abs(x - y)), 6)::DOUBLE AS mean_error FROM q GROUP BY vec_id"""
)
def lattice_quant(spark: SparkSession, sf_dir: str) -> DataFrame:
    rounded = table(spark, sf_dir, "embeddings").withColumn("rounded", tensors.lattice(F.col("embedding")))
    most, mean = tensors.errors(F.col("embedding"), F.col("rounded"))
    return rounded.select("vec_id", F.bround(most, 6).alias("max_error"), F.bround(mean, 6).alias("mean_error"))


_HALF = "CASE WHEN s = 0 THEN 0.0 ELSE round_even(s / step, 0) * step END"


@query(
    f"""WITH e AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS i, unnest(embedding)::FLOAT AS x FROM embeddings), b AS (SELECT vec_id, i // 32 AS k, (arg_max(x, abs(x)) / CAST(-8.0 AS FLOAT))::FLOAT AS d FROM (SELECT * FROM e ORDER BY vec_id, i) GROUP BY vec_id, k),
h AS (SELECT vec_id, k, d, CAST(CASE WHEN d = 0 THEN 0 ELSE 1.0::DOUBLE / d::DOUBLE END AS FLOAT) AS inverse, CAST({_HALF} AS FLOAT) AS stored FROM (SELECT *, d::DOUBLE AS s, CASE WHEN d = 0 THEN 1.0 ELSE pow(2.0, greatest(floor(log2(abs(d::DOUBLE))), -14.0) - 10) END AS step FROM b)),
q AS (SELECT e.vec_id, x, CAST(CAST(least(15.0, floor(CAST(CAST(x * inverse AS FLOAT) + CAST(8.5 AS FLOAT) AS FLOAT))) - 8 AS FLOAT) * stored AS FLOAT) AS y FROM e JOIN h ON e.vec_id = h.vec_id AND e.i // 32 = h.k)
SELECT vec_id, round_even(max(abs(x::DOUBLE - y::DOUBLE)), 6)::DOUBLE AS max_error, round_even(avg(abs(x::DOUBLE - y::DOUBLE)), 6)::DOUBLE AS mean_error FROM q GROUP BY vec_id"""
)
def lattice_half(spark: SparkSession, sf_dir: str) -> DataFrame:
    rounded = table(spark, sf_dir, "embeddings").withColumn("rounded", F.transform(tensors.lattice_half(F.col("embedding")), lambda x: x.cast("double")))
    most, mean = tensors.errors(F.col("embedding"), F.col("rounded"))
    return rounded.select("vec_id", F.bround(most, 6).alias("max_error"), F.bround(mean, 6).alias("mean_error"))


@query(
    """WITH t AS (SELECT p_brand, list(CASE WHEN p_partkey % 97 = 0 AND p_brand LIKE '%1' THEN 'inf'::DOUBLE WHEN p_brand LIKE '%2' THEN p_size - 1 ELSE p_size END::DOUBLE) AS counts FROM part GROUP BY p_brand), m AS (SELECT list_min(counts) AS least, list_max(counts) AS most FROM t), k AS (SELECT *, isinf(least) OR isinf(most) OR isnan(least) OR isnan(most) AS odd FROM m)
 SELECT min(least) FILTER (NOT odd) AS count_min, max(most) FILTER (NOT odd) AS count_max, CAST(count(*) FILTER (odd) AS BIGINT) AS n_nonfinite, CAST(count(*) FILTER (NOT odd AND least <= 0) AS BIGINT) AS n_zero FROM k"""
)
def counter_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands as tensors of counts: some hold an infinity, some a zero."""
    brand, size = F.col("p_brand"), F.col("p_size").cast("double")
    value = F.when((F.col("p_partkey") % 97 == 0) & brand.endswith("1"), F.lit(float("inf"))).when(brand.endswith("2"), size - 1).otherwise(size)
    return tensors.counter_range(table(spark, sf_dir, "part").groupBy("p_brand").agg(F.collect_list(value).alias("counts")), "p_brand", "counts")


@query("SELECT CAST(s_suppkey AS BIGINT) AS s_suppkey, concat(s_nationkey, ':<a>:', 'true,', s_nationkey + 1, ':b:', CASE WHEN s_suppkey % 2 = 0 THEN 'true' ELSE 'false' END) AS tokens, CAST(s_nationkey AS VARCHAR) AS end_ids, CASE WHEN s_suppkey % 3 = 0 THEN s_nationkey END AS block FROM supplier")
def control_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    token = lambda i, c, s: F.struct(i.alias("id"), F.lit(c).alias("content"), s.alias("special"))
    n = F.col("s_nationkey")
    tokens = F.array(token(n, "<a>", F.lit(False)), token(n + 1, "b", F.col("s_suppkey") % 2 == 0))
    patched = tensors.patch_control_tokens(tokens, ["<a>"])
    shown = F.array_join(F.transform(patched, lambda t: F.concat_ws(":", t["id"].cast("string"), t["content"], t["special"].cast("string"))), ",")
    name = F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit("blk."), n, F.lit(".x"))).otherwise("output")
    return table(spark, sf_dir, "supplier").select("s_suppkey", shown.alias("tokens"), F.array_join(tensors.end_ids(tokens, ["<a>"]).cast("array<string>"), ",").alias("end_ids"), tensors.block_index(name).alias("block"))


@query("SELECT CAST(n AS BIGINT) AS n, event_type, start FROM (SELECT count(*) AS n, event_type, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS start FROM events GROUP BY event_type, date_trunc('hour', ts))")
def windowed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.streaming.incremental import windowed_counts as counts

    found = counts(table(spark, sf_dir, "events"), "ts", "event_type")
    return found.select("n", "event_type", F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"))
