"""Queries over counts, reports, de-duplication, resumable work and manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as tx
from millrace.operators import dedup, incremental, reports
from millrace.plans.registry import registry
from millrace.plans.text_plans import _SCORE_SQL, NORM, scored_documents
from millrace.session import spread, table
from millrace.sources import manifest

QUERIES, ORACLES, query = registry()


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


@query("SELECT lang, CAST(count(*) AS BIGINT) AS n FROM documents GROUP BY lang")
def language_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.counts(_docs(spark, sf_dir), "lang").orderBy("lang")


@query("SELECT lang, min(doc_id) AS first FROM documents GROUP BY lang")
def first_seen_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.first_seen(_docs(spark, sf_dir), "lang", "doc_id").orderBy("first")


@query("SELECT source, string_agg(concat(lang, ':', n), ',' ORDER BY lang) AS composition FROM (SELECT source, lang, count(*) AS n FROM documents GROUP BY source, lang) GROUP BY source")
def composition_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = reports.counts(_docs(spark, sf_dir).select("source", "lang").withColumn("both", F.struct("source", "lang")), "both")
    listed = per.groupBy("both.source").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("both.lang"), "n")))).alias("m"))
    return listed.select("source", F.array_join(F.transform(F.map_entries("m"), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string"))), ",").alias("composition"))


@query(
    """SELECT lang, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) FILTER (quality = 0) AS BIGINT) AS poor, round_even(count(*) FILTER (quality = 0) / greatest(1, count(*)), 6)::DOUBLE AS poor_fraction,
 CAST(count(*) FILTER (n_chars > 2000) AS BIGINT) AS long, round_even(count(*) FILTER (n_chars > 2000) / greatest(1, count(*)), 6)::DOUBLE AS long_fraction FROM documents JOIN labels USING (doc_id) GROUP BY lang"""
)
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _docs(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id")
    return reports.quality(rows, "lang", {"poor": F.col("quality") == 0, "long": F.col("n_chars") > 2000})


@query("SELECT (SELECT count(*) FROM documents WHERE n_chars < 200) AS n_bad, (SELECT string_agg(doc_id, ',' ORDER BY doc_id) FROM (SELECT doc_id FROM documents WHERE n_chars < 200 ORDER BY doc_id LIMIT 20)) AS preview")
def bad_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = reports.offenders(_docs(spark, sf_dir).select("doc_id", "n_chars"), F.col("n_chars") < 200, "doc_id")
    return found.select("n_bad", F.array_join("preview", ",").alias("preview"))


@query("SELECT lang, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(least(n_chars // 4, 500)) AS BIGINT) AS n_tokens, CAST(count(*) FILTER (n_chars // 4 > 500) AS BIGINT) AS n_cut FROM documents GROUP BY lang")
def corpus_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.corpus(_docs(spark, sf_dir).withColumn("tokens", F.expr("n_chars div 4")), "lang", "tokens", 500)


@query(f"SELECT CAST(count(*) AS BIGINT) AS n, round_even(avg(score), 3)::DOUBLE AS mean_score, CAST(count(*) FILTER (invented_dose) AS BIGINT) AS safety_failures, CAST(count(*) FILTER (NOT language_ok) AS BIGINT) AS language_failures FROM {_SCORE_SQL}")
def eval_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.report(scored_documents(spark, sf_dir), "score", {"safety_failures": F.col("invented_dose"), "language_failures": ~F.col("language_ok")})


@query(f"SELECT 'language' AS dimension, lang AS key, CAST(count(*) AS BIGINT) AS n, round_even(avg(score), 3)::DOUBLE AS mean FROM {_SCORE_SQL} GROUP BY lang UNION ALL SELECT 'category', category, CAST(count(*) AS BIGINT), round_even(avg(score), 3)::DOUBLE FROM {_SCORE_SQL} GROUP BY category")
def breakdown_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.breakdown(scored_documents(spark, sf_dir).withColumnRenamed("lang", "language"), "score", "language", "category")


@query("SELECT 'ok' AS gate, CAST(count(*) AS BIGINT) AS n FROM documents")
def fraction_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir).select("doc_id", "n_chars")
    short = reports.fraction(F.count_if(F.col("n_chars") < 2), F.count(F.lit(1))) <= 0.01
    enough = F.count(F.lit(1)) >= 32
    return reports.gate(reports.gate(docs, short, "too many short rows"), enough, "too few rows").agg(F.lit("ok").alias("gate"), F.count(F.lit(1)).alias("n"))


@query(f"SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY substr({NORM}, 1, 2000) ORDER BY doc_id) AS k FROM documents) WHERE k = 1")
def row_key_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = spread(_docs(spark, sf_dir).select("doc_id", "lang", "text")).select("doc_id", "lang", tx.row_key(F.col("text"), F.lit("")).alias("key"))
    return dedup.first_wins(keyed, ["key"], ["doc_id"]).select("doc_id", "lang")


@query("SELECT doc_id, CAST(count(*) AS BIGINT) AS n FROM (SELECT doc_id FROM documents UNION ALL SELECT doc_id FROM documents WHERE doc_id % 10 = 0) GROUP BY doc_id HAVING count(*) > 1")
def duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = _docs(spark, sf_dir).select("doc_id")
    return dedup.duplicate_keys(ids.unionByName(ids.filter("doc_id % 10 = 0")), "doc_id")


@query(f"""WITH k AS (SELECT doc_id, substr({NORM}, 1, 2000) AS key, CASE WHEN doc_id % 10 = 0 THEN 'held' WHEN doc_id % 10 < 3 THEN 'eval' ELSE 'train' END AS part FROM documents)
SELECT doc_id, part FROM k WHERE part = 'eval' AND key NOT IN (SELECT key FROM k WHERE part = 'train') UNION ALL SELECT doc_id, part FROM k WHERE part = 'held' AND key NOT IN (SELECT key FROM k WHERE part <> 'held')""")
def leakage_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.when(F.col("doc_id") % 10 == 0, "held").when(F.col("doc_id") % 10 < 3, "eval").otherwise("train")
    keyed = spread(_docs(spark, sf_dir).select("doc_id", "lang", "source", "text")).select("doc_id", tx.row_key(F.col("text"), F.lit("")).alias("key"), part.alias("part"))
    train, evaluation, held = (keyed.filter(F.col("part") == p) for p in ("train", "eval", "held"))
    clean = dedup.without(evaluation, train, on=["key"]).unionByName(dedup.without(held, train, evaluation, on=["key"]))
    return clean.select("doc_id", "part")


@query("SELECT d.source, d.doc_id FROM documents d ANTI JOIN (SELECT d.source, l.doc_id FROM labels l JOIN documents d USING (doc_id) WHERE quality = 1) s ON d.source = s.source AND d.doc_id = s.doc_id")
def disjoint_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir).select("source", "doc_id")
    used = docs.join(table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id"), "doc_id")
    return dedup.without(docs, used, on=["source", "doc_id"])


@query("SELECT source, doc_id FROM documents WHERE n_chars > 1000 INTERSECT SELECT source, doc_id FROM documents JOIN labels USING (doc_id) WHERE toxic = 1")
def overlap_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir).select("source", "doc_id", "n_chars")
    toxic = docs.join(table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id"), "doc_id")
    return dedup.overlap(docs.filter("n_chars > 1000"), toxic, ["source", "doc_id"])


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND doc_id NOT IN (SELECT item_id FROM benchmark)")
def remaining_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"))
    return incremental.remaining(_docs(spark, sf_dir).select("doc_id"), table(spark, sf_dir, "labels"), failed, key="doc_id")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)")
def unsubmitted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = table(spark, sf_dir, "labels").filter("quality = 1").groupBy((F.col("doc_id") % 7).alias("chunk_index")).agg(F.collect_list("doc_id").alias("source_ids"))
    return incremental.unsubmitted(_docs(spark, sf_dir).select("doc_id"), state, "doc_id")


@query("SELECT d.doc_id, CASE WHEN toxic = 0 AND quality = 1 THEN concat('a', d.doc_id) END AS content FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
def response_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    message = F.struct(F.struct(F.concat(F.lit("a"), "doc_id").alias("content")).alias("message"))
    body = F.struct(F.when(F.col("toxic") == 1, F.array().cast("array<struct<message:struct<content:string>>>")).otherwise(F.array(message)).alias("choices"))
    response = F.struct(F.when(F.col("quality") == 0, 500).otherwise(200).alias("status_code"), body.alias("body"))
    responses = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("custom_id"), F.lit(None).cast("string").alias("error"), response.alias("response"))
    return incremental.with_responses(_docs(spark, sf_dir).select("doc_id"), responses, "doc_id").select("doc_id", incremental.response_content().alias("content"))


@query("SELECT l.doc_id, CASE WHEN d.doc_id IS NULL THEN 'keep' WHEN d.n_chars > 500 AND l.quality = 1 THEN 'keep' ELSE 'redo' END AS verdict FROM labels l LEFT JOIN (SELECT * FROM documents WHERE lang = 'en') d ON l.doc_id = d.doc_id")
def revalidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _docs(spark, sf_dir).filter("lang = 'en'").select("doc_id", "n_chars")
    return incremental.revalidated(table(spark, sf_dir, "labels"), source, "doc_id", (F.col("n_chars") > 500) & (F.col("quality") == 1)).select("doc_id", "verdict")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS k FROM events) WHERE k = 1")
def last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.last_wins(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), ["user_id"], "event_id")


@query("SELECT l.doc_id, l.quality, d.n_chars FROM labels l JOIN documents d ON l.doc_id = d.doc_id")
def source_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return incremental.in_source_order(done, _docs(spark, sf_dir).select("doc_id", "n_chars"), "doc_id", "n_chars")


@query("SELECT lang, CAST(count(*) AS BIGINT) AS expected, CAST(count(l.doc_id) AS BIGINT) AS covered, round_even(count(l.doc_id) / count(*), 6)::DOUBLE AS ratio FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY lang")
def family_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.coverage(_docs(spark, sf_dir).select("doc_id", "lang"), table(spark, sf_dir, "labels"), "doc_id", "lang")


@query("SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CASE WHEN l.doc_id IS NULL THEN 'left' ELSE 'right' END AS side FROM (SELECT doc_id FROM documents WHERE lang = 'en') d FULL JOIN labels l ON d.doc_id = l.doc_id WHERE d.doc_id IS NULL OR l.doc_id IS NULL")
def key_symdiff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.symmetric_difference(_docs(spark, sf_dir).filter("lang = 'en'"), table(spark, sf_dir, "labels"), "doc_id")


@query("SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'missing' WHEN d.text = lower(d.text) OR d.doc_id % 2 = 0 THEN 'ok' ELSE 'changed' END AS status FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def manifest_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    listed = docs.select("doc_id", F.sha2("text", 256).alias("sha256"))
    there = docs.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id").select("doc_id", F.sha2(F.when(F.col("doc_id") % 2 == 0, F.col("text")).otherwise(F.lower("text")), 256).alias("sha256"))
    return manifest.verify(listed, there, "doc_id")


@query("""SELECT * FROM (SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'missing' ELSE concat_ws(',', CASE WHEN d.doc_id % 3 = 0 THEN 'size' END, CASE WHEN l.quality = 0 THEN 'digest' END) END AS reasons FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id) WHERE reasons <> ''""")
def stale_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir).select("doc_id", F.col("n_chars").alias("size"), F.sha1("text").alias("digest"))
    facts = docs.join(table(spark, sf_dir, "labels"), "doc_id").select("doc_id", (F.col("size") + F.when(F.col("doc_id") % 3 == 0, 1).otherwise(0)).alias("f_size"), F.when(F.col("quality") == 0, "other").otherwise(F.col("digest")).alias("f_digest"))
    found = manifest.stale(docs, facts, "doc_id", {"size": ("size", "f_size"), "digest": ("digest", "f_digest")})
    return found.select("doc_id", F.array_join("reasons", ",").alias("reasons"))


@query("SELECT CAST(count(*) AS BIGINT) AS files, CAST(sum(n_chars) AS BIGINT) AS bytes FROM documents")
def manifest_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.totals(_docs(spark, sf_dir).select(F.col("n_chars").alias("size")))


@query("SELECT concat('blk.', l_orderkey) AS base, bool_or(l_linenumber = 1) AS has_first, bool_or(l_linenumber = 2) AS has_second FROM lineitem WHERE l_linenumber IN (1, 2) GROUP BY l_orderkey")
def suffix_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    suffix = F.when(F.col("l_linenumber") == 1, ".in_sum2").when(F.col("l_linenumber") == 2, ".counts").otherwise(".other")
    names = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("blk."), "l_orderkey", suffix).alias("name"))
    return manifest.paired(names, "name", r"\.in_sum2", r"\.counts")


@query("SELECT CAST(count(*) AS BIGINT) AS sampled, CAST(count(*) FILTER (ignored) AS BIGINT) AS n, round_even(count(*) FILTER (ignored) / greatest(1, count(*)), 6)::DOUBLE AS part FROM (SELECT doc_id % 3 = 0 AS ignored FROM documents ORDER BY doc_id LIMIT 64)")
def sampled_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id") % 3
    labels = F.when(k == 0, F.array(F.lit(-100), F.lit(-100))).otherwise(F.array(F.lit(-100), F.lit(5)))
    return reports.sampled_share(_docs(spark, sf_dir).select("doc_id", labels.alias("labels")), reports.all_ignored(F.col("labels")), "doc_id")


@query("SELECT doc_id, concat_ws(',', CASE WHEN doc_id % 2 = 0 THEN 'lang' END, CASE WHEN n_chars < 500 THEN 'text' END) AS missing FROM documents")
def required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _docs(spark, sf_dir).select("doc_id", F.when(F.col("doc_id") % 2 == 0, "  ").otherwise(F.col("lang")).alias("lang"), F.when(F.col("n_chars") >= 500, F.col("text")).alias("text"), "source")
    return rows.select("doc_id", F.array_join(reports.missing_fields("lang", "text", "source"), ",").alias("missing"))


@query("SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'text-generation,x' WHEN 1 THEN 'x,text-generation' ELSE 'text-generation' END AS categories, CASE s_suppkey % 3 WHEN 0 THEN 'conversational,x,new' WHEN 1 THEN 'x,text-generation,new' ELSE 'new' END AS tags FROM supplier")
def tag_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey") % 3
    tags = F.when(k == 0, F.array(F.lit("conversational"), F.lit("x"))).when(k == 1, F.array(F.lit("x"), F.lit("text-generation")))
    shown = lambda c: F.array_join(c, ",")
    return table(spark, sf_dir, "supplier").select("s_suppkey", shown(reports.patched_tags(tags, drop=("conversational",), first=("text-generation",))).alias("categories"), shown(reports.patched_tags(tags, last=("new",))).alias("tags"))


@query("SELECT p_partkey, concat('1.', p_size % 4) AS wanted, CASE WHEN p_size % 5 > 0 THEN concat('1.', p_size % 3, '+cpu') END AS installed FROM part WHERE p_size % 5 = 0 OR p_size % 4 <> p_size % 3")
def version_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts, k = table(spark, sf_dir, "part"), F.col("p_size")
    wanted = parts.select("p_partkey", F.concat(F.lit("1."), k % 4).alias("version"))
    installed = parts.filter(k % 5 > 0).select("p_partkey", F.concat(F.lit("1."), k % 3, F.lit("+cpu")).alias("version"))
    return manifest.version_mismatch(wanted, installed, "p_partkey")


@query("SELECT doc_id, doc_id % 4 <> 0 AS same FROM documents JOIN labels USING (doc_id)")
def identical_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir).select("doc_id", F.sha2("text", 256).alias("sha256"))
    other = _docs(spark, sf_dir).join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id").select("doc_id", F.sha2(F.when(F.col("doc_id") % 4 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text")), 256).alias("sha256"))
    return manifest.identical(docs, other, "doc_id")


@query("SELECT name FROM (SELECT concat(CASE p_size % 4 WHEN 0 THEN 'v.' WHEN 1 THEN 'blk.' WHEN 2 THEN 'x.MMproj.' ELSE 'vision' END, p_partkey) AS name FROM part) WHERE name LIKE 'v.%' OR contains(lower(name), 'mmproj')")
def name_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_size") % 4
    names = table(spark, sf_dir, "part").select(F.concat(F.when(k == 0, "v.").when(k == 1, "blk.").when(k == 2, "x.MMproj.").otherwise("vision"), "p_partkey").alias("name"))
    return manifest.name_leaks(names, "name")


_TENSORS = ("blk.0.nextn.eh_proj", "mtp.layers.0.w", "blk.1.DRAFT_head.w", "model.draft.x", "drafts.w", "xmtp.w", "model.layers.15.self_attn.k_proj", "model.layers.34.self_attn.v_proj.linear", "m.layers.20.self_attn.k_norm.weight", "m.layers.14.self_attn.k_proj", "m.layers.35.self_attn.v_proj", "m.layers.22.self_attn.q_proj", "m.layers.29.self_attn.v_proj.lora_A.weight", "m.layers.30.self_attn.k_norm")


def _pick(key: str) -> str:
    return f"CASE ({key}) % {len(_TENSORS)} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in enumerate(_TENSORS)) + " END"


def _named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.expr(_pick("p_partkey")).alias("name"))


@query(f"SELECT p_partkey, name FROM (SELECT p_partkey, {_pick('p_partkey')} AS name FROM part) WHERE len(list_intersect(string_split_regex(lower(name), '[._]'), ['mtp', 'draft', 'nextn'])) > 0")
def draft_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.draft_names(_named(spark, sf_dir), "name")


_LAYER = "regexp_extract(name, '\\.layers\\.([0-9]+)\\.', 1)"


@query(
    f"""WITH n AS (SELECT p_partkey, {_pick('p_partkey')} AS name FROM part), l AS (SELECT *, coalesce(try_cast({_LAYER} AS INTEGER) BETWEEN 15 AND 34, false) AS low, string_split(name, '.') AS parts FROM n),
 k AS (SELECT *, len(list_filter(range(1, len(parts)), lambda i: parts[i] = 'self_attn' AND parts[i + 1] IN ('k_proj', 'v_proj'))) > 0 AS kv, contains(name, 'self_attn.k_norm') AS norm, parts[-1] AS last FROM l)
 SELECT p_partkey, array_to_string(list_filter([CASE WHEN low AND kv THEN 'adapter' END, CASE WHEN low AND (kv OR norm) THEN 'key' END, CASE WHEN low AND kv AND (last IN ('k_proj', 'v_proj') OR (last = 'linear' AND parts[-2] IN ('k_proj', 'v_proj'))) THEN 'module' END, CASE WHEN low AND (kv OR norm) AND last NOT IN ('k_proj', 'v_proj', 'k_norm') THEN 'state' END], lambda x: x IS NOT NULL), ',') AS kinds FROM k"""
)
def shared_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named(spark, sf_dir).select("p_partkey", F.array_join(manifest.shared_kinds(F.col("name")), ",").alias("kinds"))
