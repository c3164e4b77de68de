"""Queries over conversations and preference pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import dialog, reports
from millrace.plans.registry import registry
from millrace.session import table

QUERIES, ORACLES, query = registry()


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per conversation: conv_id, messages."""
    return dialog.gather(table(spark, sf_dir, "conversations"))


CLEAN = r"""(SELECT conv_id, turn, lower(role) AS role, regexp_replace(text, '^\s+|\s+$', '', 'g') AS content FROM conversations WHERE lower(role) IN ('user', 'assistant') AND trim(text) <> '')"""


def digest(turns) -> Column:
    """A dialog's turns as one digest."""
    return F.sha1(F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit(":"), t["content"])), "\n"))


def sql_digest(rows: str) -> str:
    return f"SELECT conv_id, CAST(count(*) AS BIGINT) AS n, sha1(string_agg(concat(role, ':', content), chr(10) ORDER BY turn)) AS digest FROM {rows} GROUP BY conv_id"


@query("SELECT role, CAST(count(*) AS BIGINT) AS n FROM (SELECT CASE lower(r) WHEN 'human' THEN 'user' WHEN 'model' THEN 'assistant' WHEN 'gpt' THEN 'assistant' ELSE lower(r) END AS role FROM (SELECT CASE turn % 4 WHEN 0 THEN 'Human' WHEN 1 THEN 'GPT' WHEN 2 THEN 'model' ELSE role END AS r FROM conversations)) GROUP BY role")
def role_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("turn") % 4
    role = F.when(k == 0, "Human").when(k == 1, "GPT").when(k == 2, "model").otherwise(F.col("role"))
    return table(spark, sf_dir, "conversations").select(dialog.role_name(role).alias("role")).groupBy("role").agg(F.count(F.lit(1)).alias("n"))


@query(sql_digest(CLEAN))
def clean_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = conversations(spark, sf_dir).select("conv_id", dialog.clean(F.col("messages")).alias("m")).filter(F.size("m") > 0)
    return cleaned.select("conv_id", F.size("m").cast("long").alias("n"), digest(F.col("m")).alias("digest"))


@query(
    f"""WITH c AS {CLEAN}, f AS (SELECT conv_id, min(turn) AS first_user FROM c WHERE role = 'user' GROUP BY conv_id)
SELECT f.conv_id, (SELECT arg_max(content, turn) FROM c WHERE c.conv_id = f.conv_id AND role = 'user') AS instruction, (SELECT arg_max(content, turn) FROM c WHERE c.conv_id = f.conv_id AND role = 'assistant' AND turn > first_user) AS response
FROM f WHERE response IS NOT NULL"""
)
def last_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = conversations(spark, sf_dir).select("conv_id", dialog.last_pair(dialog.clean(F.col("messages"))).alias("p"))
    return pairs.filter("p is not null").select("conv_id", F.col("p.user").alias("instruction"), F.col("p.assistant").alias("response"))


@query(
    f"""WITH c AS {CLEAN}, f AS (SELECT conv_id, min(turn) AS first_user FROM c WHERE role = 'user' GROUP BY conv_id)
SELECT f.conv_id, (SELECT arg_min(content, turn) FROM c WHERE c.conv_id = f.conv_id AND role = 'user') AS instruction, (SELECT arg_min(content, turn) FROM c WHERE c.conv_id = f.conv_id AND role = 'assistant' AND turn > first_user) AS response
FROM f WHERE response IS NOT NULL"""
)
def first_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = conversations(spark, sf_dir).select("conv_id", dialog.first_pair(dialog.clean(F.col("messages"))).alias("p"))
    return pairs.filter("p is not null").select("conv_id", F.col("p.user").alias("instruction"), F.col("p.assistant").alias("response"))


_AS_USER = r"(SELECT conv_id, turn, CASE WHEN role = 'assistant' AND turn % 3 <> 0 THEN 'assistant' ELSE 'user' END AS role, regexp_replace(text, '^\s+|\s+$', '', 'g') AS content FROM conversations)"
_MERGED = f"""(SELECT conv_id, min(turn) AS turn, any_value(role) AS role, string_agg(content, chr(10) ORDER BY turn) AS content FROM
 (SELECT *, sum(change) OVER (PARTITION BY conv_id ORDER BY turn) AS island FROM (SELECT *, CASE WHEN lag(role) OVER (PARTITION BY conv_id ORDER BY turn) IS DISTINCT FROM role THEN 1 ELSE 0 END AS change FROM {_AS_USER})) GROUP BY conv_id, island)"""


def _mixed_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations with neighbours of one role."""
    rows = table(spark, sf_dir, "conversations")
    role = F.when((F.col("role") == "assistant") & (F.col("turn") % 3 != 0), "assistant").otherwise("user")
    return dialog.gather(rows.withColumn("role", role)).select("conv_id", dialog.clean(F.col("messages")).alias("m"))


@query(sql_digest(_MERGED))
def merge_adjacent_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = _mixed_roles(spark, sf_dir).select("conv_id", dialog.merge_adjacent(F.col("m")).alias("m"))
    return merged.select("conv_id", F.size("m").cast("long").alias("n"), digest(F.col("m")).alias("digest"))


@query(
    f"""WITH m AS {_MERGED}, s AS (SELECT m.* FROM m JOIN (SELECT conv_id, min(turn) AS t FROM m WHERE role = 'user' GROUP BY conv_id) f ON m.conv_id = f.conv_id AND m.turn >= f.t)
{sql_digest("(SELECT s.* FROM s JOIN (SELECT conv_id FROM s GROUP BY conv_id HAVING arg_max(role, turn) = 'assistant') e ON s.conv_id = e.conv_id)")}"""
)
def alternating_dialog(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _mixed_roles(spark, sf_dir).select("conv_id", dialog.alternating(F.col("m")).alias("m")).filter(F.size("m") > 0)
    return found.select("conv_id", F.size("m").cast("long").alias("n"), digest(F.col("m")).alias("digest"))


@query("SELECT conv_id, CAST(count(*) + (CASE WHEN arg_min(role, turn) = 'system' THEN 0 ELSE 1 END) AS BIGINT) AS n, CASE WHEN arg_min(role, turn) = 'system' THEN arg_min(text, turn) ELSE 'Be brief.' END AS opening FROM conversations GROUP BY conv_id")
def inject_system(spark: SparkSession, sf_dir: str) -> DataFrame:
    injected = conversations(spark, sf_dir).select("conv_id", dialog.inject_system(F.col("messages"), "Be brief.").alias("m"))
    return injected.select("conv_id", F.size("m").cast("long").alias("n"), F.get("m", F.lit(0))["content"].alias("opening"))


@query(
    """SELECT conv_id, sha1(r) AS digest, CAST(n AS BIGINT) AS starts, CAST(n AS BIGINT) AS ends, contains(r, concat('<|im_start|>assistant', chr(10))) AS answered FROM
 (SELECT conv_id, string_agg(concat('<|im_start|>', role, chr(10), text, '<|im_end|>', chr(10)), '' ORDER BY turn) AS r, count(*) AS n FROM conversations GROUP BY conv_id)"""
)
def render_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rendered = conversations(spark, sf_dir).select("conv_id", dialog.render(F.col("messages")).alias("r"))
    return rendered.select("conv_id", F.sha1("r").alias("digest"), dialog.marker_count(F.col("r"), "<|im_start|>").alias("starts"), dialog.marker_count(F.col("r"), "<|im_end|>").alias("ends"), dialog.has_answer(F.col("r")).alias("answered"))


@query(
    r"""SELECT concat('docs-', doc_id) AS source_id, CASE lang WHEN 'en' THEN 'english' WHEN 'es' THEN 'swahili' ELSE lang END AS language, source, concat('Write in ', lang) AS instruction, sha1(regexp_replace(text, '^\s+|\s+$', '', 'g')) AS response FROM documents WHERE trim(text) <> ''"""
)
def normalize_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    raw = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_index"), F.when(F.col("lang") == "es", "Kiswahili").otherwise(F.col("lang")).alias("language"), "source", F.lit("").alias("source_id"), dialog.clean(F.array(turn("human", F.concat(F.lit("Write in "), "lang")), turn("gpt", F.col("text")))).alias("messages"))
    return dialog.canonical_rows(raw, "docs").select("source_id", "language", "source", "instruction", F.sha1("response").alias("response"))


_PAIR_SQL = """(SELECT a.conv_id, a.text AS prompt, b.text AS chosen, c.text AS rejected FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 AND b.role = 'assistant'
 JOIN conversations c ON a.conv_id = c.conv_id AND c.turn = a.turn + 3 AND c.role = 'assistant' WHERE a.role = 'user')"""


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user turn with its answer as chosen and the next answer as rejected, in both layouts."""
    turns = table(spark, sf_dir, "conversations")
    shift = lambda name, by: turns.filter("role = 'assistant'").select("conv_id", (F.col("turn") - by).alias("turn"), F.col("text").alias(name))
    joined = turns.filter("role = 'user'").join(shift("chosen_text", 1), ["conv_id", "turn"]).join(shift("rejected_text", 3), ["conv_id", "turn"])
    one = lambda role, c: F.array(F.struct(F.lit(role).alias("role"), F.col(c).alias("content")))
    flat = F.col("conv_id") % 2 == 0
    return joined.select("conv_id", F.when(~flat, one("Human", "text")).alias("prompt"), F.when(~flat, one("assistant", "chosen_text")).alias("chosen"), F.when(~flat, one("gpt", "rejected_text")).alias("rejected"), F.when(flat, F.col("text")).alias("instruction"), F.when(flat, F.col("chosen_text")).alias("chosen_text"), F.when(flat, F.col("rejected_text")).alias("rejected_text"))


@query(f"SELECT conv_id, sha1(regexp_replace(prompt, '^\\s+|\\s+$', '', 'g')) AS prompt, sha1(regexp_replace(chosen, '^\\s+|\\s+$', '', 'g')) AS chosen, sha1(regexp_replace(rejected, '^\\s+|\\s+$', '', 'g')) AS rejected, 'user,model,model' AS roles FROM {_PAIR_SQL}")
def preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = dialog.preference_pairs(_pairs(spark, sf_dir))
    first = lambda c: F.get(c, F.lit(0))
    return pairs.select("conv_id", *[F.sha1(first(c)["content"]).alias(c) for c in ("prompt", "chosen", "rejected")], F.concat_ws(",", *[first(c)["role"] for c in ("prompt", "chosen", "rejected")]).alias("roles"))


_WORDS = "len(string_split({}, ' '))"


@query(
    f"""WITH p AS (SELECT a.conv_id, a.turn, a.text AS prompt, CASE WHEN a.conv_id % 5 = 4 THEN ' ' ELSE b.text END AS chosen, c.text AS rejected FROM conversations a LEFT JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 AND b.role = 'assistant' LEFT JOIN conversations c ON a.conv_id = c.conv_id AND c.turn = a.turn + 3 AND c.role = 'assistant' WHERE a.role = 'user'),
 n AS (SELECT *, {_WORDS.format('prompt')} AS np, greatest({_WORDS.format('chosen')}, {_WORDS.format('rejected')}) AS nl FROM p)
 SELECT outcome, CAST(count(*) AS BIGINT) AS n FROM (SELECT CASE WHEN chosen IS NULL OR rejected IS NULL THEN 'invalid_row' WHEN conv_id % 13 = 12 THEN 'render_splice_failed' WHEN np > 40 THEN 'prompt_too_long' WHEN nl > 50 THEN 'completion_too_long' WHEN np + nl > 70 THEN 'too_long' WHEN trim(chosen) = '' OR trim(rejected) = '' THEN 'empty_completion' ELSE 'kept' END AS outcome FROM n) GROUP BY outcome"""
)
def pair_gate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each question with its answer and the next one, words as tokens; some renderings don't splice, some are empty."""
    turns = table(spark, sf_dir, "conversations")
    shift = lambda name, by: turns.filter("role = 'assistant'").select("conv_id", (F.col("turn") - by).alias("turn"), F.col("text").alias(name))
    rows = turns.filter("role = 'user'").join(shift("chosen", 1), ["conv_id", "turn"], "left").join(shift("rejected", 3), ["conv_id", "turn"], "left")
    whole = F.concat(F.lit("<user>"), "text", F.lit("<model>"))
    prompt = F.when(F.col("conv_id") % 13 == 12, F.lit("other")).otherwise(whole)
    chosen = F.when(F.col("conv_id") % 5 == 4, F.when(F.col("chosen").isNotNull(), " ")).otherwise(F.col("chosen"))
    rows = rows.withColumn("chosen", chosen)
    spliced = lambda c: dialog.splice(F.concat(whole, c), prompt)
    words = lambda c: F.size(F.split(c, " "))
    outcome = dialog.pair_gate(F.col("chosen").isNotNull() & F.col("rejected").isNotNull(), prompt, spliced("chosen"), spliced("rejected"), words("text"), words(spliced("chosen")), words(spliced("rejected")), most_prompt=40, most_completion=50, most_total=70)
    return reports.counts(rows.withColumn("outcome", outcome), "outcome")


@query("SELECT conv_id, sha1(substr(w, length(p) + 1)) AS completion FROM (SELECT conv_id, string_agg(concat(role, ':', text, chr(10)), '' ORDER BY turn) AS w, string_agg(concat(role, ':', text, chr(10)), '' ORDER BY turn) FILTER (turn < 2) AS p FROM conversations GROUP BY conv_id)")
def render_splice(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = lambda turns: F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit(":"), t["content"], F.lit("\n"))), "")
    rows = conversations(spark, sf_dir).select("conv_id", line(F.col("messages")).alias("w"), line(F.slice("messages", 1, 2)).alias("p"))
    return rows.select("conv_id", F.sha1(dialog.splice(F.col("w"), F.col("p"))).alias("completion"))


@query(sql_digest(f"(SELECT conv_id, turn, role, content FROM {CLEAN} WHERE conv_id % 2 = 0 UNION ALL SELECT conv_id, 0, 'user', 'q' FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id % 2 = 1) UNION ALL SELECT conv_id, 1, 'assistant', 'a' FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id % 2 = 1))"))
def dialog_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations(spark, sf_dir).withColumn("messages", F.when(F.col("conv_id") % 2 == 0, F.col("messages")))
    found = rows.select("conv_id", dialog.dialog_messages(F.col("messages"), F.lit(" q "), F.lit("a"), merge=False).alias("m")).filter(F.size("m") > 0)
    return found.select("conv_id", F.size("m").cast("long").alias("n"), digest(F.col("m")).alias("digest"))
