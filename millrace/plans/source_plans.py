"""Queries over readers and writers: each writes files below the work folder and reads them back.

Lines are made from conversations: one a conversation, in four files of ascending conv_id, so that places in a file are
known. The layout of a line goes by conv_id.
"""

from __future__ import annotations

import json
import struct

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import dialog, reports
from millrace.plans.registry import registry
from millrace.session import table, work_path
from millrace.sources import catalog, jsonl, manifest, sinks, tensor_files

QUERIES, ORACLES, query = registry()

FILES = 4
_TRIM = r"regexp_replace(text, '^\s+|\s+$', '', 'g')"
#: The first user turn and the first later answer of each conversation, and all of its user and assistant turns.
_ENDS = f"""(SELECT c.conv_id, arg_min({_TRIM}, turn) FILTER (role = 'user') AS u, arg_min({_TRIM}, turn) FILTER (role = 'assistant') AS a FROM conversations c GROUP BY c.conv_id)"""
_TURNS = f"""(SELECT conv_id, turn, role, {_TRIM} AS content FROM conversations WHERE role IN ('user', 'assistant') AND trim(text) <> '')"""
#: What a line of each layout holds, as turns: layouts 3 and 4 have the first question and answer only.
_LAYOUTS = f"""(SELECT * FROM {_TURNS} WHERE conv_id % 6 NOT IN (3, 4) UNION ALL SELECT conv_id, 0, 'user', u FROM {_ENDS} WHERE conv_id % 6 IN (3, 4) AND u <> '' AND a <> '' UNION ALL SELECT conv_id, 1, 'assistant', a FROM {_ENDS} WHERE conv_id % 6 IN (3, 4) AND u <> '' AND a <> '')"""


def _layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, line): a JSON line per conversation, in the layouts that people write."""
    rows = dialog.gather(table(spark, sf_dir, "conversations"))
    first = lambda role: F.get(F.filter("messages", lambda t: t["role"] == role), F.lit(0))["content"]
    name = F.concat(F.lit("c"), F.col("conv_id"))
    shown = lambda *parts: F.to_json(F.struct(*parts))
    as_from = F.transform("messages", lambda t: F.struct(F.when(t["role"] == "user", "Human").when(t["role"] == "assistant", "gpt").otherwise(t["role"]).alias("from"), F.concat(F.lit("  "), t["content"]).alias("value")))
    # content as a list of strings and texts: the first word, and what is behind its blank
    cut = lambda t: F.locate(" ", t["content"])
    parted = F.transform("messages", lambda t: F.struct(F.upper(t["role"]).alias("role"), F.when(cut(t) > 0, F.array(F.struct(t["content"].substr(F.lit(1), cut(t) - 1).alias("text")), F.struct(t["content"].substr(cut(t) + 1, F.length(t["content"])).alias("text")))).otherwise(F.array(F.struct(t["content"].alias("text")))).alias("content")))
    k = F.col("conv_id") % 6
    line = F.when(k == 0, shown(name.alias("id"), F.col("messages"), F.lit("sw").alias("language")))
    line = line.when(k == 1, shown(name.alias("source_id"), as_from.alias("conversations"))).when(k == 2, F.to_json("messages"))
    line = line.when(k == 3, shown(first("user").alias("instruction"), first("assistant").alias("response"), F.lit("own").alias("source")))
    line = line.when(k == 4, shown(first("user").alias("user"), first("assistant").alias("assistant"), name.alias("id"))).otherwise(shown(parted.alias("messages"), name.alias("id")))
    return rows.select("conv_id", line.alias("line"))


def _written(spark: SparkSession, lines: DataFrame, name: str) -> DataFrame:
    """Numbered lines of (conv_id, line), written in FILES files of ascending conv_id; with part, the file's number."""
    path = work_path(spark, name)
    dealt = lines.withColumn("part", F.col("conv_id") % FILES).repartition(FILES, "part").sortWithinPartitions("part", "conv_id")
    dealt.select(F.col("line").alias("value"), "part").write.partitionBy("part").text(path)
    return jsonl.read_lines(spark, f"{path}/part=*").withColumn("part", _part())


def _part() -> Column:
    return F.regexp_extract("file", r"part=(\d+)", 1).cast("long")


def _digest(messages: Column) -> Column:
    return F.sha1(F.array_join(F.transform(messages, lambda t: F.concat(t["role"], F.lit(":"), t["content"])), "\n"))


@query(f"SELECT conv_id % {FILES} AS part, row_number() OVER (PARTITION BY conv_id % {FILES} ORDER BY conv_id) - 1 AS row_index, conv_id, CAST(n AS BIGINT) AS n FROM (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id)")
def jsonl_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects written as JSON lines and read strictly, with their place in the file."""
    rows = dialog.gather(table(spark, sf_dir, "conversations")).withColumn("part", F.col("conv_id") % FILES)
    path = work_path(spark, "jsonl")
    sinks.write_jsonl(rows.repartition(FILES, "part").sortWithinPartitions("part", "conv_id"), path, by="part")
    value = jsonl.parse(jsonl.read_lines(spark, f"{path}/part=*"))
    return value.select(_part().alias("part"), "row_index", F.variant_get("value", "$.conv_id", "long").alias("conv_id"), F.size(F.variant_get("value", "$.messages", "array<variant>")).cast("long").alias("n"))


def _torn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of which every seventh is cut short and every fifth is blank."""
    line = F.to_json(F.struct("conv_id", F.lit("x").alias("k")))
    torn = F.when(F.col("conv_id") % 5 == 0, "  ").when(F.col("conv_id") % 7 == 0, F.substring(line, 1, 9)).otherwise(line)
    return _written(spark, table(spark, sf_dir, "conversations").select("conv_id").distinct().select("conv_id", torn.alias("line")), "torn")


@query("SELECT DISTINCT conv_id, conv_id % 4 AS part FROM conversations WHERE conv_id % 5 <> 0 AND conv_id % 7 <> 0")
def jsonl_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jsonl.parse(_torn(spark, sf_dir), mode="tolerant").select(F.variant_get("value", "$.conv_id", "long").alias("conv_id"), "part")


@query(f"SELECT part, line, 'malformed JSON' AS reason FROM (SELECT conv_id, conv_id % {FILES} AS part, row_number() OVER (PARTITION BY conv_id % {FILES} ORDER BY conv_id) AS line FROM (SELECT DISTINCT conv_id FROM conversations)) WHERE conv_id % 7 = 0 AND conv_id % 5 <> 0")
def jsonl_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jsonl.malformed(_torn(spark, sf_dir)).select(_part().alias("part"), "line", "reason")


@query(f"SELECT c.conv_id, CAST(count(role) AS BIGINT) AS n, sha1(coalesce(string_agg(concat(role, ':', content), chr(10) ORDER BY turn) FILTER (role IS NOT NULL), '')) AS digest FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN {_LAYOUTS} l ON c.conv_id = l.conv_id GROUP BY c.conv_id")
def message_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every layout as messages."""
    lines = _layouts(spark, sf_dir)
    parsed = jsonl.parse(lines.withColumn("file", F.lit("")).withColumn("row_index", F.col("conv_id")))
    found = parsed.select("conv_id", jsonl.messages(F.col("value")).alias("m"))
    return found.select("conv_id", F.size("m").cast("long").alias("n"), _digest(F.col("m")).alias("digest"))


@query(
    f"""WITH t AS {_LAYOUTS}, p AS (SELECT conv_id, arg_max(content, turn) FILTER (role = 'user') AS u, min(turn) FILTER (role = 'user') AS first FROM t GROUP BY conv_id),
 a AS (SELECT t.conv_id, arg_max(content, turn) AS a FROM t JOIN p ON t.conv_id = p.conv_id AND turn > first WHERE role = 'assistant' GROUP BY t.conv_id),
 i AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id % {FILES} ORDER BY conv_id) - 1 AS k FROM (SELECT DISTINCT conv_id FROM conversations))
 SELECT p.conv_id % {FILES} AS part, CASE WHEN p.conv_id % 6 IN (2, 3) THEN concat('key-', k) ELSE concat('c', p.conv_id) END AS source_id, CASE WHEN p.conv_id % 6 = 0 THEN 'swahili' ELSE 'english' END AS language, CASE WHEN p.conv_id % 6 = 3 THEN 'own' ELSE 'key' END AS source, sha1(u) AS instruction, sha1(a) AS response
 FROM p JOIN a ON p.conv_id = a.conv_id JOIN i ON p.conv_id = i.conv_id"""
)
def dataset_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of every layout as canonical rows; a row without an id is named by its place in the file."""
    lines = _written(spark, _layouts(spark, sf_dir), "rows")
    out = None
    for k in range(FILES):
        rows = jsonl.chat_rows(lines.filter(F.col("part") == k), "key").select(F.lit(k).cast("long").alias("part"), "source_id", "language", "source", F.sha1("instruction").alias("instruction"), F.sha1("response").alias("response"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    """SELECT 'local' AS key, 'local' AS revision, concat('local-', row_number() OVER (ORDER BY r_regionkey) - 1) AS source_id, r_name AS instruction FROM region
 UNION ALL SELECT 'empty', 'r2', concat('n', n_nationkey), n_name FROM nation WHERE n_nationkey % 2 = 0 UNION ALL SELECT 'away', 'r2', concat('n', n_nationkey), n_name FROM nation WHERE n_nationkey % 2 = 0"""
)
def catalog_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A local file with rows; an empty one, whose key falls back to the published folder's first split; a published one
    that shares its revision; an optional one without either."""
    path = work_path(spark, "catalog")
    pair = F.to_json(F.struct(F.col("r_name").alias("user"), F.lit("a").alias("assistant")))
    table(spark, sf_dir, "region").coalesce(1).sortWithinPartitions("r_regionkey").select(pair.alias("value")).write.text(f"{path}/local")
    spark.range(0).select(F.lit("").alias("value")).write.text(f"{path}/empty")
    rows = table(spark, sf_dir, "nation").select(F.col("n_name").alias("instruction"), F.concat(F.lit("n"), F.col("n_nationkey")).alias("source_id"), F.when(F.col("n_nationkey") % 2 == 0, "check").otherwise("trial").alias("split"))
    rows.write.partitionBy("split").parquet(f"{path}/pub/r2")
    sources = [catalog.Source("local", local=f"{path}/local"), catalog.Source("empty", local=f"{path}/empty", published=f"{path}/pub"), catalog.Source("away", published=f"{path}/pub"), catalog.Source("gone", optional=True)]
    revisions = catalog.resolve_revisions(sources, {"empty": "r2", "away": "r2"})
    out = None
    for source in sources:
        found = catalog.load(spark, source, revisions)
        if found is not None:
            part = found.select(F.lit(source.key).alias("key"), F.lit(revisions[source.key]).alias("revision"), "source_id", "instruction")
            out = part if out is None else out.unionByName(part)
    return out


@query("""SELECT concat('hidden_', r_regionkey, '.json') AS file, concat('{"name":"', r_name, '","scores":{"a":', r_regionkey, ',"b":"é"}}') AS document, r_name AS name FROM region UNION ALL SELECT 'none.json', '{}', NULL""")
def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written whole with sorted keys, one of them twice, and read by a glob; a missing one is an empty object."""
    path = work_path(spark, "documents")
    rows = table(spark, sf_dir, "region").collect()  # five regions
    for turn in ("first", "last"):
        for r in rows if turn == "last" else rows[:1]:
            sinks.write_document(spark, f"{path}/hidden_{r.r_regionkey}.json", {"scores": {"b": "é", "a": r.r_regionkey}, "name": r.r_name if turn == "last" else turn})
    found = jsonl.read_document(spark, f"{path}/hidden_*.json").unionByName(jsonl.read_document(spark, f"{path}/none.json"))
    return found.select(F.regexp_extract("file", r"[^/]+$", 0).alias("file"), F.to_json("value").alias("document"), F.try_variant_get("value", "$.name", "string").alias("name"))


@query("SELECT concat('n', n_nationkey, '/', n_name, '.txt') AS file, CAST(strlen(n_comment) + 1 AS BIGINT) AS size, sha256(concat(n_comment, chr(10))) AS sha256, row_number() OVER (ORDER BY concat('n', n_nationkey, '/', n_name, '.txt')) AS place FROM (SELECT n_nationkey, n_name, concat('about ', n_name) AS n_comment FROM nation) WHERE n_nationkey % 3 = 0")
def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in folders, without unfinished ones and caches, in the order of their paths."""
    path = work_path(spark, "files")
    for r in table(spark, sf_dir, "nation").collect():  # 25 nations
        name = f"n{r.n_nationkey}/{r.n_name}.txt"
        name = name if r.n_nationkey % 3 == 0 else f"{name}.tmp" if r.n_nationkey % 3 == 1 else f"__pycache__/{name}"
        sinks.write_bytes(spark, f"{path}/{name}", f"about {r.n_name}\n".encode())
    found = manifest.listing(spark, path).select(F.substring_index("path", path.removeprefix("file:").lstrip("/") + "/", -1).alias("file"), "size", "sha256")
    return manifest.in_order(found, "file")


def _weights(spark: SparkSession, sf_dir: str) -> str:
    """A folder with a weight file a region, of either layout, with a tensor a nation."""
    path = work_path(spark, "weights")
    text = lambda x: struct.pack("<Q", len(x.encode())) + x.encode()
    nations = table(spark, sf_dir, "nation").collect()  # 25 nations
    for k in sorted({r.n_regionkey for r in nations}):
        own = sorted(r.n_nationkey for r in nations if r.n_regionkey == k)
        if k % 2:
            head = json.dumps({"__metadata__": {}, **{f"model.layers.{n}.w": {"dtype": "BF16" if n % 3 else "F32", "shape": [1], "data_offsets": [0, 2]} for n in own}}).encode()
            sinks.write_bytes(spark, f"{path}/r{k}.safetensors", struct.pack("<Q", len(head)) + head + b"\0\0")
        else:
            keys = text("general.architecture") + struct.pack("<I", 8) + text(f"arch{k}") + text(f"arch{k}.nextn_predict_layers") + struct.pack("<II", 4, k)
            tensors = b"".join(text(f"blk.{n}.ffn.weight" if n % 2 else f"out.{n}") + struct.pack("<IQIQ", 1, 8, 12 if n % 3 else 0, 0) for n in own)
            sinks.write_bytes(spark, f"{path}/r{k}.gguf", b"GGUF" + struct.pack("<IQQ", 3, len(own), 2) + keys + tensors)
    return path


@query(
    """SELECT concat('r', n_regionkey, CASE WHEN n_regionkey % 2 = 1 THEN '.safetensors' ELSE '.gguf' END) AS file, CASE WHEN n_regionkey % 2 = 0 THEN concat('arch', n_regionkey) END AS architecture, CAST(CASE WHEN n_regionkey % 2 = 0 THEN n_regionkey ELSE 0 END AS BIGINT) AS draft_layers,
 CASE WHEN n_regionkey % 2 = 1 THEN concat('model.layers.', n_nationkey, '.w') WHEN n_nationkey % 2 = 1 THEN concat('blk.', n_nationkey, '.ffn.weight') ELSE concat('out.', n_nationkey) END AS tensor, CASE WHEN n_nationkey % 3 = 0 THEN 'F32' WHEN n_regionkey % 2 = 1 THEN 'BF16' ELSE 'Q4_K' END AS dtype FROM nation"""
)
def weight_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tensor_files.inventory(spark, _weights(spark, sf_dir)).select(F.regexp_extract("path", r"[^/]+$", 0).alias("file"), "architecture", "draft_layers", "tensor", "dtype")


@query(
    """SELECT file, architecture, draft_layers, string_agg(concat(dtype, '=', n), ',' ORDER BY dtype) AS counts, max(block) AS max_block FROM (SELECT file, any_value(architecture) AS architecture, any_value(draft_layers) AS draft_layers, dtype, count(*) AS n, max(block) AS block FROM
 (SELECT concat('r', n_regionkey, CASE WHEN n_regionkey % 2 = 1 THEN '.safetensors' ELSE '.gguf' END) AS file, CASE WHEN n_regionkey % 2 = 0 THEN concat('arch', n_regionkey) END AS architecture, CAST(CASE WHEN n_regionkey % 2 = 0 THEN n_regionkey ELSE 0 END AS BIGINT) AS draft_layers,
 CASE WHEN n_regionkey % 2 = 0 AND n_nationkey % 2 = 1 THEN CAST(n_nationkey AS INTEGER) END AS block, CASE WHEN n_nationkey % 3 = 0 THEN 'F32' WHEN n_regionkey % 2 = 1 THEN 'BF16' ELSE 'Q4_K' END AS dtype FROM nation) GROUP BY file, dtype) GROUP BY file, architecture, draft_layers"""
)
def weight_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _weights(spark, sf_dir)
    found = tensor_files.summary(tensor_files.inventory(spark, path)).join(tensor_files.digests(spark, path), "path").join(manifest.listing(spark, path).select("path", F.col("sha256").alias("listed")), "path")
    counts = F.array_join(F.transform(F.map_entries("counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    # a digest that differs from the listing's would drop the file
    return found.filter("sha256 = listed").select(F.regexp_extract("path", r"[^/]+$", 0).alias("file"), "architecture", "draft_layers", counts.alias("counts"), "max_block")


@query(f"SELECT CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (conv_id % 3 <> 0) AS BIGINT) AS n_good, false AS ok FROM {_ENDS}")
def bare_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays of a question and an answer as lines; every third with the roles turned about, which the read-back tells."""
    rows = dialog.gather(table(spark, sf_dir, "conversations"))
    turn = lambda role, of: F.struct(F.lit(role).alias("role"), F.get(F.filter("messages", lambda t: t["role"] == of), F.lit(0))["content"].alias("content"))
    turned = F.col("conv_id") % 3 == 0
    both = F.when(turned, F.array(turn("assistant", "assistant"), turn("user", "user"))).otherwise(F.array(turn("user", "user"), turn("assistant", "assistant")))
    path = work_path(spark, "arrays")
    sinks.write_arrays(rows.select("conv_id", both.alias("messages")), path, order="conv_id")
    return sinks.read_back(spark, path, rows.count())


@query("SELECT CAST(n_regionkey AS BIGINT) AS n_regionkey, CAST(count(*) AS BIGINT) AS n FROM (SELECT n_regionkey FROM nation UNION ALL SELECT n_regionkey FROM nation WHERE n_nationkey % 2 = 0) GROUP BY n_regionkey")
def checkpoint_appends(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, rows = work_path(spark, "checkpoint"), table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_regionkey").cast("long").alias("n_regionkey"))
    sinks.append_checkpoint(rows, path)
    sinks.append_checkpoint(rows.filter("n_nationkey % 2 = 0"), path)
    return reports.counts(spark.read.parquet(path), "n_regionkey")


@query("SELECT doc_id, lang, 'train' AS split FROM documents")
def published_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed columns as the train split, read back by its name."""
    path = work_path(spark, "published")
    sinks.publish(table(spark, sf_dir, "documents"), path, ["doc_id", "lang"])
    return catalog.published_split(spark, path).withColumn("split", F.lit("train"))


@query(r"SELECT sha1(concat(string_agg(regexp_replace(text, '\s+', ' ', 'g'), concat(chr(10), chr(10)) ORDER BY conv_id, turn), chr(10), chr(10))) AS digest FROM conversations")
def text_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with a blank line behind each, read back as one file."""
    path = work_path(spark, "corpus")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.regexp_replace("text", r"\s+", " ").alias("text"))
    # one file here, so that its bytes can be compared; an order over several files is that of their names
    sinks.write_corpus(rows.repartition(1).sortWithinPartitions("conv_id", "turn"), path)
    return spark.read.text(path, wholetext=True).select(F.sha1("value").alias("digest"))


@query("SELECT 'upload' AS stage, concat('n', n_nationkey) AS path, CAST(n_regionkey AS BIGINT) AS size, sha256(n_name) AS sha256 FROM nation")
def provenance_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "nation").select(F.concat(F.lit("n"), F.col("n_nationkey")).alias("path"), F.col("n_regionkey").cast("long").alias("size"), F.sha2("n_name", 256).alias("sha256"))
    return manifest.provenance(files, "upload")


@query(
    """WITH l AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang), s AS (SELECT source, count(*) AS n FROM documents GROUP BY source), head AS (SELECT concat('# All', chr(10), chr(10), format('{:,}', count(*)), ' rows', chr(10), chr(10)) AS h FROM documents)
 SELECT concat(h, '| lang | rows |', chr(10), '|---|---|', chr(10), (SELECT string_agg(concat('| ', lang, ' | ', format('{:,}', n), ' |'), chr(10) ORDER BY lang) FROM l), chr(10), chr(10), '| source | rows |', chr(10), '|---|---|', chr(10), (SELECT string_agg(concat('| ', source, ' | ', format('{:,}', n), ' |'), chr(10) ORDER BY source) FROM s), chr(10)) AS markdown FROM head"""
)
def dataset_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.card(table(spark, sf_dir, "documents").select("lang", "source"), "All", "lang", "source")
