"""Queries over the text functions and rule tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import lexicons as lex
from millrace.functions import rules
from millrace.functions import text as tx
from millrace.plans.registry import registry
from millrace.session import spread, table

QUERIES, ORACLES, query = registry()

NORM = r"regexp_replace(lower(regexp_replace(text, '^\s+|\s+$', '', 'g')), '\s+', ' ', 'g')"
EDGE = r"[^\p{L}\p{N}_]"


def _docs(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", *(columns or ("text",))))


def _literal(value: str) -> str:
    """A string in SQL."""
    return "'" + value.replace("'", "''") + "'"


def _chosen(values, key: str) -> str:
    """The value that a whole number picks, in either engine."""
    return f"CASE ({key}) % {len(values)} " + " ".join(f"WHEN {k} THEN {_literal(v)}" for k, v in enumerate(values)) + " END"


def _spark_chosen(values, key: str):
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.expr(f"cast(({key}) % {len(values)} + 1 as int)"))


def _found(tests) -> str:
    """The distinct labels whose test holds, sorted, in SQL."""
    return "list_sort(list_distinct(list_filter([" + ", ".join(f"CASE WHEN {test} THEN {_literal(label)} END" for label, test in tests) + "], lambda x: x IS NOT NULL)))"


def _match(x: str, pattern: str, flags: str = "i") -> str:
    return f"regexp_matches({x}, {_literal(f'(?{flags})' + pattern)})"


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _replaced(x: str, pattern: str, by: str) -> str:
    """A rewrite in SQL, whose patterns know no look-ahead: the one that occurs, no digit behind a point, is kept out by a
    mark in the place of the 2."""
    other = by.replace("$", "\\")
    if r"(?!\.\d)" not in pattern:
        return f"regexp_replace({x}, {_literal('(?i)' + pattern)}, {_literal(other)}, 'g')"
    marked = rf"regexp_replace({x}, '(?i)(m\s*)2(\.\d)', '\1⟦\2', 'g')"
    bare = pattern.replace(r"(?!\.\d)", "")
    return f"replace(regexp_replace({marked}, {_literal('(?i)' + bare)}, {_literal(other)}, 'g'), '⟦', '2')"


def _units(x: str) -> str:
    out = f"translate({x}, '‑–', '--')"
    for pattern, by in lex.UNIT_REWRITES:
        out = _replaced(out, pattern, by)
    return out


def _normal(x: str) -> str:
    out = rf"regexp_replace(regexp_replace({_units(_strip(x))}, '[ \t]+', ' ', 'g'), ' ?\n ?', chr(10), 'g')"
    for pattern, by in lex.RATE_REWRITES:
        out = _replaced(out, pattern, by)
    return _strip(out)


def _numbers_of(x: str) -> str:
    """The distinct canonical numbers of a text, sorted. The commas of grouped numbers become marks, last one first."""
    out = _units(x)
    for _ in range(6):
        out = rf"regexp_replace({out}, '(^|[^\p{{L}}\p{{N}}_¤])(\d{{1,3}}(?:,\d{{3}})*),(\d{{3}}(?:¤\d{{3}})*)($|[^\p{{L}}\p{{N}}_¤])', '\1\2¤\3\4', 'g')"
    points = rf"regexp_replace(replace({out}, '¤', ''), '\b(\d+),(\d+)\b', '\1.\2', 'g')"
    cut = r"regexp_replace(CASE WHEN contains(n, '.') THEN regexp_replace(n, '\.?0*$', '') ELSE n END, '^0+([0-9])', '\1')"
    return rf"list_sort(list_distinct(list_transform(regexp_extract_all({points}, '\d+(?:\.\d+)?'), lambda n: CASE WHEN {cut} IN ('', '.') THEN '0' ELSE {cut} END)))"


def _phrases(x: str) -> str:
    return _found((p, f"contains(lower({x}), {_literal(p.lower())})") for p in lex.BAD_PHRASES)


def _terms(x: str) -> str:
    return _found((t, _match(x, f"(^|{EDGE}){t}({EDGE}|$)")) for t in lex.ENGLISH_TERMS)


def _headings(x: str) -> str:
    return _found((f"{h}:", _match(x, rf"^\s*{h}\s*:", "im")) for h in lex.ENGLISH_HEADINGS)


def _patterns(x: str) -> str:
    """The last pattern is of a phrase without two words behind it: fewer with them than in all."""
    tests = []
    for pattern, label in lex.BAD_PATTERNS:
        head, ahead, behind = pattern.partition(r"(?!")
        n = lambda p: f"len(regexp_extract_all({x}, {_literal('(?i)' + p)}))"
        tests.append((label, f"{n(head)} > {n(head + behind[:-1])}" if ahead else _match(x, pattern, "im")))
    return _found(tests)


def _conversions(source: str, target: str) -> str:
    new = lambda p: f"{_match(f'lower({target})', p)} AND NOT {_match(f'lower({source})', p)}"
    acre = _match(target, r"\bacre\b[^.\n]*\bha\b") + " AND NOT " + _match(source, r"\bha\b|\bhectare\b")
    return _found((("added imperial conversion", new(lex.IMPERIAL)), ("added conversion parentheses", new(lex.IMPERIAL_ASIDE)), ("added acre-to-hectare conversion", acre)))


def _joined(values: str, separator: str = ",") -> str:
    return f"array_to_string({values}, '{separator}')"


@query(f"SELECT doc_id, sha1({NORM}) AS digest, CAST(length({NORM}) AS BIGINT) AS n FROM documents")
def text_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = tx.norm(F.col("text"))
    return _docs(spark, sf_dir).select("doc_id", F.sha1(plain).alias("digest"), F.length(plain).cast("long").alias("n"))


#: What is planted into documents: units, numbers and conversions, as people write them.
_UNITS = ("2 kg ha 1", "2 kg/ha 1 of NPK", "2 t ha-1", "30 kg n ha", "50 g m 2", "5 km h 1", "2-4 L m 1 h 1", "10^9 CFU L 1", "1-109 cfu", "1109 conidia", "cfu 1-109", "Ficusspp. here", "2.5 m x 2.5 m 2", "dig to m 2.5", "3 m 2 or 4 m 2.5", "5-000 plants", "some kg K2O ha", "7 L d-1", "m ^ 2 plots", "9 kg ha ^ -1", "‑ 3 ml m 2 – 4", "2 / ha 1", "ha-1 ha")
_NUMBERS = ("1,234 g", "2,5 l at 04", "2.50 ml", "1,234,567 and 12,34", "0.0 or 00", "1,234,56", "x1,234", "7,000 8,000,9", "3.", "12,345x and 1,000,000", "no more")


def _planted(values, key: str, more: str = "") -> str:
    return f"concat(text, ' ', {_chosen(values, key)}{more})"


def _spark_planted(values, key: str, *more):
    return F.concat(F.col("text"), F.lit(" "), _spark_chosen(values, key), *more)


@query(f"SELECT doc_id, {_units('x')} AS units FROM (SELECT doc_id, {_planted(_UNITS, 'doc_id')} AS x FROM documents)")
def normalize_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", tx.normalize_units(_spark_planted(_UNITS, "doc_id")).alias("units"))


_RATES = (" 50 kg/acre ( 12 kg / ha), then", "50 KG / Acre (120,5 kg/ha) and 2.5 kg/acre(1 kg/ha)", "5 kg / acre \t twice \n mara/ siku", "kabla /wiki \n\n 3 mm / d", "4 kg/acre (about 2 kg/ha)", "2 m² / h  ")


@query(
    rf"""SELECT doc_id, {_strip(rf"regexp_replace(regexp_replace(x, {_literal('(?i)' + lex.WRONG_CONVERSION)}, '\1', 'g'), '[ \t]+', ' ', 'g')")} AS conversions, {_normal('x')} AS rates FROM (SELECT doc_id, {_planted(_RATES, 'doc_id')} AS x FROM documents)"""
)
def text_repairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _spark_planted(_RATES, "doc_id")
    return _docs(spark, sf_dir).select("doc_id", tx.strip_wrong_conversions(x).alias("conversions"), tx.normalize_text(x).alias("rates"))


@query(f"SELECT doc_id, {_joined(_numbers_of('x'))} AS numbers FROM (SELECT doc_id, {_planted(_NUMBERS, 'doc_id')} AS x FROM documents)")
def extract_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tx.extract_numbers(_spark_planted(_NUMBERS, "doc_id"))
    return _docs(spark, sf_dir).select("doc_id", F.array_join(F.array_sort(found), ",").alias("numbers"))


@query(f"SELECT doc_id, {_joined('list_sort(list_filter(a, lambda n: NOT list_contains(b, n)))')} AS missing FROM (SELECT doc_id, {_numbers_of('x')} AS a, {_numbers_of('y')} AS b FROM (SELECT doc_id, {_planted(_NUMBERS, 'doc_id')} AS x, {_chosen(_NUMBERS, 'doc_id // 3')} AS y FROM documents))")
def missing_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    missing = rules.missing_numbers(_spark_planted(_NUMBERS, "doc_id"), _spark_chosen(_NUMBERS, "doc_id div 3"))
    return _docs(spark, sf_dir).select("doc_id", F.array_join(missing, ",").alias("missing"))


_TWO_PHRASES = f"concat(text, ' ', upper({_chosen(lex.BAD_PHRASES, 'doc_id')}), ' ', {_chosen(lex.BAD_PHRASES, 'doc_id * 7')})"


@query(f"SELECT doc_id, {_joined(_phrases('x'))} AS hits FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN text ELSE {_TWO_PHRASES} END AS x FROM documents)")
def lexicon_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    two = F.concat(F.col("text"), F.lit(" "), F.upper(_spark_chosen(lex.BAD_PHRASES, "doc_id")), F.lit(" "), _spark_chosen(lex.BAD_PHRASES, "doc_id * 7"))
    text = F.when(F.col("doc_id") % 3 == 0, F.col("text")).otherwise(two)
    return _docs(spark, sf_dir).select("doc_id", F.array_join(rules.phrase_hits(text), ",").alias("hits"))


_EDGES = (".", "s ", "_", " ", "é", "\n(")


@query(f"SELECT doc_id, {_joined(_terms('x'))} AS hits FROM (SELECT doc_id, concat(text, ' ', upper({_chosen(lex.ENGLISH_TERMS, 'doc_id')}), {_chosen(_EDGES, 'doc_id')}, {_chosen(lex.ENGLISH_TERMS, 'doc_id * 11')}, {_chosen(_EDGES, 'doc_id // 5')}) AS x FROM documents)")
def whole_word_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.col("text"), F.lit(" "), F.upper(_spark_chosen(lex.ENGLISH_TERMS, "doc_id")), _spark_chosen(_EDGES, "doc_id"), _spark_chosen(lex.ENGLISH_TERMS, "doc_id * 11"), _spark_chosen(_EDGES, "doc_id div 5"))
    return _docs(spark, sf_dir).select("doc_id", F.array_join(rules.word_hits(text), ",").alias("hits"))


_BAD = ("5 kg ha 1", "3 L/ha 1", "7 g m 2", "9 km h 1", "2-4 L m-1", "4 m 2", "(about 3 ft)", "(3\nfeet)", "Viumbe wa", "kibio", "manyu.", "spra", "dalili za kutokwa damu", "dalili za kutokwa na damu", "dalili za kutokwa na choo, dalili za kutokwa", "miche")


@query(f"SELECT doc_id, {_joined(_patterns('x'), '; ')} AS labels FROM (SELECT doc_id, {_planted(_BAD, 'doc_id')} AS x FROM documents)")
def regex_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", F.array_join(rules.pattern_hits(_spark_planted(_BAD, "doc_id")), "; ").alias("labels"))


@query(f"SELECT doc_id, {_joined(_headings('x'))} AS headings FROM (SELECT doc_id, concat(text, chr(10), '  ', upper({_chosen(lex.ENGLISH_HEADINGS, 'doc_id')}), ' : x', chr(10), 'no ', {_chosen(lex.ENGLISH_HEADINGS, 'doc_id * 3')}, ': y', {_chosen((' ', chr(10)), 'doc_id')}, {_chosen(lex.ENGLISH_HEADINGS, 'doc_id * 5')}, ':') AS x FROM documents)")
def heading_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.col("text"), F.lit("\n  "), F.upper(_spark_chosen(lex.ENGLISH_HEADINGS, "doc_id")), F.lit(" : x\nno "), _spark_chosen(lex.ENGLISH_HEADINGS, "doc_id * 3"), F.lit(": y"), _spark_chosen((" ", "\n"), "doc_id"), _spark_chosen(lex.ENGLISH_HEADINGS, "doc_id * 5"), F.lit(":"))
    return _docs(spark, sf_dir).select("doc_id", F.array_join(rules.heading_hits(text), ",").alias("headings"))


_MEASURES = ("30 feet", "(12 inches wide)", "2.5 Pounds.", "(3 lb) and 3 lb", "kwa acre au ha", "an acre. One ha", "one hectare, acre and ha", "12 inn", "no measure")


@query(f"SELECT doc_id, {_joined(_conversions('s', 't'))} AS issues FROM (SELECT doc_id, {_planted(_MEASURES, 'doc_id // 3')} AS s, {_planted(_MEASURES, 'doc_id')} AS t FROM documents)")
def added_conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    issues = rules.added_conversions(_spark_planted(_MEASURES, "doc_id div 3"), _spark_planted(_MEASURES, "doc_id"))
    return _docs(spark, sf_dir).select("doc_id", F.array_join(issues, ",").alias("issues"))


#: One failure a document, or none; the last ones are in the source.
_FAULTS = ("", "node za limfa, formuleni na sanitiza", "spray the mites", "\nProcessing: x", "kibio", "3 viumbe", "miche", "maji", "udongo", "mahindi", "ndizi")
_SOURCES = ("", "", "", "", "", "", "12,500 kg na 7 m", "30 ft", "an acre", "", "ndama")


@query(
    f"""WITH d AS (SELECT doc_id, text, CASE WHEN doc_id % 13 = 12 THEN ' ' ELSE 'Swali  moja' END AS u, CASE WHEN doc_id % 17 = 16 THEN 'Swali moja' WHEN doc_id % 19 = 18 THEN '' ELSE concat(regexp_replace(text, '[0-9]+', '', 'g'), {_chosen(_FAULTS, 'doc_id')}) END AS a, {_chosen(('question', 'q', ''), 'doc_id // 11')} AS su,
 CASE WHEN doc_id % 11 = 9 THEN substr(text, 1, 40) WHEN doc_id % 11 = 10 THEN '' ELSE concat(regexp_replace(text, '[0-9]+', '', 'g'), {_chosen(_SOURCES, 'doc_id')}) END AS sa FROM documents),
 n AS (SELECT doc_id, {_normal('u')} AS u, {_normal('a')} AS a, su, sa, {_normal('concat(su, chr(10), sa)')} AS source FROM d), b AS (SELECT *, concat(u, chr(10), a) AS x FROM n),
 h AS (SELECT *, {_phrases('x')} AS phrases, {_terms('x')} AS terms, {_headings('x')} AS headings, {_patterns('x')} AS patterns, {_conversions('source', 'x')} AS conversions, {_numbers_of('source')} AS sn, {_numbers_of('x')} AS tn FROM b), m AS (SELECT *, list_sort(list_filter(sn, lambda k: NOT list_contains(tn, k))) AS missing FROM h)
 SELECT doc_id, CASE WHEN {_strip('u')} = '' THEN 'empty translated user turn' WHEN {_strip('a')} = '' THEN 'empty translated assistant turn' WHEN u = a THEN 'user and assistant translations are identical'
 WHEN len(phrases) > 0 THEN concat('QC forbidden Swahili phrases: ', array_to_string(phrases[1:12], ', ')) WHEN len(terms) > 0 THEN concat('QC untranslated English terms: ', array_to_string(terms[1:12], ', '))
 WHEN len(headings) > 0 THEN concat('QC English headings: ', array_to_string(headings[1:12], ', ')) WHEN len(patterns) > 0 THEN concat('QC pattern failures: ', array_to_string(patterns[1:12], ', '))
 WHEN su = '' AND sa = '' THEN NULL WHEN len(missing) > 0 THEN concat('missing numerals from English: ', array_to_string(missing[1:12], ', ')) WHEN len(conversions) > 0 THEN concat('QC conversion issues: ', array_to_string(conversions[1:12], ', '))
 WHEN sa <> '' AND length(a) > floor(length(sa) * 1.8) + 256 THEN concat('assistant translation too long: ', length(a), ' chars > ', CAST(floor(length(sa) * 1.8) + 256 AS BIGINT), ' chars')
 WHEN su <> '' AND length(u) > floor(length(su) * 2.6) + 140 THEN concat('user translation too long: ', length(u), ' chars > ', CAST(floor(length(su) * 2.6) + 140 AS BIGINT), ' chars') END AS reason FROM m"""
)
def qc_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The production lists over whole texts, with one failure planted in most."""
    k, bare = F.col("doc_id"), F.regexp_replace("text", "[0-9]+", "")
    user = F.when(k % 13 == 12, " ").otherwise("Swali  moja")
    assistant = F.when(k % 17 == 16, "Swali moja").when(k % 19 == 18, "").otherwise(F.concat(bare, _spark_chosen(_FAULTS, "doc_id")))
    source = F.when(k % 11 == 9, F.substring("text", 1, 40)).when(k % 11 == 10, "").otherwise(F.concat(bare, _spark_chosen(_SOURCES, "doc_id")))
    rows = _docs(spark, sf_dir).select("doc_id", tx.normalize_text(user).alias("u"), tx.normalize_text(assistant).alias("a"), _spark_chosen(("question", "q", ""), "doc_id div 11").alias("su"), source.alias("sa"))
    return rows.select("doc_id", rules.first_reason(F.col("u"), F.col("a"), F.col("su"), F.col("sa")).alias("reason"))


@query("SELECT doc_id, length(text) > floor(length(substr(text, 1, CAST(100 + doc_id % 400 AS BIGINT))) * 1.8) + 256 AS too_long FROM documents")
def length_ratio_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = F.expr("substring(text, 1, cast(100 + doc_id % 400 as int))")
    return table(spark, sf_dir, "documents").select("doc_id", rules.too_long(source, F.col("text"), 1.8, 256).alias("too_long"))


@query(r"""SELECT doc_id, CAST(n AS BIGINT) AS n FROM (SELECT doc_id, CASE WHEN trim(text) = '' THEN 0 ELSE len(string_split_regex(regexp_replace(text, '^\s+|\s+$', '', 'g'), '\s+')) END AS n FROM documents) WHERE n <= 200""")
def word_count_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", tx.word_count(F.col("text")).cast("long").alias("n")).filter("n <= 200")


@query(r"""SELECT doc_id, CASE WHEN length(line) <= 160 THEN line ELSE concat(substr(line, 1, 157), '...') END AS preview FROM (SELECT doc_id, regexp_replace(replace(text, chr(10), ' '), '^\s+|\s+$', '', 'g') AS line FROM documents)""")
def clip_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", tx.clip(F.col("text")).alias("preview"))


@query("SELECT source, CASE WHEN n < 1000 THEN 'n<1K' WHEN n < 10000 THEN '1K<n<10K' WHEN n < 100000 THEN '10K<n<100K' ELSE '100K<n<1M' END AS bucket FROM (SELECT source, sum(n_chars) AS n FROM documents GROUP BY source)")
def size_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.sum("n_chars").alias("n")).select("source", tx.size_bucket(F.col("n")).alias("bucket"))


@query("SELECT doc_id, CAST(least(16384, greatest(4096, 4096 + (n_chars + 6) // 3 + 64) * (1 << CAST(doc_id % 3 AS INTEGER))) AS BIGINT) AS budget FROM documents")
def token_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", tx.token_budget(F.lit("answer"), F.col("text"), (F.col("doc_id") % 3).cast("double")).alias("budget"))


_BEFORE = ("```json\n", "Here: ", "", "no object ", "```\n", "two {", "  ")
_BEHIND = ("\n```", " done", "", "", "\n``` ", "}", "  \n")


@query(
    rf"""WITH r AS (SELECT conv_id, turn, concat({_chosen(_BEFORE, 'conv_id + turn')}, CASE WHEN (conv_id + turn) % 7 = 3 THEN text WHEN (conv_id + turn) % 11 = 10 THEN concat('{{"user": ', to_json(text)) ELSE concat('{{"user": ', to_json(text), ', "assistant": "a{{b}}"}}') END, {_chosen(_BEHIND, 'conv_id + turn')}) AS raw FROM conversations),
 b AS (SELECT *, {_strip(rf"regexp_replace({_strip('raw')}, '^```[a-zA-Z]*\s*|\s*```$', '', 'g')")} AS bare FROM r), o AS (SELECT *, regexp_extract(bare, '(?s)\{{.*\}}') AS inner_ FROM b),
 j AS (SELECT conv_id, turn, CASE WHEN starts_with(bare, '{{') AND json_valid(bare) THEN bare WHEN json_valid(inner_) THEN inner_ END AS object FROM o)
 SELECT conv_id, turn, object IS NOT NULL AS parsed, json_extract_string(object, '$.user') AS user, json_extract_string(object, '$.assistant') AS assistant FROM j"""
)
def embedded_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers with an object between fences, prose or braces, without one, or with a torn one."""
    k = F.col("conv_id") + F.col("turn")
    quoted = F.regexp_extract(F.to_json(F.struct(F.col("text").alias("t"))), r"(?s)^\{\"t\":(.*)\}$", 1)
    whole = F.concat(F.lit('{"user": '), quoted, F.lit(', "assistant": "a{b}"}'))
    middle = F.when(k % 7 == 3, F.col("text")).when(k % 11 == 10, F.concat(F.lit('{"user": '), quoted)).otherwise(whole)
    raw = F.concat(_spark_chosen(_BEFORE, "conv_id + turn"), middle, _spark_chosen(_BEHIND, "conv_id + turn"))
    parsed = tx.embedded_json(raw, "user string, assistant string")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", parsed["user"].isNotNull().alias("parsed"), parsed["user"].alias("user"), parsed["assistant"].alias("assistant"))


@query("""SELECT doc_id, concat('{"model":"m","messages":[{"role":"system","content":"s"},{"role":"user","content":"', source, '"}],"max_completion_tokens":', 100 + doc_id % 7, '}') AS body, concat('Rejected: ', lang, chr(10), 'Previous answer:', chr(10), substr(text, 1, 1500)) AS feedback FROM documents""")
def request_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = tx.request_body(F.col("source"), "s", "m", 100 + F.col("doc_id") % 7)
    return table(spark, sf_dir, "documents").select("doc_id", body.alias("body"), tx.feedback(F.col("text"), F.col("lang")).alias("feedback"))


_NAMES = ("output.weight", "blk.1.attn_q.weight", "blk.11.ffn.up.weight", "blk.2.weight", "blk.3.attn_k.bias", "token_embd.weight", "blk.4.a.b.c.weight", "xblk.1.q.weight")
_TYPES = ("q4_k_m", "IQ3_S", "q8_0", "iq4_xl", "Q5_K_L", "f16", "tq_s_m", "_m")
_KEYS = ("base_model.model.base_model.model.layers.1.lora_A.default.weight", "base_model.model.x.default", "layers.2.default.lora_B.default.weight", "model.layers.3", "base_model.modelx.defaults.w")
_VERSIONS = ("1.2+cu121", "2.0.1", "3+", "+local", "4.5+a+b")


@query(
    rf"""WITH n AS (SELECT p_partkey, p_size, {_chosen(_NAMES, 'p_partkey')} AS name, {_chosen(_TYPES, 'p_partkey')} AS type, {_chosen(_KEYS, 'p_partkey')} AS key, {_chosen(_VERSIONS, 'p_partkey')} AS version FROM part)
 SELECT p_partkey, nullif(regexp_extract(name, '^blk\.[^.]*\.(.+)\.weight$', 1), '') AS family, regexp_replace(upper(type), '_(S|M|L|XL)$', '') AS base_type, regexp_replace(regexp_replace(key, '^(base_model\.model\.)+', ''), '\.default(\.|$)', '\1', 'g') AS adapter_key,
 split_part(version, '+', 1) AS version, CASE WHEN p_size % 5 = 0 THEN '-' ELSE printf('%.2f', CAST(p_size AS BIGINT) * 123456789 / 1073741824.0) END AS gib FROM n"""
)
def name_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_size")
    pick = lambda values: _spark_chosen(values, "p_partkey")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        tx.weight_family(pick(_NAMES)).alias("family"),
        tx.base_type(pick(_TYPES)).alias("base_type"),
        tx.adapter_key(pick(_KEYS)).alias("adapter_key"),
        tx.public_version(pick(_VERSIONS)).alias("version"),
        tx.gib(F.when(k % 5 == 0, F.lit(0).cast("long")).otherwise(k.cast("long") * 123456789)).alias("gib"),
    )


@query(
    """SELECT vec_id, array_to_string(list_slice(ids, 1, 4), ',') AS start, CASE WHEN len(ids) <= 4 THEN array_to_string(ids, ',') ELSE array_to_string(list_concat(list_slice(ids, 1, 2), [9, 8]), ',') END AS ended,
 CASE WHEN len(doubled) >= 2 AND doubled[1] = 1 AND doubled[2] = 1 THEN array_to_string(doubled[2:], ',') ELSE array_to_string(doubled, ',') END AS single, len(list_filter(range(1, len(ids) + 1), lambda p: ids[p] = 5 AND ids[p + 1] = 0)) > 0 AS has_run,
 list_slice(ids, 1, least(len(ids), len(other))) = list_slice(other, 1, least(len(ids), len(other))) AS agrees, CAST(greatest(1, floor(greatest(1, floor(vec_id * 1.5)) * 0.1)) AS BIGINT) AS warmup, (vec_id % 90) * 2 > vec_id % 37 + 64 AS too_many
FROM (SELECT *, CASE vec_id % 3 WHEN 0 THEN ids WHEN 1 THEN list_concat([1], ids) ELSE list_concat([1, 1], ids) END AS doubled, list_transform(range(0, vec_id % 5), lambda i: CASE WHEN i = 3 AND vec_id % 2 = 0 THEN 0 ELSE (vec_id * 7 + i * i * 3) % 6 END) AS other FROM (SELECT vec_id, list_transform(range(0, vec_id % 9), lambda i: (vec_id * 7 + i * i * 3) % 6) AS ids FROM embeddings))"""
)
def truncate_keep_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbers = lambda n, f: F.when(n > 0, F.transform(F.sequence(F.lit(0), (n - 1).cast("int")), f)).otherwise(F.array().cast("array<bigint>"))
    v, value = F.col("vec_id"), lambda i: (F.col("vec_id") * 7 + i * i * 3) % 6
    ids = numbers(v % 9, lambda i: value(i).cast("long"))
    other = numbers(v % 5, lambda i: F.when((i == 3) & (v % 2 == 0), F.lit(0)).otherwise(value(i)).cast("long"))
    one = F.lit(1).cast("long")
    doubled = F.when(v % 3 == 0, ids).when(v % 3 == 1, F.concat(F.array(one), ids)).otherwise(F.concat(F.array(one, one), ids))
    shown = lambda c: F.array_join(c.cast("array<string>"), ",")
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        shown(tx.keep_start(ids, 4)).alias("start"),
        shown(tx.keep_end_mark(ids, F.array(F.lit(9), F.lit(8)).cast("array<bigint>"), 4)).alias("ended"),
        shown(tx.single_start(doubled, 1)).alias("single"),
        tx.contains_run(ids, F.array(F.lit(5), F.lit(0)).cast("array<bigint>")).alias("has_run"),
        tx.same_prefix(ids, other).alias("agrees"),
        tx.warmup_steps(v, F.lit(1.5), F.lit(0.1)).alias("warmup"),
        tx.too_many_tokens(v % 90, v % 37).alias("too_many"),
    )


_OUTPUTS = ("", "give 20 ml per plant", "<|turn>model", "2.5 kg / acre <|turn>", "no dose", "7 grams", "5 l", "0.5litre/ha")
_PROMPTS = ("safety_dose", "crops", "en_safety", "clarify")


@query(
    rf"""SELECT doc_id, array_to_string(list_filter([CASE WHEN {_strip('x')} = '' THEN 'empty_output' END, CASE WHEN contains(x, '<|turn>') THEN 'template_token_leak' END, CASE WHEN contains(p, 'safety') AND {_match('x', lex.DOSE)} THEN 'possible_unsupported_exact_dosage' END], lambda w: w IS NOT NULL), ';') AS warnings
 FROM (SELECT doc_id, {_chosen(_PROMPTS, 'doc_id // 8')} AS p, CASE WHEN doc_id % 8 = 0 THEN chr(10) WHEN doc_id % 16 < 8 THEN {_planted(_OUTPUTS, 'doc_id')} ELSE {_chosen(_OUTPUTS, 'doc_id')} END AS x FROM documents)"""
)
def warning_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id")
    output = F.when(k % 8 == 0, "\n").when(k % 16 < 8, _spark_planted(_OUTPUTS, "doc_id")).otherwise(_spark_chosen(_OUTPUTS, "doc_id"))
    found = rules.warnings(_spark_chosen(_PROMPTS, "doc_id div 8"), output)
    return _docs(spark, sf_dir).select("doc_id", F.array_join(found, ";").alias("warnings"))


#: Words of either language, planted into documents; French ones stand for Swahili, all others for English.
_SPOKEN = ("maji ya mahindi, ng'ombe na udongo", "check the soil and water your maize", "kwa kama ni panda", " should and the na ya ", "", "mbolea the ndizi and ndama")
_ANSWERS = ("first water it", "Use 20 ml per acre.", "Which crop? Eneo gani", "chunguza 2. panda", "give 3 kg/ha", "nothing")


def _hints(language: str) -> str:
    return "(" + " + ".join(f"CAST(contains(concat(' ', lower(b), ' '), {_literal(h)}) AS INTEGER)" for h in lex.LANGUAGE_HINTS[language]) + ")"


_SECOND = f", ' ', {_chosen(_ANSWERS, 'doc_id // 6')}"
_HINT_SQL = f"(SELECT *, {_hints('sw')} AS sw, {_hints('en')} AS en FROM (SELECT doc_id, CASE lang WHEN 'fr' THEN 'sw' ELSE lang END AS lang, CASE WHEN doc_id % 23 = 22 THEN '[ERROR] x' WHEN doc_id % 29 = 28 THEN '' ELSE {_strip(_planted(_SPOKEN, 'doc_id', _SECOND))} END AS b FROM documents))"


def _spoken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as answers, with words of either language and an answer's phrases behind them."""
    k = F.col("doc_id")
    text = _spark_planted(_SPOKEN, "doc_id", F.lit(" "), _spark_chosen(_ANSWERS, "doc_id div 6"))
    rows = _docs(spark, sf_dir, "text", "lang")
    return rows.select("doc_id", F.when(F.col("lang") == "fr", "sw").otherwise(F.col("lang")).alias("lang"), F.when(k % 23 == 22, "[ERROR] x").when(k % 29 == 28, "").otherwise(text).alias("text"))


@query(f"SELECT lang, CAST(count(*) FILTER (CASE WHEN lang = 'sw' THEN sw >= en ELSE en >= sw END) AS BIGINT) AS matched, CAST(count(*) FILTER (CASE WHEN lang = 'sw' THEN sw > en ELSE en > sw END) AS BIGINT) AS strict FROM {_HINT_SQL} GROUP BY lang")
def language_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    fits = lambda tie: F.count_if(rules.language_match(F.col("lang"), F.col("text"), tie=tie))
    return _spoken(spark, sf_dir).groupBy("lang").agg(fits("both").alias("matched"), fits("strict").alias("strict"))


_SCORED_SQL = f"""(SELECT doc_id, lang, category, b = '' OR starts_with(b, '[ERROR') AS empty, CASE WHEN lang = 'sw' THEN sw >= en ELSE en >= sw END AS language_ok, {_match('b', lex.FIRST_STEP)} AS actionable, category = 'safety' AND {_match('b', lex.DOSE)} AS invented_dose, {_match('b', lex.ASKS_BACK)} AS asks_clarify
 FROM (SELECT d.*, CASE WHEN l.toxic = 1 THEN 'safety' WHEN l.quality = 0 THEN 'clarify' ELSE 'crops' END AS category FROM {_HINT_SQL} d JOIN labels l ON d.doc_id = l.doc_id))"""
_SCORE_SQL = f"""(SELECT *, round_even((CASE WHEN language_ok AND NOT empty THEN 1.0 ELSE 0 END + CASE WHEN actionable AND NOT empty THEN 1.0 ELSE 0 END + CASE WHEN invented_dose THEN 0 ELSE 1.0 END
 + CASE WHEN category = 'clarify' THEN CASE WHEN asks_clarify THEN 1.0 ELSE 0 END ELSE CASE WHEN asks_clarify THEN 0.5 ELSE 1.0 END END) / 4.0, 3)::DOUBLE AS score FROM {_SCORED_SQL})"""


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents as answers, with their rubric."""
    category = F.when(F.col("toxic") == 1, "safety").when(F.col("quality") == 0, "clarify").otherwise("crops")
    rows = _spoken(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id").withColumn("category", category)
    flags = rules.rubric(F.col("category"), F.col("lang"), F.col("text"))
    return rows.select("doc_id", "lang", "category", *[c.alias(n) for n, c in flags.items()])


@query(f"SELECT * FROM {_SCORE_SQL}")
def rubric_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_documents(spark, sf_dir)
