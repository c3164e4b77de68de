"""Secret scans with DataFrame functions only: fixed patterns, and sliding-window entropy over candidate strings.

Offsets come from one pattern used twice: split() gives the text between its matches and regexp_extract_all() the
matches, both leftmost and non-overlapping, so a running sum of their lengths gives each start. The sum runs as a window
over the pieces of one document, which Spark can spill.

Entropy: candidates are maximal runs of key characters that have a digit and a letter. A window moves over the run; the
counts of its characters, the sum of c * log2(c), and the numbers of its characters outside hex and outside letters and
digits change by the character that leaves and the one that enters. A window belongs to the narrowest character class
that holds it (hex, alphanumeric, base64), and the class sets the least entropy. Windows that an allow-listed string
touches are suppressed, wherever else in the run there is one. The others at or above their bound are joined into spans;
spans inside a base span are dropped.

Edge cases: null and empty texts have no spans; repeated rows each keep a row; other columns, whatever their names, are
not read; an empty table gives an empty result. Texts are searched whole.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import materialize, text_of

#: The base patterns, the group that is measured, and its least length; in the order of ties.
KINDS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)
#: What a text must have for a base pattern to give a span; cheaper to search than the pattern itself.
NEEDS = {"assign": r"(?i)(?=[apst])(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]", "access": r"AKIA[A-Z0-9]{16}", "hex": r"[0-9a-f]{24}"}
KEY_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-"
CANDIDATE = r"[A-Za-z0-9+/=_-]{20,}"
#: Stands for an allow-listed character; no key character.
MASK = "~"
WINDOW = 20
#: Least bits per character in a window of 20, by class; a window of 20 has at most 4.32.
BOUNDS = {"hex": 3.0, "alnum": 3.6, "base64": 3.7}
#: Strings that are no secrets; at most one group, and only for a reference to itself.
ALLOW = (r"(?i)example", r"(?i)placeholder", r"(?i)dummy|sample", r"(?i)x{6,}", r"0123456789", r"(?i)abcdefgh", r"(.)\1{7,}", r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$")


def _pieces(text: Column, pattern: str, needs: str, group: int, least: int) -> Column:
    """For texts that meet needs: an array of (between, length, counts) for every match and the rest, else null."""
    p = F.lit(pattern)
    found = F.regexp_extract_all(text, p, F.lit(0))
    measured = F.regexp_extract_all(text, p, F.lit(group)) if group else found
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("between"), found.alias("match"), measured.alias("value"))
    return F.when(
        text.rlike(needs),
        F.transform(zipped, lambda x: F.struct(F.length(x["between"]).alias("between"), F.length(x["match"]).alias("length"), (F.length(x["value"]) >= least).alias("counts"))),
    )


def _candidates(text: Column) -> Column:
    """An array of (between, value) for every candidate run, else null."""
    zipped = F.arrays_zip(F.split(text, CANDIDATE, -1).alias("between"), F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)).alias("match"))
    return F.when(text.rlike(r"[A-Za-z0-9+/=_-]{20}") & text.rlike(r"[0-9]"), F.transform(zipped, lambda x: F.struct(F.length(x["between"]).alias("between"), x["match"].alias("value"))))


def _masked(value: Column, allow: tuple[str, ...]) -> Column:
    """The string with a mark in place of every character of an allow-listed string."""

    def marked(pattern: str):
        def of(v: Column) -> Column:
            zipped = F.arrays_zip(F.split(v, pattern, -1).alias("between"), F.regexp_extract_all(v, F.lit(pattern), F.lit(0)).alias("match"))
            joined = F.array_join(F.transform(zipped, lambda x: F.concat(x["between"], F.repeat(F.lit(MASK), F.length(F.coalesce(x["match"], F.lit("")))))), "")
            return F.when(v.rlike(pattern), joined).otherwise(v)

        return of

    for pattern in allow:  # a one-element transform names the value, which the next step uses more than once
        value = F.get(F.transform(F.array(value), marked(pattern)), F.lit(0))
    return value


def _hot_spans(value: str) -> Column:
    """Spans (a, b) of a masked candidate whose windows have the entropy that their class asks."""
    w = WINDOW
    terms = "array(" + ", ".join(f"{c * log2(c) if c else 0.0!r}D" for c in range(w + 2)) + ")"
    term = lambda x: f"element_at({terms}, 1 + {x})"
    # the place of the mark is the last one; 0 stands for no character
    here, gone = "element_at(v.ids, i)", f"if(i > {w}, element_at(v.ids, i - {w}), 0)"
    count = lambda k: f"element_at(s.counts, {k})"
    wide = lambda k: f"if({k} > {len(KEY_CHARS) - 5}, 1, 0)"
    unhex = lambda k: f"if({k} > 0 AND NOT ({k} between 1 and 6 OR {k} between 27 and 32 OR {k} between 53 and 62), 1, 0)"
    mark = lambda k: f"if({k} = {len(KEY_CHARS) + 1}, 1, 0)"
    change = lambda f: f"{f(here)} - {f(gone)}"
    moved = f"""named_struct(
        'counts', if({here} = {gone}, s.counts, transform(s.counts, (c, k) -> c + if(k + 1 = {here}, 1, 0) - if(k + 1 = {gone}, 1, 0))),
        'total', if({here} = {gone}, s.total, s.total + {term(count(here) + ' + 1')} - {term(count(here))}
            + if({gone} > 0, {term(f"element_at(s.counts, greatest({gone}, 1)) - 1")} - {term(f"element_at(s.counts, greatest({gone}, 1))")}, 0D)),
        'wide', s.wide + {change(wide)}, 'unhex', s.unhex + {change(unhex)}, 'marks', s.marks + {change(mark)}, 'spans', s.spans)"""
    bound = f"if(t.unhex = 0, {BOUNDS['hex']}D, if(t.wide = 0, {BOUNDS['alnum']}D, {BOUNDS['base64']}D))"
    noted = f"""named_struct('counts', t.counts, 'total', t.total, 'wide', t.wide, 'unhex', t.unhex, 'marks', t.marks, 'spans',
        if(i < {w} OR t.marks > 0 OR {log2(w)!r}D - t.total / {w} < {bound} - 1e-9D, t.spans,
           if(size(t.spans) > 0 AND element_at(t.spans, -1).b >= i - {w},
              concat(slice(t.spans, 1, size(t.spans) - 1), array(named_struct('a', element_at(t.spans, -1).a, 'b', i))),
              concat(t.spans, array(named_struct('a', i - {w}, 'b', i))))))"""
    start = f"named_struct('counts', array_repeat(0, {len(KEY_CHARS) + 1}), 'total', 0D, 'wide', 0, 'unhex', 0, 'marks', 0, 'spans', cast(array() as array<struct<a:int,b:int>>))"
    # one-element transforms name the values that are used more than once
    return F.expr(
        f"""element_at(transform(array(named_struct('ids', transform(split({value}, ''), ch -> instr('{KEY_CHARS}{MASK}', ch)))), v ->
            aggregate(sequence(1, size(v.ids)), {start},
                (s, i) -> element_at(transform(array({moved}), t -> {noted}), 1), s -> s.spans)), 1)"""
    )


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """A row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans (see the module)."""
    text = text_of(text_col)
    found = [_pieces(text, pattern, NEEDS[kind], group, least).alias(kind) for kind, pattern, group, least in KINDS]
    rows = docs.select(F.col(id_col).alias("doc_id"), *found, _candidates(text).alias("runs"))
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "secret-pieces")
    in_text = Window.partitionBy("row", "kind").orderBy("pos")

    parts = [rows.filter(F.col(kind).isNotNull()).select("row", F.lit(n).alias("kind"), F.posexplode(kind).alias("pos", "x")).select("row", "kind", "pos", "x.between", "x.length", "x.counts", F.lit(None).cast("string").alias("value")) for n, (kind, *_) in enumerate(KINDS)]
    runs = rows.filter(F.col("runs").isNotNull()).select("row", F.lit(len(KINDS)).alias("kind"), F.posexplode("runs").alias("pos", "x"))
    parts.append(runs.select("row", "kind", "pos", "x.between", F.length("x.value").alias("length"), F.col("x.value").isNotNull().alias("counts"), "x.value"))
    pieces = parts[0]
    for part in parts[1:]:
        pieces = pieces.unionByName(part)
    length = F.coalesce("length", F.lit(0))
    ended = pieces.withColumn("end", F.sum(F.col("between") + length).over(in_text)).filter("counts").withColumn("start", F.col("end") - F.col("length"))
    ended = materialize(ended.select("row", "kind", "start", "end", "value"), "secret-matches")
    base = ended.filter(F.col("kind") < len(KINDS)).select("row", "kind", "start", "end")

    candidates = ended.filter((F.col("kind") == len(KINDS)) & F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]")).withColumn("masked", _masked(F.col("value"), allow))
    hot = candidates.withColumn("hot", _hot_spans("masked")).select("row", "start", F.explode("hot").alias("h")).select("row", (F.col("start") + F.col("h.a")).alias("start"), (F.col("start") + F.col("h.b")).alias("end"))

    spans = F.array_sort(F.collect_list(F.struct("start", "kind", "end")))
    based = base.groupBy("row").agg(spans.alias("base"))
    heated = hot.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", F.lit(len(KINDS)).alias("kind"), "end"))).alias("hot"))
    joined = rows.select("row", "doc_id").join(based, "row", "left").join(heated, "row", "left")
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    joined = joined.select("doc_id", F.coalesce(F.col("base").cast("array<struct<start:bigint,kind:int,end:bigint>>"), none).alias("base"), F.coalesce(F.col("hot").cast("array<struct<start:bigint,kind:int,end:bigint>>"), none).alias("hot"))
    added = F.filter("hot", lambda h: ~F.exists("base", lambda b: (b["start"] <= h["start"]) & (b["end"] >= h["end"])))
    names = F.array(*[F.lit(k) for k, *_ in KINDS], F.lit("entropy"))
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda n: F.size(F.filter("base", lambda b: b["kind"] == n)).cast("long")
    return joined.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(shown(F.col("base")), 256).alias("base_sha256"), shown(F.array_sort(F.concat("base", added))).alias("spans"))
