"""Loosely typed chat JSON: lines to VARIANT, and the layouts that people write to one typed layout.

Layouts: an object with messages or conversations (turns with role or from, content or value), a bare array of turns, an
object with instruction and response, or with user and assistant. Content is a string or a list of strings and {text}.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.text import strip
from millrace.operators import dialog
from millrace.session import work_path


def read_lines(spark: SparkSession, path: str, *, keep_blank_index: bool = True) -> DataFrame:
    """(file, row_index, line) of the non-blank lines. row_index counts from 0 in each file.

    keep_blank_index: blank lines use up an index. Files are read split by split: lines are numbered inside their split,
    in which the running id ascends, and the splits' counts are added up by file. Where splits begin goes by the files of
    a scan, which a caller's filter can make fewer, so that both numbers are taken from one stored scan.
    """
    block = F.col("_metadata.file_block_start").alias("block")
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), block, F.col("value").alias("line")).withColumn("id", F.monotonically_increasing_id())
    stored = work_path(spark, "lines")
    lines.write.parquet(stored)
    lines = spark.read.schema(lines.schema).parquet(stored)
    solid = F.trim("line") != ""
    counted = lines if keep_blank_index else lines.filter(solid)
    before = Window.partitionBy("file").orderBy("block")
    splits = counted.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n")).select("file", "block", (F.sum("n").over(before) - F.col("n")).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("file", "block").orderBy("id")) - 1
    numbered = counted.withColumn("inside", inside).join(splits, ["file", "block"])
    return numbered.filter(solid).select("file", (F.col("offset") + F.col("inside")).cast("long").alias("row_index"), "line")


def parse(lines: DataFrame, *, mode: str = "strict") -> DataFrame:
    """lines with value VARIANT. strict: a malformed line is an error that names its line; tolerant: it is dropped."""
    if mode == "tolerant":
        return lines.withColumn("value", F.try_parse_json("line")).filter("value is not null")
    place = F.concat(F.lit("malformed JSON: "), F.col("file"), F.lit(" line "), (F.col("row_index") + 1).cast("string"))
    return lines.withColumn("value", F.coalesce(F.try_parse_json("line"), F.raise_error(place)))


def malformed(lines: DataFrame) -> DataFrame:
    """(file, line, reason) of the lines that are no JSON; line counts from 1."""
    return lines.filter(F.try_parse_json("line").isNull()).select("file", (F.col("row_index") + 1).alias("line"), F.lit("malformed JSON").alias("reason"))


def _text(value: Column, path: str) -> Column:
    """A scalar under a path as a string; null for lists and objects."""
    kind = F.schema_of_variant(F.try_variant_get(value, path, "variant"))
    return F.when(~F.startswith(kind, F.lit("ARRAY")) & ~F.startswith(kind, F.lit("OBJECT")), F.try_variant_get(value, path, "string"))


def content(turn: Column) -> Column:
    """A turn's content: content, else value; a list's strings and texts joined by blanks; stripped."""

    def of(path: str) -> Column:
        items = F.try_variant_get(turn, path, "array<variant>")
        joined = F.array_join(F.filter(F.transform(items, lambda x: F.coalesce(F.try_variant_get(x, "$.text", "string"), F.try_variant_get(x, "$", "string"))), lambda x: x.isNotNull()), " ")
        return F.coalesce(joined, _text(turn, path))

    return strip(F.coalesce(F.nullif(of("$.content"), F.lit("")), of("$.value"), F.lit("")))


def turns(value: Column, path: str) -> Column:
    """The cleaned user and assistant turns of a list under a path; empty without one."""
    listed = F.coalesce(F.try_variant_get(value, path, "array<variant>"), F.array().cast("array<variant>"))
    role = lambda t: F.coalesce(_text(t, "$.role"), _text(t, "$.from"), F.lit(""))
    return dialog.clean(F.transform(listed, lambda t: F.struct(role(t).alias("role"), content(t).alias("content"))))


def _pair(value: Column, user: str, assistant: str) -> Column:
    one, two = (strip(F.coalesce(_text(value, p), F.lit(""))) for p in (user, assistant))
    both = F.array(F.struct(F.lit("user").alias("role"), one.alias("content")), F.struct(F.lit("assistant").alias("role"), two.alias("content")))
    return F.when((one != "") & (two != ""), both)


def messages(value: Column) -> Column:
    """The messages of any layout; empty where none fits."""
    some = lambda c: F.when(F.size(c) > 0, c)
    empty = F.array().cast(dialog.TURNS)
    return F.coalesce(some(turns(value, "$")), some(turns(value, "$.messages")), some(turns(value, "$.conversations")), _pair(value, "$.instruction", "$.response"), _pair(value, "$.user", "$.assistant"), empty)


def chat_rows(lines: DataFrame, key: str, *, ids: tuple[str, ...] = ("source_id", "id"), default_language: str = "english", mode: str = "strict") -> DataFrame:
    """Lines to canonical rows: messages, instruction, response, language, source, source_id."""
    parsed = parse(lines, mode=mode)
    typed = parsed.select("row_index", messages(F.col("value")).alias("messages"), _text(F.col("value"), "$.language").alias("language"), _text(F.col("value"), "$.source").alias("source"), *[_text(F.col("value"), f"$.{c}").alias(c) for c in ids])
    return dialog.canonical_rows(typed, key, ids=ids, default_language=default_language)


def read_document(spark: SparkSession, path: str) -> DataFrame:
    """One JSON document a file: (file, value). Where no file fits the path, one row with an empty object."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not there.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(there):
        return spark.range(1).select(F.lit(path).alias("file"), F.parse_json(F.lit("{}")).alias("value"))
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.try_parse_json("value").alias("value"))


def first_source(*candidates: DataFrame | None) -> DataFrame | None:
    """The first table that exists and has a row."""
    for rows in candidates:
        if rows is not None and rows.limit(1).count():
            return rows
    return None
