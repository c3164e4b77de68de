"""Writers, and the read-back that checks what was written."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_jsonl(rows: DataFrame, path: str, mode: str = "error", by: str | None = None) -> None:
    """One object a line; in a folder a value of a column, if one is given."""
    writer = rows.write.mode(mode)
    (writer.partitionBy(by) if by else writer).json(path)


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """A small file, whole or not at all: written beside its place and renamed over what is there."""
    fs = spark._jvm.org.apache.hadoop.fs
    place, beside = fs.Path(path), fs.Path(path + ".tmp")
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(place.getParent())
    stream = files.create(beside, True)
    try:
        stream.write(bytearray(content))
    finally:
        stream.close()
    over = spark.sparkContext._gateway.new_array(getattr(spark._jvm, "org.apache.hadoop.fs.Options$Rename"), 1)
    over[0] = getattr(spark._jvm, "org.apache.hadoop.fs.Options$Rename").OVERWRITE
    fs.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration()).rename(beside, place, over)


def write_document(spark: SparkSession, path: str, value: object) -> None:
    """One JSON document with sorted keys, whole or not at all."""
    write_bytes(spark, path, (json.dumps(value, indent=2, sort_keys=True, ensure_ascii=False) + "\n").encode())


def write_arrays(rows: DataFrame, path: str, column: str = "messages", order: str | None = None, mode: str = "error") -> None:
    """One bare array a line; in order, if one is given, over the files by name."""
    ordered = rows.orderBy(order) if order else rows
    ordered.select(F.to_json(column).alias("value")).write.mode(mode).text(path)


def write_corpus(rows: DataFrame, path: str, column: str = "text", order: str | None = None, mode: str = "error") -> None:
    """Texts with a blank line between them."""
    ordered = rows.orderBy(order) if order else rows
    ordered.select(F.col(column).alias("value")).write.mode(mode).option("lineSep", "\n\n").text(path)


def append_checkpoint(rows: DataFrame, path: str) -> None:
    """Add rows to a checkpoint table; the committer makes them visible together."""
    rows.write.mode("append").parquet(path)


def publish(rows: DataFrame, path: str, columns: list[str], split: str = "train", mode: str = "error") -> None:
    """The fixed columns, as one split of a data set."""
    rows.select(*columns, F.lit(split).alias("split")).write.mode(mode).partitionBy("split").parquet(path)


def read_back(spark: SparkSession, path: str, expected: int) -> DataFrame:
    """One row: lines, lines that are a user turn and an assistant turn, and whether both are as many as expected."""
    schema = "array<struct<role:string,content:string>>"
    lines = spark.read.text(path).select(F.from_json("value", schema).alias("m"))
    good = (F.size("m") == 2) & (F.get("m", F.lit(0))["role"] == "user") & (F.get("m", F.lit(1))["role"] == "assistant")
    return lines.agg(F.count(F.lit(1)).alias("n_lines"), F.count_if(good).alias("n_good")).withColumn("ok", (F.col("n_lines") == expected) & (F.col("n_good") == expected))
