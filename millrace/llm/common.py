"""What the operators of this package share: work folders, materialised tables, word patterns."""

from __future__ import annotations

import ctypes
import threading
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import work_path

#: A word: a run of characters that are neither the blank nor one of tab, newline, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"
BATCH_ROWS = 500
_lock = threading.Lock()
_holders: dict[int, tuple[int, str]] = {}


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """While this holds, jobs pass texts to Python in batches of BATCH_ROWS rows, so that long texts need little memory.
    Of threads that share a session the first sets it and the last sets it back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    with _lock:
        users, before = _holders.get(id(spark), (0, spark.conf.get(key)))
        _holders[id(spark)] = (users + 1, before)
        spark.conf.set(key, str(min(BATCH_ROWS, int(before)) if int(before) > 0 else BATCH_ROWS))
    try:
        yield
    finally:
        with _lock:
            users, before = _holders.pop(id(spark))
            if users > 1:
                _holders[id(spark)] = (users - 1, before)
            else:
                spark.conf.set(key, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df below the shared folder and read it back: its lineage ends there, and it outlives lost executors."""
    path = work_path(df.sparkSession, name)
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spare(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that no column of df has."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def without(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str, limit: int) -> DataFrame:
    """The rows of docs that agree in id and text digest with no row of gone (id, digest), with their own columns."""
    key, digest = spare(docs, "gone_id", "gone_digest")
    named = gone.select(F.col("id").alias(key), F.col("digest").alias(digest)).distinct()
    on = docs[id_col].eqNullSafe(F.col(key)) & (F.xxhash64(docs[text_col]) == F.col(digest))
    return docs.join(broadcast_if(named, named.count(), limit), on, "left_anti")


def text_of(name: str) -> Column:
    """The column's text; null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def word_count(text: Column) -> Column:
    """Words of a text as a long; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def broadcast_if(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """df with a broadcast hint when its counted rows are within limit; beyond it Spark shuffles for the join."""
    return F.broadcast(df) if rows <= limit else df


def release_memory() -> None:
    """Give a worker's freed memory back to the system: workers are kept between tasks, and allocators keep their pools."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
