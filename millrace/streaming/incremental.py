"""The resumable loop as a stream: new source files are checked once a key, and land in a done or a failed table.

Each micro batch drops the keys that both tables have, so that a batch that runs again after a failure adds nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.dedup import first_wins
from millrace.operators.incremental import remaining


def _table(spark: SparkSession, path: str, schema) -> DataFrame:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)


def process_batch(batch: DataFrame, reason: Callable[[], object], done: str, failed: str, key: str, order: str) -> None:
    """Append the batch's new keys to done, or to failed with their reason."""
    spark = batch.sparkSession
    keys = batch.select(key).schema
    new = remaining(first_wins(batch, [key], [order]), _table(spark, done, keys), _table(spark, failed, keys), key=key)
    judged = new.withColumn("reason", reason()).persist()
    try:
        judged.filter("reason is null").drop("reason").write.mode("append").parquet(done)
        judged.filter("reason is not null").select(key, "reason").write.mode("append").parquet(failed)
    finally:
        judged.unpersist()


def run_available(spark: SparkSession, source: str, schema, reason: Callable[[], object], done: str, failed: str, checkpoint: str, *, key: str, order: str, files_per_batch: int = 1) -> None:
    """Process all Parquet files that are there now, in micro batches, and stop."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    query = (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, _: process_batch(batch, reason, done, failed, key, order))
        .start()
    )
    query.awaitTermination()


def windowed_counts(events: DataFrame, time: str, kind: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts by kind in tumbling windows; rows later than `late` are dropped when this runs as a stream."""
    return events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), kind).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), kind, "n")
