"""Session construction and the few settings the engine relies on."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(app: str = "millrace", cores: int | None = None, **conf: str) -> SparkSession:
    """A local session with UTC time, adaptive execution and a partition count that fits the cores."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "6g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_shipped: set[str] = set()
_local: dict[str, str] = {}
_kept: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, whatever folder they start in; once an application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    # executors may ask for the file at any time, so that it stays until the driver ends
    folder = tempfile.mkdtemp(prefix="millrace-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    copy = os.path.join(folder, "package", os.path.basename(root))
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns("__pycache__"))
    context.addPyFile(shutil.make_archive(os.path.join(folder, f"{os.path.basename(root)}-{context.applicationId}"), "zip", os.path.dirname(copy)))
    _shipped.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir. Where that is unset, a local master gets
    a temporary folder; elsewhere it is an error, since every executor would write to a disk of its own."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if context.applicationId not in _local:
        _local[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="millrace-")
    return _local[context.applicationId]


def work_dir(spark: SparkSession) -> str:
    """The application's own folder below the shared one; it goes when the driver's JVM ends."""
    folder = f"{shared_dir(spark)}/millrace-{spark.sparkContext.applicationId}"
    if folder not in _kept:
        ship(spark)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _kept.add(folder)
    return folder


def work_path(spark: SparkSession, name: str) -> str:
    """A new path below the application's folder."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def table(spark: SparkSession, sf_dir: str, name: str):
    """One of the Parquet tables of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows):
    """Rows that come from a few files dealt to all cores, so that texts in few row groups are worked on in parallel;
    larger inputs as they are."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < 2 * cores else rows
