"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "caselore", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC; what spark-submit or conf says comes before these settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    asked = {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in {"spark.cleaner.referenceTracking.cleanCheckpoints": "true", **asked}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",  # split a hot key even if it costs a shuffle
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.shuffle.partitions": "2000",
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    given = spark.sparkContext.getConf()
    for key, value in settings.items():
        if key not in asked and not given.contains(key):
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder the cluster names; a temporary one only on a local master."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        if not context.getCheckpointDir():
            context.setCheckpointDir(named)
        return spark.conf.get("spark.checkpoint.dir", None) or named
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="caselore-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def held(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting for what is begun inside."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries begun inside delete their shuffle files as they end; for results that are stored and read again."""
    with held(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        yield


def widen(scan: DataFrame) -> DataFrame:
    """Spread a scan over the cores if it has fewer splits than there are cores.

    Many-file input has more splits than cores and is left alone, without a shuffle; a single
    small file would otherwise keep all the work on it in one task.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
