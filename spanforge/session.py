"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "spanforge", cpus: str = "*", partitions: int = 8) -> SparkSession:
    """Local session for tests and benches; a cluster passes its own session."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SPANFORGE_DRIVER_MEMORY", "12g"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a folder of its own;
    on a cluster a missing setting is an error, since executors could not read a
    driver-local folder back.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        current = sc.getCheckpointDir()
    return current


#: Spark drops the shuffle files of a query that has run where this is set.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """What runs inside drops its shuffle files at its end; else they stay until the driver happens to collect its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and forget its lineage."""
    shared_dir(df.sparkSession)
    with freed(df.sparkSession):
        # a plan of its own, made under the setting
        return df.select("*").checkpoint(eager=True)


def stage(df: DataFrame) -> DataFrame:
    """``cut`` for tables of many rows: compressed columns in the shared folder, a fraction of a checkpoint's plain rows."""
    path = shared_path(df.sparkSession, "stage")
    with freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def no_broadcast(spark: SparkSession) -> Iterator[None]:
    """Sort-merge joins for what runs inside, so that no side of a join passes through the driver.

    A job of many joins holds many broadcast tables at once, each of which the size check lets through on its own.
    """
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    try:
        yield
    finally:
        for n, value in before.items():
            spark.conf.unset(n) if value is None else spark.conf.set(n, value)
