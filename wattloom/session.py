"""Session settings, the shared scratch folder and the size-checked broadcast."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app_name: str = "wattloom", master: str | None = None, **settings: str) -> SparkSession:
    """Session with the settings the operators rely on; the cluster's own values win over these."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder for one run, below the shared folder named by ``spark.checkpoint.dir``.

    Executors can be lost, so nothing is kept on one machine's disk when the cluster names a shared
    folder. Only a session that names none (tests on one machine) gets a local one, once.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("wattloom.scratch.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            base = tempfile.mkdtemp(prefix="wattloom-")
            spark.conf.set("wattloom.scratch.dir", base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session with other settings for a while."""
    before = {name: spark.conf.get(name) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


#: The shuffle files of a query go when it has ended; otherwise they stay until the driver's garbage collection finds them unused.
DROP_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def store(df: DataFrame, label: str) -> DataFrame:
    """Write a frame that several jobs read to the shared scratch folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with settings(spark, DROP_SHUFFLES):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, max_rows: int = 500_000) -> DataFrame:
    """Hint a broadcast only after a bounded count has shown at most ``max_rows`` rows.

    Meant for stored tables, where the count reads footers only. A larger frame is returned without
    a hint, and the join shuffles with adaptive skew splitting.
    """
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df
