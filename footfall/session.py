"""Session defaults. Operators work on any session; these are the tuned settings."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def build_session(
    app_name: str = "footfall",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under the cluster's ``spark.checkpoint.dir``.

    Only a local session with no such setting (tests) may fall back to a
    folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", "") or ""
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        return tempfile.mkdtemp(prefix=f"footfall-{purpose}-")
    unique = spark.sql("select uuid() as u").first().u
    return f"{base.rstrip('/')}/footfall-{purpose}-{unique}"
