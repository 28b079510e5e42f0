"""Session settings the jobs rely on, and the shared scratch location."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str = "goldthread", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs assume; ``conf`` entries override them."""
    settings = {
        # Wall-clock columns are TIMESTAMP_NTZ and run folders are derived from UTC instants.
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Keeps the deduplication state of a stream off the heap.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder that every executor can reach.

    It lies under ``spark.checkpoint.dir``, or under the warehouse where that is unset; both are
    shared on a cluster.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
