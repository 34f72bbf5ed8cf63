"""Session helpers."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def get_session(app: str = "quillrun", master: str | None = None, **conf: str) -> SparkSession:
    """A UTC session; cluster settings such as the master come from spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.executorEnv.OMP_NUM_THREADS": "1",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_width(spark: SparkSession) -> int:
    """The number of shuffle partitions the session is sized for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder of the cluster (``spark.checkpoint.dir``).

    Where that setting is absent, the warehouse stands in, which executors share too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    root = root or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
