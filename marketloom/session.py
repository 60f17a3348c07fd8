"""Session defaults.  Only settings the caller left unset are filled in."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Exchange-local wall clock; operators read TIMESTAMP_NTZ or session-local time.
EXCHANGE_TIME_ZONE = "Asia/Shanghai"

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app_name: str = "marketloom", **conf: str) -> SparkSession:
    """Create (or reuse) a session with the engine's defaults.

    Shuffle partitions are left to the cluster: with AQE on, set
    ``spark.sql.shuffle.partitions`` (or ``...coalescePartitions.initialPartitionNum``)
    high and let Spark coalesce.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**_DEFAULTS, "spark.sql.session.timeZone": EXCHANGE_TIME_ZONE, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_scratch(spark: SparkSession) -> str:
    """Folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    On one machine (``local`` masters: tests, notebooks) a temporary folder stands in for
    an absent setting; a cluster must name a folder that all executors share.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return configured or tempfile.mkdtemp(prefix="spark-", dir="/tmp")
