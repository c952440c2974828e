"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_SETTINGS = {
    # Event times are UTC on both sides of every comparison.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

_local_scratch: dict[str, str] = {}


def build_session(app_name: str = "hazardlake", **conf: str) -> SparkSession:
    """Session with the settings the operators expect; master and sizes come from the caller."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named by the cluster.

    ``spark.checkpoint.dir`` decides. Only a local session without that setting gets a
    temporary folder of its own; on a cluster a machine-local folder would be lost with
    its machine, so that case is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_scratch:
        _local_scratch[context.applicationId] = tempfile.mkdtemp(prefix="hazardlake-")
    return _local_scratch[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """New, not yet existing path below the scratch root."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
