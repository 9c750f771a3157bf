"""SparkSession helpers.

Master, executor sizing, shuffle partitions and ``spark.checkpoint.dir`` belong
to the submission; nothing here overrides them.
"""

from __future__ import annotations

import os
import tempfile

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Runtime SQL settings the engine relies on, set only where they are unset:
# adaptive execution re-plans joins from runtime sizes, coalesces small shuffle
# partitions and splits skewed ones; dates are taken in UTC.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def get_spark(master: str | None = None, app: str = "adinsight",
              conf: dict[str, str] | None = None) -> SparkSession:
    """The active session, or a new one with the settings of the submission.

    ``master`` and ``conf`` are for tests and the bench, which submit nothing;
    they do not replace what the submission has set.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    if "PYSPARK_GATEWAY_PORT" in os.environ:  # under spark-submit: take in its settings
        SparkContext._ensure_initialized()
    submitted = SparkConf()
    builder = SparkSession.builder
    wanted = {"spark.app.name": app, **({"spark.master": master} if master else {}), **ENGINE_CONF, **(conf or {})}
    for k, v in wanted.items():
        if not submitted.contains(k):
            builder = builder.config(k, v)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster it must be set: a folder on the driver's machine is not seen
    by executors.  Under a local master an unset folder becomes a scratch one.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
        return current
    existing = spark.sparkContext.getCheckpointDir()
    if existing:
        return existing
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    path = tempfile.mkdtemp(prefix="adinsight-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext.getCheckpointDir()
