"""Session settings and the scratch folder that all executors can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from lakeshelf.sources.files import make_temporary

# No master here: the launcher (spark-submit, a notebook, a test) chooses it.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when the split costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # Collecting a stack trace per column expression slows down building large plans.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "lakeshelf", **overrides: str) -> SparkSession:
    """A session with the defaults above, changed by ``**{"spark.some.key": value}``."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written intermediate table, dropped when the application ends.

    The folder is the one the cluster names in ``spark.checkpoint.dir``; without that setting
    it is the warehouse, which driver and executors share as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{root.rstrip('/')}/lakeshelf-{uuid.uuid4().hex}"
    make_temporary(spark, folder)
    return f"{folder}/{name}"
