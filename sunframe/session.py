"""What a session needs before a query runs."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def prepared(spark: SparkSession) -> SparkSession:
    """Times in UTC, and Python workers that find this package where the driver does."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, _ROOT])
    return spark
