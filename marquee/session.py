"""Session helpers."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)


def ready(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package where it isn't installed (local runs), and pins the zone."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark
