"""Session helpers."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession


def ensure_importable(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package where it is run from a checkout. On a cluster where that folder does not
    exist ship the package with ``--py-files`` instead; the entry is harmless there."""
    root = str(Path(__file__).resolve().parent.parent)
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(":") if p]
    if root not in paths:
        environment["PYTHONPATH"] = ":".join([root, *paths])
    return spark
