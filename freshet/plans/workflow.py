"""Runs analyses, each failure on its own, whole or in batches of zones, and keeps the ledger."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.operators import reports
from freshet.plans import impact

LEDGER = "analysis string, status string, seconds double, error string"


def _tried(name: str, action: Callable[[], None]) -> tuple:
    began = time.perf_counter()
    try:
        action()
        return name, "SUCCESS", time.perf_counter() - began, None
    except Exception as error:  # noqa: BLE001  the ledger tells it
        return name, "FAILED", 0.0, str(error).splitlines()[0] if str(error) else type(error).__name__


def run(spark: SparkSession, analyses: Mapping[str, Callable[[], DataFrame]], folder: str, workers: int = 1) -> DataFrame:
    """Writes each analysis under ``folder`` as a headed CSV and returns the ledger. A failed analysis is recorded and
    the others still run. ``workers`` analyses are submitted at a time; they share the session's executors."""

    def one(item) -> tuple:
        name, make = item
        path = f"{folder}/{name.lower()}_statistics"
        return _tried(name, lambda: make().repartition(1).write.mode("overwrite").option("header", True).csv(path))

    with ThreadPoolExecutor(max(1, workers)) as pool:
        return spark.createDataFrame(list(pool.map(one, analyses.items())), LEDGER)


def run_batches(spark: SparkSession, zones: DataFrame, make: Callable[[DataFrame], DataFrame], folder: str, batch: int = 50) -> DataFrame:
    """Writes ``make(zones of a batch)`` as Parquet under ``folder/batch=<n>``, batches being of ``batch`` zones in order
    of their distance from the origin, and returns the ledger, a row for each batch. A failed batch is recorded and the
    others still run. The dealing is written first and read again by a later call on the same folder, which does again
    only what is not there: a run that was lost goes on where it stopped."""
    from freshet.sources import files

    def there(path: str) -> bool:
        try:
            return bool(files.require(spark, f"{path}/_SUCCESS"))
        except FileNotFoundError:
            return False

    dealing = f"{folder}/_dealing"
    if not there(dealing):
        impact.zones_by_distance(zones, batch).select("linkno", "batch").write.mode("overwrite").parquet(dealing)
    dealt = spark.read.parquet(dealing)
    last = dealt.agg(F.max("batch")).first()[0]
    rows = []
    for n in range(0 if last is None else last + 1):
        path = f"{folder}/batch={n}"
        if there(path):
            rows.append((f"batch {n}", "SUCCESS", 0.0, None))
            continue
        own = impact.requested(zones, dealt.where(F.col("batch") == n))
        rows.append(_tried(f"batch {n}", lambda: make(own).write.mode("overwrite").parquet(path)))
    return spark.createDataFrame(rows, LEDGER)


def batch_results(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of all finished batches, with ``batch``."""
    return spark.read.option("basePath", folder).parquet(f"{folder}/batch=*")


def summary(ledger: DataFrame, wall_seconds: float) -> tuple[DataFrame, DataFrame]:
    return reports.workflow_summary(ledger), reports.speedup(ledger, wall_seconds)
