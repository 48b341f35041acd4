"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where that is unset, one of our own in local mode, whose driver and
    executor are one process, and a ``RuntimeError`` elsewhere."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = "file://" + tempfile.mkdtemp(prefix="freshet-")
    return _OWN[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/freshet/{name}-{uuid.uuid4().hex}"


def save(df: DataFrame, name: str, **options) -> DataFrame:
    """Writes ``df`` as a Parquet table in the shared folder and returns a scan of it: lineage is cut, and a lost
    executor loses nothing of it."""
    spark = df.sparkSession
    path = new_path(spark, name)
    writer = df.write.option("compression", "zstd")
    for key, value in options.items():
        writer = writer.option(key, value)
    writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._freshet_path = path
    return out


def discard(df: DataFrame) -> None:
    """Deletes a table made by :func:`save` that no later plan reads."""
    path = getattr(df, "_freshet_path", None)
    if path is None:
        return
    spark = df.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def apart(aggregated: DataFrame) -> DataFrame:
    """An aggregate about to be joined on its own key, dealt out once more. A join that shares the aggregate's exchange
    cannot split a hot key of its other side; one with exchanges of its own can."""
    return aggregated.repartition(shuffle_partitions(aggregated.sparkSession))
