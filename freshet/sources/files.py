"""Tables of text and the files themselves, through Spark's file systems, so that paths may lie in any store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _path(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def require(spark: SparkSession, path: str, folder: bool = False) -> str:
    """``path`` itself; ``FileNotFoundError`` if nothing is there, ``NotADirectoryError`` if ``folder`` and it is a file."""
    fs, at = _path(spark, path)
    if not fs.exists(at):
        raise FileNotFoundError(path)
    if folder and not fs.getFileStatus(at).isDirectory():
        raise NotADirectoryError(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A headed CSV file or folder. Types are those of ``schema``, or else inferred, which reads it twice."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(require(spark, path))


def copy(spark: SparkSession, source: str, target: str) -> None:
    """A file or folder under another name; an existing target is replaced."""
    (a, b), (c, d) = _path(spark, require(spark, source)), _path(spark, target)
    c.delete(d, True)
    if not spark._jvm.org.apache.hadoop.fs.FileUtil.copy(a, b, c, d, False, spark._jsc.hadoopConfiguration()):
        raise OSError(f"could not copy {source} to {target}")


def rename(spark: SparkSession, source: str, target: str) -> None:
    """As :func:`copy`, the source being gone afterwards."""
    (a, b), (_, d) = _path(spark, require(spark, source)), _path(spark, target)
    a.delete(d, True)
    if not a.rename(b, d):
        raise OSError(f"could not rename {source} to {target}")


def remove(spark: SparkSession, path: str) -> bool:
    """Deletes a file or folder; whether there was one."""
    fs, at = _path(spark, path)
    return bool(fs.delete(at, True))


def publish(spark: SparkSession, outputs: dict[str, str], folder: str) -> list[str]:
    """Copies each analysis' output to ``folder`` as ``{analysis}_{name}``, lower case, and says where."""
    done = []
    for analysis, path in outputs.items():
        target = f"{folder.rstrip('/')}/{analysis.lower()}_{path.rstrip('/').rsplit('/', 1)[-1]}"
        copy(spark, path, target)
        done.append(target)
    return done
