"""Checks of converted tables and of the files behind them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.functions import geometry as g
from freshet.functions import wkb
from freshet.operators import reports, tags


def discover(spark: SparkSession, folder: str, *patterns: str) -> list[str]:
    """Paths under ``folder`` that match any of the patterns, each once, sorted; ``FileNotFoundError`` if none does."""
    found: set[str] = set()
    for pattern in patterns:
        listing = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
        found |= {r[0] for r in listing.select("path").collect()}
    if not found:
        raise FileNotFoundError(f"no {' or '.join(patterns)} under {folder}")
    return sorted(found)


def verify(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """``layer_name, geometry_type, crs, features, empty``: how a table of WKB geometries (binary or hex) is made up.
    Columns it lacks are null."""
    column = lambda c: F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")
    binary = wkb.as_binary(df, geometry)
    typed = df.select(column("layer_name").alias("layer_name"), g.wkb_type(binary).alias("geometry_type"), column("crs").alias("crs"), binary.isNull().alias("none"))
    return typed.groupBy("layer_name", "geometry_type", "crs").agg(F.count(F.lit(1)).alias("features"), F.count_if("none").alias("empty"))


def tag_report(df: DataFrame, keys: tuple[str, ...], n: int = 20) -> DataFrame:
    """``tag, value, count``: the n commonest values of each key, wherever the table keeps it."""
    out = None
    for key in keys:
        one = reports.top(df.select(tags.resolve(df, key).alias("value")), "value", n).select(F.lit(key).alias("tag"), "value", "count")
        out = one if out is None else out.unionByName(one)
    return out


def same_rows(before: DataFrame, after: DataFrame) -> bool:
    """Whether a conversion kept every row."""
    return before.count() == after.count()
