"""Statistics tables: totals above subtotals above details."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.functions.text import all_label, display_name, duration


def _report(df: DataFrame, tag: str | None, key: str, label: str, total_label: str, measure: Column | None, name: str) -> DataFrame:
    """TOTAL, SUBTOTAL (of ``tag``, if given) and DETAIL rows. ``df`` is evaluated once: it is added up by tag and value,
    and all rows come from those few sums, to which a zero is added so that there is a TOTAL over no rows, too."""
    count = measure is None
    zero = F.lit(0).cast("long") if count else F.lit(0.0)
    kinds = {"_tag": F.lit(None).cast("string") if tag is None else F.col(tag), "_key": F.col(key)}
    sums = df.select(*(c.alias(n) for n, c in kinds.items()), *(() if count else (measure.alias("_m"),)))
    sums = sums.groupBy("_tag", "_key").agg((F.count(F.lit(1)) if count else F.coalesce(F.sum("_m"), F.lit(0.0))).alias("_sum"))
    nothing = df.sparkSession.range(1).select(*(F.lit(None).cast(sums.schema[n].dataType).alias(n) for n in kinds), zero.alias("_sum"))
    sets = [[], ["_key"], *([["_tag"]] if tag is not None else [])]
    grouped = sums.unionByName(nothing).groupingSets([[F.col(c) for c in x] for x in sets], "_tag", "_key")
    rows = grouped.agg(F.sum("_sum").alias(name), F.grouping("_tag").alias("_no_tag"), F.grouping("_key").alias("_no_key"))
    category = F.when(F.col("_no_tag") == 0, "SUBTOTAL").when(F.col("_no_key") == 0, "DETAIL").otherwise("TOTAL")
    text = F.when(F.col("_no_tag") == 0, all_label(F.col("_tag"))).when(F.col("_no_key") == 0, F.col("_key")).otherwise(total_label)
    named = rows.select(category.alias("category"), text.alias(label), name)
    return named.where(F.col(label).isNotNull())


def total_detail(df: DataFrame, key: str, label: str, total_label: str, measure: Column | None = None, name: str = "count") -> DataFrame:
    """``category, label, name``: one TOTAL row, also over no rows, then a DETAIL row for each key that is not null.
    ``measure`` defaults to a count of rows."""
    return _report(df, None, key, label, total_label, measure, name)


def with_subtotals(df: DataFrame, tag: str, key: str, label: str, total_label: str) -> DataFrame:
    """As :func:`total_detail`, with a SUBTOTAL row for each tag; a detail is of its value alone, whatever its tag."""
    return _report(df, tag, key, label, total_label, None, "count")


def ordered(report: DataFrame, label: str) -> DataFrame:
    """TOTAL, SUBTOTAL, DETAIL, each by label."""
    rank = F.when(F.col("category") == "TOTAL", 0).when(F.col("category") == "SUBTOTAL", 1).otherwise(2)
    return report.orderBy(rank, label)


def top(df: DataFrame, key: str, n: int) -> DataFrame:
    """The n commonest values, ties by value."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), key).limit(n)


def sample_by_layer(df: DataFrame, layer: str, order: str, n: int) -> DataFrame:
    """The first n rows of each layer."""
    from pyspark.sql import Window

    nth = F.row_number().over(Window.partitionBy(layer).orderBy(order))
    return df.withColumn("_nth", nth).where(F.col("_nth") <= n).drop("_nth")


def inventory(layers: DataFrame, analysis: str, layer: str, kind: str = "vector") -> DataFrame:
    """``analysis, layer, type, features`` of a table of layered features."""
    counted = layers.groupBy(F.col(layer).alias("_layer")).agg(F.count(F.lit(1)).alias("features"))
    return counted.select(F.lit(analysis).alias("analysis"), F.concat(F.lit(analysis.lower() + "_"), "_layer").alias("layer"), F.lit(kind).alias("type"), "features")


def consolidate(layers: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    """Layers of several analyses one under another by column name, with ``analysis`` and ``layer``, the latter led by
    the analysis. Columns that a layer lacks are null."""
    named = [
        df.select(F.lit(analysis).alias("analysis"), F.lit(f"{analysis.lower()}_{layer}").alias("layer"), *[F.col(f"`{c}`") for c in df.columns if c not in ("analysis", "layer")])
        for (analysis, layer), df in layers.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def profile(df: DataFrame) -> DataFrame:
    """``column, non_null, nulls, distinct_values`` of every column, in one pass; nulls are no value."""
    stats = []
    for i, c in enumerate(df.columns):
        stats += [F.count(F.col(f"`{c}`")).alias(f"n{i}"), F.count_distinct(F.col(f"`{c}`")).alias(f"d{i}")]
    one = df.agg(F.count(F.lit(1)).alias("rows"), *stats)
    each = F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("non_null"), (F.col("rows") - F.col(f"n{i}")).alias("nulls"), F.col(f"d{i}").alias("distinct_values")) for i, c in enumerate(df.columns)))
    return one.select(F.explode(each).alias("p")).select("p.*")


def combined(population: DataFrame, farmland: DataFrame, features: DataFrame) -> DataFrame:
    """``Impact_Category, Metric, Value, Unit``. ``population`` has ``total_population``; ``farmland`` has ``area_km2,
    total_area_km2, cells``; ``features`` has ``tag`` for each feature. Totals are there even over no rows, tags only
    with features."""

    def rows(df: DataFrame, category: str, *metrics) -> DataFrame:
        each = F.array(*(F.struct(F.lit(category).alias("Impact_Category"), F.lit(m).alias("Metric"), v.cast("double").alias("Value"), F.lit(u).alias("Unit")) for m, v, u in metrics))
        return df.select(F.explode(each).alias("r")).select("r.*")

    people = rows(population.agg(F.coalesce(F.sum("total_population"), F.lit(0.0)).alias("v")), "POPULATION", ("Total Population Affected", F.col("v"), "people"))
    sums = farmland.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("area_km2", "total_area_km2", "cells")))
    share = F.when(F.col("total_area_km2") > 0, F.col("area_km2") / F.col("total_area_km2") * 100).otherwise(0.0)
    fields = rows(
        sums, "FARMLAND", ("Farmland Area Affected", F.col("area_km2"), "km²"), ("Total Basin Area Analyzed", F.col("total_area_km2"), "km²"),
        ("Farmland Coverage", share, "%"), ("Farmland Cells (10m pixels)", F.col("cells"), "cells"),
    )
    total = rows(features.agg(F.count(F.lit(1)).alias("v")), "INFRASTRUCTURE", ("Total Features Affected", F.col("v"), "features"))
    tags = features.where("tag is not null").groupBy("tag").agg(F.count(F.lit(1)).alias("v")).where("v > 0")
    tags = tags.select(F.lit("INFRASTRUCTURE").alias("Impact_Category"), display_name(F.col("tag")).alias("Metric"), F.col("v").cast("double").alias("Value"), F.lit("features").alias("Unit"))
    return reduce(DataFrame.unionByName, [people, fields, total, tags])


def workflow_summary(ledger: DataFrame) -> DataFrame:
    """``analysis, status, duration_seconds, duration_formatted, error`` of a ledger with ``analysis, status, seconds,
    error``; a failed analysis has no duration."""
    ok = F.col("status") == "SUCCESS"
    return ledger.select(
        "analysis", "status", F.when(ok, F.bround("seconds", 2)).otherwise(0.0).alias("duration_seconds"),
        F.when(ok, duration(F.col("seconds"))).otherwise("N/A").alias("duration_formatted"),
        F.when(~ok, F.coalesce("error", F.lit("Unknown error"))).alias("error"),
    )


def speedup(ledger: DataFrame, wall_seconds: float) -> DataFrame:
    """``succeeded, failed, total_seconds, speedup``: the sum of durations over the wall time."""
    ok = F.col("status") == "SUCCESS"
    total = F.coalesce(F.sum(F.when(ok, F.col("seconds"))), F.lit(0.0))
    return ledger.agg(F.count_if(ok).alias("succeeded"), F.count_if(~ok).alias("failed"), total.alias("total_seconds"), (total / wall_seconds).alias("speedup"))
