"""``python -m freshet --zones basins.parquet --features osm.parquet --output folder``: all analyses of one area."""

from __future__ import annotations

import argparse
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.functions import wkb
from freshet.operators import spatial
from freshet.plans import impact, workflow
from freshet.sources import geotiff, vector


def shapes(spark: SparkSession, path: str, crs: str = "geographic") -> DataFrame:
    """A vector file with rings, box and edges; rows without geometry go."""
    read = wkb.decoded(vector.read_vector(spark, path)).drop("geometry").where("rings is not null")
    return spatial.with_box(read, crs=crs)


def analyses(spark: SparkSession, given: argparse.Namespace) -> dict:
    """The analyses for which there is input, by name."""
    out = {}
    zones = lambda crs="geographic": shapes(spark, given.zones, crs)
    if given.features:
        features = lambda crs="geographic": shapes(spark, given.features, crs)
        out["Buildings"] = lambda: impact.buildings(zones(), features(), given.cell)
        out["Infrastructure"] = lambda: impact.critical_infrastructure(zones(), features(), given.cell)
        out["Structures"] = lambda: impact.structures(zones(), features(), given.cell)
        out["Transportation"] = lambda: impact.transportation(zones("mollweide"), features("mollweide"), given.cell * 111_000)
    if given.crops:
        out["Farmland"] = lambda: impact.farmland(zones("cea"), shapes(spark, given.crops, "cea").withColumn("crop_id", F.monotonically_increasing_id()), given.cell * 111_000)
    if given.population:
        pixels = lambda: geotiff.read_pixels(spark, given.population).withColumn("pixel", F.struct("tile", "row", "col"))
        out["Population"] = lambda: impact.population(zones(), spatial_pixels(pixels()), given.cell, "pixel")
    return out


def spatial_pixels(pixels: DataFrame) -> DataFrame:
    """Pixels with the rings and edges of their squares."""
    from freshet.functions import geometry as g

    return pixels.withColumn("rings", g.rectangle()).withColumn("edges", g.edges(F.col("rings")))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """Runs what the arguments name and prints the summary; 1 if an analysis failed."""
    parser = argparse.ArgumentParser(prog="freshet", description=__doc__)
    parser.add_argument("--zones", required=True, help="basins with linkno")
    parser.add_argument("--features", help="buildings, infrastructure, roads and rails")
    parser.add_argument("--crops", help="polygons of cropland")
    parser.add_argument("--population", help="folder of GeoTIFF tiles of people")
    parser.add_argument("--output", required=True)
    parser.add_argument("--cell", type=float, default=0.25, help="grid cell of the joins in degrees")
    parser.add_argument("--workers", type=int, default=1, help="analyses at a time")
    given = parser.parse_args(argv)
    spark = spark or SparkSession.builder.appName("freshet").getOrCreate()
    began = time.perf_counter()
    ledger = workflow.run(spark, analyses(spark, given), given.output, given.workers)
    rows, speed = workflow.summary(ledger, time.perf_counter() - began)
    rows.repartition(1).write.mode("overwrite").option("header", True).csv(f"{given.output}/workflow_summary")
    rows.show(truncate=False)
    speed.show()
    return int(ledger.where("status <> 'SUCCESS'").count() > 0)


if __name__ == "__main__":
    raise SystemExit(main())
