"""Recorded route answers: shapes, gaps, lengths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from atlas.functions import geo


def shape_points(routes: DataFrame, key: Sequence[str], shape: str = "shape") -> DataFrame:
    """Points of each encoded shape in order: key…, i, lat, lon. Positions are running sums, so a point
    row costs the same in a long shape as in a short one."""
    steps = routes.select(*key, F.posexplode(geo.polyline6_steps(F.col(shape))).alias("i", "s"))
    along = Window.partitionBy(*key).orderBy("i")
    return steps.select(*key, "i", (F.sum("s.dlat").over(along) / F.lit(1e6)).alias("lat"),
                        (F.sum("s.dlon").over(along) / F.lit(1e6)).alias("lon"))


def with_next(points: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    along = Window.partitionBy(*key).orderBy(order)
    return points.withColumn("lat2", F.lead("lat").over(along)).withColumn("lon2", F.lead("lon").over(along))


def largest_gap(points: DataFrame, key: Sequence[str], order: str = "i") -> DataFrame:
    """Longest step between consecutive points of each route and where it starts: key…, gap_km, lat, lon."""
    km = F.coalesce(geo.haversine(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2"), geo.EARTH_KM), F.lit(0.0))
    steps = with_next(points, key, order).withColumn("km", km)
    worst = F.max_by(F.struct("lat", "lon", "lat2", "lon2"), F.struct("km", -F.col(order))).alias("w")
    out = steps.groupBy(*key).agg(F.max("km").alias("gap_km"), worst)
    moved = F.col("gap_km") > 0
    return out.select(*key, "gap_km", F.when(moved, F.col("w.lat")).alias("lat"), F.when(moved, F.col("w.lon")).alias("lon"))


def path_length(points: DataFrame, key: Sequence[str], order: str, distance) -> DataFrame:
    """Sum of the distances between consecutive located points of each path; a missing point drops its
    two steps."""
    d = F.coalesce(distance(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2")), F.lit(0.0))
    return with_next(points, key, order).groupBy(*key).agg(F.sum(d).alias("length"))
