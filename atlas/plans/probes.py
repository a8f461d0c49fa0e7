"""P11: candidates for one-way and grade-separation probes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlas.operators import probes


def find_probe_candidates(ways: DataFrame, vertices: DataFrame) -> DataFrame:
    """``ways(id, tags, length)``, ``vertices(way, idx, node, lat, lon)`` → kind, bridge (way id), metres and, for
    grade separations, the road below and both points."""
    pairs = probes.grade_separation_pairs(ways.select("id", "tags"), vertices)
    apart = probes.interchange_exclusion(pairs, ways, vertices)
    top = probes.bridge_top(apart).select(F.lit("grade_separation").alias("kind"), "bridge", F.col("separation_m").alias("metres"),
                                          "road", "b_lat", "b_lon", "r_lat", "r_lon")
    one = probes.closest_to_400m(ways).select(F.lit("oneway").alias("kind"), F.col("id").alias("bridge"), F.bround("length").cast("int").alias("metres"))
    return top.unionByName(one, allowMissingColumns=True)
