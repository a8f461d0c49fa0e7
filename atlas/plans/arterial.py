"""P9: the arterial network with its ferries and the small roads that join them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlas.functions import geo, osm
from atlas.operators import features, filters, network, routes
from atlas.session import cut_lineage, stored


@dataclass(frozen=True)
class ArterialNetwork:
    way: DataFrame         # id, refs, tags
    relation: DataFrame    # turn restrictions
    connector: DataFrame   # source, way, length, highway
    ends: DataFrame        # source, outcome, length


def way_lengths(way: DataFrame, node: DataFrame) -> DataFrame:
    """Metres of each way; nodes without a position drop their steps."""
    placed = way.select(F.col("id").alias("way"), F.posexplode("refs").alias("i", "node")).join(
        node.select(F.col("id").alias("node"), "lat", "lon"), "node", "left")
    return routes.path_length(placed, ["way"], "i", geo.haversine)


def build_arterial_network(node: DataFrame, way: DataFrame, relation: DataFrame) -> ArterialNetwork:
    tags = F.col("tags")
    node, way = stored(node, "nodes"), stored(way, "ways")
    base = way.filter(filters.arterial(tags) | F.coalesce(tags["route"] == "ferry", F.lit(False)))
    small = way.filter(filters.routable(tags) & ~filters.arterial(tags) & ~F.coalesce(tags["route"] == "ferry", F.lit(False)))
    sources = cut_lineage(network.ferry_ends(way))
    spots = sources.select(F.col("source").alias("id")).distinct().join(node, "id").select("id", F.col("id").alias("ord"), "lat", "lon")

    def search(ends: DataFrame, box: float):
        boxes = network.grid_glue(spots.join(ends.select(F.col("source").alias("id")), "id", "left_semi"), box)
        near = network.in_boxes(node.select("id", "lat", "lon"), boxes, box).select(F.col("id").alias("node"))
        close = small.join(features.way_places(small).join(near, "node", "left_semi").select(F.col("way").alias("id")), "id", "left_semi")
        candidates = cut_lineage(close.unionByName(base.filter(filters.arterial(tags))))
        lengths = way_lengths(candidates, node).select("way", "length")
        classes = candidates.select(F.col("id").alias("way"), tags["highway"].alias("highway"))
        return network.connectors(ends, network.way_nodes(candidates), lengths, classes)

    found, ends = search(sources, network.BOX_DEGREES)
    ends = cut_lineage(ends)
    unreached = ends.filter("outcome = 'unreached'").select("source")
    if not unreached.isEmpty():
        more, again = search(unreached, network.WIDE_BOX_DEGREES)
        found = found.unionByName(more)
        ends = ends.join(unreached, "source", "left_anti").unionByName(again)
    found = cut_lineage(found.dropDuplicates(["source", "way"]))
    ids = found.select(F.col("way").alias("id")).distinct()
    lifted = way.join(ids, "id", "left_semi").withColumn("tags", osm.promote_tags(tags))
    kept = base.unionByName(lifted).withColumn("kind", F.lit("w"))
    return ArterialNetwork(filters.merge_extracts(kept).drop("kind"), relation.filter(tags["type"].startswith("restriction")), found, ends)
