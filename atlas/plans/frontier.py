"""P7–P8: border nodes of one build and the portals between builds."""

from __future__ import annotations

from pyspark.sql import DataFrame

from atlas.gates.frontier import portal_gate
from atlas.operators import matching
from atlas.session import cut_lineage


def build_frontier(nodes: DataFrame, edges: DataFrame, road_nodes: DataFrame) -> DataFrame:
    """Border nodes of a routing graph with their OSM ids: country, level, lat_e7, lon_e7, local_id, osm, source.

    ``nodes(id, country, level, lat_e7, lon_e7, tile_osm)``; ``road_nodes(id, lat_e7, lon_e7)`` are the nodes of
    road and ferry ways of the source extract (ferries included: crossings may be by ship).
    """
    border = matching.frontier_extract(nodes, edges).select("id")
    rows = nodes.join(border, "id", "left_semi")
    named = matching.frontier_osm_id(rows, road_nodes)
    return named.select("country", "level", "lat_e7", "lon_e7", named["id"].alias("local_id"), "osm", "source")


def build_portal_set(frontier: DataFrame, regions: DataFrame, borders: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Portal rows of every pair of countries, counts per pair, and the gate's findings."""
    pairs, stats = matching.all_pairs(frontier)
    pairs, stats = cut_lineage(pairs), cut_lineage(stats)
    return matching.portal_table(pairs, regions), stats, portal_gate(stats, borders, regions.select("country"))
