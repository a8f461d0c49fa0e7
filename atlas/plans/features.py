"""P4–P6: navigation features and bus lanes of one country or one network."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlas.operators import features as ops
from atlas.operators import filters
from atlas.session import cut_lineage, stored


def build_navigation_features(node: DataFrame, way: DataFrame, relation: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Feature rows in canonical columns, and what was dropped or enriched (what, n)."""
    return _build(node, way, relation, node, on_network_only=False)


def build_features_for_network(node: DataFrame, way: DataFrame, relation: DataFrame, relation_nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same over a road network: relations and their nodes come from the full source, and every object
    must touch the network."""
    nodes = node.unionByName(relation_nodes.join(node.select("id"), "id", "left_anti"))
    return _build(node, way, relation, nodes, on_network_only=True)


def _build(node: DataFrame, way: DataFrame, relation: DataFrame, located: DataFrame, on_network_only: bool) -> tuple[DataFrame, DataFrame]:
    relation = stored(relation, "relations")
    tagged = filters.tag_filter(node, "n", ops.NODE_FEATURES)
    facts, devices = ops.relation_ends(relation.filter(F.col("tags")["type"] == "enforcement"), located)
    facts, devices = cut_lineage(facts), cut_lineage(devices)
    spots = tagged.select("id").unionByName(devices.select(F.col("device").alias("id")))
    if on_network_only:
        members = relation.select(F.explode("members").alias("m")).filter("m.type = 'n' and m.role in ('from', 'to')")
        spots = spots.unionByName(members.select(F.col("m.ref").alias("id")))
    bearings = cut_lineage(ops.neighbour_bearings(ops.node_parents(way, spots.distinct()), located))
    if on_network_only:
        touching = (relation.select(F.col("id").alias("rid"), F.explode("members").alias("m"))
                    .filter("m.type = 'n' and m.role in ('device', 'from', 'to')").select("rid", F.col("m.ref").alias("node"))
                    .join(bearings.select("node"), "node", "left_semi").select("rid").distinct())
        touching = stored(touching, "touching")
        off = facts.join(touching, "rid", "left_anti")
        facts = facts.join(touching, "rid", "left_semi")
    nodes = cut_lineage(ops.node_rows(tagged, bearings, on_network_only))
    claims = ops.device_claims(facts, devices)
    rows = ops.canonical_features(ops.enforce(nodes, claims, bearings).unionByName(ops.section_rows(facts)))
    count = F.count(F.lit(1)).alias("n")
    off_road = F.concat(F.lit("dropped_off_road_"), "type").alias("what")
    incomplete = ((F.col("kind") == "average_speed") & (F.col("from").isNull() | F.col("to").isNull())) | (
        (F.col("kind") != "average_speed") & (F.col("devices") == 0) & F.col("from").isNull())
    stats = (nodes.filter("not kept").groupBy(off_road).agg(count)
             .unionByName(nodes.filter("kept and unresolved").agg(count).select(F.lit("direction_unresolved").alias("what"), "n"))
             .unionByName(facts.filter(incomplete).agg(count).select(F.lit("relation_incomplete").alias("what"), "n")))
    if on_network_only:
        stats = stats.unionByName(off.agg(count).select(F.lit("relation_off_network").alias("what"), "n"))
    return rows, stats


def build_bus_lanes(way: DataFrame) -> DataFrame:
    return ops.bus_lanes(way).orderBy("way_id")
