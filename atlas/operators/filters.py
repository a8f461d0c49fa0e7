"""Selecting map objects."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlas.functions import osm, text

# --- fixed values -----------------------------------------------------------------------------
PLACE_KINDS = ("country", "region", "locality", "borough", "neighbourhood", "macrohood")
ROAD_KINDS = ("major_road", "medium_road", "minor_road", "highway")
# ----------------------------------------------------------------------------------------------

BBOX_MARGIN = 0.2


def tag_condition(kind: str, tags: Column, wanted: Sequence[tuple[str, str, Sequence[str]]]) -> Column:
    """Condition for objects of one kind; ``wanted`` holds (kinds, key, values), no values: any."""
    out = F.lit(False)
    for kinds, key, values in wanted:
        if kind in kinds:
            value = tags[key]
            out = out | (F.coalesce(value.isin(*values), F.lit(False)) if values else value.isNotNull())
    return out


def tag_filter(objects: DataFrame, kind: str, wanted) -> DataFrame:
    return objects.filter(tag_condition(kind, F.col("tags"), wanted))


def tag_filter_with_refs(node: DataFrame, way: DataFrame, relation: DataFrame, wanted) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Matching objects plus what they refer to: member relations, their ways and all nodes of these."""
    rels = tag_filter(relation, "r", wanted)
    members = rels.select(F.explode("members").alias("m")).select("m.type", F.col("m.ref").alias("id")).distinct()
    ids = lambda kind: members.filter(F.col("type") == kind).select("id")
    all_rels = rels.select("id").unionByName(ids("r")).distinct()
    way_ids = tag_filter(way, "w", wanted).select("id").unionByName(ids("w")).distinct()
    ways = way.join(way_ids, "id", "left_semi")
    node_ids = (tag_filter(node, "n", wanted).select("id").unionByName(ids("n"))
                .unionByName(ways.select(F.explode("refs").alias("id"))).distinct())
    return node.join(node_ids, "id", "left_semi"), ways, relation.join(all_rels, "id", "left_semi")


def get_by_id(objects: DataFrame, ids: DataFrame) -> DataFrame:
    """Objects whose id is listed; missing ids are tolerated."""
    return objects.join(ids.select("id"), "id", "left_semi")


def get_ways_with_nodes(way: DataFrame, node: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    ways = get_by_id(way, ids)
    return ways, get_by_id(node, ways.select(F.explode("refs").alias("id")).distinct())


def drivable(tags: Column) -> Column:
    return F.coalesce(tags["highway"].isin(*osm.DRIVABLE), F.lit(False))


def arterial(tags: Column) -> Column:
    return F.coalesce(tags["highway"].isin(*osm.ARTERIAL), F.lit(False))


def routable(tags: Column) -> Column:
    """Any road class a car may search through."""
    return F.coalesce((tags["highway"] != "") & ~tags["highway"].isin(*osm.NOT_DRIVABLE), F.lit(False))


def outside_bbox(lat: Column, lon: Column, bbox: Column, margin: float = BBOX_MARGIN) -> Column:
    """``bbox`` is struct(west, south, east, north)."""
    m = F.lit(margin)
    return ~(lat.between(bbox["south"] - m, bbox["north"] + m) & lon.between(bbox["west"] - m, bbox["east"] + m))


def tile_bounds(west: float, south: float, east: float, north: float, zoom: int) -> tuple[int, int, int, int]:
    """Half-open column and row bounds (x0, x1, y0, y1) of a box at one zoom."""
    n = 2 ** zoom
    column = lambda lon: int((lon + 180.0) / 360.0 * n)
    row = lambda lat: int((1.0 - math.asinh(math.tan(math.radians(lat))) / math.pi) / 2.0 * n)
    return max(column(west), 0), min(column(east) + 1, n), max(row(north), 0), min(row(south) + 1, n)


def tile_window(tiles: DataFrame, bbox: tuple[float, float, float, float], zoom: int) -> DataFrame:
    x0, x1, y0, y1 = tile_bounds(*bbox, zoom)
    return tiles.filter((F.col("z") == zoom) & (F.col("x") >= x0) & (F.col("x") < x1) & (F.col("y") >= y0) & (F.col("y") < y1))


def search_row_filter(features: DataFrame) -> DataFrame:
    """Named settlements, named roads, and points of interest with a name or a category."""
    a = F.col("attrs")
    named = F.coalesce(a["name"] != "", F.lit(False))
    keep = (F.when(F.col("layer") == "places", named & F.coalesce(a["kind"].isin(*PLACE_KINDS), F.lit(False)))
            .when(F.col("layer") == "roads", named & F.coalesce(a["kind"].isin(*ROAD_KINDS), F.lit(False)))
            .when(F.col("layer") == "pois", named | text.category_of(a["kind"]).isNotNull()).otherwise(False))
    return features.filter(keep)


def one_way_candidate(tags: Column, length: Column) -> Column:
    return (F.coalesce(tags["oneway"].isin("yes", "1", "true", "-1"), F.lit(False))
            & ~F.coalesce(tags["highway"].isin("motorway", "trunk"), F.lit(False))
            & F.coalesce(tags["name"] != "", F.lit(False)) & length.between(200, 900))


def is_link(tags: Column) -> Column:
    return F.coalesce(tags["highway"].endswith("_link"), F.lit(False))


def is_bridge_deck(tags: Column) -> Column:
    """A bridge above ground level that is not a slip road."""
    raised = ~F.coalesce(tags["layer"], F.lit("0")).isin("0", "-1", "-2")
    return ~is_link(tags) & F.coalesce(tags["bridge"].isin("yes", "viaduct"), F.lit(False)) & raised


def is_ground_road(tags: Column) -> Column:
    blank = lambda k: F.coalesce(tags[k], F.lit("")) == ""
    return ~is_link(tags) & blank("bridge") & blank("tunnel")


def merge_extracts(*extracts: DataFrame) -> DataFrame:
    """Union of extracts with one row per (kind, id); equal ids are equal objects."""
    out = extracts[0]
    for other in extracts[1:]:
        out = out.unionByName(other)
    return out.dropDuplicates(["kind", "id"])
