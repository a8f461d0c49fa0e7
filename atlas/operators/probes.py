"""Probe candidates: one-way streets and grade separations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from atlas.functions import geo
from atlas.operators import filters
from atlas.operators.grid import Grid
from atlas.session import stored

MIN_SEPARATION_M, MAX_SEPARATION_M = 25.0, 80.0
INTERCHANGE_M = 150.0
REQUIRED_RATIO = 5.0
SANE_DETOUR_M = 8000
TOP = 20
PLACED = ("separation", "b_lat", "b_lon", "r_lat", "r_lon")


def closest_to_400m(ways: DataFrame) -> DataFrame:
    """The ordinary one-way street nearest to 400 m long: ``ways(id, tags, length)`` → one row."""
    kept = ways.filter(filters.one_way_candidate(F.col("tags"), F.col("length")))
    best = F.min_by(F.struct("id", F.col("tags")["name"].alias("name"), "length"), F.struct(F.abs(F.col("length") - 400.0), F.col("id")))
    return kept.agg(best.alias("w")).select("w.*").filter("id is not null")


def grade_separation_pairs(ways: DataFrame, vertices: DataFrame) -> DataFrame:
    """Closest ground vertex 25–80 m from a vertex of each bridge, of a road that shares no node and no
    name with it: bridge, road, separation, b_lat, b_lon, r_lat, r_lon.

    ``ways(id, tags)``; ``vertices(way, idx, node, lat, lon)``.

    Many roads may run through one position: each bridge asks a position for its lowest road of another name, and only where
    that road shares a node with the bridge are the position's roads walked further.
    """
    tags = F.col("tags")
    name = F.nullif(tags["name"], F.lit("")).alias("name")
    kinds = ways.select(F.col("id").alias("way"), F.coalesce(filters.is_bridge_deck(tags), F.lit(False)).alias("deck"),
                        F.coalesce(filters.is_ground_road(tags), F.lit(False)).alias("ground"), name).filter("deck or ground")
    placed = stored(vertices.select("way", "node", "lat", "lon").join(kinds, "way"), "placed")
    b = placed.filter("deck").select(F.col("way").alias("bridge"), F.col("name").alias("b_name"), "node", F.col("lat").alias("b_lat"), F.col("lon").alias("b_lon"))
    r = placed.filter("ground").select(F.col("way").alias("road"), F.col("name").alias("r_name"), "node", F.col("lat").alias("r_lat"), F.col("lon").alias("r_lon"))
    spots = stored(_near_spots(b, _lowest_roads(r)), "spots")
    asked = b.select("bridge", "b_name", "b_lat", "b_lon").distinct().join(spots, ["b_lat", "b_lon"])
    same = F.coalesce(F.col("b_name") == F.col("first_name"), F.lit(False))
    first = stored(asked.withColumn("road", F.when(same, F.col("other")).otherwise(F.col("first"))).filter("road is not null")
                   .select("bridge", "b_name", "road", *PLACED), "asked")
    pair = ["bridge", "road"]
    crossing = b.select("bridge", "node").distinct()
    shared = first.select(*pair).distinct().join(crossing, "bridge").join(r.select("road", "node").distinct(), ["road", "node"], "left_semi").select(*pair).distinct()
    shared = stored(shared, "shared")
    apart = first.join(shared, pair, "left_anti").select("bridge", "road", *PLACED)
    again = first.join(shared, pair, "left_semi").drop("road")
    further = _walked(again, r, crossing)
    spot = F.struct("separation", "road", "b_lat", "b_lon", "r_lat", "r_lon")
    best = apart.unionByName(further).groupBy("bridge").agg(F.min(spot).alias("m"))
    return best.select("bridge", "m.road", "m.separation", "m.b_lat", "m.b_lon", "m.r_lat", "m.r_lon")


def _lowest_roads(r: DataFrame) -> DataFrame:
    """Per position its lowest road, and the lowest one of another name where that is needed: r_lat, r_lon, first, first_name, other."""
    at = ["r_lat", "r_lon"]
    names = r.groupBy(*at, "r_name").agg(F.min("road").alias("road"))
    first = names.groupBy(*at).agg(F.min_by(F.struct(F.col("road").alias("first"), F.col("r_name").alias("first_name")), F.struct("road", "r_name")).alias("f")).select(*at, "f.*")
    differs = ~F.col("r_name").eqNullSafe(F.col("first_name"))
    other = names.join(first, at).filter(differs).groupBy(*at).agg(F.min("road").alias("other"))
    return first.join(other, at, "left")


def _near_spots(b: DataFrame, roads: DataFrame) -> DataFrame:
    """Positions of bridges with the positions of roads that are 25–80 m away."""
    grid = Grid(MAX_SEPARATION_M * 1.02)
    left = b.select("b_lat", "b_lon").distinct().withColumn("cell", F.explode(grid.around(F.col("b_lat"), F.col("b_lon"))))
    right = roads.withColumn("cell", grid.cell(F.col("r_lat"), F.col("r_lon")))
    d = geo.probe_metres(F.col("b_lat"), F.col("b_lon"), F.col("r_lat"), F.col("r_lon"))
    return left.join(right, "cell").drop("cell").withColumn("separation", d).filter(F.col("separation").between(MIN_SEPARATION_M, MAX_SEPARATION_M))


def _walked(asked: DataFrame, r: DataFrame, crossing: DataFrame) -> DataFrame:
    """``asked(bridge, b_name, PLACED…)`` with the lowest road at (r_lat, r_lon) that has another name and no node of the bridge.

    Roads of a position are numbered. The one wanted is the first of another name after some shared road (or from the
    start), so only these are looked up, by equi-joins; a position's roads are never paired with each other.
    """
    at = ["r_lat", "r_lon"]
    line = Window.partitionBy(*at).orderBy("road", "r_name")
    roads = r.select(*at, "road", "r_name").distinct().join(asked.select(*at).distinct(), at, "left_semi")
    roads = roads.withColumn("place", F.row_number().over(line)).withColumn("before", F.lag("r_name").over(line))
    begins = F.when((F.col("place") == 1) | ~F.col("r_name").eqNullSafe(F.col("before")), F.struct("place", "road"))
    back = Window.partitionBy(*at).orderBy(F.desc("place")).rowsBetween(Window.unboundedPreceding, -1)
    roads = stored(roads.withColumn("turn", F.min(begins).over(back)).select(*at, "road", "r_name", "place", F.col("turn.road").alias("turn")), "roads")
    bridges = asked.select("bridge").distinct()
    shared = stored(crossing.join(bridges, "bridge", "left_semi").join(r.select("road", "node").distinct(), "node").select("bridge", "road").distinct(), "sharing")
    wanted = asked.select("bridge", "b_name", *at).distinct()
    shared_here = wanted.select("bridge", *at).distinct().join(shared, "bridge").join(roads.select(*at, "road", "place"), [*at, "road"])
    after = wanted.select("bridge", *at).distinct().withColumn("place", F.lit(1)).unionByName(shared_here.select("bridge", *at, (F.col("place") + 1).alias("place")))
    same = F.coalesce(F.col("b_name") == F.col("r_name"), F.lit(False))
    tried = (wanted.join(after, ["bridge", *at]).join(roads, [*at, "place"])
             .withColumn("road", F.when(same, F.col("turn")).otherwise(F.col("road"))).filter("road is not null"))
    left = tried.join(shared, ["bridge", "road"], "left_anti").groupBy("bridge", "b_name", *at).agg(F.min("road").alias("road")).alias("w")
    a = asked.alias("a")
    on = (F.col("a.bridge") == F.col("w.bridge")) & F.col("a.b_name").eqNullSafe(F.col("w.b_name")) & (F.col("a.r_lat") == F.col("w.r_lat")) & (F.col("a.r_lon") == F.col("w.r_lon"))
    return a.join(left, on).select("a.bridge", "w.road", *[F.col(f"a.{c}") for c in PLACED])


def interchange_exclusion(pairs: DataFrame, ways: DataFrame, vertices: DataFrame) -> DataFrame:
    """Drop pairs with a slip-road vertex within 150 m of the bridge vertex."""
    links = ways.filter(filters.is_link(F.col("tags"))).select(F.col("id").alias("way"))
    ramps = vertices.join(links, "way", "left_semi").select("lat", "lon").distinct()
    grid = Grid(INTERCHANGE_M * 1.02)
    p = pairs.withColumn("cell", grid.cell(F.col("b_lat"), F.col("b_lon"))).alias("p")
    q = ramps.withColumn("cell", F.explode(grid.around(F.col("lat"), F.col("lon")))).alias("q")
    close = geo.probe_metres(F.col("p.b_lat"), F.col("p.b_lon"), F.col("q.lat"), F.col("q.lon")) <= INTERCHANGE_M
    return p.join(q, (F.col("p.cell") == F.col("q.cell")) & close, "left_anti").drop("cell")


def bridge_top(pairs: DataFrame, limit: int = TOP) -> DataFrame:
    """Widest whole-metre separations first; ties by bridge id."""
    whole = F.bround("separation").cast("int")
    return pairs.withColumn("separation_m", whole).orderBy(F.desc("separation_m"), "bridge").limit(limit)


def candidate_rank(candidates: DataFrame) -> DataFrame:
    """``(bridge, separation_m, driven_m)`` → verdict and detour ratio; usable ones by ratio."""
    ratio = F.col("driven_m") / F.col("separation_m")
    verdict = (F.when(F.col("driven_m").isNull(), "no route").when(F.col("driven_m") > SANE_DETOUR_M, "implausibly far")
               .when(ratio < REQUIRED_RATIO, "connected nearby").otherwise("usable"))
    return candidates.withColumn("ratio", ratio).withColumn("verdict", verdict).orderBy(
        (F.col("verdict") != "usable"), F.desc_nulls_last("ratio"), "bridge")
