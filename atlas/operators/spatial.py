"""Point-in-polygon as cell-key equi-joins, and what is built on it.

An area is ``(pid, rings)`` with ``rings`` an array of rings of ``struct(x, y)``: outer rings, holes and
parts alike, judged even-odd. Or it is vertex rows ``(pid, ring, ord, x, y)``, ``ord`` from 0 without gaps: then no task
ever holds a ring, and sizes, middles, boxes and segments are partial sums and equi-joins. Every function takes both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlas.functions import geo
from atlas.session import cut_lineage

BAND = 0.002
SPLIT = 8
EDGE_SLACK = 1e-9


def vertex_rows(areas: DataFrame) -> DataFrame:
    """(pid, ring, ord, x, y) of areas in either form."""
    if "rings" not in areas.columns:
        return areas.select("pid", "ring", "ord", "x", "y")
    rings = areas.select("pid", F.posexplode("rings").alias("ring", "v"))
    return rings.select("pid", "ring", F.posexplode("v").alias("ord", "v")).select("pid", "ring", "ord", "v.x", "v.y")


def segments(areas: DataFrame) -> DataFrame:
    """One row per ring segment, the closing one included: pid, xj, yj → xi, yi."""
    if "rings" not in areas.columns:
        return joined_segments(areas).select("pid", "xj", "yj", "xi", "yi")
    ring = F.col("ring")
    previous = F.concat(F.slice(ring, -1, 1), F.slice(ring, 1, F.size(ring) - 1))
    pairs = F.zip_with(previous, ring, lambda j, i: F.struct(
        j["x"].alias("xj"), j["y"].alias("yj"), i["x"].alias("xi"), i["y"].alias("yi")))
    rings = areas.select("pid", F.explode("rings").alias("ring")).filter(F.size("ring") > 0)
    return rings.select("pid", F.inline(pairs))


def joined_segments(vertices: DataFrame) -> DataFrame:
    """(pid, ring, ord, xj, yj, xi, yi): each vertex with the one before it, the first with the last, by an equi-join on its number."""
    key = ["pid", "ring"]
    sizes = vertices.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    after = vertices.join(sizes, key).select(*key, F.pmod(F.col("ord") + 1, F.col("n")).alias("ord"), F.col("x").alias("xj"), F.col("y").alias("yj"))
    return after.join(vertices.select(*key, F.col("ord").cast("bigint").alias("ord"), F.col("x").alias("xi"), F.col("y").alias("yi")), [*key, "ord"])


def area_sizes(areas: DataFrame) -> DataFrame:
    """(pid, size): the sum of the absolute shoelace areas of the rings."""
    if "rings" in areas.columns:
        return areas.select("pid", geo.ring_area(F.col("rings")).alias("size"))
    cross = F.col("xj") * F.col("yi") - F.col("xi") * F.col("yj")
    rings = joined_segments(areas).filter("ord > 0").groupBy("pid", "ring").agg((F.abs(F.sum(cross)) / 2).alias("size"))
    return areas.select("pid").distinct().join(rings.groupBy("pid").agg(F.sum("size").alias("size")), "pid", "left").select("pid", F.coalesce("size", F.lit(0.0)).alias("size"))


def area_middles(areas: DataFrame) -> DataFrame:
    """(pid, x, y): the mean of the vertices of the first ring, the closing vertex included."""
    first = vertex_rows(areas).filter("ring = 0")
    return first.groupBy("pid").agg(F.avg("x").alias("x"), F.avg("y").alias("y"))


def band_segments(segs: DataFrame) -> DataFrame:
    """Segments keyed by the latitude bands they span; horizontal ones never count."""
    low = F.floor(F.least("yi", "yj") / F.lit(BAND))
    high = F.floor(F.greatest("yi", "yj") / F.lit(BAND))
    return segs.filter("yi <> yj").withColumn("band", F.explode(F.sequence(low, high)))


def crosses(x: Column, y: Column, s: str) -> Column:
    """Does the ray from (x, y) to the east cross the segment?"""
    xi, yi, xj, yj = (F.col(f"{s}.{c}") for c in ("xi", "yi", "xj", "yj"))
    return ((yi > y) != (yj > y)) & (x < (xj - xi) * F.try_divide(y - yi, yj - yi) + xi)


def parity_inside(candidates: DataFrame, bands: DataFrame, key: list[str]) -> DataFrame:
    """Keep the candidates (key…, pid, x, y) inside their own area.

    Join on (pid, band); only true crossings leave the join, and their parity decides.
    """
    c = candidates.withColumn("band", F.floor(F.col("y") / F.lit(BAND))).alias("c")
    s = bands.alias("s")
    hit = ((F.col("c.pid") == F.col("s.pid")) & (F.col("c.band") == F.col("s.band"))
           & crosses(F.col("c.x"), F.col("c.y"), "s"))
    keys = [*key, "pid"]
    return (c.join(s, hit).groupBy(*[F.col(f"c.{k}") for k in keys])
            .agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") % 2 == 1).select(*keys))


def edge_cells(segs: DataFrame, cell: float) -> DataFrame:
    """Cells (pid, cx, cy) touched by a boundary: per row of cells the x-range of the segment there."""
    c = F.lit(cell)
    slack = F.lit(EDGE_SLACK)
    rows = segs.withColumn("cy", F.explode(F.sequence(
        F.floor((F.least("yi", "yj") - slack) / c), F.floor((F.greatest("yi", "yj") + slack) / c))))
    dy = F.col("yi") - F.col("yj")

    def x_at(y: Column) -> Column:
        y = F.least(F.greatest(y, F.least("yi", "yj")), F.greatest("yi", "yj"))
        return F.col("xj") + (F.col("xi") - F.col("xj")) * F.try_divide(y - F.col("yj"), dy)

    bottom, top = x_at(F.col("cy") * c), x_at((F.col("cy") + 1) * c)
    left = F.when(dy == 0, F.least("xi", "xj")).otherwise(F.least(bottom, top)) - slack
    right = F.when(dy == 0, F.greatest("xi", "xj")).otherwise(F.greatest(bottom, top)) + slack
    return rows.select("pid", F.explode(F.sequence(F.floor(left / c), F.floor(right / c))).alias("cx"),
                       "cy").distinct()


def cell_index(areas: DataFrame, cell: float) -> DataFrame:
    """Two-level index: (pid, level, cx, cy, full). A full cell answers by itself; level-1 cells are
    ``SPLIT`` times finer and exist only inside level-0 boundary cells, so the index grows with the
    length of the boundary, not with the area."""
    segs = segments(areas)
    bands = band_segments(segs)
    fine = cell / SPLIT
    box = segs.groupBy("pid").agg(F.min("xi").alias("x0"), F.max("xi").alias("x1"),
                                  F.min("yi").alias("y0"), F.max("yi").alias("y1"))
    span = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / F.lit(cell)), F.floor(F.col(b) / F.lit(cell))))
    coarse = box.withColumn("cx", span("x0", "x1")).withColumn("cy", span("y0", "y1")).select("pid", "cx", "cy")
    coarse_edge = edge_cells(segs, cell)
    child = lambda c: F.explode(F.sequence(F.col(c) * SPLIT, F.col(c) * SPLIT + (SPLIT - 1)))
    children = (coarse_edge.withColumn("fx", child("cx")).withColumn("fy", child("cy"))
                .select("pid", F.col("fx").alias("cx"), F.col("fy").alias("cy")))
    key = ["pid", "cx", "cy"]
    fine_edge = edge_cells(segs, fine).join(children, key, "left_semi")
    open_cells = (coarse.join(coarse_edge, key, "left_anti").withColumn("level", F.lit(0)).unionByName(
        children.join(fine_edge, key, "left_anti").withColumn("level", F.lit(1))))
    size = F.when(F.col("level") == 0, F.lit(cell)).otherwise(F.lit(fine))
    centres = (open_cells.withColumn("x", (F.col("cx") + 0.5) * size)
               .withColumn("y", (F.col("cy") + 0.5) * size))
    full = parity_inside(centres, bands, ["level", "cx", "cy"]).withColumn("full", F.lit(True))
    return full.unionByName(fine_edge.withColumn("level", F.lit(1)).withColumn("full", F.lit(False)))


def box_index(areas: DataFrame, cell: float) -> DataFrame:
    """(pid, cx, cy): the cells of each bounding box. Cheap to build, every candidate is tested."""
    box = bbox_union(segments(areas), ["pid"], "xi", "yi")
    span = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / F.lit(cell)), F.floor(F.col(b) / F.lit(cell))))
    return box.withColumn("cx", span("west", "east")).withColumn("cy", span("south", "north"))


def point_in_boxed_polygon(points: DataFrame, areas: DataFrame, cell: float = 1.0, key: str = "point") -> DataFrame:
    """As ``point_in_polygon``, for few points (one per place, not per house): bounding boxes, then the exact
    test for every candidate."""
    placed = points.select(key, F.col("lon").alias("x"), F.col("lat").alias("y"),
                           F.floor(F.col("lon") / F.lit(cell)).alias("cx"), F.floor(F.col("lat") / F.lit(cell)).alias("cy"))
    near = placed.join(box_index(areas, cell), ["cx", "cy"]).filter(
        F.col("x").between(F.col("west"), F.col("east")) & F.col("y").between(F.col("south"), F.col("north")))
    return parity_inside(near.select(key, "pid", "x", "y"), band_segments(segments(areas)), [key])


def point_in_polygon(points: DataFrame, areas: DataFrame, cell: float = 1.0,
                     key: str = "point") -> DataFrame:
    """All (point, pid) pairs with the point inside the area. ``points`` has ``key``, ``lat``, ``lon``."""
    fine = cell / SPLIT
    slot = lambda level, size: F.struct(
        F.lit(level).alias("level"), F.floor(F.col("lon") / F.lit(size)).alias("cx"),
        F.floor(F.col("lat") / F.lit(size)).alias("cy"))
    placed = (points.select(key, F.col("lon").alias("x"), F.col("lat").alias("y"),
                            F.explode(F.array(slot(0, cell), slot(1, fine))).alias("_c"))
              .select(key, "x", "y", "_c.*"))
    index = cut_lineage(cell_index(areas, cell))
    at = ["level", "cx", "cy"]
    sure = placed.join(index.filter("full"), at).select(key, "pid")
    unsure = placed.join(index.filter("not full"), at).select(key, "pid", "x", "y")
    return sure.unionByName(parity_inside(unsure, band_segments(segments(areas)), [key]))


def _hits(points: DataFrame, areas: DataFrame, cell: float, key: str, boxed: bool = False) -> DataFrame:
    """(_key, pid) pairs; the point key may itself be called pid."""
    placed = points.select(F.col(key).alias("_key"), "lat", "lon")
    return (point_in_boxed_polygon if boxed else point_in_polygon)(placed, areas, cell, "_key")


def country_cut(points: DataFrame, country: DataFrame, cell: float = 0.05, key: str = "point") -> DataFrame:
    """Points inside the country's own area."""
    inside = _hits(points, country, cell, key).select(F.col("_key").alias(key)).distinct()
    return points.join(inside, key, "left_semi")


def assign_admin(points: DataFrame, areas: DataFrame, key: str = "point") -> DataFrame:
    """Each point with the lowest ``pid`` that contains it, or NULL."""
    lowest = _hits(points, areas, 1.0, key, boxed=True).groupBy(F.col("_key").alias(key)).agg(F.min("pid").alias("admin"))
    return points.join(lowest, key, "left")


def smallest_area(points: DataFrame, areas: DataFrame, cell: float, key: str = "point") -> DataFrame:
    """Each contained point with its smallest area, ties by the lowest id: key, area."""
    hits = _hits(points, areas, cell, key).join(area_sizes(areas), "pid")
    return hits.groupBy(F.col("_key").alias(key)).agg(F.min_by("pid", F.struct("size", "pid")).alias("area"))


def landmass_of(points: DataFrame, rings: DataFrame, key: str = "point") -> DataFrame:
    """Smallest closed coastline ring around each point: key, landmass (NULL: unknown)."""
    best = smallest_area(points, rings, 0.05, key).withColumnRenamed("area", "landmass")
    return points.join(best, key, "left")


def same_landmass(a: Column, b: Column) -> Column:
    """Only two known and different landmasses are different."""
    return F.coalesce(a == b, F.lit(True))


def bbox_union(df: DataFrame, keys: list[str], x: str = "x", y: str = "y") -> DataFrame:
    return df.groupBy(*keys).agg(F.min(x).alias("west"), F.min(y).alias("south"),
                                 F.max(x).alias("east"), F.max(y).alias("north"))


def polygon_overlap(areas: DataFrame, cell: float = 1.0) -> DataFrame:
    """Pairs a < b of areas with a vertex of one inside the other, and the bounds of those vertices."""
    vertices = (vertex_rows(areas).select(F.col("pid").alias("owner"), F.col("x").alias("lon"), F.col("y").alias("lat")).distinct()
                .withColumn("point", F.struct("owner", "lon", "lat")))
    hits = point_in_boxed_polygon(vertices, areas, cell).filter(F.col("pid") != F.col("point.owner"))
    pair = hits.select(F.least("pid", "point.owner").alias("a"), F.greatest("pid", "point.owner").alias("b"),
                       F.col("point.lon").alias("x"), F.col("point.lat").alias("y"))
    return bbox_union(pair, ["a", "b"])


def tile_to_country(tiles: DataFrame, areas: DataFrame) -> DataFrame:
    """(level, tile_id, country): one of nine sample points of the tile lies in the country, or a
    vertex of the country lies in the tile (closed box)."""
    box = geo.tile_bbox(F.col("level"), F.col("tile_id"))
    boxed = tiles.select("level", "tile_id").distinct().withColumn("b", box)
    mid_x, mid_y = (F.col("b.west") + F.col("b.east")) / 2, (F.col("b.south") + F.col("b.north")) / 2
    spots = F.array(*[F.struct(x.alias("lon"), y.alias("lat"))
                      for x in (F.col("b.west"), mid_x, F.col("b.east"))
                      for y in (F.col("b.south"), mid_y, F.col("b.north"))])
    samples = (boxed.select("level", "tile_id", F.explode(spots).alias("s"))
               .select("s.lon", "s.lat", F.struct("level", "tile_id", "s").alias("point")))
    by_sample = point_in_polygon(samples, areas, 1.0).select("point.level", "point.tile_id", F.col("pid").alias("country"))
    size = geo.by_level(F.col("level"), geo.TILE_DEGREES)
    vertices = vertex_rows(areas).select(F.col("pid").alias("country"), "x", "y").distinct()
    # a vertex on a shared border belongs to the tiles of both sides
    col0, col1 = F.ceil((F.col("x") + 180.0) / size) - 1, F.floor((F.col("x") + 180.0) / size)
    row0, row1 = F.ceil((F.col("y") + 90.0) / size) - 1, F.floor((F.col("y") + 90.0) / size)
    by_vertex = (vertices.withColumn("level", F.explode(F.array(*[F.lit(k) for k in geo.TILE_DEGREES])))
                 .withColumn("col", F.explode(F.sequence(col0, col1))).withColumn("row", F.explode(F.sequence(row0, row1)))
                 .withColumn("tile_id", (F.col("row") * (F.lit(360.0) / size).cast("bigint") + F.col("col")).cast("bigint"))
                 .select("level", "tile_id", "country").distinct()
                 .join(boxed.select("level", "tile_id"), ["level", "tile_id"], "left_semi"))
    return by_sample.unionByName(by_vertex).distinct()
