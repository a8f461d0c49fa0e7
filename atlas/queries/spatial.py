"""Spatial and border-matching operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from atlas.functions import geo
from atlas.operators import matching, spatial
from atlas.queries import views  # noqa: F401
from atlas.queries.base import query, view
from atlas.queries.sqltext import crossing, haversine, km, portal_distance

c = F.col

INSIDE = f"""inside AS (SELECT p.point, s.pid FROM pt p, poly_seg s WHERE s.xj IS NOT NULL AND {crossing('p.lon', 'p.lat', 's')}
    GROUP BY p.point, s.pid HAVING count(*) % 2 = 1)"""
AREA_SIZE = """sized AS (SELECT pid, sum(abs(a)) / 2 AS area FROM (SELECT pid, ring, sum(xj * yi - xi * yj) AS a FROM poly_seg WHERE xj IS NOT NULL GROUP BY pid, ring) GROUP BY pid)"""


@query("j07_point_in_polygon", f"WITH {INSIDE} SELECT point, pid FROM inside")
def j07(t):
    return spatial.point_in_polygon(t.pt, t.area, 0.5)


@query("f05_country_cut", f"WITH {INSIDE} SELECT point, name, pop FROM pt WHERE point IN (SELECT point FROM inside WHERE pid < 12)")
def f05(t):
    return spatial.country_cut(t.pt, t.area.filter("pid < 12"), 0.4).select("point", "name", "pop")


@query("j08_assign_admin", f"WITH {INSIDE} SELECT pt.point, min(pid) AS admin FROM pt LEFT JOIN inside ON inside.point = pt.point GROUP BY pt.point")
def j08(t):
    return spatial.assign_admin(t.pt.select("point", "lat", "lon"), t.area).select("point", "admin")


@query("j05_by_area", f"""WITH {INSIDE}, {AREA_SIZE} SELECT point, pid FROM (
    SELECT point, pid, row_number() OVER (PARTITION BY point ORDER BY area, pid) AS rn FROM inside JOIN sized USING (pid)) WHERE rn = 1""")
def j05(t):
    return spatial.smallest_area(t.pt, t.area, 0.25).withColumnRenamed("area", "pid")


# a landmass is the L-shaped area read as a ring: three of four points of a 2-degree square are inside some
@query("j11_landmass", f"""WITH {INSIDE}, {AREA_SIZE}, lm AS (SELECT point, min(pid) FILTER (WHERE rn = 1) AS landmass FROM (
      SELECT point, pid, row_number() OVER (PARTITION BY point ORDER BY area, pid) AS rn FROM inside JOIN sized USING (pid)) GROUP BY point)
    SELECT a.point, lm.landmass, lm.landmass IS NULL OR b.landmass IS NULL OR lm.landmass = b.landmass AS same
    FROM pt a LEFT JOIN lm ON lm.point = a.point LEFT JOIN lm b ON b.point = a.point + 1""")
def j11(t):
    land = spatial.landmass_of(t.pt.select("point", "lat", "lon"), t.poly_vertex)
    other = land.select((c("point") - 1).alias("point"), c("landmass").alias("next"))
    return land.join(other, "point", "left").select("point", "landmass", spatial.same_landmass(c("landmass"), c("next")).alias("same"))


NEAR = f"""d AS (SELECT p.point, l.site, l.kind_rank, {km('p.lat', 'p.lon', 'l.lat', 'l.lon')} AS km FROM pt p, loc l)"""


@query("j06_nearest_locality", f"""WITH {INSIDE}, {AREA_SIZE},
    li2 AS (SELECT l.site, s.pid FROM loc l, poly_seg s WHERE s.xj IS NOT NULL AND {crossing('l.lon', 'l.lat', 's')} GROUP BY l.site, s.pid HAVING count(*) % 2 = 1),
    lmp AS (SELECT point, arg_min(pid, area) AS lm FROM inside JOIN sized USING (pid) GROUP BY point),
    lml AS (SELECT site, arg_min(pid, area) AS lm FROM li2 JOIN sized USING (pid) GROUP BY site),
    {NEAR}, ok AS (SELECT d.*, row_number() OVER (PARTITION BY d.point ORDER BY km, kind_rank, d.site) AS rn FROM d LEFT JOIN lmp ON lmp.point = d.point LEFT JOIN lml ON lml.site = d.site
      WHERE km <= 15 OR (km < 30 AND (lmp.lm IS NULL OR lml.lm IS NULL OR lmp.lm = lml.lm)))
    SELECT pt.point, site, round(km, 7) AS km FROM pt LEFT JOIN ok ON ok.point = pt.point AND rn = 1""")
def j06(t):
    from atlas.operators.address import nearest_locality
    sites = t.loc.select("site", "lat", "lon", "kind_rank")
    found = nearest_locality(t.pt.select("point", "lat", "lon"), sites, t.area)
    return found.select("point", "site", F.round("km", 7).alias("km"))



def match_sql(a: str, b: str) -> str:
    """Brute-force twin of the matching rule between two row sets (r, level, lat_e7, lon_e7, osm, p)."""
    d = haversine("x.lat_e7 / 1e7", "x.lon_e7 / 1e7", "y.lat_e7 / 1e7", "y.lon_e7 / 1e7")
    dist = portal_distance("x", "y")
    return f"""
    A AS ({a}), B AS ({b}),
    ida AS (SELECT p, osm, level, count(*) AS n, min(r) AS r FROM A WHERE osm IS NOT NULL GROUP BY ALL),
    idb AS (SELECT p, osm, level, count(*) AS n, min(r) AS r FROM B WHERE osm IS NOT NULL GROUP BY ALL),
    idj AS (SELECT x.p, x.n AS na, y.n AS nb, x.r AS ra, y.r AS rb FROM ida x JOIN idb y ON x.p = y.p AND x.osm = y.osm AND x.level = y.level),
    m1 AS (SELECT p, ra, rb FROM idj WHERE na = 1 AND nb = 1),
    A2 AS (SELECT * FROM A ANTI JOIN m1 ON m1.p = A.p AND m1.ra = A.r), B2 AS (SELECT * FROM B ANTI JOIN m1 ON m1.p = B.p AND m1.rb = B.r),
    ca AS (SELECT p, level, lat_e7, lon_e7, count(*) AS n, min(r) AS r FROM A2 GROUP BY ALL), cb AS (SELECT p, level, lat_e7, lon_e7, count(*) AS n, min(r) AS r FROM B2 GROUP BY ALL),
    m2 AS (SELECT x.p, x.r AS ra, y.r AS rb FROM ca x JOIN cb y ON x.p = y.p AND x.level = y.level AND x.lat_e7 = y.lat_e7 AND x.lon_e7 = y.lon_e7 WHERE x.n = 1 AND y.n = 1),
    A3 AS (SELECT * FROM A2 ANTI JOIN m2 ON m2.p = A2.p AND m2.ra = A2.r), B3 AS (SELECT * FROM B2 ANTI JOIN m2 ON m2.p = B2.p AND m2.rb = B2.r),
    nr AS (SELECT x.p, x.r AS ra, y.r AS rb FROM A3 x JOIN B3 y ON x.p = y.p AND x.level = y.level AND abs(x.lat_e7 - y.lat_e7) < 500 AND {d} <= 5),
    na AS (SELECT p, ra, count(*) AS n, min(rb) AS rb FROM nr GROUP BY ALL), nb AS (SELECT p, rb, count(*) AS n FROM nr GROUP BY ALL),
    nj AS (SELECT na.p, ra, na.rb, na.n AS x, nb.n AS y FROM na JOIN nb ON nb.p = na.p AND nb.rb = na.rb),
    m3 AS (SELECT p, ra, rb FROM nj WHERE x = 1 AND y = 1),
    pairs AS (SELECT m.p, m.ra, m.rb, m.method, {dist} AS distance, x.lat_e7, x.lon_e7 FROM (
        SELECT *, 'osm' AS method FROM m1 UNION ALL SELECT *, 'coord' FROM m2 UNION ALL SELECT *, 'near' FROM m3) m
      JOIN A x ON x.p = m.p AND x.r = m.ra JOIN B y ON y.p = m.p AND y.r = m.rb),
    stats AS (SELECT p, CAST(sum(o) AS BIGINT) AS osm, CAST(sum(c) AS BIGINT) AS coord, CAST(sum(n) AS BIGINT) AS near, CAST(sum(am) AS BIGINT) AS ambiguous,
        CAST(sum(a) - sum(o + c + n) AS BIGINT) AS unmatched_a, CAST(sum(b) - sum(o + c + n) AS BIGINT) AS unmatched_b FROM (
      SELECT p, CAST(method = 'osm' AS INT) AS o, CAST(method = 'coord' AS INT) AS c, CAST(method = 'near' AS INT) AS n, 0 AS am, 0 AS a, 0 AS b FROM pairs
      UNION ALL SELECT p, 0, 0, 0, na, 0, 0 FROM idj WHERE NOT (na = 1 AND nb = 1)
      UNION ALL SELECT p, 0, 0, 0, 1, 0, 0 FROM nj WHERE NOT (x = 1 AND y = 1)
      UNION ALL SELECT p, 0, 0, 0, 0, 1, 0 FROM A UNION ALL SELECT p, 0, 0, 0, 0, 0, 1 FROM B) GROUP BY p)"""


ALL_PAIRS = match_sql("SELECT f.country || '-' || o.country AS p, local_id AS r, f.* FROM fr f JOIN (SELECT DISTINCT country FROM fr) o ON f.country < o.country",
                      "SELECT o.country || '-' || f.country AS p, local_id AS r, f.* FROM fr f JOIN (SELECT DISTINCT country FROM fr) o ON o.country < f.country")


def matched(t):
    """Every pair of countries, those without a common border too."""
    all_ = t.fr_country.agg(F.collect_set("country").alias("all"))   # 255 at most
    borders = all_.select(F.explode("all").alias("a"), "all").select("a", F.explode("all").alias("b")).filter("a < b")
    return matching.match_frontiers(*matching.neighbour_sides(t.fr, borders))


@query("j12_match_frontiers", f"WITH {ALL_PAIRS} SELECT p AS pair, ra AS a_row, rb AS b_row, method, distance FROM pairs")
def j12(t):
    pairs, _ = matched(t)
    return pairs.select("pair", "a_row", "b_row", "method", "distance")


@query("a16_pair_stats", f"WITH {ALL_PAIRS} SELECT p AS pair, osm, coord, near, ambiguous, unmatched_a, unmatched_b FROM stats")
def a16(t):
    _, stats = matched(t)
    return stats


@query("j13_all_pairs", f"WITH {ALL_PAIRS} SELECT p, osm, coord, near, ambiguous, unmatched_a, unmatched_b FROM stats WHERE osm + coord + near + ambiguous > 0")
def j13(t):
    _, busy = matching.all_pairs(t.fr)
    return busy.withColumnRenamed("pair", "p")


def regions(t):
    return t.fr_country.withColumn("region_id", F.substring("country", 2, 9).cast("int"))


PORTALS = f"""{ALL_PAIRS}, gids AS (SELECT (CAST(substr(p, 2, 1) AS BIGINT) << 46) | ra AS ga, (CAST(substr(p, 5, 1) AS BIGINT) << 46) | rb AS gb, distance, lat_e7, lon_e7 FROM pairs),
    portals AS (SELECT ga AS from_id, gb AS to_id, distance, lat_e7, lon_e7 FROM gids UNION ALL SELECT gb, ga, distance, lat_e7, lon_e7 FROM gids)"""


@query("u03_both_directions", f"WITH {PORTALS} SELECT * FROM portals")
def u03(t):
    pairs, _ = matching.all_pairs(t.fr)
    return matching.portal_table(pairs, regions(t))


@query("k04_portal_lines", f"""WITH {PORTALS} SELECT CAST(from_id AS VARCHAR) || ' ' || CAST(to_id AS VARCHAR) || ' ' || CASE WHEN distance = 0 THEN '0' ELSE printf('%.2f', distance) END
    || printf('   # %.7f, %.7f', lat_e7 / 1e7, lon_e7 / 1e7) AS line FROM portals""")
def k04(t):
    pairs, _ = matching.all_pairs(t.fr)
    table = matching.portal_table(pairs, regions(t))
    return table.select(matching.portal_line(*[c(x) for x in ("from_id", "to_id", "distance", "lat_e7", "lon_e7")]).alias("line"))


view("graph_node", """SELECT p_partkey AS id, CASE WHEN p_partkey % 29 = 0 THEN '' ELSE 'N' || CAST(p_size % 4 AS STRING) END AS country,
    CAST(470000000 + (p_partkey * 7919 % 3000) * 40 AS INT) AS lat_e7, CAST(280000000 + (p_partkey * 104729 % 3000) * 60 AS INT) AS lon_e7, CAST(p_partkey % 3 AS INT) AS level,
    CASE WHEN p_partkey % 6 = 0 THEN p_partkey END AS tile_osm FROM part""")
view("graph_edge", """SELECT l_orderkey AS way_id, l_linenumber AS seq, node_id AS from_id, next_id AS to_id, l_orderkey % 10 = 0 AS shortcut, l_orderkey % 3 <> 0 AS auto_access
    FROM (SELECT l_orderkey, l_linenumber, l_partkey AS node_id, lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS next_id FROM li) WHERE next_id IS NOT NULL""")

EXTRACT = """border AS (SELECT f.id, f.country, string_agg(DISTINCT t2.country, ',' ORDER BY t2.country) AS neighbours, count(*) AS edges, min(way_id) AS first_way
    FROM graph_edge e JOIN graph_node f ON f.id = e.from_id JOIN graph_node t2 ON t2.id = e.to_id
    WHERE auto_access AND NOT shortcut AND f.country <> '' AND t2.country <> '' AND f.country <> t2.country GROUP BY f.id, f.country)"""


@query("j15_frontier_extract", f"WITH {EXTRACT} SELECT * FROM border")
def j15(t):
    return matching.frontier_extract(t.graph_node, t.graph_edge).withColumn("neighbours", F.array_join("neighbours", ","))


view("road_node", "SELECT DISTINCT p_partkey - p_partkey % 4 * 3 AS id, CAST(470000000 + (p_partkey * 7919 % 3000) * 40 AS INT) AS lat_e7, CAST(280000000 + (p_partkey * 104729 % 3000) * 60 AS INT) AS lon_e7 FROM part WHERE p_size % 5 <> 0")

NAMED = """spot AS (SELECT lat_e7, lon_e7, count(DISTINCT id) AS n, min(id) AS id FROM road_node GROUP BY ALL),
    named AS (SELECT g.id, g.country, g.level, g.lat_e7, g.lon_e7, CASE WHEN tile_osm IS NOT NULL THEN 'tile' WHEN n IS NULL THEN 'absent' WHEN n = 1 THEN 'pbf' ELSE 'ambiguous' END AS source,
      CASE WHEN tile_osm IS NOT NULL THEN tile_osm WHEN n = 1 THEN spot.id END AS osm FROM graph_node g LEFT JOIN spot ON spot.lat_e7 = g.lat_e7 AND spot.lon_e7 = g.lon_e7)"""


@query("j14_frontier_osm_id", f"WITH {NAMED} SELECT * FROM named")
def j14(t):
    return matching.frontier_osm_id(t.graph_node, t.road_node).select("id", "country", "level", "lat_e7", "lon_e7", "source", "osm")


view("fr_old", "SELECT country, local_id AS row, level, lat_e7, lon_e7, CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_orderkey END AS osm FROM fr WHERE l_orderkey % 13 <> 0 AND lon_e7 % 3 <> 5")
view("fr_new", "SELECT country, local_id AS row, level, CAST(lat_e7 + CASE WHEN l_orderkey % 10 = 1 THEN 180 ELSE 0 END AS INT) AS lat_e7, lon_e7, CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_orderkey END AS osm FROM fr WHERE l_orderkey % 17 <> 0")


@query("j16_frontier_diff", f"""WITH byid AS (SELECT o.country, o.row AS o_row, n.row AS n_row, CASE WHEN o.lat_e7 = n.lat_e7 AND o.lon_e7 = n.lon_e7 THEN 'retained' ELSE 'moved_same_osm_id' END AS what,
      CASE WHEN o.lat_e7 = n.lat_e7 AND o.lon_e7 = n.lon_e7 THEN NULL ELSE round({haversine('o.lat_e7 / 1e7', 'o.lon_e7 / 1e7', 'n.lat_e7 / 1e7', 'n.lon_e7 / 1e7')}, 2) END AS m
      FROM fr_old o JOIN fr_new n ON o.country = n.country AND o.osm = n.osm AND o.level = n.level),
    on2 AS (SELECT * FROM fr_old o WHERE NOT EXISTS (SELECT 1 FROM byid b WHERE b.country = o.country AND b.o_row = o.row)),
    nn AS (SELECT * FROM fr_new n WHERE NOT EXISTS (SELECT 1 FROM byid b WHERE b.country = n.country AND b.n_row = n.row)),
    byc AS (SELECT on2.country, on2.row AS o_row, nn.row AS n_row FROM on2 JOIN nn ON on2.country = nn.country AND on2.level = nn.level AND on2.lat_e7 = nn.lat_e7 AND on2.lon_e7 = nn.lon_e7),
    seen AS (SELECT country, what, m FROM byid UNION ALL SELECT country, 'retained_by_coordinate', NULL FROM byc
      UNION ALL SELECT country, 'removed', NULL FROM on2 o WHERE NOT EXISTS (SELECT 1 FROM byc b WHERE b.country = o.country AND b.o_row = o.row)
      UNION ALL SELECT country, 'added', NULL FROM nn n WHERE NOT EXISTS (SELECT 1 FROM byc b WHERE b.country = n.country AND b.n_row = n.row))
    SELECT country, what, count(*) AS n, max(m) AS farthest_m FROM seen GROUP BY country, what""")
def j16(t):
    return matching.frontier_diff(t.fr_old, t.fr_new)


view("tile_seen", """SELECT DISTINCT CAST(o_orderkey % 3 AS INT) AS level, CAST(CASE o_orderkey % 3
      WHEN 0 THEN floor((47 + (o_orderkey * 7919 % 200) / 100e0 + 90) / 4e0) * 90 + floor((28 + (o_orderkey * 104729 % 200) / 100e0 + 180) / 4e0)
      WHEN 1 THEN floor((47 + (o_orderkey * 7919 % 200) / 100e0 + 90) / 1e0) * 360 + floor((28 + (o_orderkey * 104729 % 200) / 100e0 + 180) / 1e0)
      ELSE floor((46.6e0 + (o_orderkey * 7919 % 300) / 100e0 + 90) / 0.25e0) * 1440 + floor((27.7e0 + (o_orderkey * 104729 % 300) / 100e0 + 180) / 0.25e0) END AS BIGINT) AS tile_id FROM orders""")

TILE_BOX = """box AS (SELECT level, tile_id, -180e0 + (tile_id % n) * s AS w, -90e0 + floor(tile_id / n) * s AS so, s FROM (
      SELECT *, CASE level WHEN 0 THEN 4e0 WHEN 1 THEN 1e0 ELSE 0.25e0 END AS s, CASE level WHEN 0 THEN 90 WHEN 1 THEN 360 ELSE 1440 END AS n FROM tile_seen)),
    sample AS (SELECT level, tile_id, w + s * fx AS x, so + s * fy AS y FROM box, (VALUES (0e0), (0.5e0), (1e0)) a(fx), (VALUES (0e0), (0.5e0), (1e0)) b(fy))"""


@query("j19_tile_to_country", f"""WITH {TILE_BOX}, hit AS (SELECT p.level, p.tile_id, p.x, p.y, s.pid FROM sample p, poly_seg s WHERE s.xj IS NOT NULL AND {crossing('p.x', 'p.y', 's')} GROUP BY ALL HAVING count(*) % 2 = 1)
    SELECT DISTINCT level, tile_id, pid AS country FROM hit
    UNION SELECT level, tile_id, pid FROM box, poly_vertex v WHERE v.x BETWEEN w AND w + s AND v.y BETWEEN so AND so + s""")
def j19(t):
    return spatial.tile_to_country(t.tile_seen, t.area)


@query("j20_polygon_overlap", f"""WITH v AS (SELECT DISTINCT pid, x, y FROM poly_vertex),
    hit AS (SELECT v.pid AS o, v.x, v.y, s.pid FROM v, poly_seg s WHERE s.pid <> v.pid AND s.xj IS NOT NULL AND {crossing('v.x', 'v.y', 's')} GROUP BY ALL HAVING count(*) % 2 = 1)
    SELECT least(o, pid) AS a, greatest(o, pid) AS b, min(x) AS west, min(y) AS south, max(x) AS east, max(y) AS north FROM hit GROUP BY ALL""")
def j20(t):
    return spatial.polygon_overlap(t.area)


@query("a12_bbox_union", "SELECT pid, min(x) AS west, min(y) AS south, max(x) AS east, max(y) AS north FROM poly_vertex GROUP BY pid")
def a12(t):
    return spatial.bbox_union(t.poly_vertex, ["pid"])


@query("a13_ring_area", f"WITH {AREA_SIZE} SELECT pid, round(area, 9) AS area FROM sized")
def a13(t):
    return t.area.select("pid", F.round(geo.ring_area(c("rings")), 9).alias("area"))


@query("a13_area_of_rows", f"WITH {AREA_SIZE} SELECT pid, round(area, 9) AS area FROM sized")
def a13_rows(t):
    return spatial.area_sizes(t.poly_vertex).select("pid", F.round("size", 9).alias("area"))


@query("a22_middle_of_rows", """SELECT pid, round(avg(x), 9) AS x, round(avg(y), 9) AS y FROM poly_vertex WHERE ring = 0 GROUP BY pid""")
def a22_rows(t):
    return spatial.area_middles(t.poly_vertex).select("pid", F.round("x", 9).alias("x"), F.round("y", 9).alias("y"))


@query("j07_point_in_rows", f"WITH {INSIDE} SELECT point, pid FROM inside")
def j07_rows(t):
    return spatial.point_in_polygon(t.pt, t.poly_vertex, 0.5)


@query("a22_centroid", """SELECT pid, round(avg(x), 9) AS x, round(avg(y), 9) AS y FROM poly_vertex WHERE ring = 0 GROUP BY pid""")
def a22(t):
    m = geo.ring_centroid(c("rings"))
    return t.area.select("pid", F.round(m["x"], 9).alias("x"), F.round(m["y"], 9).alias("y"))


@query("j25_zone_at_point", f"WITH {INSIDE} SELECT pt.point, CASE WHEN min(pid) IS NOT NULL THEN 'Zone/' || CAST(min(pid) AS VARCHAR) END AS zone FROM pt LEFT JOIN inside ON inside.point = pt.point GROUP BY pt.point")
def j25(t):
    zone = spatial.assign_admin(t.pt.select("point", "lat", "lon"), t.area, "point")
    return zone.select("point", F.when(c("admin").isNotNull(), F.concat(F.lit("Zone/"), c("admin").cast("string"))).alias("zone"))
