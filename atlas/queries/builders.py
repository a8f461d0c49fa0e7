"""Dataset builders and graph-shaped steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from atlas.operators import features, network
from atlas.operators import search as search_ops
from atlas.plans import address_index, arterial, catalog, frontier, localities
from atlas.plans import features as feature_plans
from atlas.queries import views
from atlas.queries.base import query, view
from atlas.queries.joins import BEARINGS, place_areas
from atlas.queries.scalars import BUS_SIDE
from atlas.queries.spatial import ALL_PAIRS, EXTRACT, NAMED, regions
from atlas.queries.sqltext import bearing, haversine
from atlas.session import scratch_folder, stored
from atlas.sources import map_objects, sinks

c = F.col

# ---- P4, P5, P6 ------------------------------------------------------------------------------

STATED = rf"""CASE WHEN src IN ('fwd', 'bwd') THEN CASE WHEN way_brg IS NOT NULL THEN [((way_brg + CASE WHEN src = 'bwd' THEN 180 ELSE 0 END) % 360)] ELSE [] END WHEN src IN ('deg', 'card') THEN degs ELSE [] END"""
SPEED_CASE = "CASE {0} WHEN '50' THEN 50 WHEN '30 mph' THEN 48 WHEN '60' THEN 60 WHEN '40 mph' THEN 64 END"


def features_sql(network_only: bool) -> str:
    """The whole feature build as SQL over the same tables."""
    keep = "n_ways > 0" if network_only else "(type = 'camera_speed' OR n_ways > 0)"
    touch = "WHERE rid IN (SELECT i.id FROM enf_item i WHERE i.type = 'n' AND i.role IN ('device', 'from', 'to') AND i.ref IN (SELECT node FROM brg))" if network_only else ""
    return f"""{BEARINGS}, ow AS (SELECT node, count(*) AS n_ways, list_sort(list(way)) AS ways FROM brg GROUP BY node),
    fn AS (SELECT g.id AS node, n.lat, n.lon, CASE WHEN highway = 'speed_camera' THEN 'camera_speed' WHEN railway = 'level_crossing' THEN 'level_crossing' WHEN railway = 'tram_level_crossing' THEN 'tram_level_crossing' ELSE 'traffic_signals' END AS type,
        CASE WHEN highway = 'speed_camera' THEN direction WHEN highway = 'traffic_signals' AND coalesce(railway, '') NOT IN ('level_crossing', 'tram_level_crossing') THEN sig_direction END AS d, CASE WHEN highway = 'speed_camera' THEN {SPEED_CASE.format('maxspeed')} END AS ms,
        CASE WHEN highway = 'traffic_signals' AND signals IS NOT NULL THEN 'signal__' END AS signal, coalesce(n_ways, 0) AS n_ways, ways, way_brg
      FROM node_tag g JOIN node n ON n.id = g.id LEFT JOIN ow ON ow.node = g.id LEFT JOIN dir ON dir.node = g.id WHERE highway IS NOT NULL OR railway IN ('level_crossing', 'tram_level_crossing')),
    fd AS (SELECT *, CASE d WHEN 'forward' THEN 'fwd' WHEN 'backward' THEN 'bwd' WHEN '90;270' THEN 'deg' WHEN '45' THEN 'deg' WHEN 'NE' THEN 'card' END AS src, CASE d WHEN '90;270' THEN [90e0, 270e0] WHEN '45' THEN [45e0] WHEN 'NE' THEN [45e0] END AS degs FROM fn),
    fr0 AS (SELECT node, type, lat, lon, {STATED} AS b, CASE WHEN src IN ('fwd', 'bwd') AND way_brg IS NULL THEN NULL ELSE src END AS bsrc, ms, ways, n_ways, signal FROM fd WHERE {keep}),
    mem AS (SELECT e.id AS rid, e.pos, e.ref, e.role, n.lat, n.lon FROM enf_item e JOIN node n ON n.id = e.ref WHERE e.type = 'n'),
    rl0 AS (SELECT t.id AS rid, kind, {SPEED_CASE.format('maxspeed')} AS ms FROM enf_tag t WHERE kind <> 'mindistance' AND id IN (SELECT id FROM enf_item)), rl AS (SELECT * FROM rl0 {touch}),
    en AS (SELECT rid, arg_min({{'lat': lat, 'lon': lon}}, pos) FILTER (WHERE role = 'from') AS f, arg_min({{'lat': lat, 'lon': lon}}, pos) FILTER (WHERE role = 'to') AS t, count(*) FILTER (WHERE role = 'device') AS dv FROM mem GROUP BY rid),
    sect AS (SELECT id AS rid, 'w' || string_agg(DISTINCT CAST(ref AS VARCHAR), ',w' ORDER BY CAST(ref AS VARCHAR)) AS sections FROM enf_item WHERE type = 'w' AND role = 'section' GROUP BY id),
    sec AS (SELECT 'r' || CAST(rl.rid AS VARCHAR) AS id, 'camera_section' AS type, f.lat AS lat, f.lon AS lon, [{bearing('f.lat', 'f.lon', 't.lat', 't.lon')}] AS b, ms, NULL AS ways, 'rel' AS bsrc, NULL AS rel, NULL AS signal,
        CAST(CAST(round_even(t.lat * 1e7, 0) AS BIGINT) AS VARCHAR) || ',' || CAST(CAST(round_even(t.lon * 1e7, 0) AS BIGINT) AS VARCHAR) AS section_end FROM rl JOIN en ON en.rid = rl.rid WHERE kind = 'average_speed' AND f IS NOT NULL AND t IS NOT NULL),
    cl0 AS (SELECT rl.rid, m.pos, m.ref AS device, m.lat, m.lon, kind, ms, f, t FROM rl JOIN mem m ON m.rid = rl.rid AND m.role = 'device' JOIN en ON en.rid = rl.rid WHERE kind <> 'average_speed'
      UNION ALL SELECT rl.rid, 0, NULL, f.lat, f.lon, kind, ms, f, t FROM rl JOIN en ON en.rid = rl.rid WHERE kind <> 'average_speed' AND dv = 0 AND f IS NOT NULL),
    cl AS (SELECT *, CASE WHEN device IS NOT NULL AND f IS NOT NULL AND (f.lat <> lat OR f.lon <> lon) THEN {bearing('f.lat', 'f.lon', 'lat', 'lon')} WHEN device IS NOT NULL AND t IS NOT NULL AND (t.lat <> lat OR t.lon <> lon) THEN {bearing('lat', 'lon', 't.lat', 't.lon')}
        WHEN f IS NOT NULL AND t IS NOT NULL THEN {bearing('f.lat', 'f.lon', 't.lat', 't.lon')} END AS brg, CASE WHEN device IS NOT NULL AND f IS NOT NULL AND (f.lat <> lat OR f.lon <> lon) THEN 'rel' WHEN device IS NOT NULL AND t IS NOT NULL AND (t.lat <> lat OR t.lon <> lon) THEN 'relrev'
        WHEN f IS NOT NULL AND t IS NOT NULL THEN 'rel' END AS src FROM cl0),
    sm AS (SELECT device AS node, bool_or(kind = 'traffic_signals') AS red, arg_min(brg, rid * 100 + pos) FILTER (WHERE brg IS NOT NULL) AS brg, arg_min(src, rid * 100 + pos) FILTER (WHERE brg IS NOT NULL) AS src, arg_min(ms, rid * 100 + pos) FILTER (WHERE ms IS NOT NULL) AS ms,
        'r' || CAST(max(rid) AS VARCHAR) AS rel, any_value(lat) AS lat, any_value(lon) AS lon FROM cl WHERE device IS NOT NULL GROUP BY device),
    mg AS (SELECT 'n' || CAST(coalesce(a.node, s.node) AS VARCHAR) AS id, CASE WHEN s.node IS NOT NULL AND coalesce(type = 'camera_speed', true) AND red THEN 'camera_red_light' ELSE coalesce(type, 'camera_speed') END AS type, coalesce(a.lat, s.lat) AS lat, coalesce(a.lon, s.lon) AS lon,
        s.node IS NOT NULL AND coalesce(type = 'camera_speed', true) AS claimed, coalesce(len(a.b), 0) = 0 AND s.brg IS NOT NULL AS takes0, a.b, s.brg, a.bsrc, s.src, a.ms AS ams, s.ms AS sms, CASE WHEN a.node IS NOT NULL THEN a.ways ELSE ow.ways END AS ways, s.rel, signal FROM fr0 a FULL JOIN sm s ON s.node = a.node LEFT JOIN ow ON ow.node = coalesce(a.node, s.node)),
    al AS (SELECT rid, arg_max({{'device': device, 'lat': lat, 'lon': lon, 'kind': kind, 'ms': ms, 'brg': brg, 'src': src}}, pos) AS c FROM cl WHERE device IS NULL OR device IN (SELECT node FROM fr0 WHERE type <> 'camera_speed') GROUP BY rid),
    allrows AS (SELECT id, type, lat, lon, CASE WHEN claimed AND takes0 THEN [brg] ELSE coalesce(b, []) END AS b, coalesce(ams, CASE WHEN claimed THEN sms END) AS ms, ways, CASE WHEN claimed AND takes0 THEN src ELSE bsrc END AS bsrc, CASE WHEN claimed THEN rel END AS rel, signal, NULL AS section_end FROM mg
      UNION ALL SELECT 'r' || CAST(rid AS VARCHAR), CASE WHEN c.kind = 'traffic_signals' THEN 'camera_red_light' ELSE 'camera_speed' END, c.lat, c.lon, CASE WHEN c.brg IS NULL THEN [] ELSE [c.brg] END, c.ms, ow.ways, c.src, 'r' || CAST(rid AS VARCHAR), NULL, NULL FROM al LEFT JOIN ow ON ow.node = c.device
      UNION ALL SELECT id, type, lat, lon, b, ms, ways, bsrc, rel, signal, section_end FROM sec)
    SELECT id, type, CAST(round_even(lat * 1e7, 0) AS INT) AS lat_e7, CAST(round_even(lon * 1e7, 0) AS INT) AS lon_e7, array_to_string(list_transform(b, lambda x: CAST(CAST(round_even(x, 0) AS BIGINT) % 360 AS VARCHAR)), ';') AS bearing, CAST(ms AS INT) AS maxspeed,
      coalesce(array_to_string(list_transform(ways, lambda w: 'w' || CAST(w AS VARCHAR)), ','), '') AS ways, bsrc, rel, signal, section_end FROM allrows"""


def shown(rows):
    a = c("attrs")
    return rows.select("id", "type", "lat_e7", "lon_e7", F.array_join(F.transform("bearing", lambda b: b.cast("string")), ";").alias("bearing"), "maxspeed",
                       F.array_join("way_ids", ",").alias("ways"), a["bsrc"].alias("bsrc"), a["rel"].alias("rel"), a["signal"].alias("signal"), a["to"].alias("section_end"))


def road(t):
    return t.way.join(t.way_refs, "id")


@query("p04_navigation_features", f"WITH {features_sql(False)}")
def p04(t):
    rows, _ = feature_plans.build_navigation_features(t.feature_node, road(t), t.enforcement)
    return shown(rows)


@query("p05_network_features", f"WITH {features_sql(True)}")
def p05(t):
    rows, _ = feature_plans.build_features_for_network(t.feature_node, road(t), t.enforcement, t.feature_node)
    return shown(rows)


@query("p06_bus_lanes", f"SELECT * FROM (SELECT id AS way_id, {BUS_SIDE.replace('END FROM', 'END AS side FROM')}) WHERE side IS NOT NULL")
def p06(t):
    return feature_plans.build_bus_lanes(t.way)


@query("a01_bus_lane_counts", f"WITH s AS (SELECT id AS way_id, {BUS_SIDE.replace('END FROM', 'END AS side FROM')}) SELECT v.side, count(s.way_id) AS n FROM (VALUES ('right'), ('left'), ('both')) v(side) LEFT JOIN s ON s.side = v.side GROUP BY v.side")
def a01_lanes(t):
    return features.counts_by_type(features.bus_lanes(t.way), "side", ("right", "left", "both"))


# ---- P7, P8 ----------------------------------------------------------------------------------


@query("p07_build_frontier", f"WITH {EXTRACT}, {NAMED} SELECT country, level, lat_e7, lon_e7, id AS local_id, osm, source FROM named WHERE id IN (SELECT id FROM border)")
def p07(t):
    return frontier.build_frontier(t.graph_node, t.graph_edge, t.road_node)


@query("p08_portal_set", f"""WITH {ALL_PAIRS}, g AS (SELECT p, (CAST(substr(p, 2, 1) AS BIGINT) << 46) | ra AS ga, (CAST(substr(p, 5, 1) AS BIGINT) << 46) | rb AS gb FROM pairs)
    SELECT 'portal' AS what, CAST(ga AS VARCHAR) AS subject, CAST(gb AS VARCHAR) AS detail FROM g UNION ALL SELECT 'portal', CAST(gb AS VARCHAR), CAST(ga AS VARCHAR) FROM g
    UNION ALL SELECT 'pair', p, concat_ws('/', osm, coord, near, ambiguous) FROM stats WHERE osm + coord + near + ambiguous > 0
    UNION ALL SELECT 'gate', p, 'ambiguous entries' FROM stats WHERE ambiguous > 0""")
def p08(t):
    portals, stats, gate = frontier.build_portal_set(t.fr, regions(t), t.fr_border)
    text = lambda x: c(x).cast("string")
    return (portals.select(F.lit("portal").alias("what"), text("from_id").alias("subject"), text("to_id").alias("detail"))
            .unionByName(stats.select(F.lit("pair").alias("what"), c("pair").alias("subject"), F.concat_ws("/", "osm", "coord", "near", "ambiguous").alias("detail")))
            .unionByName(gate.filter("severity = 'FAIL'").select(F.lit("gate").alias("what"), F.concat_ws("-", "a", "b").alias("subject"), c("rule").alias("detail"))))


# ---- G1, G2, P9 ------------------------------------------------------------------------------

SEARCH = """st AS (SELECT way_id AS way, row_number() OVER (PARTITION BY way_id ORDER BY seq) - 1 AS idx, node_id AS node, CASE WHEN oneway = 'yes' THEN 1 WHEN oneway = '-1' THEN -1 WHEN junction = 'roundabout' AND coalesce(oneway, '') <> 'no' THEN 1 ELSE 0 END AS dir,
      highway IN ('primary', 'tertiary', 'secondary_link') AS arterial FROM way_node JOIN way_tag g ON g.id = way_id WHERE highway IS NOT NULL AND highway <> 'footway' AND coalesce(motorcar, motor_vehicle, access, 'yes') NOT IN ('no', 'private')),
    src AS (SELECT DISTINCT CASE e WHEN 0 THEN first ELSE last END AS source FROM (SELECT way_id, arg_min(node_id, seq) AS first, arg_max(node_id, seq) AS last FROM way_node WHERE way_id IN (SELECT id FROM way_tag WHERE route = 'ferry' AND coalesce(motor_vehicle, motorcar, '') <> 'no') GROUP BY way_id), (VALUES (0), (1)) v(e)),
    f0 AS (SELECT source, h.heading, st.* FROM src JOIN st ON st.node = source, (VALUES ('out'), ('in')) h(heading)),
    hit0 AS (SELECT DISTINCT source, heading FROM f0 WHERE arterial),
    n1 AS (SELECT DISTINCT f.source, f.heading, s.node FROM f0 f JOIN st s ON s.way = f.way AND ((s.idx > f.idx AND CASE WHEN f.heading = 'out' THEN f.dir <> -1 ELSE f.dir <> 1 END) OR (s.idx < f.idx AND CASE WHEN f.heading = 'out' THEN f.dir <> 1 ELSE f.dir <> -1 END)) WHERE s.node <> f.source AND NOT EXISTS (SELECT 1 FROM hit0 WHERE hit0.source = f.source AND hit0.heading = f.heading)),
    f1 AS (SELECT n1.source, n1.heading, st.* FROM n1 JOIN st ON st.node = n1.node),
    hit1 AS (SELECT DISTINCT source, heading FROM f1 WHERE arterial)"""


REACHED = """nh AS (SELECT node, bool_or(arterial) AS hit FROM st GROUP BY node),
    reached(source, heading, node, level, hit) USING KEY (source, heading, node) AS (
      SELECT src.source, h.heading, src.source, 0, nh.hit FROM src JOIN nh ON nh.node = src.source, (VALUES ('out'), ('in')) h(heading)
      UNION
      SELECT DISTINCT b.source, b.heading, s.node, b.level + 1, nh.hit FROM reached b JOIN st f ON f.node = b.node
        JOIN st s ON s.way = f.way AND ((s.idx > f.idx AND CASE WHEN b.heading = 'out' THEN f.dir <> -1 ELSE f.dir <> 1 END) OR (s.idx < f.idx AND CASE WHEN b.heading = 'out' THEN f.dir <> 1 ELSE f.dir <> -1 END))
        JOIN nh ON nh.node = s.node
      WHERE NOT EXISTS (SELECT 1 FROM reached h WHERE h.source = b.source AND h.heading = b.heading AND h.hit)
        AND NOT EXISTS (SELECT 1 FROM recurring.reached r WHERE r.source = b.source AND r.heading = b.heading AND r.node = s.node))"""


@query("g01_directed_search", f"WITH RECURSIVE {SEARCH}, {REACHED} SELECT DISTINCT source, heading, CAST(level AS INT) AS level FROM reached WHERE hit")
def g01(t):
    ends = network.ferry_ends(road(t))
    found = network.connector_search(network.way_nodes(road(t)), ends)
    return ends.select(c("source").alias("node")).distinct().join(found, "node").select(c("node").alias("source"), "heading", "level")


BACK = """back(heading, node, level) USING KEY (heading, node) AS (
      SELECT h.heading, a.node, 0 FROM (SELECT DISTINCT node FROM st WHERE arterial) a, (VALUES ('out'), ('in')) h(heading)
      UNION
      SELECT DISTINCT b.heading, s.node, b.level + 1 FROM back b JOIN st f ON f.node = b.node AND NOT f.arterial
        JOIN st s ON s.way = f.way AND ((f.idx > s.idx AND CASE WHEN b.heading = 'out' THEN f.dir <> -1 ELSE f.dir <> 1 END) OR (f.idx < s.idx AND CASE WHEN b.heading = 'out' THEN f.dir <> 1 ELSE f.dir <> -1 END))
      WHERE NOT EXISTS (SELECT 1 FROM recurring.back r WHERE r.heading = b.heading AND r.node = s.node)),
    nxt AS (SELECT heading, node, level, way, next FROM (SELECT u.heading, u.node, u.level, s.way, f.node AS next,
        row_number() OVER (PARTITION BY u.heading, u.node ORDER BY s.way, CASE WHEN f.idx > s.idx THEN 0 ELSE 1 END, CASE WHEN f.idx > s.idx THEN -f.idx ELSE f.idx END) AS rn
      FROM back u JOIN st s ON s.node = u.node AND NOT s.arterial JOIN st f ON f.way = s.way JOIN back v ON v.node = f.node AND v.heading = u.heading AND v.level = u.level - 1
      WHERE u.level > 0 AND ((f.idx > s.idx AND CASE WHEN u.heading = 'out' THEN f.dir <> -1 ELSE f.dir <> 1 END) OR (f.idx < s.idx AND CASE WHEN u.heading = 'out' THEN f.dir <> 1 ELSE f.dir <> -1 END))) WHERE rn = 1),
    walk(source, heading, node) AS (SELECT DISTINCT source, heading, source FROM src JOIN back ON back.node = src.source
      UNION ALL SELECT w.source, w.heading, n.next FROM walk w JOIN nxt n ON n.node = w.node AND n.heading = w.heading)"""
WAY_LENGTH = f"""metres AS (SELECT way_id, sum({haversine("lat", "lon", "lat2", "lon2")}) AS length FROM (
      SELECT w.way_id, n.lat, n.lon, lag(n.lat) OVER (PARTITION BY w.way_id ORDER BY w.seq) AS lat2, lag(n.lon) OVER (PARTITION BY w.way_id ORDER BY w.seq) AS lon2
      FROM (SELECT way_id, seq, node_id FROM way_node) w JOIN (SELECT id, lat, lon FROM node) n ON n.id = w.node_id) GROUP BY way_id)"""


@query("p09_connector_ends", f"""WITH RECURSIVE {SEARCH}, {BACK}, {WAY_LENGTH},
    used AS (SELECT DISTINCT source, way FROM walk JOIN nxt USING (heading, node)), far AS (SELECT source, sum(coalesce(length, 0)) AS length FROM used LEFT JOIN metres ON way_id = way GROUP BY source),
    hd AS (SELECT source, count(DISTINCT heading) AS headings FROM walk GROUP BY source)
    SELECT source, CASE WHEN NOT EXISTS (SELECT 1 FROM st WHERE st.node = source) THEN 'no road' WHEN headings IS NULL THEN 'unreached' WHEN length IS NULL THEN 'already on network'
      WHEN length > 10000 THEN 'too long' WHEN headings = 2 THEN 'both ways' ELSE 'one way' END AS outcome, round(length, 4) AS length FROM src LEFT JOIN hd USING (source) LEFT JOIN far USING (source)""")
def p09(t):
    _, ends = connected(t)
    return ends.select("source", "outcome", F.round("length", 4).alias("length"))


@query("p09_connector_ways", f"""WITH RECURSIVE {SEARCH}, {BACK}, {WAY_LENGTH},
    used AS (SELECT DISTINCT source, way FROM walk JOIN nxt USING (heading, node)), far AS (SELECT source, sum(coalesce(length, 0)) AS total FROM used LEFT JOIN metres ON way_id = way GROUP BY source)
    SELECT source, way, round(coalesce(length, 0), 4) AS length, highway FROM used JOIN far USING (source) LEFT JOIN metres ON way_id = way JOIN way_tag ON id = way WHERE total <= 10000""")
def p09_ways(t):
    found, _ = connected(t)
    return found.select("source", "way", F.round("length", 4).alias("length"), "highway")


def connected(t):
    ways = stored(road(t), "ways")
    classes = ways.select(c("id").alias("way"), c("tags")["highway"].alias("highway"))
    return network.connectors(network.ferry_ends(ways), network.way_nodes(ways), arterial.way_lengths(ways, t.node), classes)


@query("p09_arterial_network")
def p09_network(t):
    nodes = t.node.select("id", "lat", "lon")
    built = arterial.build_arterial_network(nodes, road(t), t.relation)
    return built.way.select("id", c("tags")["highway"].alias("highway"), F.size("refs").alias("nodes"))


@query("a15_connector_summary", f"""WITH RECURSIVE {SEARCH}, {BACK}, {WAY_LENGTH},
    used AS (SELECT DISTINCT source, way FROM walk JOIN nxt USING (heading, node)), far AS (SELECT source, sum(coalesce(length, 0)) AS total FROM used LEFT JOIN metres ON way_id = way GROUP BY source),
    kept AS (SELECT DISTINCT way FROM used JOIN far USING (source) WHERE total <= 10000), sorted AS (SELECT list_sort(list(total)) AS l, count(*) AS n FROM far WHERE total <= 10000)
    SELECT highway, count(*) AS ways, round(sum(coalesce(length, 0)) / 1000, 3) AS km FROM kept LEFT JOIN metres ON way_id = way JOIN way_tag ON id = way GROUP BY highway
    UNION ALL SELECT 'median chain', 0, round(l[least(n - 1, CAST(floor(n * 0.5) AS BIGINT)) + 1] / 1000, 3) FROM sorted""")
def a15(t):
    found, ends = connected(t)
    by_class, spread = network.connector_summary(found, ends)
    rows = by_class.select("highway", "ways", F.round("km", 3).alias("km"))
    return rows.unionByName(spread.select(F.lit("median chain").alias("highway"), F.lit(0).cast("bigint").alias("ways"), F.round(c("median") / 1000, 3).alias("km")))


def coast(t):
    """Every ring edge as a way of two points, odd areas as one closed way, and open chains of points."""
    v = t.poly_vertex.filter("pid % 2 = 0")
    seg = v.alias("a").join(v.alias("b"), (c("a.pid") == c("b.pid")) & (c("a.ring") == c("b.ring")) & (c("a.ord") + 1 == c("b.ord")))
    spot = lambda p: F.struct(c(f"{p}.x").alias("x"), c(f"{p}.y").alias("y"))
    edges = seg.select((c("a.pid") * 100 + c("a.ring") * 20 + c("a.ord")).cast("bigint").alias("way"), F.array(spot("a"), spot("b")).alias("points"))
    whole = t.area.filter("pid % 2 = 1").select("pid", F.posexplode("rings").alias("ring", "points")).select((c("pid") * 100 + c("ring")).cast("bigint").alias("way"), "points")
    nxt = t.pt.select((c("point") - 1).alias("point"), c("lat").alias("lat2"), c("lon").alias("lon2"))
    open_ = t.pt.join(nxt, "point").select((c("point") + 100000).alias("way"), F.array(F.struct(c("lon").alias("x"), c("lat").alias("y")), F.struct(c("lon2").alias("x"), c("lat2").alias("y"))).alias("points"))
    return edges.unionByName(whole).unionByName(open_)


@query("g02_chain_rings", """SELECT CAST(pid * 100 + ring * 20 AS BIGINT) AS pid, CAST(ord AS BIGINT) AS ord, x, y FROM poly_vertex WHERE pid % 2 = 0
    UNION ALL SELECT CAST(pid * 100 + ring AS BIGINT), CAST(ord AS BIGINT), x, y FROM poly_vertex WHERE pid % 2 = 1""")
def g02(t):
    return network.chain_rings(coast(t)).select("pid", "ord", "x", "y")


# ---- P10 -------------------------------------------------------------------------------------

view("extract_index", """SELECT n_nationkey AS k, CASE n_nationkey WHEN 3 THEN 'alps' WHEN 4 THEN 'kosovo' WHEN 5 THEN 'russia' ELSE 'land-' || CAST(n_nationkey AS STRING) END AS gid, CASE WHEN n_nationkey IN (5, 6) THEN 'asia' ELSE 'europe' END AS parent,
    'A' || chr(CAST(65 + n_nationkey AS INT)) AS iso, n_name AS name, 'https://host.example/europe/' || lower(n_name) || '-latest.osm.pbf' AS url FROM nation""")
view("cat_known", "SELECT 'A' || chr(CAST(65 + n_nationkey AS INT)) AS code, CAST(n_nationkey + 1 AS INT) AS region_id, 'Old ' || n_name AS title, 'europe/' || lower(n_name) AS path FROM nation WHERE n_nationkey % 3 = 1 AND n_nationkey <> 4")
CATALOG = """ct AS (SELECT k, CASE gid WHEN 'kosovo' THEN 'XK' ELSE iso END AS code, name, 'europe/' || lower(name) AS path FROM extract_index WHERE (parent = 'europe' AND gid <> 'alps') OR gid = 'russia'),
    nid AS (SELECT code, (SELECT max(region_id) FROM cat_known) + row_number() OVER (ORDER BY code) AS region_id FROM ct WHERE code NOT IN (SELECT code FROM cat_known)),
    bx AS (SELECT pid AS k, round_even(min(x), 2) AS west, round_even(min(y), 2) AS south, round_even(max(x), 2) AS east, round_even(max(y), 2) AS north FROM poly_vertex GROUP BY pid)"""


def built_catalog(t):
    rings = t.area.withColumnRenamed("pid", "k")
    index = t.extract_index.join(rings, "k").withColumn("iso", F.array("iso"))
    none = t.nation.limit(0).select(*[F.lit("").alias(x) for x in ("a", "b")], *[F.lit(0.0).alias(x) for x in ("south", "west", "north", "east")])
    return catalog.build_catalog(index, t.cat_known, none, prefix="https://host.example/")


@query("p10_catalog", f"WITH {CATALOG} SELECT ct.code, CAST(coalesce(o.region_id, nid.region_id) AS BIGINT) AS region_id, CASE WHEN ct.code = 'XK' THEN 'Kosovo' ELSE coalesce(o.title, name) END AS title, ct.path, west, south, east, north FROM ct LEFT JOIN cat_known o ON o.code = ct.code LEFT JOIN nid ON nid.code = ct.code JOIN bx ON bx.k = ct.k")
def p10(t):
    return built_catalog(t).country


@query("p10_catalog_borders", f"""WITH {CATALOG}, v AS (SELECT DISTINCT pid, x, y FROM poly_vertex), hit AS (SELECT v.pid AS o, v.x, v.y, s.pid FROM v, poly_seg s WHERE s.pid <> v.pid AND s.xj IS NOT NULL AND ((s.yi > v.y) <> (s.yj > v.y) AND v.x < (s.xj - s.xi) * (v.y - s.yi) / (s.yj - s.yi) + s.xi) GROUP BY ALL HAVING count(*) % 2 = 1)
    SELECT least(p.code, q.code) AS a, greatest(p.code, q.code) AS b, round_even(min(y) - 0.2, 2) AS south, round_even(min(x) - 0.2, 2) AS west, round_even(max(y) + 0.2, 2) AS north, round_even(max(x) + 0.2, 2) AS east, false AS required FROM hit JOIN ct p ON p.k = hit.o JOIN ct q ON q.k = hit.pid GROUP BY 1, 2""")
def p10_borders(t):
    return built_catalog(t).border.drop("legacy")


# ---- P2, P3 and what the built index answers ---------------------------------------------------


def place_index(t):
    tag = lambda **kv: F.map_filter(F.create_map(*[x for k, v in kv.items() for x in (F.lit(k.replace("__", ":")), v)]), lambda k, v: v.isNotNull() & (v != ""))
    kinds = F.element_at(F.array(*[F.lit(k) for k in views.KINDS]), (F.substring("pid", 2, 20).cast("bigint") % 4 + 1).cast("int"))
    points = t.place_point.select("pid", tag(name=c("name"), place=kinds, alt_name=c("alias"), population=c("pop").cast("string"), wikidata=c("wikidata"), is_in=c("is_in")).alias("tags"), "lat", "lon")
    areas = place_areas(t).select("pid", tag(name=c("name"), place=F.lit("village"), alt_name=F.get("aliases", F.lit(0))).alias("tags"), "rings")
    admin = t.area.join(t.nation, c("pid") == c("n_nationkey")).select(F.concat(F.lit("r"), F.lpad(c("pid").cast("string"), 3, "0")).alias("pid"), tag(name=c("n_name"), official_name=F.concat(F.lit("comuna "), c("n_name"))).alias("tags"), "rings")
    return localities.build_localities(points, areas, None, admin, admin), areas.select("pid", "rings")


def built_index(t):
    places, areas = place_index(t)
    objects = t.addr.select("kind", "oid", "lat_e7", "lon_e7", "lat", "lon", "street", "place", "city", "num")
    return address_index.build_address_index(objects, t.rel_member, t.way, places, areas)


@query("p02_localities")
def p02(t):
    places, _ = place_index(t)
    return places.locality.select("id", "pid", "name", F.array_join("aliases", "|").alias("aliases"), "kind", "district", "commune", "pop")


@query("p03_address_index")
def p03(t):
    return built_index(t).street.select("id", "name", "city", "lat", "lon", "houses", "locality", "method")


@query("a07_houses_per_locality")
def a07(t):
    return built_index(t).locality.select("id", "name", "houses")


@query("k02_address_tables")
def k02(t):
    path = scratch_folder(t.spark, "address")
    sinks.write_address_tables(built_index(t), path)
    return t.spark.read.parquet(f"{path}/meta")


view("t_street", "SELECT o_orderkey AS id, o_orderpriority AS name, CASE WHEN o_custkey % 10 > 0 THEN o_custkey END AS locality, (470000000 + o_orderkey * 100) / 1e7 AS lat, (280000000 + o_orderkey * 50) / 1e7 AS lon FROM orders")
view("t_house", "SELECT l_orderkey AS street, CAST(l_linenumber AS STRING) || 'a' AS key, l_partkey * 4 + 1 AS osm, CAST(470000000 + l_partkey AS INT) AS lat_e7, CAST(280000000 + l_suppkey AS INT) AS lon_e7 FROM li")


LOOKUP = """SELECT o_orderkey AS street, '3a' AS key, h.street IS NOT NULL AS exact, coalesce(h.lat_e7 / 1e7, s.lat) AS lat, coalesce(h.lon_e7 / 1e7, s.lon) AS lon FROM orders JOIN t_street s ON s.id = o_orderkey LEFT JOIN t_house h ON h.street = o_orderkey AND h.key = '3a'"""


@query("q03_house_lookup", LOOKUP)
def q03(t):
    asked = t.orders.select(c("o_orderkey").alias("street"), F.lit("3a").alias("key"))
    return search_ops.house_lookup(asked, t.t_house, t.t_street)


@query("q03_bucketed_lookup", LOOKUP)
def q03_bucketed(t):
    """The same questions to the written tables, which are not moved."""
    path = scratch_folder(t.spark, "lookup")
    street, house = sinks.write_lookup_tables(t.t_street, t.t_house, path, f"lookup_{path[-32:]}", buckets=16)
    asked = t.orders.select(c("o_orderkey").alias("street"), F.lit("3a").alias("key"))
    return search_ops.house_lookup(asked, t.spark.table(house), t.spark.table(street))


@query("q04_street_context", """SELECT s.id, s.name, c_name AS locality_name, n_name AS commune_name, c_mktsegment AS district FROM t_street s LEFT JOIN customer ON c_custkey = s.locality LEFT JOIN nation ON n_nationkey = CASE WHEN c_custkey % 3 > 0 THEN c_nationkey END""")
def q04(t):
    locality = t.customer.select(c("c_custkey").alias("id"), c("c_name").alias("name"), c("c_mktsegment").alias("district"), F.when(c("c_custkey") % 3 > 0, c("c_nationkey")).alias("commune"))
    commune = t.nation.select(c("n_nationkey").alias("id"), c("n_name").alias("display"))
    return search_ops.street_context(t.t_street, locality, commune)




def extract_text(t):
    """Addressed features as an extract writes them: nodes as points, ways as lines or areas, relations as multipolygons."""
    pairs = [("addr:housenumber", "num"), ("addr:street", "street"), ("addr:place", "place"), ("addr:city", "city")]
    kind = F.element_at(F.array(*[F.lit(x) for x in ("node", "way", "relation")]), c("kind") + 1)
    props = F.map_filter(F.create_map(F.lit("@type"), kind, F.lit("@id"), c("oid").cast("string"), *[x for k, v in pairs for x in (F.lit(k), c(v))]), lambda k, v: v.isNotNull())
    at = lambda dx, dy: F.array(c("lon") + dx, c("lat") + dy)
    ring = F.array(at(0.0, 0.0), at(0.0, 0.001), at(0.001, 0.001), at(0.0, 0.0))
    hole = F.array(at(0.0002, 0.0002), at(0.0002, 0.0003), at(0.0002, 0.0002))
    shapes = {"Point": at(0.0, 0.0), "LineString": F.array(at(0.0, 0.0), at(0.002, 0.001)), "Polygon": F.array(ring, hole), "MultiPolygon": F.array(F.array(ring, hole), F.array(hole))}
    shape = (F.when(c("kind") == 0, "Point").when((c("kind") == 1) & (c("oid") % 2 == 0), "LineString").when(c("kind") == 1, "Polygon").otherwise("MultiPolygon"))
    text = F.coalesce(*[F.when(shape == name, F.to_json(F.struct(F.lit("Feature").alias("type"), props.alias("properties"), F.struct(F.lit(name).alias("type"), xy.alias("coordinates")).alias("geometry")))) for name, xy in shapes.items()])
    path = scratch_folder(t.spark, "extract")
    t.addr.select(F.concat(F.lit("\x1e"), text).alias("value")).write.text(path)
    return path


MEAN = {"line": ("lat + 0.001e0 / 2", "lon + 0.002e0 / 2"), "ring": ("lat + 0.002e0 / 4", "lon + 0.001e0 / 4")}


@query("p03_address_objects", f"""SELECT kind, oid, round(CASE WHEN kind = 0 THEN lat WHEN kind = 1 AND oid % 2 = 0 THEN {MEAN['line'][0]} ELSE {MEAN['ring'][0]} END, 6) AS lat,
    round(CASE WHEN kind = 0 THEN lon WHEN kind = 1 AND oid % 2 = 0 THEN {MEAN['line'][1]} ELSE {MEAN['ring'][1]} END, 6) AS lon, street, place, coalesce(city, '') AS city, num FROM addr""")
def p03_objects(t):
    read = map_objects.read_geojson_seq(t.spark, extract_text(t))
    found = address_index.address_objects(read)
    return found.select("kind", "oid", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"), "street", "place", "city", "num")


@query("p03_house_members", """SELECT rel_id, kind, ref, role, name FROM rel_member WHERE name IS NOT NULL AND rel_id % 5 <> 0""")
def p03_members(t):
    """Relations of other types, and those without a name, give no street."""
    letter = F.element_at(F.array(F.lit("n"), F.lit("w"), F.lit("r")), c("kind") + 1)
    kind = F.when(c("rel_id") % 5 == 0, "street").otherwise("associatedStreet")
    tags = F.map_filter(F.create_map(F.lit("type"), kind, F.lit("name"), c("name")), lambda k, v: v.isNotNull())
    relations = t.rel_member.select(c("rel_id").alias("id"), tags.alias("tags"), F.array(F.struct(letter.alias("type"), c("ref"), c("role"))).alias("members"))
    return address_index.house_members(relations)


@query("p02_admin_areas", """SELECT 'RO' AS code, CAST(n_nationkey AS VARCHAR) AS pid, CASE n_nationkey % 4 WHEN 0 THEN 'district' ELSE 'commune' END AS what FROM nation WHERE n_nationkey % 4 IN (0, 2)
    UNION ALL SELECT 'MD', CAST(n_nationkey AS VARCHAR), 'district' FROM nation WHERE n_nationkey % 4 = 0 UNION ALL SELECT 'FR', CAST(n_nationkey AS VARCHAR), 'district' FROM nation WHERE n_nationkey % 4 = 1""")
def p02_admin(t):
    level = F.element_at(F.array(*[F.lit(x) for x in ("4", "6", "8", "8")]), (c("n_nationkey") % 4 + 1).cast("int"))
    boundary = F.when(c("n_nationkey") % 4 == 3, "political").otherwise("administrative")
    areas = t.nation.select(c("n_nationkey").cast("string").alias("pid"), F.create_map(F.lit("boundary"), boundary, F.lit("admin_level"), level, F.lit("name"), c("n_name")).alias("tags"), F.lit(None).alias("rings"))
    rows = None
    for code in ("RO", "MD", "FR"):
        for what, df in zip(("district", "commune"), localities.admin_areas(areas, code), strict=True):
            if df is not None:
                part = df.select(F.lit(code).alias("code"), "pid", F.lit(what).alias("what"))
                rows = part if rows is None else rows.unionByName(part)
    return rows


@query("p02_fallback_places", "SELECT n_name AS name, 'town' AS kind, CAST(n_nationkey AS BIGINT) AS pop FROM nation")
def p02_fallback(t):
    """A country whose extract names no locality takes the places of its search index."""
    none = t.place_point.limit(0).select("pid", F.create_map().cast("map<string,string>").alias("tags"), "lat", "lon")
    areas = place_areas(t).limit(0).select("pid", F.create_map().cast("map<string,string>").alias("tags"), "rings")
    index = t.nation.select(c("n_name").alias("name"), (c("n_nationkey") * 0.01 + 47).alias("lat"), (c("n_nationkey") * 0.01 + 28).alias("lon"), c("n_nationkey").alias("pop"))
    built = localities.build_localities(none, areas, None, areas, None, index)
    return built.locality.select("name", "kind", "pop")
