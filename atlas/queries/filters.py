"""Selections F1–F14 and the union of extracts."""

from __future__ import annotations

from pyspark.sql import functions as F

from atlas.functions import geo, osm
from atlas.operators import filters as ops
from atlas.operators import routes
from atlas.plans.arterial import way_lengths
from atlas.plans.localities import admin_level_filter
from atlas.queries import views
from atlas.queries.base import query, view
from atlas.queries.scalars import CATEGORY_CASE
from atlas.queries.sqltext import haversine

c = F.col

WANTED = (("w", "highway", ("primary", "tertiary")), ("nw", "bridge", ("viaduct",)), ("r", "type", ("boundary",)))


@query("f01_tag_filter", "SELECT id, highway, bridge FROM way_tag WHERE highway IN ('primary', 'tertiary') OR bridge = 'viaduct'")
def f01(t):
    kept = ops.tag_filter(t.way, "w", WANTED)
    return kept.select("id", c("tags")["highway"].alias("highway"), c("tags")["bridge"].alias("bridge"))


@query("f02_tag_filter_with_refs", """WITH r AS (SELECT id FROM rel_tag WHERE type = 'boundary'), m AS (SELECT DISTINCT type, ref FROM rel_item WHERE id IN (SELECT id FROM r)),
    w AS (SELECT DISTINCT way_id AS id FROM way_node WHERE way_id IN (SELECT id FROM way_tag WHERE highway IN ('primary', 'tertiary') OR bridge = 'viaduct') OR way_id IN (SELECT ref FROM m WHERE type = 'w')),
    n AS (SELECT id FROM node WHERE id IN (SELECT ref FROM m WHERE type = 'n') OR id IN (SELECT node_id FROM way_node WHERE way_id IN (SELECT id FROM w)))
    SELECT 'r' AS kind, id FROM r UNION ALL SELECT 'w', id FROM w UNION ALL SELECT 'n', id FROM n""")
def f02(t):
    nodes = t.node.select("id", F.create_map().cast("map<string,string>").alias("tags"))
    n, w, r = ops.tag_filter_with_refs(nodes, t.full_way, t.relation, WANTED)
    tag = lambda df, k: df.select(F.lit(k).alias("kind"), "id")
    return tag(r, "r").unionByName(tag(w, "w")).unionByName(tag(n, "n"))


@query("f03_get_by_id", """WITH w AS (SELECT DISTINCT way_id AS id FROM way_node WHERE way_id IN (SELECT o_custkey FROM orders))
    SELECT 'w' AS kind, id FROM w UNION ALL SELECT DISTINCT 'n', node_id FROM way_node JOIN node ON node.id = node_id WHERE way_id IN (SELECT id FROM w)""")
def f03(t):
    ids = t.orders.select(c("o_custkey").alias("id"))
    w, n = ops.get_ways_with_nodes(t.way_refs, t.node, ids)
    return w.select(F.lit("w").alias("kind"), "id").unionByName(n.select(F.lit("n").alias("kind"), "id"))


@query("f04_road_classes", """SELECT id, coalesce(highway <> 'footway', false) AS drivable,
    coalesce(highway IN ('primary', 'secondary_link', 'tertiary'), false) AS arterial, coalesce(highway <> 'footway', false) AS routable FROM way_tag""")
def f04(t):
    g = c("tags")
    return t.way.select("id", ops.drivable(g).alias("drivable"), ops.arterial(g).alias("arterial"), ops.routable(g).alias("routable"))


@query("f06_bbox_margin", "SELECT point FROM pt WHERE NOT (lat BETWEEN 47.5 - 0.2 AND 48.5 + 0.2 AND lon BETWEEN 28.6 - 0.2 AND 29.2 + 0.2)")
def f06(t):
    box = F.struct(*[F.lit(v).alias(n) for n, v in (("west", 28.6), ("south", 47.5), ("east", 29.2), ("north", 48.5))])
    return t.pt.filter(ops.outside_bbox(c("lat"), c("lon"), box)).select("point")


PT_TILE = """SELECT point, 12 AS z, CAST(trunc((lon + 180) / 360e0 * 4096) AS BIGINT) AS x, CAST(trunc((1 - asinh(tan(radians(lat))) / pi()) / 2e0 * 4096) AS BIGINT) AS y FROM pt"""


@query("f07_tile_window", f"""WITH p AS ({PT_TILE}) SELECT point, x, y FROM p WHERE x >= trunc((28.3e0 + 180) / 360 * 4096) AND x <= trunc((29.1e0 + 180) / 360 * 4096)
    AND y >= trunc((1 - asinh(tan(radians(48.4e0))) / pi()) / 2 * 4096) AND y <= trunc((1 - asinh(tan(radians(47.2e0))) / pi()) / 2 * 4096)""")
def f07(t):
    tiles = t.pt.select("point", F.lit(12).alias("z"), geo.web_tile(c("lat"), c("lon"), F.lit(12)).alias("w")).select("point", "z", "w.*")
    return ops.tile_window(tiles, (28.3, 47.2, 29.1, 48.4), 12).select("point", "x", "y")


@query("f08_admin_level", "SELECT id, name FROM rel_tag WHERE boundary = 'administrative' AND admin_level = '6' AND name IS NOT NULL")
def f08(t):
    return admin_level_filter(t.relation, "6").select("id", c("tags")["name"].alias("name"))


TF_KEPT = f"""SELECT *, {CATEGORY_CASE} AS cat FROM tf WHERE CASE layer WHEN 'places' THEN name IS NOT NULL AND kind IN ('region', 'locality', 'borough')
    WHEN 'roads' THEN name IS NOT NULL AND kind IN ('major_road', 'minor_road', 'highway') ELSE name IS NOT NULL OR {CATEGORY_CASE} IS NOT NULL END"""


@query("f09_search_rows", f"WITH k AS ({TF_KEPT}) SELECT id, layer, name, kind FROM k")
def f09(t):
    a = c("attrs")
    return ops.search_row_filter(t.tile_feature).select("id", "layer", a["name"].alias("name"), a["kind"].alias("kind"))


view("way_len", """SELECT way_id, sum(sqrt(pow((lat - lat2) * 111320e0, 2) + pow((lon - lon2) * 111320e0 * cos(radians(lat)), 2))) AS length FROM way_step GROUP BY way_id""")


def probe_lengths(t):
    placed = t.way_node.join(t.node.select(c("id").alias("node_id"), "lat", "lon"), "node_id", "left")
    return routes.path_length(placed, ["way_id"], "seq", geo.probe_metres).withColumnRenamed("way_id", "id")


@query("f10_one_way_candidates", """SELECT id, round(length, 4) AS length FROM way_tag JOIN way_len ON way_id = id WHERE oneway IN ('yes', '-1') AND name IS NOT NULL AND coalesce(highway, '') NOT IN ('motorway', 'trunk') AND length BETWEEN 200 AND 900""")
def f10(t):
    ways = t.way.join(probe_lengths(t), "id")
    return ways.filter(ops.one_way_candidate(c("tags"), c("length"))).select("id", F.round("length", 4).alias("length"))


@query("f11_bridge_ground", """SELECT id, coalesce(highway, '') NOT LIKE '%\\_link' ESCAPE '\\' AND bridge IS NOT NULL AND coalesce(layer, '0') NOT IN ('0', '-1', '-2') AS deck,
    coalesce(highway, '') NOT LIKE '%\\_link' ESCAPE '\\' AND bridge IS NULL AND tunnel IS NULL AS ground FROM way_tag""")
def f11(t):
    return t.way.select("id", ops.is_bridge_deck(c("tags")).alias("deck"), ops.is_ground_road(c("tags")).alias("ground"))


@query("f12_car_ferry", "SELECT id FROM way_tag WHERE route = 'ferry' AND coalesce(motor_vehicle, motorcar, '') <> 'no'")
def f12(t):
    return t.way.filter(osm.is_car_ferry(c("tags"))).select("id")


@query("f13_access_ok", "SELECT id, coalesce(motorcar, motor_vehicle, access, 'yes') NOT IN ('no', 'private') AS ok FROM way_tag")
def f13(t):
    return t.way.select("id", osm.access_ok(c("tags")).alias("ok"))


view("verdict_text", """SELECT event_id AS id, CASE event_type WHEN 'click' THEN 'PASS' WHEN 'error' THEN 'FAIL' WHEN 'view' THEN 'UNCHECKED: no stamp' WHEN 'signup' THEN 'pass' END AS verdict,
    CASE WHEN user_id % 3 = 0 THEN NULL ELSE user_id % 3 = 1 END AS flag FROM events""")


@query("f14_verdicts", """SELECT id, coalesce(verdict = 'PASS', false) AS pass, coalesce(verdict LIKE 'UNCHECKED%', false) AS unchecked, CASE WHEN flag THEN 'PASS' WHEN NOT flag THEN 'FAIL' END AS legacy FROM verdict_text""")
def f14(t):
    v = c("verdict")
    return t.verdict_text.select("id", osm.verdict_is_pass(v).alias("pass"), osm.verdict_is_unchecked(v).alias("unchecked"), osm.verdict_of_legacy(c("flag")).alias("legacy"))


@query("u04_merge_extracts", """SELECT DISTINCT kind, id FROM (SELECT 'w' AS kind, o_orderkey AS id FROM orders UNION ALL SELECT 'w', l_orderkey FROM lineitem UNION ALL SELECT 'n', l_partkey FROM lineitem)""")
def u04(t):
    part = lambda df, k, col: df.select(F.lit(k).alias("kind"), c(col).alias("id"))
    return ops.merge_extracts(part(t.orders, "w", "o_orderkey"), part(t.lineitem, "w", "l_orderkey"), part(t.lineitem, "n", "l_partkey"))


@query("a14_way_length", f"""SELECT l.way_id AS id, round(coalesce(sum({haversine('lat', 'lon', 'lat2', 'lon2')}), 0), 4) AS length FROM (SELECT DISTINCT way_id FROM way_node) l LEFT JOIN way_step s ON s.way_id = l.way_id GROUP BY l.way_id""")
def a14(t):
    return way_lengths(t.way_refs, t.node).select(c("way").alias("id"), F.round("length", 4).alias("length"))


_ = views
