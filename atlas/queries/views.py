"""Map-shaped views over the driver's tables (positions, places, areas, addresses, ways, borders)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlas.queries.base import Tables, view

# Ring templates of a nation's area in e7 degrees from its corner: an L and a square hole.
RINGS = (
    ((0, 0), (4613000, 17000), (4600000, 2300000), (2300000, 2307000), (2290000, 4600000), (0, 4600000), (0, 0)),
    ((500000, 500000), (1500000, 500000), (1500000, 1500000), (500000, 1500000), (500000, 500000)),
)
KINDS = ("city", "town", "village", "hamlet")

view("li", """SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey, min(l_suppkey) AS l_suppkey,
       CAST(min(l_quantity) AS BIGINT) AS qty, min(l_shipdate) AS l_shipdate, min(l_returnflag) AS flag
     FROM lineitem GROUP BY l_orderkey, l_linenumber""")

view("pt", """SELECT point, name, pop, lat_e7, lon_e7, lat_e7 / 1e7 AS lat, lon_e7 / 1e7 AS lon FROM (
       SELECT c_custkey AS point, c_name AS name, CAST(floor(abs(c_acctbal)) AS BIGINT) AS pop,
              CAST(470000137 + (c_custkey * 7919 % 20000) * 1000 AS INT) AS lat_e7,
              CAST(280000291 + (c_custkey * 104729 % 20000) * 1000 AS INT) AS lon_e7 FROM customer)""")

view("loc", """SELECT site, name, pop, kind_rank, lat_e7, lon_e7, lat_e7 / 1e7 AS lat, lon_e7 / 1e7 AS lon FROM (
       SELECT s_suppkey AS site, s_name AS name, CAST(floor(abs(s_acctbal)) AS BIGINT) AS pop,
              CAST(s_suppkey % 4 AS INT) AS kind_rank,
              CAST(470004321 + (s_suppkey * 6151 % 2000) * 10000 AS INT) AS lat_e7,
              CAST(280008765 + (s_suppkey * 7907 % 2000) * 10000 AS INT) AS lon_e7 FROM supplier)""")

_TEMPLATE = ", ".join(f"({r}, {i}, {dx}, {dy})" for r, ring in enumerate(RINGS) for i, (dx, dy) in enumerate(ring))

view("poly_vertex", f"""SELECT n_nationkey AS pid, ring, ord,
       (280000000 + (n_nationkey % 5) * 4000000 + dx // 100 * (100 + n_nationkey % 7)) / 1e7 AS x,
       (470000000 + CAST(floor(n_nationkey / 5) AS INT) * 4000000 + dy // 100 * (100 + n_nationkey % 7)) / 1e7 AS y
     FROM nation, (VALUES {_TEMPLATE}) AS t(ring, ord, dx, dy)""",
     lambda t: t.area.select("pid", F.posexplode("rings").alias("ring", "r"))
     .select("pid", "ring", F.posexplode("r").alias("ord", "v")).select("pid", "ring", "ord", "v.x", "v.y"))

view("poly_seg", """SELECT pid, ring, ord, lag(x) OVER w AS xj, lag(y) OVER w AS yj, x AS xi, y AS yi
     FROM poly_vertex WINDOW w AS (PARTITION BY pid, ring ORDER BY ord)""")


def area(t: Tables) -> DataFrame:
    k = F.col("n_nationkey")
    x0 = F.lit(280000000) + (k % 5) * 4000000
    y0 = F.lit(470000000) + F.floor(k / 5).cast("int") * 4000000
    grow = F.lit(100) + k % 7
    vertex = lambda dx, dy: F.struct(((x0 + dx // 100 * grow) / 1e7).alias("x"), ((y0 + dy // 100 * grow) / 1e7).alias("y"))
    rings = F.array(*[F.array(*[vertex(*v) for v in ring]) for ring in RINGS])
    return t.nation.select(k.alias("pid"), rings.alias("rings"))


view("area", "SELECT n_nationkey AS pid FROM nation", area)

# border nodes of up to seven countries: same orders seen by several countries, some moved, some unnamed
view("fr", """SELECT country, CAST(level AS INT) AS level, CAST(lat_e7 AS INT) AS lat_e7, CAST(lon_e7 AS INT) AS lon_e7,
       l_orderkey * 8 + level AS local_id, osm, l_orderkey FROM (
     SELECT 'C' || CAST(l_linenumber AS STRING) AS country, l_orderkey, l_orderkey % 3 AS level,
            470000000 + (l_orderkey * 7919 % 200000) * 100
              + CASE WHEN l_linenumber % 2 = 0 THEN CASE l_orderkey % 7 WHEN 0 THEN 180 WHEN 1 THEN 440 WHEN 2 THEN 462 ELSE 0 END ELSE 0 END AS lat_e7,
            280000000 + (l_orderkey * 104729 % 50) * 100 AS lon_e7,
            CASE WHEN (l_orderkey + l_linenumber) % 5 = 0 THEN NULL WHEN l_orderkey % 11 = 0 THEN l_orderkey - l_orderkey % 2 * 3 ELSE l_orderkey END AS osm
     FROM li)""")

# its countries; grouping the lines of an order adds none and takes none away
view("fr_country", "SELECT DISTINCT 'C' || CAST(l_linenumber AS STRING) AS country FROM lineitem")

# addressed objects: an order is a house near its customer's position
view("addr", """SELECT oid, kind, street, place, city, num, rel_id, lat_e7, lon_e7, lat_e7 / 1e7 AS lat, lon_e7 / 1e7 AS lon
     FROM (SELECT o_orderkey AS oid, CAST(o_orderkey % 3 AS INT) AS kind,
       CASE WHEN o_orderkey % 13 IN (0, 1) THEN NULL
            WHEN o_orderkey % 3 = 0 THEN 'Str. ' || o_orderpriority || '  Bătrân ' || CAST(o_custkey % 37 AS STRING)
            ELSE 'STR ' || o_orderpriority || '-bătrân ' || CAST(o_custkey % 37 AS STRING) END AS street,
       CASE WHEN o_orderkey % 13 = 0 THEN 'Place ' || CAST(o_custkey % 11 AS STRING) END AS place,
       CASE WHEN o_orderkey % 4 = 0 THEN 'or. Supplier#' || lpad(CAST(o_custkey % 100 AS STRING), 9, '0')
            WHEN o_orderkey % 4 = 1 THEN 'Elsewhere ' || CAST(o_custkey % 50 AS STRING) END AS city,
       CAST(o_orderkey % 40 + 1 AS STRING) || CASE o_orderkey % 6 WHEN 0 THEN 'А' WHEN 1 THEN ';' || CAST(o_orderkey % 9 AS STRING) || ' b' WHEN 2 THEN '/7' ELSE '' END AS num,
       CASE WHEN o_orderkey % 13 IN (1, 2) THEN o_custkey END AS rel_id,
       CAST(470000137 + (o_custkey * 7919 % 20000) * 1000 + o_orderkey * 31 % 900 * 10 AS INT) AS lat_e7,
       CAST(280000291 + (o_custkey * 104729 % 20000) * 1000 + o_orderkey * 17 % 700 * 10 AS INT) AS lon_e7
     FROM orders)""")

# members of house relations: each customer's relation lists the houses that name it
view("rel_member", """SELECT o_custkey AS rel_id, CAST(o_orderkey % 3 AS INT) AS kind, o_orderkey AS ref,
       CASE WHEN o_orderkey % 17 = 0 THEN 'street' ELSE 'house' END AS role,
       CASE WHEN o_custkey % 19 = 0 THEN NULL ELSE 'Rel Street ' || CAST(o_custkey % 23 AS STRING) END AS name
     FROM orders WHERE o_orderkey % 13 < 3
     UNION ALL
     SELECT o_custkey + 7 AS rel_id, CAST(o_orderkey % 3 AS INT) AS kind, o_orderkey AS ref, 'house' AS role,
       'Second Street ' || CAST(o_custkey % 5 AS STRING) AS name FROM orders WHERE o_orderkey % 13 = 1""")

# road network: an order is a way through the parts of its lines; a part is a node
view("node", """SELECT p_partkey AS id, CAST(470000000 + (p_partkey * 7919 % 3000) * 150 AS INT) AS lat_e7,
       CAST(280000000 + (p_partkey * 104729 % 3000) * 220 AS INT) AS lon_e7, p_name, p_size,
       (470000000 + (p_partkey * 7919 % 3000) * 150) / 1e7 AS lat, (280000000 + (p_partkey * 104729 % 3000) * 220) / 1e7 AS lon
     FROM part""")

view("way_node", """SELECT l_orderkey AS way_id, l_linenumber AS seq, l_partkey AS node_id FROM li""")

view("way_tag", """SELECT o_orderkey AS id,
       CASE o_orderkey % 9 WHEN 0 THEN 'primary' WHEN 1 THEN 'residential' WHEN 2 THEN 'service' WHEN 3 THEN 'footway'
            WHEN 4 THEN 'unclassified' WHEN 5 THEN CASE WHEN o_orderkey % 117 = 5 THEN 'secondary_link' ELSE 'living_street' END WHEN 6 THEN 'track' WHEN 7 THEN NULL ELSE 'tertiary' END AS highway,
       CASE o_orderkey % 5 WHEN 0 THEN 'yes' WHEN 1 THEN '-1' WHEN 2 THEN 'no' END AS oneway,
       CASE WHEN o_orderkey % 4 = 0 THEN 'Strada Șt' || CAST(o_custkey % 41 AS STRING) WHEN o_orderkey % 4 = 1 THEN 'Улица Семёнов' || CAST(o_custkey % 41 AS STRING) END AS name,
       CASE WHEN o_orderkey % 7 = 0 THEN 'ferry' END AS route,
       CASE o_orderkey % 10 WHEN 0 THEN 'no' WHEN 1 THEN 'private' WHEN 2 THEN 'yes' END AS motor_vehicle,
       CASE o_orderkey % 11 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' END AS motorcar,
       CASE o_orderkey % 8 WHEN 0 THEN 'private' WHEN 1 THEN 'permissive' END AS access,
       CASE WHEN o_orderkey % 12 = 0 THEN 'parking_aisle' WHEN o_orderkey % 12 = 1 THEN 'alley' END AS service,
       CASE WHEN o_orderkey % 6 = 0 THEN 'roundabout' END AS junction,
       CASE o_orderkey % 14 WHEN 0 THEN 'lane' WHEN 1 THEN 'opposite_lane' END AS busway,
       CASE WHEN o_orderkey % 15 = 0 THEN 'lane' END AS busway_left,
       CASE o_orderkey % 16 WHEN 0 THEN '1' WHEN 1 THEN '0' WHEN 2 THEN ' 2 ' WHEN 3 THEN 'two' END AS lanes_bus,
       CASE o_orderkey % 18 WHEN 0 THEN '1' WHEN 1 THEN 'x' END AS lanes_psv_backward,
       CASE WHEN o_orderkey % 20 = 0 THEN 'yes' WHEN o_orderkey % 20 = 1 THEN 'viaduct' END AS bridge,
       CASE WHEN o_orderkey % 3 = 0 THEN '1' END AS layer,
       CASE WHEN o_orderkey % 21 = 5 THEN 'yes' END AS tunnel,
       CASE WHEN o_orderkey % 4 = 0 THEN 'Stefan ' || CAST(o_custkey % 6 AS STRING) END AS name_en,
       CASE WHEN o_orderkey % 4 < 2 THEN 'Штефан ' || CAST(o_custkey % 6 AS STRING) END AS name_ru
     FROM orders""")

WAY_TAG_KEYS = {"highway": "highway", "oneway": "oneway", "name": "name", "route": "route",
                "motor_vehicle": "motor_vehicle", "motorcar": "motorcar", "access": "access",
                "service": "service", "junction": "junction", "busway": "busway",
                "busway_left": "busway:left", "lanes_bus": "lanes:bus",
                "lanes_psv_backward": "lanes:psv:backward", "bridge": "bridge", "layer": "layer",
                "tunnel": "tunnel", "name_en": "name:en", "name_ru": "name:ru"}


def way(t: Tables) -> DataFrame:
    return t.way_tag.select("id", tags_of(WAY_TAG_KEYS))


def tags_of(keys: dict[str, str]):
    """Columns → one tag map, absent values left out."""
    full = F.create_map(*[x for c, k in keys.items() for x in (F.lit(k), F.col(c))])
    return F.map_filter(full, lambda k, v: v.isNotNull()).alias("tags")


view("way", "SELECT id FROM way_tag", way)


def way_refs(t: Tables) -> DataFrame:
    """Ways with their ordered node ids (a way's refs are one value of the input format)."""
    seq = F.array_sort(F.collect_list(F.struct("seq", "node_id")))
    return t.way_node.groupBy(F.col("way_id").alias("id")).agg(F.transform(seq, lambda r: r["node_id"]).alias("refs"))


view("way_refs", "SELECT way_id AS id, list(node_id ORDER BY seq) AS refs FROM way_node GROUP BY way_id", way_refs)

# relations: a customer's relation holds its orders as ways and, for every third, a part as node
view("rel_item", """SELECT o_custkey AS id, 'w' AS type, o_orderkey AS ref, o_orderstatus AS role, o_orderkey AS pos FROM orders
     UNION ALL SELECT o_custkey, 'n', o_orderkey % 1500, 'label', o_orderkey FROM orders WHERE o_orderkey % 3 = 0""")
view("rel_tag", """SELECT c_custkey AS id, CASE c_custkey % 4 WHEN 0 THEN 'boundary' WHEN 1 THEN 'multipolygon' WHEN 2 THEN 'restriction' END AS type,
       CASE WHEN c_custkey % 3 <> 2 THEN 'administrative' END AS boundary, CAST(c_nationkey % 9 AS STRING) AS admin_level,
       CASE WHEN c_custkey % 5 > 0 THEN c_name END AS name FROM customer""")


def relation(t: Tables) -> DataFrame:
    member = F.array_sort(F.collect_list(F.struct("pos", "type", "ref", "role")))
    members = t.rel_item.groupBy("id").agg(F.transform(member, lambda m: F.struct(m["type"].alias("type"), m["ref"].alias("ref"), m["role"].alias("role"))).alias("members"))
    tagged = t.rel_tag.select("id", tags_of({"type": "type", "boundary": "boundary", "admin_level": "admin_level", "name": "name"}))
    return tagged.join(members, "id", "left").withColumn("members", F.coalesce("members", F.array().cast("array<struct<type:string,ref:bigint,role:string>>")))


view("relation", "SELECT id FROM rel_tag", relation)
view("full_way", "SELECT id FROM way_tag", lambda t: t.way.join(t.way_refs, "id"))

# decoded tile features
view("tf", """SELECT o_orderkey AS id, CASE o_orderkey % 3 WHEN 0 THEN 'places' WHEN 1 THEN 'roads' ELSE 'pois' END AS layer,
       CASE WHEN o_orderkey % 8 < 6 THEN 'Name ' || CAST(o_custkey % 60 AS STRING) END AS name,
       CASE WHEN o_orderkey % 5 = 0 THEN 'Naïve ' || CAST(o_custkey % 60 AS STRING) END AS name_en,
       CASE WHEN o_orderkey % 7 = 0 THEN 'Имя ' || CAST(o_custkey % 60 AS STRING) END AS name_ru,
       CASE o_orderkey % 3 WHEN 0 THEN CASE o_custkey % 4 WHEN 0 THEN 'locality' WHEN 1 THEN 'region' WHEN 2 THEN 'island' ELSE 'borough' END
         WHEN 1 THEN CASE o_custkey % 4 WHEN 0 THEN 'major_road' WHEN 1 THEN 'path' WHEN 2 THEN 'highway' ELSE 'minor_road' END
         ELSE CASE o_custkey % 6 WHEN 0 THEN 'charging_station' WHEN 1 THEN 'cafe' WHEN 2 THEN 'bench' WHEN 3 THEN 'pharmacy' WHEN 4 THEN 'atm' END END AS kind,
       CASE WHEN o_orderkey % 4 = 0 THEN CAST(floor(o_totalprice) AS BIGINT) END AS population,
       (470000000 + (o_custkey * 7919 % 300) * 1000 + o_orderkey % 7 * 100) / 1e7 AS lat, (280000000 + (o_custkey * 104729 % 300) * 1000 + o_orderkey % 5 * 100) / 1e7 AS lon
     FROM orders""")


def tile_feature(t: Tables) -> DataFrame:
    keys = {"name": "name", "name_en": "name:en", "name_ru": "name:ru", "kind": "kind"}
    return t.tf.select("id", "layer", tags_of(keys).alias("attrs"), "population", "lat", "lon")


view("tile_feature", "SELECT id FROM tf", tile_feature)

# tagged nodes and enforcement relations
view("node_tag", """SELECT p_partkey AS id, CASE p_partkey % 12 WHEN 0 THEN 'speed_camera' WHEN 1 THEN 'traffic_signals' WHEN 2 THEN 'traffic_signals' END AS highway,
       CASE p_partkey % 12 WHEN 3 THEN 'level_crossing' WHEN 4 THEN 'tram_level_crossing' WHEN 5 THEN 'crossing' END AS railway,
       CASE p_size % 7 WHEN 0 THEN 'forward' WHEN 1 THEN 'backward' WHEN 2 THEN '90;270' WHEN 3 THEN 'NE' WHEN 4 THEN 'both' WHEN 5 THEN '0-90' END AS direction,
       CASE p_size % 5 WHEN 0 THEN 'forward' WHEN 1 THEN '45' END AS sig_direction, CASE WHEN p_size % 3 = 0 THEN 'signal;ü' END AS signals,
       CASE p_size % 4 WHEN 0 THEN '50' WHEN 1 THEN '30 mph' WHEN 2 THEN 'none' END AS maxspeed FROM part""")
view("enf_item", """SELECT l_orderkey AS id, l_linenumber AS pos, CASE WHEN l_linenumber = 4 THEN 'w' ELSE 'n' END AS type, CASE WHEN l_linenumber = 4 THEN l_orderkey % 500 ELSE l_partkey * 2 END AS ref,
       CASE l_linenumber WHEN 1 THEN 'from' WHEN 2 THEN 'device' WHEN 3 THEN 'to' WHEN 4 THEN 'section' WHEN 5 THEN 'from' ELSE 'device' END AS role FROM li""")
view("enf_tag", """SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN 'maxspeed' WHEN 1 THEN 'traffic_signals' WHEN 2 THEN 'average_speed' ELSE 'mindistance' END AS kind,
       CASE o_custkey % 3 WHEN 0 THEN '60' WHEN 1 THEN '40 mph' END AS maxspeed FROM orders""")


def feature_node(t: Tables) -> DataFrame:
    keys = {"highway": "highway", "railway": "railway", "direction": "direction", "sig_direction": "traffic_signals:direction",
            "signals": "traffic_signals", "maxspeed": "maxspeed"}
    return t.node.select("id", "lat", "lon").join(t.node_tag.select("id", tags_of(keys)), "id")


def enforcement(t: Tables) -> DataFrame:
    member = F.array_sort(F.collect_list(F.struct("pos", "type", "ref", "role")))
    members = t.enf_item.groupBy("id").agg(F.transform(member, lambda m: F.struct(m["type"].alias("type"), m["ref"].alias("ref"), m["role"].alias("role"))).alias("members"))
    tags = t.enf_tag.select("id", F.lit("enforcement").alias("type"), "kind", "maxspeed").select("id", tags_of({"type": "type", "kind": "enforcement", "maxspeed": "maxspeed"}))
    return tags.join(members, "id")


view("feature_node", "SELECT id FROM node_tag", feature_node)
view("enforcement", "SELECT id FROM enf_tag", enforcement)
