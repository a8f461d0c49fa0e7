"""Address and feature joins, duplicates, windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from atlas.functions import geo, text
from atlas.operators import address, features, localities, network, probes
from atlas.operators.groups import dense_ids, greedy_thin, most_frequent, upper_median
from atlas.queries import views
from atlas.queries.base import query, view
from atlas.queries.filters import probe_lengths
from atlas.queries.scalars import CITY_BARE, HOUSES
from atlas.queries.spatial import INSIDE
from atlas.queries.sqltext import bearing, km, meters, name_key

c = F.col

PLACES = """pl AS (SELECT way_id, seq, node_id AS node, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY way_id) AS n, coalesce(lag(node_id) OVER w, node_id) AS before, coalesce(lead(node_id) OVER w, node_id) AS after
    FROM way_node WINDOW w AS (PARTITION BY way_id ORDER BY seq))"""
DRIVABLE = "('primary', 'residential', 'service', 'unclassified', 'living_street', 'secondary_link', 'track', 'tertiary')"


def road(t):
    return t.way.join(t.way_refs, "id")


def located(t):
    return t.feature_node.filter((c("tags")["highway"].isNotNull()) | (c("tags")["railway"].isNotNull()))


@query("j01_node_parents", f"""WITH {PLACES} SELECT way_id AS way, CAST(i AS INT) AS pos, node, before, after, i > 0 AND i < n - 1 AS interior FROM pl JOIN way_tag ON way_tag.id = way_id AND highway IN {DRIVABLE}
    WHERE node IN (SELECT id FROM node_tag WHERE highway IS NOT NULL OR railway IS NOT NULL)""")
def j01(t):
    return features.node_parents(road(t), located(t))


BEARINGS = f"""{PLACES}, brg AS (SELECT p.node, p.way_id AS way, p.i AS pos, p.i > 0 AND p.i < p.n - 1 AS interior, {bearing('a.lat', 'a.lon', 'b.lat', 'b.lon')} AS brg
      FROM pl p JOIN way_tag g ON g.id = p.way_id AND g.highway IN {DRIVABLE} JOIN node a ON a.id = p.before JOIN node b ON b.id = p.after WHERE p.before <> p.after),
    pick AS (SELECT node, count(*) FILTER (WHERE interior) AS inner_n, arg_min(brg, way * 1000 + pos) AS first, any_value(brg) FILTER (WHERE interior) AS sole FROM brg GROUP BY node),
    spread AS (SELECT b.node, max(least(abs(first - brg) % 360, 360 - abs(first - brg) % 360)) AS d FROM brg b JOIN pick USING (node) GROUP BY b.node),
    dir AS (SELECT node, CASE WHEN inner_n = 1 THEN sole WHEN d <= 30 THEN first END AS way_brg FROM pick JOIN spread USING (node))"""


@query("w04_way_direction", f"WITH {BEARINGS} SELECT node, round(way_brg, 6) AS way_brg FROM dir")
def w04(t):
    parents = features.node_parents(road(t), t.node)
    return features.way_directions(features.neighbour_bearings(parents, t.node)).select("node", F.round("way_brg", 6).alias("way_brg"))


ASSOC = """assoc AS (SELECT kind, ref, arg_min(name, rel_id) AS name FROM rel_member WHERE role = 'house' AND name IS NOT NULL GROUP BY kind, ref)"""


@query("j02_relation_member", f"WITH {ASSOC} SELECT * FROM assoc")
def j02(t):
    return address.relation_member_lookup(t.rel_member)


@query("j03_street_aliases", f"""WITH a AS (SELECT {name_key('name')} AS key, alias, min(id * 10 + pos) AS o FROM (
      SELECT id, name, unnest([name_ru, name_en]) AS alias, unnest([0, 2]) AS pos FROM way_tag WHERE name IS NOT NULL AND highway IS NOT NULL)
      WHERE alias IS NOT NULL AND length(alias) <= 80 AND {name_key('alias')} <> {name_key('name')} GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY o) AS rn FROM a)
    SELECT key, string_agg(alias, '|' ORDER BY rn) AS aliases FROM r WHERE rn <= 6 GROUP BY key""")
def j03(t):
    return address.street_alias_lookup(t.way).select("key", F.array_join("aliases", "|").alias("aliases"))


def points_of(t):
    return t.addr.select(c("oid").alias("point"), "lat", "lon", "city")


@query("j04_by_city", f"""WITH q AS (SELECT oid, lat, lon, {name_key('city')} AS k0, {name_key(CITY_BARE)} AS k1 FROM addr WHERE city IS NOT NULL),
    l AS (SELECT site, lat, lon, {name_key('name')} AS k FROM loc), d AS (SELECT oid, site, {km('q.lat', 'q.lon', 'l.lat', 'l.lon')} AS km, CASE WHEN k = k0 THEN 0 ELSE 1 END AS ko FROM q JOIN l ON l.k = q.k0 OR l.k = q.k1)
    SELECT oid AS point, arg_min(site, (km, ko, site)) AS site, round(min(km), 7) AS km FROM d WHERE km < 25 GROUP BY oid""")
def j04(t):
    sites = t.loc.select("site", "lat", "lon", "name", F.array().cast("array<string>").alias("aliases"))
    return address.by_city(points_of(t), sites).select("point", "site", F.round("km", 7).alias("km"))


ANCHORS = f"""rows AS (SELECT oid, {name_key('street')} AS skey, lat_e7, lon_e7, lat, lon, CASE WHEN oid % 3 = 0 THEN oid % 40 END AS site FROM addr WHERE street IS NOT NULL),
    anchor AS (SELECT skey, site, CAST(sum(lat_e7) AS DOUBLE) / count(*) / 1e7 AS lat, CAST(sum(lon_e7) AS DOUBLE) / count(*) / 1e7 AS lon FROM rows WHERE site IS NOT NULL GROUP BY skey, site)"""


def anchor_rows(t):
    site = F.when(c("oid") % 3 == 0, c("oid") % 40)
    return t.addr.filter("street is not null").select(c("oid").alias("point"), text.street_key(c("street")).alias("skey"), "lat_e7", "lon_e7", "lat", "lon", site.alias("site"), F.lit(1).cast("bigint").alias("weight"))


@query("a02_anchor_means", f"WITH {ANCHORS} SELECT skey, site, round(lat, 9) AS lat, round(lon, 9) AS lon FROM anchor")
def a02(t):
    return address.anchor_means(anchor_rows(t)).select("skey", "site", F.round("lat", 9).alias("lat"), F.round("lon", 9).alias("lon"))


@query("j10_anchor_join", f"""WITH {ANCHORS}, d AS (SELECT r.oid, a.site, {km('r.lat', 'r.lon', 'a.lat', 'a.lon')} AS km FROM rows r JOIN anchor a USING (skey) WHERE r.site IS NULL),
    best AS (SELECT oid, arg_min(site, (km, site)) AS site, min(km) AS km FROM d WHERE km < 3 GROUP BY oid)
    SELECT r.oid AS point, b.site, round(b.km, 7) AS km FROM rows r LEFT JOIN best b USING (oid) WHERE r.site IS NULL""")
def j10(t):
    rows = anchor_rows(t)
    return address.anchor_join(rows.filter("site is null"), address.anchor_means(rows)).select("point", "site", F.round("km", 7).alias("km"))


SPELLED = "SELECT o_custkey % 50 AS site, CASE o_orderkey % 5 WHEN 0 THEN 'Chișinău ' || CAST(o_custkey % 90 AS STRING) WHEN 1 THEN 'chisinau ' || CAST(o_custkey % 90 AS STRING) ELSE 'Supplier#' || lpad(CAST(o_custkey % 60 AS STRING), 9, '0') END AS spelled FROM orders"
view("spelled", SPELLED)


@query("a06_learned_aliases", f"""WITH s AS (SELECT site, spelled, {name_key('spelled')} AS key FROM spelled GROUP BY site, spelled HAVING count(*) >= 3),
    f AS (SELECT s.site, key, min(spelled) AS spelled FROM s JOIN loc ON loc.site = s.site WHERE key <> {name_key('name')} GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY spelled) AS rn FROM f)
    SELECT site, string_agg(spelled, '|' ORDER BY rn) AS learned FROM r WHERE rn <= 12 GROUP BY site""")
def a06(t):
    seen = t.spelled.select("site", "spelled", F.lit(1).cast("bigint").alias("n"))
    known = t.loc.select("site", "name", F.array().cast("array<string>").alias("aliases"))
    return address.learned_aliases(seen, known).select("site", F.array_join("learned", "|").alias("learned"))


STREETS = f"""st AS (SELECT oid, kind, {name_key('street')} AS skey, street, lat, lon, lat_e7, lon_e7, num FROM addr WHERE street IS NOT NULL)"""


def streets(t):
    return t.addr.filter("street is not null").withColumn("skey", text.street_key(c("street")))


@query("a03_canonical_name", f"""WITH {STREETS}, n AS (SELECT skey, street, count(*) AS n FROM st GROUP BY ALL)
    SELECT skey, street FROM (SELECT *, row_number() OVER (PARTITION BY skey ORDER BY n DESC, street) AS rn FROM n) WHERE rn = 1""")
def a03(t):
    return most_frequent(streets(t), ["skey"], "street")


@query("a04_dominant_method", f"""WITH {STREETS}, n AS (SELECT skey, CASE kind WHEN 0 THEN 'name' WHEN 1 THEN 'area' ELSE 'nearest' END AS method, count(*) AS n FROM st GROUP BY ALL)
    SELECT skey, method FROM (SELECT *, row_number() OVER (PARTITION BY skey ORDER BY n DESC, method) AS rn FROM n) WHERE rn = 1""")
def a04(t):
    method = F.element_at(F.array(F.lit("name"), F.lit("area"), F.lit("nearest")), c("kind") + 1)
    return most_frequent(streets(t).withColumn("method", method), ["skey"], "method")


@query("a05_upper_median", f"""WITH {STREETS} SELECT skey, (list_sort(list(lat_e7)))[CAST(floor(count(*) / 2) AS BIGINT) + 1] AS lat_e7, (list_sort(list(lon_e7)))[CAST(floor(count(*) / 2) AS BIGINT) + 1] AS lon_e7 FROM st GROUP BY skey""")
def a05(t):
    rows = streets(t)
    return upper_median(rows, ["skey"], "lat_e7").join(upper_median(rows, ["skey"], "lon_e7"), "skey")


# the greedy walk is a recursion over the rows of a (street, key) in order
DEDUP = f"""{HOUSES}, {STREETS}, o AS (SELECT skey, key, st.oid, kind, lat, lon, row_number() OVER (PARTITION BY skey, key ORDER BY kind, st.oid) AS rn FROM st JOIN houses h ON h.oid = st.oid),
    walk AS (SELECT skey, key, rn, [{{'oid': oid, 'lat': lat, 'lon': lon}}] AS acc FROM o WHERE rn = 1
      UNION ALL SELECT w.skey, w.key, o.rn, CASE WHEN len(list_filter(w.acc, lambda a: {meters('o.lat', 'o.lon', 'a.lat', 'a.lon')} < 50)) > 0 THEN w.acc ELSE list_append(w.acc, {{'oid': o.oid, 'lat': o.lat, 'lon': o.lon}}) END
      FROM walk w JOIN o ON o.skey = w.skey AND o.key = w.key AND o.rn = w.rn + 1),
    kept AS (SELECT skey, key, unnest(acc).oid AS oid FROM (SELECT skey, key, arg_max(acc, rn) AS acc FROM walk GROUP BY skey, key))"""


def thinned(t):
    rows = streets(t).withColumn("key", F.explode(text.house_keys(c("num")))).select("skey", "key", "kind", "oid", "lat", "lon")
    return greedy_thin(rows, ["skey", "key"], ["kind", "oid"], address.DEDUP_M, address.clash_50m)


@query("w01_greedy_dedup", f"WITH RECURSIVE {DEDUP} SELECT * FROM kept")
def w01(t):
    return thinned(t).select("skey", "key", "oid")


@query("a07_houses_per_street", f"WITH RECURSIVE {DEDUP} SELECT skey, count(*) AS houses FROM kept GROUP BY skey")
def a07(t):
    return thinned(t).groupBy("skey").agg(F.count(F.lit(1)).alias("houses"))


@query("w07_dense_ids", "SELECT point, name, row_number() OVER (ORDER BY -pop, name, point) AS id FROM pt")
def w07(t):
    return dense_ids(t.pt.select("point", "name", "pop"), [-c("pop"), c("name"), c("point")], "id").select("point", "name", "id")


@query("w09_grid_glue", """WITH g AS (SELECT point, lat, lon, round_even(lat / 0.025e0, 0) AS gy, round_even(lon / 0.025e0, 0) AS gx FROM pt),
    f AS (SELECT gy, gx, arg_min(lat, point) AS lat, arg_min(lon, point) AS lon FROM g GROUP BY gy, gx)
    SELECT lat, lon, 0.025e0 AS dlat, round(0.025e0 / greatest(0.2e0, abs(cos(radians(lat)))), 9) AS dlon FROM f""")
def w09(t):
    return network.grid_glue(t.pt.select(c("point").alias("ord"), "lat", "lon")).withColumn("dlon", F.round("dlon", 9))


# places and place areas of one country: customers inside nations' shapes
view("place_point", """SELECT 'n' || lpad(CAST(point AS STRING), 8, '0') AS pid, 'Ville ' || CAST(point % 30 AS STRING) AS name, 'Alias ' || CAST(point % 17 AS STRING) AS alias, pop % 3 * pop AS pop,
    CASE WHEN point % 6 = 0 THEN 'Q' || CAST(point % 300 AS STRING) ELSE '' END AS wikidata, CASE point % 4 WHEN 0 THEN 'Land ' || CAST(point % 5 AS STRING) || ';Reich' WHEN 1 THEN 'Kreis ' || CAST(point % 3 AS STRING) ELSE '' END AS is_in, lat, lon FROM pt""")
view("place_area", """SELECT n_nationkey AS k, 'w' || lpad(CAST(n_nationkey AS STRING), 4, '0') AS pid, 'Ville ' || CAST(n_nationkey % 12 + 20 AS STRING) AS name, 'Alias ' || CAST(n_nationkey % 30 AS STRING) AS alias FROM nation""")


def place_points(t):
    return t.place_point.withColumn("aliases", F.array("alias")).drop("alias")


def place_areas(t):
    return t.place_area.join(t.area.withColumnRenamed("pid", "k"), "k").select("pid", "name", F.array("alias").alias("aliases"), "rings")


OWNERS = f"""{INSIDE}, hit AS (SELECT a.pid AS area, p.pid AS point, CASE WHEN a.name = p.name THEN 1 WHEN a.alias = p.alias THEN 2 ELSE 3 END AS rule, count(*) OVER (PARTITION BY a.pid) AS n
      FROM inside i JOIN place_area a ON a.k = i.pid JOIN place_point p ON p.pid = 'n' || lpad(CAST(i.point AS VARCHAR), 8, '0')),
    ins AS (SELECT area, arg_min(point, (rule, point)) AS owner, min(rule) AS rule, any_value(n) AS n FROM hit GROUP BY area),
    ok AS (SELECT area, owner, rule FROM ins WHERE rule < 3 OR n = 1),
    mid AS (SELECT pid AS k, avg(x) AS x, avg(y) AS y FROM poly_vertex WHERE ring = 0 GROUP BY pid),
    held AS (SELECT m.k FROM mid m, poly_seg s WHERE s.pid = m.k AND s.xj IS NOT NULL AND ((s.yi > m.y) <> (s.yj > m.y) AND m.x < (s.xj - s.xi) * (m.y - s.yi) / (s.yj - s.yi) + s.xi) GROUP BY m.k HAVING count(*) % 2 = 1),
    ctr AS (SELECT a.pid, a.name, CASE WHEN held.k IS NULL THEN v.y ELSE mid.y END AS lat, CASE WHEN held.k IS NULL THEN v.x ELSE mid.x END AS lon FROM place_area a JOIN mid ON mid.k = a.k LEFT JOIN held ON held.k = a.k JOIN poly_vertex v ON v.pid = a.k AND v.ring = 0 AND v.ord = 0 WHERE a.pid NOT IN (SELECT area FROM ok)),
    near AS (SELECT c.pid AS area, min(p.pid) AS owner FROM ctr c JOIN place_point p ON p.name = c.name WHERE {km('c.lat', 'c.lon', 'p.lat', 'p.lon')} <= 5 GROUP BY c.pid),
    own AS (SELECT * FROM ok UNION ALL SELECT area, owner, 4 FROM near UNION ALL SELECT pid, pid, 6 FROM ctr WHERE pid NOT IN (SELECT area FROM near))"""


@query("j09_area_owner", f"WITH {OWNERS} SELECT area, owner, CAST(rule AS INT) AS rule FROM own")
def j09(t):
    points = place_points(t).select("pid", "name", "aliases", "lat", "lon")
    return localities.area_owner(points, place_areas(t))


MERGE = f"""grp AS (SELECT *, point AS k FROM (SELECT *, CAST(substr(pid, 2) AS BIGINT) % 40 AS commune, CAST(substr(pid, 2) AS BIGINT) % 5 = 4 AS area_only, CAST(substr(pid, 2) AS BIGINT) AS point FROM place_point)),
    rk AS (SELECT *, row_number() OVER (PARTITION BY commune, name ORDER BY wikidata = '', -pop, area_only, pid) AS rn FROM grp),
    s AS (SELECT * FROM rk WHERE rn = 1),
    mg AS (SELECT m.pid, s.pid AS survivor, m.rn, m.is_in, s.is_in AS s_in, m.lat, m.lon, CASE WHEN m.wikidata <> '' AND m.wikidata = s.wikidata THEN 'wikidata' WHEN m.wikidata = '' AND m.pop = 0 AND m.area_only THEN 'area'
        WHEN m.wikidata = '' AND m.pop = 0 AND (s.wikidata <> '' OR s.pop > 0) AND {km('m.lat', 'm.lon', 's.lat', 's.lon')} <= 2 THEN 'near' END AS why
      FROM rk m JOIN s ON s.commune = m.commune AND s.name = m.name WHERE m.rn > 1)"""


def with_commune(t):
    n = F.substring("pid", 2, 20).cast("bigint")
    return place_points(t).withColumn("commune", (n % 40).cast("string")).withColumn("area_only", n % 5 == 4)


@query("w02_merge_duplicates", f"""WITH {MERGE}, fin AS (SELECT * FROM mg WHERE why IS NOT NULL), firsts AS (SELECT survivor, min(rn) AS rn, arg_min(is_in, rn) AS f FROM fin WHERE is_in <> '' GROUP BY survivor)
    SELECT pid, fin.survivor, why, CASE WHEN is_in = '' THEN false ELSE coalesce(nullif(s_in, ''), CASE WHEN firsts.rn < fin.rn THEN f END, is_in) <> is_in END AS conflict FROM fin LEFT JOIN firsts ON firsts.survivor = fin.survivor""")
def w02(t):
    _, merged = localities.merge_duplicates(with_commune(t))
    return merged.select("pid", "survivor", "why", "conflict")


@query("u07_alias_union", f"""WITH {MERGE}, a AS (SELECT survivor, 'Alias ' || CAST(CAST(substr(pid, 2) AS BIGINT) % 17 AS VARCHAR) AS alias, min(rn) AS rn FROM mg WHERE why IS NOT NULL GROUP BY ALL),
    b AS (SELECT g.pid, g.alias || coalesce('|' || string_agg(a.alias, '|' ORDER BY a.rn), '') AS aliases FROM grp g LEFT JOIN a ON a.survivor = g.pid AND a.alias <> g.alias GROUP BY g.pid, g.alias)
    SELECT * FROM b WHERE pid NOT IN (SELECT pid FROM mg WHERE why IS NOT NULL)""")
def u07(t):
    kept, _ = localities.merge_duplicates(with_commune(t))
    return kept.select("pid", F.array_join("aliases", "|").alias("aliases"))


@query("a21_same_name_census", "SELECT name, CAST(substr(pid, 2) AS BIGINT) % 40 AS commune, count(*) AS n FROM place_point GROUP BY ALL HAVING count(*) > 1")
def a21(t):
    rows = t.place_point.select("name", (F.substring("pid", 2, 20).cast("bigint") % 40).alias("commune"))
    return localities.same_name_census(rows)


VERTS = """v AS (SELECT way_id AS way, node_id AS node, lat, lon FROM way_node JOIN node ON node.id = node_id),
    bv AS (SELECT DISTINCT way AS bridge, name AS b_name, lat, lon FROM v JOIN way_tag g ON g.id = way WHERE coalesce(highway, '') NOT LIKE '%link' AND bridge IS NOT NULL AND layer = '1'),
    rv AS (SELECT DISTINCT way AS road, name AS r_name, lat, lon FROM v JOIN way_tag g ON g.id = way WHERE coalesce(highway, '') NOT LIKE '%link' AND bridge IS NULL AND tunnel IS NULL),
    pr AS (SELECT bridge, road, sqrt(pow((b.lat - r.lat) * 111320e0, 2) + pow((b.lon - r.lon) * 111320e0 * cos(radians(b.lat)), 2)) AS separation, b.lat AS b_lat, b.lon AS b_lon, r.lat AS r_lat, r.lon AS r_lon
      FROM bv b JOIN rv r ON abs(b.lat - r.lat) < 0.001 AND abs(b.lon - r.lon) < 0.002 WHERE b_name IS DISTINCT FROM r_name OR b_name IS NULL),
    ok AS (SELECT * FROM pr WHERE separation BETWEEN 25 AND 80 AND NOT EXISTS (SELECT 1 FROM way_node x JOIN way_node y ON x.node_id = y.node_id WHERE x.way_id = bridge AND y.way_id = road)),
    best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY bridge ORDER BY separation, road, b_lat, b_lon, r_lat, r_lon) AS rn FROM ok) WHERE rn = 1)"""
COLS = "bridge, road, round(separation, 5) AS separation, b_lat, b_lon, r_lat, r_lon"


def vertices(t):
    return t.way_node.select(c("way_id").alias("way"), c("seq").alias("idx"), c("node_id").alias("node")).join(t.node.select(c("id").alias("node"), "lat", "lon"), "node")


def pairs(t):
    return probes.grade_separation_pairs(t.way, vertices(t))


@query("j21_grade_separation", f"WITH {VERTS} SELECT {COLS} FROM best")
def j21(t):
    return pairs(t).withColumn("separation", F.round("separation", 5))


@query("j22_interchange_exclusion", f"""WITH {VERTS}, ramp AS (SELECT DISTINCT lat, lon FROM v JOIN way_tag g ON g.id = way WHERE highway LIKE '%link')
    SELECT {COLS} FROM best WHERE NOT EXISTS (SELECT 1 FROM ramp q WHERE sqrt(pow((b_lat - q.lat) * 111320e0, 2) + pow((b_lon - q.lon) * 111320e0 * cos(radians(b_lat)), 2)) <= 150)""")
def j22(t):
    return probes.interchange_exclusion(pairs(t), t.way, vertices(t)).withColumn("separation", F.round("separation", 5))


@query("t03_bridge_top", f"WITH {VERTS} SELECT bridge, CAST(round_even(separation, 0) AS INT) AS separation_m FROM best ORDER BY 2 DESC, 1 LIMIT 20")
def t03(t):
    return probes.bridge_top(pairs(t)).select("bridge", "separation_m")


@query("t04_closest_to_400m", "SELECT id, name, round(length, 4) AS length FROM way_tag JOIN way_len ON way_id = id WHERE oneway IN ('yes', '-1') AND name IS NOT NULL AND length BETWEEN 200 AND 900 ORDER BY abs(length - 400), id LIMIT 1")
def t04(t):
    return probes.closest_to_400m(t.way.join(probe_lengths(t), "id")).withColumn("length", F.round("length", 4))


view("driven", "SELECT o_orderkey AS bridge, CAST(o_custkey % 60 + 25 AS INT) AS separation_m, CASE WHEN o_orderkey % 9 > 0 THEN CAST(floor(o_totalprice) AS BIGINT) % 9000 END AS driven_m FROM orders")
RANKED = "SELECT bridge, CASE WHEN driven_m IS NULL THEN 'no route' WHEN driven_m > 8000 THEN 'implausibly far' WHEN driven_m / separation_m < 5 THEN 'connected nearby' ELSE 'usable' END AS verdict, round(driven_m / separation_m, 7) AS ratio FROM driven"


@query("t05_candidate_rank", RANKED)
def t05(t):
    return probes.candidate_rank(t.driven).select("bridge", "verdict", F.round("ratio", 7).alias("ratio"))


@query("p12_verify_candidates", f"WITH r AS ({RANKED}) SELECT verdict, count(*) AS n, max(ratio) AS best FROM r GROUP BY verdict")
def p12(t):
    return probes.candidate_rank(t.driven).groupBy("verdict").agg(F.count(F.lit(1)).alias("n"), F.round(F.max("ratio"), 7).alias("best"))


@query("p11_probe_candidates", f"""WITH {VERTS}, ramp AS (SELECT DISTINCT lat, lon FROM v JOIN way_tag g ON g.id = way WHERE highway LIKE '%link'),
    keep AS (SELECT * FROM best WHERE NOT EXISTS (SELECT 1 FROM ramp q WHERE sqrt(pow((b_lat - q.lat) * 111320e0, 2) + pow((b_lon - q.lon) * 111320e0 * cos(radians(b_lat)), 2)) <= 150)),
    top AS (SELECT bridge, CAST(round_even(separation, 0) AS INT) AS metres FROM keep ORDER BY 2 DESC, 1 LIMIT 20),
    one AS (SELECT id AS bridge, CAST(round_even(length, 0) AS INT) AS metres FROM way_tag JOIN way_len ON way_id = id WHERE oneway IN ('yes', '-1') AND name IS NOT NULL AND length BETWEEN 200 AND 900 ORDER BY abs(length - 400), id LIMIT 1)
    SELECT 'grade_separation' AS kind, * FROM top UNION ALL SELECT 'oneway', * FROM one""")
def p11(t):
    from atlas.plans.probes import find_probe_candidates
    return find_probe_candidates(t.way.join(probe_lengths(t), "id"), vertices(t)).select("kind", "bridge", "metres")


_ = (geo, views)
