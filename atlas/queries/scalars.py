"""Scalar functions X1–X36 over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from atlas.functions import geo, osm, text
from atlas.queries import views  # noqa: F401
from atlas.queries.base import query, view
from atlas.queries.sqltext import (
    bearing,
    cardinal_case,
    fold,
    half_even,
    haversine,
    km,
    meters,
    name_key,
)

c = F.col


@query("x01_fold", f"SELECT doc_id, md5({fold('text')}) AS folded, length({fold('text')}) AS n FROM documents")
def x01(t):
    f = text.fold(c("text"))
    return t.documents.select("doc_id", F.md5(f).alias("folded"), F.length(f).cast("bigint").alias("n"))


@query("x02_name_key", f"""SELECT 'document' AS what, doc_id AS id, md5({name_key('text')}) AS key FROM documents
       UNION ALL SELECT 'turn', conv_id * 1000 + turn, md5({name_key('text')}) FROM conversations""")
def x02(t):
    docs = t.documents.select(F.lit("document").alias("what"), c("doc_id").alias("id"), "text")
    turns = t.conversations.select(F.lit("turn").alias("what"), (c("conv_id") * 1000 + c("turn")).alias("id"), "text")
    return docs.unionByName(turns).select("what", "id", F.md5(text.name_key(c("text"))).alias("key"))


HOUSE_LIST = rf"""list_filter(list_transform(string_split_regex(num, '[;,]'),
    lambda p: translate(replace(regexp_replace({fold('p')}, '\s+', '', 'g'), '\', '/'), 'авекмнорстух', 'abekmhopctyx')),
    lambda k: regexp_matches(k, '[0-9]') AND length(k) <= 16)"""
HOUSES = f"""houses AS (SELECT oid, num, lower(keys[i]) AS key, i FROM (
    SELECT oid, num, list_filter(l, lambda x, j: list_position(l, x) = j) AS keys FROM (SELECT oid, num, {HOUSE_LIST} AS l FROM addr)),
    unnest(range(1, len(keys) + 1)) AS u(i))"""


@query("x03_house_keys", f"WITH {HOUSES} SELECT oid, string_agg(key, '|' ORDER BY i) AS keys FROM houses GROUP BY oid")
def x03(t):
    return t.addr.select("oid", F.array_join(text.house_keys(c("num")), "|").alias("keys"))


@query("x04_house_display", rf"""WITH {HOUSES}
    SELECT oid, key, coalesce((list_filter(list_transform(string_split_regex(num, '[;,]'), lambda p: trim(p)),
      lambda p: translate(replace(regexp_replace({fold('p')}, '\s+', '', 'g'), '\', '/'), 'авекмнорстух', 'abekmhopctyx') = key))[1], key) AS shown
    FROM houses""")
def x04(t):
    keyed = t.addr.select("oid", "num", F.explode(text.house_keys(c("num"))).alias("key"))
    return keyed.select("oid", "key", text.house_display(c("num"), c("key")).alias("shown"))


@query("x05_osm_code", "SELECT oid, kind, oid * 4 + kind AS code FROM addr")
def x05(t):
    letter = F.element_at(F.array(F.lit("n"), F.lit("w"), F.lit("r")), c("kind") + 1)
    return t.addr.select("oid", "kind", osm.osm_code(letter, c("oid")).alias("code"))


@query("x06_flat_distances", f"""SELECT point, round({meters('lat', 'lon', '(lat + 0.013e0)', '(lon - 0.021e0)')}, 5) AS m,
    round({km('lat', 'lon', '(lat + 0.013e0)', '(lon - 0.021e0)')}, 8) AS km,
    round(sqrt(pow(-0.013e0 * 111320e0, 2) + pow(0.021e0 * 111320e0 * cos(radians(lat)), 2)), 5) AS probe FROM pt""")
def x06(t):
    args = (c("lat"), c("lon"), c("lat") + 0.013, c("lon") - 0.021)
    return t.pt.select("point", F.round(geo.meters(*args), 5).alias("m"), F.round(geo.km(*args), 8).alias("km"),
                       F.round(geo.probe_metres(*args), 5).alias("probe"))


@query("x07_haversine", f"""SELECT point, round({haversine('lat', 'lon', '(lat + 0.3e0)', '(lon - 0.7e0)')}, 4) AS m,
    round({haversine('lat', 'lon', '(lat + 0.3e0)', '(lon - 0.7e0)', 6371.0)}, 7) AS km FROM pt""")
def x07(t):
    args = (c("lat"), c("lon"), c("lat") + 0.3, c("lon") - 0.7)
    return t.pt.select("point", F.round(geo.haversine(*args), 4).alias("m"),
                       F.round(geo.haversine(*args, geo.EARTH_KM), 7).alias("km"))


@query("x08_bearing", f"SELECT point, round({bearing('lat', 'lon', '48e0', '29e0')}, 8) AS brg FROM pt")
def x08(t):
    return t.pt.select("point", F.round(geo.bearing(c("lat"), c("lon"), F.lit(48.0), F.lit(29.0)), 8).alias("brg"))


@query("x09_angle_diff", """SELECT event_id, round(least(d, 360e0 - d), 6) AS diff
    FROM (SELECT event_id, abs(value * 7 - user_id * 11) % 360e0 AS d FROM events)""")
def x09(t):
    return t.events.select("event_id", F.round(geo.angle_diff(c("value") * 7, (c("user_id") * 11).cast("double")), 6).alias("diff"))


@query("x10_destination", """WITH r AS (SELECT point, lat, lon, m, b FROM pt, (VALUES (1500e0), (4000e0)) AS m(m), range(0, 360, 45) AS g(b))
    SELECT point, CAST(m AS INT) AS m, CAST(b AS INT) AS b, round(degrees(la2), 8) AS lat,
      round(degrees(radians(lon) + atan2(sin(radians(b)) * sin(d) * cos(radians(lat)), cos(d) - sin(radians(lat)) * sin(la2))), 8) AS lon
    FROM (SELECT *, m / 6371000e0 AS d, asin(sin(radians(lat)) * cos(m / 6371000e0) + cos(radians(lat)) * sin(m / 6371000e0) * cos(radians(b))) AS la2 FROM r)""")
def x10(t):
    ring = (t.pt.withColumn("m", F.explode(F.array(F.lit(1500), F.lit(4000))))
            .withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(315), F.lit(45)))))
    d = geo.destination(c("lat"), c("lon"), c("m").cast("double"), c("b").cast("double"))
    return ring.select("point", "m", "b", F.round(d["lat"], 8).alias("lat"), F.round(d["lon"], 8).alias("lon"))


view("speed_text", """SELECT o_orderkey AS id, CASE o_orderkey % 6 WHEN 0 THEN CAST(o_orderkey % 130 AS STRING)
      WHEN 1 THEN CAST(o_orderkey % 90 AS STRING) || ' mph' WHEN 2 THEN 'RO:urban' WHEN 3 THEN CAST(o_orderkey % 60 AS STRING) || '.5'
      WHEN 4 THEN ' ' || CAST(o_orderkey % 70 AS STRING) || 'mph ' END AS raw,
    CASE o_orderkey % 9 WHEN 0 THEN 'forward' WHEN 1 THEN 'reverse' WHEN 2 THEN 'both' WHEN 3 THEN '-' || CAST(o_orderkey % 400 AS STRING)
      WHEN 4 THEN CAST(o_orderkey % 720 AS STRING) || '.25; 270' WHEN 5 THEN 'nne;SW' WHEN 6 THEN '0-90' WHEN 7 THEN 'E;' || CAST(o_orderkey % 360 AS STRING) END AS dir
    FROM orders""")


SPEED = r"^\s*(\d+(?:\.\d+)?)\s*(mph)?\s*$"


@query("x11_maxspeed", f"""SELECT id, CAST({half_even(f"CAST(nullif(regexp_extract(raw, '{SPEED}', 1), '') AS DOUBLE) * CASE WHEN raw LIKE '%mph%' THEN 1.609344e0 ELSE 1e0 END")} AS INT) AS kmh FROM speed_text""")
def x11(t):
    return t.speed_text.select("id", osm.maxspeed_kmh(c("raw")).alias("kmh"))


@query("x12_direction", rf"""WITH parts AS (SELECT id, dir, string_split(dir, ';') AS p FROM speed_text),
    d AS (SELECT id, dir, list_transform(p, lambda x: CASE WHEN regexp_matches(trim(x), '^-?\d+(\.\d+)?$') THEN ((TRY_CAST(trim(x) AS DOUBLE) % 360) + 360) % 360 ELSE {cardinal_case('trim(x)')} END) AS degs FROM parts),
    s AS (SELECT id, degs, CASE WHEN dir = 'forward' THEN 'fwd' WHEN dir IN ('backward', 'reverse') THEN 'bwd' WHEN dir = 'both' THEN 'both'
       WHEN dir IS NOT NULL AND len(list_filter(degs, lambda x: x IS NULL)) = 0 THEN CASE WHEN regexp_matches(trim(string_split(dir, ';')[1]), '^-?\d+(\.\d+)?$') THEN 'deg' ELSE 'card' END END AS src FROM d)
    SELECT id, src, CASE WHEN src IN ('deg', 'card') THEN CAST(round(list_sum(degs), 6) AS DOUBLE) END AS total, CASE WHEN src IN ('deg', 'card') THEN degs[1] END AS first FROM s""")
def x12(t):
    d = osm.parse_direction(c("dir"))
    total = F.round(F.aggregate(d["degrees"], F.lit(0.0), lambda s, v: s + v), 6)
    return t.speed_text.select("id", d["src"].alias("src"), total.alias("total"), d["degrees"][0].alias("first"))


LANES = r"CASE WHEN regexp_matches(trim({0}), '^\d+$') THEN CAST(trim({0}) AS BIGINT) ELSE 0 END"
BUS_SIDE = f"""CASE WHEN l AND r THEN 'both' WHEN r THEN 'right' WHEN l THEN 'left' END FROM (
    SELECT id, coalesce(busway = 'lane', false) OR {LANES.format("coalesce(lanes_bus, '')")} >= 1 AS r,
    coalesce(busway_left = 'lane', false) OR {LANES.format("coalesce(lanes_psv_backward, '')")} >= 1 AS l FROM way_tag)"""


@query("x13_bus_lane_side", f"SELECT id, {BUS_SIDE.replace('END FROM', 'END AS side FROM')}")
def x13(t):
    return t.way.select("id", osm.bus_lane_side(c("tags")).alias("side"))


@query("x14_oneway", """SELECT id, CAST(CASE WHEN oneway IN ('yes', 'true', '1') THEN 1 WHEN oneway IN ('-1', 'reverse') THEN -1
    WHEN junction = 'roundabout' AND coalesce(oneway, '') NOT IN ('no', 'false', '0') THEN 1 ELSE 0 END AS INT) AS dir FROM way_tag""")
def x14(t):
    return t.way.select("id", osm.oneway_of(c("tags")).alias("dir"))


@query("x15_promote_tags", """SELECT id, 'tertiary' AS highway, CASE WHEN service = 'parking_aisle' THEN NULL ELSE service END AS service,
    CASE WHEN service = 'parking_aisle' THEN service END AS parked, service AS undone FROM way_tag""")
def x15(t):
    lifted = t.way.select("id", osm.promote_tags(c("tags")).alias("tags"))
    return lifted.select("id", c("tags")["highway"].alias("highway"), c("tags")["service"].alias("service"),
                         c("tags")[osm.PARKED_SERVICE_KEY].alias("parked"), osm.undo_promote(c("tags"))["service"].alias("undone"))


view("place_tag", """SELECT c_custkey AS id, c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN c_name || ' Sat' END AS name_ro,
    CASE WHEN c_custkey % 4 = 0 THEN 'Сёла ' || c_mktsegment || ';' || c_name || '; Сёла ' || c_mktsegment END AS name_ru,
    CASE WHEN c_custkey % 5 = 0 THEN c_name END AS name_en, CASE WHEN c_custkey % 7 = 0 THEN 'Old ' || c_mktsegment || '; ' END AS old_name,
    CASE c_custkey % 4 WHEN 0 THEN '1 2' || CAST(c_custkey AS STRING) WHEN 1 THEN '3,' || CAST(c_custkey AS STRING) || ' (2020)' WHEN 2 THEN 'many' END AS population,
    CASE WHEN c_custkey % 6 = 0 THEN ' municipiul ' || c_name END AS official_name, CASE WHEN c_custkey % 2 = 0 THEN 'comuna' END AS prefix,
    CASE c_custkey % 3 WHEN 0 THEN c_mktsegment || ';România' WHEN 1 THEN c_mktsegment || ', Județ ' || CAST(c_nationkey AS STRING) END AS is_in,
    CASE c_custkey % 8 WHEN 0 THEN 'mun. ' WHEN 1 THEN 'Satul  ' WHEN 2 THEN 'г ' ELSE '' END || c_name AS city FROM customer""")
PLACE_KEYS = {"name": "name", "name_ro": "name:ro", "name_ru": "name:ru", "name_en": "name:en", "old_name": "old_name",
              "population": "population", "official_name": "official_name", "prefix": "name:prefix", "is_in": "is_in"}


def place(t):
    return t.place_tag.select("id", "name", "city", views.tags_of(PLACE_KEYS))


@query("x16_locality_aliases", f"""WITH v AS (SELECT id, name, list_transform(list_concat([name_ro], string_split(coalesce(name_ru, ''), ';'), [name_en], string_split(coalesce(old_name, ''), ';'), [official_name]), lambda x: trim(x)) AS l FROM place_tag),
    k AS (SELECT id, name, list_filter(l, lambda x: x IS NOT NULL AND x <> '' AND {name_key('x')} <> {name_key('name')} AND length(x) <= 80) AS l FROM v),
    d AS (SELECT id, name, list_filter(l, lambda x, i: list_position(l, x) = i) AS l FROM k),
    y AS (SELECT id, l, list_filter(list_transform(list_concat([name], l), lambda x: translate(x, 'ёЁ', 'еЕ')), lambda x, i: x <> list_concat([name], l)[i]) AS yo FROM d)
    SELECT id, array_to_string(list_concat(l, list_filter(yo, lambda x, i: list_position(yo, x) = i AND NOT list_contains(l, x))), '|') AS aliases FROM y""")
def x16(t):
    return place(t).select("id", F.array_join(text.locality_aliases(c("tags"), c("name")), "|").alias("aliases"))


@query("x17_search_aliases", """SELECT id, concat_ws('|', CASE WHEN name_en <> coalesce(name, '') THEN name_en END,
    CASE WHEN name_ru <> coalesce(name, '') AND name_ru IS DISTINCT FROM name_en THEN name_ru END) AS aliases FROM way_tag""")
def x17(t):
    return t.way.select("id", F.array_join(text.search_aliases(c("tags"), c("tags")["name"]), "|").alias("aliases"))


CITY_BARE = r"regexp_replace(trim(city), '(?i)^(mun|municipiul|or|oras|orasul|s|sat|satul|c|com|comuna|sec|sectorul|г|пгт|с)\.?\s+', '')"


@query("x18_city_keys", f"""SELECT id, CASE WHEN {name_key(CITY_BARE)} IN ('', {name_key('city')}) THEN {name_key('city')}
    ELSE {name_key('city')} || '|' || {name_key(CITY_BARE)} END AS keys FROM place_tag""")
def x18(t):
    return place(t).select("id", F.array_join(text.city_keys(c("city")), "|").alias("keys"))


@query("x19_population", r"""SELECT id, coalesce(TRY_CAST(nullif(regexp_extract(regexp_replace(coalesce(population, ''), '[ ,]', '', 'g'), '^(\d+)', 1), '') AS BIGINT), 0) AS pop FROM place_tag""")
def x19(t):
    return place(t).select("id", text.population(c("tags")["population"]).alias("pop"))


@query("x20_commune_display", """SELECT id, upper(substr(f, 1, 1)) || substr(f, 2) AS display FROM (
    SELECT id, coalesce(nullif(trim(coalesce(official_name, '')), ''), trim(prefix) || ' ' || name, name) AS f FROM place_tag)""")
def x20(t):
    return place(t).select("id", text.commune_display(c("tags")).alias("display"))


@query("x21_is_in_conflict", f"""WITH p AS (SELECT id, list_filter(list_transform(string_split_regex(coalesce(is_in, ''), '[;,]'), lambda x: {name_key('x')}), lambda x: x <> '') AS l,
      list_filter(list_transform(string_split_regex(name || ';Județ 3;România', '[;,]'), lambda x: {name_key('x')}), lambda x: x <> '') AS r FROM place_tag)
    SELECT id, CAST(len(list_distinct(l)) AS INT) AS parts, len(l) > 0 AND len(r) > 0 AND NOT list_has_all(r, l) AND NOT list_has_all(l, r) AS conflict FROM p""")
def x21(t):
    other = F.concat(c("name"), F.lit(";Județ 3;România"))
    return place(t).select("id", F.size(text.is_in_parts(c("tags")["is_in"])).alias("parts"),
                           text.is_in_conflict(c("tags")["is_in"], other).alias("conflict"))


view("poi_kind", """SELECT p_partkey AS id, CASE p_size % 16 WHEN 0 THEN 'charging_station' WHEN 1 THEN 'fuel' WHEN 2 THEN 'parking' WHEN 3 THEN 'cafe'
    WHEN 4 THEN 'bank' WHEN 5 THEN 'hotel' WHEN 6 THEN 'clinic' WHEN 7 THEN 'toilets' WHEN 8 THEN 'chemist' WHEN 9 THEN 'mall' WHEN 10 THEN 'museum'
    WHEN 11 THEN 'parking_space' WHEN 12 THEN 'pub' WHEN 13 THEN NULL WHEN 14 THEN 'supermarket' ELSE 'viewpoint' END AS kind FROM part""")
CATEGORY_CASE = "CASE " + " ".join(
    f"WHEN kind IN ({', '.join(repr(k) for k in kinds)}) THEN '{name}'" for name, kinds in text.CATEGORY_KINDS.items()) + " END"


@query("x22_category", f"SELECT id, kind, {CATEGORY_CASE} AS cat FROM poi_kind")
def x22(t):
    return t.poi_kind.select("id", "kind", text.category_of(c("kind")).alias("cat"))


@query("x23_e7", "SELECT o_orderkey AS id, CAST(round_even(o_totalprice / 10000e0 * 1e7, 0) AS INT) AS v FROM orders")
def x23(t):
    return t.orders.select(c("o_orderkey").alias("id"), geo.e7(c("o_totalprice") / F.lit(10000.0)).alias("v"))


@query("x24_portal_distance", f"""SELECT local_id, country, CASE WHEN l_orderkey % 7 = 4 THEN 0e0 ELSE greatest(0.01e0, ceil({haversine('lat_e7 / 1e7', 'lon_e7 / 1e7', '(lat_e7 + l_orderkey % 7 - 4) / 1e7', 'lon_e7 / 1e7')} * 100) / 100e0) END AS d FROM fr""")
def x24(t):
    d = geo.portal_distance(c("lat_e7"), c("lon_e7"), (c("lat_e7") + c("l_orderkey") % 7 - 4), c("lon_e7"))
    return t.fr.select("local_id", "country", d.alias("d"))


@query("x25_graph_id", """SELECT country, local_id, (CAST(substr(country, 2) AS BIGINT) << 46) | local_id AS gid, CAST(local_id & 7 AS INT) AS level,
    CAST(g & 7 AS STRING) || '/' || CAST((g >> 3) & 4194303 AS STRING) || '/' || CAST((g >> 25) & 2097151 AS STRING) AS text
    FROM (SELECT country, local_id, (CAST(substr(country, 2) AS BIGINT) << 46) | local_id AS g FROM fr)""")
def x25(t):
    gid = osm.graph_id(F.substring("country", 2, 9), c("local_id"))
    return t.fr.select("country", "local_id", gid.alias("gid"), osm.graph_level(gid).alias("level"), osm.graph_id_text(gid).alias("text"))


view("tile_path", """SELECT DISTINCT CAST(level AS STRING) || '/' || substr(padded, 1, 3) || '/' || substr(padded, 4, 3) || CASE WHEN level = 2 THEN '/' || substr(padded, 7, 3) ELSE '' END || '.gph' AS path, level, tile_id
    FROM (SELECT level, tile_id, lpad(CAST(tile_id AS STRING), CASE WHEN level = 2 THEN 9 ELSE 6 END, '0') AS padded FROM (
      SELECT CAST(o_orderkey % 3 AS INT) AS level, CASE o_orderkey % 3 WHEN 0 THEN o_orderkey % 4050 WHEN 1 THEN o_orderkey * 4 % 64800 ELSE o_orderkey * 69 % 1036800 END AS tile_id FROM orders))""")


@query("x26_tile_bbox", """SELECT path, level, tile_id, -180e0 + (tile_id % n) * s AS west, -90e0 + floor(tile_id / n) * s AS south,
    -180e0 + (tile_id % n) * s + s AS east, -90e0 + floor(tile_id / n) * s + s AS north
    FROM (SELECT *, CASE level WHEN 0 THEN 4e0 WHEN 1 THEN 1e0 ELSE 0.25e0 END AS s, CASE level WHEN 0 THEN 90 WHEN 1 THEN 360 ELSE 1440 END AS n FROM tile_path)""")
def x26(t):
    ids = t.tile_path.select("path", geo.tile_id_from_path(c("path")).alias("i")).select("path", "i.*")
    return ids.select("path", "level", "tile_id", geo.tile_bbox(c("level"), c("tile_id")).alias("b")).select("path", "level", "tile_id", "b.*")


@query("x27_web_tiles", """WITH z AS (SELECT point, lat, lon, zz, pow(2e0, zz) AS n FROM pt, (VALUES (10), (15)) AS v(zz)),
    xy AS (SELECT *, CAST(trunc((lon + 180) / 360e0 * n) AS BIGINT) AS x, CAST(trunc((1 - asinh(tan(radians(lat))) / pi()) / 2e0 * n) AS BIGINT) AS y FROM z)
    SELECT point, CAST(zz AS INT) AS z, x, y, round_even(degrees(atan(sinh(pi() * (1 - 2 * (y + 1000e0 / 4096e0) / n)))), 5) AS lat,
      round_even((x + 2000e0 / 4096e0) / n * 360 - 180, 5) AS lon FROM xy""")
def x27(t):
    z = t.pt.withColumn("z", F.explode(F.array(F.lit(10), F.lit(15)))).withColumn("w", geo.web_tile(c("lat"), c("lon"), c("z")))
    back = geo.tile_pixel_to_lonlat(c("z"), c("w.x"), c("w.y"), F.lit(2000.0), F.lit(1000.0), F.lit(4096.0))
    return z.select("point", "z", "w.x", "w.y", back.alias("b")).select("point", "z", "x", "y", "b.lat", "b.lon")


@query("x28_hilbert", """WITH RECURSIVE ids AS (SELECT o_orderkey * 5 AS id FROM orders UNION ALL SELECT o_orderkey % 65536 * 140737488355327 FROM orders),
    zs AS (SELECT id, max(z) AS z FROM ids, range(0, 33) AS r(z) WHERE (CAST(1 AS HUGEINT) << CAST(2 * z AS INT)) // 3 <= id GROUP BY id),
    st AS (SELECT id, z, CAST(id - (CAST(1 AS HUGEINT) << CAST(2 * z AS INT)) // 3 AS BIGINT) AS d, CAST(0 AS BIGINT) AS x, CAST(0 AS BIGINT) AS y, CAST(0 AS BIGINT) AS k FROM zs
      UNION ALL
      SELECT id, z, d // 4,
        CASE WHEN ry = 0 THEN CASE WHEN rx = 1 THEN s - 1 - y ELSE y END ELSE x END + s * rx,
        CASE WHEN ry = 0 THEN CASE WHEN rx = 1 THEN s - 1 - x ELSE x END ELSE y END + s * ry, k + 1
      FROM (SELECT *, (d // 2) % 2 AS rx, (d + (d // 2) % 2) % 2 AS ry, CAST(pow(2, k) AS BIGINT) AS s FROM st WHERE k < z))
    SELECT id, CAST(z AS INT) AS z, x, y FROM st WHERE k = z""")
def x28(t):
    far = c("o_orderkey") % 65536 * 140737488355327   # up to the last zoom of 64 bits
    ids = t.orders.select((c("o_orderkey") * 5).alias("id")).unionByName(t.orders.select(far.alias("id"))).distinct()
    return ids.select("id", geo.hilbert_zxy(c("id")).alias("t")).select("id", "t.*")


view("leg", """SELECT l_orderkey AS id, l_linenumber AS seq, l_partkey % 1000 - 500 AS dlat, (l_suppkey % 100 - 50) * 7 AS dlon,
    chr(CAST(va % 32 + 95 AS INT)) || chr(CAST(floor(va / 32) % 32 + 95 AS INT)) || chr(CAST(floor(va / 1024) + 63 AS INT)) || chr(CAST(vo % 32 + 95 AS INT)) || chr(CAST(floor(vo / 32) + 63 AS INT)) AS enc
    FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_partkey % 1000 < 500 THEN -2 * (l_partkey % 1000 - 500) - 1 ELSE 2 * (l_partkey % 1000 - 500) END AS va,
      CASE WHEN l_suppkey % 100 < 50 THEN -14 * (l_suppkey % 100 - 50) - 1 ELSE 14 * (l_suppkey % 100 - 50) END AS vo FROM li)""")
view("shape", "SELECT id, string_agg(enc, '' ORDER BY seq) AS shape FROM leg GROUP BY id",
     lambda t: t.leg.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "enc"))), lambda s: s["enc"]), "").alias("shape")))


@query("x29_polyline6", """SELECT id, CAST(row_number() OVER w - 1 AS INT) AS i, sum(dlat) OVER w / 1e6 AS lat, sum(dlon) OVER w / 1e6 AS lon
    FROM leg WINDOW w AS (PARTITION BY id ORDER BY seq)""")
def x29(t):
    from atlas.operators.routes import shape_points
    return shape_points(t.shape, ["id"])


view("way_step", """SELECT way_id, seq, a.lat AS lat, a.lon AS lon, b.lat AS lat2, b.lon AS lon2, a.lat_e7 AS lat_e7, a.lon_e7 AS lon_e7, b.lat_e7 AS lat2_e7, b.lon_e7 AS lon2_e7
    FROM (SELECT way_id, seq, node_id, lead(node_id) OVER (PARTITION BY way_id ORDER BY seq) AS next_id FROM way_node) w
    JOIN node a ON a.id = w.node_id JOIN node b ON b.id = w.next_id""".replace("JOIN node a", "JOIN (SELECT * FROM node) a").replace("JOIN node b", "JOIN (SELECT * FROM node) b"))


@query("x30_segment_meets_box", """SELECT way_id, seq, least(lon, lon2) <= 28.0133e0 AND greatest(lon, lon2) >= 28.0061e0 AND least(lat, lat2) <= 47.0077e0 AND greatest(lat, lat2) >= 47.0023e0
      AND least(c1, c2, c3, c4) <= 0 AND greatest(c1, c2, c3, c4) >= 0 AS meets
    FROM (SELECT *, (lon2 - lon) * (47.0023e0 - lat) - (lat2 - lat) * (28.0061e0 - lon) AS c1, (lon2 - lon) * (47.0077e0 - lat) - (lat2 - lat) * (28.0061e0 - lon) AS c2,
      (lon2 - lon) * (47.0023e0 - lat) - (lat2 - lat) * (28.0133e0 - lon) AS c3, (lon2 - lon) * (47.0077e0 - lat) - (lat2 - lat) * (28.0133e0 - lon) AS c4 FROM way_step)""")
def x30(t):
    box = [F.lit(v) for v in (28.0061, 47.0023, 28.0133, 47.0077)]
    return t.way_step.select("way_id", "seq", geo.segment_meets_box(c("lon"), c("lat"), c("lon2"), c("lat2"), *box).alias("meets"))


@query("x31_signal_value", r"SELECT page_id, md5(regexp_replace(html, '[^A-Za-z0-9_:.-]', '_', 'g')) AS v, regexp_replace(url, '[^A-Za-z0-9_:.-]', '_', 'g') AS url FROM pages")
def x31(t):
    return t.pages.select("page_id", F.md5(text.signal_value(c("html"))).alias("v"), text.signal_value(c("url")).alias("url"))


view("url_text", """SELECT o_orderkey AS id, 'https://host.example/europe/land' || CAST(o_orderkey % 40 AS STRING) || CASE WHEN o_orderkey % 5 = 0 THEN '-260101' ELSE '-latest' END || '.osm.pbf' AS url,
    CASE WHEN o_orderkey % 7 = 0 THEN '2026' ELSE substr(CAST(o_orderdate AS STRING), 1, 10) || 'T20:21:22Z' END AS stamp,
    'https://host.example/download/v' || CAST(o_orderkey % 30 AS STRING) || '/pkg-' || CAST(o_custkey % 9 AS STRING) AS asset_url,
    'land-' || CAST(o_custkey % 9 AS STRING) || '-' || substr(CAST(o_orderdate AS STRING), 1, 10) || CASE o_orderkey % 3 WHEN 0 THEN '.tar' WHEN 1 THEN '.pmtiles' ELSE '.json' END AS asset,
    CASE WHEN o_orderkey % 4 = 0 THEN 'sequence=12' || chr(10) ELSE '' END || CASE WHEN o_orderkey % 6 = 0 THEN 'time=' ELSE 'timestamp=' END || substr(CAST(o_orderdate AS STRING), 1, 10) || 'T20\\:21\\:22Z' AS state,
    md5(CAST(o_orderkey AS STRING)) || CASE WHEN o_orderkey % 8 = 0 THEN ' *' ELSE '  ' END || 'land' || CAST(o_orderkey % 3 AS STRING) || '.pbf' AS md5_line FROM orders""".replace("T20\\:21\\:22Z", "T20-21-22Z"))


@query("x32_format_row", """SELECT way_id AS id, string_agg('w' || CAST(node_id AS STRING), ',' ORDER BY seq) AS list, coalesce(max(h), '-') AS highway,
      CASE WHEN max(kv) IS NULL THEN '-' ELSE max(kv) END AS attrs
    FROM way_node JOIN (SELECT id, highway AS h, nullif(concat_ws(';', CASE WHEN bridge IS NOT NULL THEN 'bridge=' || bridge END, CASE WHEN service IS NOT NULL THEN 'service=' || service END), '') AS kv FROM way_tag) g ON g.id = way_id
    GROUP BY way_id""")
def x32(t):
    from atlas.sources.sinks import attrs_text, list_text
    tags = F.map_filter(c("tags"), lambda k, v: k.isin("bridge", "service"))
    return t.way_refs.join(t.way, "id").select(
        "id", list_text(F.transform("refs", lambda r: F.concat(F.lit("w"), r.cast("string"))), ",").alias("list"),
        F.coalesce(c("tags")["highway"], F.lit("-")).alias("highway"), attrs_text(tags).alias("attrs"))


@query("x33_dated_names", r"""SELECT id, CASE WHEN url LIKE '%-latest.osm.pbf' AND length(stamp) >= 10 THEN replace(url, '-latest.osm.pbf', '-' || replace(substr(stamp, 3, 8), '-', '') || '.osm.pbf') END AS dated,
      CASE WHEN url NOT LIKE '%latest%' THEN regexp_extract(url, '[^/]+$') END AS redirect,
      CASE WHEN state LIKE '%timestamp=%' THEN replace(substr(regexp_extract(state, 'timestamp=(.*)', 1), 3, 8), '-', '') END AS day,
      CASE WHEN regexp_matches(md5_line, 'land1\.pbf$') THEN substr(md5_line, 1, 32) END AS md5 FROM url_text""")
def x33(t):
    path = F.regexp_extract("url", r"^https://host\.example/(.*?)-[^-]*$", 1)
    return t.url_text.select("id", text.dated_extract(c("url"), c("stamp")).alias("dated"), text.dated_name(c("url"), path).alias("redirect"),
                             text.state_date(c("state")).alias("day"), text.md5_of(c("md5_line"), F.lit("land1.pbf")).alias("md5"))


@query("x34_release_names", r"""SELECT id, regexp_extract(asset_url, '/download/([^/]*)', 1) AS tag, nullif(regexp_extract(asset, '^(land-\d+)-.*\.(tar|pmtiles)$', 1), '') AS package,
      nullif(regexp_extract(asset, '(\d{4}-\d\d-\d\d)\.(tar|pmtiles)$', 1), '') AS day, nullif(regexp_extract(asset, '\.(tar|pmtiles)$', 1), '') AS half FROM url_text""")
def x34(t):
    p = text.asset_parts(c("asset"))
    return t.url_text.select("id", text.tag_of(c("asset_url")).alias("tag"), p["package"].alias("package"), p["date"].alias("day"), p["half"].alias("half"))


@query("x35_age_days", "SELECT event_id, CAST(floor((epoch(TIMESTAMP '2024-03-01 12:00:00') - floor(epoch(ts))) / 86400) AS BIGINT) AS age FROM events")
def x35(t):
    from atlas.gates.sources import age_days
    return t.events.select("event_id", age_days(c("ts"), F.lit("2024-03-01 12:00:00").cast("timestamp")).alias("age"))


@query("x36_aliases_json", """SELECT id, CASE WHEN name_en IS NULL AND name_ru IS NULL THEN NULL ELSE '["' || concat_ws('","', name_en, name_ru) || '"]' END AS aliases FROM way_tag""")
def x36(t):
    return t.way.select("id", text.aliases_json(text.search_aliases(c("tags"), c("tags")["name"])).alias("aliases"))
