"""Gates: each returns problem rows or verdicts."""

from __future__ import annotations

from pyspark.sql import functions as F

from atlas.gates import address, archive, features, frontier, release, routes, sources
from atlas.operators import matching, token_index
from atlas.operators import release as release_ops
from atlas.queries import views
from atlas.queries.base import query, view
from atlas.queries.release import ASSETS, BLOCKS, COMPARED, DECIDE, IDENTITY, RECONCILE, compared, wanted
from atlas.queries.spatial import ALL_PAIRS
from atlas.queries.sqltext import haversine
from atlas.session import scratch_folder

c = F.col

# ---- frontier --------------------------------------------------------------------------------

view("fr_bad", """SELECT country, CAST(CASE WHEN l_orderkey % 97 = 0 THEN 3 ELSE level END AS INT) AS level, CAST(CASE WHEN l_orderkey % 101 = 0 THEN 900000001 ELSE lat_e7 END AS INT) AS lat_e7, lon_e7,
    CASE l_orderkey % 89 WHEN 0 THEN local_id + 70368744177664 WHEN 1 THEN local_id + 1 WHEN 2 THEN -5 ELSE local_id END AS local_id, osm FROM fr WHERE country <> 'C7'""")
RULES = """one AS (SELECT country, unnest([CASE WHEN level NOT IN (0, 1, 2) THEN 'impossible level' END, CASE WHEN local_id < 0 OR local_id > 70368744177663 THEN 'local id carries region bits' WHEN local_id & 7 <> level THEN 'local id of another level' END,
      CASE WHEN lat_e7 > 900000000 THEN 'coordinate out of range' END]) AS rule FROM fr_bad),
    two AS (SELECT country, 'two nodes on one spot' AS rule FROM fr_bad GROUP BY country, level, lat_e7, lon_e7 HAVING count(*) > 1 UNION ALL SELECT country, 'one OSM node twice on a level' FROM fr_bad WHERE osm IS NOT NULL GROUP BY country, osm, level HAVING count(*) > 1)"""


@query("v04_frontier_gate", f"WITH {RULES} SELECT country, rule, count(*) AS n FROM (SELECT * FROM one WHERE rule IS NOT NULL UNION ALL SELECT * FROM two UNION ALL SELECT 'C7', 'empty frontier') GROUP BY country, rule")
def v04(t):
    countries = t.fr_country.withColumn("may_be_empty", F.lit(False))
    return frontier.frontier_gate(t.fr_bad, countries)


view("fr_border", "SELECT DISTINCT 'C' || CAST(l_linenumber AS STRING) AS a, 'C' || CAST(l_linenumber + l_suppkey % 3 + 1 AS STRING) AS b, l_linenumber % 2 = 0 AS required FROM lineitem")


@query("v06_portal_gate", f"""WITH {ALL_PAIRS}, busy AS (SELECT substr(p, 1, 2) AS a, substr(p, 4, 2) AS b, ambiguous FROM stats WHERE osm + coord + near + ambiguous > 0)
    SELECT a, b, 'FAIL' AS severity, 'ambiguous entries' AS rule FROM busy WHERE ambiguous > 0
    UNION ALL SELECT a, b, CASE WHEN required THEN 'FAIL' ELSE 'NOTE' END, 'no portal' FROM fr_border WHERE a IN (SELECT country FROM fr) AND b IN (SELECT country FROM fr) AND a || b NOT IN (SELECT a || b FROM busy)""")
def v06(t):
    _, stats = matching.all_pairs(t.fr)
    return frontier.portal_gate(stats, t.fr_border, t.fr_country)


# ---- features and bus lanes ------------------------------------------------------------------

view("feat", """SELECT 'N' || CAST(c_nationkey AS STRING) AS country, CASE c_custkey % 50 WHEN 7 THEN 'x' WHEN 8 THEN 'n' ELSE 'n' END || CAST(CASE WHEN c_custkey % 60 = 9 THEN c_custkey - 25 ELSE c_custkey END AS STRING) AS id,
    CASE c_custkey % 7 WHEN 0 THEN 'camera_speed' WHEN 1 THEN 'camera_red_light' WHEN 2 THEN 'camera_section' WHEN 3 THEN 'level_crossing' WHEN 4 THEN 'tram_level_crossing' WHEN 5 THEN 'traffic_signals' ELSE CASE WHEN c_custkey % 35 = 6 THEN 'bench' ELSE 'camera_speed' END END AS type,
    CAST(CASE WHEN c_custkey % 80 = 3 THEN 910000000 ELSE 470000137 + (c_custkey * 7919 % 20000) * 1000 END AS INT) AS lat_e7, CAST(280000291 + (c_custkey * 104729 % 20000) * 1000 AS INT) AS lon_e7,
    CAST(CASE WHEN c_custkey % 45 = 4 THEN 360 ELSE c_custkey % 360 END AS INT) AS brg, CAST(CASE c_custkey % 55 WHEN 5 THEN 0 WHEN 6 THEN 301 ELSE 50 END AS INT) AS maxspeed,
    CASE c_custkey % 9 WHEN 0 THEN 'v5' WHEN 1 THEN NULL ELSE 'w' || CAST(c_custkey AS STRING) END AS way, CASE WHEN c_custkey % 4 <> 0 THEN '1,2' END AS to_end FROM customer""")


def feat(t):
    f = t.feat
    ways = F.when(c("way").isNull(), F.array().cast("array<string>")).otherwise(F.array("way"))
    return f.withColumn("bearing", F.array("brg")).withColumn("way_ids", ways).withColumn("attrs", F.map_filter(F.create_map(F.lit("to"), c("to_end")), lambda k, v: v.isNotNull()))


@query("v03_feature_row_rules", r"""WITH r AS (SELECT country, unnest([CASE WHEN NOT regexp_matches(id, '^[nr]\d+$') THEN 'bad id' END, CASE WHEN type = 'bench' THEN 'unknown type' END, CASE WHEN lat_e7 > 900000000 THEN 'coordinate out of range' END,
      CASE WHEN brg >= 360 THEN 'bearing out of range' END, CASE WHEN maxspeed <= 0 OR maxspeed > 300 THEN 'implausible maxspeed' END, CASE WHEN way = 'v5' THEN 'bad way id' END, CASE WHEN type = 'camera_section' AND to_end IS NULL THEN 'section without its end' END,
      CASE WHEN type IN ('level_crossing', 'tram_level_crossing', 'traffic_signals') AND way IS NULL THEN 'on no road' END]) AS rule FROM feat UNION ALL SELECT country, 'duplicate id' FROM feat GROUP BY country, id HAVING count(*) > 1)
    SELECT country, rule, count(*) AS n FROM r WHERE rule IS NOT NULL GROUP BY country, rule""")
def v03(t):
    return features.feature_row_rules(feat(t))


@query("v03_header_counts", """WITH d AS (SELECT 'N' || CAST(n_nationkey AS VARCHAR) AS country, unnest(['camera_speed', 'level_crossing', 'traffic_signals']) AS type, CAST(unnest([19, 8, 9]) AS BIGINT) AS n FROM nation), r AS (SELECT country, type, count(*) AS real FROM feat GROUP BY ALL)
    SELECT coalesce(d.country, r.country) AS country, coalesce(d.type, r.type) AS type, coalesce(n, 0) AS n, coalesce(real, 0) AS real FROM d FULL JOIN r ON d.country = r.country AND d.type = r.type WHERE coalesce(n, 0) <> coalesce(real, 0)""")
def v03_counts(t):
    stated = F.array(*[F.struct(F.lit(k).alias("type"), F.lit(v).cast("bigint").alias("n")) for k, v in (("camera_speed", 19), ("level_crossing", 8), ("traffic_signals", 9))])
    declared = t.nation.select(F.concat(F.lit("N"), c("n_nationkey").cast("string")).alias("country"), F.inline(stated))
    return features.header_counts(feat(t), declared)


@query("v02_feature_gate", """WITH p AS (SELECT 'N' || CAST(n_nationkey AS VARCHAR) AS country, unnest(['camera_speed', 'level_crossing', 'camera_red_light', 'bollard']) AS type, unnest([n_nationkey % 15 + 10, n_nationkey % 9 + 4, 8, 3]) AS before FROM nation),
    n AS (SELECT country, type, count(*) AS now FROM feat GROUP BY ALL)
    SELECT DISTINCT country, '*' AS type, 'HARD' AS severity, 'outside the country' AS rule FROM feat WHERE NOT (lat_e7 / 1e7 BETWEEN 47.3 - 0.2 AND 48.9 + 0.2 AND lon_e7 / 1e7 BETWEEN 28.1 - 0.2 AND 29.9 + 0.2)
    UNION ALL SELECT p.country, p.type, CASE WHEN coalesce(now, 0) = 0 THEN 'HARD' ELSE 'WARN' END, CASE WHEN coalesce(now, 0) = 0 THEN 'vanished' ELSE 'changed by more than a quarter' END FROM p LEFT JOIN n ON n.country = p.country AND n.type = p.type
      WHERE coalesce(now, 0) = 0 OR abs(now - before) / before > 0.25e0""")
def v02(t):
    name = F.concat(F.lit("N"), c("n_nationkey").cast("string")).alias("country")
    before = F.array(*[F.struct(F.lit(k).alias("type"), v.cast("bigint").alias("before")) for k, v in (
        ("camera_speed", c("n_nationkey") % 15 + 10), ("level_crossing", c("n_nationkey") % 9 + 4), ("camera_red_light", F.lit(8)), ("bollard", F.lit(3)))])
    box = F.struct(*[F.lit(v).alias(n) for n, v in (("west", 28.1), ("south", 47.3), ("east", 29.9), ("north", 48.9))])
    return features.feature_gate(feat(t), t.nation.select(name, F.inline(before)), t.nation.select(name, box.alias("bbox")))


view("lane", """SELECT 'f' || CAST(c_nationkey AS STRING) AS file, c_custkey AS way_id, CASE c_custkey % 3 WHEN 0 THEN 'right' WHEN 1 THEN 'left' ELSE 'both' END AS side, c_custkey % 400 = 11 AS broken FROM customer""")
view("lane_pkg", """SELECT 'N' || CAST(n_nationkey AS STRING) AS country, CASE WHEN n_nationkey % 6 <> 0 THEN 'f' || CAST(n_nationkey AS STRING) END AS file, n_nationkey % 4 AS q FROM nation""")


@query("v05_bus_lane_gate", """WITH r AS (SELECT file, count(*) AS n, count(*) FILTER (WHERE side = 'right') AS rt, bool_or(broken) AS broken FROM lane GROUP BY file)
    SELECT country, 'WARN' AS severity, 'no bus lanes in this run' AS rule FROM lane_pkg WHERE file IS NULL
    UNION ALL SELECT country, 'FAIL', CASE WHEN broken THEN 'unknown side' WHEN q = 1 THEN 'row count differs from the package' ELSE 'counts differ from the package' END FROM lane_pkg JOIN r ON r.file = lane_pkg.file WHERE broken OR q IN (1, 2)""")
def v05(t):
    real = t.lane.groupBy("file").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(c("side") == s).alias(s) for s in ("right", "left", "both")])
    counts = F.create_map(*[x for s in ("right", "left", "both") for x in (F.lit(s), c(s) + (F.when(c("q") == 2, 1).otherwise(0) if s == "right" else F.lit(0)))])
    packages = t.lane_pkg.join(real, "file", "left").select("country", "file", (c("n") + F.when(c("q") == 1, 1).otherwise(0)).alias("entries"), counts.alias("counts"))
    return features.bus_lane_gate(packages, t.lane, t.lane.filter("broken").select("file", F.lit("unknown side").alias("rule")))


# ---- address index ---------------------------------------------------------------------------

view("g_street", "SELECT o_orderkey AS id, o_orderpriority AS name, CASE WHEN o_custkey % 10 > 0 THEN o_custkey END AS locality, o_custkey % 5 AS houses FROM orders")
view("g_house", "SELECT l_orderkey AS street, CAST(l_linenumber AS STRING) AS key, l_partkey AS osm FROM lineitem")
view("g_locality", "SELECT c_custkey AS id, c_name AS name, CASE WHEN c_custkey % 3 > 0 THEN c_nationkey + CASE WHEN c_custkey % 500 = 1 THEN 100 ELSE 0 END END AS commune FROM customer WHERE c_acctbal > -900")


def index_tables(t):
    text = F.lit(None).cast("string")
    zero = F.lit(0.0)
    street = t.g_street.select("id", "name", text.alias("aliases"), F.lit("").alias("city"), zero.alias("lat"), zero.alias("lon"), "houses", "locality", text.alias("city_alt"))
    house = t.g_house.select("street", "key", "osm", text.alias("num"), F.lit(0).alias("lat_e7"), F.lit(0).alias("lon_e7"))
    locality = t.g_locality.select("id", "name", text.alias("aliases"), F.lit("town").alias("kind"), F.lit("").alias("district"), zero.alias("lat"), zero.alias("lon"), F.lit(0).alias("pop"), F.lit(0).alias("houses"), "commune")
    commune = t.nation.select(c("n_nationkey").alias("id"), c("n_name").alias("name"), c("n_name").alias("display"), text.alias("aliases"), F.lit("").alias("district"))
    return street, house, locality, commune


DANGLING = """dg AS (SELECT 'streets point at missing localities' AS rule, count(*) AS n FROM g_street WHERE locality IS NOT NULL AND locality NOT IN (SELECT id FROM g_locality)
    UNION ALL SELECT 'localities point at missing communes', count(*) FROM g_locality WHERE commune IS NOT NULL AND commune NOT IN (SELECT n_nationkey FROM nation) UNION ALL SELECT 'houses point at missing streets', count(*) FROM g_house WHERE street NOT IN (SELECT id FROM g_street))"""


@query("j34_referential_check", f"WITH {DANGLING} SELECT * FROM dg")
def j34(t):
    return address.referential_check(*index_tables(t))


@query("v01_address_gate", f"""WITH {DANGLING} SELECT * FROM dg WHERE n > 0 UNION ALL SELECT 'streets without locality', count(*) FROM g_street WHERE locality IS NULL HAVING count(*) > 0.01 * (SELECT count(*) FROM g_street)
    UNION ALL SELECT 'meta differs for street', count(*) FROM g_street UNION ALL SELECT 'index does not cover locality', count(*) FROM g_locality UNION ALL SELECT 'index does not cover commune', count(*) FROM nation""")
def v01(t):
    street, house, locality, commune = index_tables(t)
    size = lambda df, k, off: df.agg((F.count(F.lit(1)) + off).alias("v")).select(F.lit(k).alias("k"), "v")
    meta = size(street, "street", 1).unionByName(size(house, "house", 0))
    path = scratch_folder(t.spark, "gate")   # a written index that lacks one locality and all communes
    found = {"street": street, "locality": locality.where(c("id") != locality.agg(F.min("id")).scalar())}
    for name, rows in found.items():
        token_index.write_tokens(rows, "id", token_index.FIELDS[name], f"{path}/{name}_token")
    indexed = token_index.covered_rows({name: token_index.read_tokens(t.spark, path, name) for name in found})
    return address.address_gate(street, house, locality, commune, meta, indexed)


# ---- sources ---------------------------------------------------------------------------------

view("extract_row", "SELECT o_orderkey AS code, CASE WHEN o_orderkey % 10 > 0 THEN o_orderdate END AS snapshot, CASE WHEN o_orderkey % 20 = 0 THEN 'no header' END AS reason FROM orders")
view("extract_before", "SELECT l_orderkey AS code, min(l_shipdate) AS snapshot FROM lineitem GROUP BY l_orderkey")
FRESH = """fv AS (SELECT e.code, CAST(floor((epoch(TIMESTAMP '2000-01-01') - epoch(e.snapshot)) / 86400) AS BIGINT) AS age, CASE WHEN e.snapshot IS NULL THEN 'UNCHECKED: ' || coalesce(reason, 'no reason given') WHEN floor((epoch(TIMESTAMP '2000-01-01') - epoch(e.snapshot)) / 86400) > 30 OR coalesce(e.snapshot < b.snapshot, false) THEN 'FAIL' ELSE 'PASS' END AS verdict
    FROM extract_row e LEFT JOIN extract_before b ON b.code = e.code)"""


def fresh(t):
    return sources.freshness_vs_published(t.extract_row, t.extract_before, F.lit("2000-01-01 00:00:00").cast("timestamp"))


@query("j26_freshness_vs_published", f"WITH {FRESH} SELECT * FROM fv")
def j26(t):
    return fresh(t)


@query("v08_freshness_gate", f"WITH {FRESH} SELECT count(*) FILTER (WHERE verdict = 'FAIL') AS failed, count(*) FILTER (WHERE verdict LIKE 'UNCHECKED%') AS unchecked, CASE WHEN count(*) FILTER (WHERE verdict = 'FAIL') > 0 THEN 'FAIL' ELSE 'PASS' END AS verdict FROM fv")
def v08(t):
    return sources.freshness_gate(fresh(t))


view("dropped_name", "SELECT DISTINCT CASE WHEN c_custkey % 3 = 0 THEN upper(c_name) WHEN c_custkey % 3 = 1 THEN 'nation_' || CAST(c_nationkey AS STRING) ELSE c_mktsegment END AS name FROM customer WHERE c_nationkey % 2 = 0")


@query("j23_dropped_admin", "SELECT DISTINCT n_nationkey AS code, name FROM dropped_name JOIN nation ON lower(name) = lower(n_name)")
def j23(t):
    countries = t.nation.select(c("n_nationkey").cast("string").alias("code"), F.array("n_name").alias("names"))
    return sources.dropped_admin_for_members(t.dropped_name, countries).select(c("code").cast("int").alias("code"), "name")


@query("v09_admin_gate", "SELECT CAST(n_nationkey AS VARCHAR) AS code, count(name) AS n, CASE WHEN count(name) > 0 THEN 'FAIL' ELSE 'PASS' END AS verdict FROM nation LEFT JOIN dropped_name ON lower(name) = lower(n_name) GROUP BY n_nationkey")
def v09(t):
    countries = t.nation.select(c("n_nationkey").cast("string").alias("code"), F.array("n_name").alias("names"))
    return sources.admin_gate(t.dropped_name, countries)


view("zone_row", "SELECT 'Europe/' || CASE WHEN c_custkey % 50 = 0 THEN 'Zagreb' ELSE CAST(c_custkey AS STRING) END AS zone FROM customer")
view("runtime_row", "SELECT CASE WHEN o_custkey % 3 = 0 THEN 'link' ELSE 'zone' END AS what, 'Europe/' || CAST(o_custkey AS STRING) AS name, 'Europe/0' AS target FROM orders WHERE o_custkey % 5 > 0")
AUDIT = """za AS (SELECT DISTINCT zone, 'deprecated' AS rule FROM zone_row WHERE zone = 'Europe/Zagreb' UNION ALL SELECT DISTINCT zone, 'a link for this runtime' FROM zone_row WHERE zone IN (SELECT name FROM runtime_row WHERE what = 'link')
    UNION ALL SELECT DISTINCT zone, 'unknown to this runtime' FROM zone_row WHERE zone NOT IN (SELECT name FROM runtime_row))"""


@query("j24_zone_audit", f"WITH {AUDIT} SELECT * FROM za")
def j24(t):
    return sources.zone_audit(t.zone_row, t.runtime_row, sources.deprecated_zones(t.zone_row))


@query("u02_zone_sets", "SELECT DISTINCT zone, 'link' AS what FROM zone_row WHERE zone IN (SELECT name FROM runtime_row WHERE what = 'link') UNION ALL SELECT DISTINCT zone, 'unknown' FROM zone_row WHERE zone NOT IN (SELECT name FROM runtime_row)")
def u02(t):
    return sources.zone_sets(t.zone_row, t.runtime_row)


@query("v10_timezone_gate", f"WITH {AUDIT} SELECT rule, count(*) AS n FROM za GROUP BY rule UNION ALL SELECT 'implausible number of zones', count(DISTINCT zone) FROM zone_row HAVING count(DISTINCT zone) NOT BETWEEN 250 AND 400")
def v10(t):
    return sources.timezone_gate(t.zone_row, t.runtime_row, sources.deprecated_zones(t.zone_row))


# ---- release ---------------------------------------------------------------------------------

view("cat_now", "SELECT 'R' || CAST(o_orderkey - CASE WHEN o_orderkey % 301 = 1 THEN 1 ELSE 0 END AS STRING) AS code, CAST(o_orderkey % 300 AS INT) AS region_id, 'europe/' || CAST(o_custkey AS STRING) AS path FROM orders WHERE o_orderkey % 77 <> 5")
view("cat_old", "SELECT 'R' || CAST(o_orderkey AS STRING) AS code, CAST(o_orderkey % 300 + CASE WHEN o_orderkey % 83 = 2 THEN 1 ELSE 0 END AS INT) AS region_id, 'europe/' || CAST(o_custkey + CASE WHEN o_orderkey % 91 = 3 THEN 1 ELSE 0 END AS STRING) AS path FROM orders WHERE o_orderkey % 301 <> 1")
view("bord_old", "SELECT 'R' || CAST(o_orderkey + 1 AS STRING) AS a, 'R' || CAST(o_orderkey AS STRING) AS b FROM orders WHERE o_custkey % 9 = 0")
view("bord_now", "SELECT 'R' || CAST(o_orderkey AS STRING) AS a, 'R' || CAST(o_orderkey + 1 AS STRING) AS b FROM orders WHERE o_custkey % 27 <> 0")


@query("v07_catalog_gate", """SELECT code AS subject, 'code twice' AS rule FROM cat_now GROUP BY code HAVING count(*) > 1 UNION ALL SELECT CAST(region_id AS VARCHAR), 'region id twice' FROM cat_now GROUP BY region_id HAVING count(*) > 1
    UNION ALL SELECT code, 'region id out of range' FROM cat_now WHERE region_id NOT BETWEEN 1 AND 255 UNION ALL SELECT code, 'country lost' FROM cat_old WHERE code NOT IN (SELECT code FROM cat_now)
    UNION ALL SELECT n.code, 'region id changed' FROM cat_now n JOIN cat_old o ON o.code = n.code WHERE n.region_id <> o.region_id UNION ALL SELECT n.code, 'source path changed' FROM cat_now n JOIN cat_old o ON o.code = n.code WHERE n.path <> o.path
    UNION ALL SELECT DISTINCT least(a, b) || '-' || greatest(a, b), 'border lost' FROM bord_old WHERE least(a, b) || '-' || greatest(a, b) NOT IN (SELECT least(a, b) || '-' || greatest(a, b) FROM bord_now)""")
def v07(t):
    return release.catalog_gate(t.cat_now, t.cat_old, t.bord_now, t.bord_old)


@query("v12_source_gate", f"WITH {IDENTITY}, {BLOCKS} SELECT * FROM ident WHERE problem IS NOT NULL UNION ALL SELECT code, block, 'lost on carry' FROM lost")
def v12(t):
    return release.source_gate(t.regions_now, t.regions_before, t.built)


@query("v13_manifest_gate", f"""WITH {ASSETS}, wf AS (SELECT name, bytes, sha256 FROM assets WHERE url LIKE '%/download/v1/%' UNION ALL SELECT file, bytes, sha256 FROM table_row), {RECONCILE.format('wf')},
    fields AS (SELECT code AS subject, unnest([CASE WHEN region_id NOT BETWEEN 1 AND 255 THEN 'region id out of range' END, CASE WHEN split AND gap > 0 THEN 'parts do not add up' END, CASE WHEN src_md5 IS NULL THEN 'no source md5' END, CASE WHEN src_sha IS NULL THEN 'no source sha256' END,
      CASE WHEN replication IS NULL THEN 'no replication' END, CASE WHEN engine_digest IS NULL THEN 'no engine digest' END]) AS rule FROM reg)
    SELECT * FROM fields WHERE rule IS NOT NULL UNION ALL SELECT name, 'file ' || verdict FROM rec WHERE verdict IN ('missing', 'mismatch')
    UNION ALL SELECT pair, 'table of other versions' FROM table_row t LEFT JOIN reg a ON a.code = split_part(pair, '-', 1) LEFT JOIN reg b ON b.code = split_part(pair, '-', 2) WHERE va IS DISTINCT FROM a.code || '-' || a.graph_version OR vb IS DISTINCT FROM b.code || '-' || b.graph_version
    UNION ALL SELECT pair, 'table of another release' FROM table_row WHERE url NOT LIKE '%/download/v1/%'""")
def v13(t):
    tables = t.table_row.withColumn("versions", F.array("va", "vb"))
    return release.manifest_gate(t.regions_now, tables, t.listing, "v1")


@query("v14_rebuild_consistency", f"""WITH {DECIDE} SELECT code, 'cannot carry: never published' AS problem FROM dec WHERE reason IS NULL AND code NOT IN (SELECT code FROM reg) UNION ALL SELECT DISTINCT code, 'outside the set' FROM (SELECT a AS code FROM bord_old) WHERE code NOT IN (SELECT code FROM cat_now)""")
def v14(t):
    decision = release_ops.rebuild_decision(wanted(t), t.regions_before, "e1", "t1")
    return release.rebuild_consistency(decision, t.regions_now, t.cat_now, t.bord_old.select(c("a").alias("code")))


# ---- structure, transit, routes --------------------------------------------------------------


view("control", "SELECT o_orderkey AS way, CASE WHEN o_orderkey % 2 = 0 THEN false END AS want_dest, CASE WHEN o_orderkey % 3 = 0 THEN CAST(0 AS INT) END AS want_level, 'A' AS banned FROM orders")


@query("v16_struct_verdict", f"""WITH {COMPARED}, u AS (SELECT way, bool_or(use = 'A') AS bad, max(n_level) AS top FROM way_edge GROUP BY way),
    ctl AS (SELECT count(*) FILTER (WHERE es.way IS NULL OR (want_dest IS NOT NULL AND NOT (NOT n_any AND NOT n_all)) OR (want_level IS NOT NULL AND u.top <> 0) OR bad) AS wrong FROM control LEFT JOIN es ON es.way = control.way LEFT JOIN u ON u.way = control.way)
    SELECT count(*) FILTER (WHERE outcome = 'lifted') AS lifted, count(*) FILTER (WHERE outcome = 'lifted outside') AS lifted_outside, count(*) FILTER (WHERE outcome = 'inferred service') AS inferred, count(*) FILTER (WHERE outcome = 'other loss') AS other,
      count(*) FILTER (WHERE outcome = 'gained') AS gained, count(*) FILTER (WHERE outcome = 'kept legal') AS kept, (SELECT wrong FROM ctl) AS wrong_controls, 'FAIL' AS verdict FROM cmp""")
def v16(t):
    controls = t.control.select("way", "want_dest", c("want_level").alias("want_levels"), c("banned").alias("banned_use"))
    return routes.struct_verdict(compared(t), controls)


PLAN = """ij AS (SELECT point AS way, i, j, row_number() OVER (PARTITION BY point ORDER BY md5(CAST(point AS VARCHAR) || ':' || CAST(i AS VARCHAR) || ':' || CAST(j AS VARCHAR)), i, j) - 1 AS n FROM pt, range(16) a(i), range(16) b(j) WHERE i <> j)"""


@query("v17_transit_plan", f"WITH {PLAN} SELECT way, CAST(n AS INT) AS n, CAST(i AS INT) AS i, CAST(j AS INT) AS j FROM ij WHERE n < 12")
def v17_plan(t):
    return routes.transit_plan(t.pt.select(c("point").alias("way"), "lat", "lon")).select("way", "n", "i", "j")


# recorded answers: the lines of an order are the ways of its route, in both builds
view("transit_line", "SELECT l_orderkey AS way, CAST(l_orderkey % 12 AS INT) AS n, l_linenumber AS seq, l_partkey AS driven, CASE WHEN l_linenumber = 3 THEN l_partkey + 1 ELSE l_partkey END AS old_driven FROM li")
view("lifted_way", "SELECT p_partkey AS way FROM part WHERE p_size < 25")
INNER = """ln AS (SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY way) AS k, way % 5 = 0 AS ferry, way % 7 = 0 AS no_old FROM transit_line WINDOW w AS (PARTITION BY way ORDER BY seq)),
    nt AS (SELECT DISTINCT way, n, driven FROM ln a WHERE rn > 1 AND rn < k AND NOT ferry AND driven IN (SELECT way FROM lifted_way) AND NOT EXISTS (SELECT 1 FROM ln b WHERE b.way = a.way AND NOT b.no_old AND b.rn > 1 AND b.rn < b.k AND b.old_driven = a.driven))"""


def transit_answers(t):
    ordered = F.array_sort(F.collect_list(F.struct("seq", "driven", "old_driven")))
    a = t.transit_line.groupBy("way", "n").agg(ordered.alias("r"))
    return a.select("way", "n", (c("way") % 5 == 0).alias("ferry"), F.transform("r", lambda r: r["driven"]).alias("ways"),
                    F.when(c("way") % 7 != 0, F.transform("r", lambda r: r["old_driven"])).alias("old_ways"))


@query("u05_new_transit_ways", f"WITH {INNER} SELECT way, n, string_agg(CAST(driven AS VARCHAR), ',' ORDER BY driven) AS transit FROM nt GROUP BY way, n")
def u05(t):
    return routes.new_transit_ways(transit_answers(t), t.lifted_way).select("way", "n", F.array_join(F.transform("transit", lambda w: w.cast("string")), ",").alias("transit"))


@query("v17_transit_verdict", f"""WITH {INNER}, b AS (SELECT count(DISTINCT way) AS pairs, count(DISTINCT way) FILTER (WHERE NOT ferry) AS land_only FROM ln)
    SELECT pairs, land_only, (SELECT count(DISTINCT way) FROM nt) AS new_transits, (SELECT count(*) FROM lifted_way WHERE way NOT IN (SELECT id FROM node)) AS unplaced, 'FAIL' AS verdict FROM b""")
def v17(t):
    placed = t.lifted_way.join(t.node.select(c("id").alias("way"), "lat", "lon"), "way", "left")
    return routes.transit_verdict(placed, transit_answers(t), t.lifted_way)


view("route_row", """SELECT o_orderkey AS answer, CASE WHEN o_orderkey % 23 > 0 THEN floor(o_totalprice) / 400 END AS km, CASE o_orderkey % 5 WHEN 0 THEN 'Calais - Dover' WHEN 1 THEN 'Jersey Link' END AS ferry,
    CASE o_orderkey % 4 WHEN 0 THEN 'Calais' WHEN 1 THEN 'Dieppe' END AS expected, o_orderkey % 2 = 0 AS channel, o_orderkey % 19 = 0 AS accepted, CASE WHEN o_orderkey % 3 = 0 THEN floor(o_totalprice) / 400 + 0.01e0 END AS prod_km,
    p.lat AS from_lat, p.lon AS from_lon, p.lat + (o_orderkey % 20) / 10e0 AS to_lat, p.lon - (o_orderkey % 15) / 10e0 AS to_lon FROM orders JOIN pt AS p ON p.point = o_custkey""".replace("JOIN pt AS p ON p.point", "JOIN (SELECT point, lat, lon FROM pt) p ON p.point"))


def answers(t):
    names = lambda col: F.when(col.isNull(), F.array().cast("array<string>")).otherwise(F.array(col))
    return (t.route_row.withColumn("ferries", names(c("ferry"))).withColumn("prod_ferries", names(c("ferry")))
            .withColumn("expected", F.when(c("expected").isNotNull(), F.array("expected"))))


ROUTES = f"""rw AS (SELECT *, {haversine('from_lat', 'from_lon', 'to_lat', 'to_lon', 6371.0)} AS d FROM route_row),
    rv AS (SELECT answer, concat_ws(',', CASE WHEN km IS NULL THEN 'no route' END, CASE WHEN km IS NOT NULL AND expected IS NULL AND ferry IS NOT NULL THEN 'ferry where a land route is expected' END,
      CASE WHEN km IS NOT NULL AND expected IS NOT NULL AND NOT contains(coalesce(ferry, ''), expected) THEN 'wrong ferry' END, CASE WHEN km IS NOT NULL AND channel AND contains(coalesce(ferry, ''), 'Jersey') THEN 'Channel Islands' END,
      CASE WHEN km IS NOT NULL AND d > 30 AND km > 2.5e0 * d THEN 'detour' END) AS why, accepted, coalesce(abs(km - prod_km) < 0.05, false) AS same FROM rw),
    rj AS (SELECT answer, why, CASE WHEN why = '' THEN 'PASS' WHEN accepted THEN 'ACCEPTED' WHEN same THEN 'KNOWN' ELSE 'FAIL' END AS verdict FROM rv)"""


@query("v18_routes_verdict", f"WITH {ROUTES} SELECT * FROM rj")
def v18(t):
    return routes.routes_verdict(answers(t)).select("answer", F.array_join("why", ",").alias("why"), "verdict")


@query("a18_verdict_counts", f"""WITH {ROUTES} SELECT count(*) FILTER (WHERE verdict = 'PASS') AS "PASS", count(*) FILTER (WHERE verdict = 'KNOWN') AS "KNOWN", count(*) FILTER (WHERE verdict = 'ACCEPTED') AS "ACCEPTED", count(*) FILTER (WHERE verdict = 'FAIL') AS "FAIL" FROM rj""")
def a18(t):
    return routes.verdict_counts(routes.routes_verdict(answers(t)))


# ---- probes ----------------------------------------------------------------------------------

view("probe_row", """SELECT o_orderkey AS probe, CASE o_orderkey % 6 WHEN 0 THEN 'oneway' WHEN 1 THEN 'grade_separation' WHEN 2 THEN 'timezone' WHEN 3 THEN 'admin' WHEN 4 THEN 'border' ELSE 'corridor' END AS kind,
    CASE WHEN o_orderkey % 31 > 0 THEN o_custkey + 100 END AS with_m, CASE WHEN o_orderkey % 37 > 0 THEN o_custkey * 2 END AS against_m, o_custkey % 60 + 20 AS gap_m, CASE WHEN o_orderkey % 29 > 0 THEN o_custkey * 7 END AS driven_m, o_orderkey % 41 > 0 AS routed,
    'Z' || CAST(o_custkey % 2 AS STRING) AS expect, CASE WHEN o_orderkey % 5 > 0 THEN 'Z' || CAST(o_orderkey % 3 % 2 AS STRING) END AS got, CASE WHEN o_orderkey % 43 > 0 THEN floor(o_totalprice) / 1000 END AS km, 20e0 AS min_km, 400e0 AS max_km,
    CASE WHEN o_orderkey % 47 > 0 THEN (o_orderkey % 60) / 10e0 END AS gap_km, CASE WHEN o_orderkey % 4 > 0 THEN 'MD' END AS through, CASE o_orderkey % 3 WHEN 0 THEN 'MD' WHEN 1 THEN 'RO' END AS seen FROM orders""")
PROBES = """pj AS (SELECT probe, kind, CASE kind WHEN 'oneway' THEN CASE WHEN with_m IS NULL OR against_m IS NULL THEN 'no route in one or both directions' WHEN against_m < with_m * 1.4 THEN 'the directions agree' END
      WHEN 'grade_separation' THEN CASE WHEN driven_m IS NULL THEN 'no route' WHEN driven_m < gap_m * 5 THEN 'the bridge has become a junction' WHEN driven_m > 8000 THEN 'far beyond any detour' END
      WHEN 'border' THEN li WHEN 'corridor' THEN coalesce(li, CASE WHEN through IS NOT NULL AND seen IS NULL THEN 'countries unchecked' WHEN through IS NOT NULL AND through <> seen THEN 'never entered a country' END)
      ELSE CASE WHEN NOT routed THEN 'the probe points do not route' WHEN got IS NULL THEN 'nothing reported' WHEN got <> expect THEN 'another answer' END END AS reason
    FROM (SELECT *, CASE WHEN km IS NULL THEN 'no route' WHEN km NOT BETWEEN min_km AND max_km THEN 'length out of range' WHEN gap_km IS NULL THEN 'no geometry' WHEN gap_km > 5 THEN 'the geometry jumps' END AS li FROM probe_row))"""


def probed(t):
    listed = lambda col: F.when(c(col).isNull(), F.array().cast("array<string>")).otherwise(F.array(col))
    return routes.probe_verdict(t.probe_row.withColumns({k: listed(k) for k in ("got", "through", "seen")}))


@query("v20_probe_verdict", f"WITH {PROBES} SELECT * FROM pj")
def v20(t):
    return probed(t).select("probe", "kind", "reason")


@query("v21_continuity", f"""WITH p AS (SELECT id, seq, sum(dlat) OVER w / 1e6 AS lat, sum(dlon) OVER w / 1e6 AS lon FROM leg WINDOW w AS (PARTITION BY id ORDER BY seq)),
    s AS (SELECT id, {haversine('lat', 'lon', 'lat2', 'lon2', 6371.0)} AS km FROM (SELECT *, lead(lat) OVER w AS lat2, lead(lon) OVER w AS lon2 FROM p WINDOW w AS (PARTITION BY id ORDER BY seq)))
    SELECT o_orderkey AS id, round(g, 7) AS gap_km, g > 5 AS broken FROM orders LEFT JOIN (SELECT id, coalesce(max(km), 0) AS g FROM s GROUP BY id) x ON x.id = o_orderkey""")
def v21(t):
    shapes = t.orders.select(c("o_orderkey").alias("id")).join(t.shape, "id", "left")
    return routes.continuity(shapes, ["id"]).select("id", F.round("gap_km", 7).alias("gap_km"), "broken")


view("reg_probe", "SELECT o_orderkey AS probe, CAST(o_custkey % 25 AS STRING) AS n1, CAST(o_orderkey % 25 AS STRING) AS n2, floor(o_totalprice) / 1000 AS km_about, 5e0 AS km_tol, o_orderkey % 4 AS seams FROM orders")
view("reg_answer", "SELECT o_orderkey AS probe, CASE WHEN o_orderkey % 18 > 0 THEN floor(o_totalprice) / 1000 + o_custkey % 7 END AS km, o_orderkey % 4 + CASE WHEN o_orderkey % 16 = 0 THEN 1 ELSE 0 END AS seams, CASE WHEN o_orderkey % 50 = 0 THEN 2 ELSE 0 END AS lost FROM orders WHERE o_orderkey % 60 > 0")
REGRESS = """hv AS (SELECT CAST(n_nationkey AS VARCHAR) AS country FROM nation WHERE n_regionkey < 4), rg AS (SELECT p.probe, CASE WHEN n1 NOT IN (SELECT country FROM hv) OR n2 NOT IN (SELECT country FROM hv) THEN NULL ELSE concat_ws('; ', CASE WHEN km IS NULL THEN 'no route' END, CASE WHEN abs(km - km_about) > km_tol THEN 'length out of tolerance' END,
      CASE WHEN km IS NOT NULL AND a.seams <> p.seams THEN 'seam count' END, CASE WHEN lost > 0 THEN 'lost region' END) END AS reason FROM reg_probe p LEFT JOIN reg_answer a ON a.probe = p.probe),
    rgv AS (SELECT probe, CASE WHEN reason IS NULL THEN 'skipped' WHEN reason = '' THEN 'ok' ELSE 'FAIL' END AS verdict, reason FROM rg)"""


def regressed(t):
    have = t.nation.filter("n_regionkey < 4").select(c("n_nationkey").cast("string").alias("country"))
    return routes.regression_verdict(t.reg_probe.withColumn("needs", F.array("n1", "n2")), t.reg_answer, have)


@query("v22_regression_verdict", f"WITH {REGRESS} SELECT * FROM rgv")
def v22(t):
    return regressed(t)


@query("v22_regression_summary", f"WITH {REGRESS} SELECT count(*) FILTER (WHERE verdict <> 'skipped') AS ran, count(*) FILTER (WHERE verdict = 'FAIL') AS failed, CASE WHEN count(*) FILTER (WHERE verdict <> 'skipped') > 0 AND count(*) FILTER (WHERE verdict = 'FAIL') = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM rgv")
def v22_summary(t):
    return routes.regression_summary(regressed(t))


view("seam_row", """SELECT o_orderkey AS seam, CASE WHEN o_orderkey % 11 > 0 THEN floor(o_totalprice) / 500 END AS km, CASE WHEN o_orderkey % 13 > 0 THEN o_custkey * 20 END AS seconds, 500e0 AS expect_km, CASE WHEN o_orderkey % 17 > 0 THEN (o_orderkey % 55) / 10e0 END AS gap_km,
    CASE WHEN o_orderkey % 10 > 0 THEN 100 + o_orderkey % 6 END AS control_a_km, 100 AS control_a_known, 200 + o_orderkey % 3 AS control_b_km, 200 AS control_b_known FROM orders""")


@query("v23_seam_verdict", """WITH s AS (SELECT *, CASE WHEN km IS NULL THEN 'BROKEN' WHEN gap_km > 5 THEN 'CORRUPT' WHEN km / (nullif(seconds, 0) / 3600e0) > 130 THEN 'CORRUPT' WHEN km < expect_km * 0.9 THEN 'SUSPECT' WHEN km > expect_km * 1.15 THEN 'DETOURS' ELSE 'HOLDS' END AS seen,
      coalesce(abs(control_a_km - control_a_known) / control_a_known * 100 < 5, false) AND coalesce(abs(control_b_km - control_b_known) / control_b_known * 100 < 5, false) AS ok FROM seam_row)
    SELECT seam, CASE WHEN ok THEN seen ELSE 'INCONCLUSIVE' END AS verdict, seen, ok AS controls_ok FROM s""")
def v23(t):
    return routes.seam_verdict(t.seam_row)


view("zone_seen", "SELECT 'l' || CAST(c_nationkey AS STRING) AS label, c_mktsegment AS name, CASE c_custkey % 3 WHEN 0 THEN 'graph' ELSE 'route' END AS source, 'Z' || CAST(c_custkey % 5 AS STRING) AS zone FROM customer")


@query("v24_zone_diagnosis", """WITH w AS (SELECT label, name, max(zone) FILTER (WHERE source = 'graph') AS graph, max(zone) FILTER (WHERE source = 'route') AS route FROM zone_seen GROUP BY label, name), p AS (SELECT DISTINCT c_mktsegment AS name, 'Z4' AS expect FROM customer)
    SELECT label, w.name, graph, route, expect, graph IS NOT DISTINCT FROM route AS agree, graph IS NOT NULL AND graph <> expect AS wrong FROM w JOIN p ON p.name = w.name""")
def v24(t):
    points = t.customer.select(c("c_mktsegment").alias("name"), F.lit("Z4").alias("expect")).distinct()
    return routes.zone_diagnosis(points, t.zone_seen)


view("question", "SELECT CASE l_linenumber % 3 WHEN 0 THEN 'struct' WHEN 1 THEN 'transit' ELSE 'routes' END AS section, CAST(l_orderkey AS STRING) AS key, CAST(l_partkey AS STRING) AS at FROM li")
view("recorded", "SELECT CASE l_linenumber % 3 WHEN 0 THEN 'struct' WHEN 1 THEN 'transit' ELSE 'routes' END AS section, CAST(l_orderkey AS STRING) AS key, CAST(CASE WHEN l_orderkey % 12 = 0 THEN l_partkey + 1 ELSE l_partkey END AS STRING) AS at FROM li WHERE l_orderkey % 25 > 0")


@query("v27_baseline_coverage", """SELECT section, key, at AS "at" FROM question q WHERE NOT EXISTS (SELECT 1 FROM recorded r WHERE r.section = q.section AND r.key = q.key AND r.at = q.at)""".replace("at AS \"at\"", "q.at AS \"at\"").replace("r.at = q.at", "r.\"at\" = q.\"at\"").replace("q.at AS", "q.\"at\" AS"))
def v27(t):
    return routes.baseline_coverage(t.question, t.recorded)


@query("v28_cut_verdict", f"""WITH {PROBES}, mb AS (SELECT CAST(n_regionkey AS VARCHAR) AS plan, CAST(n_nationkey AS VARCHAR) AS country FROM nation), cu AS (SELECT country FROM mb WHERE country NOT IN ('3', '8')),
    pb AS (SELECT CAST(probe % 5 AS VARCHAR) AS plan, CASE WHEN probe % 7 > 0 THEN CAST(probe % 25 AS VARCHAR) END AS country, reason, kind FROM pj),
    f AS (SELECT plan, count(reason) AS failed FROM pb WHERE (country IS NULL OR kind <> 'border') AND (country IS NULL OR country IN (SELECT country FROM cu)) GROUP BY plan), x AS (SELECT plan, count(*) FILTER (WHERE country NOT IN (SELECT country FROM cu)) AS uncut FROM mb GROUP BY plan)
    SELECT x.plan, uncut, coalesce(failed, 0) AS failed, CASE WHEN uncut + coalesce(failed, 0) = 0 THEN 'PROMOTABLE' ELSE 'BLOCKED' END AS verdict FROM x LEFT JOIN f ON f.plan = x.plan""")
def v28(t):
    members = t.nation.select(c("n_regionkey").cast("string").alias("plan"), c("n_nationkey").cast("string").alias("country"))
    probes = probed(t).select((c("probe") % 5).cast("string").alias("plan"), F.when(c("probe") % 7 > 0, (c("probe") % 25).cast("string")).alias("country"), "reason", "kind")
    return routes.cut_verdict(members, members.filter(~c("country").isin("3", "8")).select("country"), probes)


# ---- basemaps --------------------------------------------------------------------------------

LAYERS = ("earth", "water", "landuse", "roads", "buildings", "places", "boundaries")
view("layer_row", "SELECT CAST(o_custkey AS STRING) AS archive, CASE o_orderkey % 8 WHEN 0 THEN 'earth' WHEN 1 THEN 'water' WHEN 2 THEN 'landuse' WHEN 3 THEN 'roads' WHEN 4 THEN 'buildings' WHEN 5 THEN 'places' WHEN 6 THEN 'boundaries' ELSE 'pois' END AS layer FROM orders")


def archives(t):
    return t.layer_row.groupBy("archive").agg(F.collect_set("layer").alias("layers"))


MISSING = "ml AS (SELECT archive, layer FROM (SELECT DISTINCT archive FROM layer_row), (VALUES ('earth'), ('water'), ('landuse'), ('roads'), ('buildings'), ('places'), ('boundaries')) v(layer) WHERE archive || layer NOT IN (SELECT archive || layer FROM layer_row))"


@query("u06_required_layers", f"WITH {MISSING} SELECT * FROM ml")
def u06(t):
    return archive.missing_layers(archives(t))


@query("v26_basemap_gate", f"""WITH {MISSING}, q AS (SELECT CAST(point AS VARCHAR) AS archive, name, CAST(trunc((lon + 180) / 360e0 * 1024) AS BIGINT) AS x, CAST(trunc((1 - asinh(tan(radians(lat))) / pi()) / 2e0 * 1024) AS BIGINT) AS y FROM pt)
    SELECT archive, 'no layer ' || layer AS rule FROM ml UNION ALL SELECT archive, 'no tile over ' || name FROM q WHERE x % 2 = 0 OR y % 3 = 0""")
def v26(t):
    from atlas.functions import geo
    points = t.pt.select(c("point").cast("string").alias("archive"), "name", "lat", "lon")
    tiles = points.select("archive", F.lit(10).alias("z"), geo.web_tile(c("lat"), c("lon"), F.lit(10)).alias("w")).select("archive", "z", "w.*").filter("x % 2 <> 0 and y % 3 <> 0")
    return archive.basemap_gate(archives(t), points, tiles)


_ = views
