"""Release tables: tiles, rebuild decisions, manifests, package index, retention."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlas.operators import release as ops
from atlas.plans import release as plans
from atlas.queries import views
from atlas.queries.base import Tables, query, view

c = F.col

# two builds of a tile set: an order is a tile, its line total and a digest are its content
view("tile_old", "SELECT '2/' || CAST(o_orderkey AS STRING) || '.gph' AS path, CAST(floor(o_totalprice) AS BIGINT) AS bytes, md5('s' || CAST(o_orderkey AS STRING)) AS sha, md5('b' || CAST(o_orderkey AS STRING)) AS body_sha FROM orders WHERE o_orderkey % 11 <> 3")
view("tile_new", """SELECT '2/' || CAST(o_orderkey AS STRING) || '.gph' AS path, CAST(floor(o_totalprice) AS BIGINT) + CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS bytes,
    md5(CASE WHEN o_orderkey % 3 = 0 THEN 's' ELSE 't' END || CAST(o_orderkey AS STRING)) AS sha, md5(CASE WHEN o_orderkey % 4 = 1 THEN 'c' ELSE 'b' END || CAST(o_orderkey AS STRING)) AS body_sha FROM orders WHERE o_orderkey % 13 <> 4""")
DELTA = """delta AS (SELECT coalesce(n.path, o.path) AS path, CASE WHEN o.path IS NULL THEN 'added' WHEN n.path IS NULL THEN 'removed' WHEN o.bytes = n.bytes AND o.sha = n.sha THEN 'identical'
    WHEN o.bytes = n.bytes AND o.body_sha = n.body_sha THEN 'stamp only' ELSE 'changed' END AS what, coalesce(n.bytes, 0) AS bytes FROM tile_new n FULL JOIN tile_old o ON o.path = n.path)"""


@query("j17_tile_delta", f"WITH {DELTA} SELECT * FROM delta")
def j17(t):
    return ops.tile_delta(t.tile_old, t.tile_new)


@query("j17_tile_delta_summary", f"""WITH {DELTA}, s AS (SELECT count(*) FILTER (WHERE what = 'identical') AS identical, count(*) FILTER (WHERE what = 'stamp only') AS stamp_only, count(*) FILTER (WHERE what = 'changed') AS changed,
    count(*) FILTER (WHERE what = 'added') AS added, count(*) FILTER (WHERE what = 'removed') AS removed, count(*) FILTER (WHERE what <> 'removed') AS total, CAST(sum(bytes) FILTER (WHERE what IN ('changed', 'added')) AS BIGINT) AS moved_bytes, CAST(sum(bytes) AS BIGINT) AS total_bytes FROM delta)
    SELECT *, CASE WHEN changed * 2 > total THEN 'rewritten' WHEN stamp_only > 0 THEN 'stamp blocks delta' ELSE 'delta' END AS verdict FROM s""")
def j17_summary(t):
    return ops.tile_delta_summary(ops.tile_delta(t.tile_old, t.tile_new))


@query("u01_path_sets", "SELECT path, 'added' AS what FROM tile_new WHERE path NOT IN (SELECT path FROM tile_old) UNION ALL SELECT path, 'removed' FROM tile_old WHERE path NOT IN (SELECT path FROM tile_new) UNION ALL SELECT path, 'shared' FROM tile_new WHERE path IN (SELECT path FROM tile_old)")
def u01(t):
    return ops.path_sets(t.tile_old, t.tile_new)


view("country_tile", "SELECT 'C' || CAST(l_linenumber AS STRING) AS country, '2/' || CAST(l_partkey AS STRING) AS path, min(md5(CAST(l_partkey AS STRING) || CASE WHEN l_suppkey % 3 = 0 THEN 'x' ELSE '' END)) AS sha FROM lineitem GROUP BY l_linenumber, l_partkey")


@query("j18_shared_tile_identity", "SELECT a.country AS a, b.country AS b, count(*) AS shared, count(*) FILTER (WHERE a.sha = b.sha) AS identical FROM country_tile a JOIN country_tile b ON a.path = b.path AND a.country < b.country GROUP BY a.country, b.country")
def j18(t):
    return ops.shared_tile_identity(t.country_tile)


view("owned_tile", "SELECT CAST(l_linenumber % 3 AS INT) AS level, l_partkey AS tile_id, CAST(l_suppkey % 9 AS STRING) AS country FROM lineitem GROUP BY 1, 2, 3")


@query("j19_cut_overhead", """WITH ti AS (SELECT level, tile_id, tile_id * 10 + 5 AS bytes FROM owned_tile GROUP BY level, tile_id), h AS (SELECT level, tile_id, count(*) AS n FROM owned_tile GROUP BY ALL)
    SELECT count(*) AS tiles, CAST(sum(bytes) AS BIGINT) AS bytes, count(*) FILTER (WHERE n > 1) AS shared, CAST(sum(n * bytes) AS BIGINT) AS cut_bytes, round(CAST(sum(n * bytes) AS DOUBLE) / CAST(sum(bytes) AS DOUBLE), 9) AS overhead FROM ti JOIN h USING (level, tile_id)""")
def j19_overhead(t):
    tiles = t.owned_tile.select("level", "tile_id").distinct().withColumn("bytes", c("tile_id") * 10 + 5)
    return ops.cut_overhead(tiles, t.owned_tile).withColumn("overhead", F.round("overhead", 9))


# a manifest: every order is a country release; the previous one knows most of them
_REG = """SELECT code, k, CAST(k % 300 AS INT) AS region_id, day AS graph_version, code || '-' || day || '.tar' AS package, base || '/' || code || '-' || day || '.tar' AS url, size AS bytes, md5('p' || code) AS sha256, md5(cust) AS pbf,
    CASE WHEN k % 9 <> 0 THEN md5(cust) END AS src_md5, CASE WHEN k % 8 <> 0 THEN md5('f' || code) END AS src_sha, CASE WHEN k % 10 <> 0 THEN day || 'T20:21:22Z' END AS replication, 'e' || CAST(k % {e} AS STRING) AS engine_sha, CASE WHEN k % 12 <> 0 THEN 'd' || CAST(k % 2 AS STRING) END AS engine_digest, 't' || CAST(k % {z} AS STRING) AS tz_sha,
    CASE WHEN k % {f} <> 0 THEN code || '.frontier' END AS fr_file, CASE WHEN k % 10 = 5 THEN NULL WHEN k % 8 = 1 THEN md5('x') ELSE md5(cust) END AS fr_md5, CASE WHEN k % 10 = 5 THEN 'graph-only' END AS fr_source,
    CASE WHEN k % {g} <> 0 THEN code || '.features' END AS fe_file, CASE WHEN k % 7 = 1 THEN NULL ELSE md5(cust) END AS fe_md5, CASE WHEN k % {b} <> 0 THEN code || '.lanes' END AS bl_file, md5(cust) AS bl_md5,
    CASE WHEN k % {m} <> 0 THEN code || '.map' END AS map_file, CASE WHEN k % {s} <> 0 THEN code || '.search' END AS se_file, CASE WHEN k % 14 = 3 THEN md5('y') ELSE md5(cust) END AS ad_md5, k % 3 = 0 AS split, CASE WHEN k % 30 = 0 THEN 1 ELSE 0 END AS gap, base
    FROM (SELECT 'R' || CAST(o_orderkey AS STRING) AS code, o_orderkey AS k, substr(CAST(o_orderdate AS STRING), 1, 10) AS day, 'https://host.example/download/v' || CAST(o_orderkey % 5 AS STRING) AS base, CAST(floor(o_totalprice) AS BIGINT) AS size, CAST(o_custkey AS STRING) AS cust FROM orders WHERE {w})"""
view("reg", _REG.format(e=3, z=2, f=5, g=4, b=6, m=7, s=8, w="o_orderkey % 17 <> 1"))
view("reg_prev", _REG.format(e=3, z=3, f=11, g=13, b=10, m=9, s=12, w="o_orderkey % 7 <> 2"))
view("built", "SELECT 'R' || CAST(o_orderkey AS STRING) AS code FROM orders WHERE o_orderstatus = 'F'")


def nested(flat: DataFrame) -> DataFrame:
    side = lambda prefix, file, extra=(): F.when(c(file).isNotNull(), F.struct(
        F.lit(f"atlas-{prefix}/1").alias("format"), c(file).alias("file"), F.concat_ws("/", "base", c(file)).alias("url"), (c("bytes") % 1000).alias("bytes"),
        F.md5(c(file)).alias("sha256"), *extra))
    half = lambda file, extra=(): F.when(c(file).isNotNull(), F.struct(
        c(file).alias("file"), F.concat_ws("/", "base", c(file)).alias("url"), (c("bytes") % 500).alias("bytes"), F.md5(c(file)).alias("sha256"),
        F.lit(None).cast("array<struct<name:string,bytes:bigint,sha256:string>>").alias("parts"), *extra))
    first = F.floor(c("bytes") / 2)
    part = lambda n, size: F.struct(F.concat("package", F.lit(f".{n}")).alias("name"), size.alias("bytes"), F.md5(F.concat("package", F.lit(f".{n}"))).alias("sha256"))
    parts = F.when(c("split"), F.array(part(0, first), part(1, c("bytes") - first + c("gap"))))
    return flat.select(
        "code", "region_id", "graph_version", "package", "url", "bytes", "sha256", "engine_sha", "engine_digest", parts.alias("parts"),
        F.struct(c("src_md5").alias("md5"), c("src_sha").alias("sha256"), "replication").alias("source"), F.struct(c("tz_sha").alias("sha256")).alias("timezones"),
        side("frontier", "fr_file", (c("fr_md5").alias("source_md5"), c("fr_source").alias("source"))).alias("frontier"),
        side("features", "fe_file", (c("fe_md5").alias("source_md5"),)).alias("features"), side("buslanes", "bl_file", (c("bl_md5").alias("source_md5"),)).alias("bus_lanes"),
        half("map_file").alias("map"), half("se_file", (F.struct(c("ad_md5").alias("source_md5")).alias("addresses"),)).alias("search"))


view("regions_now", "SELECT code FROM reg", lambda t: nested(t.reg))
view("regions_before", "SELECT code FROM reg_prev", lambda t: nested(t.reg_prev))

DECIDE = """want AS (SELECT 'R' || CAST(o_orderkey AS VARCHAR) AS code, md5(CAST(o_custkey - CASE WHEN o_orderkey % 19 = 0 THEN 1 ELSE 0 END AS VARCHAR)) AS md5 FROM orders),
    dec AS (SELECT w.code, CASE WHEN p.code IS NULL THEN 'not in the current manifest' WHEN p.src_md5 IS NULL THEN 'no source md5 recorded' WHEN p.src_md5 <> w.md5 THEN 'extract changed' WHEN p.engine_sha <> 'e1' THEN 'engine changed' WHEN p.tz_sha <> 't1' THEN 'time zones changed' END AS reason
      FROM want w LEFT JOIN reg_prev p ON p.code = w.code)"""


def wanted(t):
    off = F.when(c("o_orderkey") % 19 == 0, 1).otherwise(0)
    return t.orders.select(F.concat(F.lit("R"), c("o_orderkey").cast("string")).alias("code"), F.md5((c("o_custkey") - off).cast("string")).alias("md5"))


@query("j27_rebuild_decision", f"WITH {DECIDE} SELECT code, reason IS NOT NULL AS rebuild, reason FROM dec")
def j27(t):
    return ops.rebuild_decision(wanted(t), t.regions_before, "e1", "t1")


@query("j28_effective_set", """WITH a AS (SELECT 'R' || CAST(o_orderkey AS VARCHAR) AS code, o_orderkey % 4 <> 0 AS g, o_orderkey % 6 <> 0 AS b FROM orders)
    SELECT a.code, CASE WHEN g AND b THEN 'rebuilt' WHEN p.code IS NOT NULL THEN 'carried' ELSE 'absent' END AS outcome, CASE WHEN g AND b THEN NULL WHEN NOT g AND NOT b THEN 'graph and map/search jobs failed' WHEN NOT g THEN 'graph job failed' ELSE 'map/search job failed' END AS reason
    FROM a LEFT JOIN reg_prev p ON p.code = a.code""")
def j28(t):
    code = F.concat(F.lit("R"), c("o_orderkey").cast("string")).alias("code")
    return ops.effective_set(t.orders.select(code), t.orders.filter("o_orderkey % 4 <> 0").select(code), t.orders.filter("o_orderkey % 6 <> 0").select(code), t.regions_before)


IDENTITY = """st AS (SELECT code, src_md5 AS graph, unnest(['frontier', 'features', 'bus_lanes', 'addresses']) AS what, unnest([CASE WHEN fr_file IS NULL THEN NULL WHEN fr_source = 'graph-only' THEN 'graph-only' ELSE fr_md5 END,
      CASE WHEN fe_file IS NOT NULL THEN fe_md5 END, CASE WHEN bl_file IS NOT NULL THEN bl_md5 END, CASE WHEN se_file IS NOT NULL THEN ad_md5 END]) AS stamp FROM reg),
    ident AS (SELECT code, what, CASE WHEN stamp = 'graph-only' THEN NULL WHEN stamp IS NULL AND code IN (SELECT code FROM built) THEN 'no source identity' WHEN stamp IS NOT NULL AND stamp IS DISTINCT FROM graph THEN 'other source than the graph' END AS problem FROM st
      UNION ALL SELECT code, 'graph', 'the graph has no source md5' FROM reg WHERE src_md5 IS NULL AND code IN (SELECT code FROM built))"""
BLOCKS = """bl(code, block) AS (SELECT code, unnest(list_filter([CASE WHEN map_file IS NOT NULL THEN 'map' END, CASE WHEN se_file IS NOT NULL THEN 'search' END, CASE WHEN fr_file IS NOT NULL THEN 'frontier' END, CASE WHEN fe_file IS NOT NULL THEN 'features' END, CASE WHEN bl_file IS NOT NULL THEN 'bus_lanes' END], lambda x: x IS NOT NULL)) FROM reg),
    pb(code, block) AS (SELECT code, unnest(list_filter([CASE WHEN map_file IS NOT NULL THEN 'map' END, CASE WHEN se_file IS NOT NULL THEN 'search' END, CASE WHEN fr_file IS NOT NULL THEN 'frontier' END, CASE WHEN fe_file IS NOT NULL THEN 'features' END, CASE WHEN bl_file IS NOT NULL THEN 'bus_lanes' END], lambda x: x IS NOT NULL)) FROM reg_prev),
    lost AS (SELECT pb.code, pb.block FROM pb WHERE code IN (SELECT code FROM reg) AND code NOT IN (SELECT code FROM built) AND NOT EXISTS (SELECT 1 FROM bl WHERE bl.code = pb.code AND bl.block = pb.block))"""


@query("j29_source_identity", f"WITH {IDENTITY} SELECT * FROM ident WHERE problem IS NOT NULL")
def j29(t):
    return ops.source_identity(t.regions_now, t.built)


@query("j30_carry_losses", f"WITH {BLOCKS} SELECT * FROM lost")
def j30(t):
    return ops.carry_losses(t.regions_now, t.regions_before, t.built)


view("catalog_row", "SELECT 'R' || CAST(o_orderkey AS STRING) AS code, CAST(o_orderkey % 300 + CASE WHEN o_orderkey % 31 = 0 THEN 1 ELSE 0 END AS INT) AS region_id, 'europe/' || CAST(o_custkey AS STRING) AS path FROM orders")
view("border_row", "SELECT 'R' || CAST(o_orderkey AS STRING) AS a, 'R' || CAST(o_orderkey + 1 AS STRING) AS b, o_orderkey % 2 = 0 AS legacy FROM orders")
view("absent_row", "SELECT 'R' || CAST(o_orderkey AS STRING) AS code FROM orders WHERE o_orderkey % 34 = 1")
view("table_row", """SELECT a || '-' || b AS pair, a || '-' || b || '.portals' AS file, 'https://host.example/download/v' || CAST(k % 2 AS STRING) || '/' || a || '-' || b || '.portals' AS url, k * 3 AS bytes, md5(a) AS sha256, va, vb
    FROM (SELECT 'R' || CAST(o_orderkey AS STRING) AS a, 'R' || CAST(o_orderkey + 1 AS STRING) AS b, o_orderkey AS k, 'R' || CAST(o_orderkey AS STRING) || '-' || substr(CAST(o_orderdate AS STRING), 1, 10) AS va, 'R' || CAST(o_orderkey + 1 AS STRING) || '-2000-01-01' AS vb FROM orders WHERE o_orderkey % 3 = 0)""")
COMPLETE = """comp AS (SELECT c.code AS subject, CASE WHEN r.code IS NULL THEN CASE WHEN a.code IS NULL THEN 'missing' END WHEN r.region_id <> c.region_id THEN 'other region id' WHEN r.fr_file IS NULL THEN 'no frontier' END AS problem
      FROM catalog_row c LEFT JOIN reg r ON r.code = c.code LEFT JOIN absent_row a ON a.code = c.code
    UNION ALL SELECT a || '-' || b, 'no table' FROM border_row WHERE legacy AND a NOT IN (SELECT code FROM absent_row) AND b NOT IN (SELECT code FROM absent_row) AND a || '-' || b NOT IN (SELECT pair FROM table_row))"""


@query("j31_completeness", f"WITH {COMPLETE} SELECT * FROM comp WHERE problem IS NOT NULL")
def j31(t):
    return ops.completeness(t.catalog_row, t.border_row, t.regions_now, t.table_row, t.absent_row)


ASSETS = """assets AS (SELECT code, 'graph' AS block, package AS name, url, bytes, sha256 FROM reg WHERE NOT split
    UNION ALL SELECT code, 'graph', package || '.0', base || '/' || package || '.0', CAST(floor(bytes / 2) AS BIGINT), md5(package || '.0') FROM reg WHERE split
    UNION ALL SELECT code, 'graph', package || '.1', base || '/' || package || '.1', CAST(bytes - floor(bytes / 2) + gap AS BIGINT), md5(package || '.1') FROM reg WHERE split
    UNION ALL SELECT code, 'frontier', fr_file, base || '/' || fr_file, bytes % 1000, md5(fr_file) FROM reg WHERE fr_file IS NOT NULL
    UNION ALL SELECT code, 'features', fe_file, base || '/' || fe_file, bytes % 1000, md5(fe_file) FROM reg WHERE fe_file IS NOT NULL
    UNION ALL SELECT code, 'bus_lanes', bl_file, base || '/' || bl_file, bytes % 1000, md5(bl_file) FROM reg WHERE bl_file IS NOT NULL
    UNION ALL SELECT code, 'map', map_file, base || '/' || map_file, bytes % 500, md5(map_file) FROM reg WHERE map_file IS NOT NULL
    UNION ALL SELECT code, 'search', se_file, base || '/' || se_file, bytes % 500, md5(se_file) FROM reg WHERE se_file IS NOT NULL)"""


@query("p16_exploded_assets", f"WITH {ASSETS} SELECT * FROM assets")
def p16(t):
    return ops.exploded_assets(t.regions_now)


@query("p16_release_assets", f"WITH {ASSETS} SELECT name, bytes FROM assets WHERE url LIKE '%/download/v2/%'")
def p16_release(t):
    return ops.release_assets(ops.exploded_assets(t.regions_now), "v2").select("name", "bytes")


# what is really there: most frontier and map files, some with another size, and strangers
view("listing", """SELECT fr_file AS name, bytes % 1000 + CASE WHEN k % 23 = 0 THEN 1 ELSE 0 END AS bytes, md5(fr_file) AS sha256 FROM reg WHERE fr_file IS NOT NULL AND k % 21 <> 0
    UNION ALL SELECT map_file, bytes % 500, CASE WHEN k % 25 = 0 THEN 'broken' ELSE md5(map_file) END FROM reg WHERE map_file IS NOT NULL UNION ALL SELECT 'extra' || CAST(o_orderkey AS STRING), o_custkey, md5('e') FROM orders WHERE o_orderkey % 40 = 0""")
RECONCILE = "rec AS (SELECT coalesce(a.name, l.name) AS name, CASE WHEN l.name IS NULL THEN 'missing' WHEN a.name IS NULL THEN 'unexpected' WHEN a.bytes = l.bytes AND a.sha256 = l.sha256 THEN 'ok' ELSE 'mismatch' END AS verdict FROM {0} a FULL JOIN listing l ON l.name = a.name)"


@query("j32_asset_reconcile", f"WITH {ASSETS}, {RECONCILE.format('assets')} SELECT * FROM rec")
def j32(t):
    return ops.asset_reconcile(ops.exploded_assets(t.regions_now), t.listing)


# the package index: customers are packages; the run brings new halves for some
view("pkg_old", """SELECT 'pk' || CAST(c_custkey AS STRING) AS package, c_name AS countries, CASE WHEN c_custkey % 4 > 0 THEN 'old-g' || CAST(c_custkey AS STRING) END AS g, CASE WHEN c_custkey % 5 > 0 THEN 'old-b' || CAST(c_custkey AS STRING) END AS b, CASE WHEN c_custkey % 3 > 0 THEN 'old-i' || CAST(c_custkey AS STRING) END AS i, '2024-03-' || lpad(CAST(c_custkey % 28 + 1 AS STRING), 2, '0') AS day FROM customer WHERE c_custkey % 6 <> 1""")
view("pkg_new", """SELECT 'pk' || CAST(c_custkey AS STRING) AS package, c_custkey % 7 <> 0 AS tz, '2024-04-' || lpad(CAST(c_custkey % 30 + 1 AS STRING), 2, '0') AS day, c_custkey % 2 = 0 AS has_g, c_custkey % 8 < 3 AS has_b, c_custkey % 9 = 0 AS has_i, c_custkey % 10 <> 0 AS uploaded, CASE WHEN c_custkey % 3 = 0 THEN 'plan ' || c_name END AS planned FROM customer""")


def index_parts(t: Tables):
    half = lambda col, day: F.when(c(col).isNotNull(), F.struct(c(col).alias("url"), F.lit(1).cast("bigint").alias("bytes"), F.md5(c(col)).alias("sha256"), day.alias("dataDate")))
    index = t.pkg_old.select("package", F.array("countries").alias("countries"), half("g", c("day")).alias("graph"), half("b", c("day")).alias("basemap"), half("i", F.lit(None).cast("string")).alias("index"))
    n = t.pkg_new
    name = lambda ext: F.concat("package", F.lit("-"), "day", F.lit(f".{ext}"))
    asset = lambda rows, col: rows.filter("uploaded").select(col.alias("name"), F.concat(F.lit("new/"), col).alias("url"), F.lit(2).cast("bigint").alias("bytes"), F.md5(col).alias("sha256"))
    assets = asset(n.filter("has_g"), name("tar")).unionByName(asset(n.filter("has_b"), name("pmtiles"))).unionByName(asset(n.filter("has_i"), F.concat("package", F.lit("-index.json"))))
    graphs = n.filter("has_g").select("package", c("day").alias("dataDate"), c("tz").alias("timezones"))
    basemaps = n.filter("has_b").select("package", c("day").alias("dataDate"))
    planned = n.filter("planned is not null").select("package", F.array("planned").alias("countries"))
    return index, graphs, basemaps, n.filter("has_i").select("package"), assets, planned


INDEX = """idx AS (SELECT coalesce(o.package, n.package) AS package, CASE WHEN has_g AND tz AND uploaded THEN coalesce(planned, countries, '') ELSE coalesce(countries, '') END AS countries,
      CASE WHEN has_g AND tz AND uploaded THEN 'new/' || n.package || '-' || n.day || '.tar' ELSE g END AS graph, CASE WHEN has_b AND uploaded THEN 'new/' || n.package || '-' || n.day || '.pmtiles' ELSE b END AS basemap, CASE WHEN has_i AND uploaded THEN 'new/' || n.package || '-index.json' ELSE i END AS search,
      CASE WHEN has_g AND tz AND uploaded THEN n.day WHEN g IS NOT NULL THEN o.day END AS gday, CASE WHEN has_b AND uploaded THEN n.day WHEN b IS NOT NULL THEN o.day END AS bday
    FROM pkg_old o FULL JOIN (SELECT * FROM pkg_new WHERE uploaded AND ((has_g AND tz) OR has_b OR has_i)) n ON n.package = o.package)"""


@query("j33_promote_upsert", f"WITH {INDEX} SELECT package, countries, graph, basemap, search FROM idx")
def j33(t):
    i = ops.promote_upsert(*index_parts(t))
    return i.select("package", F.array_join("countries", ",").alias("countries"), c("graph.url").alias("graph"), c("basemap.url").alias("basemap"), c("index.url").alias("search"))


SKEW = "CAST(abs(date_diff('day', CAST(gday AS DATE), CAST(bday AS DATE))) AS INT)"


@query("a19_vintage_skew", f"WITH {INDEX} SELECT package, graph IS NOT NULL AND basemap IS NOT NULL AS complete, CASE WHEN graph IS NOT NULL AND basemap IS NOT NULL THEN {SKEW} END AS skew_days FROM idx")
def a19(t):
    return ops.vintage_skew(ops.promote_upsert(*index_parts(t))).select("package", "complete", "skew_days")


@query("p15_package_index", f"WITH {INDEX} SELECT package, countries, graph, basemap, search, graph IS NOT NULL AND basemap IS NOT NULL AS complete, CASE WHEN graph IS NOT NULL AND basemap IS NOT NULL THEN {SKEW} END AS skew_days FROM idx")
def p15(t):
    i = plans.build_package_index(*index_parts(t))
    return i.select("package", F.array_join("countries", ",").alias("countries"), c("graph.url").alias("graph"), c("basemap.url").alias("basemap"), c("index.url").alias("search"), "complete", "skew_days")


@query("p15_country_names", """SELECT code, coalesce(max(planned), max(old), code) AS name FROM (SELECT 'N' || CAST(n_nationkey AS VARCHAR) AS code, NULL AS planned, CASE WHEN n_nationkey % 2 = 0 THEN n_name END AS old FROM nation
    UNION ALL SELECT 'N' || CAST(c_nationkey % 30 AS VARCHAR), CASE WHEN c_nationkey % 3 = 0 THEN c_mktsegment END, NULL FROM customer) GROUP BY code""")
def p15_names(t):
    code = lambda col: F.concat(F.lit("N"), col.cast("string")).alias("code")
    old = t.nation.filter("n_nationkey % 2 = 0").select(code(c("n_nationkey")), c("n_name").alias("name"))
    planned = t.customer.filter("c_nationkey % 3 = 0").select(code(c("c_nationkey") % 30), c("c_mktsegment").alias("name"))
    used = t.customer.select(code(c("c_nationkey") % 30)).unionByName(t.nation.select(code(c("n_nationkey"))))
    return ops.country_names(old, planned, used)


view("country_meta", """SELECT 'K' || CAST(c_custkey AS STRING) AS country, 'build-' || CAST(c_nationkey AS STRING) AS build_id, CAST(floor(abs(c_acctbal)) AS BIGINT) AS bytes,
    CASE WHEN c_nationkey % 3 = 0 THEN 'PASS' ELSE CASE c_custkey % 3 WHEN 0 THEN 'PASS' WHEN 1 THEN 'FAIL' END END AS timezone, CASE WHEN c_nationkey % 2 = 0 THEN 'PASS' WHEN c_custkey % 5 = 0 THEN 'ABSENT' ELSE 'PASS' END AS admins,
    CASE WHEN c_nationkey % 4 = 1 THEN 'UNCHECKED: no stamp' ELSE 'PASS' END AS freshness FROM customer""")


@query("a20_distinct_build_id", "SELECT count(DISTINCT build_id) AS builds, count(DISTINCT build_id) <> 1 AS refused FROM country_meta")
def a20(t):
    return ops.distinct_build_id(t.country_meta)


PROMO = """pv AS (SELECT DISTINCT build_id, gate, coalesce(verdict, '(no verdict recorded)') AS said FROM (SELECT build_id, unnest(['timezone', 'admins', 'freshness']) AS gate, unnest([timezone, admins, freshness]) AS verdict FROM country_meta) WHERE verdict IS NULL OR verdict <> 'PASS')"""


@query("v11_promotion_gate", f"WITH {PROMO} SELECT * FROM pv")
def v11(t):
    from atlas.gates.release import promotion_gate
    return promotion_gate(t.country_meta)


@query("p15_country_tiles_index", f"WITH {PROMO} SELECT build_id, country, bytes FROM country_meta WHERE build_id NOT IN (SELECT build_id FROM pv)")
def p15_tiles(t):
    return plans.build_country_tiles_index(t.country_meta).select("build_id", "country", "bytes")


@query("w08_stable_ids", """WITH k AS (SELECT DISTINCT o_orderpriority || '/' || CAST(o_custkey AS VARCHAR) AS key FROM orders), e AS (SELECT DISTINCT o_orderpriority || '/' || CAST(o_custkey AS VARCHAR) AS key, CAST(o_custkey * 5 + CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS BIGINT) AS id FROM orders WHERE o_custkey % 3 = 0),
    n AS (SELECT key, (SELECT max(id) FROM e) + row_number() OVER (ORDER BY key) AS id FROM k WHERE key NOT IN (SELECT key FROM e)) SELECT key, id, id > 255 AS exhausted FROM (SELECT * FROM e UNION ALL SELECT * FROM n)""")
def w08(t):
    key = F.concat_ws("/", "o_orderpriority", c("o_custkey").cast("string")).alias("key")
    rows = t.orders.select(key, c("o_custkey"), (c("o_custkey") * 5 + F.substring("o_orderpriority", 1, 1).cast("bigint")).alias("id"))
    return ops.stable_id_assignment(rows.filter("o_custkey % 3 = 0").select("key", "id").distinct(), rows.select("key"))


view("asset_row", """SELECT DISTINCT 'land-' || CAST(o_custkey % 40 AS STRING) || '-' || substr(CAST(o_orderdate AS STRING), 1, 10) || CASE o_orderkey % 3 WHEN 0 THEN '.tar' WHEN 1 THEN '.pmtiles' ELSE '.json' END AS name FROM orders""")
DATED = r"""dt AS (SELECT name, regexp_extract(name, '^(land-\d+)-', 1) AS package, regexp_extract(name, '(\d{4}-\d\d-\d\d)', 1) AS date, regexp_extract(name, '\.(\w+)$', 1) AS half FROM asset_row WHERE name NOT LIKE '%.json')"""


@query("w10_retention", f"""WITH {DATED}, b AS (SELECT package, date, count(*) AS n, row_number() OVER (PARTITION BY package ORDER BY date DESC) AS rk FROM dt GROUP BY package, date)
    SELECT name, dt.package, dt.date, CASE WHEN rk <= 3 THEN 'kept' WHEN md5(name) < '2' THEN 'live' WHEN n < 2 THEN 'missing half' ELSE 'delete' END AS verdict FROM dt JOIN b ON b.package = dt.package AND b.date = dt.date""")
def w10(t):
    return ops.retention(t.asset_row, t.asset_row.filter(F.md5("name") < "2"), 3)


@query("w11_rollback_candidates", f"WITH {DATED} SELECT package, date, string_agg(DISTINCT half, '+' ORDER BY half) AS halves, CAST(sum(length(name)) AS BIGINT) AS bytes, count(DISTINCT half) = 2 AS complete FROM dt GROUP BY package, date")
def w11(t):
    return ops.rollback_candidates(t.asset_row.withColumn("bytes", F.length("name").cast("bigint")))


# edges of connector ways in the old and the new graph
view("way_edge", """SELECT l_orderkey AS way, (l_partkey + l_linenumber) % 5 = 0 AS o_dest, CASE WHEN l_orderkey % 6 = 0 THEN false ELSE (l_partkey + l_linenumber) % 7 = 0 END AS n_dest, CAST(2 AS INT) AS o_level,
    CAST(CASE WHEN l_orderkey % 4 = 0 THEN 0 ELSE l_linenumber % 3 END AS INT) AS n_level, l_returnflag AS use, CASE WHEN l_suppkey % 9 = 0 THEN 'primary' ELSE 'service' END AS class FROM lineitem""")
COMPARED = """es AS (SELECT way, bool_or(o_dest) AS o_any, bool_and(o_dest) AS o_all, bool_or(n_dest) AS n_any, bool_and(n_dest) AS n_all, max(n_level) AS n_top, bool_or(class = 'primary') AS main FROM way_edge GROUP BY way),
    cmp AS (SELECT way, CASE WHEN o_any AND NOT n_any THEN CASE WHEN access IN ('private') OR motor_vehicle IN ('private') THEN CASE WHEN n_top = 0 AND NOT main THEN 'lifted' ELSE 'lifted outside' END WHEN service = 'parking_aisle' THEN 'inferred service' ELSE 'other loss' END
      WHEN NOT o_any AND n_any THEN 'gained' WHEN (access IN ('private') OR motor_vehicle IN ('private')) AND o_any THEN 'kept legal' ELSE 'unchanged' END AS outcome FROM es JOIN way_tag g ON g.id = way)"""


def compared(t):
    side = lambda p: t.way_edge.select("way", c(f"{p}_dest").alias("dest_only"), c(f"{p}_level").alias("level"), "use", "class")
    return ops.baseline_vs_new(t.way.withColumnRenamed("id", "way"), side("o"), side("n"))


@query("j35_baseline_vs_new", f"WITH {COMPARED} SELECT way, outcome FROM cmp")
def j35(t):
    return compared(t).select("way", "outcome")


PREV_BLOCK = "CASE WHEN r.{0} IS NOT NULL THEN r.{0} ELSE p.{0} END"


@query("p14_build_manifest", """SELECT r.code, r.region_id + 0 AS region_id, r.graph_version, CASE WHEN b.code IS NULL THEN coalesce(p.url, r.url) ELSE r.url END AS url, b.code IS NULL AS carried,
    coalesce(r.map_file, p.map_file) AS map_file, coalesce(r.se_file, p.se_file) AS search_file, r.fr_file AS frontier FROM reg r LEFT JOIN reg_prev p ON p.code = r.code LEFT JOIN built b ON b.code = r.code""")
def p14(t):
    descriptions = t.regions_now.join(t.built.select("code", F.lit(False).alias("carried")), "code", "left").withColumn("carried", F.coalesce("carried", F.lit(True)))
    m = plans.build_manifest(t.catalog_row.select("code"), descriptions, t.regions_before)
    return m.select("code", "region_id", "graph_version", "url", "carried", c("map.file").alias("map_file"), c("search.file").alias("search_file"), c("frontier.file").alias("frontier"))


_ = views
