"""Remaining aggregations, orders and gaps."""

from __future__ import annotations

from pyspark.sql import functions as F

from atlas.functions import text
from atlas.operators import address, features, network, routes
from atlas.queries import views
from atlas.queries.base import query, view
from atlas.queries.sqltext import haversine

c = F.col

EVENT_TYPES = ("view", "click", "purchase", "signup", "refund")


@query("a01_counts_by_type", "SELECT v.t AS event_type, count(event_id) AS n FROM (VALUES ('view'), ('click'), ('purchase'), ('signup'), ('refund')) AS v(t) LEFT JOIN events ON event_type = v.t GROUP BY v.t")
def a01(t):
    return features.counts_by_type(t.events, "event_type", EVENT_TYPES)


@query("a08_build_stats", """SELECT count(*) AS objects, count(*) FILTER (WHERE street IS NULL AND place IS NULL AND rel_id IS NULL) AS no_street, count(*) FILTER (WHERE street IS NULL AND place IS NOT NULL) AS via_addr_place,
    count(city) AS with_city, count(DISTINCT num) AS numbers FROM addr""")
def a08(t):
    return address.object_stats(t.addr)


LENGTHS = "SELECT o_custkey AS length, o_orderstatus AS highway, o_orderkey AS way FROM orders"


@query("a15_sorted_positions", """WITH s AS (SELECT list_sort(list(CAST(floor(o_totalprice) AS BIGINT))) AS l, count(*) AS n FROM orders)
    SELECT l[1] AS least, l[CAST(floor(n * 0.5e0) AS BIGINT) + 1] AS median, l[CAST(floor(n * 0.95e0) AS BIGINT) + 1] AS p95, l[n] AS most FROM s""")
def a15(t):
    counts = t.orders.groupBy(F.floor("o_totalprice").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    return network.sorted_positions(counts, "length", {"least": 0.0, "median": 0.5, "p95": 0.95, "most": 1.0})


# shapes: the components of an embedding read as a path of points
view("emb_point", """SELECT vec_id AS id, CAST(i - 1 AS INT) AS i, 47 + CAST(embedding[i] AS DOUBLE) AS lat, 28 + CAST(embedding[i + 1] AS DOUBLE) AS lon FROM embeddings, unnest(range(1, len(embedding))) AS u(i)""",
     lambda t: t.embeddings.select(c("vec_id").alias("id"), "embedding", F.explode(F.sequence(F.lit(0), F.size("embedding") - 2)).alias("i"))
     .select("id", "i", (F.lit(47) + F.get("embedding", c("i")).cast("double")).alias("lat"), (F.lit(28) + F.get("embedding", c("i") + 1).cast("double")).alias("lon")))
GAPS = f"""st AS (SELECT id, i, lat, lon, {haversine('lat', 'lon', 'lat2', 'lon2', 6371.0)} AS km FROM (SELECT *, lead(lat) OVER w AS lat2, lead(lon) OVER w AS lon2 FROM emb_point WINDOW w AS (PARTITION BY id ORDER BY i)) WHERE lat2 IS NOT NULL)"""


@query("w03_largest_gap", f"WITH {GAPS} SELECT id, round(max(km), 7) AS gap_km, round(arg_max(lat, km), 6) AS lat, round(arg_max(lon, km), 6) AS lon FROM st GROUP BY id")
def w03(t):
    gap = routes.largest_gap(t.emb_point, ["id"])
    return gap.select("id", F.round("gap_km", 7).alias("gap_km"), F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"))


@query("t06_house_natural_order", """SELECT key, row_number() OVER (ORDER BY CAST(nullif(regexp_extract(key, '^(\\d+)', 1), '') AS BIGINT) NULLS LAST, regexp_replace(key, '^\\d+', ''), key) AS place
    FROM (SELECT DISTINCT CAST(l_partkey % 400 AS VARCHAR) || CASE l_linenumber WHEN 1 THEN 'a' WHEN 2 THEN '/1' WHEN 3 THEN 'б' ELSE '' END AS key FROM lineitem)""")
def t06(t):
    from atlas.operators.groups import dense_ids
    suffix = F.when(c("l_linenumber") == 1, "a").when(c("l_linenumber") == 2, "/1").when(c("l_linenumber") == 3, "б").otherwise("")
    keys = t.lineitem.select(F.concat((c("l_partkey") % 400).cast("string"), suffix).alias("key")).distinct()
    number, rest, key = text.house_sort_key(c("key"))
    return dense_ids(keys, [number, rest, key], "place").select("key", "place")


_ = views
