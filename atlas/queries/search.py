"""Search index rows and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from atlas.functions import geo
from atlas.operators import filters, token_index
from atlas.operators import search as ops
from atlas.operators.groups import dense_ids
from atlas.plans.search_index import build_search_index
from atlas.queries.base import query
from atlas.queries.filters import TF_KEPT
from atlas.queries.sqltext import decimal_cell, fold, km
from atlas.session import scratch_folder
from atlas.sources import sinks

c = F.col

ALIASES = "concat_ws('|', CASE WHEN name_en <> coalesce(name, '') THEN name_en END, CASE WHEN name_ru <> coalesce(name, '') AND name_ru IS DISTINCT FROM name_en THEN name_ru END)"
PLACE = f"""kept AS ({TF_KEPT}), rw AS (SELECT CAST(CASE layer WHEN 'places' THEN 0 WHEN 'roads' THEN 1 ELSE 2 END AS INT) AS kind, coalesce(name, '') AS name, {ALIASES} AS aliases, lat, lon,
      CASE WHEN layer = 'pois' THEN cat END AS cat, CASE WHEN layer <> 'roads' THEN kind END AS detail, CASE WHEN layer = 'places' THEN coalesce(population, 0) ELSE 0 END AS pop FROM kept),
    cell AS (SELECT *, row_number() OVER (PARTITION BY kind, CASE WHEN name = '' THEN detail ELSE name END, CASE WHEN kind = 2 THEN {decimal_cell('lat', 4)} ELSE {decimal_cell('lat', 2)} END, CASE WHEN kind = 2 THEN {decimal_cell('lon', 4)} ELSE {decimal_cell('lon', 2)} END
      ORDER BY lat, lon, -pop, aliases, detail) AS rn FROM rw), place AS (SELECT * FROM cell WHERE rn = 1)"""


def place(t):
    return ops.place_rows(filters.search_row_filter(t.tile_feature))


# several features of one name share a spot: which of them stays is compared by the fields that do not differ
@query("w05_street_representative", f"WITH {PLACE} SELECT name, lat, lon FROM place WHERE kind = 1")
def w05(t):
    return place(t).filter("kind = 1").select("name", "lat", "lon")


@query("w06_first_per_cell", f"WITH {PLACE} SELECT kind, name, lat, lon, cat FROM place WHERE kind <> 1")
def w06(t):
    return place(t).filter("kind <> 1").select("kind", "name", "lat", "lon", "cat")


@query("a09_category_counts", f"WITH {PLACE} SELECT cat, count(*) AS n FROM place WHERE cat IS NOT NULL GROUP BY cat")
def a09(t):
    return ops.category_counts(place(t))


@query("a17_index_counts", f"WITH {PLACE} SELECT CASE kind WHEN 0 THEN 'places' WHEN 1 THEN 'streets' ELSE 'pois' END AS part, count(*) AS n, count(DISTINCT cat) AS categories FROM place GROUP BY kind")
def a17(t):
    return ops.index_counts(place(t)).select("part", "n", "categories")


@query("t02_search_order", f"WITH {PLACE} SELECT kind, name, lat, lon, row_number() OVER (ORDER BY kind, CASE WHEN kind = 0 THEN -pop ELSE 0 END, name, lat, lon) AS place FROM place")
def t02(t):
    return dense_ids(place(t), ops.search_order(), "place").select("kind", "name", "lat", "lon", "place")


@query("p01_build_search_index", f"WITH {PLACE} SELECT row_number() OVER (ORDER BY kind, CASE WHEN kind = 0 THEN -pop ELSE 0 END, name, lat, lon) AS id, kind, name, lat, lon, cat FROM place")
def p01(t):
    index = build_search_index(t.tile_feature, t.tile_feature, bbox=None, places_zoom=None, detail_zoom=None)
    return index.select("id", "kind", "name", "lat", "lon", "cat")


WORDS = r"SELECT DISTINCT doc_id AS key, unnest(string_split_regex(lower(text), '[^\p{L}\p{N}]+')) AS token FROM documents"


@query("q01_prefix_search", r"""WITH w AS (SELECT doc_id AS key, unnest(string_split_regex(translate(lower(text), 'àâäáãåçèéêëìíîïñòóôöõùúûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy'), '[^\p{L}\p{N}]+')) AS token FROM documents)
    SELECT key FROM w GROUP BY key HAVING count(*) FILTER (WHERE token LIKE 'en%') > 0 AND count(*) FILTER (WHERE token LIKE 're%') > 0 AND count(*) FILTER (WHERE token = 'la') > 0""")
def q01(t):
    path = scratch_folder(t.spark, "tokens")
    token_index.write_tokens(t.documents, "doc_id", ["text"], f"{path}/documents_token")
    return token_index.match(token_index.read_tokens(t.spark, path, "documents"), "en* ré* LA")


@query("q01_place_search", f"""WITH {PLACE}, w AS (SELECT kind, name, aliases, lat, lon, cat, unnest(string_split_regex({fold("concat_ws(' ', name, aliases)")}, '[^\\p{{L}}\\p{{N}}]+')) AS token FROM place)
    SELECT kind, name, lat, lon, cat FROM w GROUP BY ALL HAVING bool_or(token LIKE '1%') AND bool_or(token = 'naive')""")
def q01_place(t):
    """Over the written search index: rows of every kind found by an alias, joined back by id."""
    path = scratch_folder(t.spark, "search-index")
    sinks.write_search_index(build_search_index(t.tile_feature, t.tile_feature, bbox=None, places_zoom=None, detail_zoom=None), path)
    found = token_index.match(token_index.read_tokens(t.spark, path, "place"), "1* aliases:Naïve")
    rows = t.spark.read.parquet(f"{path}/place").join(found.withColumnRenamed("key", "id"), "id")
    return rows.select(c("kind").cast("int").alias("kind"), "name", "lat", "lon", "cat")


@query("k01_place_tokens", f"""WITH {PLACE}, numbered AS (SELECT row_number() OVER (ORDER BY kind, CASE WHEN kind = 0 THEN -pop ELSE 0 END, name, lat, lon) AS key, name, aliases FROM place),
    f AS (SELECT key, 'name' AS field, name AS value FROM numbered UNION ALL SELECT key, 'aliases', aliases FROM numbered)
    SELECT DISTINCT token, field, key FROM (SELECT key, field, unnest(string_split_regex({fold("value")}, '[^\\p{{L}}\\p{{N}}]+')) AS token FROM f) WHERE token <> ''
    UNION ALL SELECT '', '', key FROM numbered""")
def k01_tokens(t):
    path = scratch_folder(t.spark, "search-index")
    sinks.write_search_index(build_search_index(t.tile_feature, t.tile_feature, bbox=None, places_zoom=None, detail_zoom=None), path)
    return token_index.read_tokens(t.spark, path, "place").select("token", "field", "key")


BOX, ZOOMS = (28.006, 47.006, 28.02, 47.02), (10, 15)


def tile_sql(axis: str, lat: str, lon: str, zoom: str) -> str:
    if axis == "x":
        return f"trunc(({lon} + 180) / 360 * pow(2, {zoom}))"
    return f"trunc((1 - asinh(tan(radians({lat}))) / pi()) / 2 * pow(2, {zoom}))"


BOXED = f"""zoomed AS (SELECT *, CASE WHEN layer = 'places' THEN {ZOOMS[0]} ELSE {ZOOMS[1]} END AS z FROM kept_all),
    kept AS (SELECT * FROM zoomed WHERE {tile_sql("x", "lat", "lon", "z")} BETWEEN {tile_sql("x", "", f"{BOX[0]}e0", "z")} AND {tile_sql("x", "", f"{BOX[2]}e0", "z")}
      AND {tile_sql("y", "lat", "", "z")} BETWEEN {tile_sql("y", f"{BOX[3]}e0", "", "z")} AND {tile_sql("y", f"{BOX[1]}e0", "", "z")})"""


@query("p01_boxed_search_index", f"""WITH {PLACE.replace("kept AS", "kept_all AS", 1).replace(", rw AS", f", {BOXED}, rw AS", 1)}
    SELECT row_number() OVER (ORDER BY kind, CASE WHEN kind = 0 THEN -pop ELSE 0 END, name, lat, lon) AS id, kind, name, lat, lon, cat FROM place""")
def p01_boxed(t):
    """The tile cut inside the build: settlements by tiles of one zoom, streets and points of interest by another's."""
    tiles = lambda zoom: t.tile_feature.withColumn("z", F.lit(zoom)).withColumn("t", geo.web_tile(c("lat"), c("lon"), F.lit(zoom))).select("*", "t.x", "t.y")
    index = build_search_index(tiles(ZOOMS[0]), tiles(ZOOMS[1]), BOX, *ZOOMS)
    return index.select("id", "kind", "name", "lat", "lon", "cat")


@query("q02_category_nearby", f"""WITH {PLACE}, d AS (SELECT name, lat, lon, {km('47.01e0', '28.02e0', 'lat', 'lon')} AS km FROM place WHERE cat = 'charging')
    SELECT name, lat, lon, round(km, 7) AS km FROM d WHERE km <= 2 ORDER BY d.km, lat, lon, name LIMIT 20""")
def q02(t):
    near = ops.category_nearby(place(t), "charging", 47.01, 28.02, 2.0, 20)
    return near.select("name", "lat", "lon", F.round("km", 7).alias("km"))
