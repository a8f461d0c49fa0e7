"""The scalar queries once more, written in SQL with the registered functions; each is compared with its query's DuckDB twin."""

from __future__ import annotations

from atlas.functions import osm, sql
from atlas.queries import scalars  # noqa: F401  registers the twins
from atlas.queries.base import REGISTRY, Query, Tables

PLACE = """(SELECT id, name, city, map_filter(map('name', name, 'name:ro', name_ro, 'name:ru', name_ru, 'name:en', name_en, 'old_name', old_name, 'population', population,
    'official_name', official_name, 'name:prefix', prefix, 'is_in', is_in), (k, v) -> v IS NOT NULL) AS tags FROM place_tag)"""

TEXTS = {
    "x01_fold": "SELECT doc_id, md5(atlas_fold(text)) AS folded, CAST(length(atlas_fold(text)) AS BIGINT) AS n FROM documents",
    "x02_name_key": """SELECT 'document' AS what, doc_id AS id, md5(atlas_name_key(text)) AS key FROM documents
        UNION ALL SELECT 'turn', conv_id * 1000 + turn, md5(atlas_name_key(text)) FROM conversations""",
    "x03_house_keys": "SELECT oid, array_join(atlas_house_keys(num), '|') AS keys FROM addr",
    "x04_house_display": "SELECT oid, house AS key, atlas_house_display(num, house) AS shown FROM (SELECT oid, num, explode(keys) AS house FROM (SELECT oid, num, atlas_house_keys(num) AS keys FROM addr))",
    "x05_osm_code": "SELECT oid, kind, atlas_osm_code(element_at(array('n', 'w', 'r'), kind + 1), oid) AS code FROM addr",
    "x06_flat_distances": """SELECT point, round(atlas_meters(lat, lon, lat + 0.013D, lon - 0.021D), 5) AS m, round(atlas_km(lat, lon, lat + 0.013D, lon - 0.021D), 8) AS km,
        round(atlas_probe_metres(lat, lon, lat + 0.013D, lon - 0.021D), 5) AS probe FROM pt""",
    "x07_haversine": "SELECT point, round(atlas_haversine(lat, lon, lat + 0.3D, lon - 0.7D), 4) AS m, round(atlas_haversine_km(lat, lon, lat + 0.3D, lon - 0.7D), 7) AS km FROM pt",
    "x08_bearing": "SELECT point, round(atlas_bearing(lat, lon, 48.0D, 29.0D), 8) AS brg FROM pt",
    "x09_angle_diff": "SELECT event_id, round(atlas_angle_diff(value * 7, CAST(user_id * 11 AS DOUBLE)), 6) AS diff FROM events",
    "x10_destination": """SELECT point, m, b, round(d.lat, 8) AS lat, round(d.lon, 8) AS lon FROM (SELECT point, m, b, atlas_destination(lat, lon, CAST(m AS DOUBLE), CAST(b AS DOUBLE)) AS d
        FROM (SELECT *, explode(sequence(0, 315, 45)) AS b FROM (SELECT *, explode(array(1500, 4000)) AS m FROM pt)))""",
    "x11_maxspeed": "SELECT id, atlas_maxspeed_kmh(raw) AS kmh FROM speed_text",
    "x12_direction": "SELECT id, d.src AS src, round(aggregate(d.degrees, 0D, (s, v) -> s + v), 6) AS total, d.degrees[0] AS first FROM (SELECT id, atlas_parse_direction(dir) AS d FROM speed_text)",
    "x13_bus_lane_side": "SELECT id, atlas_bus_lane_side(tags) AS side FROM way",
    "x14_oneway": "SELECT id, atlas_oneway_of(tags) AS dir FROM way",
    "x15_promote_tags": f"""SELECT id, tags['highway'] AS highway, tags['service'] AS service, tags['{osm.PARKED_SERVICE_KEY}'] AS parked, atlas_undo_promote(tags)['service'] AS undone
        FROM (SELECT id, atlas_promote_tags(tags) AS tags FROM way)""",
    "x16_locality_aliases": f"SELECT id, array_join(atlas_locality_aliases(tags, name), '|') AS aliases FROM {PLACE}",
    "x17_search_aliases": "SELECT id, array_join(atlas_search_aliases(tags, tags['name']), '|') AS aliases FROM way",
    "x18_city_keys": f"SELECT id, array_join(atlas_city_keys(city), '|') AS keys FROM {PLACE}",
    "x19_population": f"SELECT id, atlas_population(tags['population']) AS pop FROM {PLACE}",
    "x20_commune_display": f"SELECT id, atlas_commune_display(tags) AS display FROM {PLACE}",
    "x21_is_in_conflict": f"SELECT id, size(atlas_is_in_parts(tags['is_in'])) AS parts, atlas_is_in_conflict(tags['is_in'], name || ';Județ 3;România') AS conflict FROM {PLACE}",
    "x22_category": "SELECT id, kind, atlas_category_of(kind) AS cat FROM poi_kind",
    "x23_e7": "SELECT o_orderkey AS id, atlas_e7(o_totalprice / 10000D) AS v FROM orders",
    "x24_portal_distance": "SELECT local_id, country, atlas_portal_distance(lat_e7, lon_e7, lat_e7 + l_orderkey % 7 - 4, lon_e7) AS d FROM fr",
    "x25_graph_id": """SELECT country, local_id, gid, atlas_graph_level(gid) AS level, atlas_graph_id_text(gid) AS text
        FROM (SELECT country, local_id, atlas_graph_id(CAST(substring(country, 2, 9) AS BIGINT), local_id) AS gid FROM fr)""",
    "x26_tile_bbox": "SELECT path, i.level, i.tile_id, b.west, b.south, b.east, b.north FROM (SELECT path, i, atlas_tile_bbox(i.level, i.tile_id) AS b FROM (SELECT path, atlas_tile_id_from_path(path) AS i FROM tile_path))",
    "x27_web_tiles": """SELECT point, z, w.x, w.y, b.lat, b.lon FROM (SELECT point, z, w, atlas_tile_pixel_to_lonlat(z, w.x, w.y, 2000D, 1000D, 4096D) AS b
        FROM (SELECT point, z, atlas_web_tile(lat, lon, z) AS w FROM (SELECT *, explode(array(10, 15)) AS z FROM pt)))""",
    "x28_hilbert": """SELECT id, t.z, t.x, t.y FROM (SELECT id, atlas_hilbert_zxy(id) AS t FROM (SELECT o_orderkey * 5 AS id FROM orders UNION SELECT o_orderkey % 65536 * 140737488355327 FROM orders))""",
    "x30_segment_meets_box": "SELECT way_id, seq, atlas_segment_meets_box(lon, lat, lon2, lat2, 28.0061D, 47.0023D, 28.0133D, 47.0077D) AS meets FROM way_step",
    "x32_format_row": """SELECT id, atlas_list_text(transform(refs, r -> 'w' || CAST(r AS STRING))) AS list, coalesce(tags['highway'], '-') AS highway,
        atlas_attrs_text(map_filter(tags, (k, v) -> k IN ('bridge', 'service'))) AS attrs FROM way_refs JOIN way USING (id)""",
    "x33_dated_names": """SELECT id, atlas_dated_extract(url, stamp) AS dated, atlas_dated_name(url, regexp_extract(url, '^https://host[.]example/(.*?)-[^-]*$', 1)) AS redirect,
        atlas_state_date(state) AS day, atlas_md5_of(md5_line, 'land1.pbf') AS md5 FROM url_text""",
    "x34_release_names": "SELECT id, atlas_tag_of(asset_url) AS tag, p.package, p.date AS day, p.half FROM (SELECT id, asset_url, atlas_asset_parts(asset) AS p FROM url_text)",
    "x35_age_days": "SELECT event_id, atlas_age_days(ts, TIMESTAMP '2024-03-01 12:00:00') AS age FROM events",
    "x36_aliases_json": "SELECT id, atlas_aliases_json(atlas_search_aliases(tags, tags['name'])) AS aliases FROM way",
    "x31_signal_value": "SELECT page_id, md5(atlas_signal_value(html)) AS v, atlas_signal_value(url) AS url FROM pages",
}


def _by_name(text: str):
    def run(spark, folder):
        names = [n for n in sql.functions() if f"{sql.PREFIX}{n}(" in text]
        sql.register(spark, *names)
        return Tables(spark, folder).sql(text)

    return run


for _name, _text in TEXTS.items():
    REGISTRY[f"{_name}_by_name"] = Query(_by_name(_text), REGISTRY[_name].oracle)
