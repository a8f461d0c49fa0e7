"""Writers: search and address tables, canonical text, portals, search JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlas.functions import text
from atlas.operators import token_index
from atlas.session import ended_shuffles_removed


def list_text(values: Column, separator: str) -> Column:
    return F.when(F.size(values) > 0, F.array_join(values, separator)).otherwise(F.lit("-"))


def attrs_text(attrs: Column) -> Column:
    """``k=v;k=v`` sorted by key, ``-`` when empty."""
    entries = F.array_sort(F.map_entries(attrs))
    return list_text(F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"])), ";")


def or_dash(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("-"))


def frontier_line() -> Column:
    return F.concat_ws(" ", "level", "lat_e7", "lon_e7", "local_id", or_dash(F.col("osm")))


def feature_line() -> Column:
    bearing = F.transform("bearing", lambda b: b.cast("string"))
    return F.concat_ws(" ", "id", "type", "lat_e7", "lon_e7", list_text(bearing, ";"), or_dash(F.col("maxspeed")),
                       list_text(F.col("way_ids"), ","), attrs_text(F.col("attrs")))


def bus_lane_line() -> Column:
    return F.concat(F.lit("w"), F.col("way_id").cast("string"), F.lit(" "), F.col("side"))


FRONTIER_ORDER = ("level", "lat_e7", "lon_e7", "local_id")


def feature_order() -> list[Column]:
    return [F.substring("id", 1, 1).alias("kind_char"), F.substring("id", 2, 30).cast("bigint").alias("number")]


def write_canonical_text(rows: DataFrame, line: Column, order: Sequence[Column | str], header: DataFrame, path: str) -> None:
    """Header lines, then the rows in total order. The part files in name order are the canonical text:
    the header is the first part and the sorted ranges follow, so no task holds the whole file. The job
    commit makes the folder appear at once. ``header(ord, value)``."""
    top = header.coalesce(1).sortWithinPartitions("ord").select("value")
    body = rows.orderBy(*order).select(line.alias("value"))
    top.union(body).write.mode("overwrite").text(path)


def counted_header(rows: DataFrame, fixed: Sequence[str], counts: Column, columns: str) -> DataFrame:
    """Fixed lines, then lines computed from the rows (an array of text), then the column line."""
    lines = F.concat(F.array(*[F.lit(x) for x in fixed]), counts, F.array(F.lit(columns)))
    return rows.agg(lines.alias("lines")).select(F.posexplode("lines").alias("ord", "value"))


def write_frontier(rows: DataFrame, country: str, version: str, path: str, producer: str = "atlas") -> None:
    counts = F.array(F.concat(F.lit("entries "), F.count(F.lit(1)).cast("string")),
                     F.concat(F.lit("osm_resolved "), F.count("osm").cast("string")))
    header = counted_header(rows, [f"{producer}-frontier 1", f"country {country}", f"graph_version {version}"], counts,
                            "level lat_e7 lon_e7 local_id osm_node_id")
    write_canonical_text(rows, frontier_line(), FRONTIER_ORDER, header, path)


def write_features(rows: DataFrame, country: str, version: str, source: str, path: str, producer: str = "atlas") -> None:
    from atlas.sources.strict_text import FEATURE_COLUMNS, FEATURE_TYPES
    per_type = [F.concat(F.lit(f"{t}="), F.count_if(F.col("type") == t).cast("string")) for t in FEATURE_TYPES]
    counts = F.array(F.concat(F.lit("entries "), F.count(F.lit(1)).cast("string")), F.concat(F.lit("counts "), F.concat_ws(",", *per_type)))
    header = counted_header(rows, [f"{producer}-features 1", f"country {country}", f"graph_version {version}", f"source {source or '-'}"], counts, FEATURE_COLUMNS)
    write_canonical_text(rows, feature_line(), feature_order(), header, path)


def write_bus_lanes(rows: DataFrame, path: str, producer: str = "atlas") -> None:
    header = rows.sparkSession.createDataFrame([(0, f"{producer}-buslanes 1")], "ord int, value string")
    write_canonical_text(rows, bus_lane_line(), ["way_id"], header, path)


def write_portal_table(portals: DataFrame, path: str) -> None:
    from atlas.operators.matching import portal_line
    line = portal_line(*[F.col(c) for c in ("from_id", "to_id", "distance", "lat_e7", "lon_e7")])
    portals.orderBy("from_id", "to_id").select(line.alias("value")).write.mode("overwrite").text(path)


SEARCH_COLUMNS = ("kind", "name", "aliases", "lat", "lon", "cat", "detail", "pop")


def write_search_tables(place: DataFrame, path: str) -> None:
    """Place rows by kind, laid out so that a category and a box touch few row groups."""
    rows = place.select(*SEARCH_COLUMNS).withColumn("aliases", text.aliases_json(F.col("aliases")))
    rows = rows.repartitionByRange("kind", "cat", "lat", "lon").sortWithinPartitions("kind", "cat", "lat", "lon")
    rows.write.mode("overwrite").partitionBy("kind").parquet(path)


def write_search_index(index: DataFrame, path: str) -> None:
    """A built search index: ``place`` rows with their id, laid out as ``write_search_tables`` does, and their token index."""
    rows = index.select("id", *SEARCH_COLUMNS).withColumn("aliases", text.aliases_json(F.col("aliases")))
    laid = rows.repartitionByRange("kind", "cat", "lat", "lon").sortWithinPartitions("kind", "cat", "lat", "lon")
    laid.write.mode("overwrite").partitionBy("kind").parquet(f"{path}/place")
    written = index.sparkSession.read.parquet(f"{path}/place")
    token_index.write_tokens(written, "id", token_index.FIELDS["place"], f"{path}/place_token")


def write_address_tables(index, path: str) -> None:
    """Locality, commune, street and house tables with the token index of the first three; houses are laid out by street for point lookups."""
    as_json = lambda df, *cols: df.withColumns({c: text.aliases_json(F.col(c)) for c in cols})
    names = ("locality", "commune", "street", "house")
    spark = index.house.sparkSession
    house = index.house.repartitionByRange("street", "key").sortWithinPartitions("street", "key", "osm")
    with ended_shuffles_removed(spark):
        as_json(index.locality, "aliases").write.mode("overwrite").parquet(f"{path}/locality")
        as_json(index.commune, "aliases").write.mode("overwrite").parquet(f"{path}/commune")
        as_json(index.street, "aliases", "city_alt").write.mode("overwrite").parquet(f"{path}/street")
        house.write.mode("overwrite").parquet(f"{path}/house")
    for name in names[:3]:   # from the written rows, so the index says what a reader of the tables sees
        token_index.write_tokens(spark.read.parquet(f"{path}/{name}"), "id", token_index.FIELDS[name], f"{path}/{name}_token")
    meta = None
    for name in names:
        n = spark.read.parquet(f"{path}/{name}").agg(F.count(F.lit(1)).alias("v")).select(F.lit(name).alias("k"), "v")
        meta = n if meta is None else meta.unionByName(n)
    meta.write.mode("overwrite").parquet(f"{path}/meta")


def write_packed_lines(lines: DataFrame, order: str, path: str) -> None:
    """Lines ``(file, value)`` of many small files in few text files: a file's lines follow one another by ``order``, each behind the
    file's name and a tab. A file of its own costs a listing and a task's opening however short it is."""
    laid = lines.repartition("file").sortWithinPartitions("file", order)
    laid.select(F.concat("file", F.lit("\t"), "value").alias("value")).write.text(path)


def write_lookup_tables(street: DataFrame, house: DataFrame, path: str, name: str, buckets: int = 256) -> tuple[str, str]:
    """The two tables that house lookups join, as catalog tables ``name_street`` and ``name_house`` over files under ``path``.

    Houses are bucketed by (street, key) and streets by id, each bucket one sorted file, so a lookup moves the questions
    only: neither table is shuffled or sorted again, however often it is asked. Returns the two table names.
    """
    def write(rows: DataFrame, table: str, *keys: str) -> str:
        laid = rows.repartition(buckets, *keys)
        laid.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", f"{path}/{table}").saveAsTable(f"{name}_{table}")
        return f"{name}_{table}"

    return write(street, "street", "id"), write(house, "house", "street", "key")


def search_json_lines(place: DataFrame) -> DataFrame:
    """The search index as ordered JSON rows: part (places, streets, pois), line and its sort fields."""
    part = F.element_at(F.array(F.lit("places"), F.lit("streets"), F.lit("pois")), F.col("kind") + 1)
    a = F.when(F.size("aliases") > 0, F.col("aliases"))
    body = F.to_json(F.struct(F.col("name").alias("n"), F.col("detail").alias("k"), F.col("lat").alias("y"), F.col("lon").alias("x"),
                              F.when(F.col("kind") == 0, F.col("pop")).alias("p"), a.alias("a"), F.col("cat").alias("c")))
    return place.select(part.alias("part"), body.alias("line"), "kind", F.when(F.col("kind") == 0, -F.col("pop")).otherwise(0).alias("by_pop"), "name", "lat", "lon")


def write_search_json(place: DataFrame, path: str) -> None:
    """One ordered JSON-lines folder per part, and the counts."""
    lines = search_json_lines(place)
    ordered = lines.orderBy("kind", "by_pop", "name", "lat", "lon")
    ordered.select("part", F.col("line").alias("value")).write.mode("overwrite").partitionBy("part").text(f"{path}/rows")
    lines.groupBy("part").agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").json(f"{path}/counts")
