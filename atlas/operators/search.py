"""Search index rows and the lookups they answer."""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlas.functions import geo, text

KIND_PLACE, KIND_STREET, KIND_POI = 0, 1, 2


def first_per_cell(rows: DataFrame, name: Column, digits: int) -> DataFrame:
    """One row per name and rounded position: the southernmost, then westernmost (a scan has no order of
    its own here, so the lowest position stands for the first seen), on one spot the most populous."""
    cell = [name.alias("_name"), geo.decimal_cell(F.col("lat"), digits).alias("_lat"), geo.decimal_cell(F.col("lon"), digits).alias("_lon")]
    order = F.struct("lat", "lon", (-F.col("pop")).alias("by_pop"), "aliases", "detail", "cat")
    best = F.min_by(F.struct(*rows.columns), order).alias("_row")
    return rows.groupBy(*cell).agg(best).select("_row.*")


def place_rows(features: DataFrame) -> DataFrame:
    """``(layer, attrs, population, lat, lon)`` already filtered → search rows without ids."""
    a = F.col("attrs")
    is_place, is_road = F.col("layer") == "places", F.col("layer") == "roads"
    kind = F.when(is_place, KIND_PLACE).when(is_road, KIND_STREET).otherwise(KIND_POI)
    rows = features.select(
        kind.alias("kind"), F.coalesce(a["name"], F.lit("")).alias("name"), text.search_aliases(a, a["name"]).alias("aliases"),
        "lat", "lon", F.when(kind == KIND_POI, text.category_of(a["kind"])).alias("cat"),
        F.when(kind != KIND_STREET, a["kind"]).alias("detail"),
        F.when(is_place, F.coalesce("population", F.lit(0))).otherwise(0).cast("bigint").alias("pop"))
    places = first_per_cell(rows.filter(F.col("kind") == KIND_PLACE), F.col("name"), 2)
    streets = first_per_cell(rows.filter(F.col("kind") == KIND_STREET), F.col("name"), 2)
    called = F.when(F.col("name") != "", F.col("name")).otherwise(F.col("detail"))
    pois = first_per_cell(rows.filter(F.col("kind") == KIND_POI), called, 4)
    return places.unionByName(streets).unionByName(pois)


def search_order() -> list[Column]:
    """Places by population then name; streets and points by name; position last."""
    return [F.col("kind"), F.when(F.col("kind") == KIND_PLACE, -F.col("pop")).otherwise(0).alias("by_pop"),
            F.col("name"), F.col("lat"), F.col("lon")]


def index_counts(place: DataFrame) -> DataFrame:
    part = F.element_at(F.array(F.lit("places"), F.lit("streets"), F.lit("pois")), F.col("kind") + 1).alias("part")
    return place.groupBy(part).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("cat").alias("categories"),
                                   F.count_if(F.size("aliases") > 0).alias("with_alias"))


def category_counts(place: DataFrame) -> DataFrame:
    return place.filter("cat is not null").groupBy("cat").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "cat")


@functools.cache
def _latin_map() -> tuple[str, str]:
    source, target = text.base_letter_map()
    pairs = [(s, t) for s, t in zip(source, target) if unicodedata.name(t, "").startswith("LATIN")]
    return "".join(s for s, _ in pairs), "".join(t for _, t in pairs)


def search_fold(value: Column) -> Column:
    """Lower case; diacritics are dropped from Latin letters only, Cyrillic й and ё stay themselves."""
    source, target = _latin_map()
    return F.regexp_replace(F.translate(F.lower(value), source, target), r"\p{Mn}", "")


def token_table(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Inverted index: distinct (token, key) over the given text or list columns. Written sorted by token
    it answers a prefix from a few row groups."""
    texts = [F.array_join(F.col(c), " ") if rows.schema[c].dataType.typeName() == "array" else F.col(c) for c in columns]
    words = F.split(search_fold(F.concat_ws(" ", *texts)), r"[^\p{L}\p{N}]+")
    return rows.select(F.explode(F.array_distinct(words)).alias("token"), F.col(key).alias("key")).filter("token <> ''")


def prefix_search(tokens: DataFrame, terms: list[str]) -> DataFrame:
    """Keys that match every term; a trailing ``*`` makes a term a prefix. ``tokens(token, key)``."""
    wanted = []
    for i, term in enumerate(terms):
        literal = F.lit(term.rstrip("*"))
        folded = search_fold(literal)
        hit = F.startswith(F.col("token"), folded) if term.endswith("*") else F.col("token") == folded
        wanted.append((i, hit))
    any_hit = functools.reduce(lambda a, b: a | b, [h for _, h in wanted])
    flags = [F.max(h.cast("int")).alias(f"t{i}") for i, h in wanted]
    all_hit = functools.reduce(lambda a, b: a & b, [F.col(f"t{i}") == 1 for i, _ in wanted])
    return tokens.filter(any_hit).groupBy("key").agg(*flags).filter(all_hit).select("key")


def category_nearby(place: DataFrame, category: str, lat: float, lon: float, radius_km: float, limit: int) -> DataFrame:
    """Nearest points of a category: a box on (cat, lat, lon) first, exact distance second."""
    import math
    dlat = radius_km / 110.54
    dlon = radius_km / (111.32 * math.cos(math.radians(min(89.0, abs(lat) + dlat))))
    boxed = place.filter((F.col("cat") == category) & F.col("lat").between(lat - dlat, lat + dlat) & F.col("lon").between(lon - dlon, lon + dlon))
    d = geo.km(F.lit(lat), F.lit(lon), F.col("lat"), F.col("lon"))
    return boxed.withColumn("km", d).filter(F.col("km") <= radius_km).orderBy("km", "lat", "lon", "name").limit(limit)


def house_lookup(asked: DataFrame, house: DataFrame, street: DataFrame) -> DataFrame:
    """``asked(street, key)`` → the house position, or the street's own when the number is unknown."""
    exact = house.groupBy("street", "key").agg(F.min(F.struct("osm", "lat_e7", "lon_e7")).alias("h"))
    joined = asked.join(exact, ["street", "key"], "left").join(street.select(F.col("id").alias("street"), "lat", "lon"), "street")
    found = F.col("h").isNotNull()
    return joined.select("street", "key", found.alias("exact"), F.when(found, geo.from_e7(F.col("h.lat_e7"))).otherwise(F.col("lat")).alias("lat"),
                         F.when(found, geo.from_e7(F.col("h.lon_e7"))).otherwise(F.col("lon")).alias("lon"))


def street_context(street: DataFrame, locality: DataFrame, commune: DataFrame) -> DataFrame:
    """Street with its locality, commune and district as shown to a driver."""
    l = locality.select(F.col("id").alias("locality"), F.col("name").alias("locality_name"), "district", "commune")
    m = commune.select(F.col("id").alias("commune"), F.col("display").alias("commune_name"))
    return street.select("id", "name", "locality").join(l, "locality", "left").join(m, "commune", "left").select(
        "id", "name", "locality_name", "commune_name", "district")
