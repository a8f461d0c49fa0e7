"""P2: the localities of one country."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlas.functions import text
from atlas.operators import localities as places
from atlas.operators import spatial
from atlas.operators.groups import dense_ids
from atlas.session import cut_lineage


# --- fixed values: levels whose areas tell localities of one name apart, by country --------------
DISTRICT_LEVEL = {"MD": "4", "RO": "4", "HU": "6", "AT": "6", "DE": "6", "RU": "6"}
COMMUNE_LEVEL = {"RO": "8", "AT": "8", "DE": "8", "RU": "8"}
OTHER_DISTRICT_LEVEL = "6"
# ------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Localities:
    locality: DataFrame   # id, pid, name, aliases, kind, kind_rank, district, commune, lat, lon, pop
    commune: DataFrame    # id, pid, name, display, aliases, district
    ghost: DataFrame      # id, lat, lon: spots of merged duplicates, answering for their survivor
    owner: DataFrame      # pid (area), id
    stats: DataFrame      # what, n


def read_places(objects: DataFrame) -> DataFrame:
    """``objects(pid, tags, …)`` with a place tag → name, aliases, kind, pop, wikidata, is_in next to the rest."""
    tags = F.col("tags")
    kept = objects.filter(tags["place"].isin(*places.KINDS) & (tags["name"] != ""))
    return (kept.withColumn("name", tags["name"]).withColumn("kind", tags["place"])
            .withColumn("aliases", text.locality_aliases(tags, tags["name"]))
            .withColumn("pop", text.population(tags["population"]))
            .withColumn("wikidata", F.coalesce(tags["wikidata"], F.lit("")))
            .withColumn("is_in", F.coalesce(tags["is_in"], F.lit(""))).drop("tags"))


def admin_level_filter(areas: DataFrame, level: str) -> DataFrame:
    """Named administrative areas of exactly this level (members of others come along in extracts)."""
    tags = F.col("tags")
    return areas.filter((tags["boundary"] == "administrative") & (tags["admin_level"] == level) & (tags["name"] != ""))


def admin_areas(areas: DataFrame, code: str) -> tuple[DataFrame, DataFrame | None]:
    """Districts and, where the country has them, communes among administrative ``areas(pid, tags, rings)``."""
    districts = admin_level_filter(areas, DISTRICT_LEVEL.get(code, OTHER_DISTRICT_LEVEL))
    return districts, admin_level_filter(areas, COMMUNE_LEVEL[code]) if code in COMMUNE_LEVEL else None


def fallback_items(items: DataFrame, fallback: DataFrame) -> DataFrame:
    """``items``, or the places of the search index ``fallback(name, lat, lon, pop)`` as towns when there is none."""
    none = F.lit("")
    towns = fallback.select(
        F.concat(F.lit("i"), F.md5(F.concat_ws("|", "name", "lat", "lon"))).alias("pid"), "name", F.array().cast("array<string>").alias("aliases"),
        F.lit("town").alias("kind"), F.col("pop").cast("bigint").alias("pop"), none.alias("wikidata"), none.alias("is_in"), "lat", "lon", F.lit(False).alias("area_only"))
    count = items.agg(F.count(F.lit(1))).scalar()
    return items.unionByName(towns.dropDuplicates(["pid"]).filter(count == 0).select(*items.columns))


def build_localities(points: DataFrame, areas: DataFrame, country: DataFrame | None,
                     districts: DataFrame, communes: DataFrame | None, fallback: DataFrame | None = None) -> Localities:
    """``points(pid, tags, lat, lon)``, ``areas(pid, tags, rings)``; districts and communes are admin areas
    ``(pid, tags, rings)``; a country without communes passes None and merges no duplicates. ``fallback(name, lat, lon,
    pop)`` are the places of the search index, which stand in for a country that names no locality."""
    fields = ["pid", "name", "aliases", "kind", "pop", "wikidata", "is_in"]
    pts = cut_lineage(read_places(points).select(*fields, "lat", "lon"))
    ars = cut_lineage(read_places(areas).select(*fields, "rings"))
    owners = cut_lineage(places.area_owner(pts, ars))
    items = places.flow_to_owners(pts, ars, owners)
    if fallback is not None:
        items = cut_lineage(fallback_items(items, fallback))
    found = items
    if country is not None:
        items = spatial.country_cut(items, country, key="pid")
    named = districts.select("pid", F.col("tags")["name"].alias("district"))
    items = spatial.assign_admin(items, districts, "pid").join(
        named.withColumnRenamed("pid", "admin"), "admin", "left").drop("admin")
    items = items.withColumn("district", F.coalesce("district", F.lit("")))
    no_rows = pts.limit(0)
    if communes is None:
        items = items.withColumn("commune", F.lit(None).cast("string"))
        merged = no_rows.select("pid", F.col("pid").alias("survivor"), F.lit("").alias("why"), "lat", "lon", F.lit(False).alias("conflict"))
        commune = no_rows.select(F.lit(0).cast("bigint").alias("id"), "pid", "name", F.col("name").alias("display"), "aliases", F.lit("").alias("district"))
    else:
        items = cut_lineage(spatial.assign_admin(items, communes, "pid").withColumnRenamed("admin", "commune"))
        # a commune takes the district of its first locality in place order
        first = items.filter(F.col("commune").isNotNull()).groupBy(F.col("commune").alias("pid")).agg(
            F.min_by("district", F.struct("area_only", "pid")).alias("district"))
        made = communes.join(first, "pid").withColumn("name", F.col("tags")["name"])
        made = made.withColumn("display", text.commune_display(F.col("tags")))
        made = made.withColumn("aliases", F.filter(text.locality_aliases(F.col("tags"), F.col("name")), lambda a: a != F.col("display")))
        commune = dense_ids(made.select("pid", "name", "display", "aliases", "district"),
                            [F.col("district"), F.col("name"), F.col("pid")], "id")
        items, merged = places.merge_duplicates(items)
        merged = cut_lineage(merged)
    items = items.withColumn("kind_rank", places.kind_rank(F.col("kind")))
    locality = dense_ids(items, [F.col("kind_rank"), (-F.col("pop")).alias("by_pop"), F.col("name"), F.col("pid")], "id")
    if communes is not None:
        ids = commune.select(F.col("pid").alias("commune"), F.col("id").alias("commune_id"))
        locality = locality.join(ids, "commune", "left").withColumn("commune", F.col("commune_id")).drop("commune_id")
    else:
        locality = locality.withColumn("commune", F.col("commune").cast("bigint"))
    numbered = locality.select("id", F.col("pid").alias("survivor"))
    ghost = merged.join(numbered, "survivor").select("id", "lat", "lon")
    final = owners.select("area", "owner").join(merged.select(F.col("pid").alias("owner"), "survivor"), "owner", "left")
    owner = final.select(F.col("area").alias("pid"), F.coalesce("survivor", "owner").alias("survivor")).join(numbered, "survivor").select("pid", "id")
    what = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("what"), "n")
    stats = (what(locality, "localities").unionByName(what(commune, "communes"))
             .unionByName(what(found.filter("area_only"), "area_only_localities"))
             .unionByName(what(found.join(locality.select("pid"), "pid", "left_anti").join(merged.select("pid"), "pid", "left_anti"), "foreign_localities_dropped"))
             .unionByName(merged.groupBy(F.concat(F.lit("duplicates_merged_"), "why").alias("what")).agg(F.count(F.lit(1)).alias("n")))
             .unionByName(what(merged.filter("conflict"), "merged_with_conflicting_is_in"))
             .unionByName(owner.agg(F.count_distinct("id").alias("n")).select(F.lit("localities_with_area").alias("what"), "n")))
    columns = ["id", "pid", "name", "aliases", "kind", "kind_rank", "district", "commune", "lat", "lon", "pop"]
    return Localities(locality.select(*columns), commune, ghost, owner, stats)
