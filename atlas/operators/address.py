"""Resolving addressed objects to localities and streets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from atlas.functions import geo, text
from atlas.operators import spatial
from atlas.operators.grid import Grid
from atlas.operators.groups import first_by, nearest_within

PLAUSIBLE_KM = 25.0
FINE_M, SLACK_KM = 2000.0, 10.0   # small cells of by_city; more than a cell's diagonal
ANCHOR_KM = 3.0
NEAR_KM = 15.0
FALLBACK_KM = 30.0
DEDUP_M = 50.0
MAX_STREET_ALIASES = 6
MAX_LOCALITY_ALIASES = 12
LEARN_FROM = 3


def relation_member_lookup(members: DataFrame) -> DataFrame:
    """(kind, ref) of a house member → street name; the relation with the lowest id wins."""
    named = members.filter((F.col("role") == "house") & (F.col("name") != ""))
    return first_by(named, ["kind", "ref"], [F.col("rel_id"), F.col("name")], ["name"])


def street_alias_lookup(ways: DataFrame) -> DataFrame:
    """Street key → up to six names in other languages, from named highways: key, aliases.

    ``ways(id, tags)``; the first occurrence by (way id, language order) counts.
    """
    tags = F.col("tags")
    named = ways.filter(tags["name"].isNotNull() & (tags["name"] != "") & tags["highway"].isNotNull())
    values = F.array(*[tags[k] for k in text.STREET_ALIAS_KEYS])
    rows = (named.select("id", text.street_key(tags["name"]).alias("key"), F.posexplode(values).alias("pos", "alias"))
            .filter((F.col("alias") != "") & (F.length("alias") <= text.MAX_ALIAS_CHARS)
                    & (text.street_key(F.col("alias")) != F.col("key"))))
    first = rows.groupBy("key", "alias").agg(F.min(F.struct("id", "pos")).alias("at"))
    rank = F.row_number().over(Window.partitionBy("key").orderBy("at"))
    kept = first.withColumn("rank", rank).filter(F.col("rank") <= MAX_STREET_ALIASES)
    ordered = F.array_sort(F.collect_list(F.struct("rank", "alias")))
    return kept.groupBy("key").agg(F.transform(ordered, lambda r: r["alias"]).alias("aliases"))


def by_city(points: DataFrame, localities: DataFrame) -> DataFrame:
    """Locality named by the city tag within 25 km, nearest first: point, site, km.

    All houses of a large city share its key, so sites are first met by the small cells in which a key occurs,
    and the points then meet the sites of their own small cell.

    ``points(point, lat, lon, city)``; ``localities(site, lat, lon, name, aliases)``.
    """
    fine, wide = Grid(FINE_M), Grid((PLAUSIBLE_KM + SLACK_KM) * 1000)
    asked = points.filter(F.col("city") != "").select("point", "lat", "lon", "city", fine.cell(F.col("lat"), F.col("lon")).alias("cell"))
    spelled = asked.groupBy("city", "cell").agg(F.min(F.struct("lat", "lon")).alias("at"))   # keys are made once per spelling and cell
    spelled = spelled.select("city", "cell", "at", F.posexplode(text.city_keys(F.col("city"))).alias("key_ord", "key"))
    spot = spelled.groupBy("key", "cell").agg(F.min("at").alias("at"))
    spot = spot.withColumn("far", wide.cell(F.col("at.lat"), F.col("at.lon")))
    names = F.array_distinct(F.transform(F.concat(F.array("name"), F.col("aliases")), text.name_key))
    sites = (localities.select("site", F.col("lat").alias("s_lat"), F.col("lon").alias("s_lon"), F.explode(names).alias("key"))
             .groupBy("key", "s_lat", "s_lon").agg(F.min("site").alias("site")))
    around = sites.withColumn("far", F.explode(wide.around(F.col("s_lat"), F.col("s_lon"))))
    reach = (spot.join(around, ["key", "far"])
             .filter(geo.km(F.col("at.lat"), F.col("at.lon"), F.col("s_lat"), F.col("s_lon")) < PLAUSIBLE_KM + SLACK_KM)
             .select("key", "cell", "site", "s_lat", "s_lon"))
    reach = spelled.select("city", "cell", "key_ord", "key").join(reach, ["key", "cell"]).drop("key")
    km = geo.km(F.col("lat"), F.col("lon"), F.col("s_lat"), F.col("s_lon"))
    found = asked.join(reach, ["city", "cell"]).withColumn("km", km).filter(F.col("km") < PLAUSIBLE_KM)
    best = F.min(F.struct("km", "key_ord", "site")).alias("best")
    return found.groupBy("point").agg(best).select("point", "best.site", "best.km")


def object_stats(objects: DataFrame) -> DataFrame:
    """What the addressed objects state: objects, no_street, via_addr_place, with_city, numbers."""
    street, place, relation = (F.col(c).isNull() for c in ("street", "place", "rel_id"))
    return objects.agg(F.count(F.lit(1)).alias("objects"), F.count_if(street & place & relation).alias("no_street"),
                       F.count_if(street & ~place).alias("via_addr_place"), F.count("city").alias("with_city"), F.count_distinct("num").alias("numbers"))


def nearest_locality(points: DataFrame, sites: DataFrame, coast: DataFrame | None = None) -> DataFrame:
    """Nearest locality within 15 km, else within 30 km unless it is on another landmass.

    ``sites(site, lat, lon, kind_rank)``; a site may have several spots. ``coast(pid, rings)`` holds
    closed coastline rings; it is read only when some point gets as far as the outer band.
    """
    base = points.select("point", "lat", "lon")
    tie = ("kind_rank", "site")
    near = nearest_within(base, sites, [], (3.0, NEAR_KM), geo.km, strict=False, tie=tie)
    if coast is None:
        rest = near.filter(F.col("site").isNull()).select("point")
        far = nearest_within(base.join(rest, "point", "left_semi"), sites, [], (FALLBACK_KM,), geo.km, tie=tie)
        return near.filter(F.col("site").isNotNull()).unionByName(far)
    rest = base.join(near.filter(F.col("site").isNull()), "point", "left_semi")
    if rest.isEmpty():
        return near
    there = spatial.landmass_of(rest, coast)
    spots = sites.select("lat", "lon").distinct().withColumn("point", F.struct("lat", "lon"))
    land = spatial.landmass_of(spots, coast).select("lat", "lon", F.col("landmass").alias("side_landmass"))
    placed = sites.join(land, ["lat", "lon"], "left")
    same = lambda d, p, s: spatial.same_landmass(F.col(f"{p}.landmass"), F.col(f"{s}.side_landmass"))
    far = nearest_within(there, placed, [], (FALLBACK_KM,), geo.km, tie=tie, allowed=same)
    return near.filter(F.col("site").isNotNull()).unionByName(far)


def by_area(points: DataFrame, place_areas: DataFrame, owners: DataFrame) -> DataFrame:
    """Owner of the smallest place area around each point: point, site.

    ``owners(pid, site, kind_rank)`` names the locality each area belongs to.
    """
    owned = place_areas.join(owners, "pid", "left_semi").withColumn("size", geo.ring_area(F.col("rings")))
    hits = spatial.point_in_polygon(points, owned, 0.04).join(owned.select("pid", "size"), "pid").join(owners, "pid")
    best = F.min_by("site", F.struct("size", "kind_rank", "pid")).alias("site")
    return hits.groupBy("point").agg(best)


def anchor_means(rows: DataFrame) -> DataFrame:
    """Mean position of each (street key, locality) in whole e7 units summed exactly."""
    mean = lambda c: (F.sum(F.col(c).cast("bigint") * F.col("weight")) / F.sum("weight") / F.lit(1e7))
    return (rows.filter(F.col("site").isNotNull()).groupBy("skey", "site")
            .agg(mean("lat_e7").alias("lat"), mean("lon_e7").alias("lon")))


def anchor_join(unresolved: DataFrame, anchors: DataFrame) -> DataFrame:
    """Locality of the nearest same-named street within 3 km: point, site, km."""
    return nearest_within(unresolved.select("point", "lat", "lon", "skey"), anchors, ["skey"], (ANCHOR_KM,), geo.km)


def learned_aliases(seen: DataFrame, localities: DataFrame) -> DataFrame:
    """City spellings met at least three times in a locality that does not know them.

    ``seen(site, spelled, n)`` may repeat; ``localities(site, name, aliases)``. Result: site, aliases
    (new ones, in order), at most twelve names in all.
    """
    often = seen.groupBy("site", "spelled").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEARN_FROM)
    known = F.transform(F.concat(F.array("name"), F.col("aliases")), text.name_key)
    fresh = (often.join(localities.select("site", known.alias("known"), F.size("aliases").alias("have")), "site")
             .withColumn("key", text.name_key(F.col("spelled")))
             .filter(~F.array_contains("known", F.col("key"))))
    single = fresh.groupBy("site", "key", "have").agg(F.min("spelled").alias("spelled"))
    rank = F.row_number().over(Window.partitionBy("site").orderBy("spelled"))
    kept = (single.withColumn("rank", rank).filter(F.col("rank") <= MAX_LOCALITY_ALIASES)
            .filter(F.col("rank") + F.col("have") <= MAX_LOCALITY_ALIASES))
    return kept.groupBy("site").agg(F.array_sort(F.collect_list("spelled")).alias("learned"))


def clash_50m(a_lat, a_lon, b_lat, b_lon):
    return geo.meters(a_lat, a_lon, b_lat, b_lon) < F.lit(DEDUP_M)
