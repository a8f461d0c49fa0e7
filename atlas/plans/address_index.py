"""P3: streets and deduplicated houses of one country."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlas.functions import geo, osm, text
from atlas.operators import address, spatial
from atlas.operators.groups import dense_ids, greedy_thin, most_frequent, upper_median
from atlas.plans.localities import Localities
from atlas.session import Scratch, cut_lineage

NO_LOCALITY = -1


@dataclass(frozen=True)
class AddressIndex:
    street: DataFrame     # id, name, aliases, city, lat, lon, houses, locality, city_alt
    house: DataFrame      # street, key, osm, num, lat_e7, lon_e7
    locality: DataFrame   # id, name, aliases, kind, district, commune, lat, lon, pop, houses
    commune: DataFrame
    stats: DataFrame      # what, n


def address_objects(features: DataFrame) -> DataFrame:
    """Features of an extract that carry a house number, as ``objects``: what ``resolve`` takes.

    ``features`` as ``read_geojson_seq`` gives them. A point stands for itself, a line for the mean of its points, an
    area for the mean of its first outer ring.
    """
    tag = lambda k: F.col("tags")[k]
    mean = geo.ring_centroid(F.coalesce(F.when(F.size("rings") > 0, F.col("rings")), F.array("line")))
    lat, lon = F.coalesce("lat", mean["y"]), F.coalesce("lon", mean["x"])
    numbered = features.filter(tag("addr:housenumber") != "").select(
        osm.kind_code(F.col("object")).alias("kind"), "oid", lat.alias("lat"), lon.alias("lon"), tag("addr:street").alias("street"),
        tag("addr:place").alias("place"), F.coalesce(tag("addr:city"), F.lit("")).alias("city"), tag("addr:housenumber").alias("num"))
    e7 = lambda c: F.bround(F.col(c) * 1e7).cast("int").alias(f"{c}_e7")
    return numbered.filter("lat is not null").select("kind", "oid", e7("lat"), e7("lon"), "lat", "lon", "street", "place", "city", "num")


def house_members(relations: DataFrame) -> DataFrame:
    """Members of the relations that give their houses a street name: rel_id, kind, ref, role, name."""
    tags = F.col("tags")
    named = relations.filter((tags["type"] == "associatedStreet") & (tags["name"] != ""))
    return (named.select(F.col("id").alias("rel_id"), F.explode("members").alias("m"), tags["name"].alias("name"))
            .select("rel_id", osm.kind_code(F.col("m.type")).alias("kind"), F.col("m.ref").alias("ref"), F.col("m.role").alias("role"), "name"))


def resolve(objects: DataFrame, members: DataFrame, places: Localities, place_areas: DataFrame,
            country: DataFrame | None = None, coast: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Objects with their street and locality, and what each decision counted.

    ``objects(kind, oid, lat_e7, lon_e7, lat, lon, street, place, city, num)`` with kind 0 node, 1 way,
    2 relation. The method is name, area, anchor, nearest or NULL.
    """
    o = objects.withColumn("point", F.col("oid") * 4 + F.col("kind"))
    inside = spatial.country_cut(o, country) if country is not None else o
    assoc = address.relation_member_lookup(members).withColumnsRenamed({"ref": "oid", "name": "assoc"})
    filled = lambda c: F.nullif(F.col(c), F.lit(""))
    inside = inside.join(assoc, ["kind", "oid"], "left")
    inside = inside.withColumn("name", F.coalesce(filled("street"), F.col("assoc"), filled("place")))
    via = (F.when(filled("street").isNotNull(), "addr_street").when(F.col("assoc").isNotNull(), "associated_street")
           .when(filled("place").isNotNull(), "addr_place").otherwise("no_street"))
    steps = Scratch(o.sparkSession, "address")
    inside = steps.keep(inside.withColumn("via", via).drop("street", "place", "assoc"), "inside")
    rows = (inside.filter(F.col("name").isNotNull()).drop("via")
            .withColumn("skey", text.street_key(F.col("name"))).withColumn("keys", text.house_keys(F.col("num")))
            .withColumn("weight", F.size("keys").cast("bigint")))
    sites = places.locality.select(F.col("id").alias("site"), "lat", "lon", "name", "aliases", "kind_rank")
    named = address.by_city(rows.select("point", "lat", "lon", "city"), sites).select("point", F.col("site").alias("named"))
    rows = rows.join(named, "point", "left")
    open_rows = rows.filter(F.col("named").isNull())
    owners = places.owner.join(places.locality.select("id", "kind_rank"), "id").select("pid", F.col("id").alias("site"), "kind_rank")
    held = address.by_area(open_rows.select("point", "lat", "lon"), place_areas, owners).withColumnRenamed("site", "held")
    rows = rows.join(held, "point", "left").withColumn("site", F.coalesce("named", "held"))
    method = F.when(F.col("named").isNotNull(), "name").when(F.col("held").isNotNull(), "area")
    first = steps.keep(rows.withColumn("method", method).drop("named", "held"), "first")

    anchors = address.anchor_means(first.filter("weight > 0"))
    loose = first.filter(F.col("site").isNull() & (F.col("weight") > 0))
    anchored = address.anchor_join(loose, anchors).filter(F.col("site").isNotNull()).select("point", F.col("site").alias("anchored"))
    anchored = steps.keep(anchored, "anchored")
    spots = sites.select("site", "lat", "lon", "kind_rank").unionByName(
        places.ghost.join(places.locality.select("id", "kind_rank"), "id").select(F.col("id").alias("site"), "lat", "lon", "kind_rank"))
    rest = loose.join(anchored, "point", "left_anti")
    near = address.nearest_locality(rest, spots, coast).select("point", F.col("site").alias("nearest"))
    # a point's site was found by its number, so rows that have one meet none of the points without
    late = (first.filter("site is null").drop("site", "method").join(anchored, "point", "left").join(near, "point", "left")
            .withColumn("method", F.when(F.col("anchored").isNotNull(), F.lit("anchor")).when(F.col("nearest").isNotNull(), F.lit("nearest")))
            .withColumn("site", F.coalesce("anchored", "nearest")).drop("anchored", "nearest"))
    done = steps.keep(first.filter("site is not null").unionByName(late), "done")
    steps.drop("first", "anchored")
    one = lambda df, c: df.groupBy(c.alias("what")).agg(F.count(F.lit(1)).alias("n"))
    total = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("what"), "n")
    stats = (total(o, "objects")
             .unionByName(total(o.join(inside.select("point"), "point", "left_anti"), "foreign_objects_dropped"))
             .unionByName(one(inside.filter("via <> 'addr_street'"), F.when(F.col("via") == "no_street", "no_street").otherwise(F.concat(F.lit("via_"), "via"))))
             .unionByName(done.agg(F.sum("weight").alias("n")).select(F.lit("keys").alias("what"), "n")))
    return done, stats


def build_address_index(objects: DataFrame, members: DataFrame, ways: DataFrame, places: Localities,
                        place_areas: DataFrame, country: DataFrame | None = None,
                        coast: DataFrame | None = None) -> AddressIndex:
    done, stats = resolve(objects, members, places, place_areas, country, coast)
    spelled = F.trim(F.col("city"))
    seen = (done.filter((F.col("city") != "") & F.col("method").isin("area", "anchor", "nearest"))
            .select("site", spelled.alias("spelled"), F.when(F.col("method") == "area", F.lit(1).cast("bigint")).otherwise(F.col("weight")).alias("n")))
    known = places.locality.select(F.col("id").alias("site"), "name", "aliases")
    learned = address.learned_aliases(seen, known).withColumnRenamed("site", "id")
    locality = (places.locality.join(learned, "id", "left")
                .withColumn("aliases", F.when(F.col("learned").isNull(), F.col("aliases")).otherwise(F.concat("aliases", "learned"))))
    locality = cut_lineage(locality)

    raw = (done.withColumn("loc", F.coalesce("site", F.lit(NO_LOCALITY)))
           .select("skey", "loc", "kind", "oid", "name", "num", "lat", "lon", "lat_e7", "lon_e7",
                   F.coalesce("method", F.lit("unresolved")).alias("method"), F.explode("keys").alias("key")))
    group = ["skey", "loc"]
    kept = greedy_thin(raw.drop("method"), [*group, "key"], ["kind", "oid"], address.DEDUP_M, address.clash_50m, ties=["name"])
    steps = Scratch(raw.sparkSession, "street")
    facts = {"name": most_frequent(raw, group, "name"), "method": most_frequent(raw, group, "method"), "lat_e7": upper_median(raw, group, "lat_e7"),
             "lon_e7": upper_median(raw, group, "lon_e7"), "houses": kept.groupBy(*group).agg(F.count(F.lit(1)).alias("houses"))}
    per_street = reduce(lambda a, b: a.join(b, group), [steps.keep(df, what) for what, df in facts.items()])   # one at a time holds all addresses
    street = dense_ids(per_street, [F.col("skey"), F.col("loc")], "id")
    other = address.street_alias_lookup(ways).withColumnRenamed("key", "skey")
    street = street.join(other, "skey", "left")
    listed = F.coalesce("aliases", F.array().cast("array<string>"))
    street = street.withColumn("aliases", F.concat(listed, text.yo_variants(F.concat(F.array("name"), listed))))
    city = locality.select(F.col("id").alias("loc"), F.col("name").alias("city"), F.col("aliases").alias("city_alt"))
    street = street.join(city, "loc", "left")
    house = (kept.join(street.select(F.col("id").alias("street"), *group), group)
             .select("street", "key", (F.col("oid") * 4 + F.col("kind")).alias("osm"),
                     F.when(text.house_display(F.col("num"), F.col("key")) != F.col("key"), text.house_display(F.col("num"), F.col("key"))).alias("num"),
                     "lat_e7", "lon_e7"))
    lived = street.groupBy(F.col("loc").alias("id")).agg(F.sum("houses").alias("houses"))
    locality = locality.join(lived, "id", "left").withColumn("houses", F.coalesce("houses", F.lit(0).cast("bigint")))
    total = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("what"), "n")
    stats = (stats.unionByName(places.stats)
             .unionByName(street.groupBy(F.concat(F.lit("streets_by_"), "method").alias("what")).agg(F.count(F.lit(1)).alias("n")))
             .unionByName(total(street, "streets")).unionByName(total(house, "houses"))
             .unionByName(raw.select(F.lit(1).cast("bigint").alias("d")).unionByName(kept.select(F.lit(-1).cast("bigint").alias("d")))
                          .agg(F.sum("d").alias("n")).select(F.lit("dedup_dropped").alias("what"), "n"))
             .unionByName(learned.agg(F.sum(F.size("learned")).cast("bigint").alias("n")).select(F.lit("aliases_learned").alias("what"), F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))))
    street = street.select("id", "name", F.when(F.size("aliases") > 0, F.col("aliases")).alias("aliases"),
                           F.coalesce("city", F.lit("")).alias("city"), (F.col("lat_e7") / 1e7).alias("lat"), (F.col("lon_e7") / 1e7).alias("lon"),
                           "houses", F.nullif(F.col("loc"), F.lit(NO_LOCALITY)).alias("locality"),
                           F.when(F.size("city_alt") > 0, F.col("city_alt")).alias("city_alt"), "method", "skey")
    columns = ["id", "name", "aliases", "kind", "district", "commune", "lat", "lon", "pop", "houses"]
    return AddressIndex(street, house, locality.select(*columns), places.commune, stats)
