"""Places of a country: area ownership, duplicates, admin units."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlas.functions import geo, text
from atlas.operators import spatial
from atlas.operators.grid import Grid
from atlas.operators.groups import greedy_thin
from atlas.session import cut_lineage

MERGE_KM = 5.0
DUPLICATE_KM = 2.0
KINDS = ("city", "town", "village", "hamlet")  # fixed values, largest first


def within_merge(a_lat, a_lon, b_lat, b_lon):
    return geo.km(a_lat, a_lon, b_lat, b_lon) <= F.lit(MERGE_KM)


def kind_rank(kind):
    return F.array_position(F.array(*[F.lit(k) for k in KINDS]), kind).cast("int") - 1


def _names(name: str, aliases: str):
    return F.array_distinct(F.transform(F.concat(F.array(name), F.col(aliases)), text.name_key))


def area_owner(points: DataFrame, areas: DataFrame) -> DataFrame:
    """The place each area belongs to: area, owner, rule.

    ``points(pid, name, aliases, lat, lon)``; ``areas(pid, name, aliases, rings)``. Rules in order: a
    point inside with the same name; a point inside sharing any name; the only point inside; a
    same-named point within 5 km of the centroid; an earlier same-named bare area within 5 km; the area
    itself (a locality of its own). A point's names include those it gained from areas with a lower pid.
    """
    a = areas.select(F.col("pid").alias("area"), F.col("name").alias("area_name"), _names("name", "aliases").alias("area_names"))
    p = points.select(F.col("pid").alias("point"), F.col("name").alias("point_name"), _names("name", "aliases").alias("point_names"))
    at = points.select(F.col("pid").alias("point"), "lat", "lon")
    hits = cut_lineage(spatial.point_in_boxed_polygon(at, areas, 0.1).withColumnRenamed("pid", "area")
                       .join(a, "area").join(p, "point"))
    inside = _inside_owners(hits)

    centre = cut_lineage(_centres(areas.join(inside.select(F.col("area").alias("pid")), "pid", "left_anti")))
    keyed = points.select("pid", text.name_key(F.col("name")).alias("key"), "lat", "lon")
    close = cut_lineage(_first_close(centre, keyed).withColumn("rule", F.lit(4)))
    bare = centre.join(close.select(F.col("area").alias("pid")), "pid", "left_anti")
    founders = cut_lineage(greedy_thin(bare, ["key"], ["pid"], MERGE_KM * 1000, within_merge))
    joined = _first_close(bare.join(founders.select("pid"), "pid", "left_anti"), founders, earlier=True).withColumn("rule", F.lit(5))
    own = founders.select(F.col("pid").alias("area"), F.col("pid").alias("owner"), F.lit(6).alias("rule"))
    return inside.unionByName(close).unionByName(joined).unionByName(own)


def _inside_owners(hits: DataFrame) -> DataFrame:
    """Owners found inside the areas: area, owner, rule.

    Areas count in pid order, and a point takes on the names of each area it owns. An area's choice depends
    on areas with a lower pid alone, so repeating the choice with the names gained so far until nothing
    changes gives the ordered result.
    """
    same = text.name_key(F.col("point_name")) == text.name_key(F.col("area_name"))
    shared = F.arrays_overlap("area_names", "point_names")
    asked = hits.select("area", "point", F.explode("area_names").alias("key"))
    gained, owners = None, None
    while True:
        known = hits.withColumn("gained", F.lit(False)) if gained is None else hits.join(gained, ["area", "point"], "left")
        rule = F.when(same, 1).when(shared | F.coalesce("gained", F.lit(False)), 2).otherwise(3)
        found = cut_lineage(known.withColumn("rule", rule).groupBy("area")
                            .agg(F.min(F.struct("rule", "point")).alias("best"), F.count(F.lit(1)).alias("n"))
                            .filter((F.col("best.rule") < 3) | (F.col("n") == 1))
                            .select("area", F.col("best.point").alias("owner"), F.col("best.rule").alias("rule")))
        if owners is not None and found.exceptAll(owners).isEmpty() and owners.exceptAll(found).isEmpty():
            return found
        owners = found
        names = (asked.join(found.select("area", F.col("owner").alias("point")), ["area", "point"])
                 .groupBy("point", "key").agg(F.min("area").alias("since")))
        gained = (asked.join(names, ["point", "key"]).filter(F.col("since") < F.col("area"))
                  .select("area", "point").distinct().withColumn("gained", F.lit(True)))


def _centres(areas: DataFrame) -> DataFrame:
    """Centroid of each area, or its first vertex when the centroid lies outside: pid, key, lat, lon."""
    mid = areas.select("pid", text.name_key(F.col("name")).alias("key"), geo.ring_centroid(F.col("rings")).alias("m"),
                       F.get(F.get("rings", F.lit(0)), F.lit(0)).alias("first"))
    own = mid.select("pid", F.col("m.x").alias("x"), F.col("m.y").alias("y"))
    held = spatial.parity_inside(own, spatial.band_segments(spatial.segments(areas)), []).withColumn("ok", F.lit(True))
    pick = lambda f: F.when(F.col("ok"), F.col(f"m.{f}")).otherwise(F.col(f"first.{f}"))
    return mid.join(held, "pid", "left").select("pid", "key", pick("y").alias("lat"), pick("x").alias("lon"))


def _first_close(centre: DataFrame, keyed: DataFrame, earlier: bool = False) -> DataFrame:
    """Lowest pid of the same key within 5 km; same-spot rows are reduced to the lowest first."""
    grid = Grid(MERGE_KM * 1000)
    spots = keyed.groupBy("key", "lat", "lon").agg(F.min("pid").alias("owner"))
    left = centre.withColumn("cell", grid.cell(F.col("lat"), F.col("lon"))).alias("l")
    right = spots.withColumn("cell", F.explode(grid.around(F.col("lat"), F.col("lon")))).alias("r")
    near = within_merge(F.col("l.lat"), F.col("l.lon"), F.col("r.lat"), F.col("r.lon"))
    same = (F.col("l.key") == F.col("r.key")) & (F.col("l.cell") == F.col("r.cell")) & near
    if earlier:
        same = same & (F.col("r.owner") < F.col("l.pid"))
    return left.join(right, same).groupBy(F.col("l.pid").alias("area")).agg(F.min("r.owner").alias("owner"))


def flow_to_owners(points: DataFrame, areas: DataFrame, owners: DataFrame) -> DataFrame:
    """Places with what their inside areas add (names in area order, population, wikidata), plus the
    area-only localities."""
    inside = owners.filter("rule <= 3").join(areas.withColumnRenamed("pid", "area"), "area")
    renamed = inside.join(points.select(F.col("pid").alias("owner"), F.col("name").alias("own_name")), "owner")
    own = F.when(text.name_key(F.col("name")) != text.name_key(F.col("own_name")), F.array("name")).otherwise(
        F.array().cast("array<string>"))
    spelled = (renamed.select("owner", "area", F.posexplode(F.concat(own, F.col("aliases"))).alias("pos", "alias"))
               .groupBy("owner", "alias").agg(F.min(F.struct("area", "pos")).alias("at")))
    names = spelled.groupBy("owner").agg(F.array_sort(F.collect_list(F.struct("at", "alias"))).alias("n"))
    names = names.select(F.col("owner").alias("pid"), F.transform("n", lambda r: r["alias"]).alias("more"))
    facts = inside.groupBy(F.col("owner").alias("pid")).agg(
        F.min(F.when(F.col("pop") > 0, F.struct("area", "pop"))).alias("p"),
        F.min(F.when(F.col("wikidata") != "", F.struct("area", "wikidata"))).alias("w"))
    enriched = (points.join(names, "pid", "left").join(facts, "pid", "left")
                .withColumn("aliases", F.when(F.col("more").isNull(), F.col("aliases")).otherwise(F.array_union("aliases", "more")))
                .withColumn("pop", F.when(F.col("pop") > 0, F.col("pop")).otherwise(F.coalesce("p.pop", "pop")))
                .withColumn("wikidata", F.when(F.col("wikidata") != "", F.col("wikidata")).otherwise(F.coalesce("w.wikidata", "wikidata")))
                .select(*points.columns).withColumn("area_only", F.lit(False)))
    founders = areas.join(owners.filter("rule = 6").select(F.col("area").alias("pid")), "pid", "left_semi")
    made = founders.join(_centres(founders).select("pid", "lat", "lon"), "pid").select(*points.columns).withColumn("area_only", F.lit(True))
    return enriched.unionByName(made)


def merge_duplicates(localities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One village mapped twice inside one commune is one locality.

    ``localities(pid, name, aliases, lat, lon, pop, wikidata, is_in, area_only, commune, …)``. Survivor: first
    by (has wikidata, population, point before area, pid). Others join it for the same wikidata, as a
    bare area, or as a bare point within 2 km of an informative survivor. Returns the surviving rows and
    the merged ones (pid, survivor, why, lat, lon, conflict).

    The survivor's wikidata and the "informative" test cannot change while others merge (whoever has
    wikidata, or else the largest population, already survives), so no ordered walk is needed.
    """
    ordered = F.struct(F.col("wikidata") == "", -F.col("pop"), F.col("area_only"), F.col("pid"))
    rows = localities.withColumn("key", text.name_key(F.col("name"))).withColumn("ord", ordered)
    fields = ["pid", "name", "lat", "lon", "pop", "wikidata", "is_in"]
    heads = (rows.filter(F.col("commune").isNotNull()).groupBy("commune", "key")
             .agg(F.min_by(F.struct(*fields), F.col("ord")).alias("s"), F.count(F.lit(1)).alias("size"))
             .filter("size > 1"))
    m = rows.join(heads, ["commune", "key"]).filter(F.col("pid") != F.col("s.pid"))
    bare = (F.col("wikidata") == "") & (F.col("pop") == 0)
    informed = (F.col("s.wikidata") != "") | (F.col("s.pop") > 0)
    close = geo.km(F.col("lat"), F.col("lon"), F.col("s.lat"), F.col("s.lon")) <= F.lit(DUPLICATE_KM)
    why = (F.when((F.col("wikidata") != "") & (F.col("wikidata") == F.col("s.wikidata")), "wikidata")
           .when(bare & F.col("area_only"), "area").when(bare & informed & close, "near"))
    m = m.withColumn("why", why).filter(F.col("why").isNotNull())
    # is_in is compared with the first one stated by the survivor or, failing that, by the merged rows
    first_in = m.groupBy(F.col("s.pid").alias("survivor")).agg(
        F.min(F.when(F.col("is_in") != "", F.struct("ord", "is_in"))).alias("f"))
    m = m.withColumn("survivor", F.col("s.pid")).join(first_in, "survivor", "left")
    against = F.when(F.col("s.is_in") != "", F.col("s.is_in")).when(F.col("f.ord") < F.col("ord"), F.col("f.is_in")).otherwise("")
    merged = m.withColumn("conflict", text.is_in_conflict(F.col("is_in"), against))

    spelled = (merged.select("survivor", "ord", F.col("s.name").alias("own"),
                             F.posexplode(F.concat(F.array("name"), F.col("aliases"))).alias("pos", "alias"))
               .filter(text.name_key(F.col("alias")) != text.name_key(F.col("own")))
               .groupBy("survivor", "alias").agg(F.min(F.struct("ord", "pos")).alias("at")))
    names = spelled.groupBy(F.col("survivor").alias("pid")).agg(F.array_sort(F.collect_list(F.struct("at", "alias"))).alias("n"))
    pops = merged.groupBy(F.col("survivor").alias("pid")).agg(F.max("pop").alias("most"))
    kept = (localities.join(merged.select("pid"), "pid", "left_anti")
            .join(names.select("pid", F.transform("n", lambda r: r["alias"]).alias("more")), "pid", "left")
            .join(pops, "pid", "left")
            .withColumn("aliases", F.when(F.col("more").isNull(), F.col("aliases")).otherwise(F.array_union("aliases", "more")))
            .withColumn("pop", F.greatest("pop", F.coalesce("most", F.lit(0).cast("bigint"))))
            .select(*localities.columns))
    return kept, merged.select("pid", "survivor", "why", "lat", "lon", "conflict")


def same_name_census(localities: DataFrame) -> DataFrame:
    """Names that several localities of one commune share: name, commune, n."""
    return localities.groupBy("name", "commune").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
