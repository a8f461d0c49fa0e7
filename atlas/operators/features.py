"""Navigation features: node features, enforcement relations, bus lanes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlas.functions import geo, osm, text
from atlas.operators import filters

# --- fixed values -----------------------------------------------------------------------------
NODE_FEATURES = (("n", "highway", ("speed_camera", "traffic_signals")),
                 ("n", "railway", ("level_crossing", "tram_level_crossing")))
ENFORCEMENT = ("maxspeed", "traffic_signals", "average_speed")
# ----------------------------------------------------------------------------------------------

AGREE_DEGREES = 30.0


def way_places(ways: DataFrame) -> DataFrame:
    """One row per node of each way with its neighbours: way, pos, node, before, after, interior."""
    slot = F.transform("refs", lambda r, i: F.struct(
        i.alias("pos"), r.alias("node"),
        F.when(i > 0, F.get("refs", i - 1)).otherwise(r).alias("before"),
        F.coalesce(F.get("refs", i + 1), r).alias("after"),
        ((i > 0) & (i < F.size("refs") - 1)).alias("interior")))
    return ways.select(F.col("id").alias("way"), F.inline(slot))


def node_parents(ways: DataFrame, located: DataFrame) -> DataFrame:
    """Drivable ways each located node (``id``) lies on, with the neighbours there."""
    roads = ways.filter(filters.drivable(F.col("tags")))
    return way_places(roads).join(located.select(F.col("id").alias("node")), "node", "left_semi")


def neighbour_bearings(parents: DataFrame, nodes: DataFrame) -> DataFrame:
    """Direction of each way at each node, from the node before to the node after; places whose
    neighbours coincide or have no position are left out."""
    # both neighbours are looked up in one pass over the positions
    ends = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("before").alias("end")), F.struct(F.lit(1).alias("side"), F.col("after").alias("end")))).alias("e")
    asked = parents.filter("before <> after").select("node", "way", "pos", "interior", ends).select("node", "way", "pos", "interior", "e.side", "e.end")
    met = asked.join(nodes.select(F.col("id").alias("end"), "lat", "lon"), "end")
    of = lambda side, name: F.max(F.when(F.col("side") == side, F.col(name)))
    placed = (met.groupBy("node", "way", "pos", "interior").agg(of(0, "lat").alias("a_lat"), of(0, "lon").alias("a_lon"), of(1, "lat").alias("b_lat"), of(1, "lon").alias("b_lon"))
              .filter("a_lat IS NOT NULL AND b_lat IS NOT NULL"))
    brg = geo.bearing(F.col("a_lat"), F.col("a_lon"), F.col("b_lat"), F.col("b_lon"))
    return placed.select("node", "way", "pos", "interior", brg.alias("brg"))


def way_directions(bearings: DataFrame) -> DataFrame:
    """The way direction of each node: the only interior parent decides, else all must agree within 30°."""
    order = F.struct("way", "pos")
    facts = bearings.groupBy("node").agg(
        F.count_if("interior").alias("inner"), F.min_by("brg", order).alias("first"),
        F.min_by(F.when(F.col("interior"), F.col("brg")), F.when(F.col("interior"), order)).alias("sole"))
    spread = (bearings.join(facts.select("node", "first"), "node").groupBy("node")
              .agg(F.max(geo.angle_diff(F.col("first"), F.col("brg"))).alias("spread")))
    agreed = F.when(F.col("inner") == 1, F.col("sole")).when(F.col("spread") <= AGREE_DEGREES, F.col("first"))
    return facts.join(spread, "node").select("node", agreed.alias("way_brg"))


def node_rows(features: DataFrame, bearings: DataFrame, on_network_only: bool = False) -> DataFrame:
    """Feature rows of tagged nodes: id, type, lat, lon, bearing, src, maxspeed, ways, signal, unresolved."""
    tags = F.col("tags")
    ways = bearings.groupBy("node").agg(F.array_sort(F.collect_list("way")).alias("ways"))
    typed = (F.when(tags["highway"] == "speed_camera", "camera_speed").when(tags["railway"] == "level_crossing", "level_crossing")
             .when(tags["railway"] == "tram_level_crossing", "tram_level_crossing").otherwise("traffic_signals"))
    rows = (features.withColumn("type", typed).join(ways.withColumnRenamed("node", "id"), "id", "left")
            .join(way_directions(bearings).withColumnRenamed("node", "id"), "id", "left")
            .withColumn("ways", F.coalesce("ways", F.array().cast("array<bigint>"))))
    camera = F.col("type") == "camera_speed"
    kept = (F.size("ways") > 0) if on_network_only else camera | (F.size("ways") > 0)
    stated = F.when(camera, tags["direction"]).when(F.col("type") == "traffic_signals", tags["traffic_signals:direction"])
    d = osm.parse_direction(stated)
    along = d["src"].isin("fwd", "bwd")
    turned = F.pmod(F.col("way_brg") + F.when(d["src"] == "bwd", 180.0).otherwise(0.0), F.lit(360.0))
    bearing = (F.when(along & F.col("way_brg").isNotNull(), F.array(turned)).when(d["src"].isin("deg", "card"), d["degrees"])
               .otherwise(F.array().cast("array<double>")))
    src = F.when(along, F.when(F.col("way_brg").isNotNull(), d["src"])).when(d["src"].isin("deg", "card"), d["src"])
    signal = F.when(F.col("type") == "traffic_signals", text.signal_value(F.nullif(tags["traffic_signals"], F.lit(""))))
    return rows.select(
        F.col("id").alias("node"), "type", "lat", "lon", bearing.alias("bearing"), src.alias("src"),
        F.when(camera, osm.maxspeed_kmh(tags["maxspeed"])).alias("maxspeed"), "ways", signal.alias("signal"),
        (along & F.col("way_brg").isNull()).alias("unresolved"), kept.alias("kept"))


def relation_ends(relations: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Enforcement relations with their first located from / to and their section ways; and their located
    devices (rid, pos, device, lat, lon)."""
    tags = F.col("tags")
    kept = relations.filter(tags["enforcement"].isin(*ENFORCEMENT))
    members = kept.select(F.col("id").alias("rid"), F.posexplode("members").alias("pos", "m")).select("rid", "pos", "m.*")
    spots = members.filter("type = 'n'").join(nodes.select(F.col("id").alias("ref"), "lat", "lon"), "ref")
    first = lambda role: F.min(F.when(F.col("role") == role, F.struct("pos", "lat", "lon"))).alias(role)
    ends = spots.groupBy("rid").agg(first("from"), first("to"), F.count_if(F.col("role") == "device").alias("devices"))
    sections = members.filter("type = 'w' and role = 'section'").groupBy("rid").agg(F.array_sort(F.collect_set("ref")).alias("sections"))
    facts = kept.select(F.col("id").alias("rid"), tags["enforcement"].alias("kind"), osm.maxspeed_kmh(tags["maxspeed"]).alias("maxspeed"))
    facts = facts.join(ends, "rid", "left").join(sections, "rid", "left").withColumn("devices", F.coalesce("devices", F.lit(0)))
    devices = spots.filter("role = 'device'").select("rid", "pos", F.col("ref").alias("device"), "lat", "lon")
    return facts, devices


def bearing_between(a: str, b: str):
    return geo.bearing(F.col(f"{a}.lat"), F.col(f"{a}.lon"), F.col(f"{b}.lat"), F.col(f"{b}.lon"))


def section_rows(facts: DataFrame) -> DataFrame:
    """Average-speed relations with both ends: one section row each."""
    f = facts.filter((F.col("kind") == "average_speed") & F.col("from").isNotNull() & F.col("to").isNotNull())
    to = F.concat_ws(",", geo.e7(F.col("to.lat")), geo.e7(F.col("to.lon")))
    listed = F.array_join(F.transform("sections", lambda w: F.concat(F.lit("w"), w.cast("string"))), ",")
    none = F.lit(None).cast("string")
    attrs = F.map_filter(F.create_map(F.lit("bsrc"), F.lit("rel"), F.lit("to"), to, F.lit("sections"), F.coalesce(listed, none)), lambda k, v: v.isNotNull() & (v != ""))
    return f.select(F.concat(F.lit("r"), "rid").alias("id"), F.lit("camera_section").alias("type"), F.col("from.lat").alias("lat"), F.col("from.lon").alias("lon"),
                    F.array(bearing_between("from", "to")).alias("bearing"), "maxspeed", F.array().cast("array<bigint>").alias("ways"), attrs.alias("attrs"))


def device_claims(facts: DataFrame, devices: DataFrame) -> DataFrame:
    """What each relation says about each of its devices, or about itself when it has none but a from:
    rid, pos, device, lat, lon, kind, maxspeed, brg, src."""
    f = facts.filter("kind <> 'average_speed'")
    d = devices.select("rid", "pos", "device", F.struct("lat", "lon").alias("dev"))
    own = f.filter((F.col("devices") == 0) & F.col("from").isNotNull()).select(
        "rid", F.lit(0).alias("pos"), F.lit(None).cast("bigint").alias("device"), F.struct("from.lat", "from.lon").alias("dev"))
    rows = f.join(d.unionByName(own), "rid")
    has = F.col("device").isNotNull()
    differs = lambda end: F.col(end).isNotNull() & ((F.col(f"{end}.lat") != F.col("dev.lat")) | (F.col(f"{end}.lon") != F.col("dev.lon")))
    from_first, dev_to = has & differs("from"), has & differs("to")
    both = F.col("from").isNotNull() & F.col("to").isNotNull()
    brg = (F.when(from_first, bearing_between("from", "dev")).when(dev_to, bearing_between("dev", "to")).when(both, bearing_between("from", "to")))
    src = F.when(from_first, "rel").when(dev_to, "relrev").when(both, "rel")
    return rows.select("rid", "pos", "device", F.col("dev.lat").alias("lat"), F.col("dev.lon").alias("lon"), "kind", "maxspeed", brg.alias("brg"), src.alias("src"))


def _attrs(**values):
    pairs = [x for k, v in sorted(values.items()) for x in (F.lit(k), v)]
    return F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull())


def enforce(nodes: DataFrame, claims: DataFrame, bearings: DataFrame) -> DataFrame:
    """Node rows enriched by relations, plus rows that only relations know.

    All claims on one device are summed up in relation order: a red-light relation sets the type, the first
    stated bearing and speed fill gaps, the last relation is recorded. A device that is a non-camera
    row keeps it, and the relation becomes a row of its own.
    """
    rel = F.concat(F.lit("r"), F.col("rid").cast("string"))
    order = F.struct("rid", "pos")
    summed = claims.filter("device is not null").groupBy(F.col("device").alias("node")).agg(
        F.max((F.col("kind") == "traffic_signals").cast("int")).alias("red"),
        F.min(F.when(F.col("brg").isNotNull(), F.struct("rid", "pos", "brg", "src"))).alias("b"),
        F.min(F.when(F.col("maxspeed").isNotNull(), F.struct("rid", "pos", "maxspeed"))).alias("m"),
        F.max_by(rel, order).alias("rel"), F.min_by("lat", order).alias("d_lat"), F.min_by("lon", order).alias("d_lon"))
    ways = bearings.groupBy("node").agg(F.array_sort(F.collect_list("way")).alias("d_ways"))
    rows = nodes.filter("kept").join(summed, "node", "full").join(ways, "node", "left")
    tagged = F.col("type").isNotNull()
    other = tagged & (F.col("type") != "camera_speed")
    claimed = F.col("rel").isNotNull() & ~other
    empty = F.coalesce(F.size("bearing") == 0, F.lit(True))
    takes = claimed & empty & F.col("b").isNotNull()
    no_bearing = F.array().cast("array<double>")
    none = F.array().cast("array<bigint>")
    merged = rows.select(
        F.concat(F.lit("n"), "node").alias("id"),
        F.when(claimed & (F.col("red") == 1), F.lit("camera_red_light")).otherwise(F.coalesce("type", F.lit("camera_speed"))).alias("type"),
        F.coalesce("lat", "d_lat").alias("lat"), F.coalesce("lon", "d_lon").alias("lon"),
        F.when(takes, F.array("b.brg")).otherwise(F.coalesce("bearing", no_bearing)).alias("bearing"),
        F.coalesce("maxspeed", F.when(claimed, F.col("m.maxspeed"))).alias("maxspeed"),
        F.when(tagged, F.col("ways")).otherwise(F.coalesce("d_ways", none)).alias("ways"),
        _attrs(bsrc=F.when(takes, F.col("b.src")).otherwise(F.col("src")), rel=F.when(claimed, F.col("rel")), signal=F.col("signal")).alias("attrs"))
    own_type = F.when(F.col("kind") == "traffic_signals", "camera_red_light").otherwise("camera_speed")
    others = nodes.filter("kept and type <> 'camera_speed'").select(F.col("node").alias("device"), F.lit(True).alias("taken"))
    apart = (claims.join(others, "device", "left").filter(F.col("device").isNull() | F.col("taken")))
    last = apart.groupBy("rid").agg(F.max_by(F.struct("device", "lat", "lon", "kind", "maxspeed", "brg", "src"), "pos").alias("c")).select("rid", "c.*")
    alone = (last.join(ways.withColumnRenamed("node", "device"), "device", "left")
             .select(rel.alias("id"), own_type.alias("type"), "lat", "lon",
                     F.when(F.col("brg").isNotNull(), F.array("brg")).otherwise(no_bearing).alias("bearing"), "maxspeed",
                     F.coalesce("d_ways", none).alias("ways"), _attrs(bsrc=F.col("src"), rel=rel).alias("attrs")))
    return merged.unionByName(alone)


def canonical_features(rows: DataFrame) -> DataFrame:
    """The columns as written: e7 positions, whole bearings, prefixed way ids."""
    whole = F.transform("bearing", lambda b: F.pmod(F.bround(b).cast("int"), F.lit(360)))
    return rows.select("id", "type", geo.e7(F.col("lat")).alias("lat_e7"), geo.e7(F.col("lon")).alias("lon_e7"), whole.alias("bearing"),
                       F.nullif(F.col("maxspeed"), F.lit(0)).alias("maxspeed"),
                       F.transform("ways", lambda w: F.concat(F.lit("w"), w.cast("string"))).alias("way_ids"), "attrs")


def counts_by_type(rows: DataFrame, column: str, values: tuple[str, ...]) -> DataFrame:
    """Rows per value of a fixed list; zeros are kept."""
    spread = rows.agg(*[F.count_if(F.col(column) == v).alias(v) for v in values])
    return spread.select(F.inline(F.array(*[F.struct(F.lit(v).alias(column), F.col(v).alias("n")) for v in values])))


def bus_lanes(ways: DataFrame) -> DataFrame:
    """way_id, side of every way with a stated bus lane."""
    wanted = [("w", k, ()) for k in osm.BUS_LANE_KEYS]
    side = filters.tag_filter(ways, "w", wanted).select(F.col("id").alias("way_id"), osm.bus_lane_side(F.col("tags")).alias("side"))
    return side.filter("side is not null")
