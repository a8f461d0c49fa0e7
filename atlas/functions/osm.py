"""Expressions over map-object tags and ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------------------------
DRIVABLE = (
    "motorway", "trunk", "primary", "secondary", "tertiary", "unclassified", "residential",
    "living_street", "service", "road", "track", "motorway_link", "trunk_link", "primary_link",
    "secondary_link", "tertiary_link",
)
ARTERIAL = (
    "motorway", "trunk", "primary", "secondary", "tertiary", "motorway_link", "trunk_link",
    "primary_link", "secondary_link", "tertiary_link",
)
NOT_DRIVABLE = (
    "footway", "path", "cycleway", "steps", "pedestrian", "bridleway", "corridor", "platform",
    "construction", "proposed", "raceway", "bus_guideway", "elevator", "via_ferrata",
)
ACCESS_KEYS = ("motorcar", "motor_vehicle", "vehicle", "access")
CARDINALS = ("N", "NNE", "NE", "ENE", "E", "ESE", "SE", "SSE",
             "S", "SSW", "SW", "WSW", "W", "WNW", "NW", "NNW")
INFERRED_SERVICE = ("parking_aisle", "driveway", "drive-through")
BUS_LANES_RIGHT = ("lanes:bus", "lanes:psv", "lanes:bus:forward", "lanes:psv:forward")
BUS_LANES_LEFT = ("lanes:bus:backward", "lanes:psv:backward")
BUS_LANE_KEYS = ("busway", "busway:both", "busway:right", "busway:left") + BUS_LANES_RIGHT + BUS_LANES_LEFT
# ----------------------------------------------------------------------------------------------

KIND_CODE = {"n": 0, "w": 1, "r": 2}
PROMOTED_CLASS = "tertiary"
PARKED_SERVICE_KEY = "atlas:service"
REGION_SHIFT = 46


def kind_code(kind: Column) -> Column:
    return F.when(kind == "n", 0).when(kind == "w", 1).when(kind == "r", 2)


def osm_code(kind: Column, oid: Column) -> Column:
    """One number for a node, way or relation."""
    return oid.cast("bigint") * 4 + kind_code(kind)


def maxspeed_kmh(value: Column) -> Column:
    pattern = r"^\s*(\d+(?:\.\d+)?)\s*(mph)?\s*$"
    number = F.nullif(F.regexp_extract(value, pattern, 1), F.lit("")).cast("double")
    mph = F.regexp_extract(value, pattern, 2) != ""
    return F.bround(F.when(mph, number * F.lit(1.609344)).otherwise(number)).cast("int")


def parse_direction(value: Column) -> Column:
    """struct(src, degrees): src in fwd, bwd, both, deg, card or NULL when nothing usable is said.

    The first part of a list decides between deg and card.
    """
    v = F.trim(value)
    parts = F.transform(F.split(v, ";"), lambda p: F.trim(p))
    table = F.create_map(*[x for i, d in enumerate(CARDINALS) for x in (F.lit(d), F.lit(i * 22.5))])
    degrees = F.transform(parts, lambda p: F.when(
        p.rlike(r"^-?\d+(\.\d+)?$"), F.pmod(p.try_cast("double"), F.lit(360.0))).otherwise(
        table[F.upper(p)]))
    stated = parts[0].rlike(r"^-?\d+(\.\d+)?$")
    usable = ~F.exists(degrees, lambda d: d.isNull())
    src = (F.when(v == "forward", "fwd").when(v.isin("backward", "reverse"), "bwd")
           .when(v == "both", "both").when(usable, F.when(stated, "deg").otherwise("card")))
    return F.struct(src.alias("src"), F.when(src.isin("deg", "card"), degrees).alias("degrees"))


def lane_count(value: Column) -> Column:
    return F.when(F.trim(value).rlike(r"^\d+$"), F.trim(value).try_cast("bigint"))


def bus_lane_side(tags: Column) -> Column:
    """right / left / both, or NULL when no present lane is stated."""
    lane = lambda k: F.coalesce(tags[k] == "lane", F.lit(False))
    some = lambda ks: F.greatest(*[F.coalesce(lane_count(tags[k]), F.lit(0)) for k in ks]) >= 1
    right = lane("busway") | lane("busway:right") | some(BUS_LANES_RIGHT)
    left = lane("busway:left") | some(BUS_LANES_LEFT)
    return (F.when(lane("busway:both") | (left & right), "both")
            .when(right, "right").when(left, "left"))


def oneway_of(tags: Column) -> Column:
    """1 forward only, -1 backward only, 0 both ways."""
    value = F.coalesce(tags["oneway"], F.lit(""))
    return (F.when(value.isin("yes", "true", "1"), 1).when(value.isin("-1", "reverse"), -1)
            .when((tags["junction"] == "roundabout") & ~value.isin("no", "false", "0"), 1)
            .otherwise(0))


def access_ok(tags: Column) -> Column:
    """The most specific access key present decides; none present allows."""
    deciding = F.coalesce(*[F.nullif(tags[k], F.lit("")) for k in ACCESS_KEYS])
    return F.coalesce(~deciding.isin("no", "private"), F.lit(True))


def is_car_ferry(tags: Column) -> Column:
    said = F.coalesce(F.nullif(tags["motor_vehicle"], F.lit("")), tags["motorcar"])
    return (tags["route"] == "ferry") & ~said.eqNullSafe("no")


def promote_tags(tags: Column) -> Column:
    """Lift a connector way to the promoted class; park the service values that imply private use."""
    kept = F.map_filter(tags, lambda k, v: ~((k == "highway") | ((k == "service") & v.isin(*INFERRED_SERVICE))))
    lifted = F.map_concat(kept, F.create_map(F.lit("highway"), F.lit(PROMOTED_CLASS)))
    service = tags["service"]
    return F.when(service.isin(*INFERRED_SERVICE),
                  F.map_concat(lifted, F.create_map(F.lit(PARKED_SERVICE_KEY), service))).otherwise(lifted)


def undo_promote(tags: Column) -> Column:
    """Put a parked service value back."""
    parked = tags[PARKED_SERVICE_KEY]
    rest = F.map_filter(tags, lambda k, v: ~k.isin(PARKED_SERVICE_KEY, "service"))
    return F.when(parked.isNull(), tags).otherwise(
        F.map_concat(rest, F.create_map(F.lit("service"), parked)))


def is_foreign_parked(tags: Column) -> Column:
    """A parked value the promotion never writes."""
    parked = tags[PARKED_SERVICE_KEY]
    return parked.isNotNull() & ~parked.isin(*INFERRED_SERVICE)


def graph_id(region: Column, local_id: Column) -> Column:
    return F.call_function("shiftleft", region.cast("bigint"), F.lit(REGION_SHIFT)).bitwiseOR(local_id)


def graph_level(gid: Column) -> Column:
    return gid.bitwiseAND(F.lit(7).cast("bigint")).cast("int")


def graph_id_text(gid: Column) -> Column:
    """``level/tile/index`` of a graph id: 3, 22 and 21 bits."""
    tile = F.call_function("shiftright", gid, F.lit(3)).bitwiseAND(F.lit((1 << 22) - 1).cast("bigint"))
    index = F.call_function("shiftright", gid, F.lit(25)).bitwiseAND(F.lit((1 << 21) - 1).cast("bigint"))
    return F.concat_ws("/", graph_level(gid), tile, index)


def verdict_is_pass(verdict: Column) -> Column:
    """Only the literal PASS passes; a missing verdict never does."""
    return verdict.eqNullSafe("PASS")


def verdict_is_unchecked(verdict: Column) -> Column:
    return F.coalesce(verdict.startswith("UNCHECKED"), F.lit(False))


def verdict_of_legacy(flag: Column) -> Column:
    return F.when(flag, "PASS").otherwise(F.when(flag.isNotNull(), "FAIL"))
