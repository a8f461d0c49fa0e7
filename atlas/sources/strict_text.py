"""Strict line formats: frontier, features, bus lanes, portals.

Each reader returns header values, parsed rows and problem rows; a file with a problem row is refused by
its gate, nothing is repaired.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from atlas.sources.lines import read_lines, running_total

# --- fixed values: column lines and field counts of the formats ---------------------------------
FRONTIER_COLUMNS = "level lat_e7 lon_e7 local_id osm_node_id"
FEATURE_COLUMNS = "id type lat_e7 lon_e7 bearing maxspeed way_ids attrs"
FEATURE_TYPES = ("camera_speed", "camera_red_light", "camera_section", "level_crossing",
                 "tram_level_crossing", "traffic_signals")
BUS_LANE_SIDES = ("right", "left", "both")
# ----------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Parsed:
    header: DataFrame    # file, k, v
    rows: DataFrame      # file, block, at, …
    problems: DataFrame  # file, rule


def _optional(field: Column) -> Column:
    return F.nullif(field, F.lit("-"))


def _sectioned(lines: DataFrame, columns: str) -> DataFrame:
    """Lines with how many column lines came before them."""
    return running_total(lines, F.col("value") == columns, "seen")


def _headed(lines: DataFrame, kind: str, columns: str, required: tuple[str, ...], fields: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Split into header pairs and data lines, with the problems both share."""
    at = F.struct("block", "at")
    placed = _sectioned(lines, columns)
    start = F.min_by("value", at)
    files = placed.groupBy("file").agg(start.alias("first"), F.max("seen").alias("most"),
                                       F.max((F.col("value") == columns).cast("int")).alias("has"))
    first = placed.groupBy("file").agg(F.min(at).alias("first_at"))
    head = (placed.filter((F.col("seen") == 0) & (F.col("value") != columns)).join(first, "file")
            .filter(at != F.col("first_at")).drop("first_at"))
    pair = F.split("value", " ", 2)
    header = head.select("file", pair[0].alias("k"), F.try_element_at(pair, F.lit(2)).alias("v"))
    data = placed.filter("seen > 0").drop("seen").withColumn("f", F.split("value", " "))
    named = header.groupBy("file").agg(F.collect_set("k").alias("ks"))
    said = header.filter("k = 'entries'").groupBy("file").agg(F.max(F.col("v").try_cast("bigint")).alias("said"))
    counted = data.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    audit = files.join(named, "file", "left").join(said, "file", "left").join(counted, "file", "left")
    audit = audit.withColumn("n", F.coalesce("n", F.lit(0)))
    missing = [F.when(F.col("ks").isNull() | ~F.array_contains("ks", k), F.lit(f"header has no {k}")) for k in required]
    rules = F.array_compact(F.array(
        F.when(~F.col("first").rlike(rf"^[a-z]+-{kind} 1$"), F.lit("wrong format line")),
        F.when(F.col("has") == 0, F.lit("no column line")), *missing,
        F.when(F.col("said") != F.col("n"), F.lit("entries differ from the header"))))
    problems = audit.select("file", F.explode(rules).alias("rule"))
    problems = problems.unionByName(header.filter("v is null or v = ''").select("file", F.lit("malformed header line").alias("rule")))
    problems = problems.unionByName(data.filter(F.size("f") != fields).select("file", F.lit("wrong number of fields").alias("rule")))
    return header, data.filter(F.size("f") == fields), problems


def parse_frontier(lines: DataFrame) -> Parsed:
    header, data, problems = _headed(lines, "frontier", FRONTIER_COLUMNS, ("country", "graph_version", "entries"), 5)
    f = lambda i: F.get("f", F.lit(i))
    rows = data.select("file", "block", "at", f(0).try_cast("int").alias("level"), f(1).try_cast("int").alias("lat_e7"),
                       f(2).try_cast("int").alias("lon_e7"), f(3).try_cast("bigint").alias("local_id"),
                       _optional(f(4)).try_cast("bigint").alias("osm"), (f(4) == "-").alias("unnamed"))
    broken = F.col("level").isNull() | F.col("lat_e7").isNull() | F.col("lon_e7").isNull() | F.col("local_id").isNull() | (F.col("osm").isNull() & ~F.col("unnamed"))
    problems = problems.unionByName(rows.filter(broken).select("file", F.lit("not numeric").alias("rule")))
    return Parsed(header, rows.filter(~broken).drop("unnamed"), problems)


def parse_features(lines: DataFrame) -> Parsed:
    header, data, problems = _headed(lines, "features", FEATURE_COLUMNS, ("country", "graph_version", "source", "entries", "counts"), 8)
    f = lambda i: F.get("f", F.lit(i))
    empty = lambda kind: F.array().cast(f"array<{kind}>")
    parts = lambda x, sep: F.when(x == "-", empty("string")).otherwise(F.split(x, sep))
    rows = data.select(
        "file", "block", "at", f(0).alias("id"), f(1).alias("type"), f(2).try_cast("int").alias("lat_e7"), f(3).try_cast("int").alias("lon_e7"),
        F.transform(parts(f(4), ";"), lambda b: b.try_cast("int")).alias("bearing"), _optional(f(5)).try_cast("int").alias("maxspeed"),
        ((f(5) != "-") & f(5).try_cast("int").isNull()).alias("bad_speed"), parts(f(6), ",").alias("way_ids"),
        F.when(f(7) == "-", F.create_map().cast("map<string,string>")).otherwise(F.str_to_map(f(7), F.lit(";"), F.lit("="))).alias("attrs"))
    broken = F.col("lat_e7").isNull() | F.col("lon_e7").isNull() | F.col("bad_speed") | F.exists("bearing", lambda b: b.isNull())
    problems = problems.unionByName(rows.filter(broken).select("file", F.lit("not numeric").alias("rule")))
    return Parsed(header, rows.filter(~broken).drop("bad_speed"), problems)


def parse_bus_lanes(lines: DataFrame) -> Parsed:
    first = lines.groupBy("file").agg(F.min_by("value", F.struct("block", "at")).alias("first"), F.min(F.struct("block", "at")).alias("first_at"))
    body = lines.join(first.select("file", "first_at"), "file").filter(F.struct("block", "at") != F.col("first_at"))
    parsed = body.select("file", "block", "at", F.regexp_extract("value", r"^w(\d+) (\S+)$", 1).try_cast("bigint").alias("way_id"),
                         F.regexp_extract("value", r"^w(\d+) (\S+)$", 2).alias("side"))
    shape = first.filter(~F.col("first").rlike(r"^[a-z]+-buslanes 1$")).select("file", F.lit("wrong format line").alias("rule"))
    problems = (shape.unionByName(parsed.filter("way_id is null").select("file", F.lit("not 'w<id> <side>'").alias("rule")))
                .unionByName(parsed.filter(F.col("way_id").isNotNull() & ~F.col("side").isin(*BUS_LANE_SIDES)).select("file", F.lit("unknown side").alias("rule")))
                .unionByName(parsed.filter("way_id is not null").groupBy("file", "way_id").count().filter("count > 1").select("file", F.lit("duplicate way").alias("rule"))))
    header = first.select("file", F.lit("format").alias("k"), F.col("first").alias("v"))
    return Parsed(header, parsed.filter(F.col("way_id").isNotNull() & F.col("side").isin(*BUS_LANE_SIDES)), problems)


def parse_portals(lines: DataFrame) -> DataFrame:
    """``from to distance  # lat, lon``; blank lines and pure comments are left out."""
    pattern = r"^(\d+) (\d+) (\S+)\s+# (\S+), (\S+)$"
    g = lambda i: F.regexp_extract("value", pattern, i)
    kept = lines.filter((F.trim("value") != "") & ~F.col("value").startswith("#"))
    return kept.select("file", g(1).try_cast("bigint").alias("from_id"), g(2).try_cast("bigint").alias("to_id"),
                       g(3).try_cast("double").alias("distance"), g(4).try_cast("double").alias("lat"), g(5).try_cast("double").alias("lon"))


def read_frontier(spark: SparkSession, path: str) -> Parsed:
    return parse_frontier(read_lines(spark, path))


def read_features(spark: SparkSession, path: str) -> Parsed:
    return parse_features(read_lines(spark, path))


def read_bus_lanes(spark: SparkSession, path: str) -> Parsed:
    return parse_bus_lanes(read_lines(spark, path))


def read_portals(spark: SparkSession, path: str) -> DataFrame:
    return parse_portals(read_lines(spark, path))
