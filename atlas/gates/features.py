"""Gates of navigation features and bus lanes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlas.functions import geo
from atlas.operators import filters
from atlas.sources.strict_text import FEATURE_TYPES

ROAD_TYPES = ("level_crossing", "tram_level_crossing", "traffic_signals")
CHANGE = 0.25


def feature_row_rules(rows: DataFrame) -> DataFrame:
    """Rows of a feature file that break a rule: country, rule, n."""
    lat, lon = F.col("lat_e7"), F.col("lon_e7")
    rules = [
        F.when(~F.col("id").rlike(r"^[nr]\d+$"), F.lit("bad id")),
        F.when(~F.col("type").isin(*FEATURE_TYPES), F.lit("unknown type")),
        F.when(~(lat.between(-900_000_000, 900_000_000) & lon.between(-1_800_000_000, 1_800_000_000)), F.lit("coordinate out of range")),
        F.when(F.exists("bearing", lambda b: (b < 0) | (b >= 360)), F.lit("bearing out of range")),
        F.when((F.col("maxspeed") <= 0) | (F.col("maxspeed") > 300), F.lit("implausible maxspeed")),
        F.when(F.exists("way_ids", lambda w: ~w.rlike(r"^w\d+$")), F.lit("bad way id")),
        F.when((F.col("type") == "camera_section") & F.col("attrs")["to"].isNull(), F.lit("section without its end")),
        F.when(F.col("type").isin(*ROAD_TYPES) & (F.size("way_ids") == 0), F.lit("on no road"))]
    count = F.count(F.lit(1)).alias("n")
    single = rows.select("country", F.explode(F.array_compact(F.array(*rules))).alias("rule")).groupBy("country", "rule").agg(count)
    twice = rows.groupBy("country", "id").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").groupBy("country").agg(count)
    return single.unionByName(twice.select("country", F.lit("duplicate id").alias("rule"), "n"))


def header_counts(rows: DataFrame, declared: DataFrame) -> DataFrame:
    """Types whose rows differ from the header ``declared(country, type, n)``."""
    real = rows.groupBy("country", "type").agg(F.count(F.lit(1)).alias("real"))
    j = declared.join(real, ["country", "type"], "full").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n", "real")})
    return j.filter("n <> real").select("country", "type", "n", "real")


def feature_gate(rows: DataFrame, previous: DataFrame, boxes: DataFrame) -> DataFrame:
    """country, type, severity, rule: far outside the country, a type that vanished (HARD), a change above 25 %
    (WARN). ``previous(country, type, before)``; ``boxes(country, bbox)``, one per country (at most 255)."""
    lat, lon = geo.from_e7(F.col("lat_e7")), geo.from_e7(F.col("lon_e7"))
    far = rows.join(boxes, "country").filter(filters.outside_bbox(lat, lon, F.col("bbox")))
    outside = far.select("country", F.lit("*").alias("type"), F.lit("HARD").alias("severity"), F.lit("outside the country").alias("rule")).distinct()
    now = rows.groupBy("country", "type").agg(F.count(F.lit(1)).alias("now"))
    j = previous.filter("before > 0").join(now, ["country", "type"], "left").withColumn("now", F.coalesce("now", F.lit(0)))
    change = F.abs(F.col("now") - F.col("before")) / F.col("before")
    severity = F.when(F.col("now") == 0, "HARD").when(change > CHANGE, "WARN")
    rule = F.when(F.col("now") == 0, "vanished").otherwise("changed by more than a quarter")
    moved = j.select("country", "type", severity.alias("severity"), rule.alias("rule")).filter("severity is not null")
    return outside.unionByName(moved)


def bus_lane_gate(packages: DataFrame, rows: DataFrame, problems: DataFrame) -> DataFrame:
    """country, severity, rule. ``packages(country, file, entries, counts)`` with NULL file for a country
    without the block; ``rows(file, way_id, side)`` and ``problems(file, rule)`` as parsed."""
    missing = packages.filter("file is null").select("country", F.lit("WARN").alias("severity"), F.lit("no bus lanes in this run").alias("rule"))
    real = rows.groupBy("file").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("side") == s).alias(s) for s in ("right", "left", "both")])
    broken = problems.groupBy("file").agg(F.min("rule").alias("broken"))
    j = packages.filter("file is not null").join(real, "file", "left").join(broken, "file", "left")
    differs = F.lit(False)
    for s in ("right", "left", "both"):
        differs = differs | (F.col("counts").isNotNull() & (F.coalesce(F.col("counts")[s], F.lit(0)) != F.coalesce(s, F.lit(0))))
    rule = (F.when(F.col("broken").isNotNull(), F.col("broken")).when(F.coalesce("n", F.lit(0)) != F.col("entries"), "row count differs from the package")
            .when(differs, "counts differ from the package"))
    failed = j.select("country", F.lit("FAIL").alias("severity"), rule.alias("rule")).filter("rule is not null")
    return missing.unionByName(failed)
