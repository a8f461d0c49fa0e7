"""Gates over source extracts: age, admin records, time zones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_AGE_DAYS = 30
MIN_ZONES, MAX_ZONES = 250, 400

# fixed values: zone ids merged into others, with the zone they became
DEPRECATED_ZONES = {
    "Europe/Zagreb": "Europe/Belgrade", "Europe/Ljubljana": "Europe/Belgrade", "Europe/Sarajevo": "Europe/Belgrade",
    "Europe/Skopje": "Europe/Belgrade", "Europe/Podgorica": "Europe/Belgrade", "Europe/Bratislava": "Europe/Prague",
    "Europe/Busingen": "Europe/Zurich", "Europe/Vaduz": "Europe/Zurich", "Europe/San_Marino": "Europe/Rome",
    "Europe/Vatican": "Europe/Rome", "Europe/Mariehamn": "Europe/Helsinki", "Arctic/Longyearbyen": "Europe/Berlin",
    "Atlantic/Jan_Mayen": "Europe/Berlin", "America/Nassau": "America/Toronto", "Asia/Kuwait": "Asia/Riyadh",
    "Asia/Aden": "Asia/Riyadh",
}


def age_days(stamp: Column, now: Column) -> Column:
    """Whole days between two instants, rounded down."""
    return F.floor((F.unix_timestamp(now) - F.unix_timestamp(stamp)) / 86400)


def freshness_vs_published(extracts: DataFrame, published: DataFrame, now: Column, max_age: int = MAX_AGE_DAYS) -> DataFrame:
    """``extracts(code, snapshot, reason)`` against ``published(code, snapshot)``: code, age, verdict.

    FAIL: too old, or older than what is published (equal is fine). An unreadable snapshot is UNCHECKED
    with its reason.
    """
    j = extracts.join(published.select("code", F.col("snapshot").alias("before")), "code", "left")
    age = age_days(F.col("snapshot"), now)
    verdict = (F.when(F.col("snapshot").isNull(), F.concat(F.lit("UNCHECKED: "), F.coalesce("reason", F.lit("no reason given"))))
               .when((age > max_age) | F.coalesce(F.col("snapshot") < F.col("before"), F.lit(False)), "FAIL").otherwise("PASS"))
    return j.select("code", age.alias("age"), verdict.alias("verdict"))


def freshness_gate(verdicts: DataFrame) -> DataFrame:
    """One verdict for the build: FAIL beats UNCHECKED beats PASS."""
    row = verdicts.agg(F.count_if(F.col("verdict") == "FAIL").alias("failed"), F.count_if(F.col("verdict").startswith("UNCHECKED")).alias("unchecked"))
    overall = F.when(F.col("failed") > 0, "FAIL").when(F.col("unchecked") > 0, F.concat(F.lit("UNCHECKED: "), F.col("unchecked").cast("string"), F.lit(" extracts"))).otherwise("PASS")
    return row.withColumn("verdict", overall)


def dropped_admin_for_members(dropped: DataFrame, countries: DataFrame) -> DataFrame:
    """Dropped admin records that name a built country: code, name. ``countries(code, names)``."""
    known = countries.select("code", F.explode(F.array_distinct(F.transform(F.concat("names", F.array("code")), lambda n: F.lower(n)))).alias("known"))
    return dropped.join(known, F.lower("name") == F.col("known")).select("code", "name").distinct()


def admin_gate(dropped: DataFrame, countries: DataFrame) -> DataFrame:
    """Per built country: records dropped for it and the verdict."""
    ours = dropped_admin_for_members(dropped, countries).groupBy("code").agg(F.count(F.lit(1)).alias("n"))
    j = countries.select("code").join(ours, "code", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return j.withColumn("verdict", F.when(F.col("n") > 0, "FAIL").otherwise("PASS"))


def deprecated_zones(df: DataFrame) -> DataFrame:
    rows = list(DEPRECATED_ZONES.items())
    return df.sparkSession.createDataFrame(rows, "zone string, target string")


def zone_audit(zones: DataFrame, runtime: DataFrame, deprecated: DataFrame) -> DataFrame:
    """Zone ids the runtime would not accept: zone, rule. ``zones(zone)``; ``runtime(what, name)`` as parsed
    from tzdata; ``deprecated(zone)`` is the short fixed list."""
    z = zones.select("zone").distinct()
    links = runtime.filter("what = 'link'").select(F.col("name").alias("zone")).distinct()
    canon = runtime.filter("what = 'zone'").select(F.col("name").alias("zone")).distinct()
    tag = lambda df, rule: df.select("zone", F.lit(rule).alias("rule"))
    return (tag(z.join(deprecated, "zone", "left_semi"), "deprecated")
            .unionByName(tag(z.join(links, "zone", "left_semi"), "a link for this runtime"))
            .unionByName(tag(z.join(links, "zone", "left_anti").join(canon, "zone", "left_anti"), "unknown to this runtime")))


def zone_sets(zones: DataFrame, runtime: DataFrame) -> DataFrame:
    """The same as set algebra: zones ∩ links, zones − links − canonical."""
    z = zones.select("zone")
    links = runtime.filter("what = 'link'").select(F.col("name").alias("zone"))
    canon = runtime.filter("what = 'zone'").select(F.col("name").alias("zone"))
    return (z.intersect(links).withColumn("what", F.lit("link"))
            .unionByName(z.subtract(links).subtract(canon).withColumn("what", F.lit("unknown"))))


def timezone_gate(zones: DataFrame, runtime: DataFrame, deprecated: DataFrame) -> DataFrame:
    """Problem rows: rule, n; the number of zones must be plausible too."""
    audit = zone_audit(zones, runtime, deprecated).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))
    size = zones.agg(F.count_distinct("zone").alias("n")).filter(~F.col("n").between(MIN_ZONES, MAX_ZONES))
    return audit.unionByName(size.select(F.lit("implausible number of zones").alias("rule"), "n"))
