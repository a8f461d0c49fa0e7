"""P10: the country catalog from an index of extracts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlas.operators import spatial
from atlas.operators.release import MAX_REGION_ID, stable_id_assignment
from atlas.session import cut_lineage

# --- fixed values -----------------------------------------------------------------------------
AGGREGATES = ("alps", "dach", "britain-and-ireland", "united-kingdom")
ALSO = ("russia",)
CODES = {"great-britain": "GB", "ireland-and-northern-ireland": "IE", "kosovo": "XK", "azores": "XA",
         "guernsey-jersey": "XG", "isle-of-man": "IM"}
TITLES = {"GB": "Great Britain", "IE": "Ireland and Northern Ireland", "XK": "Kosovo", "XA": "Azores",
          "XG": "Guernsey and Jersey", "IM": "Isle of Man", "MK": "North Macedonia", "CZ": "Czechia",
          "BA": "Bosnia and Herzegovina", "UA": "Ukraine", "RU": "Russia"}
# ----------------------------------------------------------------------------------------------

MARGIN = 0.2


@dataclass(frozen=True)
class Catalog:
    country: DataFrame   # code, region_id, title, path, west, south, east, north
    border: DataFrame    # a, b, south, west, north, east, required, legacy
    problem: DataFrame   # subject, rule


def _lookup(key, values: dict[str, str]):
    out = F.lit(None).cast("string")
    for k, v in values.items():
        out = F.when(key == k, F.lit(v)).otherwise(out)
    return out


def build_catalog(index: DataFrame, previous: DataFrame, known_borders: DataFrame, parent: str = "europe", prefix: str = "") -> Catalog:
    """``index(gid, parent, iso array, name, url, rings)``, ``previous(code, region_id, title, path)``,
    ``known_borders(a, b, south, west, north, east)``. Known countries keep id and title; known borders stay as
    they are (legacy); new ones come from overlapping polygons and are not required."""
    child = ((F.col("parent") == parent) & ~F.col("gid").isin(*AGGREGATES)) | F.col("gid").isin(*ALSO)
    code = F.coalesce(_lookup(F.col("gid"), CODES), F.when(F.size("iso") == 1, F.get("iso", F.lit(0))))
    path = F.regexp_extract("url", "^" + prefix + r"(.+)-latest\.osm\.pbf$", 1)
    rows = cut_lineage(index.filter(child).select("gid", code.alias("code"), F.col("name"), path.alias("path"), "rings"))
    problems = (rows.filter("code is null").select(F.col("gid").alias("subject"), F.lit("no code").alias("rule"))
                .unionByName(rows.filter("path = ''").select(F.col("gid").alias("subject"), F.lit("unexpected url").alias("rule")))
                .unionByName(rows.filter("code is not null").groupBy("code").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("code").alias("subject"), F.lit("code twice").alias("rule"))))
    good = rows.filter("code is not null")
    old = previous.select("code", F.col("title").alias("old_title"), F.col("path").alias("old_path"))
    problems = problems.unionByName(old.join(good, "code", "left_anti").select(F.col("code").alias("subject"), F.lit("country lost").alias("rule")))
    problems = problems.unionByName(good.join(old, "code").filter("path <> old_path").select(F.col("code").alias("subject"), F.lit("source path changed").alias("rule")))
    ids = stable_id_assignment(previous.select(F.col("code").alias("key"), F.col("region_id").alias("id")), good.select(F.col("code").alias("key")))
    problems = problems.unionByName(ids.filter(F.col("id") > MAX_REGION_ID).select(F.col("key").alias("subject"), F.lit("region ids exhausted").alias("rule")))
    corners = good.select("code", F.explode("rings").alias("ring")).select("code", F.explode("ring").alias("v")).select("code", "v.x", "v.y")
    box = spatial.bbox_union(corners, ["code"])
    two = lambda c: F.bround(c, 2)
    title = F.coalesce("old_title", _lookup(F.col("code"), TITLES), "name")
    country = (good.drop("rings").join(old, "code", "left").join(ids.select(F.col("key").alias("code"), F.col("id").alias("region_id")), "code").join(box, "code")
               .select("code", "region_id", title.alias("title"), "path", *[two(F.col(c)).alias(c) for c in ("west", "south", "east", "north")]))
    overlap = spatial.polygon_overlap(good.select(F.col("code").alias("pid"), "rings"))
    known = known_borders.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "south", "west", "north", "east")
    here = lambda end: good.select(F.col("code").alias(end))
    kept = known.join(here("a"), "a", "left_semi").join(here("b"), "b", "left_semi")
    problems = problems.unionByName(known.join(kept, ["a", "b"], "left_anti").select(F.concat_ws("-", "a", "b").alias("subject"), F.lit("border lost").alias("rule")))
    fresh = overlap.join(kept.select("a", "b"), ["a", "b"], "left_anti").select(
        "a", "b", two(F.col("south") - MARGIN).alias("south"), two(F.col("west") - MARGIN).alias("west"), two(F.col("north") + MARGIN).alias("north"), two(F.col("east") + MARGIN).alias("east"))
    flag = lambda df, v: df.withColumn("required", F.lit(v)).withColumn("legacy", F.lit(v))
    return Catalog(country, flag(kept.select("a", "b", "south", "west", "north", "east"), True).unionByName(flag(fresh, False)), problems)
