"""Gates of border nodes and of the portals between countries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlas.functions import osm
from atlas.operators.matching import pair_ends
from atlas.sources.lines import previous_line

LOCAL_MASK = (1 << osm.REGION_SHIFT) - 1
ORDER = ("level", "lat_e7", "lon_e7", "local_id")


def frontier_row_rules() -> list:
    local = F.col("local_id")
    foreign = (local < 0) | (local > F.lit(LOCAL_MASK))
    inside = F.col("lat_e7").between(-900_000_000, 900_000_000) & F.col("lon_e7").between(-1_800_000_000, 1_800_000_000)
    return [F.when(~F.col("level").isin(0, 1, 2), F.lit("impossible level")),
            F.when(foreign, F.lit("local id carries region bits")),
            F.when(~foreign & (osm.graph_level(local) != F.col("level")), F.lit("local id of another level")),
            F.when(~inside, F.lit("coordinate out of range"))]


def frontier_gate(rows: DataFrame, countries: DataFrame, ordered: bool = False) -> DataFrame:
    """Problem rows: country, rule, n. ``rows`` carry country and the frontier columns; ``countries(country,
    may_be_empty)`` says who has to have some. With ``ordered`` the rows also carry (file, block, at) and
    must be in canonical order."""
    count = F.count(F.lit(1)).alias("n")
    single = rows.select("country", F.explode(F.array_compact(F.array(*frontier_row_rules()))).alias("rule")).groupBy("country", "rule").agg(count)
    collide = lambda df, key, rule: (df.groupBy("country", *key).agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
                                     .groupBy("country").agg(count).select("country", F.lit(rule).alias("rule"), "n"))
    spots = collide(rows, ["level", "lat_e7", "lon_e7"], "two nodes on one spot")
    ids = collide(rows.filter("osm is not null"), ["osm", "level"], "one OSM node twice on a level")
    empty = (countries.filter("not may_be_empty").join(rows.select("country"), "country", "left_anti")
             .select("country", F.lit("empty frontier").alias("rule"), F.lit(1).cast("bigint").alias("n")))
    out = single.unionByName(spots).unionByName(ids).unionByName(empty)
    if ordered:
        key = F.struct(*ORDER)
        late = previous_line(rows, key, "before").filter(F.col("before") > key)
        out = out.unionByName(late.groupBy("country").agg(count).select("country", F.lit("not in canonical order").alias("rule"), "n"))
    return out


def portal_gate(stats: DataFrame, borders: DataFrame, present: DataFrame) -> DataFrame:
    """Ambiguous pairs, and borders whose two countries are present without any portal: a, b, severity, rule.

    ``stats`` as from the matching of all pairs; ``borders(a, b, required)`` with a < b.
    """
    busy = pair_ends(stats).select("a", "b", "ambiguous")
    unclear = busy.filter("ambiguous > 0").select("a", "b", F.lit("FAIL").alias("severity"), F.lit("ambiguous entries").alias("rule"))
    here = lambda end: present.select(F.col("country").alias(end))
    bare = borders.join(here("a"), "a", "left_semi").join(here("b"), "b", "left_semi").join(busy.select("a", "b"), ["a", "b"], "left_anti")
    severity = F.when(F.col("required"), "FAIL").otherwise("NOTE")
    return unclear.unionByName(bare.select("a", "b", severity.alias("severity"), F.lit("no portal").alias("rule")))
