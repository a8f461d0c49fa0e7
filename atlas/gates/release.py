"""Gates before something is published."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlas.functions import osm, text
from atlas.operators import release as ops

BLOCKING = ("timezone", "admins", "freshness")


def catalog_gate(catalog: DataFrame, previous: DataFrame, borders: DataFrame, old_borders: DataFrame) -> DataFrame:
    """Problem rows: subject, rule. ``catalog(code, region_id, path)``; borders as (a, b)."""
    twice = lambda df, key, rule: df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col(key).cast("string").alias("subject"), F.lit(rule).alias("rule"))
    ranged = catalog.filter(~F.col("region_id").between(1, ops.MAX_REGION_ID)).select(F.col("code").alias("subject"), F.lit("region id out of range").alias("rule"))
    old = previous.select("code", F.col("region_id").alias("old_id"), F.col("path").alias("old_path"))
    lost = previous.select("code").join(catalog, "code", "left_anti").select(F.col("code").alias("subject"), F.lit("country lost").alias("rule"))
    changed = catalog.join(old, "code")
    ids = changed.filter("region_id <> old_id").select(F.col("code").alias("subject"), F.lit("region id changed").alias("rule"))
    paths = changed.filter("path <> old_path").select(F.col("code").alias("subject"), F.lit("source path changed").alias("rule"))
    sorted_pair = lambda df: df.select(F.concat_ws("-", F.least("a", "b"), F.greatest("a", "b")).alias("subject")).distinct()
    gone = sorted_pair(old_borders).subtract(sorted_pair(borders)).select("subject", F.lit("border lost").alias("rule"))
    return (twice(catalog, "code", "code twice").unionByName(twice(catalog, "region_id", "region id twice"))
            .unionByName(ranged).unionByName(lost).unionByName(ids).unionByName(paths).unionByName(gone))


def promotion_gate(metas: DataFrame) -> DataFrame:
    """Verdicts that keep a build from being promoted: build_id, gate, said (distinct texts).

    ``metas(build_id, timezone, admins, freshness)``; only the literal PASS passes.
    """
    rows = metas.unpivot(["build_id"], list(BLOCKING), "gate", "verdict").filter(~osm.verdict_is_pass(F.col("verdict")))
    return rows.select("build_id", "gate", F.coalesce("verdict", F.lit("(no verdict recorded)")).alias("said")).distinct()


def source_gate(regions: DataFrame, previous: DataFrame, built: DataFrame) -> DataFrame:
    """Foreign sources and lost blocks in one list: code, what, problem."""
    lost = ops.carry_losses(regions, previous, built).select("code", F.col("block").alias("what"), F.lit("lost on carry").alias("problem"))
    return ops.source_identity(regions, built).unionByName(lost)


REQUIRED = ("region_id", "graph_version", "package", "url", "bytes", "sha256")


def manifest_gate(regions: DataFrame, portals: DataFrame, listing: DataFrame, tag: str, provenance: bool = True) -> DataFrame:
    """Problem rows of a manifest: subject, rule.

    Fields, id range, sums of parts, files against the listing, table versions against package versions, unique
    table names, provenance.
    """
    rules = [F.when(F.col(c).isNull(), F.lit(f"no {c}")) for c in REQUIRED]
    rules.append(F.when(~F.col("region_id").between(1, ops.MAX_REGION_ID), F.lit("region id out of range")))
    parts = F.aggregate(F.transform("parts", lambda p: p["bytes"]), F.lit(0).cast("bigint"), lambda a, b: a + b)
    rules.append(F.when((F.size("parts") > 0) & (parts != F.col("bytes")), F.lit("parts do not add up")))
    if provenance:
        said = {"source md5": "source.md5", "source sha256": "source.sha256", "replication": "source.replication",
                "engine sha": "engine_sha", "engine digest": "engine_digest", "time zones": "timezones.sha256"}
        rules += [F.when(F.coalesce(F.col(c), F.lit("")) == "", F.lit(f"no {n}")) for n, c in said.items()]
    fields = regions.select(F.col("code").alias("subject"), F.explode(F.array_compact(F.array(*rules))).alias("rule"))
    files = ops.release_assets(ops.exploded_assets(regions), tag)
    tables = portals.select(F.col("file").alias("name"), "bytes", "sha256")
    wanted = files.select("name", "bytes", "sha256").unionByName(tables)
    broken = ops.asset_reconcile(wanted, listing).filter(F.col("verdict").isin("missing", "mismatch")).select(F.col("name").alias("subject"), F.concat(F.lit("file "), "verdict").alias("rule"))
    ends = portals.withColumn("a", F.split("pair", "-")[0]).withColumn("b", F.split("pair", "-")[1])
    version = lambda end: regions.select(F.col("code").alias(end), F.concat_ws("-", "code", "graph_version").alias(f"v_{end}"))
    j = ends.join(version("a"), "a", "left").join(version("b"), "b", "left")
    stale = j.filter(~F.col("versions").eqNullSafe(F.array("v_a", "v_b"))).select(F.col("pair").alias("subject"), F.lit("table of other versions").alias("rule"))
    foreign = portals.filter(text.tag_of(F.col("url")) != tag).select(F.col("pair").alias("subject"), F.lit("table of another release").alias("rule"))
    twice = portals.groupBy("file").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("file").alias("subject"), F.lit("table name twice").alias("rule"))
    return fields.unionByName(broken).unionByName(stale).unionByName(foreign).unionByName(twice)


def rebuild_consistency(decision: DataFrame, published: DataFrame, catalog: DataFrame, forced: DataFrame) -> DataFrame:
    """Carried codes that were never published, forced codes outside the set: code, problem."""
    lost = decision.filter("not rebuild").select("code").join(published.select("code"), "code", "left_anti").select("code", F.lit("cannot carry: never published").alias("problem"))
    outside = forced.select("code").distinct().join(catalog.select("code"), "code", "left_anti").select("code", F.lit("outside the set").alias("problem"))
    return lost.unionByName(outside)


def absent_gate(absent: DataFrame, published: DataFrame) -> DataFrame:
    """A country that was published may be carried but never absent: code."""
    return absent.select("code").join(published.select("code"), "code", "left_semi")
