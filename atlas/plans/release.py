"""P14–P15: the release manifest and the package indexes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlas.gates.release import promotion_gate
from atlas.operators import release as ops

CARRIED_BLOCKS = ("map", "search")


def build_manifest(catalog: DataFrame, descriptions: DataFrame, previous: DataFrame) -> DataFrame:
    """Manifest rows of the countries of the catalog that have a package description.

    ``descriptions`` carry the region fields and ``carried``; a carried country keeps its published url and
    engine digest. Map and search come from the description or, failing that, from the previous manifest:
    rebuilding a graph never loses them.
    """
    old = previous.select("code", F.col("url").alias("p_url"), F.col("engine_digest").alias("p_digest"), *[F.col(b).alias(f"p_{b}") for b in CARRIED_BLOCKS])
    j = descriptions.join(catalog.select("code"), "code", "left_semi").join(old, "code", "left")
    carried = F.col("carried")
    j = (j.withColumn("url", F.when(carried, F.coalesce("p_url", "url")).otherwise(F.col("url")))
         .withColumn("engine_digest", F.when(carried, F.coalesce("p_digest", "engine_digest")).otherwise(F.col("engine_digest"))))
    for block in CARRIED_BLOCKS:
        j = j.withColumn(block, F.coalesce(block, f"p_{block}"))
    return j.drop("p_url", "p_digest", *[f"p_{b}" for b in CARRIED_BLOCKS])


def portal_blocks(regions: DataFrame, tables: DataFrame) -> DataFrame:
    """Legacy tables with both package versions: pair, versions, file, url, bytes, sha256, rows; a table
    whose country is missing is left out. ``tables(a, b, file, url, bytes, sha256, rows)``."""
    version = lambda end: regions.select(F.col("code").alias(end), F.concat_ws("-", "code", "graph_version").alias(f"v_{end}"))
    j = tables.join(version("a"), "a").join(version("b"), "b")
    return j.select(F.concat_ws("-", "a", "b").alias("pair"), F.array("v_a", "v_b").alias("versions"), "file", "url", "bytes", "sha256", "rows")


def build_package_index(index: DataFrame, graphs: DataFrame, basemaps: DataFrame, searches: DataFrame, assets: DataFrame, plans: DataFrame) -> DataFrame:
    return ops.vintage_skew(ops.promote_upsert(index, graphs, basemaps, searches, assets, plans))


def build_country_tiles_index(metas: DataFrame) -> DataFrame:
    """Countries of the builds whose gates all say PASS; a build is promoted whole or not at all.

    ``metas(build_id, country, …)``. Publishing replaces the index by the rows of one build id (see
    ``distinct_build_id``)."""
    return metas.join(promotion_gate(metas).select("build_id"), "build_id", "left_anti")

