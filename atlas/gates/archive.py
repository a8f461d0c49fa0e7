"""Gates of tile archives and basemaps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlas.functions import geo
from atlas.sources.archives import HEADER_BYTES

# fixed values
REQUIRED_LAYERS = ("earth", "water", "landuse", "roads", "buildings", "places", "boundaries")
COMPRESSIONS, TILE_TYPES = (1, 2), (1,)
SPEC_VERSION, MAX_ZOOM, PROBE_ZOOM = 3, 15, 10


def archive_gate(headers: DataFrame) -> DataFrame:
    """Decoded headers that break the contract: path, rule."""
    c = F.col
    short = c("header_bytes") < HEADER_BYTES
    alien = ~short & ~c("magic_ok")
    rules = [
        F.when(c("version") != SPEC_VERSION, F.lit("spec version")),
        F.when(~c("directory_compression").isin(*COMPRESSIONS), F.lit("directory compression")),
        F.when(~c("tile_compression").isin(*COMPRESSIONS), F.lit("tile compression")),
        F.when(~c("tile_type").isin(*TILE_TYPES), F.lit("tile type")),
        F.when(~((c("min_zoom") <= c("max_zoom")) & (c("max_zoom") <= MAX_ZOOM)), F.lit("zoom range")),
        F.when(~((c("west_e7") >= -1_800_000_000) & (c("west_e7") < c("east_e7")) & (c("east_e7") <= 1_800_000_000)
                 & (c("south_e7") >= -900_000_000) & (c("south_e7") < c("north_e7")) & (c("north_e7") <= 900_000_000)), F.lit("bounds"))]
    for section in ("root", "metadata", "leaves", "tiles"):
        rules.append(F.when(c(f"{section}_start") + c(f"{section}_bytes") > c("length"), F.lit(f"{section} beyond the file")))
    whole = F.array_compact(F.array(*rules))
    first = F.when(short, F.array(F.lit("too short"))).when(alien, F.array(F.lit("not a tile archive"))).otherwise(whole)
    return headers.select("path", F.explode(first).alias("rule"))


def missing_layers(archives: DataFrame) -> DataFrame:
    """Required layers an archive does not declare: archive, layer. ``archives(archive, layers)``."""
    required = F.array(*[F.lit(x) for x in REQUIRED_LAYERS])
    return archives.select("archive", F.explode(F.array_except(required, F.coalesce("layers", F.array().cast("array<string>")))).alias("layer"))


def basemap_gate(archives: DataFrame, points: DataFrame, tiles: DataFrame) -> DataFrame:
    """archive, rule: a missing layer, or no tile over a country's point. ``points(archive, name, lat, lon)``;
    ``tiles(archive, z, x, y)``."""
    layers = missing_layers(archives).select("archive", F.concat(F.lit("no layer "), "layer").alias("rule"))
    asked = points.withColumn("t", geo.web_tile(F.col("lat"), F.col("lon"), F.lit(PROBE_ZOOM)))
    asked = asked.select("archive", "name", F.lit(PROBE_ZOOM).alias("z"), "t.x", "t.y")
    bare = asked.join(tiles.filter(F.col("z") == PROBE_ZOOM).select("archive", "z", "x", "y"), ["archive", "z", "x", "y"], "left_anti")
    return layers.unionByName(bare.select("archive", F.concat(F.lit("no tile over "), "name").alias("rule")))
