"""Joining border nodes of independently built regions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from atlas.functions import geo, osm
from atlas.operators.grid import Grid
from atlas.session import stored as cut_lineage     # as Parquet: several steps read a few columns each

NEAR_M = 5.0


def _meet(a: DataFrame, b: DataFrame, key: list[str], borders: DataFrame | None) -> DataFrame:
    """What both sides of a pair have under one ``key``: pair, key…, the other columns of both.

    Without ``borders`` a side is named by its pair; with them one side stands in many pairs and is not repeated for each.
    """
    if borders is None:
        return a.withColumnRenamed("side", "pair").join(b.withColumnRenamed("side", "pair"), ["pair", *key])
    met = a.withColumnRenamed("side", "a_side").join(b.withColumnRenamed("side", "b_side"), key)
    return met.join(borders.select("pair", F.col("a").alias("a_side"), F.col("b").alias("b_side")), ["a_side", "b_side"]).drop("a_side", "b_side")


def _by_id(rows: DataFrame, side: str) -> DataFrame:
    """Rows of each side per (osm, level): how many, and the row when it is the only one."""
    named = rows.filter("osm is not null").repartition("osm", "level")
    return named.groupBy("side", "osm", "level").agg(
        F.count(F.lit(1)).alias(f"n_{side}"), F.min("row").alias(f"row_{side}"), F.min("local_id").alias(f"local_{side}"),
        F.min("lat_e7").alias(f"{side}_lat"), F.min("lon_e7").alias(f"{side}_lon"))


def _by_spot(rows: DataFrame, side: str, key: str = "side") -> DataFrame:
    """Rows per position of one level: how many, and their ids in one exclusive-or. Less the ids of the rows that
    were taken, it is the id of the only one left."""
    return rows.groupBy(key, "level", F.col("lat_e7").alias(f"{side}_lat"), F.col("lon_e7").alias(f"{side}_lon")).agg(
        F.count(F.lit(1)).alias(f"n_{side}"), F.bit_xor("row").alias(f"row_{side}"), F.bit_xor("local_id").alias(f"local_{side}"))


def _near_spots(a: DataFrame, b: DataFrame) -> DataFrame:
    """Positions of both sides on one level within ``NEAR_M``, equal ones included, whatever sides hold them."""
    grid = Grid(NEAR_M)
    at = lambda side: (geo.from_e7(F.col(f"{side}_lat")), geo.from_e7(F.col(f"{side}_lon")))
    left = a.select("level", "a_lat", "a_lon").distinct().withColumn("cell", grid.cell(*at("a")))
    right = b.select("level", "b_lat", "b_lon").distinct().withColumn("cell", F.explode(grid.around(*at("b"))))
    close = geo.haversine_e7(F.col("a_lat"), F.col("a_lon"), F.col("b_lat"), F.col("b_lon")) <= NEAR_M
    return left.join(right, ["level", "cell"]).filter(close).drop("cell")


def _free(met: DataFrame, taken: DataFrame, side: str) -> DataFrame:
    """``met`` with the rows of one side's positions that no id has matched; positions without any are left out."""
    spot = ["pair", "level", f"{side}_lat", f"{side}_lon"]
    used = _by_spot(taken, side, "pair").withColumnsRenamed({f"{c}_{side}": f"{c}_used" for c in ("n", "row", "local")})
    joined = met.join(used, spot, "left")
    less = lambda c: F.col(f"{c}_{side}").bitwiseXOR(F.coalesce(f"{c}_used", F.lit(0)).cast(met.schema[f"{c}_{side}"].dataType))
    free = joined.withColumns({f"n_{side}": F.col(f"n_{side}") - F.coalesce("n_used", F.lit(0)),
                               f"row_{side}": less("row"), f"local_{side}": less("local")})
    return free.drop("n_used", "row_used", "local_used").filter(F.col(f"n_{side}") > 0)


def _pairs(met: DataFrame, method: str) -> DataFrame:
    d = geo.portal_distance(F.col("a_lat"), F.col("a_lon"), F.col("b_lat"), F.col("b_lon"))
    return met.select("pair", F.col("row_a").alias("a_row"), F.col("row_b").alias("b_row"), F.lit(method).alias("method"), d.alias("distance"),
                      F.col("local_a").alias("a_local"), F.col("local_b").alias("b_local"), F.col("a_lat").alias("lat_e7"), F.col("a_lon").alias("lon_e7"))


def _near(met: DataFrame) -> DataFrame:
    """Per pair and position of side a: the candidates within ``NEAR_M`` that exact positions left (cand_b rows), and how many
    rows of side a the only one has around it (cand_a). Rows on one spot are one weighted position."""
    spot = lambda side: ["pair", "level", f"{side}_lat", f"{side}_lon"]
    by_a, by_b = Window.partitionBy(*spot("a")), Window.partitionBy(*spot("b"))
    left = (met.withColumn("a_gone", F.max(_sole_here()).over(by_a)).withColumn("b_gone", F.max(_sole_here()).over(by_b))
            .filter("not a_gone and not b_gone").withColumn("cand_a", F.sum("n_a").over(by_b)))
    only = [F.min(c).alias(c) for c in ("b_lat", "b_lon", "row_b", "local_b", "cand_a")]      # of one row where it counts
    return (left.groupBy(*spot("a")).agg(F.first("n_a").alias("n_a"), F.first("row_a").alias("row_a"), F.first("local_a").alias("local_a"),
                                         F.sum("n_b").alias("cand_b"), *only))


def _sole_here() -> Column:
    return (F.col("a_lat") == F.col("b_lat")) & (F.col("a_lon") == F.col("b_lon")) & (F.col("n_a") == 1) & (F.col("n_b") == 1)


def match_frontiers(a: DataFrame, b: DataFrame, borders: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Match two sides of many country pairs at once.

    Sides: ``pair, row, level, lat_e7, lon_e7, local_id, osm``, where row and local id are whole numbers, unique per side. With
    ``borders(pair, a, b)`` they carry ``side`` instead of the pair, and a side stands in every pair that names it. Phases:
    unique (osm, level); unique exact position of what is left; mutually only candidate within 5 m of what is then left. Rows are
    summed up per side and key before the sides of a pair meet, so no row is repeated for each of its pairs. Returns the pairs
    and one row of counts per pair.
    """
    if borders is None:
        a, b = a.withColumnRenamed("pair", "side"), b.withColumnRenamed("pair", "side")
    kept = cut_lineage(a)
    return _match(kept, kept if a is b else cut_lineage(b), borders)


def _match(a: DataFrame, b: DataFrame, borders: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """``match_frontiers`` of sides that are cheap to read more than once."""
    sole = (F.col("n_a") == 1) & (F.col("n_b") == 1)
    by_id = cut_lineage(_meet(_by_id(a, "a"), _by_id(b, "b"), ["osm", "level"], borders).withColumn("sole", sole).drop("osm", "n_b"))
    matched = by_id.filter("sole")
    taken = lambda s: matched.select("pair", "level", F.col(f"{s}_lat").alias("lat_e7"), F.col(f"{s}_lon").alias("lon_e7"),
                                     F.col(f"row_{s}").alias("row"), F.col(f"local_{s}").alias("local_id"))
    spots_a, spots_b = cut_lineage(_by_spot(a, "a")), cut_lineage(_by_spot(b, "b"))
    near = _near_spots(spots_a, spots_b).join(spots_a, ["level", "a_lat", "a_lon"])
    met = _meet(near, spots_b, ["level", "b_lat", "b_lon"], borders)
    met = cut_lineage(_free(_free(met, taken("a"), "a"), taken("b"), "b"))
    judged = cut_lineage(_near(met))
    single = (F.col("cand_b") == 1) & (F.col("cand_a") == 1)
    pairs = _pairs(matched, "osm").unionByName(_pairs(met.filter(_sole_here()), "coord")).unionByName(_pairs(judged.filter(single), "near"))
    ambiguous = by_id.filter("not sole").unionByName(judged.filter(~single), allowMissingColumns=True).select("pair", F.col("n_a").alias("ambiguous"))
    return pairs, pair_stats(side_sizes(a, "a", borders), side_sizes(b, "b", borders), pairs, ambiguous)


def side_sizes(rows: DataFrame, end: str, borders: DataFrame | None) -> DataFrame:
    """Rows of one side of each pair: pair, n."""
    sizes = rows.groupBy("side").agg(F.count(F.lit(1)).alias("n"))
    if borders is None:
        return sizes.withColumnRenamed("side", "pair")
    return sizes.join(borders.select("pair", F.col(end).alias("side")), "side").select("pair", "n")


def pair_stats(a: DataFrame, b: DataFrame, pairs: DataFrame, ambiguous: DataFrame) -> DataFrame:
    """Counts per pair: matches by method, ambiguous rows, rows left of both sides of ``(pair, n)`` rows."""
    zero = F.lit(0).cast("bigint")
    parts = [pairs.select("pair", F.col("method").alias("what"), F.lit(1).cast("bigint").alias("n")),
             ambiguous.select("pair", F.lit("ambiguous").alias("what"), F.col("ambiguous").alias("n")),
             a.select("pair", F.lit("side_a").alias("what"), "n"), b.select("pair", F.lit("side_b").alias("what"), "n")]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    total = lambda what: F.coalesce(F.sum(F.when(F.col("what") == what, F.col("n"))), zero)
    counted = rows.groupBy("pair").agg(*[total(w).alias(w) for w in ("osm", "coord", "near", "ambiguous", "side_a", "side_b")])
    matched = F.col("osm") + F.col("coord") + F.col("near")
    return counted.select("pair", "osm", "coord", "near", "ambiguous",
                          (F.col("side_a") - matched).alias("unmatched_a"),
                          (F.col("side_b") - matched).alias("unmatched_b"))


def neighbour_sides(frontier: DataFrame, borders: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Both sides and the pairs of ``borders(a, b)``, as ``match_frontiers`` takes them; a row is named by its local id, unique per side."""
    rows = frontier.select(F.col("country").alias("side"), F.col("local_id").alias("row"), "level", "lat_e7", "lon_e7", "local_id", "osm")
    return rows, rows, borders.select(F.concat_ws("-", "a", "b").alias("pair"), "a", "b")


def pair_ends(df: DataFrame) -> DataFrame:
    """``pair`` → a, b."""
    return df.withColumn("a", F.split("pair", "-")[0]).withColumn("b", F.split("pair", "-")[1])


def all_pairs(frontier: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every pair of countries through the matching rule; pairs with nothing in common are absent."""
    rows, _, _ = neighbour_sides(frontier, frontier.select(F.col("country").alias("a"), F.col("country").alias("b")))
    rows = cut_lineage(rows)
    ends = rows.select(F.col("side").alias("a")).distinct()     # 255 at most
    borders = ends.join(ends.withColumnRenamed("a", "b"), F.col("a") < F.col("b")).select(F.concat_ws("-", "a", "b").alias("pair"), "a", "b")
    pairs, stats = _match(rows, rows, borders)
    busy = stats.filter("osm + coord + near + ambiguous > 0")
    return pairs, busy


def portal_table(pairs: DataFrame, regions: DataFrame) -> DataFrame:
    """Both directions of every matched pair as graph ids with their distance."""
    r = regions.select("country", "region_id")
    out = (pair_ends(pairs).withColumnsRenamed({"a": "ca", "b": "cb"})
           .join(r.withColumnsRenamed({"country": "ca", "region_id": "ra"}), "ca")
           .join(r.withColumnsRenamed({"country": "cb", "region_id": "rb"}), "cb")
           .withColumn("ga", osm.graph_id(F.col("ra"), F.col("a_local")))
           .withColumn("gb", osm.graph_id(F.col("rb"), F.col("b_local"))))
    return both_directions(out.select(F.col("ga").alias("from_id"), F.col("gb").alias("to_id"),
                                      "distance", "lat_e7", "lon_e7"))


def both_directions(portals: DataFrame) -> DataFrame:
    rest = [c for c in portals.columns if c not in ("from_id", "to_id")]
    swapped = portals.select(F.col("to_id").alias("from_id"), F.col("from_id").alias("to_id"), *rest)
    return portals.unionByName(swapped)


def portal_line(from_id: Column, to_id: Column, distance: Column, lat_e7: Column, lon_e7: Column) -> Column:
    """``from to distance   # lat, lon``."""
    metres = F.when(distance == 0, F.lit("0")).otherwise(F.format_string("%.2f", distance))
    return F.concat(from_id.cast("string"), F.lit(" "), to_id.cast("string"), F.lit(" "), metres,
                    F.format_string("   # %.7f, %.7f", geo.from_e7(lat_e7), geo.from_e7(lon_e7)))


def frontier_extract(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Border nodes: an auto-accessible, non-shortcut edge joins them to another country.

    ``nodes(id, country, …)``; ``edges(from_id, to_id, way_id, shortcut, auto_access)``.
    """
    usable = edges.filter(F.col("auto_access") & ~F.col("shortcut"))
    ends = nodes.select(F.col("id").alias("to_id"), F.col("country").alias("to_country"))
    starts = nodes.select(F.col("id").alias("from_id"), F.col("country").alias("from_country"))
    crossing = (usable.join(starts, "from_id").join(ends, "to_id")
                .filter((F.col("from_country") != "") & (F.col("to_country") != "")
                        & (F.col("from_country") != F.col("to_country"))))
    return crossing.groupBy(F.col("from_id").alias("id"), F.col("from_country").alias("country")).agg(
        F.array_sort(F.collect_set("to_country")).alias("neighbours"),
        F.count(F.lit(1)).alias("edges"), F.min("way_id").alias("first_way"))


def frontier_osm_id(frontier: DataFrame, road_nodes: DataFrame) -> DataFrame:
    """Name border nodes: the graph's own single id, else the only road node exactly there."""
    spot = ["lat_e7", "lon_e7"]
    there = road_nodes.groupBy(*spot).agg(F.min("id").alias("_low"), F.max("id").alias("_high"))
    joined = frontier.join(there, spot, "left")
    source = (F.when(F.col("tile_osm").isNotNull(), "tile").when(F.col("_low").isNull(), "absent")
              .when(F.col("_low") == F.col("_high"), "pbf").otherwise("ambiguous"))
    value = F.when(F.col("tile_osm").isNotNull(), F.col("tile_osm")).when(F.col("_low") == F.col("_high"), F.col("_low"))
    return joined.withColumn("source", source).withColumn("osm", value).drop("_low", "_high", "tile_osm")


def frontier_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Counts of what changed between two frontiers of each country, plus the farthest move.

    Rows carry country, ``row`` (unique in the country), level, lat_e7, lon_e7, osm; (osm, level) and positions
    are unique per side and country, as the frontier gate demands.
    """
    o = old.select(*[F.col(c).alias(f"o_{c}") for c in ("country", "row", "level", "lat_e7", "lon_e7", "osm")])
    here = F.col("country") == F.col("o_country")
    by_id = new.join(o, here & (F.col("osm") == F.col("o_osm")) & (F.col("level") == F.col("o_level")))
    same = (F.col("lat_e7") == F.col("o_lat_e7")) & (F.col("lon_e7") == F.col("o_lon_e7"))
    kept = by_id.select("country", "row", "o_row", F.when(same, "retained").otherwise("moved_same_osm_id").alias("what"),
                        F.when(~same, F.round(geo.haversine_e7(F.col("o_lat_e7"), F.col("o_lon_e7"), F.col("lat_e7"), F.col("lon_e7")), 2)).alias("moved_m"))
    old_rows = lambda df: df.select(F.col("country").alias("o_country"), "o_row")
    rest_n = new.join(kept.select("country", "row"), ["country", "row"], "left_anti")
    rest_o = o.join(old_rows(kept), ["o_country", "o_row"], "left_anti")
    placed = rest_n.join(rest_o, here & (F.col("level") == F.col("o_level")) & (F.col("lat_e7") == F.col("o_lat_e7"))
                         & (F.col("lon_e7") == F.col("o_lon_e7")))
    placed = placed.select("country", "row", "o_row", F.lit("retained_by_coordinate").alias("what"), F.lit(None).cast("double").alias("moved_m"))
    seen = kept.unionByName(placed)
    none = F.lit(None).cast("double").alias("moved_m")
    added = rest_n.join(placed.select("country", "row"), ["country", "row"], "left_anti").select("country", F.lit("added").alias("what"), none)
    removed = rest_o.join(old_rows(placed), ["o_country", "o_row"], "left_anti").select(F.col("o_country").alias("country"), F.lit("removed").alias("what"), none)
    rows = seen.select("country", "what", "moved_m").unionByName(added).unionByName(removed)
    return rows.groupBy("country", "what").agg(F.count(F.lit(1)).alias("n"), F.max("moved_m").alias("farthest_m"))

