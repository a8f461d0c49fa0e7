"""Grouped selections that stay distributed when one group holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from atlas.operators.grid import Grid
from atlas.session import Scratch, cut_lineage

BUCKET_BITS = 16
BLOCK_CELLS, BORDER_CELLS = 64, 5   # of greedy_thin: a cell asks up to four cells away, two for each question


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column], cols: Sequence[str]) -> DataFrame:
    """The first row of each group under a total order; partial aggregation, no window sort."""
    best = F.min_by(F.struct(*cols), F.struct(*order)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in cols])


def most_frequent(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Most frequent value of each group, ties by the lowest value."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(*keys).agg(F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(value))


def upper_median(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Element ``n // 2`` of the sorted values of each group (exact), for 32-bit integers.

    Values are counted first, then located through a histogram of their high bits, so no group is
    ever sorted whole: both windows below see at most 65 536 rows of one group.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_b", F.call_function("shiftright", F.col(value).cast("bigint"), F.lit(BUCKET_BITS)))
    by_key = Window.partitionBy(*keys)
    buckets = counts.groupBy(*keys, "_b").agg(F.sum("_n").alias("_bn"))
    buckets = (buckets
               .withColumn("_upto", F.sum("_bn").over(by_key.orderBy("_b")))
               .withColumn("_rank", F.floor(F.sum("_bn").over(by_key) / 2))
               .filter((F.col("_rank") < F.col("_upto")) & (F.col("_rank") >= F.col("_upto") - F.col("_bn")))
               .select(*keys, "_b", (F.col("_rank") - F.col("_upto") + F.col("_bn")).alias("_rest")))
    inner = counts.join(buckets, [*keys, "_b"])
    inner = inner.withColumn("_upto", F.sum("_n").over(by_key.orderBy(value)))
    return (inner.filter((F.col("_rest") < F.col("_upto")) & (F.col("_rest") >= F.col("_upto") - F.col("_n")))
            .select(*keys, value))


def dense_ids(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Ids 1..n along a total order, without gathering the rows in one task.

    Rows are range-partitioned and sorted, that layout is materialised once, and each partition adds
    the size of those before it (one row per partition).
    """
    slot = F.monotonically_increasing_id()
    laid = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_slot", slot))
    part = F.call_function("shiftright", F.col("_slot"), F.lit(33))
    within = F.col("_slot").bitwiseAND(F.lit((1 << 33) - 1))
    laid = laid.withColumn("_part", part)
    sizes = laid.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    return (laid.join(F.broadcast(starts), "_part")
            .withColumn(name, (F.col("_start") + within + 1).cast("bigint"))
            .drop("_slot", "_part", "_start"))


def greedy_thin(df: DataFrame, keys: Sequence[str], order: Sequence[str], radius_m: float,
                near: Callable[[Column, Column, Column, Column], Column], ties: Sequence[str] = ()) -> DataFrame:
    """Walk each group in ``order`` (then position) and keep a row unless an already kept one is ``near``.

    ``near(lat, lon, lat, lon)`` must imply a distance of at most ``radius_m``. Rows equal in keys, order and position
    are one row, the least; the columns ``ties`` only tell which that is and are not returned. The walk is decided in rounds over cells: a row that comes first among all undecided rows
    around it is kept, every row near a kept one is dropped, and the rest goes on. A row is only dropped by one
    before it, as in the walk, so the answer is the walk's for groups of any size. Rows without a position are near none.
    """
    keys, order = list(keys), list(order)
    place = [*order, "lat", "lon"]
    rest = [c for c in df.columns if c not in keys and c not in place]
    grid = Grid(radius_m)
    cell = [*keys, "_cell"]
    steps = Scratch(df.sparkSession, "thin")
    row = F.struct(*[F.col(c) for c in (*place, *rest)]).alias("_row")
    rows = df.withColumn("_cell", grid.cell(F.col("lat"), F.col("lon"))).groupBy(*cell, *place).agg(F.min(row).alias("_row"))
    rows = rows.select(*cell, F.struct(*[F.col(f"_row.{c}").alias(c) for c in (*place, *rest) if c not in ties]).alias("_row"))
    lone = rows.filter("_cell is null").select(*keys, F.col("_row").alias("_first"))
    undecided = steps.keep(rows.filter("_cell is not null"), "undecided-0")
    kept, n = lone, 0
    while not undecided.isEmpty():
        judged = steps.keep(_judged(undecided, keys, place, grid, Grid(radius_m * BLOCK_CELLS)), f"judged-{n}")
        kept = kept.unionByName(judged.filter("_wins").select(*keys, "_first"))
        undecided = steps.keep(_undecided(undecided, judged, keys, near), f"undecided-{n + 1}")
        steps.drop(f"undecided-{n}")
        n += 1
    kept = steps.keep(kept, "kept")
    steps.drop(*[f"judged-{i}" for i in range(n)], f"undecided-{n}")
    return kept.select(*[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns if c not in ties])


def _judged(undecided: DataFrame, keys: list[str], place: list[str], grid: Grid, blocks: Grid) -> DataFrame:
    """Each cell of a group with its first row, how many rows it has, whether the first wins and the winners around (at most nine).

    A cell asks its eight neighbours twice. So that not every row travels nine times for it, rows go to their block
    of many cells, and to the next ones where they lie at its border, and the questions stay inside a block. The only
    cell of a group in a block has none to ask.
    """
    first = undecided.groupBy(*keys, "_cell").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    lat, lon = F.col("_first.lat"), F.col("_first.lon")
    home = blocks.cell(lat, lon)
    laid = first.select(*keys, "_cell", "_first", "_n", home.alias("_home"),
                        F.explode(F.array_distinct(F.array(home, *[blocks.cell(y, x) for y, x in grid.corners(lat, lon, BORDER_CELLS)]))).alias("_block"))
    laid = laid.repartition(*keys, "_block").withColumn("_alone", F.count(F.lit(1)).over(Window.partitionBy(*keys, "_block")) == 1)
    spot = F.struct(*[F.col(f"_first.{c}").alias(c) for c in place])
    at = [*keys, "_block", "_near"]
    asked = laid.withColumn("_spot", spot).withColumn("_near", F.explode(F.when(F.col("_alone"), F.array("_cell")).otherwise(grid.around(lat, lon))))
    own = F.when(F.col("_near") == F.col("_cell"), F.struct("_first", "_n", "_home", "_spot", "_alone"))
    found = asked.groupBy(*at).agg(F.min("_spot").alias("_least"), F.min(own).alias("_own")).filter("_own is not null")
    found = found.select(*keys, "_block", F.col("_near").alias("_cell"), "_own._first", "_own._n", "_own._home", "_own._spot", "_own._alone", (F.col("_own._spot") == F.col("_least")).alias("_wins"))
    told = found.withColumn("_near", F.explode(F.when(F.col("_wins") & ~F.col("_alone"), grid.around(lat, lon)).otherwise(F.array("_cell"))))
    own = F.when(F.col("_near") == F.col("_cell"), F.struct("_first", "_n", "_home", "_wins"))
    winner = F.when(F.col("_wins"), F.struct("_spot.lat", "_spot.lon"))
    told = told.groupBy(*at).agg(F.min(own).alias("_own"), F.collect_list(winner).alias("_won"))
    return (told.filter(F.col("_own._home") == F.col("_block"))
            .select(*keys, F.col("_near").alias("_cell"), "_own._first", "_own._n", "_own._wins", "_won"))


def _undecided(undecided: DataFrame, judged: DataFrame, keys: list[str], near: Callable) -> DataFrame:
    """Rows that neither won nor are near a winner. The only row of its cell is judged as it is; the others are looked up."""
    def open_rows(rows: DataFrame, row: Column) -> DataFrame:
        covered = F.exists("_won", lambda z: F.coalesce(near(row["lat"], row["lon"], z["lat"], z["lon"]), F.lit(False)))
        return rows.filter(~((F.col("_wins") & (row == F.col("_first"))) | covered)).select(*keys, "_cell", row.alias("_row"))

    crowded = _same(undecided, judged.filter("_n > 1"), [*keys, "_cell"], "inner", None)
    crowded = crowded.select("u.*", "z._first", "z._wins", "z._won")
    return open_rows(judged.filter("_n = 1"), F.col("_first")).unionByName(open_rows(crowded, F.col("_row")))


def _same(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str, condition: Column | None) -> DataFrame:
    """Join ``left`` as u with ``right`` as z where ``cols`` are equal, nulls included."""
    for c in cols:
        equal = F.col(f"u.{c}").eqNullSafe(F.col(f"z.{c}"))
        condition = equal if condition is None else equal & condition
    return left.alias("u").join(right.alias("z"), condition, how)


def nearest_within(points: DataFrame, sites: DataFrame, keys: Sequence[str], rings_km: Sequence[float],
                   distance_km: Callable, strict: bool = True,
                   tie: Sequence[str] = ("site",), allowed: Callable | None = None) -> DataFrame:
    """Nearest site of each point: ``point`` → columns ``site``, ``km`` (NULL when there is none).

    ``points(point, lat, lon, keys…)`` must have one row per point; ``sites(site, lat, lon, keys…,
    tie…)``. Searches run from the smallest ring outwards and only points without an answer go on,
    so in a dense place a point meets the sites of its nearest ring alone. Sites on one spot are
    reduced to the best of them first. ``allowed(km, point_row, site_row)`` can refuse a pair.
    """
    keys, tie = list(keys), list(tie)
    extra_p = [c for c in points.columns if c not in ("point", "lat", "lon", *keys)]
    spot = (sites.groupBy(*keys, "lat", "lon", *[c for c in sites.columns if c.startswith("side_")])
            .agg(F.min(F.struct(*tie, *(["site"] if "site" not in tie else []))).alias("_s")))
    rest, answers = points, None
    for i, ring in enumerate(rings_km):
        grid = Grid(ring * 1000.0)
        p = rest.withColumn("_cell", grid.cell(F.col("lat"), F.col("lon"))).alias("p")
        s = spot.withColumn("_cell", F.explode(grid.around(F.col("lat"), F.col("lon")))).alias("s")
        d = distance_km(F.col("p.lat"), F.col("p.lon"), F.col("s.lat"), F.col("s.lon"))
        last = i == len(rings_km) - 1
        close = d < F.lit(float(ring)) if strict or not last else d <= F.lit(float(ring))
        condition = (F.col("p._cell") == F.col("s._cell")) & close
        for k in keys:
            condition = (F.col(f"p.{k}") == F.col(f"s.{k}")) & condition
        if allowed is not None:
            condition = condition & allowed(d, "p", "s")
        hits = (p.join(s, condition).select(F.col("p.point"), F.struct(d.alias("km"), F.col("s._s")).alias("_hit"))
                .groupBy("point").agg(F.min("_hit").alias("_hit"))
                .select("point", F.col("_hit._s.site").alias("site"), F.col("_hit.km").alias("km")))
        seen = rest.join(hits, "point", "left")
        if not last:
            seen = cut_lineage(seen)
            rest = seen.filter(F.col("site").isNull()).select("point", "lat", "lon", *keys, *extra_p)
            seen = seen.filter(F.col("site").isNotNull())
        found = seen.select("point", "site", "km")
        answers = found if answers is None else answers.unionByName(found)
    return answers
