"""Graph-shaped steps: ferry connectors, coastline rings, boxes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from atlas.functions import geo, osm
from atlas.operators import filters
from atlas.session import cut_lineage, stored

MAX_CHAIN_M = 10_000.0
BOX_DEGREES = 0.025
WIDE_BOX_DEGREES = 0.07


def way_nodes(ways: DataFrame) -> DataFrame:
    """Accessible road ways as rows: way, idx, node, dir (1 forward only, -1 backward only), arterial."""
    tags = F.col("tags")
    roads = ways.filter(filters.routable(tags) & osm.access_ok(tags))
    return roads.select(F.col("id").alias("way"), F.posexplode("refs").alias("idx", "node"),
                        osm.oneway_of(tags).alias("dir"), filters.arterial(tags).alias("arterial"))


def ferry_ends(ways: DataFrame) -> DataFrame:
    """First and last node of every ferry a car may take: ferry, source (node id)."""
    car = ways.filter(osm.is_car_ferry(F.col("tags")) & (F.size("refs") > 0))
    return car.select(F.col("id").alias("ferry"), F.explode(F.array(F.element_at("refs", 1), F.element_at("refs", -1))).alias("source")).distinct()


def connector_search(steps: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """One search from all arterial ways at once: how every node gets to the network and how the network gets to it.

    ``out`` is a journey from the node along allowed directions, ``in`` one that ends at it. The level is the least number of
    ways driven; ``way`` is the first (for ``in`` the last) of them and ``next`` the node where it is left (entered), from which
    ``level - 1`` ways remain. Among equal choices the lowest way counts, on it a later place before an earlier one, and of
    several places the farthest. Nodes of arterial ways have level 0. There is one row per node and heading, however many
    sources ask; with ``sources`` the search ends when each has its answer. Entering a way at several places is summed up by
    the first and the last one, so a long way is never paired with itself. Result: node, heading, level, way, next.
    """
    state = ["node", "heading"]
    none = F.lit(None).cast("bigint")
    minor = cut_lineage(steps.filter(~F.col("arterial")).select("way", "idx", "node", "dir"))
    headings = F.explode(F.array(F.lit("out"), F.lit("in"))).alias("heading")
    found = cut_lineage(steps.filter("arterial").select("node").distinct().select("node", headings)
                        .select(*state, F.lit(0).alias("level"), none.alias("way"), none.alias("next")))
    frontier, level = found, 0
    waiting = None if sources is None else sources.select(F.col("source").alias("node")).distinct().select("node", headings)
    along = minor.select("way", F.col("idx").alias("at"), F.col("node").alias("from"), "dir")
    out = F.col("heading") == "out"
    later = F.when(out, F.col("dir") != -1).otherwise(F.col("dir") != 1) & (F.col("at") < F.col("last.idx"))
    earlier = F.when(out, F.col("dir") != 1).otherwise(F.col("dir") != -1) & (F.col("at") > F.col("first.idx"))
    step = F.when(later, F.struct("way", F.lit(0).alias("side"), F.col("last.node").alias("next"))).otherwise(
        F.struct("way", F.lit(1).alias("side"), F.col("first.node").alias("next")))
    while True:
        if waiting is not None:
            waiting = cut_lineage(waiting.join(frontier, state, "left_anti"))
        if frontier.isEmpty() or (waiting is not None and waiting.isEmpty()):
            return found
        place = F.struct("idx", "node")
        entered = frontier.select(*state).join(minor.drop("dir"), "node").groupBy("way", "heading").agg(F.min(place).alias("first"), F.max(place).alias("last"))
        level += 1
        reached = (entered.join(along, "way").filter(later | earlier).groupBy(F.col("from").alias("node"), "heading").agg(F.min(step).alias("step"))
                   .join(found, state, "left_anti").select(*state, F.lit(level).alias("level"), "step.way", "step.next"))
        frontier = cut_lineage(reached)
        found = found.unionByName(frontier)
        if level % 4 == 0:
            found = cut_lineage(found)


def chains(found: DataFrame, sources: DataFrame) -> DataFrame:
    """The ways of each source's journeys: source, heading, level, way; a source on the network has one row without a way.

    Sources walk the table of ``connector_search``, one way a round.
    """
    table = found.select(F.col("node").alias("at"), "heading", "level", "way", "next")
    here = cut_lineage(sources.select("source").distinct().join(table, F.col("source") == F.col("at")).select("source", "heading", "level", "way", "next"))
    walked = here.select("source", "heading", "level", "way")
    while True:
        going = here.filter("level > 1").select("source", "heading", F.col("next").alias("at"))
        if going.isEmpty():
            return walked
        here = cut_lineage(going.join(table, ["at", "heading"]).select("source", "heading", "level", "way", "next"))
        walked = walked.unionByName(here.select("source", "heading", "level", "way"))


def connectors(sources: DataFrame, steps: DataFrame, lengths: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Connector ways, and how each source ended.

    ``lengths(way, length)``; ``classes(way, highway)``. A source is joined both ways or one way, already on
    the network, too long (chains over 10 km together), unreached, or without a road. Returns
    (source, way, length, highway) and (source, outcome, length).
    """
    steps = stored(steps, "steps")
    path = cut_lineage(chains(connector_search(steps, sources), sources))
    minor = path.filter("way is not null").select("source", "way").distinct().join(lengths, "way", "left").join(classes, "way", "left")
    minor = cut_lineage(minor.withColumn("length", F.coalesce("length", F.lit(0.0))))
    reached = path.groupBy("source").agg(F.count_distinct("heading").alias("headings"))
    total = minor.groupBy("source").agg(F.sum("length").alias("length"))
    touched = steps.select(F.col("node").alias("source")).distinct().withColumn("touched", F.lit(True))
    ends = sources.select("source").distinct().join(reached, "source", "left").join(total, "source", "left").join(touched, "source", "left")
    outcome = (F.when(F.col("touched").isNull(), "no road").when(F.col("headings").isNull(), "unreached")
               .when(F.col("length").isNull(), "already on network").when(F.col("length") > MAX_CHAIN_M, "too long")
               .when(F.col("headings") == 2, "both ways").otherwise("one way"))
    ends = ends.select("source", outcome.alias("outcome"), "length")
    good = ends.filter(F.col("outcome").isin("both ways", "one way")).select("source")
    return minor.join(good, "source", "left_semi"), ends


def connector_summary(found: DataFrame, ends: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ways and kilometres per road class; and min / median / p95 / max chain length by sorted position."""
    ways = found.select("way", "length", "highway").distinct()
    by_class = ways.groupBy("highway").agg(F.count(F.lit(1)).alias("ways"), (F.sum("length") / 1000).alias("km"))
    kept = ends.filter(F.col("outcome").isin("both ways", "one way"))
    counts = kept.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    return by_class, sorted_positions(counts, "length", {"least": 0.0, "median": 0.5, "p95": 0.95, "most": 1.0})


def sorted_positions(counts: DataFrame, value: str, wanted: dict[str, float]) -> DataFrame:
    """Values at index ``int(n * q)`` (last at most) of the sorted rows given as (value, n): one row.

    Value counts are cut into ranges; only the sizes of the ranges meet in one task.
    """
    laid = cut_lineage(counts.repartitionByRange(value).sortWithinPartitions(value).withColumn("part", F.spark_partition_id()))
    sizes = laid.groupBy("part").agg(F.sum("n").alias("size"))
    every = Window.orderBy("part")
    sizes = sizes.select("part", (F.sum("size").over(every) - F.col("size")).alias("before"),
                         F.sum("size").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"))
    at = laid.join(F.broadcast(sizes), "part")
    upto = F.sum("n").over(Window.partitionBy("part").orderBy(value)) + F.col("before")
    placed = at.withColumn("upto", upto)
    index = lambda q: F.least(F.col("total") - 1, F.floor(F.col("total") * F.lit(q)))
    pick = lambda q: F.max(F.when((index(q) < F.col("upto")) & (index(q) >= F.col("upto") - F.col("n")), F.col(value)))
    return placed.agg(*[pick(q).alias(name) for name, q in wanted.items()])


def grid_glue(points: DataFrame, box: float = BOX_DEGREES) -> DataFrame:
    """One box per rounded grid cell, around the point with the lowest ``ord``: lat, lon, dlat, dlon."""
    cell = [F.bround(F.col("lat") / F.lit(box)).alias("gy"), F.bround(F.col("lon") / F.lit(box)).alias("gx")]
    first = points.groupBy(*cell).agg(F.min_by(F.struct("lat", "lon"), F.struct("ord", "lat", "lon")).alias("p"))
    shrink = F.greatest(F.lit(0.2), F.abs(F.cos(F.radians("p.lat"))))
    return first.select("p.lat", "p.lon", F.lit(box).alias("dlat"), (F.lit(box) / shrink).alias("dlon"))


def in_boxes(points: DataFrame, boxes: DataFrame, box: float = BOX_DEGREES) -> DataFrame:
    """Points inside some box, by an equi-join on cells of the box size."""
    b = F.lit(box)
    span = lambda a, z: F.explode(F.sequence(F.floor(a / b), F.floor(z / b)))
    tiles = (boxes.withColumn("cy", span(F.col("lat") - F.col("dlat"), F.col("lat") + F.col("dlat")))
             .withColumn("cx", span(F.col("lon") - F.col("dlon"), F.col("lon") + F.col("dlon"))).alias("t"))
    p = points.withColumn("cy", F.floor(F.col("lat") / b)).withColumn("cx", F.floor(F.col("lon") / b)).alias("p")
    hit = ((F.col("p.cy") == F.col("t.cy")) & (F.col("p.cx") == F.col("t.cx"))
           & (F.abs(F.col("p.lat") - F.col("t.lat")) <= F.col("t.dlat")) & (F.abs(F.col("p.lon") - F.col("t.lon")) <= F.col("t.dlon")))
    return p.join(tiles, hit, "left_semi").drop("cx", "cy")


def chain_rings(lines: DataFrame) -> DataFrame:
    """Coastline ways ``(way, points)`` joined end to start into closed rings, as vertex rows: pid (lowest way id), ring, ord, x, y.

    Each way points to the lowest way that starts where it ends (and is the lowest that does). Pointer doubling spreads the
    lowest id around each cycle and drops chains that run out, in log steps. A second doubling sums the points from each
    way to the end of its cycle, which numbers every point: rings are never gathered. Rings of fewer than four points are left out.

    Rounds are stored, not checkpointed: a checkpoint hands on the estimated size of its plan, which a join of a table with
    itself squares, so that after thirty rounds the estimate alone is a number of billions of digits.
    """
    ends = lines.filter(F.size("points") >= 2).select(
        "way", F.element_at("points", 1).alias("head"), F.element_at("points", -1).alias("tail"), (F.size("points") - 1).cast("bigint").alias("points"))
    closed = ends.filter(F.col("head") == F.col("tail")).select("way", F.col("way").alias("pid"), F.col("points").alias("left"))
    rest = cut_lineage(ends.filter(F.col("head") != F.col("tail")))
    after = rest.groupBy(F.col("head").alias("tail")).agg(F.min("way").alias("next"))
    succ = rest.join(after, "tail").groupBy("next").agg(F.min(F.struct("way", "points")).alias("w")).select("w.way", "next", "w.points")
    now = stored(succ.select("way", F.col("next").alias("ptr"), F.least("way", "next").alias("low")))
    while True:
        ahead = now.select(F.col("way").alias("ptr"), F.col("ptr").alias("ptr2"), F.col("low").alias("low2"))
        step = now.join(ahead, "ptr")       # an inner join drops ways whose pointer ran off an open chain
        step = stored(step.select("way", F.col("ptr2").alias("ptr"), F.least("low", "low2").alias("low"),
                                  (F.col("low2") < F.col("low")).alias("moved")))
        steady = step.filter("moved").isEmpty() and step.count() == now.count()
        now = step.drop("moved")
        if steady or now.isEmpty():
            break
    # points from each way to the end of its cycle, with the link into the lowest way cut
    cycles = now.select("way", F.col("low").alias("pid")).join(succ, "way")
    far = stored(cycles.select("way", "pid", F.when(F.col("next") != F.col("pid"), F.col("next")).alias("ptr"), F.col("points").alias("left")))
    while not far.filter("ptr is not null").isEmpty():
        ahead = far.select(F.col("way").alias("ptr"), F.col("ptr").alias("ptr2"), F.col("left").alias("left2"))
        far = stored(far.join(ahead, "ptr", "left").select(
            "way", "pid", F.col("ptr2").alias("ptr"), (F.col("left") + F.coalesce("left2", F.lit(0))).alias("left")))
    placed = far.select("way", "pid", "left").unionByName(closed)
    rings = placed.filter("way = pid").select("pid", F.col("left").alias("size")).filter("size >= 3")
    points = (placed.join(rings, "pid").join(lines.select("way", "points"), "way")
              .select("pid", (F.col("size") - F.col("left")).alias("begin"), "left", F.size("points").alias("n"), F.posexplode("points").alias("i", "p")))
    # a way's last point is the next one's first; the last way's closes the ring
    kept = points.filter((F.col("i") < F.col("n") - 1) | (F.col("left") == F.col("n") - 1))
    return kept.select("pid", F.lit(0).alias("ring"), (F.col("begin") + F.col("i")).alias("ord"), "p.x", "p.y")
