"""Resource samples and stage timings of builds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from atlas.operators.groups import dense_ids

TAIL = 6


def peak_aggregates() -> list[Column]:
    """Peaks with their time, disk baseline, span: partial aggregates, usable in batch and stream.

    A value nobody measured is NULL and stays NULL. Ties of a peak go to its latest sample.
    """
    disk = F.col("disk_kb") * 1024
    at_most = lambda v: F.max(F.when(v.isNotNull(), F.struct(v.alias("v"), F.col("epoch").alias("at"))))
    return [
        at_most(F.col("mem_bytes")).alias("mem"), at_most(F.col("anon_bytes")).alias("anon"), at_most(disk).alias("disk"),
        F.min(F.when(disk.isNotNull(), F.struct("epoch", disk.alias("v")))).alias("first_disk"),
        F.min("epoch").alias("started"), F.max("epoch").alias("ended"), F.count(F.lit(1)).alias("samples")]


def shown_peaks(agg: DataFrame, label: str) -> DataFrame:
    since = lambda c: F.col(f"{c}.at") - F.col("started")
    return agg.select(
        label, "samples", (F.col("ended") - F.col("started")).alias("span"), F.col("mem.v").alias("peak_memory"), since("mem").alias("memory_at"),
        F.col("anon.v").alias("peak_anon"), since("anon").alias("anon_at"), F.col("disk.v").alias("peak_disk"), since("disk").alias("disk_at"),
        F.col("first_disk.v").alias("disk_baseline"), (F.col("disk.v") - F.col("first_disk.v")).alias("disk_growth"))


def peaks(samples: DataFrame, label: str = "label") -> DataFrame:
    return shown_peaks(samples.groupBy(label).agg(*peak_aggregates()), label)


def trend_at_end(samples: DataFrame, label: str = "label") -> DataFrame:
    """Was memory still climbing in the last six samples? ``samples`` needs a unique epoch per label."""
    latest = F.row_number().over(Window.partitionBy(label).orderBy(F.desc("epoch")))
    tail = samples.select(label, "epoch", F.coalesce("mem_bytes", F.lit(0)).alias("mem")).withColumn("back", latest).filter(F.col("back") <= TAIL)
    t = tail.groupBy(label).agg(F.max(F.when(F.col("back") == 1, F.col("mem"))).alias("last"), F.max(F.when(F.col("back") > 1, F.col("mem"))).alias("before"))
    return t.select(label, "last", F.when(F.col("before").isNull(), F.lit(None).cast("string")).when(F.col("last") >= F.col("before"), "still climbing").otherwise("settled").alias("trend"))


def stage_durations(marks: DataFrame, label: str = "label") -> DataFrame:
    """Successive stage marks ``(label, stage, epoch)`` → seconds until the next mark; the last has none.

    Marks are numbered in one total order and each meets its successor by number, so a label with many
    marks is not sorted in one task.
    """
    numbered = dense_ids(marks.select(label, "stage", "epoch"), [F.col(label), F.col("epoch"), F.col("stage")], "n")
    following = numbered.select(label, (F.col("n") - 1).alias("n"), F.col("epoch").alias("ended_epoch"))
    joined = numbered.join(following, [label, "n"], "left")
    return joined.select(label, "stage", F.col("epoch").alias("started_epoch"), "ended_epoch", (F.col("ended_epoch") - F.col("epoch")).alias("seconds"))


def build_report(builds: DataFrame, peak: DataFrame, stages: DataFrame, counters: DataFrame, label: str = "label") -> DataFrame:
    """One row per build: sizes, peaks, rates per GB of source and per million edges.

    ``builds(label, source_bytes, elapsed, tiles, tile_bytes, cut_bytes)``; ``stages(label, stage, seconds)``;
    ``counters(label, directed_edges, osm_nodes_in_routable_ways, …)``. What was not measured is NULL.
    """
    tile = stages.filter("stage = 'tiles'").groupBy(label).agg(F.sum("seconds").alias("tile_seconds"))
    j = builds.join(peak, label, "left").join(tile, label, "left").join(counters, label, "left")
    gb = F.nullif(F.col("source_bytes"), F.lit(0)) / 1e9
    edges = F.nullif(F.col("directed_edges"), F.lit(0)) / 1e6
    nodes = F.nullif(F.col("osm_nodes_in_routable_ways"), F.lit(0)) / 1e6
    some = lambda c: F.nullif(F.col(c), F.lit(0))
    rate = lambda a, b, digits: F.bround(F.try_divide(a, b), digits)
    measured = j.select(
        label, F.col("source_bytes"), some("samples").alias("samples"), some("peak_memory").alias("peak_memory"), some("peak_anon").alias("peak_anon"),
        some("peak_disk").alias("peak_disk"), some("elapsed").alias("elapsed"), some("tile_seconds").alias("tile_seconds"),
        F.bround((F.col("peak_memory") - some("peak_anon")) / 1e9, 2).alias("cache_gb"), F.bround(some("disk_growth") / 1e9, 2).alias("disk_growth_gb"),
        rate(F.col("cut_bytes").cast("double"), F.col("tile_bytes").cast("double"), 3).alias("cut_overhead"),
        rate(F.col("tile_seconds").cast("double"), gb, 0).alias("tile_s_per_gb"), rate(F.col("elapsed").cast("double"), gb, 0).alias("total_s_per_gb"),
        rate(F.col("tiles").cast("double"), gb, 0).alias("tiles_per_gb"), rate(some("peak_memory") / 1e9, gb, 2).alias("memory_gb_per_gb"),
        rate(some("peak_memory") / 1e9, nodes, 3).alias("memory_gb_per_m_nodes"), rate(some("peak_memory") / 1e9, edges, 3).alias("memory_gb_per_m_edges"),
        rate(some("peak_anon") / 1e9, edges, 3).alias("anon_gb_per_m_edges"), rate(some("tile_seconds").cast("double"), edges, 1).alias("tile_s_per_m_edges"))
    return measured.withColumn("missing", missing_measurements()).withColumn("telemetry", F.when(F.size("missing") == 0, "VALID").otherwise("INVALID"))


MEASURED = ("samples", "peak_memory", "peak_anon", "peak_disk", "elapsed", "tile_seconds")


def missing_measurements() -> Column:
    return F.array_compact(F.array(*[F.when(F.col(m).isNull(), F.lit(m)) for m in MEASURED]))
