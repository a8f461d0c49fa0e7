"""Telemetry: peaks, rates, trends, and the streaming peaks."""

from __future__ import annotations

from pyspark.sql import functions as F

from atlas.operators import telemetry as ops
from atlas.queries.base import query, view
from atlas.session import scratch_folder
from atlas.streaming import live_peaks

c = F.col

# a user's events are the samples of one build
view("sample", """SELECT 'b' || CAST(user_id AS STRING) AS label, event_id AS epoch, CASE WHEN event_type = 'error' THEN NULL ELSE CAST(floor(value * 1000) AS BIGINT) * 1000000 END AS mem_bytes,
    CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(floor(value * 700) AS BIGINT) * 1000000 END AS anon_bytes, CASE WHEN event_id % 5 = 0 THEN NULL ELSE 60000000 + CAST(floor(value * 100) AS BIGINT) * 1000 END AS disk_kb FROM events""")
PEAKS = """pk AS (SELECT label, count(*) AS samples, max(epoch) - min(epoch) AS span, max(mem_bytes) AS peak_memory, max(anon_bytes) AS peak_anon, max(disk_kb) * 1024 AS peak_disk,
    arg_min(disk_kb, epoch) FILTER (WHERE disk_kb IS NOT NULL) * 1024 AS disk_baseline, min(epoch) AS started FROM sample GROUP BY label),
    at AS (SELECT s.label, max(epoch) FILTER (WHERE mem_bytes = peak_memory) - any_value(started) AS memory_at, max(epoch) FILTER (WHERE anon_bytes = peak_anon) - any_value(started) AS anon_at,
      max(epoch) FILTER (WHERE disk_kb * 1024 = peak_disk) - any_value(started) AS disk_at FROM sample s JOIN pk ON pk.label = s.label GROUP BY s.label),
    peaks AS (SELECT pk.label, samples, span, peak_memory, memory_at, peak_anon, anon_at, peak_disk, disk_at, disk_baseline, peak_disk - disk_baseline AS disk_growth FROM pk JOIN at ON at.label = pk.label)""".replace("at AS (", "ats AS (").replace("JOIN at ON at.label", "JOIN ats ON ats.label")


@query("a10_peaks", f"WITH {PEAKS} SELECT * FROM peaks")
def a10(t):
    return ops.peaks(t.sample)


@query("w12_trend_at_end", """WITH r AS (SELECT label, coalesce(mem_bytes, 0) AS mem, row_number() OVER (PARTITION BY label ORDER BY epoch DESC) AS back FROM sample)
    SELECT label, max(mem) FILTER (WHERE back = 1) AS last, CASE WHEN count(*) FILTER (WHERE back BETWEEN 2 AND 6) = 0 THEN NULL
      WHEN max(mem) FILTER (WHERE back = 1) >= max(mem) FILTER (WHERE back BETWEEN 2 AND 6) THEN 'still climbing' ELSE 'settled' END AS trend FROM r GROUP BY label""")
def w12(t):
    return ops.trend_at_end(t.sample)


view("mark", "SELECT 'b' || CAST(user_id AS STRING) AS label, event_type AS stage, event_id * 7 AS epoch FROM events")
MARKS = "ms AS (SELECT label, stage, epoch AS started_epoch, lead(epoch) OVER w AS ended_epoch, lead(epoch) OVER w - epoch AS seconds FROM mark WINDOW w AS (PARTITION BY label ORDER BY epoch, stage))"


@query("w13_stage_durations", f"WITH {MARKS} SELECT * FROM ms")
def w13(t):
    return ops.stage_durations(t.mark)


view("build_row", """SELECT 'b' || CAST(c_custkey AS STRING) AS label, CASE WHEN c_custkey % 7 = 0 THEN 0 ELSE CAST(floor(abs(c_acctbal) * 1000000) AS BIGINT) END AS source_bytes, c_custkey * 13 % 5000 AS elapsed, c_custkey * 11 % 300 AS tiles,
    c_custkey * 1000 AS tile_bytes, c_custkey * 1100 AS cut_bytes, CASE WHEN c_custkey % 5 > 0 THEN c_custkey * 90000 END AS directed_edges, CASE WHEN c_custkey % 6 > 0 THEN c_custkey * 40000 END AS osm_nodes_in_routable_ways FROM customer""")


def report(t):
    stages = ops.stage_durations(t.mark).withColumn("stage", F.when(c("stage") == "view", "tiles").otherwise(c("stage")))
    b = t.build_row
    return ops.build_report(b.drop("directed_edges", "osm_nodes_in_routable_ways"), ops.peaks(t.sample), stages, b.select("label", "directed_edges", "osm_nodes_in_routable_ways"))


REPORT = f"""{PEAKS}, {MARKS}, tl AS (SELECT label, CAST(sum(seconds) AS BIGINT) AS tile_seconds FROM ms WHERE stage = 'view' GROUP BY label),
    rp AS (SELECT b.label, source_bytes, nullif(samples, 0) AS samples, nullif(peak_memory, 0) AS peak_memory, nullif(peak_anon, 0) AS peak_anon, nullif(peak_disk, 0) AS peak_disk, nullif(elapsed, 0) AS elapsed, nullif(tile_seconds, 0) AS tile_seconds,
      round_even((peak_memory - nullif(peak_anon, 0)) / 1e9, 2) AS cache_gb, round_even(nullif(disk_growth, 0) / 1e9, 2) AS disk_growth_gb, round_even(cut_bytes / nullif(tile_bytes, 0), 3) AS cut_overhead,
      round_even(tile_seconds / (nullif(source_bytes, 0) / 1e9), 0) AS tile_s_per_gb, round_even(elapsed / (nullif(source_bytes, 0) / 1e9), 0) AS total_s_per_gb, round_even(tiles / (nullif(source_bytes, 0) / 1e9), 0) AS tiles_per_gb,
      round_even(nullif(peak_memory, 0) / 1e9 / (nullif(source_bytes, 0) / 1e9), 2) AS memory_gb_per_gb, round_even(nullif(peak_memory, 0) / 1e9 / (nullif(osm_nodes_in_routable_ways, 0) / 1e6), 3) AS memory_gb_per_m_nodes,
      round_even(nullif(peak_memory, 0) / 1e9 / (nullif(directed_edges, 0) / 1e6), 3) AS memory_gb_per_m_edges, round_even(nullif(peak_anon, 0) / 1e9 / (nullif(directed_edges, 0) / 1e6), 3) AS anon_gb_per_m_edges,
      round_even(nullif(tile_seconds, 0) / (nullif(directed_edges, 0) / 1e6), 1) AS tile_s_per_m_edges
      FROM build_row b LEFT JOIN peaks ON peaks.label = b.label LEFT JOIN tl ON tl.label = b.label),
    full_rp AS (SELECT *, concat_ws(',', CASE WHEN samples IS NULL THEN 'samples' END, CASE WHEN peak_memory IS NULL THEN 'peak_memory' END, CASE WHEN peak_anon IS NULL THEN 'peak_anon' END, CASE WHEN peak_disk IS NULL THEN 'peak_disk' END,
      CASE WHEN elapsed IS NULL THEN 'elapsed' END, CASE WHEN tile_seconds IS NULL THEN 'tile_seconds' END) AS missing FROM rp)"""


@query("a11_build_report", f"WITH {REPORT} SELECT * EXCLUDE (missing) FROM full_rp")
def a11(t):
    return report(t).drop("missing", "telemetry")


@query("v15_telemetry_gate", f"WITH {REPORT} SELECT label, missing, CASE WHEN missing = '' THEN 'VALID' ELSE 'INVALID' END AS telemetry FROM full_rp")
def v15(t):
    return report(t).select("label", F.array_join("missing", ",").alias("missing"), "telemetry")


@query("p13_telemetry_report", f"WITH {REPORT} SELECT CASE WHEN missing = '' THEN 'VALID' ELSE 'INVALID' END AS telemetry, count(*) AS builds, max(peak_memory) AS peak_memory, max(tile_s_per_gb) AS tile_s_per_gb FROM full_rp GROUP BY ALL")
def p13(t):
    return report(t).groupBy("telemetry").agg(F.count(F.lit(1)).alias("builds"), F.max("peak_memory").alias("peak_memory"), F.max("tile_s_per_gb").alias("tile_s_per_gb"))


@query("st1_live_peaks", f"WITH {PEAKS} SELECT * FROM peaks")
def st1(t):
    """The samples are written as CSV files and read back as a stream, batch by batch."""
    base = scratch_folder(t.spark, "stream")
    t.sample.repartition(4, "epoch").write.option("header", True).csv(f"{base}/in")
    stream = live_peaks.read_sample_stream(t.spark, f"{base}/in", files_per_batch=2)
    running = live_peaks.start(stream, f"{base}/out", f"{base}/checkpoint", availableNow=True)
    running.awaitTermination()
    last = running.lastProgress["batchId"] if running.lastProgress else 0
    return t.spark.read.parquet(f"{base}/out/batch={last}")
