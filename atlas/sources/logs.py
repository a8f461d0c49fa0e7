"""Telemetry CSV and build logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlas.sources.lines import first_match, read_lines, read_packed_lines

# --- fixed values: line patterns of the tools whose output is read ------------------------------
BUILD_COUNTERS = {
    "routable_ways": r"Finished with (\d+) routable ways",
    "osm_nodes_in_routable_ways": r"Finished with (\d+) nodes contained in routable ways",
    "graph_edges": r"Finished with (\d+) graph edges",
    "directed_edges": r"Directed Edge Count = (\d+)",
    "tiles_built": r"Building (\d+) tiles with",
}
DROPPED_ADMIN = r"NOT NULL constraint failed: admin_access\.admin_id\..*?name change for (.+?)\s*$"
REPORT_LINES = {
    "struct": {
        r"^connector ways (\d+), found in baseline (\d+), in new (\d+)$":
            ("connector_ways", "found_in_baseline", "found_in_new"),
        (r"^destonly True->False: inferred service (\d+); explicit access in ferry reclassification (\d+); "
         r"explicit access OUTSIDE it (\d+); other (\d+); False->True (\d+)$"):
            ("lost_inferred_service", "lost_in_ferry_reclassification", "lost_outside_reclassification", "lost_other", "gained"),
        r"^explicit access outside ferry reclassification kept destonly: (\d+) of (\d+)$":
            ("explicit_access_kept", "explicit_access_total"),
    },
    "transit": {
        r"^pairs (\d+), land-only (\d+), new transits through lifted destonly: (\d+)$":
            ("pairs", "land_only", "new_transits"),
    },
    "routes": {
        r"^TOTAL PASS (\d+), KNOWN (\d+), ACCEPTED (\d+), FAIL (\d+)$": ("pass", "known", "accepted", "fail"),
    },
}
# ----------------------------------------------------------------------------------------------


def parse_headed_csv(lines: DataFrame, first_column: str, columns: dict[str, str]) -> DataFrame:
    """CSV lines whose columns are found by name per file; a missing column or empty value is NULL."""
    body = lines.filter(~F.col("value").startswith("#") & (F.trim("value") != ""))
    is_head = F.col("value").startswith(first_column + ",")
    heads = body.filter(is_head).groupBy("file").agg(F.min_by("value", F.struct("block", "at")).alias("_h"))
    rows = body.filter(~is_head).join(heads, "file").withColumn("_v", F.split("value", ",")).withColumn("_n", F.split("_h", ","))
    def field(name: str, kind: str):
        place = F.array_position("_n", name)
        raw = F.when(place > 0, F.try_element_at("_v", place.cast("int")))
        return F.nullif(F.trim(raw), F.lit("")).try_cast(kind).alias(name)
    return rows.select("file", "block", "at", *[field(n, k) for n, k in columns.items()])


SAMPLE_COLUMNS = {"epoch": "bigint", "mem_bytes": "bigint", "anon_bytes": "bigint", "disk_kb": "bigint",
                  "mem_available_bytes": "bigint", "disk_free_kb": "bigint", "load1": "double"}


def read_samples(spark: SparkSession, path: str, packed: bool = False) -> DataFrame:
    """Resource samples with the memory source named in the first comment of their file.

    ``packed``: the text files hold the lines of many files, as ``sinks.write_packed_lines`` lays them out.
    """
    lines = read_packed_lines(spark, path) if packed else read_lines(spark, path)
    source = first_match(lines.filter(F.col("value").startswith("#")), {"source": r"^#[^:]*:\s*(.*?)\s*$"})
    rows = parse_headed_csv(lines, "epoch", SAMPLE_COLUMNS).filter("epoch is not null")
    return rows.join(source.select("file", F.col("found").alias("source")), "file", "left")


def read_stages(spark: SparkSession, path: str) -> DataFrame:
    """Seconds per stage; a repeated stage is summed."""
    rows = parse_headed_csv(read_lines(spark, path), "stage", {"stage": "string", "seconds": "bigint"})
    return rows.groupBy("file", "stage").agg(F.sum("seconds").alias("seconds"))


def mine_build_log(lines: DataFrame) -> DataFrame:
    """Five counters per log; an absent counter is NULL, never zero."""
    found = first_match(lines, BUILD_COUNTERS)
    files = lines.select("file").distinct()
    wide = found.groupBy("file").agg(*[F.max(F.when(F.col("name") == n, F.col("found").cast("bigint"))).alias(n) for n in BUILD_COUNTERS])
    return files.join(wide, "file", "left")


def mine_admin_log(lines: DataFrame) -> DataFrame:
    """Distinct names of dropped admin records per log."""
    name = F.trim(F.regexp_extract("value", DROPPED_ADMIN, 1))
    return lines.select("file", name.alias("name")).filter("name <> ''").distinct()


def mine_gate_reports(lines: DataFrame, kind: str) -> DataFrame:
    """Counts of the summary lines and the verdict lines of one kind of report: file, counts, missing, said."""
    trimmed = lines.withColumn("value", F.rtrim("value"))
    names = {n: (p, i + 1) for p, ns in REPORT_LINES[kind].items() for i, n in enumerate(ns)}
    found = first_match(trimmed, {n: p for n, (p, _) in names.items()}, {n: i for n, (_, i) in names.items()})
    counts = found.groupBy("file").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", F.col("found").cast("bigint").alias("found"))))).alias("counts"))
    label = kind.upper() + " GATE:"
    verdict = trimmed.filter(F.col("value").startswith(label)).groupBy("file").agg(
        F.count(F.lit(1)).alias("verdict_lines"), F.min(F.trim(F.substring("value", len(label) + 1, 1 << 30))).alias("said"))
    files = lines.select("file").distinct()
    lead = [ns[0] for ns in REPORT_LINES[kind].values()]
    absent = F.filter(F.array(*[F.lit(n) for n in lead]), lambda n: F.col("counts").isNull() | ~F.array_contains(F.map_keys("counts"), n))
    joined = files.join(counts, "file", "left").join(verdict, "file", "left")
    return joined.select("file", "counts", F.size(absent).alias("missing"), F.coalesce("verdict_lines", F.lit(0)).alias("verdict_lines"), "said")


def parse_tz_links(lines: DataFrame) -> DataFrame:
    """tzdata source lines → what (link, zone, version), name, target."""
    w = F.split("value", r"\s+")
    at = lambda i: F.try_element_at(w, F.lit(i))
    what = (F.when(F.col("value").startswith("# version"), "version")
            .when(F.col("value").startswith("L") & (F.size(w) >= 3), "link")
            .when(F.col("value").startswith("Z") & (F.size(w) >= 2), "zone"))
    name = F.when(what == "link", at(3)).when(what == "zone", at(2)).otherwise(at(-1))
    return lines.select(what.alias("what"), name.alias("name"), F.when(what == "link", at(2)).alias("target")).filter("what is not null").distinct()


def read_tz_links(spark: SparkSession, path: str) -> DataFrame:
    return parse_tz_links(spark.read.text(path))
