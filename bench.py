"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import time

from atlas.queries import load
from atlas.session import get_spark

HEADLINE = (
    "x02_name_key", "j07_point_in_polygon", "j06_nearest_locality", "j10_anchor_join", "j12_match_frontiers",
    "j13_all_pairs", "j21_grade_separation", "w01_greedy_dedup", "a05_upper_median", "w02_merge_duplicates",
    "p01_build_search_index", "p04_navigation_features", "p06_bus_lanes", "p07_build_frontier", "q01_prefix_search",
    "j17_tile_delta", "j32_asset_reconcile", "v13_manifest_gate", "v18_routes_verdict", "v21_continuity", "p03_address_index",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    only = tuple(filter(None, os.environ.get("BENCH_QUERIES", "").split(",")))
    spark = get_spark("bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    registry = load()
    registry["j17_tile_delta_summary"].run(spark, folder).collect()   # start the JVM's workers before timing
    seconds = {}
    for name in only or HEADLINE:
        start = time.time()
        registry[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({"metric": "total wall time of headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": float(scale.group(1)) if scale else None}))


if __name__ == "__main__":
    main()
